"""Columns of the input never clash with helper columns, and come back as they were."""

import re
from pathlib import Path

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark import llm
from tidemark.llm import exact, mixing, pii, rules, simhash, toxicity

OPERATORS = {
    "rules": lambda df: rules.apply_rules(df),
    "pii": lambda df: pii.find_spans(df),
    "mixing": lambda df: mixing.mix(df),
    "simhash": lambda df: simhash.drop_near_duplicates(df),
    "exact": lambda df: exact.drop_duplicates(df),
    "toxicity": lambda df: toxicity.drop_toxic(df, toxicity.Model({"the": 1.0}, -9.0)),
}
#: What an operator adds replaces columns of the same name; these are stated in its docstring.
ADDED = {"rules": {*rules.BASE, *rules.FIGURES, "kept"}, "pii": {"spans"}, "mixing": set(mixing.ADDED)}
GIVEN = {"doc_id", "text", "lang", "source"}


def helpers(module):
    """Every name in quotes in the source of an operator that could be one of its helper columns."""
    source = Path(llm.__file__).parent.joinpath(f"{module}.py").read_text()
    return sorted({n for n in re.findall(r'"([a-z_][a-z_0-9]{0,20})"', source)} - GIVEN)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_helper_names_in_the_input(spark, name):
    names = [n for n in helpers(name) + [f"pii_{k}" for k in pii.BASE] + ["r_lang", "n_lines", "fence_mean_word", "mix_of", "mix_order", "keep_id", "input", "none"]]
    names = sorted(set(names) - ADDED.get(name, set()))
    docs = d.table(spark).select("doc_id", "text", "lang", "source").filter("doc_id is not null").dropDuplicates(["doc_id"])
    plain = {r.doc_id: r for r in OPERATORS[name](docs).collect()}
    wide = docs.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names])
    got = {r.doc_id: r for r in OPERATORS[name](wide).collect()}
    assert set(got) == set(plain) and plain
    for i, r in got.items():
        assert all(r[n] == f"{n}:{i}" for n in names)
        if name not in ("mixing",):  # the seeded order of rows alike in id and size is free
            assert all(r[c] == plain[i][c] for c in plain[i].asDict())


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    """Rows alike in id and text but not in source, and rows without an id."""
    rows = [(i // 3, f"some words of text {i // 3}", "en", f"s{i % 3}") for i in range(30)] + [(None, "no id " * 5, "en", f"s{i % 4}") for i in range(12)]
    one = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(1)
    two = spark.createDataFrame(rows[::-1], one.schema).repartition(4)
    for name in ("simhash", "exact", "mixing"):
        a, b = (sorted(map(repr, OPERATORS[name](x).collect())) for x in (one, two))
        assert a == b, name
