"""Exact duplicates against brute force, with digests that clash and groups that are heavy."""

import hashlib
from collections import defaultdict

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact as e
from tidemark.llm.common import ascii_lower, free_name

AWKWARD = [
    (1, "Same TEXT"), (2, "same text"), (3, "SAME text"), (3, "same text"), (4, None), (5, ""), (6, " "), (None, None),
    (None, "same texT"), (7, "ÉCOLE"), (8, "École"), (9, "École"), (10, "x" * 300_000), (11, "X" * 300_000), (-4, "İ Σ K"),
    (12, "i̇ σ k"), (12, "unique"), (12, "unique"), (13, "ǅ A"), (14, "ǆ a"),
]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    of = defaultdict(list)
    for i, t in rows:
        of[lowered(t)].append(i)
    out = []
    for i, t in rows:
        ids = of[lowered(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((repr(i), repr(keep), len(ids), hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out)


def check(got, rows):
    assert sorted((repr(r.id), repr(r.keep_id), r.group_size, r.digest) for r in got) == brute(rows)
    stay = defaultdict(list)
    for r in got:
        if r.kept:
            stay[r.digest].append(r.id)
    of = {hashlib.sha256(lowered(t).encode()).hexdigest() for _, t in rows}
    assert set(stay) == of and all(len(v) == 1 for v in stay.values())
    assert all(r.id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("least", [1000, 2, 1])
def test_groups(spark, monkeypatch, least):
    monkeypatch.setattr(e, "LEAST_HEAVY", least)
    rows = AWKWARD + [(r[0], r[1]) for r in d.rows()]
    check(e.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect(), rows)


def test_a_group_of_most_rows(spark, monkeypatch):
    monkeypatch.setattr(e, "LEAST_HEAVY", 50)
    rows = [(i, "Copy" if i % 2 else f"text {i // 3}") for i in range(3000)]
    check(e.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect(), rows)


@pytest.mark.parametrize("least", [1000, 2])
@pytest.mark.parametrize("weak", [lambda c: F.lit("same"), lambda c: F.length(c).cast("string")])
def test_texts_of_one_digest_are_compared_whole(spark, monkeypatch, least, weak):
    monkeypatch.setattr(e, "LEAST_HEAVY", least)
    rows = AWKWARD + [(100 + i, f"text {i % 7}") for i in range(60)]
    got = e.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), digest=weak).collect()
    want = brute(rows)
    assert sorted((repr(r.id), repr(r.keep_id), r.group_size) for r in got) == sorted(w[:3] for w in want)
    assert sum(r.kept for r in got) == len({lowered(t) for _, t in rows})


def test_rows_that_stay_keep_their_columns(spark):
    names = ["doc_id", "text", "row", "digest", "rank", "n", "kept", "input", "content", "salt", "heavy", "keep_id"]
    rows = [(i, t, 1, "d", 2, 3, True, "i", "c", 4, False, i) for i, t in AWKWARD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, digest string, rank int, n int, kept boolean, input string, "
                                       "content string, salt int, heavy boolean, keep_id long")
    got = e.drop_duplicates(docs)
    assert got.columns == names
    kept = got.collect()
    assert len(kept) == len({lowered(t) for _, t in AWKWARD}) and {r.input for r in kept} == {"i"}
    # Of rows with the largest id, which one stays does not depend on the order of the rows.
    one = [tuple(r) for r in e.drop_duplicates(docs.withColumn("digest", F.upper("text"))).collect()]
    two = [tuple(r) for r in e.drop_duplicates(docs.withColumn("digest", F.upper("text")).orderBy(F.desc("text")).repartition(3)).collect()]
    assert sorted(one, key=repr) == sorted(two, key=repr)


def test_empty_table_and_only_nulls(spark):
    empty = d.empty(spark)
    assert e.duplicate_groups(empty).count() == 0 and e.drop_duplicates(empty).columns == empty.columns
    nulls = spark.createDataFrame([(None, None)] * 4, "doc_id long, text string")
    got = e.duplicate_groups(nulls).collect()
    assert [(r.id, r.keep_id, r.group_size) for r in got] == [(None, None, 4)] * 4 and sum(r.kept for r in got) == 1
    assert e.drop_duplicates(nulls).count() == 1


def test_only_ascii_letters_are_lowered(spark):
    texts = ["ABC xyz", "ÀÉ AB", "İI", "ΑΣ A", "ſ K Å", "", "A" * 1000 + "ß"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert [r[0] for r in df.select(ascii_lower(F.col("t"))).collect()] == [*map(lowered, texts), None]
    assert free_name(df, "T") == "T_" and free_name(df, "u") == "u"


def test_no_python_in_the_plan(spark):
    from tidemark.llm.queries import op13_exact_dedup

    plan = op13_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
