"""Figures against brute force, sketches against exact quantiles, and limits that follow the group."""

import random
import re
from collections import Counter

import documents as d
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import rules as r

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_figures(spark):
    rng = random.Random(2)
    extra = [" ".join(rng.choice("ab") for _ in range(n)) for n in range(14)] + ["#a\n#a\n#a\n \n", "one two three four five " * 3, "ü* " * 12]
    table = d.table(spark).select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame([(1000 + i, t, "en", "s") for i, t in enumerate(extra)], "doc_id long, text string, lang string, source string"))
    rows = r.apply_rules(table).collect()
    assert len(rows) == table.count()
    for x in rows:
        want = plain(x.text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert x.kept is not None and not (x.kept and x.base_failed)


def test_sketch_quantiles(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate((rng.pareto(1.5, 3000), np.zeros(500)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select(r.bucket(F.col("v")).alias("b"))
    df = df.withColumn("x", r.bucket_value(F.col("b")))
    got = np.sort([row.x for row in df.collect()])
    want = np.sort(values)
    assert np.all(np.abs(got - want) <= r.ALPHA * want + 2 * r.ZERO)


def figures(spark, rows):
    schema = "lang string, source string, symbol_share double, base_failed boolean"
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"repeat_share": F.lit(0.0), "repeated_line_share": F.lit(0.0), "mean_word": F.lit(5.0)})


def test_limits_follow_the_group(spark):
    # Code has many symbols and keeps them; the same share elsewhere is out.
    rows = [("en", "code", 0.3 + i % 10 / 100, False) for i in range(300)] + [("en", "news", 0.0, False)] * 300
    rows += [("en", "news", 0.35, False), ("en", "code", 0.9, False), ("en", "news", 0.0, True)]
    out = r.judge(figures(spark, rows)).groupBy("source", "kept").count().collect()
    assert {(x.source, x.kept): x["count"] for x in out} == {
        ("code", True): 300, ("code", False): 1, ("news", True): 300, ("news", False): 2}


def test_small_groups_use_wider_sketches(spark):
    rows = [("en", "code", 0.4, False)] * 300 + [("en", "tiny", 0.4, False), ("fr", "few", 0.4, False), (None, None, 0.9, False)]
    got = r.fences(r.sketches(figures(spark, rows))).collect()
    fence = {(x.lang, x.source): x.fence_symbol_share for x in got}
    assert fence[("en", "tiny")] == pytest.approx(0.45, abs=0.02) == fence[("fr", "few")]
    kept = {(x.lang, x.source): x.kept for x in r.judge(figures(spark, rows)).collect()}
    assert kept == {("en", "code"): True, ("en", "tiny"): True, ("fr", "few"): True, (None, None): False}


def test_nothing_and_clashing_names(spark):
    assert r.apply_rules(d.empty(spark)).count() == 0
    table = d.table(spark).withColumns({"kept": F.lit("x"), "n_words": F.lit("y"), "docs": F.lit(1), "bucket": F.lit(2)})
    out = r.apply_rules(table)
    assert out.count() == table.count() and dict(out.dtypes)["kept"] == "boolean" and dict(out.dtypes)["docs"] == "int"


def test_no_python_in_the_plan(spark):
    plan = r.apply_rules(d.table(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
