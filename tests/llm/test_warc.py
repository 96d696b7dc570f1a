"""Revisits against a plain walk through each address's captures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc as w

SCHEMA = "record_id long, kind string, url string, time long, headers map<string,string>, payload string"


def captures(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("url, want", [
    ("http://WWW.Example.com:80/", "example.com"), ("https://example.com/index.html#top", "example.com"),
    ("https://u:p@example.com/A/b/?b=2&a=1&utm_source=x", "example.com/A/b?a=1&b=2"), ("example.com/a?ref=x", "example.com/a"),
    ("http://example.com:8080/a/index.php?", "example.com:8080/a"), ("", None), (None, None), ("http://", None),
    ("http://Exämple.de./Ü", "exämple.de/Ü"),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(w.canonical_url("u")).first()[0] == want


def plain(rows):
    """(status, source) of each revisit."""
    out = {}
    for r, kind, url, time, headers, _ in rows:
        if kind != "revisit":
            continue
        before = [x for x in rows if x[1] == "response" and x[2] == url and x[3] is not None and time is not None and x[3] < time]
        if url is None or not before:
            out[r] = ("unresolved", None)
            continue
        base = max(before, key=lambda x: (x[3], x[0]))
        mine, theirs = ({k.lower(): v for k, v in (x or {}).items()} for x in (headers, base[4]))
        weak = lambda t: re.sub("^[Ww]/", "", t)
        if "etag" in mine and "etag" in theirs:
            agree = weak(mine["etag"]) == weak(theirs["etag"])
        elif "last-modified" in mine and "last-modified" in theirs:
            agree = mine["last-modified"] == theirs["last-modified"]
        else:
            agree = None
        out[r] = ({True: "resolved", False: "mismatch", None: "unverified"}[agree], None if agree is False else base[0])
    return out


@pytest.mark.parametrize("ranges", [60, 7, None])
def test_revisits(spark, ranges):
    rng = random.Random(ranges or 1)
    rows = []
    for i in range(400):
        head = {}
        if rng.random() < 0.7:
            head[rng.choice(["ETag", "etag"])] = rng.choice(['"a"', 'W/"a"', '"b"'])
        if rng.random() < 0.5:
            head["Last-Modified"] = rng.choice(["x", "y"])
        url = rng.choice(["http://hot.com/a"] * 8 + ["http://b.com", "c.com/x?q=1", None])
        kind = rng.choice(["response", "revisit"])
        rows.append((i, kind, url, rng.choice([None, *range(60)]), rng.choice([head, head, head, None]), f"p{i}" if kind == "response" else None))
    got = {r.record_id: r for r in w.resolve_revisits(captures(spark, rows).repartition(4), ranges=ranges).collect()}
    assert len(got) == 400
    want = plain(rows)
    assert {k: (got[k].status, got[k].source_id) for k in want} == want
    assert all(got[k].payload == (None if s is None else f"p{s}") for k, (_, s) in want.items())
    strict = {r.record_id: r.payload for r in w.resolve_revisits(captures(spark, rows), strict=True, ranges=ranges).collect()}
    assert all(strict[k] is None for k, (s, _) in want.items() if s != "resolved")


def test_headers(spark):
    rows = [(1, "response", "a.com", 1, {"ETag": '"x"', "Content-Length": "9", "X": "old", "Keep": "k"}, "body"),
            (2, "Revisit", "http://a.com/", 2, {"etag": 'W/"x"', "content-length": "0", "x": "new", "Y": "more"}, None)]
    got = {r.record_id: r for r in w.resolve_revisits(captures(spark, rows)).collect()}
    assert got[2].headers == {"etag": '"x"', "content-length": "9", "x": "new", "keep": "k", "y": "more"}
    assert (got[2].payload, got[2].status, got[1].status) == ("body", "resolved", "response")


def test_repeated_rows_nulls_and_nothing(spark):
    rows = [(1, "response", "a.com", 1, None, "p")] * 2 + [(2, "revisit", "a.com", 2, None, None)] * 2
    rows += [(None, "revisit", "a.com", 2, None, None), (3, "response", None, None, None, None)]
    df = captures(spark, rows).withColumn("status", F.lit("mine")).withColumn("canonical", F.lit("z"))
    got = [(r.record_id, r.status, r.payload) for r in w.resolve_revisits(df).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "response", "p")] * 2 + [(2, "unverified", "p")] * 2 + [(None, "unverified", "p"), (3, "response", None)], key=str)
    assert w.resolve_revisits(captures(spark, [])).count() == 0


CAPTURE = "record_id long, kind string, url string, time double, headers map<string,string>, payload string"


def resolved(spark, rows):
    out = w.resolve_revisits(spark.createDataFrame(rows, CAPTURE).repartition(3)).collect()
    assert len(out) == len(rows)
    return sorted(((r.record_id, r.kind, r.url, r.time, r.status, r.source_id, r.payload) for r in out), key=repr)


def test_every_kind_comes_back(spark):
    tag = {"ETag": '"a"'}
    rows = [(1, "response", "http://a/", 1.0, tag, "A"), (2, "request", "http://a/", 2.0, tag, "ask"), (3, None, "http://a/", 2.0, None, None),
            (4, "Revisit", "http://a/", 3.0, tag, None), (5, "metadata", None, None, None, "m")]
    got = {r[0]: r[4:] for r in resolved(spark, rows)}
    assert got == {1: ("response", 1, "A"), 2: ("other", None, "ask"), 3: ("other", None, None), 4: ("resolved", 1, "A"), 5: ("other", None, "m")}


def test_ids_that_repeat_or_are_null(spark):
    tag = {"ETag": '"a"'}
    rows = [(1, "response", "http://a/", 1.0, tag, "A"), (9, "revisit", "http://a/", 2.0, tag, None), (9, "revisit", "http://b/", 2.0, tag, None),
            (9, "revisit", "http://a/", 2.0, tag, None), (None, "response", "http://c/", 1.0, tag, "C"), (None, "revisit", "http://c/", 2.0, tag, None),
            (None, "revisit", "http://d/", 2.0, tag, None)]
    got = [(r[0], r[2], r[4], r[6]) for r in resolved(spark, rows) if r[1] == "revisit"]
    assert sorted(got, key=repr) == sorted([(9, "http://a/", "resolved", "A"), (9, "http://a/", "resolved", "A"), (9, "http://b/", "unresolved", None),
                                            (None, "http://c/", "resolved", "C"), (None, "http://d/", "unresolved", None)], key=repr)


def test_earlier_is_strict_for_any_time(spark):
    rows = [(1, "response", "http://a/", 1.25, {}, "old"), (2, "response", "http://a/", 1.5, {}, "same time"), (3, "revisit", "http://a/", 1.5, {}, None),
            (4, "revisit", "http://a/", 1.75, {}, None), (5, "revisit", "http://a/", 1.25, {}, None)]
    got = {r[0]: (r[4], r[6]) for r in resolved(spark, rows)}
    assert got[3] == ("unverified", "old") and got[4] == ("unverified", "same time") and got[5] == ("unresolved", None)


def test_many_captures_of_one_moment(spark):
    """A URL whose captures are all close together is still cut, and every stretch knows the responses before it."""
    rows = [(i, "response" if i % 40 == 0 else "revisit", "http://hot/", float(i // 100), {}, f"p{i}" if i % 40 == 0 else None) for i in range(2000)]
    last = {}
    for i, kind, _, t, _, p in rows:
        if kind == "response":
            last[t] = max(last.get(t, (-1, "")), (i, p))
    for r in resolved(spark, rows):
        if r[1] == "revisit":
            want = max((v for t, v in last.items() if t < r[3]), default=None)
            assert (r[5], r[6]) == (want or (None, None))
