"""Targets, quotas and what is taken."""

import random

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as m


def quotients(shares, seats, most=None):
    won = [0] * len(shares)
    for _ in range(seats):
        free = [i for i in range(len(shares)) if shares[i] > 0 and (most is None or won[i] < most[i])]
        if not free:
            break
        won[max(free, key=lambda i: (shares[i] / (2 * won[i] + 1), -i))] += 1
    return won


@pytest.mark.parametrize("seed", range(30))
def test_apportionment_by_highest_quotients(seed):
    rng = random.Random(seed)
    shares = [rng.choice([0, 1, 1, 2, 5, rng.random() * 100]) for _ in range(rng.randrange(1, 12))]
    seats = rng.randrange(0, 80)
    assert m.sainte_lague(shares, seats) == (quotients(shares, seats) if sum(shares) else [0] * len(shares))
    most = [rng.randrange(0, 20) for _ in shares]
    assert m.sainte_lague(shares, seats, most) == (quotients(shares, seats, most) if sum(shares) else [0] * len(shares))


def test_targets():
    assert m.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    # The first stops at 3 times its size; what it leaves is shared out 2 to 1.
    assert m.targets([10, 100, 100], [5, 2, 1]) == [30.0, 120.0, 60.0]
    assert m.targets([0, 0], [5, 2]) == [0.0, 0.0]
    assert m.targets([1, 1, 1000], [5, 2, 1]) == [3.0, 3.0, 996.0]


def taken_by_source(rows):
    out = {}
    for r in rows:
        t = out.setdefault(r.source, [r.target, 0, r.source_size])
        t[1] += r.taken
    return out


@pytest.mark.parametrize("shard", [50, 2000, 10**6])
def test_mix(spark, shard):
    table = d.table(spark, n=120)
    mixed = m.mix(table, shard=shard)
    assert set(mixed.columns) == set(table.columns) | {"source_size", "target", "taken", "ranges"}
    rows = mixed.collect()
    plain = table.select("doc_id", "source", F.size(F.array_compact(F.split(F.regexp_replace(
        F.coalesce("text", F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+"))).alias("n"), "text").collect()
    words = lambda t: len([w for w in (t or "").encode().split()])
    assert len(rows) == len(plain)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted(
        (r.doc_id is None, r.doc_id or 0, words(r.text)) for r in plain)
    assert all(0 <= r.taken <= 3 * r.size and r.taken == sum(b - a for a, b in r.ranges) for r in rows)
    assert all(0 <= a < b <= r.size for r in rows for a, b in r.ranges)
    by = taken_by_source(rows)
    sizes = {s: sum(words(r.text) for r in plain if r.source == s) for s in by}
    names = sorted((s for s in by if s is not None), key=str.encode) + [None]
    assert [by[s][2] for s in names] == [sizes[s] for s in names]
    want = m.targets([sizes[s] for s in names], [5, 2, 1][: len(names)])
    assert [by[s][0] for s in names] == pytest.approx(want)
    assert all(abs(by[s][1] - by[s][0]) <= 0.02 * by[s][0] + 1 for s in names)
    again = m.mix(table.repartition(7), shard=shard).collect()
    assert sorted(map(str, ((r.doc_id, r.size, r.taken) for r in rows))) == sorted(map(str, ((r.doc_id, r.size, r.taken) for r in again)))


def test_taken_texts(spark):
    table = d.table(spark, n=60)
    mixed = m.mix(table, shard=500)
    out = m.mix(table, shard=500, cut="text").collect()
    total = mixed.agg(F.sum("taken")).first()[0]
    assert sum(len(r.text.encode().split()) for r in out) == total
    texts = {r.text for r in table.collect()}
    assert all(any(r.text in (t or "") for t in texts) for r in out)


def test_nothing_to_mix(spark):
    assert m.mix(d.empty(spark)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {r.taken for r in m.mix(none).collect()} == {0}
