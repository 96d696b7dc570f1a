"""Fingerprints, links and groups against brute force."""

import random

import documents as d
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as s


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, radius=3):
    """Smallest member of the group of each fingerprint."""
    left, out = set(fps), {}
    while left:
        todo, part = [left.pop()], set()
        while todo:
            x = todo.pop()
            part.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= radius}
            left -= near
            todo += near
        out.update(dict.fromkeys(part, frozenset(part)))
    return out


def test_fingerprints(spark):
    for t in [None, "", " ", "One", "one TWO", "a b c", "É É é a b", "a " * 500, "ab\x0bcd\x0c e\x1cf g h"]:
        assert s.fingerprint(None if t is None else t.encode()) == plain(t)
    got = d.table(spark).select("text", s.hex64(s.simhash("text")).alias("f")).collect()
    assert len(got) > 50 and all(r.f == f"{plain(r.text):016x}" for r in got)


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 7])
@pytest.mark.parametrize("shift", [1, 63, 64, 100])
def test_bit_sliced_distances(radius, shift):
    rng = np.random.default_rng(shift)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = rng.random(3000) < 0.3
    fps[shift:][near[shift:]] = fps[:-shift][near[shift:]] ^ (np.uint64(1) << rng.integers(0, 64, near[shift:].sum(), dtype=np.uint64))
    lanes = len(fps) - shift
    want = np.nonzero(np.bitwise_count(fps[:lanes] ^ fps[shift:]) <= radius)[0]
    assert np.array_equal(s.near_lanes(s._planes(fps), shift, lanes, radius), want)


def chains(rng, n=60):
    """Fingerprints in chains of small steps, so that groups reach far beyond the radius."""
    out = [0]
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 9])):
            out.append(x)
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
    return out


@pytest.mark.parametrize("tile", [2, 5, 2048])
@pytest.mark.parametrize("many", [False, True])
def test_links_keep_every_group(spark, tile, many, monkeypatch):
    if many:  # the scheme for large tables
        keys = s._bucket_keys
        monkeypatch.setattr(s, "_bucket_keys", lambda fp, n, r: keys(fp, 1 << 22, r))
    fps = chains(random.Random(tile))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in s.links(table, tile=tile).collect()]
    want = groups(fps)
    assert all(want[a] == want[b] for a, b in edges)
    # Links may go through a fingerprint between; together they connect the same groups.
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    assert len({find(x) for x in fps}) == len(set(want.values()))


def test_groups_of_documents(spark):
    fps = chains(random.Random(8))
    docs = [(i if i % 9 else None, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps * 2)]
    got = s.near_duplicate_groups(spark.createDataFrame(docs, "doc_id long, fp long")).collect()
    want = groups(fps)
    least = {}
    for i, x in docs:
        g = want[x % (1 << 64)]
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert len(got) == len(docs)
    assert all(r.component_id == least.get(want[r.fp % (1 << 64)]) for r in got)


def test_one_document_of_each_group_stays(spark):
    table = d.table(spark)
    left = s.drop_near_duplicates(table)
    assert left.columns == table.columns
    rows = table.collect()
    want = groups({plain(r.text) for r in rows})
    ids = {}
    for r in rows:
        ids.setdefault(want[plain(r.text)], []).append((r.doc_id is None, r.doc_id or 0))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect())
    assert got == sorted(min(x) for x in ids.values())


def test_nothing(spark):
    assert s.drop_near_duplicates(d.empty(spark)).count() == 0
    assert s.near_duplicate_groups(d.empty(spark).select("doc_id", F.lit(0).cast("long").alias("fp"))).count() == 0
