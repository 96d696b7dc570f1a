"""Suffix arrays, common prefixes and removal against brute force."""

import random

import documents as d
import numpy as np
import pytest

from tidemark.llm import suffix as s


def texts(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    kinds = [rng.integers(97, 99, n), np.frombuffer((b"abcabcab" * 60)[:n], np.uint8), rng.integers(0, 256, n), np.full(n, 97)]
    return kinds[seed % 4].astype(np.uint8)


@pytest.mark.parametrize("seed", range(24))
def test_suffix_array_and_common_prefixes(seed):
    t = texts(seed)
    b, n = t.tobytes(), len(t)
    order = s.suffix_array(t, 1000)
    assert order.tolist() == sorted(range(n), key=lambda i: b[i:])
    common = s.common_prefixes(t, order, chains=7 + seed)

    def prefix(i, j):
        k = 0
        while k < s.LENGTH and max(i, j) + k < n and b[i + k] == b[j + k]:
            k += 1
        return k

    assert common.tolist()[1:] == [prefix(order[k - 1], order[k]) for k in range(1, n)]


def removed(rows):
    """Kept bytes per row, by the definition."""
    out = []
    for key, text in rows:
        data = (text or "").encode()
        earlier = {t[i:i + 50] for k, t in ((k, (t or "").encode()) for k, t in rows)
                   if k is not None and (key is None or k < key) for i in range(len(t) - 49)}
        gone = np.zeros(len(data) + 1, int)
        for i in range(len(data) - 49):
            if data[i:i + 50] in earlier:
                gone[i] += 1
                gone[i + 50] -= 1
        gone = np.cumsum(gone)[:-1] > 0 if len(data) else np.zeros(0, bool)
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        out.append((key, len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, piece", [(s.CHUNK, s.PIECE), (3000, s.PIECE), (2000, 300)])
def test_removal(spark, monkeypatch, chunk, piece):
    monkeypatch.setattr(s, "PIECE", piece)
    rng = random.Random(chunk)
    shared = [d.prose(rng, 12)[: rng.choice([49, 50, 51, 80, 200])] for _ in range(6)]
    rows = [(r[0], r[1] if r[1] is None else r[1][:3000]) for r in d.rows(5, 25)]
    for i in range(60):
        parts = [d.prose(rng, 6), rng.choice(shared), d.prose(rng, 3), rng.choice(shared), rng.choice(["", "ü", d.prose(rng, 30)])]
        rows.append((rng.choice([1000 + i, 1000 + i, 1010, None]), rng.choice(["", " "]).join(parts)))
    rows += [(2000 + i, shared[-1] * 3) for i in range(9)] + [(3000, "a" * 400), (3001, "a" * 49), (3002, "a" * 51), (3003, "ab" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in s.remove_repeats(df, chunk).collect()), key=str)
    assert got == removed(rows)


def test_pieces_are_merged(monkeypatch):
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 70).astype(np.uint8)
    parts = [np.concatenate((rng.integers(97, 123, 20), passage, rng.integers(97, 123, 15))).astype(np.uint8) for _ in range(12)]
    text, ends, ids = np.concatenate(parts), np.cumsum([len(p) for p in parts]), np.arange(12)[::-1].copy()
    data = [(int(i), p.tobytes()) for i, p in zip(ids, parts)]
    want = [int(e) - len(t) + k for (i, t), e in zip(data, ends) for k in range(len(t) - 49)
            if any(j < i and t[k:k + 50] in u for j, u in data)]
    assert len(want) >= 11 * 21
    for piece in (s.PIECE, 250):
        monkeypatch.setattr(s, "PIECE", piece)
        assert np.sort(s.repeated(text, ends, ids)).tolist() == want


def test_nothing(spark):
    assert s.remove_repeats(d.empty(spark)).count() == 0
    rows = s.remove_repeats(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == {(1, 0, 0, 0, b""), (None, 0, 0, 0, b"")}
