"""Ids against the tokenizer itself, and exact round trips of blocks and sequences."""

import random
import zlib

import documents as d
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokens as t
from tidemark.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/{t.VOCABULARY_FILE}"
ODD = [
    "", "a", "  a", "a  b", "it's o'clock 'S", "naïve cœur x", "\t tab\n\n x", "x\n", " lead", "trail ", "a \n b", "a\n b",
    "a\n\n b", "​ zero", "ñ1ñ2,a", "don't  \n'll", "<|endoftext|> x", "日本語 text", "Á b", "\x1c a\x1cb",
    "a\x85b c", "Ġ b Ġ", "...!? x", "é" * 50, " \n \n", "ªº µm", "a b c", "\x00 a",
]


@pytest.fixture(scope="module")
def encoder():
    return t.Encoder(PATH)


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [t.END_ID]


def test_ids_are_those_of_the_tokenizer(encoder, monkeypatch):
    monkeypatch.setattr(t, "CACHE", 200)
    monkeypatch.setattr(t, "LOT_CHARS", 500)
    rng = random.Random(1)
    texts = ODD + [r[1] for r in d.rows(2, 30)] + [
        "".join(rng.choice("ab é'\n.,1  œ<|>_Ġ") for _ in range(40)) for _ in range(500)
    ]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.kind).tolist() == plain(encoder, text), repr(text)


@pytest.mark.parametrize("cache", [200, 1 << 30])
def test_words_of_many_pieces(monkeypatch, cache):
    """Against a tokenizer of its own: contractions, digits, marks and letters of many scripts next to each other."""
    monkeypatch.setattr(t, "CACHE", cache)
    monkeypatch.setattr(t, "LOT_CHARS", 3000)
    fresh, encoder, rng = Tokenizer.from_file(PATH), t.Encoder(PATH), random.Random(3)
    parts = ["don't", "'ll", "'LL", "foo", "bar-", "12", "½", "²", "_", "é", "ß", "Ж", "日", "ª", "\n", "...", "'", "\u0301", "͵", "ʰ", "\u0345", "Ա", "x"]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.kind).tolist() == fresh.encode(text, add_special_tokens=False).ids + [t.END_ID], repr(text)


def test_some_documents_by_select(spark):
    docs = d.table(spark)
    blocks = t.write_tokens(docs, PATH, block_ids=500, shards=3)
    wanted = [0, 7, 44, -5, 10**9, 3]
    got = sorted((r.doc_id, r.ids) for r in t.ids_of(blocks, wanted).collect())
    fresh = Tokenizer.from_file(PATH)
    want = sorted(
        (r.doc_id, fresh.encode(r.text or "", add_special_tokens=False).ids + [t.END_ID]) for r in docs.collect() if r.doc_id in wanted
    )
    assert got == want and len(got) >= 5


@pytest.mark.parametrize("values", [
    [], [0], [7], [5, 5, 5], [0, 1 << 40], [-9, -9, -1, 4], list(range(3000)), [2**62 // 1000 * i for i in range(1000)],
])
def test_elias_fano(values):
    data = t.EliasFano.of(np.array(values, np.int64)).to_bytes()
    e = t.EliasFano.from_bytes(data)
    assert e.decode().tolist() == values
    assert [e.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        e.select(len(values))


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 2000, 10_000))
    # Two bits a number and the bits of the mean gap, and the samples.
    assert len(t.EliasFano.of(ends).to_bytes()) * 8 / 10_000 < 2 + 10 + 0.5


@pytest.mark.parametrize("block_ids, shards", [(50, 3), (1 << 18, None)])
def test_documents_come_back(spark, encoder, tmp_path, block_ids, shards):
    table = d.table(spark)
    written = t.write_tokens(table, PATH, str(tmp_path / "out"), block_ids=block_ids, shards=shards)
    got = t.read_documents(written).collect()
    rows = table.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    start, want = 0, []
    for r in rows:
        ids = plain(encoder, r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    sizes = [(b.n_docs, b.n_ids) for b in written.select("n_docs", "n_ids").collect()]
    assert all(docs == 1 or ids <= block_ids for docs, ids in sizes) and sum(x[1] for x in sizes) == start


def test_nothing(spark, tmp_path):
    assert t.read_documents(t.write_tokens(d.empty(spark), PATH, str(tmp_path / "out"))).count() == 0


def test_added_tokens_are_those_of_a_fresh_tokenizer(encoder):
    fresh = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|>", "<|endoftext|> x", "a <|endoftext|> b", "one two<|endoftext|>three four", "<|endoftext| > a b", *ODD]
    assert 50256 in fresh.encode(texts[2], add_special_tokens=False).ids
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = fresh.encode(text, add_special_tokens=False).ids + [t.END_ID]
        assert np.frombuffer(ids, encoder.kind).tolist() == want, repr(text)


def test_few_words_in_many_combinations_are_few_to_remember():
    """What stands between blanks may be new each time, as line ends and marks join words; the words are not."""
    encoder, fresh = t.Encoder(PATH), Tokenizer.from_file(PATH)
    words = [a + b for a in ["ka", "Lo", "mé", "Жи"] for b in ["ra", "st", "ün", "日", "tion"]]
    texts = [" ".join(f"x {a}{s}\n{b}{s}" for b in words) for a in words for s in [",", ".", "?!", ""]]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.kind).tolist() == fresh.encode(text, add_special_tokens=False).ids + [t.END_ID], repr(text)
    assert len({w for text in texts for w in text.split(" ")}) > 1500 and encoder.held < 300 * t.ENTRY


@pytest.mark.parametrize("cache", [200, 1 << 30])
def test_line_feeds(monkeypatch, cache):
    """Runs of them at the start, between words and at the end, next to letters, marks, digits and other scripts."""
    monkeypatch.setattr(t, "CACHE", cache)
    monkeypatch.setattr(t, "LOT_CHARS", 300)
    encoder, fresh, rng = t.Encoder(PATH), Tokenizer.from_file(PATH), random.Random(5)
    parts = ["\n", "\n\n", "\n\n\n", "\n\n\n\n", " ", " ", "ab", "Ab", "é.", "...", "'s", "'", "7", "Ж", "日本", "\r", "\r\n", "_"]
    texts = ["\n" * n + w + "\n" * m for n in range(5) for w in ["", "a", "a b", "Ж", "日 x", ".", "a\nb"] for m in range(5)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.kind).tolist() == fresh.encode(text, add_special_tokens=False).ids + [t.END_ID], repr(text)
