"""Token ids of documents in binary blocks with Elias-Fano coded document boundaries.

A file is a Parquet dataset of blocks, so that it is written and committed like any Spark table, on any file system. A
block holds, as little-endian bytes: the ids of its documents one after another (16 or 32 bits each, as the vocabulary
needs), the ends of the documents as an Elias-Fano sequence over that array, and the document ids as another. Offsets
come from the select structure; there is no table of 64-bit offsets.

Defined results: an added token of the vocabulary, such as ``<|endoftext|>``, is one id where a text holds it, as the
tokenizer's ``encode`` gives it; a null or empty text has the end id alone; repeated ids and rows are documents of their
own, in the order of id, then text; rows without an id come last; an empty table has no block. Other columns are left
out.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import saved, values

VOCABULARY_FILE = "byte_bpe_50k.json"
END_ID = 0
#: A block is closed at so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: Bytes of heads and pieces of words and their ids that a worker process remembers, about, and characters of text that it encodes together.
CACHE, LOT_CHARS = 64 << 20, 2 << 20
#: What an entry takes besides its characters.
ENTRY = 150
#: Bytes of text per shard, about.
SHARD_BYTES = 64 << 20

#: How the vocabulary file writes a blank.
BLANK = "\u0120"
#: Fixed value: the pattern of the byte-level pre-tokenizer. Tokens never cross its matches.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words without these are cut here, as any engine knows the classes of the other characters; the rest go to the tokenizer whole.
UNKNOWN = re.compile("[\u0530-\U0010ffff]")
#: Stands before the first word of a text, which has no blank before it. No text that is cut into words holds it.
FIRST = "\r"
MARKS = FIRST + "\n"
# White space other than blank and line feed, and what one of two regular expression engines takes for it.
_OTHER_SPACE = frozenset(
    c for c in map(chr, [*range(9, 14), *range(28, 32), 133, 160, 5760, 6158, *range(8192, 8208), 8232, 8233, 8239, 8287, 12288, 65279])
    if c != "\n"
)


def _plain(text: str) -> bool:
    """Whether every blank stands alone between other characters: the pre-tokenizer then always cuts before it, so what
    is between blanks can be encoded apart."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return not any(c in text for c in _OTHER_SPACE)


def _marked(text: str) -> str:
    """A plain text with a mark before its first word, and a blank before line feeds where each is a pre-token by itself: all but
    runs of three or more, and of two at the end."""
    return FIRST + (text if "\n\n\n" in text or text.endswith("\n\n") else text.replace("\n", " \n"))


def _cut(word: str) -> tuple[str, list[str]]:
    """A word of a marked text as its pre-token with a blank before it (or none) and its pre-tokens without. What holds
    characters of unknown class is left whole."""
    bare = word[0] in MARKS
    rest = word[1:] if bare else word
    if UNKNOWN.search(rest):
        cut = [rest]
    elif bare:
        cut = PRE_TOKEN.findall(rest)
    else:
        cut = PRE_TOKEN.findall(" " + rest)
        cut[0] = cut[0][1:]
    if word[0] == "\n":
        cut.insert(0, "\n")
    return ("", cut) if bare else (cut[0], cut[1:])


class EliasFano:
    """A non-decreasing sequence of ``n`` numbers below ``2**62``: the low bits side by side, the high bits in unary, and
    every ``SAMPLE``-th place of a one in the upper bits to start a select from."""

    SAMPLE = 256

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, base: int):
        self.n, self.low_bits, self.low, self.high, self.samples, self.base = n, low_bits, low, high, samples, base

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        base = int(values[0]) if n else 0
        rest = (values - base).astype(np.uint64)
        top = int(rest[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        places = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        if low_bits:
            lows = (rest & np.uint64((1 << low_bits) - 1))[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)
            low = np.packbits(lows.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), places[:: cls.SAMPLE].astype(np.uint32), base)

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqqqq", self.n, self.low_bits, len(self.low), len(self.high), self.base)
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, low_bits, a, b, base = struct.unpack_from("<qqqqq", data)
        low = np.frombuffer(data, np.uint8, a, 40)
        high = np.frombuffer(data, np.uint8, b, 40 + a)
        return cls(n, low_bits, low, high, np.frombuffer(data, "<u4", -1, 40 + a + b), base)

    def select(self, i: int) -> int:
        """The number at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // self.SAMPLE]), i % self.SAMPLE
        byte = place // 8
        skip = int(self.high[byte]) & ((1 << place % 8) - 1)
        left += skip.bit_count()
        while True:
            chunk = self.high[byte : byte + 64]
            ones = np.cumsum(np.unpackbits(chunk, bitorder="little"))
            if ones[-1] > left:
                place = byte * 8 + int(np.searchsorted(ones, left, "right"))
                break
            left -= int(ones[-1])
            byte += 64
        at = i * self.low_bits
        part = int.from_bytes(self.low[at // 8 : (at + self.low_bits + 7) // 8].tobytes(), "little") >> at % 8
        return (place - i << self.low_bits | part & (1 << self.low_bits) - 1) + self.base

    def decode(self) -> np.ndarray:
        """All numbers."""
        places = np.nonzero(np.unpackbits(self.high, bitorder="little"))[0][: self.n]
        out = (places - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits and self.n:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out + self.base


class Encoder:
    """Ids of texts as little-endian bytes; words that occur again are looked up."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Tokens that are cut out of a text before it is split into words.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = np.array([end_id], self.kind).tobytes()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.blank = np.array([t.startswith(BLANK) for t in tokens])
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.heads: dict[str, bytes] = {"": b""}  # first pre-tokens of words, with the blank before them
        self.pieces: dict[str, bytes] = {"": b""}  # pre-tokens without a blank
        self.held = 0

    @classmethod
    def of_process(cls, path: str, end_id: int = END_ID) -> "Encoder":
        """The encoder of this worker process, with what it knows from earlier tasks. Code of this package comes with each
        task, so the encoder is kept in a module of its own."""
        kept = sys.modules.setdefault("token_encoders_of_process", types.ModuleType("token_encoders_of_process"))
        found = getattr(kept, "encoders", {}).get((path, end_id, cls.__qualname__))
        if found is None:
            found = cls(path, end_id)
            kept.encoders = {(path, end_id, cls.__qualname__): found}
        return found

    def _by_word(self, text: str) -> bool:
        """Whether words can be looked up. An added token is cut out first and may hold blanks of its own."""
        return _plain(text) and not any(t in text or " " in t for t in self.added)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _keep(self, into: dict[str, bytes], parts: list[str], ids: list[bytes]) -> None:
        into.update(zip(parts, ids, strict=True))
        self.held += sum(map(len, parts)) + sum(map(len, ids)) + ENTRY * len(parts)

    def _learn_heads(self, heads: list[str]) -> None:
        """Encode heads strung together, each after a blank. A blank begins a pre-token and so a token, and there is no
        other, so the tokens that begin with a blank are the places to cut."""
        ids = self._whole(" " + " ".join(heads))
        cut = (np.append(np.nonzero(self.blank[ids])[0], len(ids)) * self.width).tolist()
        raw = ids.tobytes()
        self._keep(self.heads, heads, [raw[a:z] for a, z in zip(cut, cut[1:])])

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Encode pieces strung together, each before a line feed, which is a pre-token and a token by itself there."""
        for p in [p for p in pieces if "\n" in p]:
            self._keep(self.pieces, [p], [self._whole(p).tobytes()])
        if pieces := [p for p in pieces if "\n" not in p]:
            ids = self._whole("\n".join(pieces) + "\n.")
            raw, ends = ids.tobytes(), (np.nonzero(ids == self.feed)[0] * self.width).tolist()
            starts = [0, *[z + self.width for z in ends[:-1]]]
            self._keep(self.pieces, pieces, [raw[a:z] for a, z in zip(starts, ends, strict=True)])

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of words as ``_marked`` leaves them. Only heads and pieces are kept, so "word", "word." and "word" at a
        line's end are one piece of work."""
        out = list(map(self.heads.get, words))
        foreign = UNKNOWN.search("".join(words)) is not None
        # Most words are letters, then marks if any; the others are cut by the pattern.
        at, heads, tails, others = [], [], [], []
        for i, ids in enumerate(out):
            if ids is None:
                word = words[i]
                stem = word.rstrip(punctuation)
                if stem.isalpha() and not (foreign and UNKNOWN.search(word)):
                    at.append(i)
                    heads.append(stem)
                    tails.append(word[len(stem):])
                else:
                    others.append(i)
        cuts = [_cut(words[i]) for i in others]
        need = {*heads, *[head for head, _ in cuts]}
        pieces = {*tails, *[p for _, rest in cuts for p in rest]}
        if self.held > CACHE:  # the heads and pieces of this lot are the ones to keep
            kept = {w: ids for w, ids in zip(words, out) if ids is not None}
            kept |= {h: self.heads[h] for h in need if h in self.heads}
            self.heads, self.pieces, old, self.held = {"": b""}, {"": b""}, self.pieces, 0
            self._keep(self.heads, list(kept), list(kept.values()))
            again = [p for p in pieces if p in old]
            self._keep(self.pieces, again, [old[p] for p in again])
        if missing := list(need.difference(self.heads)):
            self._learn_heads(missing)
        if missing := list(pieces.difference(self.pieces)):
            self._learn_pieces(missing)
        head_of, piece_of = self.heads, self.pieces
        for i, head, tail in zip(at, heads, tails):
            out[i] = head_of[head] + piece_of[tail]
        for i, (head, rest) in zip(others, cuts):
            out[i] = head_of[head] + b"".join([piece_of[p] for p in rest])
        return out

    def _lot(self, texts: list[str]) -> list[bytes]:
        by_word = [self._by_word(t) for t in texts]
        split = pc.split_pattern(pa.array([_marked(t) for t, b in zip(texts, by_word) if b], pa.string()), " ")
        at = np.cumsum([0, *pc.list_value_length(split).to_pylist()])
        words = split.flatten().dictionary_encode()
        del split
        known = pa.array(self._ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        # The ids of all words lie one after another; where a text begins among them follows from its number of words.
        _, places, raw = known.take(words.indices).buffers()
        bounds = iter(np.frombuffer(places, np.int64)[at].tolist() if len(words) else [0])
        raw = memoryview(raw or b"")
        out, begin = [], next(bounds)
        for t, b in zip(texts, by_word):
            if b:
                end = next(bounds)
                out.append(bytes(raw[begin:end]) + self.end)
                begin = end
            else:
                out.append(self._whole(t).tobytes() + self.end)
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids with the end id."""
        lot, size = [], 0
        for t in texts:
            lot.append(t or "")
            size += len(lot[-1])
            if size >= LOT_CHARS:
                yield from self._lot(lot)
                lot, size = [], 0
        yield from self._lot(lot)


BLOCK_SCHEMA = (
    "shard int, block int, n_docs long, n_null_ids long, n_ids long, width int, ids binary, ends binary, doc_ids binary"
)


def encode_blocks(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                  shards: int | None = None) -> DataFrame:
    """Blocks of ``docs(doc_id, text)``; shards follow each other in ascending ``doc_id`` order, so do blocks in one."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text")]
    placed = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    numbered = placed.select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_process(tokenizer_path, end_id)
        ids: list[bytes] = []
        keys: list[int | None] = []
        no = size = shard = 0

        def block():
            ends = np.cumsum([len(x) // encoder.width for x in ids])
            given = [k for k in keys if k is not None]
            row = {
                "shard": shard, "block": no, "n_docs": len(keys), "n_null_ids": len(keys) - len(given),
                "n_ids": int(ends[-1]), "width": encoder.width, "ids": b"".join(ids),
                "ends": EliasFano.of(ends).to_bytes(), "doc_ids": EliasFano.of(given).to_bytes(),
            }
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_null_ids", pa.int64()),
                ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("ends", pa.binary()),
                ("doc_ids", pa.binary()),
            ]))

        for batch in batches:
            texts = values(batch.column(2))
            for shard, key, coded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoder.encode(texts)):
                if ids and size + len(coded) // encoder.width > block_ids:
                    yield block()
                    no, size = no + 1, 0
                    ids, keys = [], []
                ids.append(coded)
                keys.append(key)
                size += len(coded) // encoder.width
        if ids:
            yield block()

    return numbered.mapInArrow(encode, BLOCK_SCHEMA)


def decode_blocks(blocks: DataFrame) -> DataFrame:
    """Documents of written blocks: ``shard, block, doc_id, start`` (ids of the block before it), ``n_tokens`` and
    ``ids_crc32`` over the ids as 32-bit numbers."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                b = batch.slice(n, 1).to_pylist()[0]
                ids = np.frombuffer(b["ids"], f"<u{b['width']}").astype("<u4")
                ends = EliasFano.from_bytes(b["ends"]).decode()
                starts = np.concatenate(([0], ends[:-1]))
                keys = [*EliasFano.from_bytes(b["doc_ids"]).decode().tolist(), *[None] * b["n_null_ids"]]
                crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(keys)
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["shard"]] * n, pa.int32()), pa.array([b["block"]] * n, pa.int32()),
                    pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()),
                    pa.array(crc, pa.int64()),
                ], names=["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.select("shard", "block", "n_null_ids", "width", "ids", "ends", "doc_ids").mapInArrow(
        decode, "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def ids_of(blocks: DataFrame, wanted: list[int]) -> DataFrame:
    """``doc_id, ids`` of the documents with the given ids. Their places and bounds come from the select structures; no other
    document of a block is decoded."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for n in range(batch.num_rows):
                b = batch.slice(n, 1).to_pylist()[0]
                docs, ends = EliasFano.from_bytes(b["doc_ids"]), EliasFano.from_bytes(b["ends"])
                ids = np.frombuffer(b["ids"], f"<u{b['width']}")
                if not docs.n:
                    continue
                least, most = docs.select(0), docs.select(docs.n - 1)
                for w in wanted:
                    if not least <= w <= most:
                        continue
                    at = bisect_left(range(docs.n), w, key=docs.select)
                    while at < docs.n and docs.select(at) == w:
                        keys.append(w)
                        found.append(ids[ends.select(at - 1) if at else 0:ends.select(at)].astype(np.int64))
                        at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([x.tolist() for x in found], pa.list_(pa.int64()))], names=["doc_id", "ids"]
            )

    return blocks.select("width", "ids", "ends", "doc_ids").mapInArrow(look_up, "doc_id long, ids array<long>")


def block_starts(blocks: DataFrame) -> DataFrame:
    """``(shard, block, base)``: ids before each block. One small row per block; shards are added up first, so what one
    task sees is a row per shard or the blocks of one shard."""
    from pyspark.sql import Window as W

    sizes = blocks.select("shard", "block", "n_ids")
    per_shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per shard, a fixed number of bytes of text each.
    shards = per_shard.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(W.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("within", within).join(shards, "shard").select(
        "shard", "block", (F.col("before") + F.col("within")).alias("base")
    )


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Encode ``docs`` and write the blocks to ``path`` (or a new table in the shared folder); returns what was written,
    read back."""
    blocks = encode_blocks(docs, tokenizer_path, **options)
    if path is None:
        return saved(blocks, "tokens", compression="zstd")
    blocks.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def read_documents(blocks: DataFrame) -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32`` of written blocks."""
    rows = decode_blocks(blocks).join(block_starts(blocks), ["shard", "block"])
    return rows.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
