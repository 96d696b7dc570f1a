"""SimHash fingerprints of documents and the groups that near-equal fingerprints form.

Defined results: a null or empty text has fingerprint 0 and is linked like any other; repeated rows share a group; an
empty table gives an empty result; a null ``doc_id`` never names a group that holds another id. Other columns pass
through untouched and may have any name but the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import components, free_name, row_hash, saved, values

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fingerprints of one bucket compared in one task; larger buckets are cut into tiles of pairs.
TILE = 2048
#: Rows gathered before a task compares what it has.
GATHER = 1 << 20
#: Words of 64 lanes per block; a block is left as soon as all its lanes are beyond the radius.
BLOCK = 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of word shingles, repeats counted: a bit is 1 if set in over half of the hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(flat[s:e], seed) for s, e in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for i in range(0, len(raw), 65536):
        total += np.unpackbits(raw[i : i + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: Column | str) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t) for t in values(texts, pa.binary())]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return run(text)


def hex64(fp: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _bucket_keys(fp: Column, fingerprints: int, radius: int) -> Column:
    """Bucket keys such that two fingerprints within the radius share at least one.

    ``radius + 1`` blocks: one of them is equal. With many fingerprints such blocks hold too many by chance; then
    ``2 * radius`` blocks, of which ``radius`` are equal, in every choice. Both are exact.
    """
    from itertools import combinations

    cuts, same = (radius + 1, 1) if fingerprints < 1 << 22 else (2 * radius, radius)
    edges = [64 * i // cuts for i in range(cuts + 1)]
    tables = []
    for no, chosen in enumerate(combinations(range(cuts), same)):
        mask = sum(((1 << (edges[c + 1] - edges[c])) - 1) << edges[c] for c in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        tables.append(F.struct(F.lit(no).alias("table"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*tables)


def _planes(fps: np.ndarray) -> np.ndarray:
    """64 bit planes over the fingerprints, 64 lanes to a word, with one spare word for shifts."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.zeros((64, (len(fps) + 63) // 64 * 64 + 64), np.uint8)
    lanes[:, : len(fps)] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view("<u8")


def near_lanes(planes: np.ndarray, shift: int, lanes: int, radius: int) -> np.ndarray:
    """Lanes ``i`` below ``lanes`` whose fingerprint differs from that of lane ``i + shift`` in at most ``radius`` bits.

    A carry-save counter of few planes adds one bit plane of the differences at a time for all lanes at once. It starts
    so high that it overflows just beyond the radius; blocks in which all lanes have overflowed are left.
    """
    width = (lanes + 63) // 64
    step, bit = divmod(shift, 64)
    size = max(1, radius.bit_length())
    start = (1 << size) - 1 - radius
    block = np.arange(width, dtype=np.int64)
    counter = [np.full(width, 0xFFFFFFFFFFFFFFFF if start >> k & 1 else 0, np.uint64) for k in range(size)]
    over = np.zeros(width, np.uint64)
    low, high = np.uint64(bit), np.uint64(64 - bit)
    for p in range(64):
        plane = planes[p]
        moved = plane[np.minimum(block + step, len(plane) - 1)]
        if bit:
            moved = (moved >> low) | (plane[np.minimum(block + step + 1, len(plane) - 1)] << high)
        carry = plane[block] ^ moved
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if p % 8 == 7 and len(block):
            full = np.bitwise_and.reduceat(over, np.arange(0, len(over), BLOCK)) == 0xFFFFFFFFFFFFFFFF
            if full.any():
                stay = ~np.repeat(full, BLOCK)[: len(block)]
                block, over, counter = block[stay], over[stay], [c[stay] for c in counter]
    hits = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(hits)
    found = block[word] * 64 + lane
    return found[found < lanes]


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking ``i`` and ``j``: the smallest index that is reached."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j = i[differ], j[differ]
        np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while not np.array_equal(label, higher := label[label]):
            label = higher


def bucket_links(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the radius inside each group: for each fingerprint that is not the first
    of its part, that first one. ``group`` numbers the buckets; all rows of a bucket are given together."""
    _, number, size = np.unique(group, return_inverse=True, return_counts=True)
    # Large groups first: the lanes that still have a partner at a shift are then the leading ones.
    order = np.lexsort((number, -size[number]))
    number, fps = number[order], fps[order]
    reach = size[number]
    label = np.arange(len(fps))
    planes = _planes(fps)
    for shift in range(1, int(size.max(initial=0))):
        lanes = int(np.searchsorted(-reach, -shift, "left")) - shift  # rows in groups larger than the shift
        if lanes <= 0:
            break
        i = near_lanes(planes, shift, lanes, radius)
        i = i[number[i] == number[i + shift]]
        if len(i):
            label = _join(label, i, i + shift)
    rest = np.nonzero(label != np.arange(len(label)))[0]
    return fps[rest], fps[label[rest]]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(a, b)``: links between different fingerprints of the column ``fp`` whose connected components are those of all
    pairs within the radius. No pair is lost: fingerprints meet in a bucket if they are within the radius, buckets of
    more than ``tile`` rows are compared tile by tile."""
    fps = fps.filter("fp is not null").select("fp").distinct()
    count = fps.count()
    rows = fps.select("fp", F.explode(_bucket_keys(F.col("fp"), count, radius)).alias("k")).select("k.*", "fp")
    large = rows.groupBy("table", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
    cut = large.select("table", "bits", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, mine), F.greatest(o, mine))
    )
    placed = (
        rows.join(cut, ["table", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("t", F.explode(tiles)).select(F.xxhash64("table", "bits", "t").alias("g"), "fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(last: bool):
            g = np.concatenate([x[0] for x in kept])
            f = np.concatenate([x[1] for x in kept])
            # The group at the end may go on in the next batch.
            at = len(g) if last else int(np.searchsorted(g, g[-1]))
            kept[:] = [] if last else [(g[at:], f[at:])]
            a, b = bucket_links(g[:at], f[:at].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                kept.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
                if sum(len(x[0]) for x in kept) >= GATHER:
                    yield flush(False)
        if kept:
            yield flush(True)

    return placed.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "a long, b long")


def near_duplicate_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs(doc_id, fp)`` with ``component_id``, the smallest document id that can be reached by links between
    fingerprints (null when all ids of the group are null)."""
    ids = saved(docs.select("doc_id", "fp"), "simhash")
    first = ids.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    part = components(saved(links(ids, radius), "simhash-links"))
    rooted = first.join(part.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return ids.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each group stays: the smallest ``doc_id`` (null last), among its rows the smallest hash of all columns. The
    columns are those of the input."""
    hashed = docs.select("*", row_hash(docs).alias(free_name(docs, "row_hash")))
    own = hashed.columns[-1]
    ids = saved(hashed.select("doc_id", simhash(text).alias("fp"), F.col(own).alias("row_hash")), "simhash-keys")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_hash"))
    first = ids.groupBy("fp").agg(F.min(order).alias("first"))
    part = components(saved(links(ids, radius), "simhash-links"))
    rooted = first.join(part.withColumnRenamed("node", "fp"), "fp", "left")
    best = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    keep = best.select(F.struct(F.col("first.doc_id").alias("id"), F.col("first.row_hash").alias("hash")).alias(free_name(hashed, "keep")))
    k = F.col(keep.columns[0])
    left = hashed.join(keep, hashed["doc_id"].eqNullSafe(k["id"]) & (hashed[own] == k["hash"]), "left_semi")
    # Repeats of the row that stays are equal in every column.
    return left.dropDuplicates(["doc_id", own]).drop(own)
