"""Hard negatives: exact integer inner products of anchors with all rows, by Kronecker-packed products.

A component becomes ``floor(256 * x)``, so scores are whole numbers. For a block of candidates, the components of several
candidates are made non-negative by a bias and laid side by side in one wide integer, in fields that no sum can outgrow. An
anchor then needs one multiplication per component for all of them; the fields of the sum are the products with every
candidate, and the bias is taken off again:

    sum((a - a0) * (c - c0)) = field,   sum(a * c) = field + a0 * sum(c) + c0 * sum(a) - d * a0 * c0

Where a field needs at most 26 bits, the wide integers have 53 bits and are held in doubles, which are exact to 53 bits, so the
products of a block are one matrix product. Otherwise they are integers of Python, as wide as a block of candidates.

Anchors and candidates are dealt into blocks of bounded size, each pair of blocks is one task-sized piece, and each piece returns
its best few rows per anchor; a window keeps the best of all pieces. A first pass finds the positives, a second the negatives in the
score range that each positive gives. All rows are compared with all anchors; nothing is left out.

Rows with a null label, a null vector or a null or non-finite component take no part. A row without an id may be a positive or a
negative and comes last among ties. Vectors of different lengths are compared as if the shorter ended in zeros. Repeated rows stand
for themselves; an anchor is never its own positive, but an equal row may be. Components outside the range of a long count as its
nearest end, and so do scores in the result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import saved

#: Rows of a block of candidates and of a block of anchors; anchors whose scores are held at once.
CANDIDATES = 8192
ANCHORS = 4096
SLICE = 128

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score that a negative's score may have.
LOW, HIGH = 30, 90

_LONG = 2**63 - 1


# ---- packed products ------------------------------------------------------------------------------------------


def packed_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products, anchors by candidates, of two arrays of whole numbers with rows of one length."""
    (k, d), m = anchors.shape, len(candidates)
    if not k or not m or not d:
        return np.zeros((k, m), np.int64)
    a0, c0 = int(anchors.min()), int(candidates.min())
    width = (d * (int(anchors.max()) - a0) * (int(candidates.max()) - c0)).bit_length() or 1
    # The bias is taken off in longs only where no product comes near their end.
    if width <= 26 and max(abs(a0), abs(c0)) < 2**26:
        fields = _in_doubles(anchors - a0, candidates - c0, width)
        return fields + a0 * candidates.sum(1)[None, :] + c0 * anchors.sum(1)[:, None] - d * a0 * c0
    fields = _in_integers(anchors.astype(object) - a0, candidates.astype(object) - c0, width)
    out = fields + a0 * candidates.astype(object).sum(1)[None, :] + c0 * anchors.astype(object).sum(1)[:, None] - d * a0 * c0
    return out.astype(np.int64) if max(abs(int(out.min())), abs(int(out.max()))) < 2**48 else out


def _in_doubles(a: np.ndarray, c: np.ndarray, width: int) -> np.ndarray:
    """Fields of ``width`` bits in integers of 53 bits."""
    per = 53 // width
    m = len(c)
    words = -(-m // per)
    held = np.zeros((words * per, c.shape[1]), np.int64)
    held[:m] = c
    # Field f of the words holds the f-th stretch of candidates.
    packed = sum(held[f * words:(f + 1) * words] << (f * width) for f in range(per))
    products = (a.astype(np.float64) @ packed.astype(np.float64).T).astype(np.int64)
    mask = (1 << width) - 1
    return np.concatenate([(products >> (f * width)) & mask for f in range(per)], axis=1)[:, :m]


def _in_integers(a: np.ndarray, c: np.ndarray, width: int) -> np.ndarray:
    """Fields of whole bytes in one integer per component, as wide as all candidates together."""
    size, m = -(-width // 8), len(c)
    packed = [int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in column), "little") for column in c.T]
    out = np.empty((len(a), m), object)
    for i, row in enumerate(a):
        found = sum(int(x) * p for x, p in zip(row, packed) if x).to_bytes(size * m, "little")
        out[i] = [int.from_bytes(found[j:j + size], "little") for j in range(0, size * m, size)]
    return out


def _best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` highest scores among the places given; the first ones where scores are equal."""
    if scores.dtype == object:
        return np.array(sorted(among.tolist(), key=lambda j: (-scores[j], j))[:k], np.int64)
    s = scores[among]
    if len(s) > k:
        least = np.partition(s, len(s) - k)[len(s) - k]
        among, s = among[s >= least], s[s >= least]
    return among[np.argsort(-s, kind="stable")[:k]]


# ---- blocks in a task -------------------------------------------------------------------------------------------


def _vectors(column: pa.ChunkedArray, d: int) -> np.ndarray:
    array = column.combine_chunks()
    lengths = array.value_lengths().to_numpy()
    flat = array.flatten().to_numpy()
    if len(lengths) and (lengths == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(lengths), d), np.int64)
    out[np.arange(d)[None, :] < lengths[:, None]] = flat
    return out


def _blocks(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Place of an anchor and its scores with ``rows``, a slice of anchors at a time."""
    d = max(max(t["vector"].combine_chunks().value_lengths().to_numpy(), default=0) for t in (anchors, rows))
    held, among = _vectors(anchors["vector"], d), _vectors(rows["vector"], d)
    for at in range(0, len(held), SLICE):
        for i, scores in enumerate(packed_scores(held[at:at + SLICE], among)):
            yield at + i, scores


def _in_order(rows: pa.Table) -> pa.Table:
    """Rows by id, those without one last, so that the place breaks ties."""
    return rows.sort_by([("id", "ascending"), ("row", "ascending")])


_SCORED = "anchor long, anchor_id long, row long, id long, score decimal(38,0)"


def _nearest(left: pa.Table, right: pa.Table) -> pa.Table:
    """The best rows of the label of each anchor in this pair of blocks."""
    out = {k: [] for k in ("anchor", "anchor_id", "row", "id", "score")}
    if left.num_rows and right.num_rows:
        rows = _in_order(right)
        label, key, ids = rows["label"].to_numpy(), rows["row"].to_numpy(), rows["id"].to_pylist()
        own, own_row, own_id = left["label"].to_pylist(), left["row"].to_pylist(), left["id"].to_pylist()
        for i, scores in _blocks(left, rows):
            for j in _best(scores, np.flatnonzero((label == own[i]) & (key != own_row[i])), POSITIVES):
                for k, v in zip(out, (own_row[i], own_id[i], int(key[j]), ids[j], _decimal(scores[j]))):
                    out[k].append(v)
    return _table(out, ("anchor", "anchor_id", "row", "id"), ("score",))


def _hardest(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each anchor and positive, the best rows of other labels in the positive's range, in this pair of blocks."""
    out = {k: [] for k in ("anchor", "anchor_id", "positive", "positive_id", "positive_score", "row", "id", "score")}
    if left.num_rows and right.num_rows:
        rows = _in_order(right)
        label, key, ids = rows["label"].to_numpy(), rows["row"].to_numpy(), rows["id"].to_pylist()
        own, own_row, own_id, near = (left[c].to_pylist() for c in ("label", "row", "id", "positives"))
        for i, scores in _blocks(left, rows):
            other = np.flatnonzero(label != own[i])
            s = scores[other]
            for p in near[i]:
                top = int(p["score"])
                lowest, highest = -((-LOW * top) // 100), HIGH * top // 100
                if lowest > highest:
                    continue
                if s.dtype != object:  # within the range of such scores
                    lowest, highest = max(lowest, -(2**62)), min(highest, 2**62)
                for j in _best(scores, other[((s >= lowest) & (s <= highest)).astype(bool)], NEGATIVES):
                    for k, v in zip(out, (own_row[i], own_id[i], p["row"], p["id"], _decimal(top), int(key[j]), ids[j], _decimal(scores[j]))):
                        out[k].append(v)
    return _table(out, ("anchor", "anchor_id", "positive", "positive_id", "row", "id"), ("positive_score", "score"))


def _decimal(score: int) -> int:
    """Scores travel as decimals of 38 digits: the product of two vectors of longs has more only beyond 10^38."""
    return max(-(10**38) + 1, min(10**38 - 1, int(score)))


def _table(out: dict[str, list], longs: tuple[str, ...], decimals: tuple[str, ...]) -> pa.Table:
    exact = Context(prec=40)
    kinds = dict.fromkeys(longs, pa.int64()) | dict.fromkeys(decimals, pa.decimal128(38, 0))
    return pa.table({k: pa.array([exact.create_decimal(Decimal(x)) for x in v] if k in decimals else v, kinds[k]) for k, v in out.items()})


# ---- the operator ---------------------------------------------------------------------------------------------


def scaled(vector: Column) -> Column:
    """Components as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _usable(vector: Column, label: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return label.isNotNull() & vector.isNotNull() & whole


def _pairs(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, task, schema: str) -> DataFrame:
    """``task`` on every pair of a block of anchors and a block of rows."""
    across, down = max(1, -(-n_rows // CANDIDATES)), max(1, -(-n_anchors // ANCHORS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = anchors.withColumn("down", block(down)).withColumn("across", every(across))
    right = rows.select(*[F.col(c).alias(c) for c in rows.columns], block(across).alias("across"), every(down).alias("down"))
    return left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(task, schema)


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str | Column = "label"
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchor`` holds."""
    label = F.col(label) if isinstance(label, str) else label
    held = saved(rows.filter(_usable(F.col(vector), label)).select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"), label.cast("long").alias("label"),
        scaled(F.col(vector)).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ), "negatives")
    anchors, among = held.filter("is_anchor").drop("is_anchor"), held.drop("is_anchor")
    n_anchors, n_rows = anchors.count(), held.count()
    near = _first(_pairs(anchors, among, n_anchors, n_rows, _nearest, _SCORED), POSITIVES, "anchor")
    near = near.groupBy("anchor").agg(F.collect_list(F.struct("row", "id", "score")).alias("positives"))  # 5 at most
    ready = saved(anchors.join(near, anchors["row"] == near["anchor"]).drop("anchor"), "negatives-positives")
    schema = "anchor long, anchor_id long, positive long, positive_id long, positive_score decimal(38,0), row long, id long, score decimal(38,0)"
    found = _first(_pairs(ready, among, n_anchors, n_rows, _hardest, schema), NEGATIVES, "anchor", "positive")
    as_long = lambda c: F.least(F.greatest(F.col(c), F.lit(-_LONG - 1)), F.lit(_LONG)).cast("long").alias
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        as_long("positive_score")("positive_score"), as_long("score")("negative_score"),
    )
