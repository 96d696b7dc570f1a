"""Mixing sources to target weights by Sainte-Laguë apportionment.

Each source has a token target. The whole is cut into blocks of equal token counts; blocks go to sources by highest
quotients ``target / (2 n + 1)``, then within a source to its shards, again by highest quotients, which gives integer
quotas. A shard strings its documents together in a seeded order and takes its quota of blocks in a seeded order, a block
again only when all have been taken.

Defined results: null and empty texts have size 0 and are never taken; a null source is one source, the last; repeated
rows are documents of their own; an empty table gives an empty mix. Other columns pass through untouched; those added
are ``size, source_size, target, taken, ranges`` and replace columns of the same name.
"""

from __future__ import annotations

import heapq
import re
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import SPACE, free_name, n_words, saved, values

SEED = 8
WEIGHTS = (5, 2, 1)
#: No source or document is taken more often than this.
REPEATS = 3
#: Words of a block, at most, and of a shard, about. A shard is what one task handles at a time.
BLOCK, SHARD = 256, 1_000_000
#: The sources themselves are a list that the driver holds; more than this is refused.
MAX_SOURCES = 1_000_000
ADDED = ("size", "source_size", "target", "taken", "ranges")


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Shares of the whole by weight, none above ``repeats`` times its source's size: the excess is shared out again by
    weight among the others until none is above."""
    out = [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] > repeats * sizes[i] * total]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in over)
        open_.difference_update(over)
    return out


def sainte_lague(shares: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients ``share / (2 n + 1)``; ties go to the earlier entry; none above its limit.

    A divisor found by bisection gives the seats that the quotients surely grant, the quotients themselves the few that
    are left, so the work does not grow with the number of seats.
    """
    share = np.array(shares, float)
    limit = np.full(len(share), np.inf) if most is None else np.array(most, float)
    if seats <= 0 or not len(share) or share.sum() <= 0:
        return [0] * len(shares)
    seats = int(min(seats, np.where(share > 0, limit, 0).sum()))
    won = lambda d: np.minimum(limit, np.floor(share / d + 0.5))
    low, high = 0.0, 2.0 * share.max() + 1.0  # at high nobody has a seat
    for _ in range(100):
        middle = (low + high) / 2
        if middle <= 0 or won(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = won(high).astype(np.int64)
    left = seats - int(out.sum())
    queue = [(-s / (2 * n + 1), i) for i, (s, n, m) in enumerate(zip(share, out, limit)) if s > 0 and n < m] if left else []
    heapq.heapify(queue)
    for _ in range(left):
        _, i = queue[0]
        out[i] += 1
        if out[i] < limit[i]:
            heapq.heapreplace(queue, (-share[i] / (2 * out[i] + 1), i))
        else:
            heapq.heappop(queue)
    return out.tolist()


def _block_ranges(sizes: np.ndarray, want: int, block: int, seed: list[int]) -> list[list[list[int]]]:
    """Taken word ranges ``[from, to)`` of each document of a shard, in the shard's order. Rounds over everything first,
    then blocks in a seeded order; the block at the end of the string and the last one taken may be shorter."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    out: list[list[list[int]]] = [[] for _ in sizes]
    if not total or want <= 0:
        return out
    rounds, rest = divmod(want, total)
    for own, n in zip(out, sizes.tolist()):
        if n:
            own += [[0, n]] * rounds
    if rest:
        cuts = np.arange(0, total, block)
        order = np.random.default_rng(seed).permutation(len(cuts))
        stop = np.minimum(cuts + block, total)
        upto = np.cumsum((stop - cuts)[order])
        n = int(np.searchsorted(upto, rest, "left")) + 1
        stop[order[n - 1]] -= int(upto[n - 1]) - rest
        chosen = np.sort(order[:n])
        # Blocks that touch are one stretch, which then is cut where documents end.
        a, z = cuts[chosen], stop[chosen]
        new = np.append(True, a[1:] != z[:-1])
        a, z = a[new], z[np.append(np.nonzero(new)[0][1:] - 1, len(z) - 1)]
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(ends, z, "left")
        for lo, hi, d, e in zip(a.tolist(), z.tolist(), first.tolist(), last.tolist()):
            for k in range(d, e + 1):
                begin = int(ends[k] - sizes[k])
                if (f := max(lo, begin)) < (t := min(hi, int(ends[k]))):
                    out[k].append([f - begin, t - begin])
    return out


_WORD = re.compile(f"[^{SPACE}]+")


def _cut(text: str | None, ranges: list[list[int]]) -> list[str]:
    """The text of each range of words; a range over all of them is the text as it is."""
    if not ranges:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    return [text if (a, z) == (0, len(spans)) else text[spans[a][0] : spans[z - 1][1]] for a, z in ranges]


def apportion(sources: list[tuple[str | None, int]], weights=WEIGHTS, repeats: int = REPEATS, block: int = BLOCK):
    """``(block, [(source, size, target, blocks)])`` for sources in their order. A source whose target is the limit of
    repeats takes everything that often; the blocks of the others go by highest quotients."""
    sizes = [n for _, n in sources]
    wanted = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(sizes))], repeats)
    full = [t >= repeats * n for n, t in zip(sizes, wanted)]
    open_ = [t for t, f in zip(wanted, full) if not f]
    # A block is at most a hundredth of a target, so that every source comes near its own.
    block = max(1, min([block, *(int(t) // 100 for t in open_)]))
    seats = iter(sainte_lague(open_, round(sum(open_) / block)))
    blocks = [-(-repeats * n // block) if f else next(seats) for n, f in zip(sizes, full)]
    return block, [(s, n, t, q, f) for (s, n), t, q, f in zip(sources, wanted, blocks, full)]


def mix(docs: DataFrame, size: Column | None = None, source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS,
        repeats: int = REPEATS, seed: int = SEED, block: int = BLOCK, shard: int = SHARD, cut: str | None = None) -> DataFrame:
    """All rows with what the mix takes of them: ``size`` (words of ``text``, or what is given), ``source_size``,
    ``target`` (of the source), ``taken`` (words, repeats counted) and ``ranges`` (word ranges taken). With ``cut``, the
    name of the text column, a row for each range taken instead, its text cut to the range; whole documents keep theirs."""
    rows = docs.withColumn("size", F.coalesce(n_words("text") if size is None else size, F.lit(0)).cast("long"))
    rows = rows.drop(*ADDED[1:])
    # The place of a document in the seeded order. Rows alike in id and size are told apart by all their columns; rows alike
    # in those too are interchangeable.
    told = [F.col(f.name) for f in rows.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    place = {"order": F.xxhash64(F.lit(seed), F.col(doc_id), F.col("size")), "tie": F.xxhash64(F.lit(seed + 1), *told)}
    named = [c.alias(n) for n, c in place.items()]
    # What the plan needs of a document; texts are read once more, when the blocks are taken.
    slim = saved(rows.select(F.col(source).alias("source"), "size", *named), "mix-sizes")
    found = slim.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # By code point, which is the byte order of UTF-8.
    listed = sorted(((r[0], int(r[1])) for r in found), key=lambda x: (x[0] is None, str(x[0] or "").encode()))
    block, plan = apportion(listed, weights, repeats, block)
    schema = T.StructType([
        T.StructField("source", slim.schema["source"].dataType), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()), T.StructField("blocks", T.LongType()), T.StructField("full", T.BooleanType()),
        T.StructField("shards", T.IntegerType()), T.StructField("rank", T.IntegerType()),
    ])
    table = docs.sparkSession.createDataFrame(
        [(s, n, t, q, f, max(1, -(-n // shard)), i) for i, (s, n, t, q, f) in enumerate(plan)], schema
    )
    # Helper columns are in one struct, under a name that the input does not have.
    own = free_name(rows, "mix")

    def placed(df: DataFrame, by: str, own: str, spot: Column) -> DataFrame:
        # One row per source; Spark broadcasts it as long as it is small.
        joined = df.join(table.select(F.struct("*").alias(own)), df[by].eqNullSafe(F.col(f"{own}.source")))
        return joined.withColumn(own, F.col(own).withField("shard", F.pmod(spot, F.col(f"{own}.shards")).cast("int")))

    shards = placed(slim, "source", "mix", F.xxhash64("order", "tie")).groupBy("mix.rank", "mix.shard", "mix.blocks", "mix.full").agg(F.sum("size").alias("n"))

    def quotas(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        sizes, full = shards["n"].tolist(), bool(shards["full"].iloc[0])
        limit = [-(-repeats * n // block) for n in sizes]
        won = limit if full else sainte_lague(sizes, int(shards["blocks"].iloc[0]), limit)
        want = [min(q * block, repeats * n) for q, n in zip(won, sizes)]
        return pd.DataFrame({"rank": shards["rank"], "shard": shards["shard"], "want": want})

    # A task has the shards of a source: one small row for each SHARD words.
    wants = saved(shards.groupBy("rank").applyInPandas(quotas, "rank int, shard int, want long"), "mix-quotas")
    wants = wants.select(F.struct("*").alias(free_name(rows, "want")))
    want = F.col(wants.columns[0])
    ready = placed(rows, source, own, F.xxhash64(*place.values()))
    ready = ready.join(wants, (ready[own]["rank"] == want["rank"]) & (ready[own]["shard"] == want["shard"]))
    names = [*rows.columns, "source_size", "target"]
    ready = ready.select(
        *rows.columns, F.col(f"{own}.source_size").alias("source_size"), F.col(f"{own}.target").alias("target"),
        F.struct(*named, want["want"].alias("want"), F.col(f"{own}.rank").alias("rank"), F.col(f"{own}.shard").alias("shard")).alias(own),
    )
    out = T.StructType([
        *(ready.schema[c] for c in names), T.StructField("taken", T.LongType()),
        T.StructField("ranges", T.ArrayType(T.ArrayType(T.LongType()))),
    ])

    def take(shard: pa.Table) -> pa.Table:
        order, tie, wanted, rank, no = shard[own].combine_chunks().flatten()
        shard = shard.take(np.lexsort((tie.to_numpy(), order.to_numpy())))
        chosen = _block_ranges(shard["size"].to_numpy(), wanted[0].as_py(), block, [seed, rank[0].as_py(), no[0].as_py()])
        taken = pa.array([sum(z - a for a, z in r) for r in chosen], pa.int64())
        ranges = pa.array(chosen, pa.list_(pa.list_(pa.int64())))
        out = shard.select(names).append_column("taken", taken).append_column("ranges", ranges)
        if cut is None:
            return out
        texts = [x for t, own in zip(values(shard[cut]), chosen) for x in _cut(t, own)]
        rows = out.take(pa.array([i for i, own in enumerate(chosen) for _ in own], pa.int64()))
        return rows.set_column(names.index(cut), cut, pa.array(texts, pa.string()))

    return ready.groupBy(F.col(own)["rank"], F.col(own)["shard"]).applyInArrow(take, out)
