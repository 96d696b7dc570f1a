"""Merkle manifest of a dataset: a tree over the rows of each source and one over the sources, with a proof for every row.

The tree is built by a *slot pivot*: the ``FANOUT`` consecutive nodes of a parent become its columns ``c0`` to ``c15`` by
conditional aggregates over (group, position div fanout). Concatenating the columns and hashing gives the parent; leaving out
a node's own column gives its siblings. Spark combines the slots of a task before the shuffle, so a level of n nodes sends
about n / 16 rows.

Positions come from a range sort by (source, id, leaf): rows are numbered within each sorted partition, and the counts of the
partitions of a source (as many rows as partitions and sources) are added up by a window. No task sees a whole source.

Proofs go down the tree: each parent hands its children the parts left and right of them, in front of its own path. A path has
two strings of at most 15 digests per level; only parents carry one through a shuffle, never the rows.

Special rows: null ids come first within a source, the null source comes first among sources. Rows with one id are ordered by
their leaf; equal leaves are interchangeable. A source with one row has that leaf as its root, a dataset with one source has that
source's root as its root; a row alone in the dataset has an empty path. Empty tables give no rows. Carried columns travel in
one struct, so their names don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import saved

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """The leaf of a row: each value as its length in bytes, a colon and itself; ``-`` for null."""
    text = [v.cast("string") for v in values]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text])


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda node, x: digest(x["left"], node, x["right"]))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, left to right, in one string."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def _numbered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` (``tree``, ``hash``, ``load``) with ``pos`` in its tree, from 0, and ``total``, the nodes of the tree."""
    laid = saved(
        nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id()), name
    )
    part = F.shiftright("at", 33)
    of = Window.partitionBy("tree")
    parts = laid.groupBy("tree", part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first")).select(
        "tree", "part", F.sum("n").over(of).alias("total"),
        (F.sum("n").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n") - F.col("first")).alias("shift"),
    )
    placed = laid.withColumn("part", part).join(parts, ["tree", "part"])
    return placed.select("tree", (F.col("at") + F.col("shift")).alias("pos"), "total", "hash", "load")


def _levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The levels of all trees, from the leaves up, each stored: ``tree, pos, total, hash`` and, above the leaves, ``c0`` to
    ``c15``. A tree ends at the level where ``total`` is 1."""
    levels = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    slots = [f"c{i}" for i in range(FANOUT)]
    whole = ", ".join(f"coalesce({c}.hash, '')" for c in slots)
    while most > 1:
        below = levels[-1].filter("total > 1")
        node = "struct(hash, load)" if "load" in below.columns else "struct(hash)"
        up = below.groupBy("tree", F.expr(f"pos div {FANOUT}").alias("pos")).agg(
            F.max(F.ceil(F.col("total") / FANOUT)).alias("total"),
            *[F.expr(f"first(CASE WHEN pos % {FANOUT} = {i} THEN {node} END, true) AS {c}") for i, c in enumerate(slots)],
        )
        levels.append(saved(up.withColumn("hash", F.expr(f"sha2(concat({whole}), 256)")), f"{name}-{len(levels)}"))
        most = -(-most // FANOUT)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``tree, hash, level`` of the root of each tree."""
    return reduce(DataFrame.unionByName, [x.filter("total = 1").select("tree", "hash", F.lit(k).alias("level")) for k, x in enumerate(levels)])


def _paths(levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """``tree, hash, load, path, above`` of every leaf. ``starts`` has ``tree, level, path, above`` for each root: where it is, its
    path beyond the tree, and what all its leaves get."""
    here = None
    for k in range(len(levels) - 1, -1, -1):
        entering = starts.filter(F.col("level") == k).select("tree", F.lit(0).cast("long").alias("pos"), "path", "above")
        here = entering if here is None else here.select("tree", "pos", "path", "above").unionByName(entering)
        if k == 0:
            # Leaves that are roots; all others have come down from level 1 with their slot.
            alone = levels[0].filter("total = 1").join(entering, ["tree", "pos"]).select("tree", "hash", "load", "path", "above")
            return alone if len(levels) == 1 else alone.unionByName(below.select("tree", "hash", "load", "path", "above"))
        hashes = [f"coalesce(c{i}.hash, '')" for i in range(FANOUT)]
        beside = lambda part: f"concat({', '.join(part)})" if part else "''"
        children = F.expr("array(" + ", ".join(
            f"CASE WHEN c{i} IS NOT NULL THEN struct(pos * {FANOUT} + {i} AS pos, c{i} AS node, "
            f"struct({beside(hashes[:i])} AS left, {beside(hashes[i + 1:])} AS right) AS step) END" for i in range(FANOUT)
        ) + ")")
        down = levels[k].join(here, ["tree", "pos"]).select("tree", "path", "above", F.explode(F.filter(children, lambda c: c.isNotNull())).alias("c"))
        below = down.select(
            "tree", F.col("c.pos").alias("pos"), F.concat(F.array("c.step"), "path").alias("path"), "above",
            *([F.col("c.node.hash").alias("hash"), F.col("c.node.load").alias("load")] if k == 1 else []),
        )
        here = below


def prove(leaves: DataFrame, source: str = "source", id: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """One row per row of ``leaves``: ``leaf``, ``subroot`` of its source, ``root``, ``path`` (steps of ``left`` and ``right``, from the
    leaf up) and ``load``, a struct of all columns of ``leaves``."""
    tree = F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    nodes = leaves.select(tree.alias("tree"), F.col(leaf).alias("hash"), F.col(id).alias("id"), F.struct("*").alias("load"))
    rows = _levels(saved(_numbered(nodes, ["id", "hash"], "merkle-rows"), "merkle-0"), "merkle")
    tops = saved(_tops(rows), "merkle-subroots")
    sources = _numbered(
        tops.select(F.lit(0).alias("tree"), "hash", F.col("tree").alias("name"), F.struct("tree", "level").alias("load")), ["name"], "merkle-sources"
    )
    upper = _levels(saved(sources, "merkle-top-0"), "merkle-top")
    whole = _tops(upper)
    starts = whole.select(
        "tree", "level", F.expr("CAST(array() AS array<struct<left:string,right:string>>)").alias("path"), F.struct(F.col("hash").alias("root")).alias("above")
    )
    of_sources = saved(_paths(upper, starts).select(
        F.col("load.tree").alias("tree"), F.col("load.level").alias("level"), "path",
        F.struct("above.root", F.col("hash").alias("subroot")).alias("above"),
    ), "merkle-source-paths")
    return _paths(rows, of_sources).select(F.col("hash").alias("leaf"), "above.subroot", "above.root", "path", "load")
