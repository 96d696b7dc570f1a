"""Exact duplicates: local combining, salted digest groups, then one winner of each group, by whole texts at every stage.

Two texts are equal when they are identical after A-Z are put into lower case; a null text counts as empty. The row with
the largest id stays.

1. Every row gets the digest of its normalised text and a row key, and is stored with its text.
2. Digests that at least one in ``1 / HEAVY_SHARE`` rows have are *heavy*. There are at most that many of them, so the list
   is broadcast, whatever the size of the input.
3. Rows are grouped by digest, salt and **text**. Spark combines the rows of each task before the shuffle, so a group that
   holds a third of all rows sends one row per task and salt. Only heavy digests have several salts.
4. The winners of the salts of a heavy digest are grouped once more, by digest and **text**.
5. Rows find the winner of their group by digest, and by digest and **text** where one digest has several texts.

Limits and special rows: ids are whole numbers of 64 bits or less; a null id is smaller than all others. Rows that agree in id
and text are told apart by a hash of all their columns, then by their place in the stored table, so exactly one stays.
Empty tables give no rows. Columns of the input never clash: they travel as one struct.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, saved

#: A digest is heavy from this share of all rows on, but not below LEAST_HEAVY rows.
HEAVY_SHARE = 1e-4
LEAST_HEAVY = 1000
#: Groups into which the rows of a heavy digest are dealt.
SALTS = 32

_TIES = 10**18
_BELOW_ALL = Decimal(-99 * 10**36)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def normalised(text: Column) -> Column:
    """The text that counts for equality."""
    return F.coalesce(ascii_lower(text), F.lit(""))


def _stored(docs: DataFrame, id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """``row``, ``digest``, ``id``, ``rank`` (order of the winners) and the input as one struct, written once."""
    hashed = [F.col(f.name) for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    tie = F.pmod(F.xxhash64(*hashed), F.lit(_TIES)).cast("decimal(18,0)")
    by_id = F.col(id).cast("decimal(19,0)") * F.lit(Decimal(_TIES)).cast("decimal(19,0)")
    rank = (F.coalesce(by_id.cast("decimal(38,0)"), F.lit(_BELOW_ALL).cast("decimal(38,0)")) + tie).cast("decimal(38,0)")
    return saved(docs.select(
        F.monotonically_increasing_id().alias("row"), digest(normalised(F.col(text))).alias("digest"), F.col(id).alias("id"),
        rank.alias("rank"), F.struct("*").alias("input"),
    ), "exact-rows")


def _combined(rows: DataFrame, *keys: str) -> DataFrame:
    """The winner of each group and the number of its rows. All figures are of fixed width, so Spark combines by hash."""
    return rows.groupBy(*keys).agg(
        F.max_by("row", "rank").alias("row"), F.max_by("id", "rank").alias("id"), F.max("rank").alias("rank"), F.sum("n").alias("n")
    )


def _classes(rows: DataFrame, text: str, heavy: DataFrame) -> DataFrame:
    """``digest, row, id, n`` of each different text."""
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("row"), F.lit(SALTS))).otherwise(-1)
    dealt = rows.join(F.broadcast(heavy), "digest", "left").select(
        "digest", salt.alias("salt"), normalised(F.col(f"input.`{text}`")).alias("content"), "row", "id", "rank", F.lit(1).cast("long").alias("n")
    )
    # Only heavy digests are compared again, so only their texts (one per digest and salt) are written.
    merged = saved(
        _combined(dealt, "digest", "salt", "content").withColumn("content", F.when(F.col("salt") >= 0, F.col("content"))), "exact-salted"
    )
    alone = merged.filter("salt < 0").select("digest", "row", "id", "n")
    return alone.unionByName(_combined(merged.filter("salt >= 0"), "digest", "content").select("digest", "row", "id", "n"))


def _labelled(rows: DataFrame, text: str) -> DataFrame:
    """``row, id, digest, keep_row, keep_id, group_size`` of every stored row."""
    least = max(LEAST_HEAVY, int(rows.count() * HEAVY_SHARE))
    heavy = saved(
        rows.groupBy("digest").count().filter(F.col("count") >= least).select("digest", F.lit(True).alias("heavy")), "exact-heavy"
    )
    classes = saved(_classes(rows, text, heavy), "exact-classes")
    found = classes.select(
        "digest", F.col("row").alias("keep_row"), F.col("id").alias("keep_id"), F.col("n").alias("group_size")
    )
    narrow = rows.select("row", "id", "digest")
    shared = saved(classes.groupBy("digest").count().filter("count > 1").select("digest"), "exact-shared")
    clash = not shared.isEmpty()
    if clash:
        narrow, found = narrow.join(shared, "digest", "left_anti"), found.join(shared, "digest", "left_anti")
    # A heavy digest has one class here, so its classes are as few as the heavy digests.
    hot = F.broadcast(found.join(F.broadcast(heavy.select("digest")), "digest"))
    rest = narrow.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    out = rest.join(found, "digest").unionByName(narrow.join(hot, "digest"))
    if clash:
        content = normalised(F.col(f"input.`{text}`")).alias("content")
        mixed = rows.select("row", "id", "digest", "rank", content, F.lit(1).cast("long").alias("n")).join(shared, "digest", "left_semi")
        winners = _combined(mixed, "digest", "content").select(
            "digest", "content", F.col("row").alias("keep_row"), F.col("id").alias("keep_id"), F.col("n").alias("group_size")
        )
        out = out.unionByName(mixed.select("row", "id", "digest", "content").join(winners, ["digest", "content"]).drop("content"))
    return out


def duplicate_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, digest``. ``digest`` only spreads the rows: two texts of one
    digest are still compared whole."""
    found = _labelled(_stored(docs.select(id, text), id, text, digest), text)
    return found.select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")


def drop_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of the input."""
    rows = _stored(docs, id, text, digest)
    stay = _labelled(rows, text).filter("row = keep_row").select("row")
    return rows.join(stay, "row", "left_semi").select("input.*")
