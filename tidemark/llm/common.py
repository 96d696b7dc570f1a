"""Helpers that the operators share: words, scratch tables in the shared folder, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters between words, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def words(text: Column | str) -> Column:
    """Words of a text as an array; empty for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(col, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def n_words(text: Column | str) -> Column:
    """Number of words without building them: what is left between runs of white space."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines see, ``spark.checkpoint.dir``. Where it is unset, a session within one process gets
    a folder of its own; a cluster session is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
        found = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def saved(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)



def values(column, kind=None, step: int = 256):
    """The values of an Arrow column as Python objects, a slice at a time: a whole batch of texts is never held twice."""
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        yield from (part.cast(kind) if kind is not None else part).to_pylist()


def fold_of(doc_id: Column | str, of: int) -> Column:
    """The fold of a document among ``of``: the checksum of its id as text."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")) % of


def training_labels(labels: DataFrame, label: str, fold: int, of: int, most: int) -> DataFrame:
    """``(doc_id, label)`` of labelled rows outside the held-out fold: all of them, or the ``most`` with the smallest
    hash. At most ``most`` small rows, so it may be broadcast."""
    rows = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of("doc_id", of) != fold))
    picked = rows.select("doc_id", label).orderBy(F.xxhash64("doc_id", F.lit(of)), "doc_id", label).limit(most)
    return F.broadcast(picked)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``links``: the smallest node that can be reached.

    Large-star and small-star steps in turn (both are an aggregate and a join, so a hub is split by adaptive
    execution); each round is written to the shared folder. Ends when a round changes nothing.
    """
    edges = saved(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").select(F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
            )).alias("e")).select("e.*").filter("u <> v").distinct()
        )
        edges = saved(small, "edges")
        # An order-free digest of the edges; it repeats only when they do.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is. ``lower`` does just that to a text of ASCII
    characters only, and is quicker than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``df`` as the named columns and one struct ``input`` with all others, so that no helper column can clash with them; and
    the columns that give ``df`` back."""
    others = [c for c in df.columns if c not in names]
    held = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(True).alias("none"))
    back = [F.col(f"`{c}`") if c in names else F.col("input").getField(c).alias(c) for c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in names], held.alias("input")), back


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row that can be hashed, to tell rows apart that are alike in id and text."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))])
