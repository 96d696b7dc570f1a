"""A table with one current row per key: a snapshot cut into hash buckets, and one small manifest. The number of buckets follows
the number of rows.

A write merges changed rows into the buckets they touch and writes those buckets anew, in one job; then the manifest,
which names the folder of every bucket and the last tags written, is replaced. Replacing it commits the write, so a
write that was interrupted or repeated changes nothing. Reading lists no folders: the manifest has the paths. Folders
that two manifests have not named are deleted. Writes to one table must not overlap; the streams of one application take
turns through the lock of their store.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .files import delete, exists, read_small, replace_small

#: Buckets of a small table, and rows of a bucket from which on a table gets more of them.
BUCKETS, BUCKET_ROWS = 64, 500_000
#: Tags that a manifest remembers; a stream repeats its last batch at most.
TAGS = 200


class KeyedTable:
    """``apart`` names a condition (SQL text) whose rows are kept in files of their own, so that they can be read alone."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, apart: str = "true",
                 buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.key, self.schema, self.apart = spark, path, key, schema, apart
        self.buckets, self.bucket_rows = buckets, bucket_rows

    def _manifest(self) -> dict:
        text = read_small(self.spark, f"{self.path}/manifest.json")
        empty = {"version": 0, "buckets": {}, "tags": [], "before": [], "count": self.buckets, "rows": 0}
        return json.loads(text) if text else empty

    def _enough(self, manifest: dict, more: int) -> int:
        """Buckets for the table after ``more`` changed rows. The manifest adds changed rows up, so the rows are only counted when
        that sum has reached the limit; then the number grows by a power of two."""
        count = manifest["count"]
        if manifest["rows"] + more > 2 * count * self.bucket_rows:
            manifest["rows"] = self._rows(manifest).count()
            while manifest["rows"] + more > count * self.bucket_rows:
                count *= 2
        return count

    def has(self, tag: str) -> bool:
        return tag in self._manifest()["tags"]

    def _rows(self, manifest: dict, buckets: list[str] | None = None, only_apart: bool = False) -> DataFrame:
        wanted = [b for b in manifest["buckets"] if buckets is None or b in buckets]
        paths = [f"{self.path}/{manifest['buckets'][b]}/bucket={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(StructType([*self.schema.fields, StructField("apart", BooleanType())])).parquet(*paths)
        return (rows.filter("apart") if only_apart else rows).select(*self.schema.names)

    def _has_bucket(self, folder: str, bucket: str) -> bool:
        return exists(self.spark, f"{self.path}/{folder}/bucket={bucket}")

    def read(self) -> DataFrame:
        """Current rows."""
        return self._rows(self._manifest())

    def read_apart(self) -> DataFrame:
        """Current rows that meet the condition of the table; only their files are read."""
        return self._rows(self._manifest(), only_apart=True)

    def find(self, key: str) -> DataFrame:
        """The current row of one key; only the files of its bucket are read, and of those the blocks whose filter may hold it."""
        manifest = self._manifest()
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(key)), F.lit(manifest["count"])).cast("string")).first()[0]
        return self._rows(manifest, [bucket]).filter(F.col(self.key) == key)

    def write(self, df: DataFrame, tag: str) -> bool:
        """Put changed rows in place under ``tag``; false when that tag has been written."""
        manifest = self._manifest()
        if tag in manifest["tags"]:
            return False
        folder = f"v{manifest['version'] + 1:012d}"
        changed = f"{self.path}/{folder}-changed"
        df.select(*self.schema.names).write.mode("overwrite").parquet(changed)
        new = self.spark.read.schema(self.schema).parquet(changed)
        more = new.count()
        count = self._enough(manifest, more)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(count)).cast("int")
        anew = count != manifest["count"]
        # At most the number of buckets; all of them where the rows are dealt anew.
        touched = [str(b) for b in range(count)] if anew else [str(r.b) for r in new.select(bucket.alias("b")).distinct().collect()]
        if touched:
            old = self._rows(manifest, None if anew else touched).withColumn("fresh", F.lit(0))
            # Dealt by bucket, so that a bucket is one file, however many tasks there are; it has a bounded number of rows.
            both = old.unionByName(new.withColumn("fresh", F.lit(1))).withColumn("bucket", bucket).repartition("bucket")
            # A key has its old and its new row here, no more.
            last = W.partitionBy("bucket", self.key).orderBy(F.desc("fresh"))
            merged = both.withColumn("nth", F.row_number().over(last)).filter("nth = 1").select(
                *self.schema.names, F.coalesce(F.expr(self.apart), F.lit(False)).alias("apart"), "bucket"
            )
            writer = merged.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            writer.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        # A bucket that got no row has no folder.
        kept = {} if anew else manifest["buckets"]
        buckets = kept | {b: folder for b in touched if not anew or self._has_bucket(folder, b)}
        named = sorted(set(buckets.values()))
        after = {
            "version": manifest["version"] + 1, "buckets": buckets, "tags": [*manifest["tags"], tag][-TAGS:],
            "before": sorted(set(manifest["buckets"].values())), "count": count, "rows": manifest["rows"] + more,
        }
        replace_small(self.spark, f"{self.path}/manifest.json", json.dumps(after))
        delete(self.spark, changed)
        for gone in set(manifest["before"]) - set(named) - set(after["before"]):
            delete(self.spark, f"{self.path}/{gone}")
        return True
