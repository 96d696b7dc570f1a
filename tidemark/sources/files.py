"""Readers and writers: streams of event text, training files, reports, materialised tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..schemas import RUN_LOG, TRAINING

# Each Kafka partition gets its own range of arrival numbers.
OFFSETS_PER_PARTITION = 2**44


#: Columns of a file stream that give the order of arrival, together with the place in the block.
ARRIVAL = ("file_time", "file", "block")


def text_event_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, by_name: bool = False
) -> DataFrame:
    """Lines of JSON text that arrive as files; the arrival number is given when a batch is stored. Files of one batch are
    in the order of their times, or of their names where those count their ranges (``by_name``)."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    seen = F.col("_metadata.file_modification_time")
    return reader.load(path).select(
        "value", seen.alias("arrived"), (F.lit(None).cast("timestamp") if by_name else seen).alias("file_time"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    )


def write_event_files(raw: DataFrame, path: str, order: list[str], rows_per_file: int) -> None:
    """Event text in files of about so many rows, each a range of ``order``; the names of the files count the ranges."""
    files = max(1, -(-raw.count() // rows_per_file))
    ranges = raw.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranges.select("value").write.text(path)


def kafka_event_stream(spark: SparkSession, servers: str, topic: str = "access_events", **options: str) -> DataFrame:
    """The event topic from its start. Events of a dataset share a partition, so offsets give their order."""
    reader = spark.readStream.format("kafka").options(**options)
    raw = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).option(
        "startingOffsets", "earliest"
    ).load()
    return raw.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), F.col("value").cast("string").alias("value"),
        (F.col("partition").cast("long") * OFFSETS_PER_PARTITION + F.col("offset")).alias("seq"),
    )


def keyed_messages(events: DataFrame, key: str = "dataset_id", columns: list[str] | None = None) -> DataFrame:
    """``(key, value)`` text pairs, ready for a Kafka or file writer. A null is written as ``null``: a field that is left
    out may mean something else to the reader."""
    value = F.to_json(F.struct(*(columns or events.columns)), {"ignoreNullFields": "false"})
    return events.select(F.col(key).alias("key"), value.alias("value"))


def publish_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Append keyed messages to a topic, acknowledged by all replicas."""
    keyed_messages(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "kafka.acks", "all"
    ).option("topic", topic).save()


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """The training table from CSV with a header: timestamps to epoch seconds (null if malformed), numbers that are missing
    or out of range to zero."""
    header = spark.read.option("header", True).csv(path)
    wanted = {f.name: f.dataType for f in TRAINING}

    def cell(name: str) -> Column:
        kind = wanted[name].simpleString()
        if name == "timestamp":
            return F.unix_timestamp(F.try_to_timestamp(name))
        if kind == "string":
            return F.coalesce(name, F.lit("0"))
        # A whole number may be written as 3.0.
        return F.coalesce(F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).try_cast(kind), F.lit(0).cast(kind))

    return header.select(*[cell(n).alias(n) for n in wanted])


def shared_dir(spark: SparkSession) -> str:
    """Folder that all machines see: the setting ``spark.checkpoint.dir``, which the cluster or the caller makes."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
    return found


_RUN: ContextVar[str] = ContextVar("run", default="all")


@contextmanager
def run_of(name: str):
    """Puts the copies that ``staged`` makes inside the block under one run id, which is given back. The results built
    inside may read them until ``drop_run``."""
    run = f"{name}-{uuid.uuid4().hex}"
    token = _RUN.set(run)
    try:
        yield run
    finally:
        _RUN.reset(token)


def run_folder(spark: SparkSession) -> str:
    """A new folder for what a query writes itself, under the run id that holds now."""
    return f"{shared_dir(spark)}/staged/{_RUN.get()}/{uuid.uuid4().hex}"


def drop_run(spark: SparkSession, run: str) -> None:
    """Delete the copies of one run, once its results have been read."""
    delete(spark, f"{shared_dir(spark)}/staged/{run}")


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder, by a job that runs at once. For a result that several branches of
    one query read: they then share a scan with pruned columns, and losing an executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/staged/{_RUN.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its marker in ``path``."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_small(spark: SparkSession, path: str) -> str | None:
    """A small text file, or nothing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place of the old one. It is written aside first and then renamed over it."""
    fs, p = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.next")
    stream = fs.create(aside, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = rename
    context.rename(aside, p, options)


def fingerprint(inputs: list[DataFrame], arguments: object = None) -> str:
    """A digest of the files behind ``inputs``, with their sizes and times, of what is done to them, and of ``arguments``."""
    seen = hashlib.sha256(repr(arguments).encode())
    for df in inputs:
        seen.update(repr((df.dtypes, df.semanticHash())).encode())
        for name in sorted(df.inputFiles()):
            fs, p = _fs(df.sparkSession, name)
            status = fs.getFileStatus(p)
            seen.update(f"{name}|{status.getLen()}|{status.getModificationTime()}\n".encode())
    return seen.hexdigest()


def reused(path: str, build: Callable[[], DataFrame], inputs: list[DataFrame], arguments: object = None) -> DataFrame:
    """What ``build`` makes of ``inputs``, kept below ``path``: built and written the first time, only read as long as the
    input files and the arguments are the same. ``arguments`` stand for all else that the result depends on, such as
    horizons and limits."""
    spark, where = inputs[0].sparkSession, f"{path}/{fingerprint(inputs, arguments)}"
    if not is_complete(spark, where):
        build().write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back; a later call with the same path only reads, so the path has to name the result: a
    batch that is repeated goes on with what it wrote. Cuts the lineage. See ``reused`` for results of changing input."""
    spark = df.sparkSession
    if not is_complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_json_report(report: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """A one-row report as one JSON file, and the long ``counts`` next to it as JSON lines in as many files as needed."""
    report.coalesce(1).write.mode("overwrite").json(path)
    if counts is not None:
        counts.write.mode("overwrite").json(f"{path}-counts")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of text files, lines numbered from 0. Files are read in splits: rows are numbered within their
    split, and the rows of the splits before are added."""
    seen = staged(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    ))
    splits = seen.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(W.partitionBy("file").orderBy("block")) - F.col("n")  # a row per split
    shifts = splits.select("file", "block", (before - F.col("first")).alias("shift"))
    return seen.join(shifts, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "line")


def read_pipe_log(spark: SparkSession, path: str, service: str = "benchmark") -> DataFrame:
    """Rows of a pipe table as run-log rows. ``ts`` is the position in the file, so the last row is the newest; rows
    of another width and the header give nulls."""
    lines = numbered_lines(spark, path)
    rows = lines.filter(F.col("line").startswith("| ") & ~F.col("line").contains("---")).select(
        F.col("line_no").cast("double").alias("ts"),
        F.transform(F.split(F.regexp_replace("line", r"^\|+|\|+\s*$", ""), r"\|"), lambda c: F.trim(c)).alias("cells"),
    )
    good = F.size("cells") == 6
    names = RUN_LOG.names[2:]
    return rows.select(
        F.lit(service).alias("service"), "ts",
        *[F.when(good, F.get("cells", F.lit(i)).try_cast("double")).alias(n) for i, n in enumerate(names)],
    )


def latest_logged_run(log: DataFrame) -> DataFrame:
    """The last row of a log, and nothing when that row is malformed."""
    values = [c for c in log.columns if c != "ts"]
    last = log.agg(F.max_by(F.struct(*values), "ts").alias("r")).select("r.*")
    return last.filter(F.col("events").isNotNull())


def append_run(run: DataFrame, path: str) -> None:
    run.select(*RUN_LOG.names).write.mode("append").parquet(path)


def append_request(request: DataFrame, path: str) -> None:
    request.write.mode("append").parquet(path)
