"""Fixed schemas of every table the engine reads or writes."""

from pyspark.sql import types as T

ACCESS_EVENT = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("reads_1h", T.LongType()),
    T.StructField("writes_1h", T.LongType()),
    T.StructField("bytes_read_1h", T.LongType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("current_backend", T.StringType()),
    T.StructField("initial_backend", T.StringType()),
    T.StructField("size_gb", T.DoubleType()),
])

HISTORY_FIELDS = ("timestamp", "reads_1h", "writes_1h", "bytes_read_1h", "hour_of_day", "day_of_week")
HISTORY_ENTRY = T.StructType([ACCESS_EVENT[name] for name in HISTORY_FIELDS])

DATASET = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("size_gb", T.DoubleType()),
    T.StructField("initial_backend", T.StringType()),
    T.StructField("current_backend", T.StringType()),
    T.StructField("last_timestamp", T.LongType()),
    T.StructField("reads_1h", T.LongType()),
    T.StructField("writes_1h", T.LongType()),
    T.StructField("bytes_read_1h", T.LongType()),
    T.StructField("last_migrated_at", T.DoubleType()),
    T.StructField("history", T.ArrayType(HISTORY_ENTRY)),
])

JOB = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("from_backend", T.StringType()),
    T.StructField("to_backend", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("created_at", T.DoubleType()),
    T.StructField("started_at", T.DoubleType()),
    T.StructField("finished_at", T.DoubleType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("retry_after", T.DoubleType()),
])

OUTCOME = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("duration_sec", T.DoubleType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("started_at", T.DoubleType()),
    T.StructField("finished_at", T.DoubleType()),
    T.StructField("jobs_created", T.LongType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("error", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ts", T.DoubleType()),
])

RUN_LOG = T.StructType([
    T.StructField("service", T.StringType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("events", T.DoubleType()),
    T.StructField("accepted", T.DoubleType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("events_per_sec", T.DoubleType()),
    T.StructField("events_per_hour", T.DoubleType()),
    T.StructField("p95_latency_ms", T.DoubleType()),
])

ROLLING_HOURS = (6, 12, 24, 48, 96)
TRAINING = T.StructType(
    [ACCESS_EVENT["dataset_id"]]
    + [ACCESS_EVENT[name] for name in HISTORY_FIELDS]
    + [T.StructField(f"{kind}_{h}h", T.DoubleType()) for kind in ("reads", "writes") for h in ROLLING_HOURS]
    + [
        T.StructField("trend_6h", T.DoubleType()),
        T.StructField("data_temperature", T.StringType()),
        T.StructField("access_freq_24h", T.DoubleType()),
    ]
)
