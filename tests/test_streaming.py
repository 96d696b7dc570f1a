"""A stream over many files must end where one batch ends, and repeating a batch must change nothing."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ingest import ingest_batch
from tidemark.operators.validate import validate_events
from tidemark.schemas import DATASET, JOB
from tidemark.sources import derived as dv
from tidemark.operators.state import fold_events, summarise, upsert
from tidemark.sources.files import staged, text_event_stream
from tidemark.operators.jobs import new_request
from tidemark.sources.keyed_table import KeyedTable
from tidemark.streaming.pipeline import (
    Store, drop_replays, ingest_stream, process_batch, rate_stream, run_pending_scans, run_scan,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    rows = dv.raw_events(dv.access(spark, SF)).orderBy("seq", "value").collect()
    return [r["value"] for r in rows]


def state_of(df):
    return sorted(str(r) for r in df.drop("last_migrated_at").collect())


def job_keys(df):
    return sorted((r.dataset_id, r.from_backend, r.to_backend, r.reason) for r in df.collect())


@pytest.fixture(scope="module")
def once(spark, raw):
    numbered = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "seq long, value string")
    out = ingest_batch(
        validate_events(numbered).cache(), spark.createDataFrame([], DATASET), spark.createDataFrame([], JOB), 9.0)
    return state_of(out.state), job_keys(out.jobs), sorted(r.payload for r in out.dead_letters.collect()), numbered


def test_stream_equals_batch(spark, raw, once, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    size = len(raw) // 3 + 1
    for i in range(3):
        f = source / f"part{i}.json"
        f.write_text("\n".join(raw[i * size:(i + 1) * size]) + "\n")
        os.utime(f, (1000 + i, 1000 + i))
    store = Store(spark, str(tmp_path / "store"))
    stream = text_event_stream(spark, str(source), files_per_trigger=1)
    q = ingest_stream(stream, store, str(tmp_path / "cp"), clock=lambda: 9.0, trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None and not q.isActive
    assert len(q.recentProgress) >= 3
    state, jobs, dead, _ = once
    assert state_of(store.state.read()) == state
    assert job_keys(store.jobs.read()) == jobs
    assert sorted(r.payload for r in store.dead_letters().collect()) == dead

    before = state_of(store.state.read())
    assert process_batch(store, spark.createDataFrame([(0, raw[0])], "seq long, value string"), 2, 9.0) is False
    assert state_of(store.state.read()) == before

    history = store.state.read().select(F.max(F.size("history")), F.count("*"), F.countDistinct("dataset_id")).first()
    assert history[0] == 24 and history[1] == history[2]

    made = run_scan(store, 20.0, "scan-0").count()
    assert made > 0
    assert run_scan(store, 20.0, "scan-0").count() == made and store.jobs.read().count() == made + len(jobs)
    assert run_scan(store, 21.0, "scan-1").count() == 0


def test_every_pending_request_gets_its_scan(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    asked = [new_request(spark, str(i), float(i)) for i in range(3)]
    store.requests.write(asked[0].unionByName(asked[1]).unionByName(asked[2]), "asked")
    assert run_pending_scans(store, 9.0, "t") == 3
    done = {r.request_id: (r.status, r.jobs_created) for r in store.requests.read().collect()}
    assert done == {str(i): ("COMPLETE", 0) for i in range(3)}
    assert run_pending_scans(store, 10.0, "u") == 1


def test_small_blocks_give_the_same_reactions(spark, once):
    numbered = once[3]
    checked = validate_events(numbered).cache()
    empty = spark.createDataFrame([], DATASET), spark.createDataFrame([], JOB)
    big = ingest_batch(checked, *empty, 9.0).triggers
    small = ingest_batch(checked, *empty, 9.0, min_rows=40).triggers
    assert sorted(map(str, small.collect())) == sorted(map(str, big.collect()))
    assert ingest_batch(checked, *empty, 9.0, skip_noop=True).triggers.filter("target_backend = 'public-cold'").count() == 0


def event(reads, ts=1, tier="public-cold", size=25.0, writes=2):
    return (f'{{"timestamp":{ts},"dataset_id":"d","reads_1h":{reads},"writes_1h":{writes},"bytes_read_1h":1024,'
            f'"hour_of_day":12,"day_of_week":2,"current_backend":"{tier}","size_gb":{size}}}')


def run(spark, texts, state=None, jobs=None):
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    return ingest_batch(
        validate_events(df), state or spark.createDataFrame([], DATASET), jobs or spark.createDataFrame([], JOB), 5.0)


def test_one_hot_event(spark):
    out = run(spark, [event(500)])
    (t,) = out.triggers.collect()
    assert (t.target_backend, t.reason, t.current_cost, t.target_cost) == (
        "on-prem", "hot-read-low-latency", 4812.0813, 12.3333)
    (j,) = out.jobs.collect()
    assert (j.from_backend, j.to_backend, j.reason) == (
        "public-cold", "on-prem", "real-time-hot-read: hot-read-low-latency")


def test_trigger_is_strict_and_the_first_tier_counts(spark):
    assert run(spark, [event(100)]).jobs.count() == 0
    assert run(spark, [event(101)]).triggers.count() == 1
    assert run(spark, [event(5, tier="on-prem"), event(500)]).jobs.count() == 0


def test_same_event_twice(spark):
    first = run(spark, [event(500)])
    out = run(spark, [event(500)], first.state, first.jobs)
    assert out.jobs.count() == 0
    assert len(out.state.first()["history"]) == 2
    both = run(spark, [event(500), event(500)])
    assert both.jobs.count() == 1 and len(both.state.first()["history"]) == 2


def test_hold_still_makes_a_job_unless_skipped(spark):
    texts = [event(0, i, size=60000.0, writes=0) for i in range(23)] + [event(101, 23, size=60000.0, writes=0)]
    (j,) = run(spark, texts).jobs.collect()
    assert (j.from_backend, j.to_backend, j.reason) == (
        "public-cold", "public-cold", "real-time-hot-read: hysteresis-hold")


def test_rate_stream(spark, tmp_path):
    events = dv.table(spark, SF, "events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{SF}/events.parquet*")
    q = (rate_stream(stream).writeStream.outputMode("update").format("memory").queryName("rates")
         .option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("rates").agg(F.sum("events")).first()[0] == events.count()


def test_replays_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([("a", 100), ("a", 100), ("b", 100)], "dataset_id string, timestamp long").write.parquet(path)
    s = spark.readStream.schema("dataset_id string, timestamp long").parquet(path)
    q = (drop_replays(s).writeStream.format("memory").queryName("uniq").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("uniq").count() == 2


def test_huge_values_do_not_stop_the_stream(spark):
    big = 6_000_000_000_000_000_000
    out = run(spark, [event(big, 1), event(big, 2), event(big, 3)])
    assert out.triggers.count() == 3 and out.state.count() == 1


def late_rows(seed, n=400):
    """Events of three datasets in an order of their own, with many of one time."""
    rng = random.Random(seed)
    return [(i, rng.randrange(60), f"d{rng.randrange(3)}", rng.choice([1, 50, 150]), rng.choice(["a", "b"])) for i in range(n)]


def typed(spark, rows):
    return spark.createDataFrame(rows, "seq long, timestamp long, dataset_id string, reads_1h long, current_backend string").selectExpr(
        "*", "reads_1h + 1 as writes_1h", "seq as bytes_read_1h", "0 as hour_of_day", "0 as day_of_week", "current_backend as initial_backend",
        "cast(seq as double) as size_gb")


@pytest.mark.parametrize("cuts", [[], [200], [10, 11, 300], [90, 180, 270]])
def test_state_by_event_time_does_not_depend_on_the_batches(spark, cuts):
    rows = late_rows(1)
    state = None
    for a, z in zip([0, *cuts], [*cuts, len(rows)]):
        batch = typed(spark, rows[a:z])
        state = fold_events(batch, "event_time") if state is None else upsert(state, summarise(batch, "event_time"), order_by="event_time")
        state = staged(state)
    got = {r.dataset_id: r for r in state.collect()}
    for d in ("d0", "d1", "d2"):
        own = sorted((t, s, r, b) for s, t, k, r, b in rows if k == d)
        first = min((s, b) for s, t, k, r, b in rows if k == d)
        r = got[d]
        assert [(e.timestamp, e.bytes_read_1h) for e in r.history] == [(t, s) for t, s, _, _ in own[-24:]]
        assert (r.last_timestamp, r.size_gb, r.reads_1h, r.current_backend) == (own[-1][0], own[-1][1], own[-1][2], first[1])


def test_replays_are_dropped_inside_the_stream(spark, raw, once, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    size = len(raw) // 3 + 1
    parts = [raw[i * size:(i + 1) * size] for i in range(3)]
    for i, texts in enumerate([parts[0], parts[1] + parts[0][::2], parts[1], parts[2] + parts[0]]):
        f = source / f"part{i}.json"
        f.write_text("\n".join(texts) + "\n")
        os.utime(f, (1000 + i, 1000 + i))
    store = Store(spark, str(tmp_path / "store"))
    q = ingest_stream(
        text_event_stream(spark, str(source), files_per_trigger=1), store, str(tmp_path / "cp"), clock=lambda: 9.0,
        trigger={"availableNow": True}, order_by="event_time", replays="1 day")
    q.awaitTermination(600)
    assert state_of(store.state.read()) == once[0]
    log = {r.batch: r for r in store.run_log().collect()}
    assert len(log) == 4 and log[0].events == len(parts[0]) and log[2].accepted == 0


def test_a_bucket_is_one_file(spark, tmp_path):
    """However many tasks a write has, so that the files do not grow with the tasks of each batch."""
    table = KeyedTable(spark, str(tmp_path / "t"), "job_id", JOB, buckets=4)
    for batch in range(2):
        rows = [(f"j{i}", f"d{batch}", "a", "b", "r", "PENDING", 0, 1.0, None, None, None, None, None) for i in range(batch * 50, batch * 50 + 200)]
        # More rows would be needed for several tasks if Spark could join their partitions.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            table.write(spark.createDataFrame(rows, JOB), f"b{batch}")
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folders = [d for d in (tmp_path / "t").glob("v*/bucket=*")]
    assert len(folders) == 2 * 4 and all(len(list(d.glob("*.parquet"))) == 1 for d in folders)
    found = {r.job_id: r.dataset_id for r in table.read().collect()}
    assert found == {f"j{i}": "d0" if i < 50 else "d1" for i in range(250)}
