import json

import pytest
from helpers import dataset, datasets, job, jobs
from pyspark.sql import functions as F

from tidemark.operators import metrics, reports, scenario
from tidemark.operators.jobs import first_rows
from tidemark.operators.pricing import cost_summary
from tidemark.operators.quantiles import merged_quantiles, quantile_sketches, rank_errors, RANK_ERROR
from tidemark.operators import features as ft
from tidemark.schemas import DATASET, RUN_LOG, TRAINING
from tidemark.sources import files
from tidemark.sources.keyed_table import KeyedTable


def test_empty_tables(spark):
    d, j = datasets(spark, []), jobs(spark, [])
    log = spark.createDataFrame([], RUN_LOG)
    o = reports.overview(d, j, log).first()
    assert (o.total_datasets, o.migrations.total, o.costs.baseline, o.throughput.events_per_sec) == (0, 0, 0.0, 0.0)
    e = reports.migration_efficiency(j).first()
    assert (e.total, e.success_rate, e.avg_duration, e.median_duration) == (0, 0.0, 0.0, None)
    counts = {(r.kind, r.item): r.jobs for r in reports.migration_counts(j).collect()}
    assert counts == {("status", "COMPLETE"): 0, ("status", "FAILED"): 0}
    assert reports.savings(d, j).first().savings_percent == 0.0


def test_migration_efficiency(spark):
    j = jobs(spark, [job("1", status="COMPLETE", duration=4.0), job("2", status="COMPLETE", duration=1.0),
                     job("3", status="COMPLETE", duration=0.0), job("4", status="FAILED"), job("5", status=None, reason=None)])
    e = reports.migration_efficiency(j).first()
    assert (e.total, e.success_rate, e.avg_duration, e.median_duration, e.min_duration, e.max_duration) == (
        5, 75.0, 2.5, 2.5, 1.0, 4.0)
    counts = {(r.kind, r.item): r.jobs for r in reports.migration_counts(j).collect()}
    assert counts[("status", "UNKNOWN")] == 1 and counts[("reason", "Unknown")] == 1


def test_classes_divide_by_24_hours(spark):
    d = datasets(spark, [dataset("hot", [2401]), dataset("warm", [2400]), dataset("cold", [240]), dataset("none", None)])
    got = {r.dataset_id: r.temperature for r in reports.observed(d).collect()}
    assert got == {"hot": "hot", "warm": "warm", "cold": "cold"}


def test_reports_agree(spark, tmp_path):
    d = datasets(spark, [dataset("a", [100] * 24), dataset("b", [1] * 24, "on-prem")])
    j = jobs(spark, [job("1", status="COMPLETE", duration=2.0), job("2", status="FAILED")])
    s = reports.savings(d, j).first()
    assert s.savings == pytest.approx(-0.5) and s.monthly == pytest.approx(-15)
    files.write_json_report(reports.json_report(d, j, "now"), str(tmp_path / "r"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert [json.loads(x["body"]) for x in lines if x["part"] == "reason"] == [{"reason": "r", "count": 2}]
    (r,) = [json.loads(x["body"]) for x in lines if x["part"] == "report"]
    assert r["costs"]["savings"]["amount"] == pytest.approx(-0.5)
    assert r["migrations"]["efficiency"]["by_status"] == {"COMPLETE": 1, "FAILED": 1}
    assert r["backends"]["on-prem"] == {"count": 1, "total_gb": 100.0}
    lines = {(x.section, x.item): x.text for x in reports.text_report(d, j).collect()}
    assert lines[("cost", "savings")] == "$-0.50" and lines[("access", "total reads")] == "2,424"


def test_run_log(spark, tmp_path):
    p = tmp_path / "log.md"
    head = "# Title\n\n| Events | Accepted | Duration | Rate | Hourly | p95 |\n| ---: | ---: | ---: | ---: | ---: | ---: |\n"
    p.write_text(head + "| 10 | 9 | 1.5 | 6 | 21600 | 0.1 |\n| 20 | 18 | 2 | 9 | 32400 | 0.2 |\n")
    row = files.latest_logged_run(files.read_pipe_log(spark, str(p))).first()
    assert (row.events, row.accepted, row.p95_latency_ms) == (20.0, 18.0, 0.2)
    p.write_text(head + "| 10 | 9 | 1.5 | 6 | 21600 | 0.1 |\n| broken |\n")
    assert files.latest_logged_run(files.read_pipe_log(spark, str(p))).count() == 0
    p.write_text(head)
    assert files.latest_logged_run(files.read_pipe_log(spark, str(p))).count() == 0
    run = spark.createDataFrame([("benchmark", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], RUN_LOG)
    files.append_run(run, str(tmp_path / "runs"))
    files.append_run(run.withColumn("ts", F.lit(2.0)), str(tmp_path / "runs"))
    assert reports.latest_metric(spark.read.parquet(str(tmp_path / "runs"))).first().ts == 2.0


def test_training_csv(spark, tmp_path):
    names = TRAINING.names
    row = {n: "3" for n in names} | {"dataset_id": "a", "timestamp": "2025-01-01 05:00:00", "data_temperature": "hot",
                                     "reads_6h": "", "hour_of_day": "5.0"}
    p = tmp_path / "t.csv"
    p.write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    r = files.read_training_csv(spark, str(p)).first()
    assert (r.timestamp, r.reads_6h, r.hour_of_day, r.data_temperature, r.trend_6h) == (1735707600, 0.0, 5, "hot", 3.0)


def test_keyed_table_and_materialise(spark, tmp_path):
    log = KeyedTable(spark, str(tmp_path / "log"), "dataset_id", DATASET, apart="size(history) > 1", buckets=3)
    assert log.read().count() == 0
    assert log.write(datasets(spark, [dataset("a", [1]), dataset("b", [1])]), "x")
    assert log.write(datasets(spark, [dataset("a", [1, 2])]), "y")
    assert log.write(datasets(spark, [dataset("a", [9])]), "y") is False
    sizes = {r.dataset_id: len(r.history) for r in log.read().collect()}
    assert sizes == {"a": 2, "b": 1}
    assert [r.dataset_id for r in log.read_apart().collect()] == ["a"]
    for i in range(5):
        assert log.write(datasets(spark, [dataset(f"n{i}", [1])]), f"more{i}")
    again = KeyedTable(spark, str(tmp_path / "log"), "dataset_id", DATASET)
    assert {r.dataset_id: len(r.history) for r in again.read().collect()} == sizes | {f"n{i}": 1 for i in range(5)}
    assert again.has("x") and not again.has("z")


def test_reuse_notices_other_input_and_other_arguments(spark, tmp_path):
    where, given, built = str(tmp_path / "kept"), str(tmp_path / "in"), []
    spark.range(3).write.parquet(given)

    def kept(df, arguments=None):
        return files.reused(where, lambda: built.append(1) or df, [df], arguments).count(), len(built)

    read = lambda: spark.read.parquet(given)
    assert kept(read()) == (3, 1) and kept(read()) == (3, 1)  # the same input and arguments: only read
    assert kept(read().filter("id > 0")) == (2, 2)
    assert kept(read(), {"limit": 1}) == (3, 3)
    spark.range(2).write.mode("append").parquet(given)
    assert kept(read()) == (5, 4) and kept(read()) == (5, 4)


def test_lookup_reads_one_bucket(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "dataset_id", DATASET, buckets=8)
    table.write(datasets(spark, [dataset(f"d{i}", [i]) for i in range(40)]), "x")
    for i in (0, 17, 39):
        found = table.find(f"d{i}")
        assert [r.reads_1h for r in found.collect()] == [0] and len({f.split("bucket=")[1][0] for f in found.inputFiles()}) == 1
    assert table.find("nothing").count() == 0


def test_buckets_follow_the_size(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "dataset_id", DATASET, buckets=2, bucket_rows=10)
    names = set()
    for step in range(4):
        new = {f"d{step}-{i}" for i in range(30)}
        table.write(datasets(spark, [dataset(n, [step]) for n in new]), f"t{step}")
        table.write(datasets(spark, [dataset(n, [step, 1]) for n in sorted(new)[:5]]), f"u{step}")
        names |= new
        rows = {r.dataset_id: len(r.history) for r in table.read().collect()}
        assert set(rows) == names and rows[sorted(new)[0]] == 2
    assert table._manifest()["count"] >= 8 and table.find("d0-7").count() == 1


def test_lines_are_numbered_over_splits(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 1), ("c", 700)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i} {'x' * (i % 50)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = files.numbered_lines(spark, f"{tmp_path}/*.txt").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 5701 and all(r.line.split()[0] == f"{r.file[-5]}{r.line_no}" for r in rows)


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(60_000).selectExpr("id % 3 as g", "id % 7 as h", "cast(id * id % 9973 as double) as v")
    df = df.unionByName(spark.createDataFrame([(0, 0, None), (9, 9, 5.0), (8, 8, None)], "g long, h long, v double"))
    stored = files.staged(quantile_sketches(df, "v", ["g", "h"]))
    assert stored.count() == 22
    asked = files.staged(merged_quantiles(stored, ["g"], [0.01, 0.5, 0.99]))
    off = {(r.g, r.p): r.rank_error for r in rank_errors(df, "v", asked, ["g"]).collect()}
    assert len(off) == 12 and max(off.values()) <= RANK_ERROR
    assert {r.n for r in asked.filter("g = 9").collect()} == {1} and {r.value for r in asked.filter("g = 9").collect()} == {5.0}


def test_first_rows_by_ranges(spark):
    df = spark.createDataFrame([(i * 7919 % 1000 // 3, i) for i in range(1000)], "t int, id int").repartition(5)
    want = sorted((r.t, r.id) for r in df.collect())
    for n in (1, 10, 333, 999, 1000, 5000):
        assert sorted((r.t, r.id) for r in first_rows(df, ["t", "id"], n, few=0).collect()) == want[:n]


def test_messages(spark):
    e = spark.createDataFrame([("a", 1)], "dataset_id string, n int")
    assert tuple(files.keyed_messages(e).first()) == ("a", '{"dataset_id":"a","n":1}')


def test_calendar_multiplies_overlaps(spark):
    from tidemark.config import CalendarEntry

    c = scenario.calendar_table(spark, (
        CalendarEntry("x", 2, 3, ("p", "q"), read_multiplier=2.0), CalendarEntry("y", 4, 9, ("p",), 5.0, 3.0)))
    got = {(r.persona, r.cycle_day): (r.read_multiplier, r.write_multiplier)
           for r in scenario.daily_multipliers(c, 6).collect()}
    assert got == {("p", 2): (2.0, 1.0), ("p", 3): (2.0, 1.0), ("p", 4): (10.0, 3.0), ("p", 5): (5.0, 3.0),
                   ("q", 2): (2.0, 1.0), ("q", 3): (2.0, 1.0), ("q", 4): (2.0, 1.0)}


def test_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.0, 0.5)], "a double, p double")
    e = metrics.forecast_errors(df, "a", "p").first()
    assert (e.mae, e.mape) == (1.25, 25.0) and e.rmse == pytest.approx((4.25 / 2) ** 0.5)
    loss = metrics.losses(df, [("a", "p")]).first()
    assert loss.huber == pytest.approx((1.5 + 0.125) / 2) and loss.mse == pytest.approx(2.125)
    best = spark.createDataFrame([("r", "8h", 0, 2.0), ("r", "12h", 1, 2.0), ("w", "8h", 0, 3.0), ("w", "12h", 1, 1.0)],
                                 "target string, name string, ord int, val_mae double")
    assert {(r.target, r.best) for r in metrics.best_model(best).collect()} == {("r", "8h"), ("w", "12h")}


def test_scaler_equals_the_built_sequences(spark):
    import numpy as np

    values = [(i * 17) % 23 for i in range(60)]
    t = spark.createDataFrame([("a", 3600 * i, float(v), 1.0, True, i, 60) for i, v in enumerate(values)],
                              "dataset_id string, timestamp long, f double, g double, is_train boolean, part_pos long, "
                              "part_rows long")
    s = ft.fit_scaler(t, ["f", "g"], 12).first()
    windows = np.array([values[i:i + 24] for i in range(60 - 35)], dtype=float).ravel()
    assert s.mean_f == pytest.approx(windows.mean()) and s.sd_f == pytest.approx(windows.std())
    assert (s.mean_g, s.sd_g) == (1.0, 1.0)


def test_savings_never_come_from_unpriced_datasets(spark):
    d = datasets(spark, [dataset("a", [5] * 3, "on-prem"), dataset("b", [5] * 3, "tape", initial="on-prem")])
    j = jobs(spark, [])
    s = cost_summary(d, j).first()
    assert (s.savings, s.savings_percent, s.unpriced_datasets) == (0.0, 0.0, 1) and s.baseline > 0
    s = reports.savings(d, j, baseline="initial").first()
    assert (s.savings, s.unpriced_datasets) == (0.0, 1) and s.baseline > 0


def test_hours_off_the_grid_are_not_lost(spark):
    rows = [("a", 0, 5, 1, 1), ("a", 1800, 7, 1, 1), ("a", 7300, 1, 0, 0), ("b", 2**60, 3, 0, 0), ("b", 100, 2, 0, 0)]
    access = spark.createDataFrame(rows, "dataset_id string, timestamp long, reads_1h long, writes_1h long, bytes_read_1h long")
    got = {(r.dataset_id, r.timestamp): r.reads_1h for r in scenario.fill_hours(access).collect()}
    assert got == {("a", 0): 12, ("a", 3600): 0, ("a", 7200): 1, ("b", 2**60 // 3600 * 3600): 3, ("b", 0): 2}


def test_calendar_entries_of_no_days_cover_none(spark):
    from tidemark.config import CalendarEntry

    c = scenario.calendar_table(spark, (CalendarEntry("x", 5, 0, ("p",), read_multiplier=2.0),))
    assert scenario.daily_multipliers(c, 30).count() == 0


def test_scaler_of_large_values(spark):
    rows = [("a", 3600 * i, 1e12 + i % 2, True, i, 60) for i in range(60)]
    t = spark.createDataFrame(rows, "dataset_id string, timestamp long, f double, is_train boolean, part_pos long, part_rows long")
    s = ft.fit_scaler(t, ["f"], 12).first()
    assert s.sd_f == pytest.approx(0.5, rel=1e-6)


def test_malformed_training_cells(spark, tmp_path):
    names = TRAINING.names
    row = {n: "3" for n in names} | {"dataset_id": "a", "timestamp": "yesterday", "hour_of_day": "9e30"}
    p = tmp_path / "t.csv"
    p.write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    r = files.read_training_csv(spark, str(p)).first()
    assert (r.timestamp, r.hour_of_day) == (None, 0)


def test_runs_keep_their_copies_together(spark):
    import os

    with files.run_of("q") as run:
        df = files.staged(spark.range(3))
    folder = f"{files.shared_dir(spark)}/staged/{run}"
    assert df.count() == 3 and len(os.listdir(folder)) == 1
    files.drop_run(spark, run)
    assert not os.path.exists(folder)
