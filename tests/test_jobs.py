from helpers import dataset, datasets, job, jobs
from pyspark.sql import functions as F

from tidemark.operators import jobs as jb
from tidemark.schemas import OUTCOME, REQUEST


def by_id(df, key="job_id"):
    return {r[key]: r for r in df.collect()}


def test_one_pending_job_per_dataset_and_reason(spark):
    asked = spark.createDataFrame(
        [("a", "x", "y", "r", 2), ("a", "x", "z", "r", 1), ("a", "x", "y", "other", 1), ("b", "x", "y", "r", 1)],
        "dataset_id string, from_backend string, to_backend string, reason string, ord int")
    have = jobs(spark, [job("1", "b", "PENDING"), job("2", "a", "COMPLETE")])
    made = jb.create_jobs(asked, have, 7.0).collect()
    assert {(r.dataset_id, r.reason, r.to_backend) for r in made} == {("a", "r", "z"), ("a", "other", "y")}
    assert {(r.status, r.attempts, r.created_at, r.started_at) for r in made} == {("PENDING", 0, 7.0, None)}
    assert jb.create_jobs(asked, have.unionByName(jb.create_jobs(asked, have, 7.0)), 8.0).count() == 0


def test_scan_creates_a_job_only_for_moves(spark):
    d = datasets(spark, [dataset("hot", [500] * 24, size=10.0), dataset("cold", [1] * 24), dataset("new", None)])
    (made,) = jb.scan(d, jobs(spark, []), 1.0).collect()
    assert (made.dataset_id, made.from_backend, made.to_backend) == ("hot", "public-cold", "on-prem")
    assert made.reason.startswith("hot-read-low-latency: save $") and made.reason.endswith("%)")
    again = jobs(spark, [job("1", "hot", to="on-prem", reason="older figure")])
    assert jb.scan(d, again, 1.0).count() == 1
    assert jb.scan(d, again, 1.0, one_per_target=True).count() == 0


def test_reason_text(spark):
    from tidemark.functions.text import scheduled_reason

    rows = spark.createDataFrame(
        [(0.0009, 0.0), (12.0, 5.5), (12345678.9, 99.99), (2398.824, 100.0), (0.0, 0.01)], "s double, p double")
    got = [r[0] for r in rows.select(scheduled_reason(F.lit("r"), F.col("s"), F.col("p"))).collect()]
    assert got == [f"r: save ${s}/day ({p}%)" for s, p in
                   [("0.0009", "0.0"), ("12.0", "5.5"), ("12345678.9", "99.99"), ("2398.824", "100.0"), ("0.0", "0.01")]]


def test_claim_takes_the_oldest_that_may_run(spark):
    table = jobs(spark, [
        job("a", created=3.0), job("b", created=1.0, retry=50.0), job("c", created=2.0, retry=10.0, attempts=1),
        job("d", created=0.5, status="FAILED"), job("e", created=2.0)])
    out = by_id(jb.claim_jobs(table, 10.0, 2))
    assert {k for k, r in out.items() if r.status == "RUNNING"} == {"c", "e"}
    assert (out["c"].attempts, out["c"].started_at, out["e"].attempts) == (2, 10.0, 1)
    assert out["a"].status == out["b"].status == "PENDING" and len(out) == 5
    assert by_id(jb.claimed(table, 10.0, 2)).keys() == {"c", "e"}
    assert jb.claimed(jobs(spark, []), 10.0).count() == 0


def test_outcomes(spark):
    table = jobs(spark, [job(str(i), status="RUNNING", attempts=a) for i, a in enumerate([1, 1, 2, 3])]
                 + [job("9")])
    said = spark.createDataFrame([("0", True, None, 1.23456), ("1", False, "e1", None), ("2", False, "e2", None),
                                  ("3", False, "e3", None), ("77", True, None, 1.0)], OUTCOME)
    out = by_id(jb.apply_outcomes(table, said, 100.0))
    assert (out["0"].status, out["0"].duration_sec, out["0"].finished_at) == ("COMPLETE", 1.235, 100.0)
    assert (out["1"].status, out["1"].retry_after, out["1"].error, out["1"].finished_at) == ("PENDING", 103.0, "e1", None)
    assert (out["2"].status, out["2"].retry_after) == ("PENDING", 106.0)
    assert (out["3"].status, out["3"].finished_at, out["3"].retry_after) == ("FAILED", 100.0, None)
    assert out["9"].status == "PENDING" and len(out) == 5


def test_moves_apply_the_last_claim(spark):
    d = datasets(spark, [dataset("a", [1]), dataset("b", [1])])
    done = jobs(spark, [job("1", "a", "COMPLETE", to="on-prem"), job("2", "a", "COMPLETE", to="public-hot"),
                        job("3", "gone", "COMPLETE")])
    done = done.withColumn("started_at", F.when(F.col("job_id") == "1", 9.0).otherwise(5.0))
    out = by_id(jb.apply_moves(d, done, 50.0), "dataset_id")
    assert (out["a"].current_backend, out["a"].last_migrated_at) == ("on-prem", 50.0)
    assert (out["b"].current_backend, out["b"].last_migrated_at) == ("public-cold", None)
    assert len(out) == 2


def test_reclaim_is_optional(spark):
    table = jobs(spark, [job("1", status="RUNNING")]).withColumn("started_at", F.lit(1.0))
    assert by_id(jb.reclaim(table, 100.0, 50.0))["1"].status == "PENDING"
    assert by_id(jb.reclaim(table, 100.0, 500.0))["1"].status == "RUNNING"


def test_requests(spark):
    table = spark.createDataFrame([("2", "PENDING", 5.0, "x", None, None, None), ("1", "PENDING", 3.0, "x", None, None, None)],
                                  REQUEST).unionByName(jb.new_request(spark, "3", 9.0))
    started = jb.claim_request(table, 10.0)
    out = by_id(jb.finish_request(started, "1", 12.0, F.lit(4).cast("long")), "request_id")
    assert (out["1"].status, out["1"].started_at, out["1"].finished_at, out["1"].jobs_created) == ("COMPLETE", 10.0, 12.0, 4)
    assert out["2"].status == out["3"].status == "PENDING"
    # A request that another scan has claimed is left alone.
    both = jb.claim_request(started, 11.0)
    out = by_id(jb.finish_request(both, "2", 12.0, F.lit(4).cast("long")), "request_id")
    assert (out["1"].status, out["1"].jobs_created, out["2"].status) == ("RUNNING", None, "COMPLETE")


def test_several_outcomes_of_a_job_leave_one_row(spark):
    table = jobs(spark, [job("1", status="RUNNING", attempts=1)])
    said = spark.createDataFrame([("1", False, "lost", None), ("1", True, None, 2.0), ("1", True, None, 1.0)], OUTCOME)
    (row,) = jb.apply_outcomes(table, said, 5.0).collect()
    assert (row.status, row.duration_sec, row.error) == ("COMPLETE", 2.0, None)
