"""Registered queries against their SQL on the smallest tables; ``run_queries.py`` runs all of them at any scale."""

import pytest
from run_queries import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
QUICK = [
    "event_validation", "dataset_state_upsert", "hot_reactions_on_state", "placement_decisions", "scan_jobs",
    "suppressed_jobs", "job_outcomes", "cost_summary", "savings_projection", "text_report", "migration_counts",
    "p95_event_value", "calendar_effect", "training_features", "feature_scaler", "best_horizon", "cost_summary_after_faults",
    "savings_after_faults", "filled_hours_of_events", "streamed_state", "logged_runs", "event_messages",
    "dataset_state_event_time", "hot_reactions_event_time", "trained_forecast", "reads_quantiles", "reused_features",
    "imported_run_log", "claimed_job_table", "tier_distribution", "stored_dataset_detail", "streamed_event_rate",
    "streamed_scans", "streamed_run_log", "streamed_state_without_replays",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) == ""


def test_entry(spark):
    assert entry(spark).count() == 15


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())
