import pytest
from helpers import by_sql, dataset, datasets, job, jobs
from hypothesis import given, settings, strategies as st

from tidemark.config import Limits
from tidemark.operators.forecast import access_stats, forecast_access
from tidemark.operators.placement import choose_best_backend, evaluate_placement
from tidemark.operators.pricing import baseline_cost, cost_summary, price_table, tier_costs, unpriced


def one(df):
    (row,) = df.collect()
    return row


def test_hot_dataset(spark):
    d = datasets(spark, [dataset("a", [250] * 24)])
    costs = {r["backend"]: round(r["cost"], 4) for r in tier_costs(d).collect()}
    assert costs == {"on-prem": 7.3333, "private-cloud": 320.0333, "public-hot": 283.6267, "public-cold": 2406.1573}
    p = one(evaluate_placement(d))
    assert tuple(p)[2:] == ("on-prem", "hot-read-low-latency", 2406.1573, 7.3333, 2398.824, 99.7)


def test_cold_dataset(spark):
    d = datasets(spark, [dataset("a", [1] * 24, "public-hot")])
    costs = {r["backend"]: round(r["cost_without_latency"], 4) for r in tier_costs(d).collect()}
    assert costs == {"on-prem": 1.3333, "private-cloud": 3.2333, "public-hot": 2.5867, "public-cold": 0.1813}
    assert tuple(one(evaluate_placement(d)))[2:] == (
        "public-cold", "cold-data-cooldown", 2.5867, 0.1813, 2.4053, 92.99)
    assert tuple(one(choose_best_backend(d))) == ("a", "public-cold", "cold-data-cooldown")


def test_cost_summary(spark):
    d = datasets(spark, [dataset("a", [1] * 24), dataset("b", [1000] * 24, "public-hot")])
    j = jobs(spark, [job("1", status="COMPLETE"), job("2"), job("3", status="FAILED")])
    s = one(cost_summary(d, j))
    assert abs(s.savings - (s.baseline - s.optimized)) < 0.011
    assert set(s.asDict()) == {
        "baseline", "optimized", "migration_cost", "savings", "savings_percent", "unpriced_datasets"}


def test_cost_summary_golden(spark):
    # The golden row has another initial than current tier for the second dataset.
    d = datasets(spark, [
        dataset("a", [1] * 24, "public-cold", initial="public-cold"),
        dataset("b", [1000] * 24, "public-hot", initial="public-cold"),
    ])
    s = one(cost_summary(d, jobs(spark, [job("1", status="COMPLETE")])))
    assert tuple(s) == (9633.94, 1139.41, 0.0, 8494.53, 88.17, 0)


def test_hysteresis_hold(spark):
    d = datasets(spark, [dataset("a", [0] * 23 + [101], size=60000.0, writes=[0] * 24)])
    p = one(evaluate_placement(d))
    assert (p.target_backend, p.reason, p.savings) == ("public-cold", "hysteresis-hold", 0.0)
    assert round(p.current_cost, 3) == round(p.target_cost, 3) == 404.008


def test_no_history(spark):
    d = datasets(spark, [dataset("a", None), dataset("b", [])])
    assert {tuple(r)[2:] for r in evaluate_placement(d).collect()} == {
        ("public-cold", "insufficient-history", 0.0, 0.0, 0.0, 0.0)}
    assert {tuple(r)[1:] for r in forecast_access(d).collect()} == {(0.0, 0.0, 0)}


def test_missing_values_count_as_zero(spark):
    row = list(dataset("a", [None, 10], writes=[None, 4]))
    row[3] = None
    d = datasets(spark, [tuple(row)])
    s = one(access_stats(d))
    assert (s.n, s.avg_reads, s.peak_reads, s.avg_writes) == (2, 5.0, 10, 2.0)
    assert one(evaluate_placement(d)).current_cost > 0


@pytest.mark.parametrize("hours", [24, 12, 8, 4])
def test_short_histories(spark, hours):
    lengths = [1, 5, 6, 11, 12, 13, 24, 30]
    d = datasets(spark, [dataset(str(n), [(i * 37) % 50 for i in range(n)], writes=[i % 3 for i in range(n)])
                         for n in lengths])
    got = {r["dataset_id"]: (r["reads"], r["writes"]) for r in forecast_access(d, hours).collect()}
    want = by_sql(d, lambda o: o.forecast(o.window("ranked", hours), "state", hours), "dataset_id, fc_reads, fc_writes")
    assert len(want) == len(lengths)
    for name, reads, writes in want:
        assert got[name] == pytest.approx((reads, writes))


def test_forecast_golden(spark):
    # Means 0 and 12 of the older and the newer half: the trend is cut to 2. Then falling load, cut to 0.7.
    d = datasets(spark, [dataset("up", [0] * 6 + [12] * 6), dataset("down", [100] * 6 + [10] * 6), dataset("one", [7])])
    got = {r["dataset_id"]: r["reads"] for r in forecast_access(d).collect()}
    assert got == pytest.approx({"up": 12 * 2 * 24, "down": 10 * 0.7 * 24, "one": 7 * 24})


def test_unknown_tier_is_reported_and_left_out(spark):
    d = datasets(spark, [dataset("a", [5] * 3, "tape"), dataset("b", [5] * 3), dataset("c", [], "tape")])
    assert [r["dataset_id"] for r in unpriced(d).collect()] == ["a"]
    assert {r["dataset_id"] for r in evaluate_placement(d).collect()} == {"b", "c"}
    assert one(baseline_cost(d)).baseline > 0


def test_prices(spark):
    assert [r["backend"] for r in price_table(spark).orderBy("ord").collect()] == [
        "on-prem", "private-cloud", "public-hot", "public-cold"]


DECIDED = "dataset_id, target_backend, reason, current_cost, target_cost"
BOUNDARIES = [
    ([99] * 24, 10.0, "public-cold"), ([100] * 24, 10.0, "public-cold"), ([0] * 23 + [100], 10.0, "on-prem"),
    ([0] * 23 + [99], 10.0, "public-cold"), ([10] * 24, 500.0, "on-prem"), ([10] * 23 + [11], 500.0, "on-prem"),
    ([20] * 12 + [80] * 12, 100.0, "public-hot"), ([0] * 24, 0.0, "public-hot"), ([50] * 18 + [99] * 6, 5.0, "on-prem"),
]


@pytest.mark.parametrize("limits", [(100, 10), (40, 60), (10, 5), (400, 500)])
def test_boundaries(spark, limits):
    d = datasets(spark, [dataset(str(i), r, t, s) for i, (r, s, t) in enumerate(BOUNDARIES)])
    got = {r["dataset_id"]: r for r in evaluate_placement(d, Limits(hot_reads=limits[0], cold_reads=limits[1])).collect()}
    want = by_sql(d, lambda o: o.place("fc", *limits), DECIDED)
    assert len(want) == len(BOUNDARIES)
    for name, target, why, here, there in want:
        assert (got[name].target_backend, got[name].reason) == (target, why), name
        assert (got[name].current_cost, got[name].target_cost) == pytest.approx((here, there), abs=1.5e-4)  # both are rounded


def test_boundaries_golden(spark):
    # 100 reads are hot, 99 are not; an average of 10 is cold, above 10 it is not.
    d = datasets(spark, [dataset("a", [0] * 23 + [100]), dataset("b", [0] * 23 + [99]), dataset("c", [10] * 24, "on-prem", 500.0),
                         dataset("d", [10] * 23 + [11], "on-prem", 500.0)])
    got = {r["dataset_id"]: r["reason"] for r in evaluate_placement(d).collect()}
    assert got == {"a": "hot-read-low-latency", "b": "cold-data-cooldown", "c": "cold-data-cooldown",
                   "d": "forecasted-cost-reduction"}


CASE = st.tuples(
    st.lists(st.integers(0, 300), max_size=30), st.floats(0, 50000).map(lambda x: round(x, 2)),
    st.sampled_from(["on-prem", "private-cloud", "public-hot", "public-cold"]), st.integers(0, 30),
    st.sampled_from([0.01, 0.1, 1.0]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(CASE, min_size=20, max_size=40))
def test_placement_equals_the_sql(spark, cases):
    rows = []
    for reads, size, tier, w, f in cases:
        reads = [int(x * f) for x in reads]
        rows.append((reads, [(w + i) % 7 for i in range(len(reads))], size, tier))
    d = datasets(spark, [dataset(str(i), r, t, s, w or None) for i, (r, w, s, t) in enumerate(rows)])
    got = {r["dataset_id"]: r for r in evaluate_placement(d).collect()}
    for name, target, why, here, there in by_sql(d, lambda o: o.place("fc"), DECIDED):
        g = got[name]
        assert (g.current_cost, g.target_cost) == pytest.approx((here, there), abs=1.5e-4)  # both are rounded
        assert g.target_backend == target or abs(here - there) < 1e-9
        assert g.reason == why
