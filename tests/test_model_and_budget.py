import heapq
import itertools
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight import config
from shelfsight.operators import budget, model, quantile_regression
from shelfsight.session import stage

ESTIMATES = "peer_ceiling double, quantile_regression double, unconstrained_extrapolation double"


def test_blend(frame):
    df = frame(ESTIMATES, (10.0, 20.0, 30.0), (10.0, None, None), (None, None, None), (10.0, -1.0, 20.0))
    out = [r[0] for r in df.select(model.blend()).collect()]
    assert out[:2] == [pytest.approx(19.0), pytest.approx(10.0)] and out[2] is None
    assert out[3] == pytest.approx((4 + 6) / 0.7)


def test_floored_blend(frame):
    df = frame("b double, m double", (5.0, 9.0), (None, 9.0), (12.0, 9.0), (None, None))
    assert [r[0] for r in df.select(model.floored_blend(F.col("b"), F.col("m"))).collect()] == [9.0, 9.0, 12.0, 0.0]


def test_peer_ceiling(frame):
    df = frame(
        "outlet_id string, peer_cluster int, unc_deflated_p90 double, hist_total_median double",
        *[(f"o{i}", 0, float(i), float(i)) for i in range(1, 12)], ("zero", 1, 4.0, 0.0), ("empty", 2, None, None),
    )
    out = dict(rows(model.with_peer_ceiling(df), "outlet_id", "peer_ceiling"))
    assert out["o6"] == pytest.approx(10.0)  # p90 of 1..11 is 10, own size is the median
    assert out["o1"] == pytest.approx(5.0) and out["o11"] == pytest.approx(10.0 * 11 / 6)
    assert out["zero"] == 4.0 and out["empty"] is None


def test_multiplicative_floor_and_cap(frame):
    df = frame(
        "outlet_id string, peer_cluster int, peer_ceiling double, constraint_uplift double, seasonality_jan_index double, hist_total_max double",
        ("plain", 0, 50.0, 1.2, 1.0, 40.0), ("floor", 0, 10.0, 1.0, 1.0, 60.0), ("cap", 0, 500.0, 1.0, 1.0, 100.0),
        ("no base", 0, None, 1.5, 1.0, 30.0), ("no factor", 0, 50.0, None, None, 20.0), ("nothing", 1, None, None, None, None),
    )
    out = dict(rows(model.with_multiplicative(df), "outlet_id", "mult_potential"))
    assert out == {"plain": 60.0, "floor": 60.0, "cap": 160.0, "no base": 30.0, "no factor": 50.0, "nothing": 0.0}


def test_extrapolation(frame):
    df = frame("outlet_id string, distributor_id string, unc_deflated_max double, months_unconstrained int",
               ("a", "d", 10.0, 2), ("b", "d", 10.0, 1), ("c", "e", 10.0, 5), ("x", None, 10.0, None))
    season = frame("distributor_id string, year int, month int, seasonality_index double", ("d", 2025, 1, 1.15), ("e", 2025, 1, 0.0))
    out = dict(rows(model.with_extrapolation(df, season), "outlet_id", "unconstrained_extrapolation"))
    assert out == {"a": 11.5, "b": None, "c": 10.0, "x": None}


def test_divergence_and_guards(frame):
    df = frame("outlet_id string, mult_potential double, ensemble_potential double", ("a", 200.0, 100.0), ("b", 110.0, 100.0), ("c", 1.0, 0.0))
    out = model.with_divergence(df)
    assert rows(out, "outlet_id", "divergence_pct", "divergence_flag") == [("a", 100.0, True), ("b", 10.0, False), ("c", None, False)]
    s = model.divergence_summary(out).first()
    assert s.median_abs_divergence_pct == 55.0 and s.share_within_25pct == pytest.approx(1 / 3) and s.n_flagged_outlets == 1
    model.require_sound(df)
    with pytest.raises(ValueError):
        model.require_sound(frame("mult_potential double", (None,), (-1.0,)))


def test_column_selection(frame):
    df = frame(
        "outlet_id string, poi_total_500m int, poi_accessibility double, latitude double, hist_total_p90 double, "
        "hist_total_median double, hist_deflated_max double, constraint_uplift double, flag boolean",
        ("a", 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, True),
    )
    assert model.peer_columns(df) == ["poi_total_500m", "poi_accessibility", "latitude", "hist_total_p90", "hist_total_median"]
    assert model.regression_columns(df, "hist_deflated_max") == [
        "poi_total_500m", "poi_accessibility", "latitude", "hist_total_median", "constraint_uplift", "flag",
    ]


@pytest.fixture(scope="module")
def synthetic(spark):
    rng = random.Random(1)
    data = []
    for i in range(600):
        x, size = rng.random() * 10, rng.expovariate(1)
        data.append((f"o{i}", x, rng.random() * 50, 3.0 * x + 5 * size + rng.expovariate(0.2), 2.0 * x + size, None))
    return spark.createDataFrame(
        data,
        "outlet_id string, poi_total_500m double, latitude double, hist_deflated_max double, hist_total_median double, empty double",
    ).persist()


def test_feature_matrix_drops_empty_columns(synthetic):
    matrix, used = model.feature_matrix(synthetic, ["poi_total_500m", "empty"])
    assert used == ["poi_total_500m"] and matrix.count() == 600


def test_feature_values(frame):
    df = frame("id int, a double, b int, same double", (1, 1.0, None, 0.1), (2, None, 4, 0.1), (3, 2.0, 8, 0.1), (4, float("nan"), 6, 0.1), (5, 9.0, 6, 0.1))
    values, used = model.feature_values(df, ["a", "b", "same"], keep=("id",))
    got = {r.id: r.features for r in values.collect()}
    assert used == ["a", "b", "same"]
    for k, column in enumerate(([1, 2, 2, 2, 9], [6, 4, 8, 6, 6])):
        z = (np.array(column) - np.mean(column)) / np.std(column)
        assert [got[i + 1][k] for i in range(5)] == pytest.approx(z.tolist())
    assert [v[2] for v in got.values()] == pytest.approx([0.0] * 5)
    assert model.feature_values(df.where("false"), ["a"], keep=("id",))[1] == []


def test_clusters(synthetic):
    rules = config.ModelRules(clusters=4, cluster_tries=2)
    a = rows(model.peer_clusters(synthetic, rules))
    assert len({c for _, c in a}) <= 4 and len(a) == 600
    assert a == rows(model.peer_clusters(synthetic, rules))
    assert {c for _, c in rows(model.peer_clusters(synthetic.limit(3), rules))} == {0}


def vertex_optimum(x, y, tau, l1):
    """The least penalised loss: some optimum has as many zeros among residuals and weights as there are unknowns."""
    n, p = len(y), x.shape[1] + 1
    full = np.column_stack([np.ones(n), x])
    lines = np.vstack([full, np.eye(p)[1:]])
    values = np.concatenate([y, np.zeros(p - 1)])
    picks = np.array(list(itertools.combinations(range(len(lines)), p)))
    systems = lines[picks]
    usable = np.abs(np.linalg.det(systems)) > 1e-9
    found = np.linalg.solve(systems[usable], values[picks[usable]][..., None])[..., 0]
    r = y - found @ full.T
    return (np.maximum(tau * r, (tau - 1) * r).mean(axis=1) + l1 * np.abs(found[:, 1:]).sum(axis=1)).min()


@pytest.mark.parametrize("l1", [0.0, 0.001, 0.3, 50.0])
@pytest.mark.parametrize("tau", [0.9, 0.5])
def test_quantile_fit_reaches_the_optimum(spark, tau, l1):
    r = np.random.default_rng(3)
    x = r.normal(size=(40, 2))
    y = 5 + 2 * x[:, 0] + r.exponential(3, 40)
    rows_ = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, label double")
    found = quantile_regression.fit(rows_, tau, l1)
    best = vertex_optimum(x, y, tau, l1)
    own = y - found.intercept - x @ found.weights
    assert found.loss == pytest.approx(np.maximum(tau * own, (tau - 1) * own).mean() + l1 * np.abs(found.weights).sum())
    assert best - 1e-9 <= found.loss <= best + 2e-6 * y.std() and found.loss - found.gap <= best + 1e-9
    if l1 == 50.0:
        assert np.abs(found.weights).max() < 1e-6
    got = [v[0] for v in rows_.select(found.predict(F.col("features"))).collect()]
    assert got == pytest.approx((found.intercept + x @ found.weights).tolist())


def test_quantile_fit_with_odd_rows(spark):
    one = spark.createDataFrame([([1.0, 1.0], 3.0)] * 5, "features array<double>, label double")
    assert quantile_regression.fit(one, 0.9).loss < 1e-6
    r = np.random.default_rng(5)
    x = r.normal(size=200)
    twice = spark.createDataFrame([([float(a), float(a)], float(3 * a + e)) for a, e in zip(x, r.exponential(1, 200))], one.schema)
    alone = spark.createDataFrame([([float(a)], float(b.label)) for a, b in zip(x, twice.collect())], one.schema)
    both, single = quantile_regression.fit(twice, 0.9), quantile_regression.fit(alone, 0.9)
    assert both.loss == pytest.approx(single.loss, abs=1e-5)
    with pytest.raises(quantile_regression.Unsettled):
        quantile_regression.fit(twice, 0.9, rounds=2)


@pytest.mark.parametrize("tau", [0.85, 0.9, 0.95, 0.99])
def test_quantile_fit_settles_where_most_labels_lie_on_a_plane(spark, tau):
    r = np.random.default_rng(11)
    x = r.normal(size=(6000, 30)) ** 3
    x[:, 20:] = (x[:, 20:] > 0.5).astype(float)
    y = 200 + 60 * x[:, 0] + np.where(r.random(6000) < 0.02, r.normal(20, 60, 6000), 0.0)
    rows_ = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, label double")
    found = quantile_regression.fit(rows_, tau)
    assert found.gap <= 1e-6 * y.std() and found.weights[0] == pytest.approx(60, rel=0.01)


@pytest.mark.parametrize("tau", [0.5, 0.9])
def test_quantile_fit_of_more_rows_than_the_driver_holds(spark, monkeypatch, tau):
    r = np.random.default_rng(13)
    x = r.normal(size=(8000, 3))
    y = 5 + 2 * x[:, 0] + r.exponential(3, 8000) * (1 + 0.5 * np.abs(x[:, 1]))
    y[:2000] = 5 + 2 * x[:2000, 0]
    schema = "features array<double>, label double"
    rows_ = stage(spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], schema).repartition(5), "fit")
    whole = quantile_regression.fit(rows_, tau)
    monkeypatch.setattr(quantile_regression, "HELD_BYTES", 20_000)
    held, solve = [], quantile_regression._solve
    monkeypatch.setattr(quantile_regression, "_solve", lambda x, *rest: held.append(len(x)) or solve(x, *rest))
    parts = quantile_regression.fit(rows_, tau)
    assert len(held) > 1 and max(held) < 1500
    own = y - parts.intercept - x @ parts.weights
    assert parts.loss == pytest.approx(np.maximum(tau * own, (tau - 1) * own).mean() + 0.001 * np.abs(parts.weights).sum())
    assert parts.gap <= 1e-6 * y.std() and parts.loss == pytest.approx(whole.loss, abs=2e-6 * y.std())
    assert parts.loss - parts.gap <= whole.loss + 1e-9


def test_quantile_fit_reads_its_rows_a_few_times(spark):
    r = np.random.default_rng(17)
    x = r.normal(size=(2000, 4))
    rows_ = stage(spark.createDataFrame([(a.tolist(), float(a[0] + b)) for a, b in zip(x, r.exponential(1, 2000))], "features array<double>, label double"), "fit")
    spark.sparkContext.setJobGroup("quantile_fit", "")
    try:
        quantile_regression.fit_all(rows_, [0.5, 0.9])
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantile_fit")) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quantile_regression_covers_tau(synthetic):
    est = quantile_regression.estimate(synthetic, tau=0.9)
    scored = synthetic.join(est, "outlet_id")
    c = quantile_regression.coverage(scored, "hist_deflated_max", 0.9).first()
    assert c.n == 600 and 0.87 <= c.coverage <= 0.93
    few = quantile_regression.estimate(synthetic.limit(20))
    assert {r.quantile_regression for r in few.collect()} == {None}


# ---------------------------------------------------------------------------
# Budget
# ---------------------------------------------------------------------------


def heap_split(headroom, rules):
    """One step at a time to the outlet that gains most."""
    factor = 1 - math.exp(-rules.k * rules.step)
    spend = dict.fromkeys(headroom, 0.0)
    heap = [(-h * factor, o) for o, h in sorted(headroom.items()) if h > 0]
    heapq.heapify(heap)
    left = rules.total
    while heap and left >= rules.step - 1e-9:
        _, o = heapq.heappop(heap)
        if spend[o] + rules.step > rules.cap + 1e-9:
            continue
        spend[o] += rules.step
        left -= rules.step
        heapq.heappush(heap, (-headroom[o] * math.exp(-rules.k * spend[o]) * factor, o))
    return {o: s for o, s in spend.items() if s > 0}


CASES = {
    "usual": (config.BudgetRules(total=200_000.0), [random.Random(5).expovariate(1 / 300) for _ in range(60)]),
    "ties": (config.BudgetRules(total=100_000.0), [100.0] * 15 + [50.0] * 10),
    "budget below a step": (config.BudgetRules(total=4_999.0), [10.0, 20.0]),
    "cap below a step": (config.BudgetRules(cap=4_999.0), [10.0, 20.0]),
    "no headroom": (config.BudgetRules(), [0.0, 0.0]),
    "more than fits": (config.BudgetRules(total=10_000_000.0), [10.0, 20.0, 0.0]),
    "cap binds": (config.BudgetRules(total=60_000.0, cap=10_000.0), [1000.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]),
    "many ties": (config.BudgetRules(total=135_000.0, cap=15_000.0), [100.0] * 40),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("close_steps", [1_000_000, 3])
def test_split_equals_one_step_at_a_time(spark, case, close_steps):
    rules, values = CASES[case]
    headroom = {f"o{i:03d}": v for i, v in enumerate(values)}
    df = spark.createDataFrame(list(headroom.items()), "outlet_id string, headroom double")
    got = {r.outlet_id: r.steps * rules.step for r in budget.greedy_steps(df, rules, close_steps).collect()}
    assert got == heap_split(headroom, rules)


def test_inputs_and_reports(frame):
    features = frame(
        "outlet_id string, distributor_id string, province string, hist_total_median double",
        ("a", "d1", "Western", 10.0), ("b", "d2", "Western", None), ("c", "d1", "Southern", 1.0), ("e", None, "Western", 50.0),
    )
    factors = frame("outlet_id string, mult_potential double", ("a", 110.0), ("b", 40.0), ("c", 5.0))
    inputs = budget.allocation_inputs(features, factors)
    assert rows(inputs, "outlet_id", "headroom") == [("a", 100.0), ("b", 40.0), ("e", 0.0)]
    rules = config.BudgetRules(total=20_000.0)
    spent = budget.allocate(inputs, rules)
    out = dict(rows(spent, "outlet_id", "trade_spend_lkr"))
    assert out == {"a": 20_000.0, "b": 0.0, "e": 0.0}
    a = spent.where("outlet_id = 'a'").first()
    assert a.expected_incremental_liters == pytest.approx(100 * (1 - math.exp(-0.1)))
    assert a.headroom_captured_frac == pytest.approx(1 - math.exp(-0.1))
    budget.require_valid(spent, rules)
    with pytest.raises(ValueError):
        budget.require_valid(spent, config.BudgetRules(total=10_000.0))
    by = {r.distributor_id: r for r in budget.by_distributor(spent).collect()}
    assert set(by) == {"d1", "d2"} and by["d2"].lkr_per_incremental_liter is None and by["d1"].outlets_funded == 1
    s = budget.allocation_summary(spent, rules).first()
    assert (s.n_outlets_total, s.n_outlets_funded, s.spend_p50_funded, s.allocated_lkr) == (3, 1, 20_000.0, 20_000.0)
