import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight.operators import gold, silver


def test_season_labels(frame):
    df = frame("seasonality_index string", (" Favorable",), ("Un-Favorable",), ("Other",), (None,))
    out = silver.season_to_number(df)
    assert rows(out, "seasonality_label", "seasonality_index") == [
        (None, None), ("Favorable", 1.15), ("Other", None), ("Un-Favorable", 0.85),
    ]


def test_main_distributor_and_province(frame):
    tx = frame("outlet_id string, distributor_id string", ("a", "DIST_W_02"), ("a", "DIST_C_01"), ("b", "DIST_NW_01"),
               ("b", "DIST_NW_01"), ("b", "DIST_S_01"), ("c", None))
    out = silver.enrich_outlets(frame("outlet_id string", ("a",), ("b",), ("c",)), None, tx)
    assert rows(out, "outlet_id", "distributor_id", "province") == [
        ("a", "DIST_C_01", "Central"), ("b", "DIST_NW_01", "North-Western"), ("c", None, None),
    ]
    assert rows(silver.enrich_outlets(frame("outlet_id string", ("a",)))) == [("a", None)]


@pytest.fixture
def lines(frame):
    return frame(
        "outlet_id string, year int, month int, distributor_id string, sku_id string, volume_liters double, "
        "total_bill_value double, at int",
        ("a", 2024, 1, None, "s1", 10.0, 1.0, 1), ("a", 2024, 1, "d2", "s2", -4.0, 1.0, 2), ("a", 2024, 1, "d1", None, None, None, 3),
        (None, 2024, 1, "d1", "s1", 5.0, 1.0, 4), ("z", 2024, 1, "d1", "s1", None, 1.0, 5),
    )


def test_monthly_totals(lines):
    out = {r.outlet_id: r for r in gold.monthly_totals(gold.split_volumes(lines), ["at"]).collect()}
    a = out["a"]
    assert (a.volume_total, a.volume_gross, a.volume_returns, a.volume_purchases) == (6.0, 14.0, 4.0, 10.0)
    assert (a.sku_diversity, a.n_lines, a.distributor_id) == (2, 3, "d2")
    assert out["z"].volume_total == 0.0  # a sum of nothing is 0
    assert out[None].volume_total == 5.0  # missing keys stay


def test_flags(frame):
    df = frame(
        "outlet_id string, volume_total double, sku_diversity int",
        ("a", 100.0, 3), ("a", 90.0, 1), ("a", 44.0, 3), ("a", 0.0, 3), ("a", -150.0, 3), ("a", 101.0, 3), (None, 1.0, 2),
    )
    out = {(r.outlet_id, r.volume_total): r for r in gold.flag_constraints(df).collect()}
    # the median month is 67
    low = {k for k, r in out.items() if r.low_volume_flag}
    assert low == set()
    out = {r.volume_total: r for r in gold.flag_constraints(df.where("volume_total > 40")).collect()}
    assert {k for k, r in out.items() if r.low_volume_flag} == {44.0}
    assert {k for k, r in out.items() if r.low_sku_diversity_flag} == {90.0}
    assert {k for k, r in out.items() if r.credit_cap_flag} == {100.0}
    assert {k for k, r in out.items() if r.is_constrained} == {44.0, 90.0, 100.0}


def test_deflate(frame):
    months = frame("distributor_id string, year int, month int, volume_total double", ("d", 2024, 1, 10.0), ("e", 2024, 1, 10.0), ("f", 2024, 1, 9.0))
    season = frame(
        "distributor_id string, year int, month int, seasonality_index double, at int",
        ("d", 2024, 1, 0.8, 1), ("d", 2024, 1, 2.0, 2), ("e", 2024, 1, 0.0, 3),
    )
    out = gold.deflate(months, season, season_order=["at"])
    assert rows(out, "distributor_id", "volume_total_deflated") == [("d", 12.5), ("e", 10.0), ("f", 9.0)]
    assert rows(gold.deflate(months, None), "seasonality_index") == [(1.0,)] * 3


def test_roll_up(frame):
    schema = "outlet_id string, volume_total double, volume_total_deflated double, is_constrained boolean, sku_diversity int, return_share double, bill_total double"
    df = frame(schema, ("a", 10.0, 10.0, False, 2, 0.0, 1.0), ("a", 20.0, 20.0, False, 4, 0.5, 3.0), ("a", 60.0, 50.0, True, 3, 0.0, 2.0),
               ("b", 7.0, 7.0, True, 1, 0.0, 1.0), (None, 1.0, 1.0, False, 1, 0.0, 1.0))
    out = {r.outlet_id: r for r in gold.roll_up(df).collect()}
    assert set(out) == {"a", "b"}
    a, b = out["a"], out["b"]
    assert (a.months_observed, a.months_constrained, a.months_unconstrained, a.unc_months) == (3, 1, 2, 2)
    assert a.hist_total_p90 == pytest.approx(52.0) and a.unc_deflated_p90 == pytest.approx(19.0)
    assert (a.hist_total_median, a.hist_total_max, a.unc_deflated_max, a.unc_deflated_mean) == (20.0, 60.0, 20.0, 15.0)
    assert b.hist_total_std is None and b.unc_months is None and b.unc_deflated_max is None


def test_one_hot_and_ratios(frame):
    df = frame("outlet_size string, hist_total_std double, hist_total_max double, hist_total_mean double", ("Small", 1.0, 4.0, 2.0), (None, 1.0, 4.0, 0.0))
    out = rows(gold.with_ratios(gold.one_hot(df)), "size_Small", "size_Large", "volume_cv", "max_to_mean_ratio")
    assert out == [(0, 0, None, None), (1, 0, 0.5, 2.0)]
    assert gold.vocabulary(df, {"outlet_size": ("size", ["Huge"]), "gone": ("g", [])}) == {"outlet_size": ("size", ["Huge", "Small"])}


def test_constraint_uplift(frame):
    schema = "o string, months_observed int, months_constrained int, unc_deflated_mean double, hist_total_mean double"
    df = frame(
        schema,
        ("usual", 4, 2, 15.0, 10.0),  # gap 1.5
        ("below", 4, 4, 5.0, 10.0),  # gap clipped to 1
        ("above", 4, 4, 90.0, 10.0),  # gap clipped to 2, uplift to 1.6
        ("no free month", 4, 4, None, 10.0),  # median gap 1.5
        ("zero mean", 4, 2, 5.0, 0.0),
        ("no months", None, None, None, None),
    )
    out = dict(rows(gold.with_constraint_uplift(df), "o", "constraint_uplift"))
    assert out == {
        "usual": 1.25, "below": 1.0, "above": 1.6, "no free month": 1.5, "zero mean": 1.25, "no months": 1.0,
    }
    alone = frame(schema, ("x", 4, 4, None, None))
    assert rows(gold.with_constraint_uplift(alone), "constraint_uplift") == [(1.0,)]


def test_season_index_falls_back_only_as_a_whole(frame):
    features = frame("outlet_id string, distributor_id string", ("a", "d"), ("b", "e"), ("c", None))
    schema = "distributor_id string, year int, month int, seasonality_index double"
    both = frame(schema, ("d", 2026, 1, 1.15), ("d", 2025, 1, 0.85), ("e", 2025, 1, 0.85))
    assert rows(gold.with_season_index(features, both), "outlet_id", "seasonality_jan_index") == [("a", 1.15), ("b", 1.0), ("c", 1.0)]
    old = both.where("year = 2025").union(frame(schema, ("e", 2026, 2, 1.0)))
    assert rows(gold.with_season_index(features, old), "outlet_id", "seasonality_jan_index") == [("a", 0.85), ("b", 0.85), ("c", 1.0)]
    assert rows(gold.with_season_index(features, None), "seasonality_jan_index") == [(1.0,)] * 3


def test_monthly_plan_groups_the_roll_up_without_another_shuffle(spark, lines, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monthly = gold.outlet_monthly(lines, None, ["at"])
        monthly.explain()
        alone = capsys.readouterr().out
        gold.roll_up(monthly).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange") <= alone.count("Exchange") and plan.count("Exchange hashpartitioning(outlet_id") == 1


def test_lines_are_summed_up_by_hash_aggregates(spark, lines, capsys, monkeypatch):
    """What goes over all lines is no sort; the months of several distributors are the exception."""
    plans = []

    def stage(df, name):
        df.explain()
        plans.append((name, capsys.readouterr().out))
        return df

    monkeypatch.setattr(gold, "stage", stage)
    gold.monthly_totals(gold.split_volumes(lines), ["at"])
    assert [name for name, _ in plans] == ["month_totals", "first_distributors"]
    assert "SortAggregate" not in plans[0][1] and "HashAggregate" in plans[0][1]


def test_months_do_not_read_the_source_again(spark, lines, tmp_path):
    """The lines are written once; the table of months is put together from written tables alone."""
    lines.write.parquet(f"{tmp_path}/source")
    months = gold.monthly_totals(gold.split_volumes(spark.read.parquet(f"{tmp_path}/source")), ["at"])
    assert not [f for f in months.inputFiles() if str(tmp_path) in f]
    assert sorted(r.n_lines for r in months.collect()) == [1, 1, 3]


def test_tables_of_outlets_are_not_broadcast_and_made_once(spark, tmp_path):
    """A file of keys is small, but not what is made of its rows; and the counts of categories do not read the source again."""
    spark.range(60).selectExpr("id", "id * 0.01 AS latitude", "id * 0.02 AS longitude").write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source").withColumn("outlet_id", F.concat(F.lit("OUT_"), "id"))
    outlets = silver.enrich_outlets(source.select("outlet_id", F.lit("Kiosk").alias("outlet_type")), source)
    plan = outlets._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    months = spark.createDataFrame([("OUT_1", 2024, 1, 5.0, 5.0, False, 2, 0.0, 1.0)], "outlet_id string, year int, month int, volume_total double, "
                                   "volume_total_deflated double, is_constrained boolean, sku_diversity long, return_share double, bill_total double")
    found = gold.outlet_features(outlets, months, source.select("outlet_id", F.col("id").alias("poi_total_500m")))
    assert [r.poi_total_500m for r in found.where("months_observed = 1").collect()] == [1] and found.count() == 60
    made = gold.outlet_features(outlets, months)
    assert made.count() == 60 and not [f for f in made.inputFiles() if str(tmp_path) in f]


def test_lines_of_mixed_months_are_not_shuffled(spark, lines, capsys, monkeypatch):
    """The first distributor of a month of several comes from an aggregate, whose lines combine before the shuffle; no join moves the lines."""
    plans = []

    def stage(df, name):
        df.explain()
        plans.append(capsys.readouterr().out)
        return df

    monkeypatch.setattr(gold, "stage", stage)
    gold.monthly_totals(gold.split_volumes(lines), ["at"])
    assert plans[1].count("Exchange") == 1 and not any("Join" in p for p in plans)
