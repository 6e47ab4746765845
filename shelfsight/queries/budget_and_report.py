"""Queries for the budget split, the reports and the profiles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from shelfsight import config
from shelfsight.operators import budget, model, profile, quantile_regression, report
from shelfsight.operators.engine import union_rejects
from shelfsight.queries import prepared
from shelfsight.queries.base import query, rounded, sql
from shelfsight.queries.blocks import MASTER_DOUBLES, block
from shelfsight.queries.sources_and_checks import all_results, blackouts, constant_runs, d10
from shelfsight.session import stage
from shelfsight.sources.adapters import SOURCE_TABLES, Tables

# ---------------------------------------------------------------------------
# Budget
# ---------------------------------------------------------------------------

_SPEND = "spend_lkr incremental_liters"


@query(
    "b1_allocation_inputs",
    sql("SELECT * FROM headrooms", "headrooms", doubles="hist_total_median potential historical headroom", digits=4),
)
def b1(t: Tables) -> DataFrame:
    s = prepared.scored(t)
    return rounded(budget.allocation_inputs(s, model.factor_table(s)), 4)


@query("b2_greedy_steps", sql("SELECT * FROM steps", "steps"))
def b2(t: Tables) -> DataFrame:
    s = prepared.scored(t)
    return budget.greedy_steps(budget.allocation_inputs(s, model.factor_table(s)))


@query("b2_threshold_steps", sql("SELECT * FROM steps", "steps"))
def b2_threshold(t: Tables) -> DataFrame:
    """The same split with the search for the two gains carried on, as for very many steps."""
    s = prepared.scored(t)
    return budget.greedy_steps(budget.allocation_inputs(s, model.factor_table(s)), close_steps=100)


@query(
    "b3_expected_lift",
    sql(
        "SELECT outlet_id, expected_incremental_liters FROM allocated",
        "allocated",
        doubles="expected_incremental_liters",
        digits=4,
    ),
)
def b3(t: Tables) -> DataFrame:
    a = prepared.allocated(t)
    lift = budget.lift(F.col("headroom"), F.col("trade_spend_lkr"))
    return rounded(a.select("outlet_id", lift.alias("expected_incremental_liters")), 4)


@query(
    "b4_captured_share",
    sql("SELECT outlet_id, headroom_captured_frac FROM allocated", "allocated", doubles="headroom_captured_frac"),
)
def b4(t: Tables) -> DataFrame:
    s = prepared.scored(t)
    spent = budget.allocate(budget.allocation_inputs(s, model.factor_table(s)))
    return rounded(spent.select("outlet_id", "headroom_captured_frac"))


@query(
    "b5_allocation_faults",
    sql(
        """SELECT sum(trade_spend_lkr) AS total_spend, count(*) FILTER (trade_spend_lkr < 0) AS n_negative,
                  count(*) FILTER (trade_spend_lkr % 5000 <> 0) AS n_off_step FROM allocated""",
        "allocated",
        doubles="total_spend",
        digits=2,
    ),
)
def b5(t: Tables) -> DataFrame:
    return rounded(budget.allocation_faults(prepared.allocated(t)), 2)


@query(
    "b6_allocations",
    sql(
        """SELECT outlet_id AS "Outlet_ID", CAST(trade_spend_lkr AS DOUBLE) AS "Trade_Spend_Allocation_LKR" FROM allocated""",
        "allocated",
    ),
)
def b6(t: Tables) -> DataFrame:
    return budget.allocation_deliverable(prepared.allocated(t))


block(
    "by_distributor",
    "allocated",
    """
SELECT distributor_id, count(*) AS outlets, count(*) FILTER (trade_spend_lkr > 0) AS outlets_funded,
       CAST(sum(trade_spend_lkr) AS DOUBLE) AS spend_lkr, sum(expected_incremental_liters) AS incremental_liters
FROM allocated WHERE distributor_id IS NOT NULL GROUP BY distributor_id""",
)


@query(
    "b7_by_distributor",
    sql(
        "SELECT *, round_even(spend_lkr / nullif(incremental_liters, 0), 2) AS lkr_per_incremental_liter FROM by_distributor",
        "by_distributor",
        doubles=_SPEND,
        digits=4,
    ),
)
def b7(t: Tables) -> DataFrame:
    return rounded(budget.by_distributor(prepared.allocated(t)), 4)


@query(
    "b8_allocation_summary",
    sql(
        """SELECT 'Western' AS province, CAST(5000000 AS DOUBLE) AS budget_lkr, CAST(sum(trade_spend_lkr) AS DOUBLE) AS allocated_lkr,
                  count(*) AS n_outlets_total, count(*) FILTER (trade_spend_lkr > 0) AS n_outlets_funded,
                  round_even(sum(expected_incremental_liters), 1) AS total_incremental_liters,
                  round_even(sum(trade_spend_lkr) / nullif(sum(expected_incremental_liters), 0), 2) AS blended_lkr_per_incremental_liter,
                  CAST(max(trade_spend_lkr) AS DOUBLE) AS max_spend_outlet,
                  CAST(coalesce(median(trade_spend_lkr) FILTER (trade_spend_lkr > 0), 0) AS DOUBLE) AS spend_p50_funded
           FROM allocated""",
        "allocated",
    ),
)
def b8(t: Tables) -> DataFrame:
    return budget.allocation_summary(prepared.allocated(t))


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------


@query("r1_master", sql("SELECT * FROM master", "master", doubles=MASTER_DOUBLES, digits=4))
def r1(t: Tables) -> DataFrame:
    return rounded(prepared.master(t), 4, poi_accessibility=8)


@query(
    "r2_factor_product",
    sql("SELECT outlet_id, raw_factor_product FROM master", "master", doubles="raw_factor_product", digits=3),
)
def r2(t: Tables) -> DataFrame:
    f = model.factor_table(prepared.scored(t))
    return rounded(f.select("outlet_id", report.raw_product().alias("raw_factor_product")), 3)


_CHOICE = {
    "provinces": ("Western", "Southern"),
    "distributors": ("DIST_W_01", "DIST_W_03", "DIST_S_02"),
    "types": ("Grocery", "Kiosk"),
    "id_pattern": "out_.*[13579]$",
}
_CHOICE_SQL = """province IN ('Western', 'Southern') AND distributor_id IN ('DIST_W_01', 'DIST_W_03', 'DIST_S_02')
  AND outlet_type IN ('Grocery', 'Kiosk') AND regexp_matches(outlet_id, '(?i)out_.*[13579]$')"""


@query(
    "r3_filter",
    sql(f"SELECT outlet_id, mult_potential FROM master WHERE {_CHOICE_SQL}", "master", doubles="mult_potential", digits=3),
)
def r3(t: Tables) -> DataFrame:
    return rounded(prepared.master(t).where(report.selection(**_CHOICE)).select("outlet_id", "mult_potential"), 3)


@query(
    "r4_options",
    sql(
        "SELECT DISTINCT distributor_id FROM outlet_master WHERE province IN ('Western') AND distributor_id IS NOT NULL",
        "outlet_master",
    ),
)
def r4(t: Tables) -> DataFrame:
    return report.options(prepared.master(t).where(report.selection(provinces=["Western"])), "distributor_id")


@query(
    "r5_key_figures",
    sql(
        """SELECT count(*) AS outlets, median(mult_potential) AS median_potential, sum(mult_potential) AS total_potential,
                  median(mult_potential / nullif(hist_total_median, 0)) AS median_ratio_to_normal FROM master""",
        "master",
        doubles="median_potential total_potential median_ratio_to_normal",
        digits=4,
    ),
)
def r5(t: Tables) -> DataFrame:
    return rounded(report.key_figures(prepared.master(t)), 4)


@query(
    "r6_histogram",
    sql(
        """SELECT bin * w AS bin_start, (bin + 1) * w AS bin_end, n FROM (
             SELECT floor(mult_potential / w) AS bin, w, count(*) AS n FROM master, (
               SELECT unit * CASE WHEN need / unit <= 1 THEN 1 WHEN need / unit <= 2 THEN 2 WHEN need / unit <= 5 THEN 5 ELSE 10 END AS w
               FROM (SELECT need, power(10, floor(log10(need))) AS unit
                     FROM (SELECT (max(mult_potential) - min(mult_potential)) / 40 AS need FROM master) AS s) AS u) AS step
             WHERE mult_potential IS NOT NULL GROUP BY bin, w) AS b""",
        "master",
        doubles="bin_start bin_end",
    ),
)
def r6(t: Tables) -> DataFrame:
    return rounded(report.histogram(prepared.master(t), F.col("mult_potential")))


@query(
    "r7_by_province",
    sql(
        """SELECT province, count(mult_potential) AS outlets, median(mult_potential) AS "median_L", sum(mult_potential) AS "total_L"
           FROM master WHERE province IS NOT NULL GROUP BY province""",
        "master",
        doubles="median_L total_L",
        digits=3,
    ),
)
def r7(t: Tables) -> DataFrame:
    return rounded(report.by_province(prepared.master(t)), 3)


@query(
    "r8_geocoded",
    sql(
        "SELECT outlet_id, latitude AS lat, longitude AS lon FROM outlet_master WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
        "outlet_master",
        doubles="lat lon",
    ),
)
def r8(t: Tables) -> DataFrame:
    return rounded(report.geocoded(prepared.master(t)))


@query(
    "r9_outlet_table",
    sql(
        """SELECT outlet_id, province, distributor_id, outlet_type, outlet_size, mult_potential, hist_total_median, hist_total_max,
                  constraint_uplift, seasonality_jan_index, spatial_multiplier,
                  CASE WHEN "Trade_Spend_Allocation_LKR" IS NULL THEN 'N/A (non-Western)'
                       WHEN "Trade_Spend_Allocation_LKR" = 0 THEN '0 — not selected'
                       ELSE 'LKR ' || format('{:,}', CAST("Trade_Spend_Allocation_LKR" AS BIGINT)) END AS "Allocation (LKR)"
           FROM master""",
        "master",
        doubles="mult_potential hist_total_median hist_total_max constraint_uplift seasonality_jan_index spatial_multiplier",
        digits=4,
    ),
)
def r9(t: Tables) -> DataFrame:
    return rounded(report.outlet_table(prepared.master(t)), 4)


_WATERFALL = " UNION ALL ".join(
    f"SELECT outlet_id, '{stage}' AS stage, {value} AS value, {value} - {before} AS delta FROM master"
    for stage, value, before in (
        ("1 similar outlets", "peer_ceiling", "0"),
        ("2 months held back", "peer_ceiling * constraint_uplift", "peer_ceiling"),
        (
            "3 season",
            "peer_ceiling * constraint_uplift * seasonality_jan_index",
            "peer_ceiling * constraint_uplift",
        ),
        (
            "4 surroundings",
            "peer_ceiling * constraint_uplift * seasonality_jan_index * spatial_multiplier",
            "peer_ceiling * constraint_uplift * seasonality_jan_index",
        ),
        (
            "5 limits",
            "mult_potential",
            "peer_ceiling * constraint_uplift * seasonality_jan_index * spatial_multiplier",
        ),
    )
)


@query("r10_waterfall", sql(_WATERFALL, "master", doubles="value delta", digits=3))
def r10(t: Tables) -> DataFrame:
    return rounded(report.waterfall(prepared.master(t)).drop("note"), 3)


def _factor_note(column: str, why: str) -> str:
    return f"'factor ' || printf('%.3f', round({column}, 3)) || ': ' || {why}"


_NOTES = {
    "1 similar outlets": "'what the best of them sell in months without limits'",
    "2 months held back": _factor_note("constraint_uplift", "coalesce(months_constrained, 0) || ' of ' || coalesce(months_observed, 0) || ' months'"),
    "3 season": _factor_note("seasonality_jan_index", "'target month at ' || coalesce(distributor_id, 'no distributor')"),
    "4 surroundings": _factor_note("spatial_multiplier", "'places nearby against competitors nearby'"),
    "5 limits": "'no less than the own maximum, no more than the group allows'",
}


@query(
    "r10_waterfall_notes",
    sql(" UNION ALL ".join(f"SELECT outlet_id, '{stage}' AS stage, {note} AS note FROM master" for stage, note in _NOTES.items()), "master"),
)
def r10_notes(t: Tables) -> DataFrame:
    """Half-way factors are rounded up in both engines before they are formatted."""
    m = prepared.master(t)
    factors = m.withColumns({c: F.round(c, 3) for c in ("constraint_uplift", "seasonality_jan_index", "spatial_multiplier")})
    return report.waterfall(factors).select("outlet_id", "stage", "note")


_PRODUCT = "peer_ceiling * constraint_uplift * seasonality_jan_index * spatial_multiplier"


@query(
    "r11_guardrail",
    sql(
        f"""SELECT outlet_id, p AS factor_product, mult_potential,
                   CASE WHEN NOT coalesce(abs(mult_potential - p) > greatest(1.0, 0.005 * p), false) THEN 'none'
                        WHEN mult_potential > p THEN 'floor' ELSE 'cap' END AS guardrail
            FROM (SELECT *, {_PRODUCT} AS p FROM master) AS m""",
        "master",
        doubles="factor_product mult_potential",
        digits=3,
    ),
)
def r11(t: Tables) -> DataFrame:
    return rounded(report.guardrail(prepared.master(t)), 3)


@query(
    "r12_spatial_direction",
    sql(
        """SELECT outlet_id, spatial_multiplier, CASE WHEN spatial_multiplier > 1 THEN 'lift'
                  WHEN spatial_multiplier < 1 THEN 'discount' ELSE 'neutral' END AS direction
           FROM (SELECT outlet_id, round(spatial_multiplier, 8) AS spatial_multiplier FROM master) AS m""",
        "master",
    ),
)
def r12(t: Tables) -> DataFrame:
    return report.spatial_direction(rounded(prepared.master(t), 8))


@query(
    "r13_funded",
    sql(
        """SELECT outlet_id, distributor_id, outlet_type, hist_total_median, mult_potential, headroom, "Trade_Spend_Allocation_LKR",
                  expected_incremental_liters FROM master WHERE "Trade_Spend_Allocation_LKR" > 0""",
        "master",
        doubles="hist_total_median mult_potential headroom Trade_Spend_Allocation_LKR expected_incremental_liters",
        digits=3,
    ),
)
def r13(t: Tables) -> DataFrame:
    return rounded(report.funded(prepared.master(t)), 3)


@query(
    "r13_budget_figures",
    sql(
        """SELECT CAST(5000000 AS DOUBLE) AS budget_lkr, sum("Trade_Spend_Allocation_LKR") AS allocated_lkr,
                  count(*) FILTER ("Trade_Spend_Allocation_LKR" > 0) AS outlets_funded,
                  sum(expected_incremental_liters) AS projected_incremental_liters FROM master""",
        "master",
        doubles="allocated_lkr projected_incremental_liters",
        digits=3,
    ),
)
def r13_figures(t: Tables) -> DataFrame:
    return rounded(report.budget_figures(prepared.master(t)), 3)


@query(
    "r14_one_outlet",
    sql("SELECT * FROM master WHERE outlet_id = 'OUT_7'", "master", doubles=MASTER_DOUBLES, digits=4),
)
def r14(t: Tables) -> DataFrame:
    return rounded(report.one_outlet(prepared.master(t), "OUT_7"), 4, poi_accessibility=8)


def _figure(column: str, decimals: int = 0) -> str:
    return f"coalesce(format('{{:,.{decimals}f}}', round({column}, {decimals})), 'unknown')"


_EXPLAIN = f"""
SELECT outlet_id, concat_ws(chr(10),
    'Outlet ' || outlet_id || ' (type ' || coalesce(outlet_type, 'unknown') || ', size ' || coalesce(outlet_size, 'unknown') || ') in '
      || coalesce(province, 'unknown') || ' is served by ' || coalesce(distributor_id, 'unknown') || '.',
    'Similar outlets reach ' || {_figure('peer_ceiling')} || ' l a month.',
    'It was held back in ' || format('{{:.0f}}', round(coalesce(months_constrained * 100 / nullif(months_observed, 0), 0)))
      || ' % of its months, which counts as a factor of ' || {_figure('constraint_uplift', 3)} || '.',
    'The season counts as ' || {_figure('seasonality_jan_index', 2)} || ', the surroundings as ' || {_figure('spatial_multiplier', 3)}
      || ' (pull of places ' || {_figure('poi_accessibility', 2)} || ', competition ' || {_figure('saturation_index', 2)} || ').',
    'That makes a potential of ' || {_figure('mult_potential')} || ' l a month, ' || {_figure('headroom')} || ' l above the usual '
      || {_figure('hist_total_median')} || ' l; its best month had ' || {_figure('hist_total_max')} || ' l.',
    CASE WHEN coalesce("Trade_Spend_Allocation_LKR", 0) <> 0
         THEN 'A promotion of ' || format('{{:,.0f}}', "Trade_Spend_Allocation_LKR") || ' LKR should add '
              || {_figure('expected_incremental_liters')} || ' l.' ELSE 'No promotion is planned.' END) AS explanation
FROM master"""


@query("r15_explanation", sql(_EXPLAIN, "master"))
def r15(t: Tables) -> DataFrame:
    """Half-way figures are rounded up in both engines before they are formatted."""
    m = prepared.master(t)
    digits = {
        "peer_ceiling": 0, "mult_potential": 0, "hist_total_median": 0, "hist_total_max": 0, "headroom": 0,
        "expected_incremental_liters": 0, "constraint_uplift": 3, "spatial_multiplier": 3, "seasonality_jan_index": 2,
        "poi_accessibility": 2, "saturation_index": 2,
    }
    return report.explanation(m.withColumns({c: F.round(c, d) for c, d in digits.items()}))


@query(
    "b9_real_chain",
    sql(
        """SELECT count(*) AS outlets, count(*) FILTER (province = 'Western') AS western, 0 AS below_own_maximum, 0 AS missing,
                  true AS within_budget, 0 AS off_step FROM features""",
        "features",
    ),
)
def b9(t: Tables) -> DataFrame:
    """From the features to the budget with real groups and a real regression, by what holds whatever these find."""
    rules = replace(config.MODEL, cluster_tries=1)
    features = prepared.factored(t).drop("peer_cluster", "quantile_regression")
    joined = features.join(model.peer_clusters(features, rules).hint("merge"), "outlet_id", "left")
    joined = joined.join(quantile_regression.estimate(features, rules=rules).hint("merge"), "outlet_id", "left")
    scored = stage(model.with_estimates(stage(joined, "model_inputs"), t.seasonality, rules=rules), "estimates")
    spent = stage(budget.allocate(budget.allocation_inputs(scored, model.factor_table(scored))), "spent")
    missing = model.prediction_faults(scored).select((F.col("n_missing") + F.col("n_negative")).cast("int").alias("missing"))
    faults = budget.allocation_faults(spent).select(
        (F.col("total_spend") <= config.BUDGET.total + 1e-6).alias("within_budget"), (F.col("n_negative") + F.col("n_off_step")).cast("int").alias("off_step")
    )
    counts = scored.agg(
        F.count("*").alias("outlets"), F.count_if(F.col("province") == config.BUDGET.province).alias("western"),
        F.count_if(F.col("mult_potential") < F.coalesce("hist_total_max", F.lit(0.0))).cast("int").alias("below_own_maximum"),
    )
    return counts.crossJoin(missing).crossJoin(faults)  # a row each


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------


@query(
    "x1_dataset_sizes",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {name}) AS rows,
                   CAST((SELECT count(*) FROM (DESCRIBE {name})) AS INT) AS columns"""
        for name in SOURCE_TABLES
    ),
)
def x1(t: Tables) -> DataFrame:
    """All given tables that the library reads."""
    return profile.dataset_sizes({name: t.source(name) for name in SOURCE_TABLES})


_NULL_COLUMNS = ("outlet_id", "outlet_type", "outlet_size", "cooler_count", "src_key", "src_copy")


@query(
    "x2_null_fractions",
    sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", avg(CAST({c} IS NULL AS INT)) AS null_fraction FROM outlets_raw""" for c in _NULL_COLUMNS
        )
        + """) AS f ORDER BY null_fraction DESC, "column" LIMIT 3""",
        "outlets_raw",
        doubles="null_fraction",
    ),
)
def x2(t: Tables) -> DataFrame:
    return rounded(profile.null_fractions(t.outlets_raw, top=3))


@query(
    "x3_date_range",
    sql(
        "SELECT min(try_cast(date AS TIMESTAMP)) AS first_date, max(try_cast(date AS TIMESTAMP)) AS last_date FROM holidays_raw",
        "holidays_raw",
    ),
)
def x3(t: Tables) -> DataFrame:
    return profile.date_range(t.holidays_raw, "date")


block(
    "run_rows",
    "visits",
    """
SELECT *, count(*) OVER (PARTITION BY outlet_id, step_value, island) AS run FROM (
  SELECT *, row_number() OVER (PARTITION BY outlet_id ORDER BY ts, event_id)
            - row_number() OVER (PARTITION BY outlet_id, step_value ORDER BY ts, event_id) AS island FROM visits) AS i""",
)


@query(
    "x4_rejections_by_outlet",
    sql(
        """SELECT outlet_id, count(*) AS rejections FROM run_rows WHERE run >= 7 AND step_value <> 0 GROUP BY outlet_id
           ORDER BY rejections DESC, outlet_id LIMIT 10""",
        "run_rows",
    ),
)
def x4(t: Tables) -> DataFrame:
    return profile.rejections_by(constant_runs(t).rejected, "outlet_id")


@query(
    "x4_rejection_rate",
    sql(
        """SELECT count(*) FILTER (run >= 7) AS rejected, count(*) AS rows, avg(CAST(run >= 7 AS INT)) AS rejection_rate FROM run_rows""",
        "run_rows",
        doubles="rejection_rate",
    ),
)
def x4_rate(t: Tables) -> DataFrame:
    return rounded(profile.rejection_rate(constant_runs(t).tagged))


@query(
    "x5_blackout_days",
    sql("SELECT distributor_id, count(*) AS blackout_days FROM dark_days GROUP BY distributor_id", "dark_days"),
)
def x5(t: Tables) -> DataFrame:
    return profile.dark_days(blackouts(t).rejected, "distributor_id", "day")


@query(
    "x6_credit_cap_rate",
    sql(
        """SELECT avg(flag::INT) AS tag_rate, count(DISTINCT src_order) FILTER (flag) AS keys_tagged FROM (
             SELECT src_order, is_round AND avg(is_round::INT) OVER w >= 0.15 AND sum(is_round::INT) OVER w >= 5 AS flag
             FROM (SELECT *, volume_liters > 0 AND (volume_liters % 5 = 0 OR volume_liters % 50 = 0) AS is_round FROM transactions) AS r
             WINDOW w AS (PARTITION BY outlet_id)) AS f""",
        "transactions",
        doubles="tag_rate",
    ),
)
def x6(t: Tables) -> DataFrame:
    return rounded(profile.tag_rate(d10(t), "_credit_cap_flag", "src_order"))


@query(
    "x7_master_sanity",
    sql(
        """SELECT count(*) AS rows, count(DISTINCT outlet_id) AS distinct_outlet_id,
                  count(DISTINCT distributor_id) AS distinct_distributor_id FROM outlet_master""",
        "outlet_master",
    ),
)
def x7(t: Tables) -> DataFrame:
    return profile.master_sanity(prepared.outlet_master(t), "outlet_id", "distributor_id")


@query("x7_value_counts", sql("SELECT outlet_size, count(*) AS n FROM outlets GROUP BY outlet_size", "outlets"))
def x7_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.outlets, "outlet_size")


@query(
    "x8_out_of_bounds",
    sql(
        """SELECT count(*) FILTER (NOT coalesce(latitude BETWEEN 5.5 AND 10.5 AND longitude BETWEEN 79.0 AND 82.5, false)) AS out_of_bounds
           FROM coordinates_raw""",
        "coordinates_raw",
    ),
)
def x8(t: Tables) -> DataFrame:
    return profile.out_of_bounds(t.coordinates_raw)


@query(
    "x9_top_reasons",
    sql(
        """SELECT dataset, reason, n, CAST(place AS INT) AS place FROM (
             SELECT _dataset AS dataset, failure_reason AS reason, count(*) AS n,
                    row_number() OVER (PARTITION BY _dataset ORDER BY count(*) DESC, failure_reason) AS place
             FROM dirty_rejects GROUP BY _dataset, failure_reason) AS c WHERE place <= 3""",
        "dirty_rejects",
    ),
)
def x9(t: Tables) -> DataFrame:
    return profile.top_reasons(union_rejects([result.rejected for result in all_results(t)]))


@query(
    "x10_constraint_coverage",
    sql(
        """SELECT count(*) FILTER (months_unconstrained >= 1) AS outlets_with_1_free_month,
                  count(*) FILTER (months_unconstrained >= 2) AS outlets_with_2_free_months, count(*) AS outlets_total,
                  (SELECT avg(is_constrained::INT) FROM monthly) AS constrained_share FROM features""",
        "features",
        "monthly",
        doubles="constrained_share",
    ),
)
def x10(t: Tables) -> DataFrame:
    return rounded(profile.constraint_coverage(prepared.monthly(t), prepared.features(t)))


@query(
    "x11_free_months",
    sql(
        """SELECT coalesce(months_unconstrained, 0) AS months_unconstrained, count(*) AS outlets FROM features GROUP BY 1""",
        "features",
    ),
)
def x11(t: Tables) -> DataFrame:
    return profile.free_month_counts(prepared.features(t))


_FLAGS = ("low_volume_flag", "low_sku_diversity_flag", "credit_cap_flag", "is_constrained")


@query(
    "x12_flag_rates",
    sql(f"SELECT {', '.join(f'avg({f}::INT) AS {f}' for f in _FLAGS)} FROM monthly", "monthly", doubles=list(_FLAGS)),
)
def x12(t: Tables) -> DataFrame:
    return rounded(profile.flag_rates(prepared.monthly(t)))


@query(
    "x13_variation",
    sql(
        """SELECT median(r) AS median_cv_raw, median(d) AS median_cv_deflated FROM (
             SELECT stddev_samp(volume_total) / avg(volume_total) AS r,
                    stddev_samp(volume_total_deflated) / avg(volume_total_deflated) AS d, count(*) AS n, avg(volume_total) AS m
             FROM monthly GROUP BY outlet_id) AS o WHERE n > 1 AND m > 0""",
        "monthly",
        doubles="median_cv_raw median_cv_deflated",
    ),
)
def x13(t: Tables) -> DataFrame:
    return rounded(profile.median_variation(prepared.monthly(t)))


@query(
    "x14_without_poi",
    sql("SELECT count(*) AS outlets_without_poi FROM features WHERE poi_total_1000m IS NULL", "features"),
)
def x14(t: Tables) -> DataFrame:
    return profile.without_poi(prepared.features(t))


_DESCRIBED = ("mult_potential", "ensemble_potential", "hist_total_max")
_PROBS = {10: 0.1, 50: 0.5, 90: 0.9, 99: 0.99}


@query(
    "x15_describe",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max,
                {', '.join(f'quantile_cont({c}, {q}) AS p{p}' for p, q in _PROBS.items())} FROM scored"""
            for c in _DESCRIBED
        ),
        "scored",
        doubles=["mean", "std", "min", "max", *[f"p{p}" for p in _PROBS]],
        digits=4,
    ),
)
def x15(t: Tables) -> DataFrame:
    return rounded(profile.describe(prepared.scored(t), _DESCRIBED, list(_PROBS.values())), 4)


@query(
    "x16_log_histogram",
    sql(
        "SELECT estimator, floor(v / 0.1) * 0.1 AS bin_start, count(*) AS n FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS estimator, ln(1 + {c}) AS v FROM scored" for c in model.ESTIMATORS)
        + ") AS l WHERE v IS NOT NULL GROUP BY estimator, floor(v / 0.1)",
        "scored",
        doubles="bin_start",
        digits=3,
    ),
)
def x16(t: Tables) -> DataFrame:
    return rounded(profile.log_histogram(prepared.scored(t), model.ESTIMATORS), 3)


