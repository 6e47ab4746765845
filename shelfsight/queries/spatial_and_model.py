"""Queries for points of interest, spatial factors and the model."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from shelfsight import config
from shelfsight.functions import quantiles
from shelfsight.operators import geo, model, poi, quantile_regression, sensitivity, spatial
from shelfsight.queries import prepared
from shelfsight.queries.base import query, rounded, sql
from shelfsight.queries.blocks import CATEGORY_SQL, NEAREST_DIGITS, POI_DOUBLES, blend_sql, case, distance, robust_z
from shelfsight.sources.adapters import Tables

_CENTRE = (6.9271, 79.8612)


@query(
    "p1_haversine",
    sql(
        f"SELECT outlet_id, {distance('latitude', 'longitude', str(_CENTRE[0]), str(_CENTRE[1]))} AS distance_m FROM coordinates",
        "coordinates",
        doubles="distance_m",
        digits=3,
    ),
)
def p1(t: Tables) -> DataFrame:
    d = geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(_CENTRE[0]), F.lit(_CENTRE[1]))
    return rounded(t.coordinates.select("outlet_id", d.alias("distance_m")), 3)


@query(
    "p2_decay",
    sql(
        f"""SELECT outlet_id, exp(-(d * d) / (2.0 * 400000 * 400000)) AS gaussian, exp(-d / 400000.0) AS exponential
            FROM (SELECT outlet_id, {distance('latitude', 'longitude', str(_CENTRE[0]), str(_CENTRE[1]))} AS d FROM coordinates) AS x""",
        "coordinates",
        doubles="gaussian exponential",
    ),
)
def p2(t: Tables) -> DataFrame:
    d = geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(_CENTRE[0]), F.lit(_CENTRE[1]))
    sigma = F.lit(400_000.0)
    return rounded(
        t.coordinates.select(
            "outlet_id",
            geo.decay_weight(d, sigma, "gaussian").alias("gaussian"),
            geo.decay_weight(d, sigma, "exponential").alias("exponential"),
        )
    )


@query("p3_poi_category", sql(f"SELECT poi_id, {CATEGORY_SQL} AS category FROM poi_flat", "poi_flat"))
def p3(t: Tables) -> DataFrame:
    return t.poi.select("poi_id", poi.classify(F.col("tags")).alias("category"))


@query(
    "p4_radius_join",
    sql("SELECT outlet_id, poi_id, category, d AS distance_m FROM poi_pairs", "poi_pairs", doubles="distance_m", digits=3),
)
def p4(t: Tables) -> DataFrame:
    return rounded(poi.nearby(t.coordinates, poi.locate(t.poi), 1000.0), 3)


@query(
    "p5_poi_position",
    sql("SELECT poi_id, lat, lon FROM poi_located WHERE category IS NOT NULL", "poi_located", doubles="lat lon"),
)
def p5(t: Tables) -> DataFrame:
    return rounded(poi.locate(t.poi).select("poi_id", "lat", "lon"))


@query(
    "p6_poi_by_category",
    sql(
        f"""SELECT outlet_id, CAST(r AS INT) AS radius_m, category, count(*) AS n, min(d) AS nearest_m,
                   sum(exp(-(d * d) / (2 * sigma * sigma))) AS access
            FROM (SELECT *, {case("category", config.POI_SIGMA_M, "300.0")} AS sigma
                  FROM poi_pairs JOIN (SELECT unnest([{", ".join(map(str, config.SPATIAL.radii_m))}]) AS r) AS radii ON d <= r) AS p
            GROUP BY outlet_id, r, category""",
        "poi_pairs",
        doubles="nearest_m:4 access",
    ),
)
def p6(t: Tables) -> DataFrame:
    """The wide features turned back into rows, for each radius."""
    radii = tuple(config.SPATIAL.radii_m)
    wide = poi.features_from_hits(poi.site_hits(t.coordinates, poi.locate(t.poi), radii), ["latitude", "longitude"], radii)
    rows = F.array(
        *[
            F.struct(
                F.lit(r).alias("radius_m"),
                F.lit(c).alias("category"),
                F.col(f"poi_count_{c}_{r}m").alias("n"),
                F.col(f"poi_nearest_{c}_{r}m").alias("nearest_m"),
                F.col(f"poi_access_{c}_{r}m").alias("access"),
            )
            for r in radii
            for c in config.POI_CATEGORIES
        ]
    )
    found = t.coordinates.join(wide, ["latitude", "longitude"]).select("outlet_id", F.inline(rows)).where("n > 0")
    return rounded(found, nearest_m=4)


@query("p7_poi_features", sql("SELECT * FROM poi_wide", "poi_wide", doubles=POI_DOUBLES))
def p7(t: Tables) -> DataFrame:
    return rounded(poi.poi_features(t.coordinates, t.poi), **NEAREST_DIGITS)


@query("p8_own_density", sql("SELECT * FROM own_density", "own_density"))
def p8(t: Tables) -> DataFrame:
    return spatial.with_own_density(t.coordinates).select("outlet_id", "own_network_density")


@query("p8_own_density_crowded", sql("SELECT * FROM own_density", "own_density"))
def p8_crowded(t: Tables) -> DataFrame:
    """The same with small cells everywhere, as in a place a hundred times as crowded."""
    return spatial.with_own_density(t.coordinates, direct=4).select("outlet_id", "own_network_density")


@query(
    "p9_accessibility",
    sql("SELECT outlet_id, poi_accessibility FROM spatial_inputs", "spatial_inputs", doubles="poi_accessibility", digits=8),
)
def p9(t: Tables) -> DataFrame:
    f = prepared.features(t)
    return rounded(f.select("outlet_id", spatial.accessibility(f).alias("poi_accessibility")), 8)


@query(
    "p10_saturation",
    sql("SELECT outlet_id, CAST(saturation_index AS DOUBLE) AS saturation_index FROM spatial_inputs", "spatial_inputs"),
)
def p10(t: Tables) -> DataFrame:
    f = prepared.spatial_inputs(t)
    return f.select("outlet_id", spatial.saturation(f).alias("saturation_index"))


@query(
    "p11_robust_z",
    sql(
        f"SELECT outlet_id, {robust_z('hist_total_mean', 'features')} AS z FROM features", "features", doubles="z"
    ),
)
def p11(t: Tables) -> DataFrame:
    return rounded(spatial.with_robust_z(prepared.features(t), {"z": F.col("hist_total_mean")}).select("outlet_id", "z"))


@query(
    "p12_spatial_multiplier",
    sql("SELECT outlet_id, spatial_multiplier FROM spatial", "spatial", doubles="spatial_multiplier", digits=5),
)
def p12(t: Tables) -> DataFrame:
    return rounded(spatial.with_multiplier(prepared.spatial_inputs(t)).select("outlet_id", "spatial_multiplier"), 5)


@query(
    "p13_spatial_report",
    sql(
        """SELECT median(poi_accessibility) AS accessibility_median, median(saturation_index) AS saturation_median,
                  min(spatial_multiplier) AS multiplier_min, median(spatial_multiplier) AS multiplier_median,
                  max(spatial_multiplier) AS multiplier_max FROM spatial""",
        "spatial",
        doubles="accessibility_median saturation_median multiplier_min multiplier_median multiplier_max",
        digits=8,
    ),
)
def p13(t: Tables) -> DataFrame:
    return rounded(spatial.spatial_report(prepared.factored(t)), 8)


# ---------------------------------------------------------------------------
# Model
# ---------------------------------------------------------------------------


@query("m2_feature_matrix")
def m2(t: Tables) -> DataFrame:
    """Mean and deviation of every standardised column, all close to 0 and 1."""
    f = prepared.features(t)
    matrix, used = model.feature_matrix(f, model.peer_columns(f))
    stats = matrix.agg(Summarizer.metrics("mean", "std", "count").summary(F.col("features")).alias("s"))
    names = F.array(*[F.lit(c) for c in used])
    return rounded(
        stats.select(F.inline(F.arrays_zip(names.alias("column"), vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("std"))))
    )


@query(
    "m2_feature_values",
    sql(
        """SELECT "column", outlet_id, CASE WHEN stddev_pop(v) OVER c > 1e-12 * abs(avg(v) OVER c)
                  THEN (v - avg(v) OVER c) / stddev_pop(v) OVER c ELSE 0 END AS value
           FROM (SELECT "column", outlet_id, coalesce(v, median(v) OVER (PARTITION BY "column")) AS v FROM (
             SELECT "column", outlet_id, CASE WHEN NOT isnan(v) THEN v END AS v FROM (
               UNPIVOT (SELECT outlet_id, coalesce(COLUMNS(lambda c: starts_with(c, 'poi_') OR c IN ('latitude', 'longitude',
                               'hist_total_p90', 'hist_total_median'))::DOUBLE, 'nan'::DOUBLE) FROM features)
               ON COLUMNS(* EXCLUDE (outlet_id)) INTO NAME "column" VALUE v) AS l) AS g) AS m
           WHERE v IS NOT NULL WINDOW c AS (PARTITION BY "column")""",
        "features",
        doubles="value",
        digits=5,
    ),
)
def m2_values(t: Tables) -> DataFrame:
    """Every value after gaps are filled with the exact median and the column is standardised."""
    f = prepared.features(t)
    values, used = model.feature_values(f, model.peer_columns(f))
    named = F.arrays_zip(F.array(*[F.lit(c) for c in used]).alias("column"), F.col("features").alias("value"))
    return rounded(values.select("outlet_id", F.inline(named)).select("column", "outlet_id", "value"), 5)


@query("m3_peer_clusters")
def m3(t: Tables) -> DataFrame:
    clusters = model.peer_clusters(prepared.features(t))
    return clusters.groupBy("peer_cluster").agg(F.count("*").alias("outlets"))


@query(
    "m3_cluster_invariants",
    sql("SELECT count(*) AS outlets, true AS few_groups, true AS nearest_own_centre FROM features", "features"),
)
def m3_invariants(t: Tables) -> DataFrame:
    """What every settled clustering has: no more groups than asked for, and outlets nearest to the middle of their own.

    A round may move the middles a last little bit, so one outlet in fifty may lie between two.
    """
    f = prepared.features(t)
    rules = replace(config.MODEL, cluster_tries=1)
    values = model.feature_values(f, model.peer_columns(f))[0].join(model.peer_clusters(f, rules).hint("merge"), "outlet_id")
    middles = values.select("peer_cluster", F.posexplode("features").alias("i", "v")).groupBy("peer_cluster", "i").agg(F.avg("v").alias("m"))
    middles = middles.groupBy("peer_cluster").agg(F.array_sort(F.collect_list(F.struct("i", "m")))["m"].alias("middle")).collect()  # a row per group
    away = [
        F.struct(
            F.aggregate(F.zip_with("features", F.lit(list(r.middle)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x).alias("d"),
            F.lit(r.peer_cluster).alias("c"),
        )
        for r in middles
    ]
    own = (F.array_min(F.array(*away))["c"] == F.col("peer_cluster")).cast("int")
    return values.agg(
        F.count("*").alias("outlets"), (F.count_distinct("peer_cluster") <= rules.clusters).alias("few_groups"), (F.avg(own) >= 0.98).alias("nearest_own_centre")
    )


@query(
    "m4_peer_ceiling",
    sql("SELECT outlet_id, peer_ceiling FROM peered", "peered", doubles="peer_ceiling", digits=4),
)
def m4(t: Tables) -> DataFrame:
    return rounded(model.with_peer_ceiling(prepared.factored(t)).select("outlet_id", "peer_ceiling"), 4)


@query("m5_quantile_regression")
def m5(t: Tables) -> DataFrame:
    f = prepared.factored(t).drop("quantile_regression")
    scored = quantile_regression.estimate(f).join(f.select("outlet_id", "hist_deflated_max").hint("merge"), "outlet_id")
    return rounded(quantile_regression.coverage(scored, "hist_deflated_max", 0.9), 3)


@query(
    "m5_fit_invariants",
    sql(
        """SELECT count(hist_deflated_max) AS n, count(hist_deflated_max) > 0 AS as_many_above, count(hist_deflated_max) > 0 AS near_the_best
           FROM features""",
        "features",
    ),
)
def m5_invariants(t: Tables) -> DataFrame:
    """What every best fit of the quantile 0.9 has: no more than a tenth of the labels above it, no more than nine tenths below, and no gap."""
    f = prepared.factored(t).drop("quantile_regression")
    rows = quantile_regression.training_rows(f, "hist_deflated_max")[0].where("label is not null")
    found = quantile_regression.fit(rows, 0.9)
    r = F.col("label") - found.predict(F.col("features"))
    near, n = F.lit(1e-3) * F.stddev_pop("label"), F.count("*")
    sides = rows.select("label", r.alias("r")).crossJoin(rows.agg(near.alias("near")))  # one row
    return sides.agg(
        n.alias("n"),
        ((F.count_if(F.col("r") > F.col("near")) <= 0.1 * n) & (F.count_if(F.col("r") < -F.col("near")) <= 0.9 * n)).alias("as_many_above"),
        (F.lit(found.gap) <= 2e-6 * F.stddev_pop("label")).alias("near_the_best"),
    )


@query(
    "m6_extrapolation",
    sql("SELECT outlet_id, unconstrained_extrapolation FROM estimated", "estimated", doubles="unconstrained_extrapolation"),
)
def m6(t: Tables) -> DataFrame:
    return rounded(
        model.with_extrapolation(prepared.factored(t), t.seasonality).select("outlet_id", "unconstrained_extrapolation")
    )


@query(
    "m7_blend",
    sql(f"SELECT outlet_id, {blend_sql(0.4, 0.3, 0.3)} AS blended FROM estimated", "estimated", doubles="blended", digits=4),
)
def m7(t: Tables) -> DataFrame:
    return rounded(prepared.scored(t).select("outlet_id", model.blend().alias("blended")), 4)


@query(
    "m8_multiplicative",
    sql("SELECT outlet_id, mult_potential FROM estimated", "estimated", doubles="mult_potential", digits=3),
)
def m8(t: Tables) -> DataFrame:
    peered = model.with_peer_ceiling(prepared.factored(t))
    return rounded(model.with_multiplicative(peered).select("outlet_id", "mult_potential"), 3)


@query(
    "m9_floored_blend",
    sql("SELECT outlet_id, ensemble_potential FROM scored", "scored", doubles="ensemble_potential", digits=4),
)
def m9(t: Tables) -> DataFrame:
    value = model.floored_blend(model.blend(), F.col("hist_total_max"))
    return rounded(prepared.scored(t).select("outlet_id", value.alias("ensemble_potential")), 4)


@query(
    "m10_divergence",
    sql("SELECT outlet_id, divergence_pct FROM scored", "scored", doubles="divergence_pct", digits=3),
)
def m10(t: Tables) -> DataFrame:
    d = model.divergence_pct(F.col("mult_potential"), F.col("ensemble_potential"))
    return rounded(prepared.scored(t).select("outlet_id", d.alias("divergence_pct")), 3)


@query("m11_divergence_flag", sql("SELECT outlet_id, divergence_flag FROM factor_rows", "factor_rows"))
def m11(t: Tables) -> DataFrame:
    return model.with_divergence(prepared.scored(t)).select("outlet_id", "divergence_flag")


@query(
    "m12_prediction_faults",
    sql(
        """SELECT count(*) FILTER (mult_potential IS NULL) AS n_missing, count(*) FILTER (mult_potential < 0) AS n_negative
           FROM scored""",
        "scored",
    ),
)
def m12(t: Tables) -> DataFrame:
    return model.prediction_faults(prepared.scored(t))


_FACTOR_DOUBLES = (
    "peer_ceiling constraint_uplift seasonality_jan_index spatial_multiplier mult_potential ensemble_potential "
    "divergence_pct hist_total_max"
)


@query("m13_factor_table", sql("SELECT * FROM factor_rows", "factor_rows", doubles=_FACTOR_DOUBLES, digits=3))
def m13(t: Tables) -> DataFrame:
    return rounded(model.factor_table(prepared.scored(t)), 3)


@query(
    "m13_predictions",
    sql(
        """SELECT outlet_id AS "Outlet_ID", round_even(mult_potential, 2) AS "Maximum_Monthly_Liters" FROM scored""",
        "scored",
    ),
)
def m13_predictions(t: Tables) -> DataFrame:
    return model.predictions(prepared.scored(t))


@query(
    "m13_diagnostics",
    sql(
        """SELECT outlet_id, peer_ceiling, quantile_regression, unconstrained_extrapolation, ensemble_potential, mult_potential,
                  divergence_pct FROM scored""",
        "scored",
        doubles="peer_ceiling quantile_regression unconstrained_extrapolation ensemble_potential mult_potential divergence_pct",
        digits=3,
    ),
)
def m13_diagnostics(t: Tables) -> DataFrame:
    return rounded(model.diagnostics_table(prepared.scored(t)), 3)


@query(
    "m14_divergence_summary",
    sql(
        """SELECT median(abs(divergence_pct)) AS median_abs_divergence_pct, avg(abs(divergence_pct)) AS mean_abs_divergence_pct,
                  quantile_cont(abs(divergence_pct), 0.9) AS p90_abs_divergence_pct,
                  avg(CAST(coalesce(abs(divergence_pct) <= 25, false) AS INT)) AS share_within_25pct,
                  count(*) FILTER (coalesce(abs(divergence_pct) > 50, false)) AS n_flagged_outlets FROM scored""",
        "scored",
        doubles="median_abs_divergence_pct mean_abs_divergence_pct p90_abs_divergence_pct share_within_25pct",
        digits=4,
    ),
)
def m14(t: Tables) -> DataFrame:
    return rounded(model.divergence_summary(prepared.scored(t)), 4)


_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS factor, min({c}) AS min, median({c}) AS p50, avg({c}) AS mean, max({c}) AS max FROM factor_rows"
    for c in model.FACTORS
)


@query("m15_factor_distribution", sql(_DESCRIBE, "factor_rows", doubles="min p50 mean max", digits=4))
def m15(t: Tables) -> DataFrame:
    return rounded(model.describe_factors(model.factor_table(prepared.scored(t))), 4)


@query(
    "m16_coverage",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS estimator, count({c}) AS n, count({c}) / count(*) AS share FROM scored" for c in model.ESTIMATORS
        ),
        "scored",
        doubles="share",
    ),
)
def m16(t: Tables) -> DataFrame:
    return rounded(model.coverage(prepared.scored(t)))


def _spearman_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, corr(ra, rb) AS rho FROM (
      SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
             rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
      FROM (SELECT round({a}, 6) AS {a}, round({b}, 6) AS {b} FROM scored) AS s
      WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS r"""


_PAIRS = [(a, b) for i, a in enumerate(model.ESTIMATORS) for b in model.ESTIMATORS[i + 1 :]]


@query(
    "m17_spearman",
    sql(" UNION ALL ".join(_spearman_sql(a, b) for a, b in _PAIRS), "scored", doubles="rho"),
)
def m17(t: Tables) -> DataFrame:
    """Ranks depend on exact ties, so the estimates are rounded first."""
    return rounded(model.rank_agreement(rounded(prepared.scored(t).select(*model.ESTIMATORS))))


_BASE = blend_sql(0.4, 0.3, 0.3)


@query(
    "m18_weight_sweep",
    sql(
        " UNION ALL ".join(
            f"""SELECT 'w_peer={w}' AS perturbation,
                       median(abs({blend_sql(w, (1 - w) / 2, (1 - w) / 2)} - {_BASE}) / nullif({_BASE}, 0)) AS median_rel_change
                FROM estimated"""
            for w in (0.3, 0.4, 0.5)
        ),
        "estimated",
        doubles="median_rel_change",
        digits=5,
    ),
)
def m18(t: Tables) -> DataFrame:
    return rounded(model.weight_sweep(prepared.scored(t)), 5)


_SWEPT = [*[f"peer_k={k}" for k in (15, 25, 40)], *[f"qreg_tau={q}" for q in (0.85, 0.9, 0.95)], *[f"w_peer={w}" for w in (0.3, 0.4, 0.5)]]

_CONFIGURED = ("peer_k=25", "qreg_tau=0.9", "w_peer=0.4")


@query(
    "m18_sweeps",
    " UNION ALL ".join(
        f"SELECT '{name}' AS perturbation, {str(name in _CONFIGURED).lower()} AS configured, true AS as_expected" for name in _SWEPT
    ),
)
def m18_sweeps(t: Tables) -> DataFrame:
    """Real clusters and fits. What any library must find: the configured values change nothing, the others less than half.

    The numbers themselves depend on the clusters and are in ``sensitivity.sweep``.
    """
    rules = replace(config.MODEL, cluster_tries=1)
    found = sensitivity.sweep(prepared.factored(t), t.seasonality, rules=rules)
    change = F.col("median_rel_change")
    configured = F.col("perturbation").isin(*_CONFIGURED)
    expected = F.when(configured, change == 0).otherwise(change.between(0, 0.5))
    return found.select("perturbation", configured.alias("configured"), expected.alias("as_expected"))


_PERCENTS = {10: 0.1, 25: 0.25, 50: 0.5, 75: 0.75, 90: 0.9, 99: 0.99}
_UPLIFT_DOUBLES = ["mean", "std", "min", *[f"p{p}" for p in _PERCENTS], "max"]


@query(
    "m19_uplift_over_history",
    sql(
        f"""SELECT count(u) AS n, avg(u) AS mean, stddev_samp(u) AS std, min(u) AS min,
                   {', '.join(f'quantile_cont(u, {q}) AS p{p}' for p, q in _PERCENTS.items())}, max(u) AS max,
                   count(*) FILTER (ensemble_potential < coalesce(hist_total_max, 0)) AS n_below_floor
            FROM (SELECT *, ensemble_potential / nullif(coalesce(hist_total_max, 0), 0) AS u FROM scored) AS s""",
        "scored",
        doubles=_UPLIFT_DOUBLES,
        digits=5,
    ),
)
def m19(t: Tables) -> DataFrame:
    return rounded(model.uplift_over_history(prepared.scored(t)), 5)


@query(
    "q_exact_quantiles",
    sql(
        """SELECT distributor_id, quantile_cont(total_bill_value, 0.1) AS p10, quantile_cont(total_bill_value, 0.5) AS p50,
                  quantile_cont(total_bill_value, 0.99) AS p99 FROM transactions GROUP BY distributor_id""",
        "transactions",
        doubles="p10 p50 p99",
        digits=3,
    ),
)
def exact_quantiles(t: Tables) -> DataFrame:
    """Quantiles by a key with few, very large groups, with a coarse sketch so that the brackets are real."""
    q = quantiles.exact_quantiles(
        t.transactions, {"v": F.col("total_bill_value")}, [0.1, 0.5, 0.99], ["distributor_id"], accuracy=200
    )
    return rounded(q.select("distributor_id", *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "p50", "p99"))]), 3)
