"""Demand-ceiling estimates: peers, quantile regression, extrapolation, blend and factor product."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfsight import config
from shelfsight.functions import quantiles, scalar as S
from shelfsight.operators import gold
from shelfsight.session import stage

FACTORS = ("peer_ceiling", "constraint_uplift", "seasonality_jan_index", "spatial_multiplier")
ESTIMATORS = ("peer_ceiling", "quantile_regression", "unconstrained_extrapolation")


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Number and boolean columns, in order, without the excluded ones."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in exclude
    ]


def peer_columns(df: DataFrame) -> list[str]:
    extra = {"latitude", "longitude", "hist_total_p90", "hist_total_median"}
    return [c for c in df.columns if c.startswith("poi_") or c in extra]


def regression_columns(df: DataFrame, target: str) -> list[str]:
    """All numbers but the target and the history, of which only the median stays."""
    history = {c for c in df.columns if c.startswith("hist_") and c != "hist_total_median"}
    return numeric_columns(df, {target, "outlet_id", "peer_cluster", "peer_ceiling"} | history)


def feature_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("outlet_id",)) -> tuple[DataFrame, list[str]]:
    """``keep`` plus ``features``, an array of numbers: medians for gaps, then mean 0 and deviation 1.

    Medians are exact; the deviation is that of the whole population, and a
    column without any is 0 throughout. Columns without a value are left out, as
    they have no median. Two passes over the rows find medians, means and deviations.
    """
    if not columns:
        return df.select(*keep), []
    given = [S.not_nan(F.col(f"`{c}`").cast("double")) for c in columns]
    about = quantiles.column_summaries(df, given)
    used = [i for i, a in enumerate(about) if a.n]
    if not used:
        return df.select(*keep), []
    scaled = []
    for i in used:
        mean, deviation = about[i].filled()
        # The spread of equal values may come out as a rounding error; it counts as none.
        scale = deviation if deviation > 1e-12 * abs(mean) else 1.0
        scaled.append((F.coalesce(given[i], F.lit(about[i].median)) - mean) / scale)
    return df.select(*keep, F.array(*scaled).alias("features")), [columns[i] for i in used]


def feature_matrix(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("outlet_id",)) -> tuple[DataFrame, list[str]]:
    """:func:`feature_values` with ``features`` as a vector, as the clustering takes it."""
    values, used = feature_values(df, columns, keep)
    return (values.withColumn("features", array_to_vector("features")) if used else values), used


# ---------------------------------------------------------------------------
# Peer ceiling
# ---------------------------------------------------------------------------


def peer_clusters(features: DataFrame, rules: config.ModelRules = config.MODEL) -> DataFrame:
    """``outlet_id, peer_cluster``: the best of several K-means runs.

    With no usable column or fewer rows than clusters all outlets are one peer group.
    """
    columns = peer_columns(features)
    enough = len(features.select("outlet_id").take(rules.clusters)) >= rules.clusters
    matrix, used = feature_matrix(features, columns) if columns and enough else (None, [])
    if not used:
        return features.select("outlet_id", F.lit(0).alias("peer_cluster"))
    matrix = stage(matrix, "peer_features")
    best = None
    for i in range(rules.cluster_tries):
        means = KMeans(
            k=rules.clusters, seed=rules.seed + i, maxIter=rules.cluster_rounds, featuresCol="features", predictionCol="peer_cluster"
        )
        fitted = means.fit(matrix)
        if fitted.summary.numIter >= rules.cluster_rounds:
            warnings.warn(f"K-means try {i} ended after {rules.cluster_rounds} rounds without settling", stacklevel=2)
        if best is None or fitted.summary.trainingCost < best.summary.trainingCost:
            best = fitted
    return best.transform(matrix).select("outlet_id", "peer_cluster")


def ceiling_column(columns: Sequence[str]) -> str:
    for name in ("unc_deflated_p90", "hist_deflated_p90", "hist_total_p90"):
        if name in columns:
            return name
    raise ValueError("no column to take a peer ceiling from")


def bounded_cluster(rules: config.ModelRules = config.MODEL) -> Column:
    """The cluster id, an error where it is not one of the configured number of clusters.

    This is what makes the tables with a row per cluster small enough to broadcast.
    """
    c = F.col("peer_cluster")
    wrong = F.raise_error(F.concat(F.lit(f"peer_cluster not below {rules.clusters}: "), c.cast("string"))).cast("int")
    return F.when(c.isNull() | c.between(0, rules.clusters - 1), c.cast("int")).otherwise(wrong)


def with_peer_ceiling(features: DataFrame, rules: config.ModelRules = config.MODEL) -> DataFrame:
    """``peer_ceiling`` given ``peer_cluster``: the cluster's high quantile, scaled by relative size.

    A cluster may hold any part of the outlets; its quantiles are found without
    gathering it. There are as many clusters as configured, so the small table
    of cluster values is broadcast.
    """
    features = features.withColumn("peer_cluster", bounded_cluster(rules))
    size = "hist_total_median" if "hist_total_median" in features.columns else "hist_total_mean"
    wanted = {"_peer_q": (F.col(ceiling_column(features.columns)), rules.peer_quantile)}
    if size in features.columns:
        wanted["_peer_size"] = (F.col(size), 0.5)
    peers = quantiles.quantiles_by(features, ["peer_cluster"], wanted, few_groups=True)
    df = features.join(F.broadcast(peers), "peer_cluster", "left")
    if size not in features.columns:
        return df.withColumn("peer_ceiling", F.col("_peer_q")).drop("_peer_q")
    low, high = rules.size_ratio
    relative = F.coalesce(S.clip(S.ratio(F.col(size), F.col("_peer_size")), low, high), F.lit(1.0))
    return df.withColumn("peer_ceiling", F.col("_peer_q") * relative).drop("_peer_q", "_peer_size")


# ---------------------------------------------------------------------------
# Other estimators and the blend
# ---------------------------------------------------------------------------


def with_extrapolation(
    features: DataFrame,
    seasonality: DataFrame | None,
    season: config.Season = config.SEASON,
    rules: config.ModelRules = config.MODEL,
) -> DataFrame:
    """``unconstrained_extrapolation``: best unconstrained month × season index, with enough such months."""
    best = F.col("unc_deflated_max") if "unc_deflated_max" in features.columns else S.col_or(features, "hist_deflated_max", None)
    months = F.coalesce(S.col_or(features, "months_unconstrained", 0), F.lit(0))
    df = features.withColumn("_best", F.when(months >= rules.min_unconstrained_months, best.cast("double")))
    if seasonality is not None and "distributor_id" in features.columns:
        df = df.join(gold.target_season(seasonality, season), "distributor_id", "left")
    else:
        df = df.withColumn("season_index", F.lit(None).cast("double"))
    index = F.coalesce(F.nullif(F.col("season_index"), F.lit(0.0)), F.lit(1.0))
    return df.withColumn("unconstrained_extrapolation", F.col("_best") * index).drop("_best", "season_index")


def blend(weights: Mapping[str, float] | None = None, estimates: Mapping[str, Column] | None = None) -> Column:
    """Weighted mean of the estimators that are present and not negative; ``estimates`` are their columns if named otherwise."""
    weights = dict(config.MODEL.weights) if weights is None else weights
    parts, total = [], []
    for name in ESTIMATORS:
        value = estimates[name] if estimates else F.col(name)
        usable = S.flag(value >= 0)
        weight = F.when(usable, F.lit(float(weights.get(name, 0.0)))).otherwise(0.0)
        total.append(weight)
        parts.append(weight * F.when(usable, value).otherwise(0.0))
    return S.ratio(reduce(lambda a, b: a + b, parts), reduce(lambda a, b: a + b, total))


def floored_blend(blended: Column, hist_max: Column, multiplier: float = config.MODEL.floor_multiplier) -> Column:
    floor = F.coalesce(hist_max, F.lit(0.0)) * multiplier
    return F.greatest(F.coalesce(blended, floor), floor)


def with_multiplicative(features: DataFrame, rules: config.ModelRules = config.MODEL) -> DataFrame:
    """``mult_potential``: product of the factors, not below the own maximum and not
    above the cluster's maximum × the cap (which itself never undercuts the floor)."""
    factor = [F.coalesce(S.col_or(features, n, 1.0).cast("double"), F.lit(1.0)) for n in FACTORS[1:]]
    product = reduce(lambda a, b: a * b, factor, F.col("peer_ceiling").cast("double"))
    own = F.coalesce(S.col_or(features, "hist_total_max", 0.0).cast("double"), F.lit(0.0))
    df = features.withColumns({"_own": own, "_product": F.coalesce(S.finite(product), own)})
    value = F.greatest(F.col("_product"), F.col("_own"))
    if "peer_cluster" in features.columns:
        df = df.withColumn("peer_cluster", bounded_cluster(rules))
        top = df.groupBy("peer_cluster").agg(F.max("_own").alias("_top"))
        df = df.join(F.broadcast(top), "peer_cluster", "left")
        value = F.greatest(F.least(value, F.col("_top") * rules.cap_over_cluster_max), F.col("_own"))
        return df.withColumn("mult_potential", value).drop("_own", "_product", "_top")
    return df.withColumn("mult_potential", value).drop("_own", "_product")


def divergence_pct(value: Column, base: Column) -> Column:
    """Difference from ``base`` in percent, NULL where the base is (nearly) 0."""
    return F.when(F.abs(base) > 1e-9, 100.0 * (value - base) / base)


def with_divergence(df: DataFrame, flag_pct: float = config.MODEL.divergence_flag_pct) -> DataFrame:
    df = df.withColumn("divergence_pct", divergence_pct(F.col("mult_potential"), F.col("ensemble_potential")))
    return df.withColumn("divergence_flag", S.flag(F.abs("divergence_pct") > flag_pct))


def with_estimates(
    features: DataFrame,
    seasonality: DataFrame | None,
    season: config.Season = config.SEASON,
    rules: config.ModelRules = config.MODEL,
) -> DataFrame:
    """All estimates for features that have ``peer_cluster`` and ``quantile_regression``."""
    df = with_multiplicative(with_peer_ceiling(features, rules), rules)
    df = with_extrapolation(df, seasonality, season, rules)
    ensemble = floored_blend(blend(dict(rules.weights)), F.col("hist_total_max"), rules.floor_multiplier)
    return with_divergence(df.withColumn("ensemble_potential", ensemble), rules.divergence_flag_pct)


# ---------------------------------------------------------------------------
# Outputs
# ---------------------------------------------------------------------------


def prediction_faults(df: DataFrame) -> DataFrame:
    """One row: predictions missing and predictions below 0."""
    p = F.col("mult_potential")
    return df.agg(
        F.count_if(p.isNull() | F.isnan(p)).alias("n_missing"), F.count_if(p < 0).alias("n_negative")
    )


def require_sound(df: DataFrame) -> None:
    faults = prediction_faults(df).first()
    if faults.n_missing or faults.n_negative:
        raise ValueError(f"{faults.n_missing} predictions missing, {faults.n_negative} negative")


def factor_table(df: DataFrame) -> DataFrame:
    factors = [F.coalesce(F.col(c), F.lit(1.0)).alias(c) for c in FACTORS[1:]]
    return df.select(
        "outlet_id",
        "peer_ceiling",
        *factors,
        "mult_potential",
        "ensemble_potential",
        "divergence_pct",
        "divergence_flag",
        F.coalesce("hist_total_max", F.lit(0.0)).alias("hist_total_max"),
    )


def diagnostics_table(df: DataFrame) -> DataFrame:
    return df.select("outlet_id", *ESTIMATORS, "ensemble_potential", "mult_potential", "divergence_pct")


def predictions(df: DataFrame) -> DataFrame:
    """The deliverable; half-way cases round to the even digit."""
    return df.select(
        F.col("outlet_id").alias("Outlet_ID"), F.bround("mult_potential", 2).alias("Maximum_Monthly_Liters")
    )


def divergence_summary(df: DataFrame) -> DataFrame:
    """One row. Outlets without a divergence count in the share's denominator."""
    size = F.abs("divergence_pct")
    q = quantiles.global_quantiles(df, {"d": size}, [0.5, 0.9]).getField("d")
    return df.agg(
        F.avg(size).alias("mean_abs_divergence_pct"),
        F.avg(S.flag(size <= 25).cast("int")).alias("share_within_25pct"),
        F.count_if(F.col("divergence_flag")).alias("n_flagged_outlets"),
    ).select(
        q.getItem(0).alias("median_abs_divergence_pct"),
        "mean_abs_divergence_pct",
        q.getItem(1).alias("p90_abs_divergence_pct"),
        "share_within_25pct",
        "n_flagged_outlets",
    )


def describe_factors(df: DataFrame, columns: Sequence[str] = FACTORS) -> DataFrame:
    """``factor, min, p50, mean, max``."""
    medians = quantiles.exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("factor"), F.min(c).alias("min"), F.avg(c).alias("mean"), F.max(c).alias("max")
            )
            for c in columns
        ]
    )
    # A row per factor: as few as there are columns.
    stats = df.agg(rows.alias("r")).select(F.inline("r"))
    medians = medians.select(F.col("metric").alias("factor"), F.col("q")[0].alias("p50"))
    return stats.join(F.broadcast(medians), "factor", "left").select("factor", "min", "p50", "mean", "max")


def coverage(df: DataFrame, columns: Sequence[str] = ESTIMATORS) -> DataFrame:
    """``estimator, n`` present values and their share."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("estimator"), F.count(c).alias("n"), (F.count(c) / F.count("*")).alias("share"))
            for c in columns
        ]
    )
    return df.agg(rows.alias("r")).select(F.inline("r"))


def rank_agreement(df: DataFrame, columns: Sequence[str] = ESTIMATORS) -> DataFrame:
    """Spearman correlation of every two estimators."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return quantiles.spearman(df, pairs)


def uplift_over_history(df: DataFrame, probs: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)) -> DataFrame:
    """Distribution of estimate / own maximum, and how many estimates lie below the maximum (none should)."""
    d = df.withColumn("_u", S.finite(S.ratio(F.col("ensemble_potential"), F.coalesce("hist_total_max", F.lit(0.0)))))
    q = quantiles.global_quantiles(d, {"u": F.col("_u")}, list(probs)).getField("u")
    below = F.count_if(F.col("ensemble_potential") < F.coalesce("hist_total_max", F.lit(0.0)))
    return d.agg(
        F.count("_u").alias("n"),
        F.avg("_u").alias("mean"),
        F.stddev_samp("_u").alias("std"),
        F.min("_u").alias("min"),
        F.max("_u").alias("max"),
        below.alias("n_below_floor"),
    ).select(
        "n", "mean", "std", "min", *[q.getItem(i).alias(f"p{round(p * 100)}") for i, p in enumerate(probs)], "max",
        "n_below_floor",
    )


def relative_changes(df: DataFrame, base: Column, variants: Mapping[str, Column]) -> DataFrame:
    """``perturbation, median_rel_change`` of each variant from the base."""
    change = {name: F.abs(v - base) / F.nullif(base, F.lit(0.0)) for name, v in variants.items()}
    out = quantiles.exact_quantiles(df, change, [0.5])
    return out.select(F.col("metric").alias("perturbation"), F.col("q")[0].alias("median_rel_change"))


def peer_weight(share: float) -> dict[str, float]:
    """Weights with a given share for the peers and the rest split evenly."""
    rest = (1 - share) / 2
    return {"peer_ceiling": share, "quantile_regression": rest, "unconstrained_extrapolation": rest}


def weight_sweep(df: DataFrame, shares: Sequence[float] = (0.3, 0.4, 0.5)) -> DataFrame:
    """How much the blend moves with the peers' weight."""
    return relative_changes(df, blend(), {f"w_peer={s}": blend(peer_weight(s)) for s in shares})
