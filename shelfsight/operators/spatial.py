"""Spatial factors of an outlet: competition, accessibility, and the multiplier made of them."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight import config
from shelfsight.functions import quantiles, scalar as S
from shelfsight.operators.geo import counts_within, places
from shelfsight.session import stage

# IQR of a standard normal distribution.
_NORMAL_IQR = 1.349


def with_own_density(features: DataFrame, radius_m: float = config.SPATIAL.own_radius_m, direct: int = 1024) -> DataFrame:
    """``own_network_density``: other outlets within the radius; 0 without coordinates.

    Positions are collapsed first, so outlets at one spot are counted, not
    paired; see :func:`counts_within` for the rest and for ``direct``.
    """
    if not {"latitude", "longitude"} <= set(features.columns):
        return features.withColumn("own_network_density", F.lit(0.0))
    spots = places(features, "latitude", "longitude", count="_here")
    near = counts_within(spots, "latitude", "longitude", "_here", radius_m, direct)
    df = features.join(near, ["latitude", "longitude"], "left")
    density = F.coalesce((F.col("within") - 1).cast("double"), F.lit(0.0))
    return df.withColumn("own_network_density", density).drop("within")


def accessibility(
    df: DataFrame,
    radius_m: int = max(config.SPATIAL.radii_m),
    weights: Mapping[str, float] = config.POI_DEMAND_WEIGHT,
) -> Column:
    """Demand-weighted sum of the decayed pulls at the widest radius."""
    score = F.lit(0.0)
    for category, weight in weights.items():
        name = f"poi_access_{category}_{radius_m}m"
        if weight > 0 and name in df.columns:
            score = score + weight * F.coalesce(F.col(name), F.lit(0.0))
    return score


def saturation(df: DataFrame, rules: config.SpatialRules = config.SPATIAL) -> Column:
    shops = S.col_or(df, f"poi_count_shop_{rules.shop_radius_m}m", 0).cast("double")
    own = F.coalesce(F.col("own_network_density"), F.lit(0.0))
    return own + rules.shop_weight * F.coalesce(shops, F.lit(0.0))


def robust_scales(df: DataFrame, values: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Centre and scale of each value over the whole table.

    Scale is IQR / 1.349; with an IQR of 0 the population standard deviation,
    and 1 if that is 0 too. This runs a job and brings back one row, as fitting
    a scaler does: what is built on the numbers then reads its input once.
    """
    quartiles = quantiles.quantile_row(df, values, [0.25, 0.5, 0.75]).first()
    spread = df.agg(*[F.stddev_pop(S.not_nan(v)).alias(n) for n, v in values.items()]).first()
    out = {}
    for name in values:
        low, middle, high = quartiles[name] or (0.0, 0.0, 0.0)
        scale = (high - low) / _NORMAL_IQR if high > low else spread[name] or 1.0
        out[name] = (middle, scale if math.isfinite(scale) else 1.0)
    return out


def with_robust_z(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """A column per value: (value − median) / scale, 0 where the value is missing."""
    scales = robust_scales(df, values)
    return df.withColumns({n: F.coalesce((v - scales[n][0]) / scales[n][1], F.lit(0.0)) for n, v in values.items()})


def with_multiplier(df: DataFrame, rules: config.SpatialRules = config.SPATIAL) -> DataFrame:
    """``spatial_multiplier`` from ``poi_accessibility`` and ``saturation_index``.

    Both are compressed by log1p and standardised; the result is moved so that
    the median outlet has 1, then clamped. Two one-row jobs over the two columns
    find the quartiles and that median, so ``df`` should be a written table.
    """
    logs = {
        "_z_access": F.log1p(S.clip(F.col("poi_accessibility"), low=0.0)),
        "_z_saturation": F.log1p(S.clip(F.col("saturation_index"), low=0.0)),
    }
    z = with_robust_z(df, logs)
    raw = rules.access_beta * F.col("_z_access") - rules.saturation_beta * F.col("_z_saturation")
    middle = quantiles.quantile_row(z, {"raw": raw}, [0.5]).first()["raw"]
    low, high = rules.clamp
    moved = 1.0 + (raw - (middle[0] if middle else 0.0))
    return z.withColumn("spatial_multiplier", S.clip(moved, low, high)).drop(*logs)


def with_spatial_inputs(features: DataFrame, rules: config.SpatialRules = config.SPATIAL) -> DataFrame:
    df = with_own_density(features, rules.own_radius_m)
    df = df.withColumn("poi_accessibility", accessibility(df, max(rules.radii_m)))
    return df.withColumn("saturation_index", saturation(df, rules))


def with_spatial_factors(features: DataFrame, rules: config.SpatialRules = config.SPATIAL) -> DataFrame:
    """Density, accessibility, saturation and multiplier, with a written table in between."""
    return with_multiplier(stage(with_spatial_inputs(features, rules), "spatial_inputs"), rules)


def spatial_report(df: DataFrame) -> DataFrame:
    """Medians of accessibility and saturation; smallest, median and largest multiplier."""
    medians = quantiles.quantile_row(
        df, {c: F.col(c) for c in ("poi_accessibility", "saturation_index", "spatial_multiplier")}, [0.0, 0.5, 1.0]
    )
    return medians.select(
        F.col("poi_accessibility")[1].alias("accessibility_median"),
        F.col("saturation_index")[1].alias("saturation_median"),
        F.col("spatial_multiplier")[0].alias("multiplier_min"),
        F.col("spatial_multiplier")[1].alias("multiplier_median"),
        F.col("spatial_multiplier")[2].alias("multiplier_max"),
    )
