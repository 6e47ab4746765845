"""Outlet-by-month table, outlet features and the factors derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfsight import config
from shelfsight.functions import quantiles, scalar as S
from shelfsight.session import stage

MONTH_KEYS = ("outlet_id", "year", "month")
CATEGORIES = {
    "outlet_size": ("size", config.OUTLET_SIZE_VALUES),
    "outlet_type": ("type", config.OUTLET_TYPE_VALUES),
    "province": ("prov", config.PROVINCE_VALUES),
}


def split_volumes(transactions: DataFrame) -> DataFrame:
    """Numbers as numbers, and the volume split into returns, purchases and absolute volume."""
    df = transactions
    for name in ("year", "month"):
        df = df.withColumn(name, S.number(df, name).cast("int"))
    for name in ("volume_liters", "total_bill_value"):
        df = df.withColumn(name, S.number(df, name))
    volume = F.col("volume_liters")
    returned = S.flag(F.col("_is_return")) if "_is_return" in df.columns else S.flag(volume < 0)
    return df.withColumn("_is_return", returned).withColumns(
        {
            "_returns_vol": F.when(F.col("_is_return"), -volume).otherwise(0.0),
            "_purchase_vol": F.when(~F.col("_is_return"), volume).otherwise(0.0),
            "_abs_vol": F.abs(volume),
        }
    )


def monthly_totals(lines: DataFrame, order: Sequence[str]) -> DataFrame:
    """Lines summed up to outlet × month; rows with missing keys stay.

    The distributor is the one of the first line in ``order`` that has one.

    Two hash aggregates, by product and then by month, sum up the lines and count
    the products. The first distributor has a pass and an aggregate of its own, as
    the least of a struct takes a sort. In all of them the lines of a month combine
    before the shuffle; the lines themselves are not shuffled, and each pass reads
    only the columns it needs.
    """
    sums = {
        "volume_total": "volume_liters", "volume_gross": "_abs_vol", "volume_returns": "_returns_vol",
        "volume_purchases": "_purchase_vol", "bill_total": "total_bill_value",
    }
    by_product = lines.groupBy(*MONTH_KEYS, "sku_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count("*").alias("n_lines"))
    months = by_product.groupBy(*MONTH_KEYS).agg(
        *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in sums], F.count("sku_id").alias("sku_diversity"), F.sum("n_lines").alias("n_lines")
    )
    months = stage(months, "month_totals")
    first = lines.where("distributor_id is not null").groupBy(*MONTH_KEYS).agg(F.min_by("distributor_id", F.struct(*order)).alias("distributor_id"))
    first = stage(first, "first_distributors").select(*[F.col(k).alias(f"_m_{k}") for k in MONTH_KEYS], "distributor_id")
    same = S.all_of(F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in MONTH_KEYS)
    return months.join(first, same, "left").select(*MONTH_KEYS, *sums, "sku_diversity", "n_lines", "distributor_id")


def with_return_share(monthly: DataFrame) -> DataFrame:
    share = S.ratio(F.col("volume_returns"), F.col("volume_gross"))
    return monthly.withColumn("return_share", F.coalesce(share, F.lit(0.0)))


def low_volume(volume: Column, share: float = config.CONSTRAINTS.low_volume_share) -> Column:
    """Sold something, but less than a share of the outlet's median month.

    An outlet has at most one row per month, so its window is small by nature.
    """
    median = F.median(volume).over(Window.partitionBy("outlet_id"))
    has_outlet = F.col("outlet_id").isNotNull()
    return S.flag(has_outlet & (volume > 0) & (volume < share * median))


def few_skus(skus: Column, minimum: int = config.CONSTRAINTS.min_skus) -> Column:
    return S.flag(skus < minimum)


def round_volume(volume: Column, moduli: Sequence[int] = config.CONSTRAINTS.round_moduli) -> Column:
    size = F.abs(volume)
    return S.flag((size > 0) & S.any_of(size % m == 0 for m in moduli))


def flag_constraints(monthly: DataFrame, rules: config.ConstraintRules = config.CONSTRAINTS) -> DataFrame:
    volume = F.col("volume_total")
    return monthly.withColumns(
        {
            "low_volume_flag": low_volume(volume, rules.low_volume_share),
            "low_sku_diversity_flag": few_skus(F.col("sku_diversity"), rules.min_skus),
            "credit_cap_flag": round_volume(volume, rules.round_moduli),
        }
    ).withColumn(
        "is_constrained", F.col("low_volume_flag") | F.col("low_sku_diversity_flag") | F.col("credit_cap_flag")
    )


def one_per_key(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = ()) -> DataFrame:
    """One value per key: the first in ``order``, without one the largest."""
    chosen = F.min_by(value, F.struct(*order)) if order else F.max(value)
    return df.groupBy(*keys).agg(chosen.alias(value))


def deflate(monthly: DataFrame, seasonality: DataFrame | None, season_order: Sequence[str] = ()) -> DataFrame:
    """Join the season index and divide the volume by it; missing or 0 counts as 1."""
    index = F.lit(None).cast("double")
    df = monthly
    if seasonality is not None and "seasonality_index" in seasonality.columns:
        keys = [c for c in ("distributor_id", "year", "month") if c in seasonality.columns and c in monthly.columns]
        if keys:
            # As a written table it has a known size: small, it is broadcast and the months stay in place.
            df = df.join(stage(one_per_key(seasonality, keys, "seasonality_index", season_order), "season"), keys, "left")
            index = F.col("seasonality_index")
    index = F.coalesce(F.nullif(index, F.lit(0.0)), F.lit(1.0))
    return df.withColumn("seasonality_index", index).withColumn(
        "volume_total_deflated", F.col("volume_total") / F.col("seasonality_index")
    )


def outlet_monthly(
    transactions: DataFrame,
    seasonality: DataFrame | None,
    order: Sequence[str],
    rules: config.ConstraintRules = config.CONSTRAINTS,
) -> DataFrame:
    monthly = with_return_share(monthly_totals(split_volumes(transactions), order))
    # Season first: the flags' window then leaves the rows partitioned by outlet,
    # which the outlet roll-up can use without another shuffle.
    return flag_constraints(deflate(monthly, seasonality), rules)


# ---------------------------------------------------------------------------
# Outlet roll-up
# ---------------------------------------------------------------------------


def roll_up(monthly: DataFrame) -> DataFrame:
    """All months and the unconstrained months of each outlet, in one pass."""
    volume, deflated = F.col("volume_total"), F.col("volume_total_deflated")
    held = F.col("is_constrained")
    free = F.when(~held, deflated)
    return (
        monthly.where("outlet_id is not null")
        .groupBy("outlet_id")
        .agg(
            F.count("*").alias("months_observed"),
            F.count_if(held).alias("months_constrained"),
            F.count_if(~held).alias("months_unconstrained"),
            F.avg(volume).alias("hist_total_mean"),
            F.median(volume).alias("hist_total_median"),
            F.percentile(volume, F.lit(0.75)).alias("hist_total_p75"),
            F.percentile(volume, F.lit(0.90)).alias("hist_total_p90"),
            F.percentile(volume, F.lit(0.95)).alias("hist_total_p95"),
            F.max(volume).alias("hist_total_max"),
            F.stddev_samp(volume).alias("hist_total_std"),
            F.max(deflated).alias("hist_deflated_max"),
            F.percentile(deflated, F.lit(0.90)).alias("hist_deflated_p90"),
            F.avg("sku_diversity").alias("hist_sku_diversity_mean"),
            F.max("sku_diversity").alias("hist_sku_diversity_max"),
            F.avg("return_share").alias("hist_return_share_mean"),
            F.avg("bill_total").alias("hist_bill_total_mean"),
            F.max(free).alias("unc_deflated_max"),
            F.percentile(free, F.lit(0.90)).alias("unc_deflated_p90"),
            F.avg(free).alias("unc_deflated_mean"),
            F.nullif(F.count_if(~held), F.lit(0)).alias("unc_months"),
        )
    )


def vocabulary(
    df: DataFrame, known: Mapping[str, tuple[str, Sequence[str]]] = CATEGORIES, widest: int = 200
) -> dict[str, tuple[str, list[str]]]:
    """The categories to give columns to: the known values, and of the others present the ``widest`` most frequent.

    The values are counted where they are; no more than ``widest`` of a column
    come to the driver, whatever it holds. What is left over is kept by
    :func:`one_hot` in another form.
    """
    out = {}
    for column, (prefix, values) in known.items():
        if column in df.columns:
            other = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).count()
            most = other.orderBy(F.col("count").desc(), column).limit(widest).collect()
            out[column] = (prefix, [*values, *sorted(r[0] for r in most)])
    return out


def one_hot(df: DataFrame, categories: Mapping[str, tuple[str, Sequence[str]]] = CATEGORIES, rest: bool = False) -> DataFrame:
    """A 0/1 column ``<prefix>_<value>`` per listed value; a missing value has 0 in all.

    With ``rest`` a value that is not listed is 1 in the map ``<prefix>_rest``,
    a sparse row of the columns it would have needed.
    """
    new = {}
    for column, (prefix, values) in categories.items():
        if column in df.columns:
            new |= {f"{prefix}_{value}": S.flag(F.col(column) == value).cast("int") for value in values}
            if rest:
                unlisted = F.col(column).isNotNull() & ~F.col(column).isin(*values)
                new[f"{prefix}_rest"] = F.when(unlisted, F.create_map(F.col(column), F.lit(1)))
    return df.withColumns(new) if new else df


def with_ratios(df: DataFrame) -> DataFrame:
    mean = F.col("hist_total_mean")
    return df.withColumns(
        {
            "volume_cv": S.finite(S.ratio(F.col("hist_total_std"), mean)),
            "max_to_mean_ratio": S.finite(S.ratio(F.col("hist_total_max"), mean)),
        }
    )


def outlet_features(
    outlets: DataFrame,
    monthly: DataFrame,
    poi: DataFrame | None = None,
    categories: Mapping[str, tuple[str, Sequence[str]]] | None = None,
) -> DataFrame:
    """Without ``categories`` they are those of :func:`vocabulary`, counted over the outlets.

    The outlets are then written first: what they are made of is not worked out
    again for each column that is counted.
    """
    if categories is None:
        outlets = stage(outlets, "outlets")
        categories = vocabulary(outlets)
    df = outlets.join(roll_up(monthly), "outlet_id", "left")
    if poi is not None and "outlet_id" in poi.columns:
        df = df.join(poi.hint("merge"), "outlet_id", "left")  # mostly zeros in its file, but a row per outlet
    return with_ratios(one_hot(df, categories))


# ---------------------------------------------------------------------------
# Factors
# ---------------------------------------------------------------------------


def gap_ratio(features: DataFrame, rules: config.ConstraintRules = config.CONSTRAINTS) -> Column:
    """Mean deflated unconstrained month over mean month, within [1, cap].

    The numerator is deflated and the denominator is not; the factor is defined so.
    """
    free = S.col_or(features, "unc_deflated_mean", None).cast("double")
    usual = S.col_or(features, "hist_total_mean", None).cast("double")
    return S.clip(S.finite(S.ratio(free, usual)), 1.0, rules.gap_cap)


def with_constraint_uplift(features: DataFrame, rules: config.ConstraintRules = config.CONSTRAINTS) -> DataFrame:
    """How far sales were held back: 1 + share of constrained months × (gap − 1).

    An outlet without an unconstrained month takes the median gap of all outlets.
    """
    df = features.withColumn("_gap", gap_ratio(features, rules))
    usual_gap = F.coalesce(quantiles.global_median(df, F.col("_gap")), F.lit(1.0))
    observed = S.col_or(df, "months_observed", None).cast("double")
    held = S.col_or(df, "months_constrained", None).cast("double")
    share = F.coalesce(S.clip(S.ratio(held, observed), 0.0, 1.0), F.lit(0.0))
    gap = F.coalesce(F.col("_gap"), usual_gap)
    return df.withColumn("constraint_uplift", S.clip(1.0 + share * (gap - 1.0), 1.0, rules.uplift_cap)).drop("_gap")


def target_season(seasonality: DataFrame, season: config.Season = config.SEASON) -> DataFrame:
    """``distributor_id, season_index`` of the target month.

    The fallback year is used only when the target year has no row at all for
    the month, not distributor by distributor.
    """
    s = seasonality.select(
        "distributor_id",
        S.number(seasonality, "month").alias("m"),
        (S.number(seasonality, "year") if "year" in seasonality.columns else F.lit(season.year).cast("double")).alias("y"),
        S.number(seasonality, "seasonality_index").alias("seasonality_index"),
    ).where((F.col("m") == season.month) & F.col("y").isin(season.year, season.fallback_year))
    has_target = s.agg(F.coalesce(F.max(F.col("y") == season.year), F.lit(False)).alias("h")).scalar()
    year = F.when(has_target, F.lit(season.year)).otherwise(F.lit(season.fallback_year))
    return one_per_key(s.where(F.col("y") == year), ["distributor_id"], "seasonality_index").withColumnRenamed(
        "seasonality_index", "season_index"
    )


def with_season_index(
    features: DataFrame, seasonality: DataFrame | None, season: config.Season = config.SEASON
) -> DataFrame:
    if seasonality is None or "distributor_id" not in features.columns:
        return features.withColumn("seasonality_jan_index", F.lit(1.0))
    df = features.join(target_season(seasonality, season), "distributor_id", "left")
    index = F.coalesce(F.nullif(F.col("season_index"), F.lit(0.0)), F.lit(1.0))
    return df.withColumn("seasonality_jan_index", index).drop("season_index")
