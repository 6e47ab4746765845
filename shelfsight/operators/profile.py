"""Profiling queries: what a table looks like before and after cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfsight import config
from shelfsight.functions import quantiles, scalar as S
from shelfsight.operators.checks import FAILED_STEP


def dataset_sizes(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``dataset, rows, columns`` per table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_fractions(df: DataFrame, top: int = 15) -> DataFrame:
    """``column, null_fraction`` of the columns with most missing values."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.avg(F.col(f"`{c}`").isNull().cast("int")).alias("null_fraction"))
            for c in df.columns
        ]
    )
    return df.agg(rows.alias("r")).select(F.inline("r")).orderBy(F.col("null_fraction").desc(), "column").limit(top)


def date_range(df: DataFrame, column: str) -> DataFrame:
    """First and last date; text that is no date is passed over."""
    at = S.timestamp(df, column)
    return df.agg(F.min(at).alias("first_date"), F.max(at).alias("last_date"))


def rejections_by(rejected: DataFrame, key: str, top: int = 10) -> DataFrame:
    return rejected.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rejections")).orderBy(
        F.col("rejections").desc(), key
    ).limit(top)


def rejection_rate(tagged: DataFrame) -> DataFrame:
    out = F.col(FAILED_STEP).isNotNull()
    return tagged.agg(
        F.count_if(out).alias("rejected"), F.count("*").alias("rows"), F.avg(out.cast("int")).alias("rejection_rate")
    )


def dark_days(rejected: DataFrame, distributor: str, date: str) -> DataFrame:
    """Blackout days per distributor."""
    return rejected.groupBy(distributor).agg(F.count_distinct(date).alias("blackout_days"))


def tag_rate(tagged: DataFrame, flag: str, key: str) -> DataFrame:
    """Share of tagged rows and number of keys with a tagged row."""
    return tagged.agg(
        F.avg(F.col(flag).cast("int")).alias("tag_rate"), F.count_distinct(F.when(F.col(flag), F.col(key))).alias("keys_tagged")
    )


def master_sanity(df: DataFrame, key: str, *others: str) -> DataFrame:
    """Rows, distinct keys and distinct values of further columns."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias(f"distinct_{key}"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in others],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing included."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def out_of_bounds(
    df: DataFrame,
    lat_bounds: tuple[float, float] = config.LAT_BOUNDS,
    lon_bounds: tuple[float, float] = config.LON_BOUNDS,
) -> DataFrame:
    """Rows with a coordinate outside the bounds or without one."""
    inside = S.flag(F.col("latitude").between(*lat_bounds)) & S.flag(F.col("longitude").between(*lon_bounds))
    return df.agg(F.count_if(~inside).alias("out_of_bounds"))


def top_reasons(rejected: DataFrame, top: int = 3) -> DataFrame:
    """Most frequent rejection reasons per dataset."""
    counts = rejected.groupBy(F.col("_dataset").alias("dataset"), F.col("failure_reason").alias("reason")).agg(
        F.count("*").alias("n")
    )
    # There are only as many rows here as there are different reasons.
    order = Window.partitionBy("dataset").orderBy(F.col("n").desc(), "reason")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def constraint_coverage(monthly: DataFrame, features: DataFrame) -> DataFrame:
    free = F.coalesce("months_unconstrained", F.lit(0))
    share = monthly.agg(F.avg(F.col("is_constrained").cast("int")).alias("s")).scalar()
    return features.agg(
        F.count_if(free >= 1).alias("outlets_with_1_free_month"),
        F.count_if(free >= 2).alias("outlets_with_2_free_months"),
        F.count("*").alias("outlets_total"),
    ).withColumn("constrained_share", share)


def free_month_counts(features: DataFrame) -> DataFrame:
    """Outlets by number of unconstrained months."""
    free = F.coalesce("months_unconstrained", F.lit(0)).alias("months_unconstrained")
    return features.groupBy(free).agg(F.count("*").alias("outlets")).orderBy("months_unconstrained")


def flag_rates(monthly: DataFrame) -> DataFrame:
    flags = ("low_volume_flag", "low_sku_diversity_flag", "credit_cap_flag", "is_constrained")
    return monthly.agg(*[F.avg(F.col(f).cast("int")).alias(f) for f in flags])


def variation_by_outlet(monthly: DataFrame) -> DataFrame:
    """Coefficient of variation of each outlet's months, as sold and deflated, where both exist."""

    def cv(name: str) -> Column:
        return F.when((F.count(name) > 1) & (F.avg(name) > 0), S.ratio(F.stddev_samp(name), F.avg(name)))

    return (
        monthly.where("outlet_id is not null")
        .groupBy("outlet_id")
        .agg(cv("volume_total").alias("cv_raw"), cv("volume_total_deflated").alias("cv_deflated"))
        .where("cv_raw is not null and cv_deflated is not null")
    )


def median_variation(monthly: DataFrame) -> DataFrame:
    q = quantiles.quantile_row(
        variation_by_outlet(monthly), {"r": F.col("cv_raw"), "d": F.col("cv_deflated")}, [0.5]
    )
    return q.select(F.col("r")[0].alias("median_cv_raw"), F.col("d")[0].alias("median_cv_deflated"))


def without_poi(features: DataFrame) -> DataFrame:
    """Outlets none of whose point-of-interest columns has a value."""
    names = [c for c in features.columns if c.startswith("poi_") and c != "poi_accessibility"]
    return features.agg(F.count_if(S.all_of(F.col(c).isNull() for c in names)).alias("outlets_without_poi"))


def describe(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, n, mean, std, min, p…, max`` with exact percentiles."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            )
            for c in columns
        ]
    )
    stats = df.agg(rows.alias("r")).select(F.inline("r"))
    q = quantiles.exact_quantiles(df, {c: F.col(c) for c in columns}, list(probs))
    q = q.select(F.col("metric").alias("column"), *[F.col("q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)])
    # Both sides have one row per described column.
    return stats.join(F.broadcast(q), "column", "left")


def log_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``estimator, log_value`` of the finite values, for a histogram per estimator."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("estimator"), F.log1p(S.finite(F.col(c).cast("double"))).alias("log_value")) for c in columns]
    )
    return df.select(F.inline(rows)).where("log_value is not null and not isnan(log_value)")


def log_histogram(df: DataFrame, columns: Sequence[str], width: float = 0.1) -> DataFrame:
    """``estimator, bin_start, n`` of log1p values in bins of fixed width."""
    bins = log_values(df, columns).select("estimator", F.floor(F.col("log_value") / width).alias("_b"))
    return bins.groupBy("estimator", (F.col("_b") * width).alias("bin_start")).agg(F.count("*").alias("n"))
