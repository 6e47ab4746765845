"""Enrichment of the cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight import config
from shelfsight.functions import scalar as S


def season_to_number(seasonality: DataFrame, mapping: Mapping[str, float] = config.SEASON_INDEX) -> DataFrame:
    """Replace the season label by its index and keep the label."""
    if "seasonality_index" not in seasonality.columns:
        return seasonality
    label = S.strip(F.col("seasonality_index"))
    return seasonality.withColumn("seasonality_label", label).withColumn(
        "seasonality_index", S.lookup(F.col("seasonality_label"), mapping).cast("double")
    )


def with_coordinates(outlets: DataFrame, coordinates: DataFrame) -> DataFrame:
    # A row per outlet: a file of keys looks small enough to broadcast, whatever the rows made of it.
    return outlets.join(coordinates.select("outlet_id", "latitude", "longitude").hint("merge"), "outlet_id", "left")


def main_distributor(transactions: DataFrame) -> DataFrame:
    """The distributor with most lines per outlet; the smaller id wins a tie.

    Two aggregates: the first shrinks the lines to one row per pair, so an
    outlet with very many lines is no heavier than any other in the second.
    """
    pairs = (
        transactions.where("distributor_id is not null and outlet_id is not null")
        .groupBy("outlet_id", "distributor_id")
        .agg(F.count("*").alias("_n"))
    )
    return pairs.groupBy("outlet_id").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("distributor_id").alias("d")))["d"].alias("distributor_id")
    )


def province_of(distributor: Column, prefixes: Mapping[str, str] = config.PROVINCE_BY_PREFIX) -> Column:
    """Province by id prefix, first match wins, NULL without one."""
    out = None
    for prefix, province in prefixes.items():
        hit = distributor.startswith(prefix)
        out = F.when(hit, F.lit(province)) if out is None else out.when(hit, F.lit(province))
    return out


def enrich_outlets(
    outlets: DataFrame, coordinates: DataFrame | None = None, transactions: DataFrame | None = None
) -> DataFrame:
    df = outlets
    if coordinates is not None:
        df = with_coordinates(df, coordinates)
    if transactions is not None and "distributor_id" in transactions.columns:
        df = df.join(main_distributor(transactions), "outlet_id", "left")
    if "distributor_id" in df.columns:
        return df.withColumn("province", province_of(F.col("distributor_id")))
    return df.withColumn("province", F.lit(None).cast("string"))


def join_coverage(outlets: DataFrame) -> DataFrame:
    """How many outlets got coordinates and a distributor."""
    present = {c: F.count(S.col_or(outlets, c, None)) for c in ("latitude", "distributor_id")}
    return outlets.agg(
        present["latitude"].alias("outlets_with_coords"),
        present["distributor_id"].alias("outlets_with_distributor"),
        F.count("*").alias("outlets_total"),
    )
