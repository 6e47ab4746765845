"""Places in a total order, without a task that sees all rows.

Rows are dealt to partitions by ranges of the order, which Spark samples. The
sizes of the partitions, one row each, are summed up along the order; the place
of a row is the sum before its partition plus its place inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfsight.session import stage


def in_ranges(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows as a written table with ``_part``, which grows with the order. Equal rows share a part."""
    return stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)


def first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The ``n`` first rows in an order that tells all rows apart.

    Parts wholly among them are taken as they are; only the one part that the
    cut goes through is ordered.
    """
    placed = in_ranges(df, order, "in_ranges")
    sums = Window.orderBy("_part")  # over one row per part
    parts = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    parts = stage(parts.withColumn("_upto", F.sum("_size").over(sums)), "part_sizes")
    whole = placed.join(parts.where(F.col("_upto") <= n), "_part", "left_semi").drop("_part")
    cut = parts.where((F.col("_upto") > n) & (F.col("_upto") - F.col("_size") < n)).first()
    if cut is None:
        return whole
    rest = placed.where(F.col("_part") == cut["_part"]).drop("_part").orderBy(*order).limit(n - cut["_upto"] + cut["_size"])
    return whole.unionByName(rest)


def average_ranks(counts: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """``counts`` with ``rank`` and ``size`` of each distinct value among the rows of its keys.

    ``counts`` holds each distinct value of a group of keys once, with the rows
    that have it; equal values share their mean rank, the first rank is 1. Groups
    may be of any size and number.
    """
    keys = list(keys)
    placed = in_ranges(counts, [*keys, value], "values_in_ranges")
    along = Window.partitionBy(*keys).orderBy("_part")  # a row per part
    sums = placed.groupBy(*keys, "_part").agg(F.sum(n).alias("_sum"))
    sums = sums.withColumns(
        {"_before": F.sum("_sum").over(along) - F.col("_sum"), "size": F.sum("_sum").over(Window.partitionBy(*keys))}
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum(n).over(inside)).join(sums.drop("_sum"), [*keys, "_part"])
    rank = F.col("_before") + F.col("_upto") - F.col(n) + (F.col(n) + 1) / 2
    return ranked.withColumn("rank", rank).drop("_part", "_upto", "_before")
