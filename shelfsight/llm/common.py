"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfsight.session import tune as tune_session

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space between the words of most contracts, as a class of a regular expression.
SPACE = r"\x20\x09-\x0D"


def tune(spark: SparkSession) -> SparkSession:
    """The library's run-time settings, and Arrow batches small enough for rows that hold long texts."""
    tune_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def fold(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. ASCII texts, told by their length in bytes, have a shorter way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it.

    The planner merges projections, so a column that a lambda reads would be
    made anew for each element; the variable of a lambda is not.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column, separators: str) -> Column:
    """The runs of characters outside a class, in order; none for a null or empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+"), "")


def if_small(df: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """A written table, marked for broadcast if its rows together are below a number of bytes as measured; else as it is, for a shuffled join."""
    size = F.lit(0)
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        size = size + (F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    total = df.select(F.sum(size + 16)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df
