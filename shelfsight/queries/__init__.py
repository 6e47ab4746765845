"""Queries over the given tables, by operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsight.operators import gold
from shelfsight.queries import budget_and_report, silver_and_gold, sources_and_checks, spatial_and_model
from shelfsight.queries.base import ORACLES, QUERIES, runner
from shelfsight.session import tune
from shelfsight.sources.adapters import TRANSACTION_ORDER, Tables

_ = (budget_and_report, silver_and_gold, sources_and_checks, spatial_and_model)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(name) for name in QUERIES}


def all_sql() -> dict[str, str]:
    return {name: text if isinstance(text, str) else text() for name, text in ORACLES.items()}


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    """Check the transactions, sum them up to months and outlets, best outlets first."""
    t = Tables(tune(spark), directory)
    clean = sources_and_checks.transactions_result(t).passing
    months = gold.outlet_monthly(clean, t.seasonality, TRANSACTION_ORDER)
    return gold.roll_up(months).orderBy(F.col("hist_total_p90").desc(), "outlet_id")
