"""Gold tables that many report queries read.

Each is worked out once per session and data directory and kept as a written
table in the shared folder, as a batch run would leave it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfsight.operators import budget, gold, model, poi, report, silver, spatial
from shelfsight.session import stage_path
from shelfsight.sources.adapters import TRANSACTION_ORDER, Tables

_WRITTEN: dict[tuple[str, str, str], tuple[str, object]] = {}


def _kept(t: Tables, name: str, build) -> DataFrame:
    key = (t.spark.sparkContext.applicationId, t.directory, name)
    if key not in _WRITTEN:
        path = stage_path(t.spark, name)
        df = build()
        df.write.mode("overwrite").parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return t.spark.read.schema(schema).parquet(path)


def outlet_master(t: Tables) -> DataFrame:
    return silver.enrich_outlets(t.outlets, t.coordinates, t.transactions)


def monthly_plan(t: Tables) -> DataFrame:
    return gold.outlet_monthly(t.transactions, t.seasonality, TRANSACTION_ORDER)


def monthly(t: Tables) -> DataFrame:
    return _kept(t, "outlet_monthly", lambda: monthly_plan(t))


def poi_wide(t: Tables) -> DataFrame:
    return _kept(t, "poi_features", lambda: poi.poi_features(t.coordinates, t.poi))


def features(t: Tables) -> DataFrame:
    """Outlet features without factors."""
    return _kept(t, "outlet_features", lambda: gold.outlet_features(outlet_master(t), monthly(t), poi_wide(t)))


def spatial_inputs(t: Tables) -> DataFrame:
    return _kept(
        t,
        "spatial_inputs",
        lambda: spatial.with_spatial_inputs(
            gold.with_season_index(gold.with_constraint_uplift(features(t)), t.seasonality)
        ),
    )


def factored(t: Tables) -> DataFrame:
    """Features with all factors, a given peer group and a stand-in for the regression estimate."""
    group = F.substring("outlet_id", 5, 18).cast("bigint") % 25
    stand_in = F.when(F.col("months_observed") >= 3, F.col("hist_deflated_p90") * 1.05)
    return _kept(
        t,
        "factored",
        lambda: spatial.with_multiplier(spatial_inputs(t)).withColumns(
            {"peer_cluster": group, "quantile_regression": stand_in}
        ),
    )


def scored(t: Tables) -> DataFrame:
    return _kept(t, "scored", lambda: model.with_estimates(factored(t), t.seasonality))


def allocated(t: Tables) -> DataFrame:
    s = scored(t)
    return _kept(t, "allocated", lambda: budget.allocate(budget.allocation_inputs(s, model.factor_table(s))))


def master(t: Tables) -> DataFrame:
    s = scored(t)
    spent = allocated(t)
    return report.master(s, model.factor_table(s), budget.allocation_deliverable(spent), spent)
