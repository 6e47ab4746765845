"""The batch run: CSV exports to predictions and budget split, in six stages.

Every stage reads written tables and writes its own, so a stage can be rerun
alone and no plan reaches back further than one stage.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsight import config
from shelfsight.functions import scalar as S
from shelfsight.operators import budget, engine, gold, model, poi, quantile_regression, silver, spatial
from shelfsight.operators.checks import FAILED_STEP
from shelfsight.plans import cleaning
from shelfsight.session import scratch, tune
from shelfsight.sources import files

logger = logging.getLogger(__name__)

# Column types of the cleaned tables; the exports are read as text.
TYPES = {
    "year": "int",
    "month": "int",
    "cooler_count": "int",
    "volume_liters": "double",
    "total_bill_value": "double",
    "latitude": "double",
    "longitude": "double",
}


@dataclass(frozen=True)
class Layout:
    """Where the tables are. ``root`` is a folder all executors reach."""

    root: str
    team: str = "team"

    def raw(self, file: str) -> str:
        return f"{self.root}/raw/{file}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def checked(self, name: str) -> str:
        """All rows of a dataset with their verdict, split into two folders by it."""
        return f"{self.root}/silver/{name}"

    @property
    def outlets(self) -> str:
        return f"{self.root}/silver/outlets_enriched"

    @property
    def seasonality(self) -> str:
        return f"{self.root}/silver/seasonality_numeric"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver/_rejected"

    @property
    def poi_responses(self) -> str:
        return f"{self.root}/external/poi/raw"

    @property
    def poi_table(self) -> str:
        return f"{self.root}/external/poi/points"

    @property
    def poi_features(self) -> str:
        return f"{self.root}/external/poi/poi_features"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def prediction(self, name: str) -> str:
        return f"{self.root}/predictions/{name}"


# ---------------------------------------------------------------------------
# 1. Bronze
# ---------------------------------------------------------------------------


def ingest(spark: SparkSession, layout: Layout, sources: Mapping[str, str] = config.SOURCE_FILES) -> DataFrame:
    """Exports to parquet with canonical names; returns and writes the manifest.

    A missing export is noted and does not stop the others. Records with more
    fields than their header go to the quarantine.
    """
    entries, run_id = [], uuid.uuid4().hex
    for name, file in sources.items():
        source, target = layout.raw(file), layout.bronze(name)
        if not files.path_exists(spark, source):
            logger.warning("no source file for %s: %s", name, source)
            entries.append((name, source, None, None, None, None, "MISSING"))
            continue
        original, canonical, rows = files.ingest_csv(spark, source, target, layout.quarantine, name, run_id)
        entries.append((name, source, target, rows, original, canonical, "OK"))
    manifest = spark.createDataFrame(
        entries,
        "dataset string, source_path string, bronze_path string, rows bigint, columns_original array<string>, "
        "columns_canonical array<string>, status string",
    )
    present = [e[1] for e in entries if e[-1] == "OK"]
    if present:
        hashes = None
        for dataset, source, *_ in (e for e in entries if e[-1] == "OK"):
            part = files.file_hashes(spark, source).select(F.lit(dataset).alias("dataset"), F.struct("path", "bytes", "sha256").alias("file"))
            hashes = part if hashes is None else hashes.unionByName(part)
        manifest = manifest.join(hashes.groupBy("dataset").agg(F.collect_list("file").alias("source_files")), "dataset", "left")
    path = layout.bronze("_manifest")
    files.write_json(manifest, path)
    return spark.read.schema(manifest.schema).json(path)


# ---------------------------------------------------------------------------
# 2. Silver
# ---------------------------------------------------------------------------


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns({c: S.number(df, c).cast(TYPES[c]) for c in df.columns if c in TYPES})


def clean(spark: SparkSession, layout: Layout, name: str, specs, run_id: str) -> engine.CheckResult | None:
    """Check one dataset. The tagged rows are written once; passing rows, quarantine
    and summary are read off that table."""
    source = layout.bronze(name)
    if not files.path_exists(spark, source):
        logger.warning("no bronze table for %s: %s", name, source)
        return None
    df = spark.read.parquet(source)
    result = engine.run_checks(df, name, engine.fit_to_columns(specs, df.columns))
    status = F.when(F.col(FAILED_STEP).isNull(), "pass").otherwise("reject")
    files.write_parquet(result.tagged.withColumn("_status", status), layout.checked(name), ["_status"])
    written = result.over(spark.read.schema(result.tagged.schema).parquet(layout.checked(name)))
    files.append_quarantine(written.rejected, layout.quarantine, run_id)
    return written


def passing(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """Rows that passed, typed. Only their folder is read."""
    if not files.path_exists(spark, f"{layout.checked(name)}/_status=pass"):
        return None
    df = spark.read.parquet(layout.checked(name)).where("_status = 'pass'")
    return _typed(df.drop("_status", FAILED_STEP, "failure_reason"))


def clean_all(spark: SparkSession, layout: Layout) -> DataFrame:
    """All five datasets, then the enriched outlets and seasonality; returns the step summary."""
    run_id = uuid.uuid4().hex
    results = [
        clean(spark, layout, "outlets", cleaning.outlet_checks(), run_id),
        clean(spark, layout, "coordinates", cleaning.coordinate_checks(), run_id),
        clean(spark, layout, "seasonality", cleaning.season_checks(), run_id),
        clean(spark, layout, "holidays", cleaning.holiday_checks(), run_id),
    ]
    outlets = passing(spark, layout, "outlets")
    known = outlets if outlets is not None else spark.createDataFrame([], "outlet_id string")
    results.append(clean(spark, layout, "transactions", cleaning.transaction_checks(known.select("outlet_id")), run_id))
    if outlets is not None:
        enriched = silver.enrich_outlets(
            _without_source(outlets), passing(spark, layout, "coordinates"), passing(spark, layout, "transactions")
        )
        files.write_parquet(enriched, layout.outlets)
        files.write_json(silver.join_coverage(spark.read.parquet(layout.outlets)), layout.checked("_coverage"))
    season = passing(spark, layout, "seasonality")
    if season is not None:
        files.write_parquet(silver.season_to_number(season), layout.seasonality)
    summaries = [r.summary for r in results if r is not None]
    summary = engine.union_rejects(summaries).withColumn("run_id", F.lit(run_id))
    files.write_json(summary, layout.checked("_summary"))
    return spark.read.schema(summary.schema).json(layout.checked("_summary"))


def _without_source(df: DataFrame) -> DataFrame:
    return df.drop(*files.INGEST_ORDER)


def _optional(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if files.path_exists(spark, path) else None


# ---------------------------------------------------------------------------
# 3. Points of interest, 4. Gold
# ---------------------------------------------------------------------------


def build_poi(spark: SparkSession, layout: Layout, limit: int | None = None) -> DataFrame | None:
    """From a table of points if there is one, else from saved responses, else nothing."""
    outlets = spark.read.parquet(layout.outlets)
    points = _optional(spark, layout.poi_table)
    if points is not None:
        table = poi.poi_features(outlets, points, limit=limit)
    elif files.path_exists(spark, layout.poi_responses):
        table = poi.poi_features_from_responses(outlets, files.read_poi_responses(spark, layout.poi_responses), limit=limit)
    else:
        logger.info("no points of interest; features go without")
        return None
    files.write_parquet(table, layout.poi_features)
    return spark.read.parquet(layout.poi_features)


def build_gold(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """``outlet_monthly`` and ``outlet_features``."""
    season = _optional(spark, layout.seasonality)
    transactions = passing(spark, layout, "transactions")
    if transactions is None:
        raise FileNotFoundError(f"no cleaned transactions under {layout.checked('transactions')}")
    monthly = gold.outlet_monthly(transactions, season, files.INGEST_ORDER)
    files.write_parquet(monthly, layout.gold("outlet_monthly"))
    monthly = spark.read.parquet(layout.gold("outlet_monthly"))

    features = gold.outlet_features(spark.read.parquet(layout.outlets), monthly, _optional(spark, layout.poi_features))
    # Two written steps: the factors take medians over their whole input.
    files.write_parquet(features, layout.gold("_features_plain"))
    features = gold.with_constraint_uplift(spark.read.parquet(layout.gold("_features_plain")))
    features = spatial.with_spatial_inputs(gold.with_season_index(features, season))
    files.write_parquet(features, layout.gold("_features_spatial"))
    features = spatial.with_multiplier(spark.read.parquet(layout.gold("_features_spatial")))
    files.write_parquet(features, layout.gold("outlet_features"))
    return monthly, spark.read.parquet(layout.gold("outlet_features"))


# ---------------------------------------------------------------------------
# 5. Model, 6. Budget
# ---------------------------------------------------------------------------


def run_model(spark: SparkSession, layout: Layout, rules: config.ModelRules = config.MODEL) -> DataFrame:
    features = spark.read.parquet(layout.gold("outlet_features"))
    clusters = model.peer_clusters(features, rules)
    regression = quantile_regression.estimate(features, rules=rules)
    joined = features.join(clusters.hint("merge"), "outlet_id", "left").join(regression.hint("merge"), "outlet_id", "left")
    files.write_parquet(joined, layout.gold("_model_inputs"))
    estimates = model.with_estimates(
        spark.read.parquet(layout.gold("_model_inputs")), _optional(spark, layout.seasonality), rules=rules
    )
    files.write_parquet(estimates, layout.gold("_estimates"))
    estimates = spark.read.parquet(layout.gold("_estimates"))
    model.require_sound(estimates)
    files.write_parquet(model.factor_table(estimates), layout.gold("outlet_factors"))
    files.write_parquet(model.diagnostics_table(estimates), layout.prediction("modeling_diagnostics"))
    files.write_csv(model.predictions(estimates), layout.prediction(f"{layout.team}_predictions"))
    return estimates


def run_budget(spark: SparkSession, layout: Layout, rules: config.BudgetRules = config.BUDGET) -> DataFrame:
    """Returns the summary row."""
    inputs = budget.allocation_inputs(
        spark.read.parquet(layout.gold("outlet_features")), spark.read.parquet(layout.gold("outlet_factors")), rules=rules
    )
    if inputs.isEmpty():
        raise ValueError(f"no outlets in province {rules.province!r}")
    diagnostics = layout.prediction("budget_allocation_diagnostics")
    files.write_parquet(budget.allocate(inputs, rules), diagnostics)
    spent = spark.read.parquet(diagnostics)
    budget.require_valid(spent, rules)
    files.write_csv(budget.allocation_deliverable(spent), layout.prediction(f"{layout.team}_budget_allocations"))
    files.write_csv(budget.by_distributor(spent), layout.prediction("budget_allocation_by_distributor"))
    return budget.allocation_summary(spent, rules)


def run_all(
    spark: SparkSession,
    root: str,
    team: str = "team",
    poi_limit: int | None = None,
    skip_poi: bool = False,
    model_rules: config.ModelRules = config.MODEL,
    budget_rules: config.BudgetRules = config.BUDGET,
) -> dict[str, DataFrame]:
    """All six stages. Returns manifest, check summary, estimates and budget summary.

    What the stages write for themselves in the shared folder is deleted at the end.
    """
    layout = Layout(root.rstrip("/"), team)
    with scratch(tune(spark)):
        manifest = ingest(spark, layout)
        checks = clean_all(spark, layout)
        if not skip_poi:
            build_poi(spark, layout, poi_limit)
        build_gold(spark, layout)
        estimates = run_model(spark, layout, model_rules)
        summary = run_budget(spark, layout, budget_rules)
    return {"manifest": manifest, "checks": checks, "estimates": estimates, "budget": summary}
