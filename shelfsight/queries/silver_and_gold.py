"""Queries for enrichment, the monthly table, outlet features and factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


from shelfsight import config
from shelfsight.operators import gold, poi, silver, spatial
from shelfsight.queries import prepared
from shelfsight.queries.base import query, rounded, sql
from shelfsight.queries.blocks import NEAREST_DIGITS, ONE_HOT, POI_DOUBLES, PROVINCE_SQL, ROLL_UP_DOUBLES, block, hot
from shelfsight.queries.sources_and_checks import coordinates_result, outlets_result, transactions_result
from shelfsight.session import stage
from shelfsight.sources.adapters import TRANSACTION_ORDER, Tables

_FIRST = ", ".join(TRANSACTION_ORDER)

# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------


@query(
    "e1_season_number",
    sql(
        """SELECT distributor_id, year, month, src_copy, trim(seasonality_index) AS seasonality_label,
                  CAST(CASE trim(seasonality_index) WHEN 'Favorable' THEN 1.15 WHEN 'Moderate' THEN 1.0
                       WHEN 'Un-Favorable' THEN 0.85 END AS DOUBLE) AS seasonality_index FROM seasonality_raw""",
        "seasonality_raw",
        doubles="seasonality_index",
    ),
)
def e1(t: Tables) -> DataFrame:
    return rounded(silver.season_to_number(t.seasonality_raw))


@query(
    "e2_outlet_coordinates",
    sql(
        "SELECT o.*, latitude, longitude FROM outlets o LEFT JOIN coordinates c ON o.outlet_id = c.outlet_id",
        "outlets",
        "coordinates",
        doubles="latitude longitude",
    ),
)
def e2(t: Tables) -> DataFrame:
    return rounded(silver.with_coordinates(t.outlets, t.coordinates))


@query("e3_main_distributor", sql("SELECT * FROM main_distributor", "main_distributor"))
def e3(t: Tables) -> DataFrame:
    return silver.main_distributor(t.transactions)


@query("e4_province", sql(f"SELECT outlet_id, {PROVINCE_SQL} AS province FROM main_distributor", "main_distributor"))
def e4(t: Tables) -> DataFrame:
    named = silver.main_distributor(t.transactions)
    return named.select("outlet_id", silver.province_of(F.col("distributor_id")).alias("province"))


@query(
    "e5_join_coverage",
    sql(
        """SELECT count(latitude) AS outlets_with_coords, count(distributor_id) AS outlets_with_distributor,
                  count(*) AS outlets_total FROM outlet_master""",
        "outlet_master",
    ),
)
def e5(t: Tables) -> DataFrame:
    return silver.join_coverage(prepared.outlet_master(t))


block(
    "clean_main_distributor",
    "transaction_steps",
    """
SELECT outlet_id, distributor_id FROM (
  SELECT outlet_id, distributor_id, row_number() OVER (PARTITION BY outlet_id ORDER BY count(*) DESC, distributor_id) AS place
  FROM transaction_steps WHERE step IS NULL GROUP BY outlet_id, distributor_id) AS counted WHERE place = 1""",
)


@query(
    "e6_silver_outlets",
    sql(
        f"""SELECT o.outlet_id, outlet_type, outlet_size, cooler_count, latitude, longitude, distributor_id, {PROVINCE_SQL} AS province
            FROM outlets_checked o LEFT JOIN (SELECT * FROM coordinate_steps WHERE step IS NULL) AS c ON o.outlet_id = c.outlet_id
              LEFT JOIN clean_main_distributor d ON o.outlet_id = d.outlet_id
            WHERE o.step IS NULL""",
        "outlets_checked",
        "coordinate_steps",
        "clean_main_distributor",
        doubles="latitude longitude",
    ),
)
def e6(t: Tables) -> DataFrame:
    clean = silver.enrich_outlets(
        outlets_result(t).passing, coordinates_result(t).passing, transactions_result(t).passing
    )
    return rounded(clean.drop("src_key", "src_copy"))


# ---------------------------------------------------------------------------
# Gold: months
# ---------------------------------------------------------------------------


@query(
    "g1_split_volumes",
    sql(
        f"""SELECT {_FIRST}, volume_liters < 0 AS _is_return,
                   CASE WHEN volume_liters < 0 THEN -volume_liters ELSE 0 END AS _returns_vol,
                   CASE WHEN volume_liters < 0 THEN 0 ELSE volume_liters END AS _purchase_vol,
                   abs(volume_liters) AS _abs_vol FROM transactions""",
        "transactions",
    ),
)
def g1(t: Tables) -> DataFrame:
    parts = gold.split_volumes(t.transactions)
    return parts.select(*TRANSACTION_ORDER, "_is_return", "_returns_vol", "_purchase_vol", "_abs_vol")


@query("g2_monthly_totals", sql("SELECT * FROM monthly_totals", "monthly_totals", doubles="bill_total", digits=3))
def g2(t: Tables) -> DataFrame:
    return rounded(gold.monthly_totals(gold.split_volumes(t.transactions), TRANSACTION_ORDER), 3)


_KEYS = ["outlet_id", "year", "month"]


@query("g3_return_share", sql("SELECT outlet_id, year, month, return_share FROM monthly_flags", "monthly_flags", doubles="return_share"))
def g3(t: Tables) -> DataFrame:
    return rounded(gold.with_return_share(prepared.monthly(t).drop("return_share")).select(*_KEYS, "return_share"))


def _flag_query(name: str, column: str, reads: str = "monthly") -> None:
    @query(name, sql(f"SELECT outlet_id, year, month, {column} FROM {reads}", reads))
    def run(t: Tables) -> DataFrame:
        return gold.flag_constraints(prepared.monthly(t)).select(*_KEYS, column)


_flag_query("g4_low_volume", "low_volume_flag")
_flag_query("g5_few_skus", "low_sku_diversity_flag")
_flag_query("g6_round_volume", "credit_cap_flag")
_flag_query("g7_is_constrained", "is_constrained")


@query(
    "g8_deflated",
    sql(
        "SELECT outlet_id, year, month, seasonality_index, volume_total_deflated FROM monthly",
        "monthly",
        doubles="seasonality_index volume_total_deflated",
    ),
)
def g8(t: Tables) -> DataFrame:
    months = prepared.monthly(t).drop("seasonality_index", "volume_total_deflated")
    return rounded(gold.deflate(months, t.seasonality).select(*_KEYS, "seasonality_index", "volume_total_deflated"))


# ---------------------------------------------------------------------------
# Gold: outlets
# ---------------------------------------------------------------------------

_ROLL_UP = [
    "outlet_id", "months_observed", "months_constrained", "months_unconstrained", *ROLL_UP_DOUBLES.split(),
    "hist_sku_diversity_max", "unc_months",
]
_ALL_MONTHS = [c for c in _ROLL_UP if not c.startswith("unc_")]
_FREE_MONTHS = [c for c in _ROLL_UP if c.startswith("unc_")]


@query(
    "g9_outlet_roll_up",
    sql(
        f"SELECT {', '.join(_ALL_MONTHS)} FROM roll_up",
        "roll_up",
        doubles=[c for c in ROLL_UP_DOUBLES.split() if not c.startswith("unc_")],
    ),
)
def g9(t: Tables) -> DataFrame:
    """From the lines to the outlets in one plan."""
    return rounded(gold.roll_up(prepared.monthly_plan(t)).select(*_ALL_MONTHS))


@query(
    "g10_unconstrained_roll_up",
    sql(
        f"SELECT outlet_id, {', '.join(_FREE_MONTHS)} FROM roll_up",
        "roll_up",
        doubles=[c for c in _FREE_MONTHS if c != "unc_months"],
    ),
)
def g10(t: Tables) -> DataFrame:
    return rounded(gold.roll_up(prepared.monthly(t)).select("outlet_id", *_FREE_MONTHS))


@query(
    "g11_outlet_features",
    sql(
        "SELECT * FROM features",
        "features",
        doubles=["latitude", "longitude", *ROLL_UP_DOUBLES.split(), *POI_DOUBLES, "volume_cv", "max_to_mean_ratio"],
    ),
)
def g11(t: Tables) -> DataFrame:
    return rounded(
        gold.outlet_features(prepared.outlet_master(t), prepared.monthly(t), prepared.poi_wide(t)), **NEAREST_DIGITS
    )


@query("g12_one_hot", sql(f"SELECT outlet_id, {ONE_HOT} FROM outlet_master", "outlet_master"))
def g12(t: Tables) -> DataFrame:
    hot = gold.one_hot(prepared.outlet_master(t))
    new = [f"{prefix}_{v}" for prefix, values in gold.CATEGORIES.values() for v in values]
    return hot.select("outlet_id", *[F.col(f"`{c}`") for c in new])


# Outlets with types outside the given list.
_TYPED = """CASE WHEN CAST(substring(outlet_id, 5) AS BIGINT) % 11 = 0 THEN 'Night market'
    WHEN CAST(substring(outlet_id, 5) AS BIGINT) % 13 = 0 THEN 'Petrol station' ELSE outlet_type END"""
_PRESENT = (*config.OUTLET_TYPE_VALUES, "Night market", "Petrol station")


@query(
    "g12_one_hot_present",
    sql(
        f"SELECT outlet_id, {hot('outlet_type', 'type', _PRESENT)} FROM (SELECT outlet_id, {_TYPED} AS outlet_type FROM outlets) AS t",
        "outlets",
    ),
)
def g12_present(t: Tables) -> DataFrame:
    """A column also for types that no list names."""
    outlets = t.outlets.select("outlet_id", F.expr(_TYPED).alias("outlet_type"))
    return gold.one_hot(outlets, gold.vocabulary(outlets)).drop("outlet_type")


@query(
    "g13_ratios",
    sql("SELECT outlet_id, volume_cv, max_to_mean_ratio FROM features", "features", doubles="volume_cv max_to_mean_ratio"),
)
def g13(t: Tables) -> DataFrame:
    return rounded(gold.with_ratios(prepared.features(t)).select("outlet_id", "volume_cv", "max_to_mean_ratio"))


@query(
    "g14_constraint_uplift",
    sql("SELECT outlet_id, constraint_uplift FROM uplift", "uplift", doubles="constraint_uplift"),
)
def g14(t: Tables) -> DataFrame:
    return rounded(gold.with_constraint_uplift(prepared.features(t)).select("outlet_id", "constraint_uplift"))


@query(
    "g15_season_index",
    sql(
        """SELECT outlet_id, CAST(coalesce(nullif(season_index, 0), 1.0) AS DOUBLE) AS seasonality_jan_index
           FROM outlet_master o LEFT JOIN target_season t ON o.distributor_id = t.distributor_id""",
        "outlet_master",
        "target_season",
        doubles="seasonality_jan_index",
    ),
)
def g15(t: Tables) -> DataFrame:
    return rounded(
        gold.with_season_index(prepared.outlet_master(t), t.seasonality).select("outlet_id", "seasonality_jan_index")
    )


FACTOR_DOUBLES = (
    "constraint_uplift seasonality_jan_index own_network_density poi_accessibility saturation_index spatial_multiplier"
)


@query(
    "g16_factors",
    sql(
        f"SELECT outlet_id, {', '.join(FACTOR_DOUBLES.split())} FROM factored",
        "factored",
        doubles=FACTOR_DOUBLES,
        digits=8,
    ),
)
def g16(t: Tables) -> DataFrame:
    return rounded(prepared.factored(t).select("outlet_id", *FACTOR_DOUBLES.split()), 8)


@query(
    "g17_gold_from_lines",
    sql(
        """SELECT m.outlet_id, count(*) AS months, sum(volume_total) AS volume, sum(volume_total_deflated) AS deflated,
                  any_value(constraint_uplift) AS constraint_uplift, any_value(seasonality_jan_index) AS seasonality_jan_index,
                  any_value(poi_total_1000m) AS poi_total_1000m, any_value(poi_accessibility) AS poi_accessibility,
                  any_value(saturation_index) AS saturation_index, any_value(spatial_multiplier) AS spatial_multiplier
           FROM monthly m JOIN factored f ON m.outlet_id = f.outlet_id GROUP BY m.outlet_id""",
        "monthly",
        "factored",
        doubles="volume deflated constraint_uplift seasonality_jan_index poi_accessibility saturation_index spatial_multiplier",
        digits=4,
    ),
)
def g17(t: Tables) -> DataFrame:
    """Monthly and outlet table with all factors built afresh, with written tables in between as in the batch run."""
    months = stage(prepared.monthly_plan(t), "months")
    plain = gold.outlet_features(prepared.outlet_master(t), months, poi.poi_features(t.coordinates, t.poi))
    outlets = gold.with_season_index(gold.with_constraint_uplift(stage(plain, "plain_features")), t.seasonality)
    outlets = spatial.with_spatial_factors(outlets)
    sums = months.groupBy("outlet_id").agg(
        F.count("*").alias("months"), F.sum("volume_total").alias("volume"), F.sum("volume_total_deflated").alias("deflated")
    )
    factors = ("constraint_uplift", "seasonality_jan_index", "poi_total_1000m", "poi_accessibility", "saturation_index", "spatial_multiplier")
    return rounded(sums.join(outlets.select("outlet_id", *factors), "outlet_id"), 4)


