"""Outlet tables derived from the generated star-schema tables.

Each logical table is one SELECT in SQL that Spark and DuckDB read alike, so
that queries and their SQL counterparts start from the same rows. The ``*_raw``
tables carry dirt of the kinds the cleaning steps look for: typos, blanks,
missing and out-of-range values, swapped or zero coordinates, repeated rows,
unknown keys. It is spread by arithmetic on the keys over the whole tables.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfsight import config
from shelfsight.session import stage

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

# Row identity of the transactions; fewer columns are not unique in the data.
TRANSACTION_ORDER = ("src_order", "src_line", "src_part", "src_supp", "src_price", "src_ship")
# Years are moved so that the order dates end in the year before the target month.
YEAR_SHIFT = 24
# Customers and parts per map tile, so that density stays the same at any scale.
_OUTLETS_PER_TILE = 1500
_POI_PER_TILE = 2000


def _case(expr: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _tile(key: str, per_tile: int) -> str:
    return f"CAST(floor({key} / {per_tile}.0) AS BIGINT) % 160000"


def _lat(key: str, per_tile: int, step: int) -> str:
    row = f"CAST(floor(({_tile(key, per_tile)}) / 85.0) AS BIGINT)"
    return f"(CAST(56000 + 401 * {row} + ({key} * {step}) % 401 AS DOUBLE) / 10000)"


def _lon(key: str, per_tile: int, step: int) -> str:
    return f"(CAST(790000 + 401 * (({_tile(key, per_tile)}) % 85) + ({key} * {step}) % 401 AS DOUBLE) / 10000)"


_OUTLET = "'OUT_' || CAST({} AS STRING)"
_LAT = _lat("c_custkey", _OUTLETS_PER_TILE, 7919)
_LON = _lon("c_custkey", _OUTLETS_PER_TILE, 104729)
_POI_LAT = _lat("p_partkey", _POI_PER_TILE, 6101)
_POI_LON = _lon("p_partkey", _POI_PER_TILE, 3571)
_LABEL = _case("(d * 7 + month * 3 + year) % 3", ("Favorable", "Moderate", "Un-Favorable"))
_TYPE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Grocery' WHEN 'BUILDING' THEN 'Eatery'
    WHEN 'FURNITURE' THEN 'Bakery' WHEN 'HOUSEHOLD' THEN 'Supermarket' ELSE 'Kiosk' END"""
_DIRTY_TYPE = """CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN '  '
    WHEN c_custkey % 43 = 0 THEN ' Corner Shop '
    WHEN c_mktsegment = 'AUTOMOBILE' THEN CASE WHEN c_custkey % 2 = 0 THEN 'Grocry' ELSE 'GROCERY' END
    WHEN c_mktsegment = 'BUILDING' THEN ' Eatery '
    WHEN c_mktsegment = 'FURNITURE' THEN CASE WHEN c_custkey % 2 = 0 THEN 'Bakry' ELSE 'bakery' END
    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'SMMT' ELSE 'kiosk' END"""
_DIRTY_SIZE = _case("c_custkey % 5", ("Small", "MEDIUM ", " large", "Extra Large", "Kiosk-sized"))

# name -> (tables it reads, SELECT)
LOGICAL: dict[str, tuple[tuple[str, ...], str]] = {
    "transactions": (
        ("lineitem", "orders"),
        f"""
SELECT {_OUTLET.format('o_custkey')} AS outlet_id,
       CAST(year(o_orderdate) + {YEAR_SHIFT} AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       {_case('l_suppkey % 10', config.DISTRIBUTORS)} AS distributor_id,
       'SKU_' || lpad(CAST(l_partkey % 10 + 1 AS STRING), 2, '0') AS sku_id,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity ELSE l_quantity END AS volume_liters,
       l_extendedprice AS total_bill_value,
       l_orderkey AS src_order, l_linenumber AS src_line, l_partkey AS src_part, l_suppkey AS src_supp,
       l_extendedprice AS src_price, l_shipdate AS src_ship
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    ),
    "transactions_raw": (
        ("transactions",),
        """
SELECT CASE WHEN src_part % 211 = 0 THEN ' ' ELSE outlet_id END AS outlet_id,
       CASE WHEN src_part % 223 = 0 THEN '20x5' WHEN src_part % 227 = 0 THEN '2024.5' ELSE CAST(year AS STRING) END AS year,
       CASE WHEN src_part % 229 = 0 THEN 13 ELSE month END AS month,
       distributor_id, CASE WHEN src_part % 233 = 0 THEN NULL ELSE sku_id END AS sku_id,
       volume_liters, CASE WHEN src_part % 239 = 0 THEN NULL ELSE total_bill_value END AS total_bill_value,
       src_order, src_line, src_part, src_supp, src_price, src_ship
FROM {transactions}""",
    ),
    "outlets": (
        ("customer",),
        f"""
SELECT {_OUTLET.format('c_custkey')} AS outlet_id, {_TYPE} AS outlet_type,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE {_case('c_custkey % 4', config.OUTLET_SIZE_VALUES)} END AS outlet_size,
       CAST(c_custkey % 7 AS INT) AS cooler_count
FROM {{customer}}""",
    ),
    "outlets_raw": (
        ("customer",),
        f"""
SELECT {_OUTLET.format('c_custkey')} AS outlet_id, {_DIRTY_TYPE} AS outlet_type, {_DIRTY_SIZE} AS outlet_size,
       CAST(CASE WHEN c_custkey % 83 = 0 THEN 150 WHEN c_custkey % 89 = 0 THEN NULL ELSE c_custkey % 7 END AS INT)
           AS cooler_count,
       c_custkey AS src_key, 0 AS src_copy
FROM {{customer}}
UNION ALL
SELECT {_OUTLET.format('c_custkey')}, 'Hotel', 'Small', CAST(1 AS INT), c_custkey, 1
FROM {{customer}} WHERE c_custkey % 29 = 0""",
    ),
    "coordinates": (
        ("customer",),
        f"""
SELECT {_OUTLET.format('c_custkey')} AS outlet_id, {_LAT} AS latitude, {_LON} AS longitude
FROM {{customer}} WHERE c_custkey % 97 <> 0""",
    ),
    "coordinates_raw": (
        ("customer",),
        f"""
SELECT {_OUTLET.format('c_custkey')} AS outlet_id,
       CASE WHEN c_custkey % 97 = 0 THEN CAST(0 AS DOUBLE) WHEN c_custkey % 50 = 0 THEN {_LON} WHEN c_custkey % 71 = 0 THEN NULL
            ELSE {_LAT} END AS latitude,
       CASE WHEN c_custkey % 97 = 0 THEN CAST(0 AS DOUBLE) WHEN c_custkey % 50 = 0 THEN {_LAT} ELSE {_LON} END AS longitude,
       c_custkey AS src_key, 0 AS src_copy
FROM {{customer}}
UNION ALL
SELECT {_OUTLET.format('c_custkey')}, {_LAT}, {_LON}, c_custkey, 1 FROM {{customer}} WHERE c_custkey % 53 = 0""",
    ),
    "season_labels": (
        ("lineitem", "orders"),
        f"""
SELECT {_case('d', config.DISTRIBUTORS)} AS distributor_id, year, month, {_LABEL} AS seasonality_index, d
FROM (SELECT DISTINCT CAST(l_suppkey % 10 AS INT) AS d, CAST(year(o_orderdate) + {YEAR_SHIFT} AS INT) AS year,
             CAST(month(o_orderdate) AS INT) AS month
      FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey) AS months""",
    ),
    "seasonality": (
        ("season_labels",),
        """
SELECT distributor_id, year, month,
       CAST(CASE seasonality_index WHEN 'Favorable' THEN 1.15 WHEN 'Moderate' THEN 1.0 ELSE 0.85 END AS DOUBLE)
           AS seasonality_index
FROM {season_labels}""",
    ),
    "seasonality_raw": (
        ("season_labels",),
        """
SELECT distributor_id, year, CASE WHEN (d + year + month) % 41 = 0 THEN 13 ELSE month END AS month,
       CASE WHEN (d + month) % 17 = 0 THEN seasonality_index || ' ' WHEN (d + year) % 19 = 0 THEN NULL
            ELSE seasonality_index END AS seasonality_index,
       0 AS src_copy
FROM {season_labels}
UNION ALL
SELECT distributor_id, year, month, 'Moderate', 1 FROM {season_labels} WHERE (d * 5 + year + month) % 23 = 0""",
    ),
    "holidays_raw": (
        ("orders",),
        """
SELECT CASE WHEN dayofmonth(day) = 29 THEN 'not a date' ELSE CAST(day AS STRING) END AS date,
       CASE WHEN dayofmonth(day) = 17 THEN NULL ELSE 'Holiday ' || CAST(dayofmonth(day) AS STRING) END AS holiday_name,
       CASE WHEN month(day) % 2 = 0 THEN 'Public' ELSE 'Bank' END AS holiday_type,
       CAST(day AS STRING) AS src_day, 0 AS src_copy
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}) AS days
UNION ALL
SELECT CAST(day AS STRING), 'Holiday ' || CAST(dayofmonth(day) AS STRING),
       CASE WHEN month(day) % 2 = 0 THEN 'Public' ELSE 'Bank' END, CAST(day AS STRING), 1
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}) AS days WHERE dayofmonth(day) % 7 = 0""",
    ),
    "poi_flat": (
        ("part",),
        f"""
SELECT p_partkey AS poi_id,
       CASE WHEN p_partkey % 53 = 0 OR p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN CAST(0 AS DOUBLE)
            ELSE {_POI_LAT} END AS lat,
       CASE WHEN p_partkey % 53 = 0 OR p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN CAST(0 AS DOUBLE)
            ELSE {_POI_LON} END AS lon,
       CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN {_POI_LAT} END
           AS center_lat,
       CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN {_POI_LON} END
           AS center_lon,
       CASE p_size % 14 WHEN 0 THEN CASE p_size WHEN 14 THEN 'school' WHEN 28 THEN 'college' ELSE 'kindergarten' END
            WHEN 1 THEN 'university' WHEN 3 THEN 'bus_station' WHEN 5 THEN 'clinic' WHEN 6 THEN 'place_of_worship'
            WHEN 8 THEN 'marketplace' WHEN 9 THEN 'police' WHEN 10 THEN 'cafe' WHEN 13 THEN 'bench' END AS amenity,
       CASE WHEN p_size % 14 = 7 THEN 'museum' END AS tourism,
       CASE WHEN p_size % 14 = 2 THEN 'bus_stop' END AS highway,
       CASE WHEN p_size % 14 = 4 THEN 'station' END AS railway,
       CASE WHEN p_size % 14 = 11 THEN 'pitch' END AS leisure,
       CASE WHEN p_size % 14 = 12 OR p_partkey % 3 = 0 THEN 'yes' END AS shop
FROM {{part}}""",
    ),
    "visits": (
        ("events",),
        """
SELECT user_id AS outlet_id, event_type AS distributor_id, ts, event_id, CAST(ts AS DATE) AS day, value,
       CAST(floor(value / 100) + 1 AS DOUBLE) AS step_value
FROM {events}""",
    ),
}

# A few rows made of all the lines, and read more than once by what is built on them.
_KEPT = ("season_labels",)
_TAG_KEYS = ("amenity", "tourism", "highway", "railway", "leisure", "shop")


def needs(name: str) -> list[str]:
    """Logical tables that ``name`` is built from, in build order, ending with itself."""
    order: list[str] = []
    for source in LOGICAL[name][0]:
        if source in LOGICAL:
            order += [t for t in needs(source) if t not in order]
    return [*order, name]


def logical_sql(name: str) -> str:
    """The SELECT of a logical table with table names in place."""
    return re.sub(r"\{(\w+)\}", r"\1", LOGICAL[name][1]).strip()


class Tables:
    """The given tables of one directory and the logical tables over them.

    Those of ``_KEPT`` are written at their first use, so the lines are joined
    and shuffled for them once.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._kept: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def logical(self, name: str) -> DataFrame:
        if name in self._kept:
            return self._kept[name]
        sources, sql = LOGICAL[name]
        frames = {s: self.logical(s) if s in LOGICAL else self.source(s) for s in sources}
        df = self.spark.sql(sql.strip(), **frames)
        if name in _KEPT:
            df = self._kept[name] = stage(df, name)
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in LOGICAL:
            return self.logical(name)
        if name in SOURCE_TABLES:
            return self.source(name)
        raise AttributeError(name)

    @property
    def poi(self) -> DataFrame:
        """Points of interest with a tag map and a nested centre."""
        pairs: list[Column] = [x for key in _TAG_KEYS for x in (F.lit(key), F.col(key))]
        return self.poi_flat.select(
            "poi_id",
            "lat",
            "lon",
            F.struct(F.col("center_lat").alias("lat"), F.col("center_lon").alias("lon")).alias("center"),
            F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("tags"),
        )


def sql_with(final: str, *tables: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH`` the logical tables (and extra named selects) followed by ``final``."""
    names: list[str] = reduce(lambda acc, t: acc + [n for n in needs(t) if n not in acc], tables, [])
    parts = [f"{n} AS ({logical_sql(n)})" for n in names] + [f"{n} AS ({q})" for n, q in extra]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final
