"""Queries for sources, sinks, checks and the check engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfsight import config
from shelfsight.operators import engine
from shelfsight.operators.engine import CheckSpec, run_check, run_checks
from shelfsight.plans import cleaning
from shelfsight.queries.base import query, rounded, sql
from shelfsight.queries.blocks import block, case
from shelfsight.session import stage, stage_path
from shelfsight.sources import files
from shelfsight.sources.adapters import SOURCE_TABLES, TRANSACTION_ORDER, Tables

COPY_ORDER = ("src_key", "src_copy")
SEASON_ORDER = ("src_copy", "distributor_id", "year", "month", "seasonality_index")
HOLIDAY_ORDER = ("src_copy", "src_day")
_FIRST = ", ".join(TRANSACTION_ORDER)

# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------


# What the exports below hold in their notes: line breaks, quotes and commas in quotes, accents, nothing.
_NOTES = """CASE CAST(substring(outlet_id, 5) AS BIGINT) % 5 WHEN 0 THEN 'back' || chr(10) || 'yard, ' || chr(10) WHEN 1 THEN 'says "ok", twice'
    WHEN 2 THEN 'caf' || chr(233) WHEN 3 THEN NULL ELSE 'plain' END"""
_LINE = """outlet_id || ',' || outlet_type || ',' || coalesce(outlet_size, '') || ',' || CAST(cooler_count AS STRING)"""


def _exports(t: Tables) -> str:
    """Outlets as a UTF-8 and a Latin-1 export with broken lines, and a third one with stray quotes and surplus fields."""
    path = stage_path(t.spark, "outlets_csv")
    number = F.expr("CAST(substring(outlet_id, 5) AS BIGINT)")
    noted = t.outlets.withColumn("cooler_count", F.col("cooler_count").cast("string")).withColumn("note", F.expr(_NOTES))
    for name, rest, encoding in (("first", 0, "UTF-8"), ("second", 1, "ISO-8859-1")):
        part = noted.where(number % 3 == rest)
        out = part.write.option("header", True).option("escape", '"').option("encoding", encoding)
        out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{name}")
    tail = F.when(number % 2 == 0, ',6" pipe').otherwise(",a,,b")
    line = F.concat(F.expr(_LINE), tail).alias("outlet_id,outlet_type,outlet_size,cooler_count,note")
    raw = noted.where(number % 3 == 2).select(line)
    raw.write.option("header", True).option("sep", "\x01").option("escapeQuotes", False).csv(f"{path}/third")
    return f"{path}/*"


@query(
    "s1_csv_scan",
    sql(
        f"""SELECT outlet_id, outlet_type, outlet_size, CAST(cooler_count AS STRING) AS cooler_count,
                   CASE WHEN k % 3 = 2 THEN '6" pipe' ELSE note END AS note
            FROM (SELECT *, CAST(substring(outlet_id, 5) AS BIGINT) AS k, {_NOTES} AS note FROM outlets) AS n
            WHERE k % 3 <> 2 OR k % 2 = 0""",
        "outlets",
    ),
)
def csv_scan(t: Tables) -> DataFrame:
    return files.read_csv_with_surplus(t.spark, _exports(t))[0].drop(*files.INGEST_ORDER)


@query(
    "s1_csv_surplus",
    sql(
        f"""SELECT {_LINE} || ',a,,b' AS record FROM outlets
            WHERE CAST(substring(outlet_id, 5) AS BIGINT) % 3 = 2 AND CAST(substring(outlet_id, 5) AS BIGINT) % 2 = 1""",
        "outlets",
    ),
)
def csv_surplus(t: Tables) -> DataFrame:
    return files.read_csv_with_surplus(t.spark, _exports(t))[1].select("record")


@query(
    "s2_parquet_scan",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
       FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY l_returnflag, l_linestatus""",
)
def parquet_scan(t: Tables) -> DataFrame:
    lines = files.read_parquet(t.spark, f"{t.directory}/lineitem.parquet")
    return rounded(
        lines.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")),
        2,
    )


@query(
    "s5_canonical_columns",
    """SELECT o_custkey AS outlet_id, o_orderdate AS date, o_totalprice AS total_bill_value,
              o_orderpriority AS order_priority FROM orders""",
)
def canonical_columns(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_custkey").alias(" Store-ID"),
        F.col("o_orderdate").alias("Txn Date"),
        F.col("o_totalprice").alias("AMOUNT"),
        F.col("o_orderpriority").alias("Order  Priority!"),
    )
    return files.canonicalise(raw)


@query("s7_ingest_manifest")
def ingest_manifest(t: Tables) -> DataFrame:
    names = SOURCE_TABLES
    hashes = files.file_hashes(t.spark, f"{t.directory}/{{{','.join(names)}}}.parquet")
    dataset = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    counts = [t.source(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n in names]
    return hashes.withColumn("dataset", dataset).select("dataset", "bytes", "sha256").join(
        engine.union_rejects(counts), "dataset"
    )


@query(
    "s9_quarantine",
    sql("SELECT _dataset, failure_reason, count(*) AS n FROM dirty_rejects GROUP BY ALL", "dirty_rejects"),
)
def quarantine(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "quarantine")
    for result in all_results(t):
        files.append_quarantine(result.rejected, path, "run1")
    return files.read_quarantine(t.spark, path).groupBy("_dataset", "failure_reason").agg(F.count("*").alias("n"))


@query(
    "s11_poi_responses",
    sql(
        """SELECT 'OUT_' || CAST(CAST(floor(poi_id / 40.0) AS BIGINT) AS STRING) AS outlet_id, CAST(500 AS INT) AS radius_m, count(*) AS elements,
                  count(*) FILTER (coalesce(amenity, tourism, highway, railway, leisure, shop) IS NOT NULL) AS tagged
           FROM poi_flat GROUP BY 1""",
        "poi_flat",
    ),
)
def poi_responses(t: Tables) -> DataFrame:
    """Responses of forty points each, saved as JSON lines and read back."""
    element = F.struct("lat", "lon", "center", "tags")
    saved = t.poi.groupBy(F.floor(F.col("poi_id") / 40).alias("k")).agg(F.collect_list(element).alias("elements"))
    path = stage_path(t.spark, "poi_responses")
    files.write_json(saved.select(F.format_string("OUT_%d__500", "k").alias("key"), "elements"), path)
    read = files.read_poi_response_lines(t.spark, path)
    return read.groupBy("outlet_id", "radius_m").agg(
        F.count("element").alias("elements"), F.count_if(F.size("element.tags") > 0).alias("tagged")
    )


# ---------------------------------------------------------------------------
# Single checks
# ---------------------------------------------------------------------------


@query(
    "d1_duplicate",
    sql(
        f"""SELECT {_FIRST} FROM (SELECT *, row_number() OVER
              (PARTITION BY outlet_id, year, month, distributor_id, sku_id ORDER BY {_FIRST}) AS place FROM transactions) AS p
            WHERE place > 1""",
        "transactions",
    ),
)
def d1(t: Tables) -> DataFrame:
    keys = list(cleaning.KEYS["transactions"])
    _, rejected = run_check(t.transactions, "duplicate", keys=keys, order=TRANSACTION_ORDER)
    return rejected.select(*TRANSACTION_ORDER)


@query(
    "d1_duplicate_any",
    sql(
        f"""SELECT {_FIRST} FROM (SELECT *, count(*) OVER
              (PARTITION BY outlet_id, year, month, distributor_id, sku_id) AS copies FROM transactions) AS p
            WHERE copies > 1""",
        "transactions",
    ),
)
def d1_any(t: Tables) -> DataFrame:
    keys = list(cleaning.KEYS["transactions"])
    _, rejected = run_check(t.transactions, "duplicate", keys=keys, order=TRANSACTION_ORDER, keep=False)
    return rejected.select(*TRANSACTION_ORDER)


_NULLS = """concat_ws(',', CASE WHEN outlet_id IS NULL OR trim(outlet_id) = '' THEN 'outlet_id' END,
   CASE WHEN sku_id IS NULL OR trim(sku_id) = '' THEN 'sku_id' END,
   CASE WHEN total_bill_value IS NULL THEN 'total_bill_value' END)"""


@query(
    "d2_null",
    sql(
        f"SELECT {_FIRST}, 'null_in:' || missing AS failure_reason FROM (SELECT *, {_NULLS} AS missing FROM transactions_raw) AS m WHERE missing <> ''",
        "transactions_raw",
    ),
)
def d2(t: Tables) -> DataFrame:
    _, rejected = run_check(t.transactions_raw, "null", mandatory_cols=["outlet_id", "sku_id", "total_bill_value"])
    return rejected.select(*TRANSACTION_ORDER, "failure_reason")


@query(
    "d3_referential_integrity",
    sql(
        f"""SELECT {_FIRST} FROM transactions_raw x
            WHERE NOT EXISTS (SELECT 1 FROM coordinates c WHERE c.outlet_id = x.outlet_id)""",
        "transactions_raw",
        "coordinates",
    ),
)
def d3(t: Tables) -> DataFrame:
    _, rejected = run_check(
        t.transactions_raw, "referential_integrity", fk_col="outlet_id", ref_df=t.coordinates, ref_col="outlet_id"
    )
    return rejected.select(*TRANSACTION_ORDER)


@query(
    "d4_value_range",
    sql(
        f"""SELECT {_FIRST} FROM transactions_raw
            WHERE year IS NOT NULL AND NOT coalesce(try_cast(year AS DOUBLE) BETWEEN 2022 AND 2026, false)""",
        "transactions_raw",
    ),
)
def d4(t: Tables) -> DataFrame:
    _, rejected = run_check(t.transactions_raw, "value_range", col="year", min_=2022, max_=2026)
    return rejected.select(*TRANSACTION_ORDER)


@query(
    "d5_format_int",
    sql(
        f"""SELECT {_FIRST} FROM transactions_raw
            WHERE year IS NOT NULL AND (try_cast(year AS DOUBLE) IS NULL OR try_cast(year AS DOUBLE) % 1 <> 0)""",
        "transactions_raw",
    ),
)
def d5_int(t: Tables) -> DataFrame:
    _, rejected = run_check(t.transactions_raw, "format", col="year", dtype="int")
    return rejected.select(*TRANSACTION_ORDER)


@query(
    "d5_format_regex",
    sql(
        """SELECT distributor_id, year, month, seasonality_index FROM seasonality_raw
           WHERE NOT regexp_full_match(coalesce(seasonality_index, ''), 'Favorable|Moderate|Un-Favorable')""",
        "seasonality_raw",
    ),
)
def d5_regex(t: Tables) -> DataFrame:
    _, rejected = run_check(t.seasonality_raw, "format", col="seasonality_index", regex="Favorable|Moderate|Un-Favorable")
    return rejected.select("distributor_id", "year", "month", "seasonality_index")


@query(
    "d5_format_date",
    sql("SELECT src_day, src_copy FROM holidays_raw WHERE date IS NOT NULL AND try_cast(date AS TIMESTAMP) IS NULL", "holidays_raw"),
)
def d5_date(t: Tables) -> DataFrame:
    _, rejected = run_check(t.holidays_raw, "format", col="date", dtype="datetime")
    return rejected.select("src_day", "src_copy")


_SWAPPED = """(latitude BETWEEN 79.0 AND 82.5 AND longitude BETWEEN 5.5 AND 10.5
   AND NOT (latitude BETWEEN 5.5 AND 10.5 AND longitude BETWEEN 79.0 AND 82.5))"""


@query(
    "d6_coord_swap",
    sql(
        f"""SELECT src_key, src_copy, CASE WHEN {_SWAPPED} THEN longitude ELSE latitude END AS latitude,
                   CASE WHEN {_SWAPPED} THEN latitude ELSE longitude END AS longitude FROM coordinates_raw""",
        "coordinates_raw",
        doubles="latitude longitude",
    ),
)
def d6(t: Tables) -> DataFrame:
    passing, _ = run_check(t.coordinates_raw, "coord_swap_fix")
    return rounded(passing.select("src_key", "src_copy", "latitude", "longitude"))


def _normal(column: str, mapping: dict) -> str:
    return f"coalesce({case(f'lower(trim({column}))', mapping)}, trim({column}))"


@query(
    "d7_text_normalize",
    sql(f"SELECT src_key, src_copy, {_normal('outlet_type', config.OUTLET_TYPES)} AS outlet_type FROM outlets_raw", "outlets_raw"),
)
def d7(t: Tables) -> DataFrame:
    passing, _ = run_check(t.outlets_raw, "text_normalize", col="outlet_type", mapping=config.OUTLET_TYPES)
    return passing.select("src_key", "src_copy", "outlet_type")


@query(
    "d8_negative_volume",
    sql(f"SELECT {_FIRST}, coalesce(volume_liters < 0, false) AS _is_return FROM transactions", "transactions"),
)
def d8(t: Tables) -> DataFrame:
    passing, _ = run_check(t.transactions, "negative_volume_tag", value_col="volume_liters")
    return passing.select(*TRANSACTION_ORDER, "_is_return")


@query(
    "d9_low_volume",
    sql(
        f"""SELECT {_FIRST}, total_bill_value <= quantile_cont(total_bill_value, 0.2) OVER (PARTITION BY distributor_id, month)
              AS _low_volume_month_flag FROM transactions""",
        "transactions",
    ),
)
def d9(t: Tables) -> DataFrame:
    passing, _ = run_check(
        t.transactions, "low_volume_month_tag", group_keys=["distributor_id", "month"], value_col="total_bill_value"
    )
    return passing.select(*TRANSACTION_ORDER, "_low_volume_month_flag")


@query(
    "d10_credit_cap",
    sql(
        f"""SELECT {_FIRST}, is_round AND avg(is_round::INT) OVER w >= 0.15 AND sum(is_round::INT) OVER w >= 5 AS _credit_cap_flag
            FROM (SELECT *, volume_liters > 0 AND (volume_liters % 5 = 0 OR volume_liters % 50 = 0) AS is_round FROM transactions) AS r
            WINDOW w AS (PARTITION BY outlet_id)""",
        "transactions",
    ),
)
def d10(t: Tables) -> DataFrame:
    passing, _ = run_check(
        t.transactions,
        "credit_cap_signature",
        group_keys=["outlet_id"],
        value_col="volume_liters",
        modulos=[5, 50],
        min_share=0.15,
    )
    return passing.select(*TRANSACTION_ORDER, "_credit_cap_flag")


@query(
    "d11_constant_run",
    sql(
        """SELECT event_id FROM (
             SELECT event_id, step_value, count(*) OVER (PARTITION BY outlet_id, step_value, island) AS n FROM (
               SELECT *, row_number() OVER (PARTITION BY outlet_id ORDER BY ts, event_id)
                         - row_number() OVER (PARTITION BY outlet_id, step_value ORDER BY ts, event_id) AS island
               FROM visits) AS i) AS c WHERE n >= 7 AND step_value <> 0""",
        "visits",
    ),
)
def d11(t: Tables) -> DataFrame:
    rejected = constant_runs(t).rejected
    return rejected.select("event_id")


def constant_runs(t: Tables) -> engine.CheckResult:
    spec = CheckSpec(
        "constant_run",
        {
            "group_keys": ["outlet_id"],
            "order": ["ts", "event_id"],
            "value_col": "step_value",
            "min_run": 7,
        },
    )
    return run_checks(t.visits, "visits", [spec])


block(
    "dark_days",
    "visits",
    """
SELECT distributor_id, day FROM (
  SELECT distributor_id, day, outlet_id, bool_and(value < 30) AS nothing FROM visits GROUP BY ALL) AS o
GROUP BY distributor_id, day HAVING avg(nothing::INT) >= 0.4""",
)


@query(
    "d12_distributor_blackout",
    sql(
        "SELECT event_id FROM visits v JOIN dark_days b ON v.distributor_id = b.distributor_id AND v.day = b.day",
        "visits",
        "dark_days",
    ),
)
def d12(t: Tables) -> DataFrame:
    return blackouts(t).rejected.select("event_id")


def blackouts(t: Tables) -> engine.CheckResult:
    spec = CheckSpec(
        "distributor_blackout",
        {
            "distributor_col": "distributor_id",
            "date_col": "day",
            "outlet_col": "outlet_id",
            "value_col": "value",
            "blackout_threshold": 0.4,
            "zero_below": 30.0,
        },
    )
    return run_checks(t.visits, "visits", [spec])


# ---------------------------------------------------------------------------
# The five check lists. In SQL each is a CASE that names the first failing step.
# ---------------------------------------------------------------------------


def outlets_result(t: Tables) -> engine.CheckResult:
    return run_checks(t.outlets_raw, "outlets", cleaning.outlet_checks(COPY_ORDER))


def coordinates_result(t: Tables) -> engine.CheckResult:
    return run_checks(t.coordinates_raw, "coordinates", cleaning.coordinate_checks(COPY_ORDER))


def seasonality_result(t: Tables) -> engine.CheckResult:
    return run_checks(t.seasonality_raw, "seasonality", cleaning.season_checks(SEASON_ORDER))


def holidays_result(t: Tables) -> engine.CheckResult:
    return run_checks(t.holidays_raw, "holidays", cleaning.holiday_checks(HOLIDAY_ORDER))


def transactions_result(t: Tables) -> engine.CheckResult:
    """Against the outlets that pass their own checks.

    The outlets are written first: their checks then run once, not again for
    every pass over the transactions.
    """
    outlets = stage(outlets_result(t).passing.select("outlet_id"), "clean_outlets")
    return run_checks(t.transactions_raw, "transactions", cleaning.transaction_checks(outlets, TRANSACTION_ORDER))


def all_results(t: Tables) -> list[engine.CheckResult]:
    """The checks of all five datasets."""
    return [outlets_result(t), coordinates_result(t), seasonality_result(t), holidays_result(t), transactions_result(t)]


def _step_block(name: str, reads: str, null_sql: str, null_reason: str, keys: str, order: str, before: str, after: str, reasons: dict):
    """Blocks ``<name>`` (rows with step, reason): CASE of the checks before the
    duplicate check, ``after`` the ones behind it."""
    dup = f"""row_number() OVER (PARTITION BY pre IS NULL, {keys} ORDER BY {order}) > 1"""
    dup_step = reasons["duplicate"][0]
    arms = " ".join(f"WHEN {s} THEN '{r}'" for s, r in reasons.values())
    block(
        name,
        reads,
        f"""
SELECT *, CASE step WHEN 0 THEN {null_reason} {arms} END AS failure_reason FROM (
  SELECT *, CASE WHEN pre IS NOT NULL THEN pre WHEN {dup} THEN {dup_step} {after} END AS step FROM (
    SELECT *, CASE WHEN {null_sql} THEN 0 {before} END AS pre FROM {reads.split()[0]}) AS p) AS s""",
    )


def _absent(*columns: str) -> tuple[str, str]:
    bad = [f"({c} IS NULL OR trim(CAST({c} AS STRING)) = '')" for c in columns]
    listed = ", ".join(f"CASE WHEN {b} THEN '{c}' END" for b, c in zip(bad, columns))
    return " OR ".join(bad), f"'null_in:' || concat_ws(',', {listed})"


_null, _reason = _absent("outlet_id", "outlet_type")
_step_block(
    "outlet_steps", "outlets_raw", _null, _reason, "outlet_id", "src_key, src_copy", "",
    "WHEN cooler_count NOT BETWEEN 0 AND 100 THEN 4",
    {"duplicate": (1, "duplicate_on:outlet_id"), "range": (4, "range_violation:cooler_count[0,100]")},
)
block(
    "outlets_checked",
    "outlet_steps",
    f"""
SELECT outlet_id, CASE WHEN step = 0 OR step = 1 THEN outlet_type ELSE {_normal('outlet_type', config.OUTLET_TYPES)} END AS outlet_type,
       CASE WHEN step = 0 OR step = 1 THEN outlet_size ELSE {_normal('outlet_size', config.OUTLET_SIZES)} END AS outlet_size,
       cooler_count, src_key, src_copy, step, failure_reason FROM outlet_steps""",
)
_null, _reason = _absent("outlet_id", "latitude", "longitude")
block(
    "coordinates_fixed",
    "coordinates_raw",
    f"""
SELECT outlet_id, src_key, src_copy, latitude AS lat0, longitude AS lon0,
       CASE WHEN {_SWAPPED} THEN longitude ELSE latitude END AS latitude,
       CASE WHEN {_SWAPPED} THEN latitude ELSE longitude END AS longitude FROM coordinates_raw""",
)
_step_block(
    "coordinate_steps", "coordinates_fixed", _null, _reason, "outlet_id", "src_key, src_copy", "",
    "WHEN latitude NOT BETWEEN 5.5 AND 10.5 THEN 3 WHEN longitude NOT BETWEEN 79.0 AND 82.5 THEN 4",
    {
        "duplicate": (1, "duplicate_on:outlet_id"),
        "lat": (3, "range_violation:latitude[5.5,10.5]"),
        "lon": (4, "range_violation:longitude[79.0,82.5]"),
    },
)
_null, _reason = _absent("distributor_id", "year", "month", "seasonality_index")
_step_block(
    "season_steps", "seasonality_raw", _null, _reason, "distributor_id, year, month", ", ".join(SEASON_ORDER), "",
    "WHEN month NOT BETWEEN 1 AND 12 THEN 2 WHEN year NOT BETWEEN 2022 AND 2026 THEN 3 "
    "WHEN NOT regexp_full_match(seasonality_index, 'Favorable|Moderate|Un-Favorable') THEN 4",
    {
        "duplicate": (1, "duplicate_on:distributor_id+year+month"),
        "month": (2, "range_violation:month[1,12]"),
        "year": (3, "range_violation:year[2022,2026]"),
        "label": (4, "format_violation:seasonality_index(|Favorable|Moderate|Un-Favorable)"),
    },
)
_null, _reason = _absent("date", "holiday_name", "holiday_type")
_step_block(
    "holiday_steps", "holidays_raw", _null, _reason, "date, holiday_name, holiday_type", "src_copy, src_day",
    "WHEN try_cast(date AS TIMESTAMP) IS NULL THEN 1", "",
    {"date": (1, "format_violation:date(datetime|)"), "duplicate": (2, "duplicate_on:date+holiday_name+holiday_type")},
)
_null, _reason = _absent(*cleaning.MANDATORY["transactions"])
_step_block(
    "transaction_steps", "transactions_raw outlets_checked", _null, _reason,
    "outlet_id, year, month, distributor_id, sku_id", _FIRST,
    "WHEN coalesce(try_cast(year AS DOUBLE) % 1, 1) <> 0 THEN 1 WHEN try_cast(year AS DOUBLE) NOT BETWEEN 2022 AND 2026 THEN 3 "
    "WHEN month NOT BETWEEN 1 AND 12 THEN 4 "
    "WHEN outlet_id NOT IN (SELECT outlet_id FROM outlets_checked WHERE step IS NULL) THEN 5",
    "",
    {
        "year_format": (1, "format_violation:year(int|)"),
        "year": (3, "range_violation:year[2022,2026]"),
        "month": (4, "range_violation:month[1,12]"),
        "outlet": (5, "ri_violation:outlet_id"),
        "duplicate": (7, "duplicate_on:outlet_id+year+month+distributor_id+sku_id"),
    },
)
block(
    "dirty_rejects",
    "outlets_checked coordinate_steps season_steps holiday_steps transaction_steps",
    """
SELECT 'outlets' AS _dataset, failure_reason FROM outlets_checked WHERE step IS NOT NULL
UNION ALL SELECT 'coordinates', failure_reason FROM coordinate_steps WHERE step IS NOT NULL
UNION ALL SELECT 'seasonality', failure_reason FROM season_steps WHERE step IS NOT NULL
UNION ALL SELECT 'holidays', failure_reason FROM holiday_steps WHERE step IS NOT NULL
UNION ALL SELECT 'transactions', failure_reason FROM transaction_steps WHERE step IS NOT NULL""",
)


def _verdicts(result: engine.CheckResult, *columns: str) -> DataFrame:
    """Every row with its final values, failing step and reason."""
    step = F.col("_failed_step").alias("step")
    return rounded(result.tagged.select(*columns, step, "failure_reason"))


@query(
    "d15_run_checks",
    sql(f"SELECT {_FIRST}, step, failure_reason FROM transaction_steps WHERE step IS NOT NULL", "transaction_steps"),
)
def d15(t: Tables) -> DataFrame:
    rejected = transactions_result(t).tagged.where("_failed_step is not null")
    return rejected.select(*TRANSACTION_ORDER, F.col("_failed_step").alias("step"), "failure_reason")



@query(
    "d16_check_summary",
    sql(
        f"""SELECT CAST(n.i AS INT) AS step, 'transactions' AS dataset, ['null', 'format', 'format', 'value_range', 'value_range',
                   'referential_integrity', 'negative_volume_tag', 'duplicate'][n.i + 1] AS "check",
                   (SELECT count(*) FROM transaction_steps WHERE step IS NULL OR step >= n.i) AS rows_before,
                   (SELECT count(*) FROM transaction_steps WHERE step = n.i) AS rows_rejected,
                   (SELECT count(*) FROM transaction_steps WHERE step IS NULL OR step > n.i) AS rows_after
            FROM range(8) AS n(i)""",
        "transaction_steps",
    ),
)
def d16(t: Tables) -> DataFrame:
    return transactions_result(t).summary.drop("params")


@query(
    "d17_union_rejects",
    sql(
        """SELECT 'outlets' AS _dataset, outlet_id, cooler_count, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS STRING) AS distributor_id,
                  CAST(NULL AS STRING) AS holiday_name, CAST(NULL AS STRING) AS sku_id, failure_reason FROM outlets_checked WHERE step IS NOT NULL
           UNION ALL SELECT 'coordinates', outlet_id, NULL, CASE WHEN step < 2 THEN lat0 ELSE latitude END, NULL, NULL, NULL, failure_reason
             FROM coordinate_steps WHERE step IS NOT NULL
           UNION ALL SELECT 'seasonality', NULL, NULL, NULL, distributor_id, NULL, NULL, failure_reason FROM season_steps WHERE step IS NOT NULL
           UNION ALL SELECT 'holidays', NULL, NULL, NULL, NULL, holiday_name, NULL, failure_reason FROM holiday_steps WHERE step IS NOT NULL
           UNION ALL SELECT 'transactions', outlet_id, NULL, NULL, distributor_id, NULL, sku_id, failure_reason FROM transaction_steps
             WHERE step IS NOT NULL""",
        "outlets_checked",
        "coordinate_steps",
        "season_steps",
        "holiday_steps",
        "transaction_steps",
        doubles="latitude",
    ),
)
def d17(t: Tables) -> DataFrame:
    """The rejects of all datasets in one table, with a column of each of them."""
    rejects = engine.union_rejects([result.rejected for result in all_results(t)])
    shown = ("_dataset", "outlet_id", "cooler_count", "latitude", "distributor_id", "holiday_name", "sku_id", "failure_reason")
    return rounded(rejects.select(*shown))


@query(
    "d19_outlets_checked",
    sql("SELECT outlet_id, outlet_type, outlet_size, cooler_count, src_copy, step, failure_reason FROM outlets_checked", "outlets_checked"),
)
def d19(t: Tables) -> DataFrame:
    return _verdicts(outlets_result(t), "outlet_id", "outlet_type", "outlet_size", "cooler_count", "src_copy")


@query(
    "d20_coordinates_checked",
    sql(
        """SELECT outlet_id, CASE WHEN step < 2 THEN lat0 ELSE latitude END AS latitude,
                  CASE WHEN step < 2 THEN lon0 ELSE longitude END AS longitude, src_copy, step, failure_reason FROM coordinate_steps""",
        "coordinate_steps",
        doubles="latitude longitude",
    ),
)
def d20(t: Tables) -> DataFrame:
    return _verdicts(coordinates_result(t), "outlet_id", "latitude", "longitude", "src_copy")


@query(
    "d21_seasonality_checked",
    sql("SELECT distributor_id, year, month, seasonality_index, src_copy, step, failure_reason FROM season_steps", "season_steps"),
)
def d21(t: Tables) -> DataFrame:
    return _verdicts(seasonality_result(t), "distributor_id", "year", "month", "seasonality_index", "src_copy")


@query(
    "d22_holidays_checked",
    sql("SELECT date, holiday_name, holiday_type, src_copy, step, failure_reason FROM holiday_steps", "holiday_steps"),
)
def d22(t: Tables) -> DataFrame:
    return _verdicts(holidays_result(t), "date", "holiday_name", "holiday_type", "src_copy")


@query(
    "d23_transactions_checked",
    sql(
        f"""SELECT {_FIRST}, outlet_id, year, month, volume_liters < 0 AS _is_return FROM transaction_steps WHERE step IS NULL""",
        "transaction_steps",
    ),
)
def d23(t: Tables) -> DataFrame:
    return transactions_result(t).passing.select(*TRANSACTION_ORDER, "outlet_id", "year", "month", "_is_return")
