"""SQL building blocks of the counterparts."""

from __future__ import annotations

from shelfsight import config
from shelfsight.queries.base import BLOCKS
from shelfsight.sources.adapters import TRANSACTION_ORDER

RADII = config.SPATIAL.radii_m
CATEGORIES = config.POI_CATEGORIES

_FIRST = ", ".join(TRANSACTION_ORDER)


def block(name: str, reads: str, text: str) -> None:
    BLOCKS[name] = (tuple(reads.split()), text)


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371000.0 * asin(sqrt(least(1.0, power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def case(expr: str, mapping: dict, default: str = "NULL") -> str:
    def literal(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


block(
    "monthly_totals",
    "transactions",
    f"""
SELECT outlet_id, year, month, sum(volume_liters) AS volume_total, sum(abs(volume_liters)) AS volume_gross,
       sum(CASE WHEN volume_liters < 0 THEN -volume_liters ELSE 0 END) AS volume_returns,
       sum(CASE WHEN volume_liters < 0 THEN 0 ELSE volume_liters END) AS volume_purchases,
       sum(total_bill_value) AS bill_total, count(DISTINCT sku_id) AS sku_diversity, count(*) AS n_lines,
       first(distributor_id ORDER BY {_FIRST}) AS distributor_id
FROM transactions GROUP BY outlet_id, year, month""",
)
block(
    "monthly_flags",
    "monthly_totals",
    """
SELECT *, CASE WHEN volume_gross <> 0 THEN volume_returns / volume_gross ELSE 0 END AS return_share,
       volume_total > 0 AND volume_total < 0.5 * median(volume_total) OVER (PARTITION BY outlet_id) AS low_volume_flag,
       sku_diversity < 2 AS low_sku_diversity_flag,
       volume_total <> 0 AND (abs(volume_total) % 50 = 0 OR abs(volume_total) % 100 = 0 OR abs(volume_total) % 500 = 0
                              OR abs(volume_total) % 1000 = 0) AS credit_cap_flag
FROM monthly_totals""",
)
block(
    "monthly",
    "monthly_flags seasonality",
    """
SELECT m.*, low_volume_flag OR low_sku_diversity_flag OR credit_cap_flag AS is_constrained,
       coalesce(nullif(s.seasonality_index, 0), 1.0) AS seasonality_index,
       volume_total / coalesce(nullif(s.seasonality_index, 0), 1.0) AS volume_total_deflated
FROM monthly_flags m LEFT JOIN seasonality s
  ON m.distributor_id = s.distributor_id AND m.year = s.year AND m.month = s.month""",
)
block(
    "main_distributor",
    "transactions",
    """
SELECT outlet_id, distributor_id FROM (
  SELECT outlet_id, distributor_id, row_number() OVER (PARTITION BY outlet_id ORDER BY count(*) DESC, distributor_id) AS place
  FROM transactions GROUP BY outlet_id, distributor_id) AS counted WHERE place = 1""",
)
PROVINCE_SQL = """CASE WHEN distributor_id LIKE 'DIST~_W~_%' ESCAPE '~' THEN 'Western'
    WHEN distributor_id LIKE 'DIST~_C~_%' ESCAPE '~' THEN 'Central'
    WHEN distributor_id LIKE 'DIST~_NW~_%' ESCAPE '~' THEN 'North-Western'
    WHEN distributor_id LIKE 'DIST~_S~_%' ESCAPE '~' THEN 'Southern' END"""
block(
    "outlet_master",
    "outlets coordinates main_distributor",
    f"""
SELECT o.*, c.latitude, c.longitude, d.distributor_id, {PROVINCE_SQL} AS province
FROM outlets o LEFT JOIN coordinates c ON o.outlet_id = c.outlet_id LEFT JOIN main_distributor d ON o.outlet_id = d.outlet_id""",
)
ROLL_UP_DOUBLES = (
    "hist_total_mean hist_total_median hist_total_p75 hist_total_p90 hist_total_p95 hist_total_max hist_total_std "
    "hist_deflated_max hist_deflated_p90 hist_sku_diversity_mean hist_return_share_mean hist_bill_total_mean "
    "unc_deflated_max unc_deflated_p90 unc_deflated_mean"
)
block(
    "roll_up",
    "monthly",
    """
SELECT outlet_id, count(*) AS months_observed, count(*) FILTER (is_constrained) AS months_constrained,
       count(*) FILTER (NOT is_constrained) AS months_unconstrained,
       avg(volume_total) AS hist_total_mean, quantile_cont(volume_total, 0.5) AS hist_total_median,
       quantile_cont(volume_total, 0.75) AS hist_total_p75, quantile_cont(volume_total, 0.9) AS hist_total_p90,
       quantile_cont(volume_total, 0.95) AS hist_total_p95, max(volume_total) AS hist_total_max,
       stddev_samp(volume_total) AS hist_total_std, max(volume_total_deflated) AS hist_deflated_max,
       quantile_cont(volume_total_deflated, 0.9) AS hist_deflated_p90,
       avg(sku_diversity) AS hist_sku_diversity_mean, max(sku_diversity) AS hist_sku_diversity_max,
       avg(return_share) AS hist_return_share_mean, avg(bill_total) AS hist_bill_total_mean,
       max(volume_total_deflated) FILTER (NOT is_constrained) AS unc_deflated_max,
       quantile_cont(volume_total_deflated, 0.9) FILTER (NOT is_constrained) AS unc_deflated_p90,
       avg(volume_total_deflated) FILTER (NOT is_constrained) AS unc_deflated_mean,
       nullif(count(*) FILTER (NOT is_constrained), 0) AS unc_months
FROM monthly GROUP BY outlet_id""",
)

# --- points of interest ----------------------------------------------------
CATEGORY_SQL = """CASE WHEN amenity IN ('school', 'college', 'kindergarten') THEN 'school'
    WHEN amenity = 'university' THEN 'university' WHEN highway = 'bus_stop' THEN 'bus_stand'
    WHEN amenity = 'bus_station' THEN 'bus_station' WHEN railway = 'station' THEN 'railway'
    WHEN amenity IN ('hospital', 'clinic') THEN 'hospital' WHEN amenity = 'place_of_worship' THEN 'place_of_worship'
    WHEN tourism IN ('attraction', 'museum', 'viewpoint', 'hotel', 'guest_house') THEN 'tourism'
    WHEN amenity = 'marketplace' THEN 'market' WHEN amenity IN ('townhall', 'courthouse', 'police') THEN 'government'
    WHEN amenity IN ('restaurant', 'cafe', 'fast_food') THEN 'restaurant'
    WHEN leisure IN ('sports_centre', 'stadium', 'pitch') THEN 'sports' WHEN shop <> '' THEN 'shop' END"""
block(
    "poi_located",
    "poi_flat",
    f"""
SELECT poi_id, {CATEGORY_SQL} AS category, coalesce(nullif(lat, 0), center_lat) AS lat,
       coalesce(nullif(lon, 0), center_lon) AS lon
FROM poi_flat""",
)
block(
    "poi_pairs",
    "poi_located coordinates",
    f"""
SELECT * FROM (
  SELECT outlet_id, poi_id, category, {distance('latitude', 'longitude', 'lat', 'lon')} AS d
  FROM coordinates JOIN poi_located ON abs(latitude - lat) < 0.0091 AND category IS NOT NULL) AS near
WHERE d <= 1000""",
)
_SIGMA = case("category", config.POI_SIGMA_M, "300.0")
_WIDE = ",\n".join(
    f"count(*) FILTER (category = '{c}' AND d <= {r}) AS poi_count_{c}_{r}m, "
    f"min(d) FILTER (category = '{c}' AND d <= {r}) AS poi_nearest_{c}_{r}m, "
    f"round(coalesce(sum(w) FILTER (category = '{c}' AND d <= {r}), 0), 6) AS poi_access_{c}_{r}m"
    for r in RADII
    for c in CATEGORIES
)
_TOTALS = ", ".join(f"count(*) FILTER (d <= {r}) AS poi_total_{r}m" for r in RADII)
# The pulls are rounded by definition; only the distances need it for comparing.
POI_DOUBLES = [f"poi_nearest_{c}_{r}m:4" for r in RADII for c in CATEGORIES]
NEAREST_DIGITS = {name.partition(":")[0]: 4 for name in POI_DOUBLES}
block(
    "poi_wide",
    "poi_pairs coordinates",
    f"""
SELECT c.outlet_id, {_WIDE}, {_TOTALS}
FROM coordinates c LEFT JOIN (
  SELECT *, exp(-(d * d) / (2 * sigma * sigma)) AS w FROM (SELECT *, {_SIGMA} AS sigma FROM poi_pairs) AS s) AS p
  ON c.outlet_id = p.outlet_id
GROUP BY c.outlet_id""",
)
block(
    "own_density",
    "coordinates",
    f"""
SELECT a.outlet_id, CAST(count(*) - 1 AS DOUBLE) AS own_network_density
FROM coordinates a JOIN coordinates b ON abs(a.latitude - b.latitude) < 0.0046
WHERE {distance('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')} <= 500 GROUP BY a.outlet_id""",
)

# --- features and factors --------------------------------------------------


def hot(column: str, prefix: str, values) -> str:
    return ", ".join(f"""CAST(coalesce({column} = '{v}', false) AS INT) AS "{prefix}_{v}\"""" for v in values)


ONE_HOT = ", ".join(
    [
        hot("outlet_size", "size", config.OUTLET_SIZE_VALUES),
        hot("outlet_type", "type", config.OUTLET_TYPE_VALUES),
        hot("province", "prov", config.PROVINCE_VALUES),
    ]
)
block(
    "features",
    "outlet_master roll_up poi_wide",
    f"""
SELECT o.*, r.* EXCLUDE (outlet_id), p.* EXCLUDE (outlet_id), {ONE_HOT},
       hist_total_std / nullif(hist_total_mean, 0) AS volume_cv,
       hist_total_max / nullif(hist_total_mean, 0) AS max_to_mean_ratio
FROM outlet_master o LEFT JOIN roll_up r ON o.outlet_id = r.outlet_id LEFT JOIN poi_wide p ON o.outlet_id = p.outlet_id""",
)
block(
    "gaps",
    "features",
    """
SELECT *, CASE WHEN unc_deflated_mean IS NOT NULL AND hist_total_mean <> 0
               THEN least(greatest(unc_deflated_mean / hist_total_mean, 1.0), 2.0) END AS gap FROM features""",
)
block(
    "uplift",
    "gaps",
    """
SELECT outlet_id, least(greatest(1.0 + coalesce(months_constrained / nullif(months_observed, 0), 0)
         * (coalesce(gap, (SELECT median(gap) FROM gaps), 1.0) - 1.0), 1.0), 1.6) AS constraint_uplift
FROM gaps""",
)
block(
    "target_season",
    "seasonality",
    """
SELECT distributor_id, max(seasonality_index) AS season_index FROM seasonality
WHERE month = 1 AND year = CASE WHEN (SELECT count(*) FROM seasonality WHERE month = 1 AND year = 2026) > 0 THEN 2026 ELSE 2025 END
GROUP BY distributor_id""",
)
_ACCESS = " + ".join(
    f"{w} * coalesce(poi_access_{c}_1000m, 0)" for c, w in config.POI_DEMAND_WEIGHT.items() if w > 0
)
block(
    "spatial_inputs",
    "features own_density",
    f"""
SELECT f.outlet_id, coalesce(d.own_network_density, 0.0) AS own_network_density, {_ACCESS} AS poi_accessibility,
       coalesce(d.own_network_density, 0.0) + 0.5 * coalesce(poi_count_shop_500m, 0) AS saturation_index
FROM features f LEFT JOIN own_density d ON f.outlet_id = d.outlet_id""",
)


def robust_z(value: str, table: str) -> str:
    def q(p):
        return f"(SELECT quantile_cont({value}, {p}) FROM {table})"

    iqr = f"({q(0.75)} - {q(0.25)})"
    return (
        f"coalesce(({value} - {q(0.5)}) / (CASE WHEN {iqr} > 0 THEN {iqr} / 1.349 "
        f"ELSE coalesce(nullif((SELECT stddev_pop({value}) FROM {table}), 0), 1.0) END), 0.0)"
    )


block(
    "spatial_raw",
    "spatial_inputs",
    f"""
SELECT *, 0.18 * {robust_z('ln(1 + greatest(poi_accessibility, 0))', 'spatial_inputs')}
        - 0.15 * {robust_z('ln(1 + greatest(saturation_index, 0))', 'spatial_inputs')} AS raw
FROM spatial_inputs""",
)
block(
    "spatial",
    "spatial_raw",
    """
SELECT outlet_id, own_network_density, poi_accessibility, saturation_index,
       least(greatest(1.0 + raw - (SELECT median(raw) FROM spatial_raw), 0.70), 1.40) AS spatial_multiplier
FROM spatial_raw""",
)
block(
    "factored",
    "features uplift target_season spatial",
    """
SELECT f.*, u.constraint_uplift, coalesce(nullif(t.season_index, 0), 1.0) AS seasonality_jan_index,
       s.* EXCLUDE (outlet_id), CAST(substr(f.outlet_id, 5) AS BIGINT) % 25 AS peer_cluster,
       CASE WHEN months_observed >= 3 THEN hist_deflated_p90 * 1.05 END AS quantile_regression
FROM features f LEFT JOIN uplift u ON f.outlet_id = u.outlet_id
  LEFT JOIN target_season t ON f.distributor_id = t.distributor_id
  LEFT JOIN spatial s ON f.outlet_id = s.outlet_id""",
)
block(
    "peer_values",
    "factored",
    """
SELECT peer_cluster, quantile_cont(unc_deflated_p90, 0.9) AS q, median(hist_total_median) AS med,
       max(coalesce(hist_total_max, 0)) AS top
FROM factored GROUP BY peer_cluster""",
)
block(
    "peered",
    "factored peer_values",
    """
SELECT f.*, q * coalesce(CASE WHEN hist_total_median IS NOT NULL AND med <> 0
                              THEN least(greatest(hist_total_median / med, 0.5), 2.0) END, 1.0) AS peer_ceiling, top
FROM factored f LEFT JOIN peer_values p ON f.peer_cluster = p.peer_cluster""",
)
block(
    "estimated",
    "peered target_season",
    """
SELECT p.*, greatest(least(greatest(coalesce(peer_ceiling * constraint_uplift * seasonality_jan_index * spatial_multiplier,
                                             coalesce(hist_total_max, 0)), coalesce(hist_total_max, 0)), top * 1.6),
                     coalesce(hist_total_max, 0)) AS mult_potential,
       CASE WHEN coalesce(months_unconstrained, 0) >= 2
            THEN unc_deflated_max * coalesce(nullif(t.season_index, 0), 1.0) END AS unconstrained_extrapolation
FROM peered p LEFT JOIN target_season t ON p.distributor_id = t.distributor_id""",
)


def blend_sql(peer: float, qreg: float, unc: float) -> str:
    names = {"peer_ceiling": peer, "quantile_regression": qreg, "unconstrained_extrapolation": unc}
    top = " + ".join(f"CASE WHEN {n} >= 0 THEN {w} * {n} ELSE 0 END" for n, w in names.items())
    bottom = " + ".join(f"CASE WHEN {n} >= 0 THEN {w} ELSE 0 END" for n, w in names.items())
    return f"(({top}) / nullif({bottom}, 0))"


block(
    "scored",
    "estimated",
    f"""
SELECT *, CASE WHEN abs(ensemble_potential) > 1e-9
               THEN 100.0 * (mult_potential - ensemble_potential) / ensemble_potential END AS divergence_pct
FROM (SELECT *, greatest(coalesce({blend_sql(0.4, 0.3, 0.3)}, coalesce(hist_total_max, 0)), coalesce(hist_total_max, 0))
                AS ensemble_potential FROM estimated) AS e""",
)
block(
    "headrooms",
    "scored",
    """
SELECT outlet_id, distributor_id, province, hist_total_median, cooler_count,
       greatest(coalesce(mult_potential, 0), 0) AS potential, greatest(coalesce(hist_total_median, 0), 0) AS historical,
       greatest(greatest(coalesce(mult_potential, 0), 0) - greatest(coalesce(hist_total_median, 0), 0), 0) AS headroom
FROM scored WHERE province = 'Western'""",
)
block(
    "steps",
    "headrooms",
    """
SELECT outlet_id, count(*) AS steps FROM (
  SELECT outlet_id FROM (
    SELECT outlet_id, j, headroom * exp(-0.000005 * (j * 5000.0)) * (1 - exp(-0.025)) AS gain
    FROM headrooms, range(50) AS r(j) WHERE headroom > 0) AS g
  ORDER BY gain DESC, outlet_id, j LIMIT 1000) AS best GROUP BY outlet_id""",
)
block(
    "allocated",
    "headrooms steps",
    """
SELECT *, CASE WHEN headroom > 0 THEN expected_incremental_liters / headroom ELSE 0 END AS headroom_captured_frac
FROM (SELECT h.*, coalesce(s.steps, 0) * CAST(5000 AS DOUBLE) AS trade_spend_lkr,
             headroom * (1 - exp(-0.000005 * (coalesce(s.steps, 0) * CAST(5000 AS DOUBLE)))) AS expected_incremental_liters
      FROM headrooms h LEFT JOIN steps s ON h.outlet_id = s.outlet_id) AS a""",
)
block(
    "factor_rows",
    "scored",
    """
SELECT outlet_id, peer_ceiling, constraint_uplift, seasonality_jan_index, spatial_multiplier, mult_potential,
       ensemble_potential, divergence_pct, coalesce(abs(divergence_pct) > 50, false) AS divergence_flag,
       coalesce(hist_total_max, 0) AS hist_total_max
FROM scored""",
)
block(
    "master",
    "scored factor_rows allocated",
    """
SELECT f.outlet_id, f.province, f.distributor_id, outlet_type, outlet_size, latitude, longitude, f.cooler_count,
       f.hist_total_median, hist_total_mean, months_observed, months_constrained, months_unconstrained,
       poi_accessibility, saturation_index, own_network_density,
       r.* EXCLUDE (outlet_id), round_even(a.trade_spend_lkr, 2) AS "Trade_Spend_Allocation_LKR", a.headroom,
       a.expected_incremental_liters, a.headroom_captured_frac,
       coalesce(r.peer_ceiling, 1) * coalesce(r.constraint_uplift, 1) * coalesce(r.seasonality_jan_index, 1)
         * coalesce(r.spatial_multiplier, 1) AS raw_factor_product
FROM scored f LEFT JOIN factor_rows r ON f.outlet_id = r.outlet_id LEFT JOIN allocated a ON f.outlet_id = a.outlet_id""",
)
MASTER_DOUBLES = (
    "hist_total_median hist_total_mean poi_accessibility:8 saturation_index peer_ceiling constraint_uplift "
    "spatial_multiplier mult_potential ensemble_potential divergence_pct headroom expected_incremental_liters "
    "headroom_captured_frac raw_factor_product"
).split()
