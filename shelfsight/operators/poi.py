"""Features from points of interest around outlets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight import config
from shelfsight.functions import scalar as S
from shelfsight.operators.geo import decay_weight, haversine_m, places, radius_join


def classify(tags: Column) -> Column:
    """Category of a tag map; the first rule that fits wins, NULL without one."""
    out = None
    for category, key, values in config.POI_RULES:
        tag = F.try_element_at(tags, F.lit(key))
        hit = (tag != "") if values is None else tag.isin(*values)
        out = F.when(hit, F.lit(category)) if out is None else out.when(hit, F.lit(category))
    return out


def position(own: Column, centre: Column) -> Column:
    """Own coordinate, else the centre's. 0 counts as no coordinate."""
    return F.coalesce(F.nullif(own, F.lit(0.0)), centre)


def locate(poi: DataFrame) -> DataFrame:
    """Points of interest with ``category, lat, lon``; those of no category fall away."""
    return poi.select(
        *[c for c in poi.columns if c not in ("lat", "lon", "center", "tags")],
        classify(F.col("tags")).alias("category"),
        position(F.col("lat"), F.col("center.lat")).alias("lat"),
        position(F.col("lon"), F.col("center.lon")).alias("lon"),
    ).where("category is not null")


def nearby(outlets: DataFrame, located: DataFrame, radius_m: float) -> DataFrame:
    """``outlet_id, poi_id, category, distance_m`` of every outlet and point within the radius."""
    sites = outlets.select("outlet_id", "latitude", "longitude")
    pairs = radius_join(sites, located.select("poi_id", "category", "lat", "lon"), radius_m)
    return pairs.select("outlet_id", "poi_id", "category", "distance_m")


def site_hits(sites: DataFrame, located: DataFrame, radii_m: Sequence[int]) -> DataFrame:
    """Hits for :func:`features_from_hits`, keyed by position.

    Both sides are collapsed to distinct positions first: what surrounds a spot
    is worked out once, however many outlets share it, and a crowd of points of
    one category at one spot is a single row with a count. One join at the
    largest radius serves the smaller ones.
    """
    spots = places(sites, "latitude", "longitude").select("latitude", "longitude")
    points = places(located, "lat", "lon", "category")
    pairs = radius_join(spots, points, float(max(radii_m)))
    reached = F.array(*[F.when(F.col("distance_m") <= r, F.lit(r)) for r in radii_m])
    return pairs.select(
        "latitude", "longitude", "category", "distance_m", "n", F.explode(F.array_compact(reached)).alias("radius_m")
    )


def response_hits(responses: DataFrame, outlets: DataFrame) -> DataFrame:
    """Hits from saved responses, keyed by outlet.

    An element without a position counts, but has no distance.
    """
    element = responses.where("element is not null").select("outlet_id", "radius_m", "element.*")
    located = locate(element).alias("e")
    sites = outlets.select(F.col("outlet_id").alias("_oid"), "latitude", "longitude")
    joined = located.join(sites, F.col("outlet_id") == F.col("_oid"))
    distance = haversine_m(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    return joined.select("outlet_id", "radius_m", "category", distance.alias("distance_m"), F.lit(1).alias("n"))


def column_names(radii_m: Sequence[int], categories: Sequence[str] = config.POI_CATEGORIES) -> list[str]:
    out = []
    for r in radii_m:
        for c in categories:
            out += [f"poi_count_{c}_{r}m", f"poi_nearest_{c}_{r}m", f"poi_access_{c}_{r}m"]
        out.append(f"poi_total_{r}m")
    return out


def features_from_hits(
    hits: DataFrame,
    keys: Sequence[str],
    radii_m: Sequence[int] = config.SPATIAL.radii_m,
    kernel: str = config.SPATIAL.kernel,
) -> DataFrame:
    """Per key a column for each radius, category and measure: count, nearest distance, decayed pull.

    The hits shrink to at most one row per key, radius and category before they
    are spread over columns.
    """
    sigma = F.coalesce(S.lookup(F.col("category"), config.POI_SIGMA_M), F.lit(config.DEFAULT_SIGMA_M))
    pull = decay_weight(F.col("distance_m"), sigma, kernel)
    narrow = hits.groupBy(*keys, "radius_m", "category").agg(
        F.sum("n").alias("_count"), F.min("distance_m").alias("_nearest"), F.sum(F.col("n") * pull).alias("_access")
    )
    wide = []
    for r in radii_m:
        at_r = F.col("radius_m") == r
        for c in config.POI_CATEGORIES:
            here = at_r & (F.col("category") == c)
            wide += [
                F.coalesce(F.max(F.when(here, F.col("_count"))), F.lit(0)).alias(f"poi_count_{c}_{r}m"),
                F.max(F.when(here, F.col("_nearest"))).alias(f"poi_nearest_{c}_{r}m"),
                F.bround(F.coalesce(F.max(F.when(here, F.col("_access"))), F.lit(0.0)), 6).alias(f"poi_access_{c}_{r}m"),
            ]
        wide.append(F.coalesce(F.sum(F.when(at_r, F.col("_count"))), F.lit(0)).alias(f"poi_total_{r}m"))
    return narrow.groupBy(*keys).agg(*wide)


def _none_around(df: DataFrame, radii_m: Sequence[int]) -> DataFrame:
    """0 / NULL / 0.0 where nothing was found."""
    zero = {}
    for name in column_names(radii_m):
        if not name.startswith("poi_nearest_"):
            zero[name] = 0.0 if name.startswith("poi_access_") else 0
    return df.fillna(zero)


def _sites(outlets: DataFrame, limit: int | None) -> DataFrame:
    sites = outlets.select("outlet_id", "latitude", "longitude").where(
        "outlet_id is not null and latitude is not null and longitude is not null"
    )
    return sites.orderBy("outlet_id").limit(limit) if limit else sites


def poi_features(
    outlets: DataFrame,
    poi: DataFrame,
    radii_m: Sequence[int] = config.SPATIAL.radii_m,
    kernel: str = config.SPATIAL.kernel,
    limit: int | None = None,
) -> DataFrame:
    """One wide row per outlet with coordinates (or the first ``limit`` of them by id)."""
    sites = _sites(outlets, limit)
    spots = features_from_hits(site_hits(sites, locate(poi), radii_m), ["latitude", "longitude"], radii_m, kernel)
    return _none_around(sites.join(spots, ["latitude", "longitude"], "left"), radii_m).select(
        "outlet_id", *column_names(radii_m)
    )


def poi_features_from_responses(
    outlets: DataFrame,
    responses: DataFrame,
    radii_m: Sequence[int] = config.SPATIAL.radii_m,
    kernel: str = config.SPATIAL.kernel,
    limit: int | None = None,
) -> DataFrame:
    """The same table from saved responses; an outlet without a response has none around."""
    sites = _sites(outlets, limit)
    found = features_from_hits(response_hits(responses, sites), ["outlet_id"], radii_m, kernel)
    return _none_around(sites.join(found, "outlet_id", "left"), radii_m).select("outlet_id", *column_names(radii_m))
