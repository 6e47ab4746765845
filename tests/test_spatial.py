import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight import config
from shelfsight.operators import geo, poi, spatial


def metres(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * config.EARTH_RADIUS_M * math.asin(math.sqrt(h))


def test_distance_and_decay(frame):
    df = frame("d double", (0.0,), (100.0,), (None,))
    g = df.select(geo.decay_weight(F.col("d"), F.lit(100.0), "gaussian").alias("w"))
    e = df.select(geo.decay_weight(F.col("d"), F.lit(100.0), "exponential").alias("w"))
    assert [r.w for r in g.collect()] == pytest.approx([1.0, math.exp(-0.5), 0.0])
    assert [r.w for r in e.collect()] == pytest.approx([1.0, math.exp(-1), 0.0])
    none = df.select(geo.decay_weight(F.col("d"), F.lit(0.0)).alias("w"))
    assert {r.w for r in none.collect()} == {0.0}
    one = frame("x int", (1,)).select(geo.haversine_m(*[F.lit(v) for v in (6.9, 79.8, 7.0, 79.9)]).alias("m")).first().m
    assert one == pytest.approx(metres(6.9, 79.8, 7.0, 79.9))


@pytest.mark.parametrize("lat0", [0.0, 7.0, -33.0, 60.0, 84.0])
@pytest.mark.parametrize("radius", [300.0, 2500.0])
def test_radius_join_equals_brute_force(spark, lat0, radius):
    rng = random.Random(int(lat0) + int(radius))
    # A span of several cells, narrow in degrees where meridians are close.
    span = 4 * math.degrees(radius / config.EARTH_RADIUS_M)
    wide = span / math.cos(math.radians(lat0))

    def points(n):
        return [(i, lat0 + rng.uniform(-span, span), rng.uniform(-wide, wide)) for i in range(n)]

    a, b = points(120), points(120)
    left = spark.createDataFrame(a, "i int, latitude double, longitude double")
    right = spark.createDataFrame(b, "j int, lat double, lon double")
    got = {(r.i, r.j) for r in geo.radius_join(left, right, radius).collect()}
    pairs = geo.radius_join(left, right, radius)
    assert pairs.count() == len(got)
    assert got == {(i, j) for i, y, x in a for j, v, u in b if metres(y, x, v, u) <= radius}


def test_radius_join_refuses_the_poles(frame):
    df = frame("latitude double, longitude double", (89.0, 0.0))
    with pytest.raises(Exception, match="latitude beyond"):
        geo.radius_join(df, frame("lat double, lon double", (0.0, 0.0)), 100.0).collect()


POI = "poi_id int, lat double, lon double, center struct<lat:double,lon:double>, tags map<string,string>"


@pytest.fixture
def points(frame):
    return frame(
        POI,
        (1, 7.0, 80.0, None, {"amenity": "school", "shop": "yes"}),
        (2, 7.0, 80.0, (None, None), {"amenity": "school"}),
        (3, 0.0, 0.0, (7.001, 80.0), {"shop": "kiosk"}),
        (4, None, None, None, {"amenity": "clinic"}),
        (5, 7.0, 80.0, None, {"amenity": "bench"}),
        (6, 7.007, 80.0, None, {"amenity": "cafe"}),
    )


def test_classification_and_position(points):
    out = rows(poi.locate(points), "poi_id", "category", "lat")
    assert out == [(1, "school", 7.0), (2, "school", 7.0), (3, "shop", 7.001), (4, "hospital", None), (6, "restaurant", 7.007)]


def test_poi_features(frame, points):
    outlets = frame(
        "outlet_id string, latitude double, longitude double", ("a", 7.0, 80.0), ("b", 7.0, 80.0), ("far", 9.0, 80.0), ("none", None, 80.0)
    )
    out = {r.outlet_id: r for r in poi.poi_features(outlets, points).collect()}
    assert set(out) == {"a", "b", "far"}
    a = out["a"]
    assert (a.poi_count_school_500m, a.poi_nearest_school_500m, a.poi_access_school_500m) == (2, 0.0, 2.0)
    d = metres(7.0, 80.0, 7.001, 80.0)
    assert a.poi_nearest_shop_500m == pytest.approx(d)
    assert a.poi_access_shop_500m == pytest.approx(math.exp(-(d**2) / (2 * 200.0**2)), abs=1e-6)
    assert (a.poi_count_restaurant_500m, a.poi_count_restaurant_1000m) == (0, 1)
    assert (a.poi_total_500m, a.poi_total_1000m) == (3, 4)
    assert tuple(a)[1:] == tuple(out["b"])[1:]
    far = out["far"]
    assert (far.poi_total_1000m, far.poi_nearest_shop_500m, far.poi_access_shop_500m) == (0, None, 0.0)
    assert poi.poi_features(outlets, points, limit=1).count() == 1


def test_radius_is_inclusive(frame):
    d = metres(7.0, 80.0, 7.004, 80.0)
    left, right = frame("latitude double, longitude double", (7.0, 80.0)), frame("lat double, lon double", (7.004, 80.0))
    assert geo.radius_join(left, right, d * (1 + 1e-12)).count() == 1
    assert geo.radius_join(left, right, d * (1 - 1e-9)).count() == 0


def test_features_from_responses(spark, frame, tmp_path):
    from shelfsight.sources import files

    (tmp_path / "a_1__500.json").write_text(
        '{"elements": [{"lat": 7.0, "lon": 80.0, "tags": {"amenity": "cafe"}}, {"tags": {"amenity": "cafe"}},'
        '\n {"center": {"lat": 7.0, "lon": 80.0}, "tags": {"shop": "x"}}, {"lat": 7.0, "lon": 80.0}]}'
    )
    (tmp_path / "b__500.json").write_text("{not json")
    responses = files.read_poi_responses(spark, str(tmp_path))
    assert rows(responses.where("corrupt"), "outlet_id") == [("b",)]
    outlets = frame("outlet_id string, latitude double, longitude double", ("a_1", 7.0, 80.0), ("b", 7.0, 80.0))
    out = {r.outlet_id: r for r in poi.poi_features_from_responses(outlets, responses, (500,)).collect()}
    a = out["a_1"]
    assert (a.poi_count_restaurant_500m, a.poi_access_restaurant_500m, a.poi_count_shop_500m, a.poi_total_500m) == (2, 1.0, 1, 3)
    assert (out["b"].poi_total_500m, out["b"].poi_nearest_shop_500m) == (0, None)


@pytest.mark.parametrize("lat0", [0.0, 7.0, -60.0])
@pytest.mark.parametrize("direct", [1, 30, 1 << 20])
def test_counts_within_equals_brute_force(spark, lat0, direct):
    rng = random.Random(direct)
    # A crowd in a small place, more around it, some at one spot.
    deg = math.degrees(500 / config.EARTH_RADIUS_M)
    points = [(lat0 + rng.gauss(0, deg / 3), rng.gauss(0, deg / 3)) for _ in range(150)]
    points += [(lat0 + rng.uniform(-2, 2) * deg, rng.uniform(-4, 4) * deg) for _ in range(150)]
    points += [points[0]] * 5
    df = spark.createDataFrame(points, "latitude double, longitude double")
    spots = geo.places(df, "latitude", "longitude")
    got = {(r.latitude, r.longitude): r.within for r in geo.counts_within(spots, "latitude", "longitude", "n", 500.0, direct).collect()}
    assert got == {p: sum(metres(*p, *q) <= 500.0 for q in points) for p in points}


def _compared(spark, n):
    """Pairs of positions compared one by one, of n positions spread over three kilometres."""
    rng = random.Random(n)
    side = math.degrees(3000 / config.EARTH_RADIUS_M)
    spots = spark.createDataFrame([(rng.random() * side, rng.random() * side, 1) for _ in range(n)], "latitude double, longitude double, n int")
    height = geo._row_height(1000.0) / 2
    placed = geo._bands(spots, "latitude", "longitude", "n", height)
    rim = geo.refine(placed, "n", height, 1000.0, 64)[1]
    sizes = [geo._cells(placed, "n", level, "").withColumn("_level", F.lit(level)) for level in range((rim.agg(F.max("_level")).first()[0]) + 1)]
    cells = {(r["_level"], r["_r"], r["_c"]): r["_k"] for level in sizes for r in level.collect()}
    return sum(cells[r["_level"], r["_r1"], r["_c1"]] * cells[r["_level"], r["_r2"], r["_c2"]] for r in rim.collect())


def test_comparisons_grow_slower_than_pairs(spark):
    """Sixteen times the positions: 64 times the comparisons by the power 1.5, where listing all pairs takes 256 times."""
    few, many = _compared(spark, 1000), _compared(spark, 16000)
    assert many / few < 80
    assert many < 0.1 * 16000**2


@pytest.mark.parametrize("direct", [1, 1024])
def test_own_density(frame, direct):
    df = frame(
        "outlet_id string, latitude double, longitude double",
        ("a", 7.0, 80.0), ("b", 7.0, 80.0), ("c", 7.003, 80.0), ("d", 8.0, 80.0), ("e", None, 80.0),
    )
    assert rows(spatial.with_own_density(df, direct=direct), "outlet_id", "own_network_density") == [
        ("a", 2.0), ("b", 2.0), ("c", 2.0), ("d", 0.0), ("e", 0.0),
    ]
    assert rows(spatial.with_own_density(df.drop("latitude")), "own_network_density") == [(0.0,)] * 5


def test_robust_z_of_odd_columns(frame):
    df = frame("id int, same double, none double, spiky double", *[(i, 5.0, None, 10.0 if i == 0 else 0.0) for i in range(9)])
    out = spatial.with_robust_z(df, {c: F.col(c) for c in ("same", "none", "spiky")}).collect()
    assert {r.same for r in out} == {0.0} and {r.none for r in out} == {0.0}
    spread = math.sqrt(100 / 9 - (10 / 9) ** 2)
    assert max(r.spiky for r in out) == pytest.approx(10 / spread)


def test_multiplier_centres_on_one_and_clamps(frame):
    df = frame("poi_accessibility double, saturation_index double", *[(float(i * i), float(60 - i)) for i in range(61)])
    out = sorted(r.spatial_multiplier for r in spatial.with_multiplier(df).collect())
    assert out[30] == pytest.approx(1.0) and out[0] == 0.70 and out[-1] <= 1.40


def test_accessibility_and_saturation(frame):
    df = frame("poi_access_market_1000m double, poi_access_shop_1000m double, poi_count_shop_500m int, own_network_density double", (2.0, 9.0, 3, 1.0))
    assert df.select(spatial.accessibility(df)).first()[0] == pytest.approx(2.6)
    assert df.select(spatial.saturation(df)).first()[0] == 2.5


def test_hot_cells_are_cut_into_parts(spark):
    """One cell holds nearly all points: no task gets more candidates than allowed, and no pair is lost or doubled."""
    rng = random.Random(9)
    deg = math.degrees(500 / config.EARTH_RADIUS_M)
    left = [(i, rng.random() * deg / 4, rng.random() * deg / 4) for i in range(300)] + [(1000 + i, rng.random() * 9 * deg, 0.1) for i in range(30)]
    right = [(i, rng.random() * deg / 4, rng.random() * deg / 4) for i in range(200)] + [(2000 + i, rng.random() * 9 * deg, 0.1) for i in range(30)]
    a = spark.createDataFrame(left, "l int, latitude double, longitude double")
    b = spark.createDataFrame(right, "r int, lat double, lon double")
    want = sorted((i, j) for i, *p in left for j, *q in right if metres(*p, *q) <= 500.0)
    for most in (1, 500, 4_000_000):
        found = geo.radius_join(a, b, 500.0, most_pairs=most)
        assert rows(found, "l", "r") == rows(spark.createDataFrame(want, "l int, r int")) and "_l_own" not in found.columns
    cells = a.select("*", geo._row(F.col("latitude"), 500.0).alias("_ca")).withColumn("_co", geo._cell(F.col("_ca"), F.col("longitude"), 500.0))
    there = b.select("*", geo._row(F.col("lat"), 500.0).alias("_ra")).withColumn("_ro", geo._cell(F.col("_ra"), F.col("lon"), 500.0))
    hot = geo._hot_cells(cells, there, 500)
    dealt = geo._dealt(cells, hot, "_ca", "_co", ("latitude", "longitude"), "_lines", "_rows", "_l").groupBy("_ca", "_co", "_l_own", "_l_other").count()
    other = geo._dealt(there, hot, "_ra", "_ro", ("lat", "lon"), "_rows", "_lines", "_r").groupBy("_ra", "_ro", "_r_own", "_r_other").count()
    sizes = {tuple(r)[:4]: r["count"] for r in dealt.collect()}
    pairs = [sizes.get((r._ra, r._ro, r._r_other, r._r_own), 0) * r["count"] for r in other.collect()]
    assert max(pairs) <= 4 * 500 and len(pairs) > 60


def test_sides_repeated_by_an_explode_are_not_broadcast(spark, tmp_path):
    """The files are small, but the planner does not see that each row of a side is repeated."""
    for name, columns in (("left", ("latitude", "longitude")), ("right", ("lat", "lon"))):
        spark.range(50).selectExpr(f"id * 0.001 AS {columns[0]}", f"id * 0.002 AS {columns[1]}").write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    plan = geo.radius_join(left, right, 500.0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_ca" in plan  # the hot cells, counted and written, may be broadcast
    near = geo.counts_within(geo.places(left, "latitude", "longitude"), "latitude", "longitude", "n", 500.0, direct=4)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_level" in plan and "BroadcastHashJoin" not in plan
