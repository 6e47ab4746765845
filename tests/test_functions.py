import math
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight.functions import ordering, quantiles as Q, scalar as S


def interpolated(values, p):
    values = sorted(values)
    r = p * (len(values) - 1)
    low, high = values[math.floor(r)], values[math.ceil(r)]
    return low + (high - low) * (r - math.floor(r))


def test_column_summaries(spark):
    rng = random.Random(3)
    make = [
        lambda: rng.gauss(1e6, 1), lambda: float(rng.randint(0, 3)), lambda: 0.0 if rng.random() < 0.6 else rng.expovariate(1), lambda: 0.1,
        lambda: rng.choice([None, float("nan"), rng.random()]), lambda: None, lambda: rng.random() if rng.random() < 0.001 else None, lambda: rng.paretovariate(0.7),
    ]
    data = [[f() for f in make] for _ in range(40_001)]
    names = [f"c{i}" for i in range(len(make))]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(3)
    for frame_, given in ((df, data), (df.where("false"), []), (spark.createDataFrame(data[:4], df.schema), data[:4])):
        for i, got in enumerate(Q.column_summaries(frame_, [F.col(n) for n in names])):
            there = [r[i] for r in given if r[i] is not None and not math.isnan(r[i])]
            assert (got.n, got.missing) == (len(there), len(given) - len(there))
            assert got.median == (statistics.median(there) if there else None)
            if there:
                full = there + [got.median] * got.missing
                assert got.filled() == pytest.approx((statistics.fmean(full), statistics.pstdev(full)), rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("shape", ["continuous", "ties", "one_hot_value", "constant"])
@pytest.mark.parametrize("accuracy", [100, 100_000])
def test_exact_quantiles(spark, shape, accuracy):
    rng = random.Random(7)
    make = {
        "continuous": lambda: rng.gauss(0, 100),
        "ties": lambda: float(rng.randint(0, 9)),
        "one_hot_value": lambda: 0.0 if rng.random() < 0.6 else rng.expovariate(1),
        "constant": lambda: 3.0,
    }[shape]
    # One group holds most rows; others are tiny.
    data = [("hot", make()) for _ in range(5000)] + [("two", 1.0), ("two", 2.0), ("one", 9.0), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]
    out = {r.g: (r.n, r.q) for r in Q.exact_quantiles(df, {"v": F.col("v")}, probs, ["g"], accuracy=accuracy).collect()}
    assert set(out) == {"hot", "two", "one"}
    for g, (n, q) in out.items():
        values = [v for k, v in data if k == g]
        assert n == len(values)
        assert q == pytest.approx([interpolated(values, p) for p in probs], abs=1e-9)


def test_quantiles_of_several_columns(frame):
    df = frame("a double, b double", (1.0, None), (2.0, None), (3.0, None))
    row = Q.quantile_row(df, {"a": F.col("a"), "b": F.col("b")}, [0.5]).first()
    assert row.a == [2.0] and row.b is None
    assert df.select(Q.global_median(df, F.col("a"))).first()[0] == 2.0


def test_ranks_of_several_groups(spark):
    rng = random.Random(3)
    values = {g: [float(rng.randint(0, 40)) for _ in range(size)] + [rng.random() * 40 for _ in range(size)] for g, size in (("a", 500), ("b", 3))}
    df = spark.createDataFrame([(g, v) for g, own in values.items() for v in own], "g string, v double")
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    found = ordering.average_ranks(counted, ["g"], "v", "n").collect()
    assert len(found) == sum(len(set(own)) for own in values.values())
    for r in found:
        own = values[r.g]
        assert r["rank"] == sum(x < r.v for x in own) + (own.count(r.v) + 1) / 2 and r["size"] == len(own)


@pytest.mark.parametrize("n", [0, 1, 7, 199, 200, 500])
def test_first_rows(spark, n):
    rng = random.Random(n)
    given = [(float(rng.randint(0, 3)), f"k{i:03d}") for i in range(200)]
    df = spark.createDataFrame(given, "v double, k string")
    found = ordering.first_rows(df, n, [F.col("v").desc(), F.col("k")])
    assert sorted(map(tuple, found.collect())) == sorted(sorted(given, key=lambda r: (-r[0], r[1]))[:n])


def test_spearman(frame):
    df = frame("a double, b double", (1.0, 2.0), (2.0, 1.0), (2.0, 4.0), (4.0, 4.0), (5.0, None))
    ra, rb = [1, 2.5, 2.5, 4], [2, 1, 3.5, 3.5]
    found = {(r.a, r.b): r for r in Q.spearman(df, [("a", "b"), ("b", "a"), ("a", "a")]).collect()}
    assert found["a", "b"].rho == pytest.approx(statistics.correlation(ra, rb)) and found["a", "b"].n == 4
    assert found["b", "a"].rho == pytest.approx(found["a", "b"].rho) and (found["a", "a"].rho, found["a", "a"].n) == (pytest.approx(1.0), 5)
    assert Q.spearman(frame("a double, b double", (1.0, 1.0), (1.0, 2.0)), [("a", "b")]).first().rho is None
    none = Q.spearman(frame("a double, b double", (1.0, None), (None, 2.0)), [("a", "b")]).first()
    assert (none.n, none.rho) == (0, None)


def test_scalar_helpers(frame):
    df = frame("id int, x double", (1, None), (2, -1.0), (3, 5.0), (4, float("inf")), (5, float("nan")))
    assert rows(df.select("id", S.clip(F.col("x"), 0.0, 2.0).alias("c")).where("id < 4")) == [(1, None), (2, 0.0), (3, 2.0)]
    assert rows(df.where(S.finite(F.col("x")).isNotNull()), "id") == [(2,), (3,)]
    assert rows(df.select(S.ratio(F.lit(1.0), F.lit(0.0)).alias("r")).distinct()) == [(None,)]
    texts = frame("t string", ("1",), (" 2.5 ",), ("1d",), ("NaN",), ("x",), (None,), ("-.5e1",))
    assert rows(texts.select("t", S.number(texts, "t").alias("n")).where("n is not null"), "n") == [(-5.0,), (1.0,), (2.5,)]
    assert frame("t string", (" \n a b ",)).select(S.strip(F.col("t"))).first()[0] == "a b"
