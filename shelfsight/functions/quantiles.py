"""Exact order statistics that never put a large group into one task.

Spark's ``percentile`` gathers all distinct values of a group in one buffer.
That is right for groups with a small natural bound (the months of an outlet),
and is what the outlet roll-up uses. The functions here serve groups without
such a bound: the whole table, a peer cluster, a province, a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfsight.functions import ordering
from shelfsight.session import stage

ACCURACY = 100_000


def _melt(df: DataFrame, metrics: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row per (keys, metric, value), without missing keys or values."""
    keyed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    if len(metrics) == 1:
        ((name, value),) = metrics.items()
        rows = df.select(*keyed, F.lit(name).alias("_metric"), value.cast("double").alias("_v"))
    else:
        pairs = F.array(
            *[F.struct(F.lit(n).alias("_metric"), v.cast("double").alias("_v")) for n, v in metrics.items()]
        )
        rows = df.select(*keyed, F.inline(pairs))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for i in range(len(keys)):
        rows = rows.where(F.col(f"_k{i}").isNotNull())
    return rows


def exact_quantiles(
    df: DataFrame,
    metrics: Mapping[str, Column],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
    few_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles: ``keys, metric, n, q`` (array in the order of ``probs``).

    Pass 1 sketches each group (bounded, mergeable, so map-side combined) and
    brackets every wanted rank between two sketch values. Pass 2 counts what
    lies below a bracket and keeps only the distinct values inside it, a
    ``12 / accuracy`` part of the group at most; the exact rank is then read off
    a running count over those. Equal values collapse before the shuffle.

    ``few_groups``: the caller knows the number of groups to be small (say the
    cluster count), so the brackets may be broadcast. A call without keys has
    one group per metric and always does.
    """
    probs = [float(p) for p in probs]
    key_cols = [f"_k{i}" for i in range(len(keys))]
    group = [*key_cols, "_metric"]
    margin = 4.0 / accuracy
    # Up to here the whole group is its own bracket.
    small = 2 * accuracy

    rows = _melt(df, metrics, keys)
    wanted = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]
    sketch = rows.groupBy(*group).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", F.array(*map(F.lit, wanted)), F.lit(accuracy)).alias("_s"),
    )
    whole = F.col("_n") <= small
    infinity = F.lit(float("inf"))
    bounds = []
    for i, p in enumerate(probs):
        low = -infinity if p - margin <= 0 else F.when(whole, -infinity).otherwise(F.col("_s")[i])
        high = infinity if p + margin >= 1 else F.when(whole, infinity).otherwise(F.col("_s")[len(probs) + i])
        bounds += [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]
    brackets = sketch.select(*[F.col(g).alias(f"_b{g}") for g in group], "_n", *bounds)
    if few_groups or not keys:
        brackets = F.broadcast(brackets)
    else:
        # As a written table it has a known size: small, it is broadcast and the rows stay in place.
        brackets = stage(brackets, "brackets")

    same_group = [F.col(g) == F.col(f"_b{g}") for g in group]
    v = F.col("_v")
    places = F.array(
        *[
            F.when(v < F.col(f"_lo{i}"), F.struct(F.lit(i).alias("_i"), F.lit(None).cast("double").alias("_x")))
            .when(v <= F.col(f"_hi{i}"), F.struct(F.lit(i).alias("_i"), v.alias("_x")))
            for i in range(len(probs))
        ]
    )
    counts = (
        rows.join(brackets, same_group)
        .select(*group, "_n", F.inline(F.filter(places, lambda s: s.isNotNull())))
        .groupBy(*group, "_n", "_i", "_x")
        .agg(F.count("*").alias("_c"))
    )
    # The NULL row holds the count below the bracket and sorts first.
    order = Window.partitionBy(*group, "_n", "_i").orderBy(F.col("_x").asc_nulls_first())
    upto = counts.withColumn("_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1) * (F.col("_n") - 1)
    upto = upto.withColumn("_r", rank)

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= k) & (k < F.col("_upto")), F.col("_x")))

    picked = upto.groupBy(*group, "_n", "_i", "_r").agg(
        at(F.floor("_r")).alias("_low"), at(F.ceil("_r")).alias("_high")
    )
    missed = F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")
    low, high = F.coalesce("_low", missed), F.coalesce("_high", missed)
    value = F.when(low == high, low).otherwise(low + (high - low) * (F.col("_r") - F.floor("_r")))
    picked = picked.select(*group, "_n", "_i", value.alias("_q"))
    per_prob = [F.max(F.when(F.col("_i") == i, F.col("_q"))) for i in range(len(probs))]
    return picked.groupBy(*group, "_n").agg(F.array(*per_prob).alias("q")).select(
        *[F.col(c).alias(k) for c, k in zip(key_cols, keys)],
        F.col("_metric").alias("metric"),
        F.col("_n").alias("n"),
        "q",
    )


def quantile_row(df: DataFrame, metrics: Mapping[str, Column], probs: Sequence[float]) -> DataFrame:
    """One row with an array column per metric; NULL for a metric without values."""
    long = exact_quantiles(df, metrics, probs)
    return long.agg(*[F.max(F.when(F.col("metric") == name, F.col("q"))).alias(name) for name in metrics])


@dataclass(frozen=True)
class Summary:
    """Present values of a column: how many, their exact median, mean and sum of squares around it; ``missing`` counts the others."""

    n: int
    missing: int
    median: float | None
    mean: float
    squares: float

    def filled(self) -> tuple[float, float]:
        """(mean, deviation of the whole population) with the median for what is missing."""
        total = self.n + self.missing
        mean = self.mean + (self.median - self.mean) * self.missing / total
        squares = self.squares + (self.median - self.mean) ** 2 * self.n * self.missing / total
        return mean, (squares / total) ** 0.5


# Of the sorted values of so many rows one in _STRIDE is kept for the brackets.
_CHUNK, _STRIDE = 16_384, 64

# How far from the middle, as a part of all, a bracket may begin and end; beyond that a column is its own bracket.
_MARGINS = (0.005, 0.02, 0.1)


def _chunks(batches: Iterator[pa.RecordBatch], most: int = _CHUNK) -> Iterator[np.ndarray]:
    """Rows of numbers, NaN where missing, about ``most`` at a time."""
    held, count = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns]))
            count += batch.num_rows
        if count >= most:
            yield np.concatenate(held)
            held, count = [], 0
    if held:
        yield np.concatenate(held)


def column_summaries(df: DataFrame, values: Sequence[Column]) -> list[Summary]:
    """A :class:`Summary` of each of many columns, NULL and NaN being missing, in two passes over the rows.

    The first pass sorts the rows in chunks and keeps one value in 64 of each
    column. How far ranks among those can be from ranks among all is known, so
    they give a bracket that holds the median for certain. The second pass counts
    what lies below it, and the distinct values inside: one in a hundred of a large table.
    """
    wide = df.select(*[v.cast("double").alias(f"x{i}") for i, v in enumerate(values)])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(invalid="ignore", divide="ignore"):
            for rows in _chunks(batches):
                rows.sort(axis=0)  # NaN comes last
                n = (~np.isnan(rows)).sum(axis=0)
                there = [rows[:k, i] for i, k in enumerate(n)]
                mean = np.array([v.mean() if len(v) else 0.0 for v in there])
                squares = np.array([((v - m) ** 2).sum() for v, m in zip(there, mean)])
                some = [v[_STRIDE // 2 :: _STRIDE] for v in there]
                yield pa.RecordBatch.from_pydict(
                    {
                        "i": pa.array(np.arange(len(n), dtype=np.int32)), "n": pa.array(n.astype(np.int64)), "missing": pa.array(len(rows) - n.astype(np.int64)),
                        "mean": pa.array(mean), "squares": pa.array(squares), "some": pa.array(some, pa.list_(pa.float64())),
                    }
                )

    chunks = stage(wide.mapInArrow(kept, "i int, n long, missing long, mean double, squares double, some array<double>"), "column_chunks")
    about = {
        r.i: r
        for r in chunks.groupBy("i").agg(
            F.count("*").alias("chunks"), F.sum("n").alias("n"), F.sum("missing").alias("missing"),
            (F.try_divide(F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("mean"))), F.sum("n"))).alias("mean"),
        ).collect()
    }
    if not about:
        return [Summary(0, 0, None, 0.0, 0.0) for _ in values]
    means = F.element_at(F.lit([float(about[i].mean or 0.0) for i in range(len(values))]), F.col("i") + 1)
    around = F.sum(F.when(F.col("n") > 0, F.col("squares") + F.col("n") * (F.col("mean") - means) * (F.col("mean") - means)))
    squares = dict(chunks.groupBy("i").agg(around.alias("s")).collect())

    # A rank among all is 64 times the rank among the kept ones, give or take 48 for each chunk; the sketch adds a twenty-thousandth.
    margin = {i: 0.001 + 0.75 * _STRIDE * (r.chunks + 2) / r.n for i, r in about.items() if r.n}
    sketch = chunks.select("i", F.explode("some").alias("v")).groupBy("i").agg(
        *[F.percentile_approx("v", [0.5 - m, 0.5 + m], 20_000).alias(f"b{k}") for k, m in enumerate(_MARGINS)]
    )
    low, high = np.full(len(values), -np.inf), np.full(len(values), np.inf)
    for i, *around_median in sketch.collect():
        for m, b in zip(_MARGINS, around_median):
            if margin[i] <= m:
                low[i], high[i] = b
                break

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros(len(low), dtype=np.int64)
        for rows in _chunks(batches):
            below += (rows < low).sum(axis=0)
            at, v = np.nonzero(((rows >= low) & (rows <= high)).T)
            found = rows[v, at]
            order = np.lexsort((found, at))
            at, found = at[order], found[order]
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (found[1:] != found[:-1])])[: len(at)])
            yield _counted(at[new], found[new], np.diff(np.append(new, len(at))), None)
        yield _counted(np.arange(len(low)), np.zeros(len(low)), below, np.ones(len(low), dtype=bool))

    counts = wide.mapInArrow(inside, "i int, x double, c long").groupBy("i", "x").agg(F.sum("c").alias("c"))
    # The NULL row holds the count below the bracket and sorts first.
    upto = F.sum("c").over(Window.partitionBy("i").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    last = F.element_at(F.lit([int(about[i].n) - 1 for i in range(len(values))]), F.col("i") + 1)

    def at_rank(k: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("c") <= k) & (k < F.col("_upto")), F.col("x")))

    ranked = counts.withColumn("_upto", upto).groupBy("i").agg(at_rank(F.floor(last / 2)).alias("a"), at_rank(F.ceil(last / 2)).alias("b"))
    medians = {r.i: (r.a, r.b) for r in ranked.collect()}
    out = []
    for i in range(len(values)):
        r, (a, b) = about[i], medians[i]
        if r.n and (a is None or b is None):
            raise RuntimeError("median outside its bracket")
        middle = None if not r.n else a if a == b else a + (b - a) * 0.5
        out.append(Summary(r.n, r.missing, middle, r.mean or 0.0, squares[i] or 0.0))
    return out


def _counted(at: np.ndarray, x: np.ndarray, c: np.ndarray, unknown: np.ndarray | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(x, mask=unknown), pa.array(c.astype(np.int64))], ["i", "x", "c"])


def global_quantiles(df: DataFrame, metrics: Mapping[str, Column], probs: Sequence[float]) -> Column:
    """:func:`quantile_row` as a scalar subquery: a struct usable inside any expression."""
    row = quantile_row(df, metrics, probs)
    return row.select(F.struct(*metrics).alias("s")).scalar()


def global_median(df: DataFrame, value: Column) -> Column:
    return global_quantiles(df, {"m": value}, [0.5]).getField("m").getItem(0)


def quantiles_by(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, tuple[Column, float]],
    few_groups: bool = False,
) -> DataFrame:
    """``keys`` plus one column per entry ``name: (value, prob)``."""
    probs = sorted({p for _, p in metrics.values()})
    long = exact_quantiles(df, {n: v for n, (v, _) in metrics.items()}, probs, keys, few_groups=few_groups)
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == n, F.col("q")[probs.index(p)])).alias(n) for n, (_, p) in metrics.items()]
    )


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """A row ``a, b, n, rho`` for each pair of columns, over the rows where both are present.

    Rows with the same values of a pair collapse first, so a hot value costs no
    more than a rare one. All columns of all pairs are ranked at once.
    """
    number = lambda c: F.col(f"`{c}`").cast("double")
    each = F.array(
        *[F.struct(F.lit(i).alias("pair"), number(a).alias("x"), number(b).alias("y")) for i, (a, b) in enumerate(pairs)]
    )
    present = "x is not null and y is not null and not isnan(x) and not isnan(y)"
    counted = df.select(F.inline(each)).where(present).groupBy("pair", "x", "y").agg(F.count("*").alias("w"))
    counted = stage(counted, "value_pairs")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("v")) for side in ("x", "y")])
    values = counted.select("pair", "w", F.inline(sides)).groupBy("pair", "side", "v").agg(F.sum("w").alias("n"))
    ranks = ordering.average_ranks(values, ["pair", "side"], "v", "n")
    # Mean rank is (n + 1) / 2 whatever the ties; centring first keeps the sums small.
    ranks = stage(ranks.select("pair", "side", "v", (F.col("rank") - (F.col("size") + 1) / 2).alias("d")), "ranks")
    ranked = counted
    for side in ("x", "y"):
        of_side = ranks.where(F.col("side") == side).select("pair", F.col("v").alias(side), F.col("d").alias(f"d{side}"))
        ranked = ranked.join(of_side, ["pair", side])
    w, dx, dy = F.col("w"), F.col("dx"), F.col("dy")
    found = ranked.groupBy("pair").agg(
        F.sum("w").alias("n"), F.try_divide(F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))).alias("rho")
    )
    named = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, a string, b string")
    return named.join(found, "pair", "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"), "rho")
