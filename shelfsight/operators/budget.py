"""Splitting a promotion budget over outlets.

Lift is concave in spend and outlets do not affect each other, so the best
split takes the steps with the highest marginal lift. Steps of one outlet fall
in value, which makes "give the next step to the best outlet" the same as
"take the N best steps of all": a selection, not a loop.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, functions as F

from shelfsight import config
from shelfsight.functions import ordering, quantiles, scalar as S

_EPS = 1e-9


def allocation_inputs(
    features: DataFrame,
    factors: DataFrame,
    baseline: str = "hist_total_median",
    rules: config.BudgetRules = config.BUDGET,
) -> DataFrame:
    """Outlets of the province with potential, usual volume and headroom."""
    keep = [c for c in ("outlet_id", "distributor_id", "province", baseline, "cooler_count") if c in features.columns]
    df = features.select(*keep)
    if "province" in keep:
        df = df.where(F.col("province") == rules.province)
    # A row per outlet: two columns of a wide table look small enough to broadcast, whatever the rows.
    df = df.join(factors.select("outlet_id", F.col("mult_potential").alias("potential")).hint("merge"), "outlet_id", "left")

    def at_least_zero(x: Column) -> Column:
        return F.greatest(F.coalesce(x.cast("double"), F.lit(0.0)), F.lit(0.0))

    df = df.withColumns(
        {
            "historical": at_least_zero(S.col_or(df, baseline, None)),
            "potential": at_least_zero(F.col("potential")),
        }
    )
    return df.withColumn("headroom", F.greatest(F.col("potential") - F.col("historical"), F.lit(0.0)))


def max_steps(amount: float, step: float) -> int:
    return max(0, math.floor((amount + _EPS) / step))


def _marginal(headroom: Column, nth: Column, rules: config.BudgetRules) -> Column:
    """Lift of the step after ``nth`` steps."""
    return headroom * F.exp(-rules.k * (nth * rules.step)) * (1.0 - math.exp(-rules.k * rules.step))


def greedy_steps(df: DataFrame, rules: config.BudgetRules = config.BUDGET, close_steps: int = 1_000_000) -> DataFrame:
    """``outlet_id, steps`` of the outlets that get any. Equal gains go to the smaller id.

    Two gains are looked for that the last step taken lies between. Each round
    counts the steps above many gains in one aggregate, until no more than
    ``close_steps`` lie between the two or they are all but equal. Steps above
    both are taken by a formula; only those between are listed and put in order.
    """
    total, per_outlet = max_steps(rules.total, rules.step), max_steps(rules.cap, rules.step)
    open_ = df.select("outlet_id", "headroom").where("headroom > 0")
    none = open_.limit(0).select("outlet_id", F.lit(0).cast("bigint").alias("steps"))
    if total == 0 or per_outlet == 0:
        return none
    bounds = open_.agg(F.max("headroom").alias("high"), F.min("headroom").alias("low"), F.count("*").alias("n")).first()
    if bounds.n * per_outlet <= total:
        return open_.select("outlet_id", F.lit(per_outlet).cast("bigint").alias("steps"))
    factor = 1.0 - math.exp(-rules.k * rules.step)
    low = bounds.low * factor * math.exp(-rules.k * rules.step * per_outlet)
    low, high = _bracket(open_, total, per_outlet, rules, low, bounds.high * factor, bounds.n * per_outlet, close_steps)
    # The formula may be off by a rounding near the two gains; the margins put such steps among the listed ones.
    sure = _steps_above(F.col("headroom"), F.lit(high * (1 + 1e-9)), per_outlet, rules)
    upto = _steps_above(F.col("headroom"), F.lit(low * (1 - 1e-9)), per_outlet, rules)
    split = open_.withColumns({"_sure": sure, "_upto": upto})
    rest = total - split.agg(F.sum("_sure")).first()[0]
    between = split.where("_upto > _sure").select("outlet_id", "headroom", F.explode(F.sequence("_sure", F.col("_upto") - 1)).alias("_nth"))
    between = between.select("outlet_id", "_nth", _marginal(F.col("headroom"), F.col("_nth"), rules).alias("_gain"))
    more = ordering.first_rows(between, rest, [F.col("_gain").desc(), F.col("outlet_id"), F.col("_nth")])
    more = more.groupBy("outlet_id").agg(F.count("*").alias("_more"))
    steps = F.col("_sure") + F.coalesce("_more", F.lit(0))
    return split.join(more, "outlet_id", "left").select("outlet_id", steps.alias("steps")).where("steps > 0")


def _steps_above(headroom: Column, gain: Column, per_outlet: int, rules: config.BudgetRules) -> Column:
    """How many of an outlet's steps are worth more than ``gain``."""
    first = headroom * (1.0 - math.exp(-rules.k * rules.step))
    n = F.ceil(F.log(first / gain) / (rules.k * rules.step))
    return F.when(first > gain, F.least(n, F.lit(per_outlet))).otherwise(0).cast("bigint")


def _bracket(
    df: DataFrame, total: int, per_outlet: int, rules: config.BudgetRules, low: float, high: float, below: int, close: int, probes: int = 64
) -> tuple[float, float]:
    """Gains ``low`` and ``high``: more than ``total`` steps lie above the first, no more than that above the second."""
    above = 0
    while below - above > close and high > low * (1 + 1e-9):
        ratio = (low / high) ** (1 / probes)
        gains = [high * ratio**i for i in range(1, probes)]
        counts = df.agg(*[F.sum(_steps_above(F.col("headroom"), F.lit(g), per_outlet, rules)).alias(f"c{i}") for i, g in enumerate(gains)])
        for gain, count in zip(gains, counts.first()):
            if count > total:
                low, below = gain, count
                break
            high, above = gain, count
    return low, high


def lift(headroom: Column, spend: Column, k: float = config.BUDGET.k) -> Column:
    """Volume gained by a spend."""
    return headroom * -F.expm1(-k * spend)


def allocate(inputs: DataFrame, rules: config.BudgetRules = config.BUDGET) -> DataFrame:
    """Inputs plus spend, expected gain and the part of the headroom it reaches."""
    df = inputs.join(greedy_steps(inputs, rules), "outlet_id", "left")
    df = df.withColumn("trade_spend_lkr", F.coalesce("steps", F.lit(0)) * F.lit(float(rules.step))).drop("steps")
    df = df.withColumn("expected_incremental_liters", lift(F.col("headroom"), F.col("trade_spend_lkr"), rules.k))
    return df.withColumn(
        "headroom_captured_frac",
        F.when(F.col("headroom") > 0, F.col("expected_incremental_liters") / F.col("headroom")).otherwise(0.0),
    )


def allocation_faults(df: DataFrame, rules: config.BudgetRules = config.BUDGET) -> DataFrame:
    """One row: total, outlets below 0, outlets off the step size."""
    spend = F.col("trade_spend_lkr")
    rest = (spend + 1e-6) % rules.step
    return df.agg(
        F.coalesce(F.sum(spend), F.lit(0.0)).alias("total_spend"),
        F.count_if(spend < -1e-9).alias("n_negative"),
        F.count_if(F.least(rest, rules.step - rest) > 1e-3).alias("n_off_step"),
    )


def require_valid(df: DataFrame, rules: config.BudgetRules = config.BUDGET) -> None:
    f = allocation_faults(df, rules).first()
    if f.total_spend > rules.total + 1e-6:
        raise ValueError(f"allocated {f.total_spend:.2f} of a budget of {rules.total:.2f}")
    if f.n_negative or f.n_off_step:
        raise ValueError(f"{f.n_negative} negative allocations, {f.n_off_step} not a multiple of the step")


def allocation_deliverable(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("outlet_id").alias("Outlet_ID"), F.bround("trade_spend_lkr", 2).alias("Trade_Spend_Allocation_LKR")
    )


def by_distributor(df: DataFrame) -> DataFrame:
    """Outlets, spend and gain per distributor; outlets without one are left out."""
    sums = df.where("distributor_id is not null").groupBy("distributor_id").agg(
        F.count("*").alias("outlets"),
        F.count_if(F.col("trade_spend_lkr") > 0).alias("outlets_funded"),
        F.sum("trade_spend_lkr").alias("spend_lkr"),
        F.sum("expected_incremental_liters").alias("incremental_liters"),
    )
    cost = S.ratio(F.col("spend_lkr"), F.col("incremental_liters"))
    return sums.withColumn("lkr_per_incremental_liter", F.bround(cost, 2))


def allocation_summary(df: DataFrame, rules: config.BudgetRules = config.BUDGET) -> DataFrame:
    """One row of totals."""
    funded = F.col("trade_spend_lkr") > 0
    median = quantiles.global_median(df, F.when(funded, F.col("trade_spend_lkr")))
    gained = F.sum("expected_incremental_liters")
    return df.agg(
        F.sum("trade_spend_lkr").alias("allocated_lkr"),
        F.count("*").alias("n_outlets_total"),
        F.count_if(funded).alias("n_outlets_funded"),
        F.bround(gained, 1).alias("total_incremental_liters"),
        F.bround(S.ratio(F.sum("trade_spend_lkr"), gained), 2).alias("blended_lkr_per_incremental_liter"),
        F.max("trade_spend_lkr").alias("max_spend_outlet"),
    ).select(
        F.lit(rules.province).alias("province"),
        F.lit(float(rules.total)).alias("budget_lkr"),
        "*",
        F.coalesce(median, F.lit(0.0)).alias("spend_p50_funded"),
    )
