"""Running a list of checks as one plan."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight.operators.checks import FAILED_STEP, REASON, Step, find_check, is_row_local, tag_reason
from shelfsight.operators import checks
from shelfsight.sources.files import union_by_name

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class CheckSpec:
    name: str
    params: dict[str, Any] = field(default_factory=dict)

    def describe(self) -> str:
        shown = {k: v for k, v in self.params.items() if not isinstance(v, (DataFrame, Column))}
        return json.dumps(shown, default=list, sort_keys=True)


@dataclass
class CheckResult:
    """The tagged frame and the three views of it.

    ``tagged`` holds every input row once, with the number of the first check it
    failed and the reason. A caller that needs more than one of the views should
    write ``tagged`` and build the result over the written table (``over``).
    """

    dataset: str
    steps: list[CheckSpec]
    tagged: DataFrame

    def over(self, tagged: DataFrame) -> CheckResult:
        return CheckResult(self.dataset, self.steps, tagged)

    @property
    def passing(self) -> DataFrame:
        return self.tagged.where(F.col(FAILED_STEP).isNull()).drop(FAILED_STEP, REASON)

    @property
    def rejected(self) -> DataFrame:
        names = F.array(*[F.lit(s.name) for s in self.steps]) if self.steps else F.array(F.lit(""))
        return (
            self.tagged.where(F.col(FAILED_STEP).isNotNull())
            .withColumn("_check", F.element_at(names, F.col(FAILED_STEP) + 1))
            .withColumn("_dataset", F.lit(self.dataset))
            .drop(FAILED_STEP)
        )

    @cached_property
    def summary(self) -> DataFrame:
        """One row per step, from one aggregate over the step numbers."""
        steps = self.steps
        failed = [F.count_if(F.col(FAILED_STEP) == i) for i in range(len(steps))]
        totals = self.tagged.agg(F.count("*").alias("_total"), F.array(*failed).cast("array<bigint>").alias("_failed"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).alias("step"),
                    F.lit(self.dataset).alias("dataset"),
                    F.lit(s.name).alias("check"),
                    F.lit(s.describe()).alias("params"),
                )
                for i, s in enumerate(steps)
            ]
        )
        earlier = F.aggregate(F.slice("_failed", 1, F.col("step")), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return totals.select("_total", "_failed", F.inline(rows)).select(
            "step",
            "dataset",
            "check",
            "params",
            (F.col("_total") - earlier).alias("rows_before"),
            F.col("_failed")[F.col("step")].alias("rows_rejected"),
            (F.col("_total") - earlier - F.col("_failed")[F.col("step")]).alias("rows_after"),
        )


def _mark(df: DataFrame, found: Sequence[tuple[int, Column]]) -> DataFrame:
    """Note the first of these steps that a row fails, if it has not failed before.

    The earlier verdict is used once in the new one, so a filter on the final
    verdict can be pushed to the scan without growing on the way.
    """
    if not found:
        return df
    first = None
    for number, bad in found:
        first = F.when(bad, F.lit(number)) if first is None else first.when(bad, F.lit(number))
    return df.withColumn(FAILED_STEP, F.coalesce(F.col(FAILED_STEP), first))


def _rewrite(step: Step, before: Sequence[str], live: Column) -> DataFrame:
    """The step's frame with its new values in rows that have passed so far."""
    if not step.updates:
        return step.frame
    out = [
        F.when(live, step.updates[n]).otherwise(F.col(n)).alias(n) if n in step.updates else F.col(n)
        for n in step.frame.columns
    ]
    out += [F.when(live, c).alias(n) for n, c in step.updates.items() if n not in before]
    return step.frame.select(*out)


def run_checks(df: DataFrame, dataset: str, specs: Sequence[CheckSpec]) -> CheckResult:
    """Apply the checks in order; each sees only rows that passed the earlier ones."""
    known = []
    for spec in specs:
        if find_check(spec.name) is None:
            logger.warning("unknown check %r on dataset %r", spec.name, dataset)
        else:
            known.append(spec)
    given = F.col(REASON).cast("string") if REASON in df.columns else F.lit(None).cast("string")
    columns = [c for c in df.columns if c != REASON]
    tagged = df.withColumns({FAILED_STEP: F.lit(None).cast("int"), REASON: given})
    live = F.col(FAILED_STEP).isNull()
    reasons, open_steps = [], []
    for number, spec in enumerate(known):
        if not is_row_local(spec.name):
            tagged, open_steps = _mark(tagged, open_steps), []
        step = find_check(spec.name)(tagged, live, **spec.params)
        reasons.append(step.reason if step.replace_reason else tag_reason(F.col(REASON), step.reason))
        if is_row_local(spec.name):
            open_steps.append((number, step.bad))
            continue
        before = tagged.columns
        tagged = _mark(_rewrite(step, before, live), [(number, step.bad)]).drop(*step.helpers)
        columns += [c for c in step.updates if c not in columns]
    tagged = _mark(tagged, open_steps)
    # A rejected row keeps the values it was rejected with, so its reason can be worded last.
    worded = None
    for number, reason in enumerate(reasons):
        failed_here = F.col(FAILED_STEP) == number
        worded = F.when(failed_here, reason) if worded is None else worded.when(failed_here, reason)
    tagged = tagged.select(*columns, FAILED_STEP, (F.col(REASON) if worded is None else worded).alias(REASON))
    return CheckResult(dataset, known, tagged)


def run_check(df: DataFrame, name: str, **params: Any) -> tuple[DataFrame, DataFrame]:
    """One check by itself: (passing, rejected with ``failure_reason``)."""
    if find_check(name) is None:
        raise KeyError(f"no check named {name!r}; there are {checks.available_checks()}")
    result = run_checks(df, "", [CheckSpec(name, params)])
    return result.passing, result.rejected.drop("_check", "_dataset")


def union_rejects(frames: Sequence[DataFrame]) -> DataFrame:
    """All rejected rows in one frame; columns a frame lacks are NULL. See :func:`union_by_name`."""
    return union_by_name(frames)


def fit_to_columns(specs: Sequence[CheckSpec], columns: Sequence[str]) -> list[CheckSpec]:
    """Leave out the checks whose columns the table does not have."""
    have = set(columns)
    kept = []
    for spec in specs:
        column = spec.params.get("col")
        several = spec.params.get("mandatory_cols") or spec.params.get("keys") or spec.params.get("group_keys")
        if (column and column not in have) or (several and not have & set(several)):
            logger.info("leaving out %s: columns not present", spec.name)
            continue
        kept.append(spec)
    return kept
