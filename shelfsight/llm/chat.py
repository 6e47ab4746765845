"""Tool calls of conversations: linked to their results, ordered, validated, in canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfsight.session import stage

#: Types of a schema and what stands for them (fixed values).
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, characters as they are. Numbers without a finite value are an error."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _TYPES.get(kind, ()))


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with arguments by a schema: type, enum, const, required, properties, items and bounds."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    out = []
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        out.append(f"{at}: value")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    elif isinstance(value, list) and isinstance(schema.get("items"), dict):
        out += [p for k, x in enumerate(value) for p in problems(x, schema["items"], f"{at}[{k}]")]
    size = value if _is(value, "number") else len(value) if isinstance(value, (str, list)) else None
    names = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems")}.get(type(value), ("minimum", "maximum"))
    if size is not None and (size < schema.get(names[0], size) or size > schema.get(names[1], size)):
        out.append(f"{at}: bounds")
    return out


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, rank_turn, rank_step, cyclic): where a call stands after all that it needs.

    ``calls`` has conv_id, call_id, turn and needs (ids in the conversation). A
    call stands at its turn, or one step behind the last of what it needs if
    that stands later. Order by (rank_turn, rank_step, call_id) is topological.
    Most calls need earlier ones and are settled at once; the others move until
    nothing moves, a round per link that points forward in time. Calls on a
    cycle, or that need one on a cycle, would move for ever: they are those that
    have taken as many steps as their conversation has calls, and have no order.
    """
    edges = calls.select("conv_id", "call_id", F.explode("needs").alias("need")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("need"))
    edges = stage(edges.join(known, ["conv_id", "need"]), "needs")
    size = stage(calls.groupBy("conv_id").agg(F.count("*").alias("n_calls")), "conversations")
    ranks = stage(
        calls.select("conv_id", "call_id", F.struct(F.col("turn").alias("turn"), F.lit(0).alias("step")).alias("rank"), F.lit(False).alias("moved")),
        "ranks",
    )
    while True:
        needed = ranks.select("conv_id", F.col("call_id").alias("need"), F.col("rank").alias("other"))
        least = (
            edges.join(needed, ["conv_id", "need"]).groupBy("conv_id", "call_id").agg(F.max("other").alias("other"))
        )
        behind = F.struct(F.col("other.turn").alias("turn"), (F.col("other.step") + 1).alias("step"))
        move = (F.col("rank") <= F.col("other")) & (F.col("other.step") <= 2 * F.col("n_calls"))
        ranks = stage(
            ranks.drop("moved").join(least, ["conv_id", "call_id"], "left").join(size, "conv_id")
            .withColumn("moved", F.coalesce(move, F.lit(False)))
            .select("conv_id", "call_id", F.when(F.col("moved"), behind).otherwise(F.col("rank")).alias("rank"), "moved"),
            "ranks",
        )
        if ranks.where("moved").isEmpty():
            break
    out = ranks.join(size, "conv_id").withColumn("cyclic", F.col("rank.step") >= F.col("n_calls"))
    return out.select("conv_id", "call_id", F.col("rank.turn").alias("rank_turn"), F.col("rank.step").alias("rank_step"), "cyclic")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, status, rank_turn, rank_step, errors, record): a row per call, and per result without a call.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON), needs (array of
    call ids). ``results``: conv_id, call_id, turn, content. ``schemas``: name,
    schema (JSON). Calls and results meet in a hash join on (conv_id, call_id).
    Status: ``linked``, ``unanswered``, ``orphan`` (a result without call),
    ``early`` (a result before its call) or ``cyclic``. ``errors`` lists what is
    wrong with the arguments by the schema of the tool (``$: json`` if they are
    no JSON, ``$: tool`` if the tool has no schema), then the needs that no call
    answers to. ``record`` is the call with its result as canonical JSON.

    Of calls with the same identifier the first by turn, name and arguments
    counts, of results the first by turn and content. Rows without conv_id or
    identifier are left out, as nothing can refer to them; a null turn stands
    before all, null arguments are ``{}``, null contents null. Other columns
    are ignored; empty tables give no rows. No conversation is gathered in one
    place: order comes as a rank.
    """
    given = "conv_id is not null and call_id is not null"
    first = lambda *c: F.min(F.struct(*c)).alias("x")
    needs = F.sort_array(F.array_distinct(F.array_compact(F.coalesce("needs", F.array().cast("array<string>"))))).alias("needs")
    calls = calls.where(given).select("conv_id", "call_id", F.coalesce("turn", F.lit(-1)).alias("turn"), "name", F.coalesce("arguments", F.lit("{}")).alias("arguments"), needs)
    calls = stage(calls.groupBy("conv_id", "call_id").agg(first("turn", "name", "arguments", "needs")).select("conv_id", "call_id", "x.*"), "calls")
    results = results.where(given).select("conv_id", "call_id", F.coalesce("turn", F.lit(-1)).alias("result_turn"), "content")
    results = results.groupBy("conv_id", "call_id").agg(first("result_turn", "content")).select("conv_id", "call_id", "x.*")
    schemas = schemas.where("name is not null").groupBy("name").agg(F.min("schema").alias("schema"))
    known = calls.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("there"))
    lost = (
        calls.select("conv_id", "call_id", F.explode("needs").alias("need")).join(known, ["conv_id", "need"], "left")
        .where("there is null").groupBy("conv_id", "call_id").agg(F.sort_array(F.collect_set("need")).alias("lost"))
    )
    both = (
        calls.withColumn("called", F.lit(True)).join(results, ["conv_id", "call_id"], "full")
        .join(schemas, "name", "left").join(ordered(calls), ["conv_id", "call_id"], "left").join(lost, ["conv_id", "call_id"], "left")
    )
    status = (
        F.when(F.col("called").isNull(), "orphan").when(F.col("cyclic"), "cyclic").when(F.col("result_turn").isNull(), "unanswered")
        .when(F.col("result_turn") < F.col("turn"), "early").otherwise("linked")
    )
    both = both.select(
        "conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), status.alias("status"), "name", "arguments", "needs", "lost",
        F.col("schema"), "content", F.coalesce("rank_turn", "result_turn").alias("rank_turn"), F.coalesce("rank_step", F.lit(0)).alias("rank_step"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors, records = [], []
            for r in frame.itertuples(index=False):
                wrong, arguments = [], None
                if r.status != "orphan":
                    try:
                        arguments = json.loads(r.arguments)
                        canonical(arguments)
                    except ValueError:
                        wrong, arguments = ["$: json"], r.arguments
                    else:
                        wrong = problems(arguments, json.loads(r.schema)) if r.schema else ["$: tool"]
                    wrong += [f"needs {x}" for x in (r.lost if r.lost is not None else ())]
                record = {"id": r.call_id, "name": r.name, "arguments": arguments, "result": r.content, "status": r.status}
                record["needs"] = list(r.needs) if r.needs is not None else []
                errors.append(wrong)
                records.append(canonical(record))
            keep = frame[["conv_id", "call_id", "turn", "status", "rank_turn", "rank_step"]]
            yield keep.assign(errors=errors, record=records)

    return both.mapInPandas(
        run, "conv_id long, call_id string, turn long, status string, rank_turn long, rank_step int, errors array<string>, record string"
    )
