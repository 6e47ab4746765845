"""The queries of this package, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsight.llm import (
    chat, decontamination, html, infill, language, linefield, neardup, packing, periodic, pii, quality, tokens, urls,
)
from shelfsight.llm.common import table
from shelfsight.llm.sql import ORACLES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
URL_RULES = (
    urls.UrlRule("allow", "org", "/"),
    urls.UrlRule("block", "example.org", "/es/"),
    urls.UrlRule("block", "example.org", "/en/1"),
    urls.UrlRule("allow", "com", "/fr/"),
    urls.UrlRule("block", "com", "/de/"),
)
REPLY_SCHEMA = (
    '{"additionalProperties":false,"properties":{"query":{"minLength":1,"type":"string"},'
    '"turn":{"minimum":0,"type":"integer"}},"required":["query","turn"],"type":"object"}'
)


def op1_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents"), TOKENIZER)


def op2_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    found = quality.quality(table(spark, directory, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed", ",").alias("failed"),
    )


def op3_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    judged = urls.judge(table(spark, directory, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "inherited")


def op4_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, directory, "documents"))


def op5_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    fold = language.fold_of(F.col("doc_id"))
    known = language.learn(docs.where(fold != 1))
    found = language.identify(docs, known)
    return found.select("doc_id", (language.fold_of(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score", "accepted")


def op6_html_extraction(spark: SparkSession, directory: str) -> DataFrame:
    return html.main_text(table(spark, directory, "pages"))


def op7_pii(spark: SparkSession, directory: str) -> DataFrame:
    found = pii.find(table(spark, directory, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.digest(F.col("spans")), 256).alias("base_sha256"),
        pii.digest(F.concat("spans", "added")).alias("spans"), F.size("added").cast("long").alias("n_term"),
    )


def op8_tool_calls(spark: SparkSession, directory: str) -> DataFrame:
    """A user's turn is a call of the assistant, the turn after it the result; a call needs the one before it."""
    said = table(spark, directory, "conversations")
    name = lambda turn: F.concat(F.lit("c"), turn.cast("string"))
    turn = F.col("turn")
    calls = said.where("role = 'user'").select(
        "conv_id", name(turn).alias("call_id"), "turn", F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("query"), turn.alias("turn"))).alias("arguments"),
        F.when(turn >= 2, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
    results = said.where("role = 'assistant'").select(
        "conv_id", name(turn - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    schemas = spark.range(1).select(F.lit("reply").alias("name"), F.lit(REPLY_SCHEMA).alias("schema"))
    linked = chat.link_tool_calls(calls, results, schemas)
    return linked.withColumn("errors", F.array_join("errors", ";")).withColumn("rank_step", F.col("rank_step").cast("long"))


def op9_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs, items = table(spark, directory, "documents"), table(spark, directory, "benchmark")
    return decontamination.contamination(docs, items).drop("items")


def op10_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    counted = tokens.token_counts(table(spark, directory, "documents"), TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    seed = F.crc32(F.col("doc_id").cast("string"))
    return periodic.periodic_runs(table(spark, directory, "documents"), seed=seed).drop("runs", "collapsed")


def op12_fill_in_middle(spark: SparkSession, directory: str) -> DataFrame:
    return infill.infill(table(spark, directory, "documents")).drop("output")


def op13_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = table(spark, directory, "documents"), table(spark, directory, "labels")
    held_out = F.coalesce(linefield.fold_of(F.col("doc_id")) == 2, F.lit(False))
    field = linefield.learn(docs, labels.where(~held_out))
    return linefield.quality(docs, field).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_quality_rules, op3_url_filters, op4_near_duplicates, op5_language,
        op6_html_extraction, op7_pii, op8_tool_calls, op9_decontamination, op10_token_counts,
        op11_periodic_runs, op12_fill_in_middle, op13_quality_classifier,
    )
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(ORACLES)
