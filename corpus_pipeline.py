"""A training corpus in five stages, each over all that the one before kept.

``run`` writes each result to the shared folder as Parquet and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfsight.llm import decontamination, language, neardup, packing, pii
from shelfsight.llm.common import if_small, table, tune
from shelfsight.llm.queries import TOKENIZER
from shelfsight.session import stage

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*DOCUMENTS)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear lead. ``lang`` stays as given."""
    tune(spark)
    found = language.identify(docs, language.learn(docs), carry=DOCUMENTS[1:])
    return _rows(found.where("accepted"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: of the document with the smallest id, and of its rows the first in order. Rows without an id stay."""
    tune(spark)
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    # Ids that several rows have are few as a rule; only their rows are put together.
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = if_small(stage(repeated, "pipeline-repeated"))
    first = left.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*DOCUMENTS[1:])).alias("row"))
    return _rows(left.join(repeated, "doc_id", "left_anti")).unionByName(first.select("doc_id", "row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    tune(spark)
    found = decontamination.matches(docs, table(spark, sf_dir, "benchmark")).where("exact").select("doc_id").distinct()
    return _rows(docs.join(found, "doc_id", "left_anti"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, replaced by their kind."""
    tune(spark)
    return _rows(pii.clean(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    tune(spark)
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", sanitised),
    ("packing", packed),
]

#: The compressor, the tokenizer and the positions of backtracking patterns are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _rows(table(spark, sf_dir, "documents"))
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
