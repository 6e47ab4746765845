"""Benchmark decontamination by a positional inverted index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfsight.llm.common import fold, if_small, let, words_of
from shelfsight.session import stage

#: Everything but ASCII letters (in lower case), digits and characters beyond ASCII.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: The same for texts as they are, with letters in either case.
SEPARATORS_ANY_CASE = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


@dataclass(frozen=True)
class PhraseRules:
    width: int = 10  # words of a window
    lists: int = 2  # postings lists that are intersected for a window, from its rarest term on
    slop: int = 0  # words by which a term may stand off its place and still be near


def terms(text: Column) -> Column:
    return words_of(fold(text), SEPARATORS)


def windows(items: DataFrame, width: int) -> DataFrame:
    """(window, item_id, place, phrase) of all windows; a shorter item that has words is one window. Equal windows of an item once."""
    return (
        items.select("item_id", terms(F.col("text")).alias("w"))
        .where(F.size("w") > 0)
        .select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))).alias("place"))
        .select("item_id", F.slice("w", F.col("place"), width).alias("phrase"))
        .distinct()
    )


def _placed(docs: DataFrame) -> DataFrame:
    """Every word of every text with its place."""
    return docs.select("doc_id", terms(F.col("text")).alias("w"))


def matches(docs: DataFrame, items: DataFrame, rules: PhraseRules = PhraseRules()) -> DataFrame:
    """(doc_id, item_id, start, size, exact): where a window of an item stands in a text, from word ``start`` (0 first).

    1. The terms of the windows are counted over all texts.
    2. Of each window the ``lists`` rarest terms are chosen.
    3. The postings of these terms are stored: term, text and place.
    4. For each window the lists of its chosen terms are intersected from the
       rarest on, each shifted by the offset of the term in the window.
    5. What is left is compared with the text, word by word. With ``slop``, a window is near (``exact`` false) if every term
       stands within that many words of its place.

    Nothing is left out: a window of frequent terms only is found through the
    least frequent of them. Counts combine before the shuffle, and joins with
    postings are equi-joins that AQE splits. Vocabularies are broadcast only
    if they are measured to be small. Null texts and ids: a null text has no words, a null
    id cannot be referred to and is left out here. Empty tables give no rows.
    """
    w, slop = rules.width, rules.slop
    phrases = stage(
        windows(items, w).groupBy("phrase").agg(F.sort_array(F.collect_set("item_id")).alias("items")).withColumn(
            "window", F.xxhash64("phrase", F.lit(1))
        ),
        "phrases",
    )
    vocabulary = stage(phrases.select(F.explode("phrase").alias("term")).distinct(), "vocabulary")
    counts = stage(
        _placed(docs).select(F.explode("w").alias("term")).join(if_small(vocabulary), "term").groupBy("term").count(), "counts"
    )

    # A window with a term that no text holds cannot occur exactly.
    spelled = phrases.select("window", F.size("phrase").alias("size"), F.posexplode("phrase").alias("offset", "term")).join(
        counts, "term"
    )
    by_rarity = Window.partitionBy("window").orderBy("count", "term", "offset")
    chosen = (
        spelled.withColumn("known", F.count("*").over(Window.partitionBy("window")))
        .withColumn("rank", F.row_number().over(by_rarity))
        .where((F.col("known") == F.col("size")) & (F.col("rank") <= rules.lists))
    )
    chosen = stage(chosen.select("window", "size", "offset", "term", "rank"), "chosen")

    wanted = stage(chosen.select("term").distinct(), "terms")
    index = stage(
        _placed(docs.where("doc_id is not null"))
        .select("doc_id", F.posexplode("w").alias("place", "term"))
        .join(if_small(wanted), "term")
        .select("term", "doc_id", "place"),
        "postings",
    )

    rarest = chosen.where("rank = 1").select("window", "term", "offset", "size")
    found = rarest.join(index, "term").select(
        "window", "doc_id", (F.col("place") - F.col("offset")).alias("start")
    )
    for rank in range(2, rules.lists + 1):
        here = chosen.where(F.col("rank") == rank).select("window", "term", "offset")
        at = found.join(here, "window", "left").withColumn("place", F.col("start") + F.col("offset"))
        spread = F.explode(F.sequence(F.col("place") - slop, F.col("place") + slop)) if slop else F.col("place")
        listed = index.select("term", "doc_id", spread.alias("place"))
        # Windows with fewer terms than lists stay as they are.
        found = at.where("term is null").select("window", "doc_id", "start").unionByName(
            at.where("term is not null").join(listed, ["term", "doc_id", "place"], "left_semi").select("window", "doc_id", "start")
        )
    found = found.where("start >= 0").groupBy("doc_id").agg(F.collect_set(F.struct("window", "start")).alias("at"))
    found = stage(found, "intersected")

    # The words at what is left: of each place, the words from ``slop`` before it to ``slop`` behind.
    held = if_small(stage(found.select("doc_id"), "intersected-docs"))
    texts = docs.select("doc_id", "text").join(held, "doc_id").join(found, "doc_id")
    wide = w + 2 * slop
    cut = lambda words: F.transform(
        "at",
        lambda x: F.struct(
            x["window"].alias("window"), x["start"].alias("start"),
            F.slice(words, F.greatest(x["start"] - slop, F.lit(0)) + 1, F.lit(wide)).alias("near"), F.least(x["start"], F.lit(slop)).alias("first"),
        ),
    )
    spread = texts.select("doc_id", F.explode(let(terms(F.col("text")), cut)).alias("x")).select("doc_id", "x.*")
    spread = spread.join(phrases, "window").withColumn("size", F.size("phrase"))
    exact = F.slice("near", F.col("first") + 1, F.col("size")) == F.col("phrase")
    low = lambda k: F.greatest(F.col("first") + k - slop, F.lit(0))
    reach = lambda k: F.slice(F.col("near"), low(k) + 1, F.col("first") + k + slop - low(k) + 1)
    nearly = F.forall(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.array_contains(reach(k), F.get(F.col("phrase"), k)))
    checked = spread.withColumn("exact", exact)
    checked = checked.where(F.col("exact") | nearly) if slop else checked.where("exact")
    return checked.select("doc_id", F.explode("items").alias("item_id"), "start", "size", "exact")


def contamination(docs: DataFrame, items: DataFrame, rules: PhraseRules = PhraseRules()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) of every row.

    A word inside any exact occurrence of a window is hit. A null or empty text
    has no words and is clean; a repeated row is judged each time; an id that
    two different texts share has the hits of both; a null id is clean. Other
    columns are ignored; an empty table of items makes every text clean.
    """
    hits = stage(matches(docs, items, rules).where("exact"), "phrase-hits")
    spans = hits.groupBy("doc_id", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    before = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    covered = spans.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("n_hit"))
    named = hits.groupBy("doc_id").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = covered.join(named, "doc_id")
    # Cut at separators: a pattern of the words themselves, matched one by one, takes ten times as long.
    sized = docs.select("doc_id", F.size(words_of(F.col("text"), SEPARATORS_ANY_CASE)).cast("long").alias("n_words"))
    items_ = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    return (
        sized.join(found, "doc_id", "left")
        .withColumn("items", items_)
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "items",
        )
    )
