"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight.llm.common import SPACE, fold, let, words_of

#: Frequent words of running text by language (fixed values).
STOP_WORDS = {
    "en": "the of and to in a is that it for on was with as be by this are from or an at not have which he his but",
    "fr": "le la les de des du et en un une est que qui dans pour pas sur au avec ce il ne se par plus ou son",
    "de": "der die das und in den von zu mit sich auf ist im dem nicht ein eine als auch es an für aus bei nach",
    "es": "el la los las de del y en que un una se por con para no es al lo su como más o este sus pero",
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Threshold:
    """A document passes if the measure lies in [least, most]; None is open."""

    measure: str
    least: float | None = None
    most: float | None = None


#: Production thresholds.
RULES = (
    Threshold("n_words", least=10),
    Threshold("mean_word_length", least=2.0, most=15.0),
    Threshold("symbol_ratio", most=0.1),
    Threshold("stop_word_ratio", least=0.04),
    Threshold("duplicate_line_ratio", most=0.5),
    Threshold("shout_ratio", most=0.3),
)
WINDOW = 5


def _repeated(words: Column, width: int) -> Column:
    """Words inside a window of ``width`` words that the text holds twice or more."""

    def covered(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["hash"] == x["hash"], F.lit(False))
        twice = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
        places = F.sort_array(F.transform(twice, lambda x: x["place"]))
        start = F.struct(F.lit(0).alias("total"), F.lit(-width).alias("last"))
        step = lambda s, p: F.struct(
            (s["total"] + F.least(F.lit(width), p - s["last"])).alias("total"), p.alias("last")
        )
        return F.aggregate(places, start, step, lambda s: s["total"])

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda k: F.struct(F.xxhash64(F.slice(words, k + 1, width)).alias("hash"), k.alias("place")),
    )
    return F.when(F.size(words) > width, let(F.sort_array(hashes), covered)).otherwise(F.lit(0))


def _measures(text: Column, words: Column) -> dict[str, Column]:
    """Counts of one text. ``words`` must be a variable of a lambda: it is read many times."""
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    long = lambda c: c.cast("long")
    return {
        "n_words": long(F.size(words)),
        "word_chars": long(F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))),
        "n_symbols": long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_lines": long(F.size(lines)),
        "n_dup_lines": let(lines, lambda x: long(F.size(x) - F.size(F.array_distinct(x)))),
        "n_repeat_words": long(_repeated(words, WINDOW)),
        "n_stop_words": long(F.size(F.filter(words, lambda w: fold(w).isin(stops)))),
        "n_capitals": long(F.length(F.regexp_replace(text, r"\P{Lu}+", ""))),
        "n_letters": long(F.length(F.regexp_replace(text, r"\P{L}+", ""))),
    }


def quality(docs: DataFrame, rules: Sequence[Threshold] = RULES, carry: Sequence[str] = ()) -> DataFrame:
    """Counts, ratios and verdict of every row: one projection, no shuffle, no user function.

    Words are runs of characters other than ASCII white space. Ratios: mean
    word length, symbols per word, stop words per word, lines that repeat an
    earlier one per line, capitals per letter; each is 0 if its divisor is.
    ``base_failed``: fewer than 10 words, or more than 20 % of them in repeated
    windows of 5 words. ``failed``: the measures out of bounds, in table order.
    ``kept``: neither.

    A null text counts as empty and fails. Rows, ids and columns are taken as
    they come (repeated rows each get a verdict, null ids stay); only doc_id,
    text and the columns named in ``carry`` are read. An empty table gives an
    empty result.
    """
    text = F.coalesce("text", F.lit(""))
    counted = docs.select(
        "doc_id",
        *carry,
        let(words_of(text, SPACE), lambda w: F.struct(*(c.alias(n) for n, c in _measures(text, w).items()))).alias("_m"),
    ).select("doc_id", *carry, "_m.*")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    counted = counted.withColumns({
        "mean_word_length": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "stop_word_ratio": share("n_stop_words", "n_words"),
        "duplicate_line_ratio": share("n_dup_lines", "n_lines"),
        "shout_ratio": share("n_capitals", "n_letters"),
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    })
    out_of = []
    for rule in rules:
        value, outside = F.col(rule.measure), F.lit(False)
        if rule.least is not None:
            outside = outside | (value < rule.least)
        if rule.most is not None:
            outside = outside | (value > rule.most)
        out_of.append(F.when(outside, F.lit(rule.measure)))
    failed = F.array_compact(F.array(*out_of)) if out_of else F.array().cast("array<string>")
    return counted.withColumn("failed", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
