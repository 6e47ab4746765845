"""Personal data: patterns, and terms that give protected values away."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight.llm.common import fold, if_small, let
from shelfsight.llm.decontamination import SEPARATORS, terms
from shelfsight.session import stage

# The patterns of the kinds, written so that no place of a text is tried from every character of a
# long run: a match starts where a run or the last match ends, and repeats give nothing back.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"


@dataclass(frozen=True)
class DisclosureRules:
    """When a term gives a protected value away."""

    share: float = 0.9  # of the information of the value that the term tells
    surprise: float = 1.0  # bits by which the shared documents must exceed what one document could show
    letters: int = 3  # of a term, at least


def spans_of(text: Column, pattern: str, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost matches that do not overlap, as (start, end, value) in characters; only those whose value is ``wanted``, if given.

    The pieces between the matches and the matches take turns, so their lengths
    add up to the positions.
    """
    def placed(both: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        begin = F.struct(F.lit(0).cast("int").alias("at"), empty.alias("out"))

        def step(s: Column, pair: Column) -> Column:
            start = s["at"] + F.length(pair["gap"])
            end = start + F.length(pair["hit"])
            row = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("value"))
            more = F.concat(s["out"], F.array(row))
            return F.struct(end.alias("at"), (F.when(wanted(pair["hit"]), more).otherwise(s["out"]) if wanted else more).alias("out"))

        pairs = F.transform(both["hits"], lambda hit, k: F.struct(F.get(both["gaps"], k).alias("gap"), hit.alias("hit")))
        return F.aggregate(pairs, begin, step, lambda s: s["out"])

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps")
    )
    return let(both, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(d: Column) -> Column:
        def step(s: Column, k: Column) -> Column:
            digit = F.substring(d, F.length(d) - k, F.lit(1)).cast("int")
            return s + F.when(k % 2 == 0, digit).when(digit < 5, 2 * digit).otherwise(2 * digit - 9)

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), step)

    return let(_digits(value), total) % 10 == 0


def _found(text: Column) -> Column:
    """All spans of the patterns, by kind and start."""
    size = lambda v: F.length(_digits(v))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    kinds = {
        "email": (text.contains("@"), _EMAIL, None),
        "ip": (text.rlike(r"[0-9]\.[0-9]"), _IP, lambda m: F.forall(
            F.split(m["value"], r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int") <= 255)
        )),
        "card": (text.rlike(r"[0-9][ -]?[0-9]"), _CARD, lambda m: size(m["value"]).between(13, 19) & _luhn(m["value"])),
        "phone": (text.contains("+"), _PHONE, lambda m: size(m["value"]).between(9, 15)),
    }

    def of(kind: str) -> Column:
        worth, pattern, valid = kinds[kind]
        spans = spans_of(text, pattern)
        spans = F.when(worth, F.filter(spans, valid) if valid else spans).otherwise(none)
        return F.transform(spans, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["end"], m["value"]))

    return F.concat(*map(of, KINDS))


def _value_key(kind: Column, value: Column) -> Column:
    """The protected value whatever its spelling."""
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), _digits(value)).otherwise(fold(value)))


def _words(text: Column, rules: DisclosureRules) -> Column:
    """The distinct words of a whole text that can be terms."""
    return F.filter(F.array_distinct(terms(text)), lambda w: (F.length(w) >= rules.letters) & w.rlike(r"\p{L}"))


def _weighed(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``_w``: rows that repeat an id with its text share the weight of one document; a null id has none."""
    if repeated is None:
        return rows.withColumn("_w", F.when(F.col("_id").isNotNull(), 1.0).otherwise(0.0))
    weight = F.when(F.col("_id").isNotNull(), 1.0 / F.coalesce("n_rows", F.lit(1))).otherwise(0.0)
    return rows.join(if_small(repeated), ["_id", "_key"], "left").withColumn("_w", weight)


def _n() -> Column:
    return F.round(F.sum("_w")).cast("long")


def _told(base: DataFrame, docs: DataFrame, rules: DisclosureRules) -> DataFrame | None:
    """(_key, _terms): the terms of a text that give one of its values away. None if no value can be judged."""
    ids = base.where("_id is not null").groupBy("_id", "_key").agg(F.count("*").alias("n_rows"))
    ids = stage(ids, "pii-ids")
    n_docs = ids.count()
    repeated = ids.where("n_rows > 1")
    repeated = None if repeated.isEmpty() else stage(repeated, "pii-repeated")

    held = _weighed(base.where("_entities is not null").select("_id", "_key", "_entities", "_words"), repeated)
    texts = held.groupBy("_key").agg(F.sum("_w").alias("_w"), F.first("_entities").alias("_entities"), F.first("_words").alias("_words"))
    texts = stage(texts, "pii-texts")
    values = texts.select("_key", "_w", F.explode("_entities").alias("entity"))
    # One document can never exceed what one document shows; a value of all documents has no information.
    entities = values.groupBy("entity").agg(_n().alias("n_entity")).where(F.col("n_entity").between(2, n_docs - 1))
    entities = stage(entities, "pii-entities")
    most = entities.agg(F.max("n_entity")).first()[0]
    if most is None:
        return None

    # From share and n_joint <= n_entity: no term of more documents can tell enough.
    def reach(n):
        return n * F.pow(n_docs / n, F.lit(1 - rules.share)) + 1e-6

    values = stage(values.join(if_small(entities), "entity"), "pii-values")
    judged = texts.join(if_small(stage(values.select("_key").distinct(), "pii-judged")), "_key", "left_semi")
    named = judged.select("_key", F.explode("_words").alias("term"))
    wanted = stage(named.select("term").distinct(), "pii-wanted")
    every = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    if repeated is not None:
        every = every.withColumn("_key", F.sha2("_text", 256))
    every = _weighed(every, repeated).where("_w > 0").select("_w", F.explode(_words(F.col("_text"), rules)).alias("term"))
    counts = every.groupBy("term").agg(_n().alias("n_term")).where((F.col("n_term") >= 2) & (F.col("n_term") <= reach(F.lit(most))))
    counts = if_small(stage(counts.join(wanted, "term"), "pii-terms"))

    pairs = named.join(counts, "term").join(values, "_key").where(F.col("n_term") <= reach(F.col("n_entity")))
    pairs = stage(pairs.select("_key", "_w", "entity", "n_entity", "term", "n_term"), "pii-pairs")
    joint = pairs.groupBy("entity", "n_entity", "term", "n_term").agg(_n().alias("n_joint"))
    information = F.log2(F.col("n_joint") * n_docs / (F.col("n_term") * F.col("n_entity")))
    told = joint.where(
        (information >= rules.share * F.log2(n_docs / F.col("n_entity")))
        & (F.col("n_joint") * information >= F.log2(F.lit(n_docs)) + rules.surprise)
    )
    told = if_small(stage(told.select("entity", "term"), "pii-told"))
    return stage(pairs.join(told, ["entity", "term"], "left_semi").groupBy("_key").agg(F.collect_set("term").alias("_terms")), "pii-added")


def _judged(docs: DataFrame, rules: DisclosureRules, columns: list[str]) -> DataFrame:
    """``columns`` of every row, with ``_spans`` and ``_added`` as ``find`` gives them, both made from the text of the row itself."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)), F.col("doc_id").alias("_id"), text.alias("_text"))
    base = base.withColumn("_found", let(F.col("_text"), _found)).withColumn("_key", F.sha2("_text", 256))
    held = F.size("_found") > 0
    entities = F.array_distinct(F.transform("_found", lambda m: _value_key(m["kind"], m["value"])))
    base = base.withColumn("_entities", F.when(held, entities)).withColumn("_words", F.when(held, _words(F.col("_text"), rules)))
    base = stage(base.withColumn("_text", F.when(held, F.col("_text"))), "pii-base")

    plain = F.transform("_found", lambda m: F.struct(m["kind"], m["start"], m["end"]))
    none = F.filter("_spans", lambda _: F.lit(False))
    named = [F.col(f"c{k}").alias(c) for k, c in enumerate(columns)]
    told = _told(base, docs, rules)
    rows = base.withColumn("_spans", plain)
    if told is None:
        return rows.select(*named, "_spans", none.alias("_added"))

    def standing(given: Column) -> Column:
        at = spans_of(fold(given["text"]), rf"[^{SEPARATORS}]++", lambda w: F.array_contains(given["terms"], w))
        return F.transform(at, lambda t: F.struct(F.lit(TERM).alias("kind"), t["start"], t["end"]))

    told = rows.where("_entities is not null").join(if_small(told), "_key", "left")
    at = F.when(F.size("_terms") > 0, let(F.struct(F.col("_text").alias("text"), F.col("_terms").alias("terms")), standing))
    free = F.filter(F.col("_at"), lambda t: ~F.exists("_spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    told = told.withColumn("_at", at).select(*named, "_spans", F.coalesce(free, none).alias("_added"))
    return rows.where("_entities is null").select(*named, "_spans", none.alias("_added")).unionByName(told)


def find(docs: DataFrame, rules: DisclosureRules = DisclosureRules()) -> DataFrame:
    """(doc_id, spans, added) of every row; a span is (kind, start, end), end exclusive, in characters.

    ``spans`` are the matches of the patterns: email, IP address, payment card
    (Luhn), phone. ``added`` are terms of a document that give one of its values
    away. How much a term t tells about a value v is taken from all documents,

        share = log2( P(t, v) / (P(t) P(v)) ) / log2( 1 / P(v) )

    with P as shares of documents; 1 means that t occurs with v only. Terms from
    ``share`` on are told if the documents they share with v are no accident:

        n(t, v) log2( P(t, v) / (P(t) P(v)) ) >= log2( n ) + surprise

    n documents in all. Two shared documents can be enough; one never is, as any
    word of a single document has log2(n) bits at most. A told term is added
    wherever it stands in a document with v, outside every span of a pattern.

    Words of the values count as words of the document. Terms are counted by
    combined aggregates; what the bounds rule out is left out before pairs of
    values and terms are made. A null text is empty. A document is an id with a
    text: repeated rows get the same spans each and count as one document, two
    texts under one id are two. A row with a null id is not counted; its
    patterns and the terms told by the others are found. Other columns are
    ignored; an empty table gives an empty result.
    """
    return _judged(docs, rules, ["doc_id"]).select("doc_id", F.col("_spans").alias("spans"), F.col("_added").alias("added"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def clean(docs: DataFrame, rules: DisclosureRules = DisclosureRules()) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, and ``n_chars`` counted anew where a text changes.

    Overlapping spans become one, named after the first. Rows without a span
    stay as they are. All columns of ``docs`` are kept, in their order.
    """
    every = F.transform(F.concat("_spans", "_added"), lambda m: F.struct(m["start"], m["end"], m["kind"]))
    out = _judged(docs, rules, docs.columns).withColumn("_all", F.sort_array(F.array_distinct(every)))

    def rebuilt(text: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(s: Column, m: Column) -> Column:
            new = F.concat(s["out"], F.substring(text, s["at"] + 1, m["start"] - s["at"]), F.lit("["), F.upper(m["kind"]), F.lit("]"))
            return F.struct(F.greatest(s["at"], m["end"]).alias("at"), F.when(m["start"] >= s["at"], new).otherwise(s["out"]).alias("out"))

        return F.aggregate("_all", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))

    changed = F.size("_all") > 0
    text = F.when(changed & F.col("text").isNotNull(), let(F.col("text"), rebuilt)).otherwise(F.col("text"))
    out = out.withColumn("_new", text)
    put = {"text": F.col("_new"), "n_chars": F.when(changed, F.length("_new").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(put[c].alias(c) if c in put else F.col(f"`{c}`") for c in docs.columns))
