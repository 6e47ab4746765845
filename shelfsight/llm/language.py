"""Language identification by compression."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageRules:
    """``documents`` x ``characters`` of text of a language make its dictionary, at most: the bound of the sample."""

    documents: int = 200
    characters: int = 2000
    dictionary: int = 110 << 10  # bytes
    block: int = 16 << 10  # bytes compressed at a time, so that a long text does not become its own dictionary
    level: int = 6
    margin: float = 0.004  # of the second smallest size; a narrower lead is rejected


_OTHER = re.compile(r"[^\w]+|[\d_]+")


def letters_of(text: str | None) -> bytes:
    """The text as lower-case words with one space between: case, digits and signs say nothing about a language."""
    return _OTHER.sub(" ", (text or "").lower()).strip().encode()


def learn(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> dict[str, bytes]:
    """A raw-content dictionary per value of ``lang``, from a bounded sample of the rows with text and language.

    The rows are counted per language, and as many are drawn, by a hash of
    their text, as the bound asks for; at most twice the bound comes to the
    driver. Frequent words, which the dictionary should hold near its end,
    come with any sample.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text")
    order = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)
    counts = known.groupBy("lang").count().collect()  # one row per language
    share = F.coalesce(*(F.when(F.col("lang") == r["lang"], F.lit(rules.documents / r["count"])) for r in counts), F.lit(0.0))
    drawn = known.where(order < share).select("lang", F.substring("text", 1, rules.characters).alias("text"), order.alias("order"))
    rows = drawn.dropDuplicates(["lang", "text"]).orderBy("order", "lang", "text").limit(2 * rules.documents * max(1, len(counts))).collect()
    out: dict[str, list[bytes]] = {r["lang"]: [] for r in counts}
    for r in rows:
        out[r["lang"]].append(letters_of(r["text"]))
    return {lang: b" ".join(parts)[-rules.dictionary :] for lang, parts in sorted(out.items())}


class Sizes:
    """Compressed sizes of texts by language."""

    def __init__(self, dictionaries: dict[str, bytes], rules: LanguageRules):
        self.block, self.languages = rules.block, list(dictionaries)
        self.by_language = []
        for content in dictionaries.values():
            # An empty dictionary is none.
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
            if data:
                data.precompute_compress(level=rules.level)
            self.by_language.append(
                zstandard.ZstdCompressor(level=rules.level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def of(self, data: bytes) -> list[int]:
        blocks = [data[at : at + self.block] for at in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.by_language]


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], rules: LanguageRules = LanguageRules(), carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, the columns of ``carry``, lang_pred, score, accepted) of every row, from the text alone.

    The whole text is compressed with the dictionary of each language; the
    smallest size wins, among equal ones the first language by name. ``score``
    is the lead over the second smallest, as a share of that (1 if there is no
    second language). ``accepted`` is false where the lead is under ``margin``,
    for ``und`` and without any language.

    A null text, and one without a letter, is ``und`` with score 0. Repeated
    rows are each answered, null ids stay, other columns are
    ignored; an empty table gives an empty result.
    """
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(dictionaries, rules)
        for frame in frames:
            rows = []
            for text in frame.column("text").to_pylist():
                if not sizes.languages or not any(map(str.isalpha, text or "")):
                    rows.append((UNKNOWN, 0.0, False))
                    continue
                each = sizes.of(letters_of(text))
                first, *second = sorted(each)
                lead = (second[0] - first) / second[0] if second else 1.0
                rows.append((sizes.languages[each.index(first)], lead, lead >= rules.margin))
            answer = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(frame.column(c) for c in own), *answer], [*own, "lang_pred", "score", "accepted"])

    own = ["doc_id", *carry]
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in own) + ", lang_pred string, score double, accepted boolean"
    return docs.select(*dict.fromkeys([*own, "text"])).mapInArrow(run, schema)


def fold_of(doc_id: Column, folds: int = 3) -> Column:
    """The fold of a document by a checksum of its id; fold 1 is held out."""
    return F.crc32(doc_id.cast("string")) % folds
