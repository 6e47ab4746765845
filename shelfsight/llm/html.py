"""Main text of web pages: a page against its neighbour on the same host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfsight.llm.urls import host_of, path_of
from shelfsight.session import stage

#: Elements without text of the article.
DROPPED = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea iframe object svg math canvas audio video dialog menu".split()
)
#: Words of a class, id or role that mark such an element.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|sidebar|menu|nav|navbar|navigation|breadcrumbs?"
    r"|footer|header|masthead|comments?|replies|disqus|share|social|related|newsletter|subscribe|pagination|contentinfo|complementary|search)(?:$|[\s_-])",
    re.I,
)
#: Elements that do not end a block of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
_PART = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = frozenset(("script", "style", "textarea", "title"))


@dataclass
class Line:
    text: str
    marked: bool  # in an element that holds no text of the article
    main: bool  # in an element that the page calls its main part


def lines(html: str | None) -> list[Line]:
    """The blocks of text of a page, in order, white space made one space."""
    html = html or ""
    out: list[Line] = []
    text: list[str] = []
    open_: list[tuple[str, bool, bool]] = []  # name, marked, main, from the outside in
    state = (False, False)

    def end() -> None:
        whole = " ".join(entities.unescape("".join(text)).split())
        if whole:
            out.append(Line(whole, *state))
        text.clear()

    at = 0
    while part := _PART.match(html, at):
        at = part.end()
        close, name, rest = part.groups()
        if not name:
            if not part[0].startswith(("<!", "<?")):
                text.append(part[0])
            continue
        name = name.lower()
        if name in INLINE:
            continue
        end()
        if close:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    del open_[k:]
                    break
        elif name not in VOID and not rest.endswith("/"):
            named = " ".join(x or y or z for x, y, z in _ATTRIBUTE.findall(rest))
            bad = name in DROPPED and not (name == "header" and state[1]) or bool(MARKED.search(named)) and name not in MAIN and name != "body"
            if name == "p" and open_ and open_[-1][0] == "p":
                open_.pop()
            above = open_[-1][1:] if open_ else (False, False)
            open_.append((name, above[0] or bad, above[1] or name in MAIN))
            if name in _RAW:  # no markup inside
                stop = re.compile(rf"</{name}\b", re.I).search(html, at)
                text.append(html[at : stop.start() if stop else len(html)])
                at = stop.start() if stop else len(html)
        state = open_[-1][1:] if open_ else (False, False)
    end()
    return out


def _profile(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of every prefix of ``a`` with ``b``, by words of bits."""
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.r_[0, np.cumsum(1 - bits.astype(int))]


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places of ``a`` in a longest common subsequence with ``b``. Halves ``b`` at each step, so memory is linear."""
    lo, out = 0, []
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        out.append(lo)
        lo += 1
    cut = 0
    while cut < min(len(a), len(b)) - lo and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    tail = range(len(a) - cut, len(a))
    inner, other = a[lo : len(a) - cut], b[lo : len(b) - cut]
    if inner and len(other) == 1:
        out += [lo + inner.index(other[0])] if other[0] in inner else []
    elif inner and other:
        mid = len(other) // 2
        split = int(np.argmax(_profile(inner, other[:mid]) + _profile(inner[::-1], other[mid:][::-1])[::-1]))
        out += [lo + k for k in shared(inner[:split], other[:mid])]
        out += [lo + split + k for k in shared(inner[split:], other[mid:])]
    return out + list(tail)


def _hashes(found: list[Line]) -> np.ndarray:
    return pd.util.hash_array(np.array([x.text for x in found], object), categorize=False).view(np.int64) if found else np.empty(0, np.int64)


def article(found: list[Line], neighbour: list[int]) -> str:
    """Text of a page: without marked lines, and without those it shares with its neighbour, in order.

    Lines of the element a page itself calls its main part stay, as an article
    that a site shows twice is still one; where a page names such an element,
    what is outside is no part of the article. A neighbour that has all lines of
    the page is a copy and deletes nothing.
    """
    common = set(shared(_hashes(found).tolist(), neighbour))
    if len(common) == len(found):  # a copy tells nothing
        common = set()
    named = any(x.main and not x.marked for x in found)
    return " ".join(x.text for k, x in enumerate(found) if not x.marked and (x.main if named else k not in common))


def neighbours(pages: DataFrame) -> DataFrame:
    """(row, host, path, partner): for each page of a host the one before it by path, for the first the one after it.

    Pages are ranged by host, path and row, so a host of any size lies in many
    partitions. Each finds the page before it inside its partition; the first
    of a host in a partition takes the last of that host in the partitions
    before, of which there is one row per host and partition.
    """
    ranged = pages.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ranged = ranged.repartitionByRange("host", "path", "row").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    inside = Window.partitionBy("part", "host").orderBy("path", "row")
    ranged = ranged.withColumns({"before": F.lag("row").over(inside), "after": F.lead("row").over(inside)})
    ends = ranged.groupBy("part", "host").agg(
        F.min_by("row", F.struct("path", "row")).alias("first"), F.max_by("row", F.struct("path", "row")).alias("last")
    )
    by_part = Window.partitionBy("host").orderBy("part")
    ends = ends.withColumns({"earlier": F.lag("last").over(by_part), "later": F.lead("first").over(by_part)})
    joined = ranged.join(ends.select("part", "host", "earlier", "later"), ["part", "host"])
    return joined.select("row", "host", F.coalesce("before", "earlier", "after", "later").alias("partner"))


def main_text(pages: DataFrame, carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """(page_id, the columns of ``carry``, text, n_chars, neighbour) of every row.

    A page is read as lines of text, one per block. It is paired with the page
    nearest to it by path on the same host, the lines of the two are aligned by
    a longest common subsequence, and the shared ones are deleted
    (:func:`article`). Menus, headers, footers, forms, adverts, notices,
    comments, scripts and styles go by their markup, also where a neighbour
    differs. What is left is joined by single spaces.

    Lines travel to the neighbour as hashes, the page itself moves once. A null
    or empty page has an empty text; a page without an address, or alone on its
    host, has no neighbour. Rows with one page_id are pages of their own, and
    each is paired. Null ids stay; other columns are ignored; an empty table
    gives an empty result.
    """
    own = pages.select("page_id", *carry, "html", "url") if "url" not in carry else pages.select("page_id", *carry, "html")
    key = F.xxhash64("page_id", "url", F.coalesce("html", F.lit("")))
    own = own.withColumn("row", key)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"row": frame["row"], "lines": [_hashes(lines(h)).tolist() for h in frame["html"]]})

    pairs = neighbours(own.select("row", "url").dropDuplicates(["row"])).where("host <> '' and partner is not null")
    known = own.select("row", "html").mapInPandas(read, "row long, lines array<long>").dropDuplicates(["row"])
    pairs = pairs.select("row", "partner").join(known.withColumnRenamed("row", "partner"), "partner")
    given = own.join(pairs.select("row", "lines"), "row", "left")

    def extract(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ["page_id", *carry]
        for frame in frames:
            near = frame.column("lines").to_pylist()
            texts = [article(lines(h), x or []) for h, x in zip(frame.column("html").to_pylist(), near)]
            found = [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array([x is not None for x in near])]
            yield pa.RecordBatch.from_arrays([*(frame.column(c) for c in own), *found], [*own, "text", "n_chars", "neighbour"])

    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in ("page_id", *carry)) + ", text string, n_chars long, neighbour boolean"
    return given.mapInArrow(extract, schema)
