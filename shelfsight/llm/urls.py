"""URL filters: rules by host and path, block decisions carried over to aliases of a page."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight.llm.common import fold, let
from shelfsight.llm.graph import components
from shelfsight.session import stage


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for the paths under ``path`` of ``host`` and its subdomains; the path starts with a slash."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


@dataclass(frozen=True)
class AliasRules:
    """What makes two addresses one page where the page itself names no canonical address."""

    prefixes: tuple[str, ...] = ("www", "m")  # labels in front of a host
    tracking: str = r"utm_[^=&]*|ref|fbclid|gclid"  # query parameters without effect
    suffix: str = r"/?(?:index)?(?:\.html?)?/?$"  # ends of a path without effect


# The whole of `scheme://host/path?query#fragment`; the first :// of the text counts.
_ADDRESS = r"^(?s)(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'>\s]+)"""
_REDIRECT = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'>\s]+)"""
_BASE = r"""(?is)<base\b[^>]*?\bhref\s*=\s*["']?([^"'>\s]+)"""
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
_NAMED = json.dumps({f"&{name}": x for name, x in html5.items() if name.endswith(";") and x < "\u0100"})  # ASCII and Latin-1


def host_of(url: Column) -> Column:
    return fold(F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 3), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as its place in the list; null if none does. The list is a parameter, so its size is the caller's."""
    order = sorted(range(len(rules)), key=lambda k: -len(rules[k].name))
    fits = [
        F.when(((host == rules[k].host) | host.endswith(f".{rules[k].host}")) & path.startswith(rules[k].path), F.lit(k))
        for k in order
    ]
    return F.coalesce(*fits, F.lit(None).cast("int"))


def _folded(path: Column) -> Column:
    """A path without the steps ``.`` and ``..``; none leads above the root."""
    def step(s: Column, x: Column) -> Column:
        up = F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(1)))
        return F.when(x == ".", s).when(x == "..", up).otherwise(F.concat(s, F.array(x)))

    walked = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.array_join(walked, "/")).otherwise(path)


def plain_address(url: Column, rules: AliasRules = AliasRules()) -> Column:
    """The address without scheme, fragment and all that ``rules`` call without effect; null for what is no address."""
    host = F.regexp_replace(host_of(url), rf"^(?:{'|'.join(rules.prefixes)})\.(?=[^.]+\.)", "")
    path = F.regexp_replace(_folded(path_of(url)), rules.suffix, "")
    query = F.regexp_replace(F.regexp_extract(url, _ADDRESS, 4), r"^\?", "")
    query = F.regexp_replace(query, rf"(?:^|&)(?:{rules.tracking})(?:=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, "^&", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def _decoded(link: Column) -> Column:
    """A value of an attribute with its character references put in, each once."""
    def one(x: Column) -> Column:
        hexadecimal = x.rlike("^&#[xX]")
        digits = F.regexp_replace(x, "^&#[xX]?0*|;$", "")
        code = F.when(F.length(digits) <= 7, F.conv(digits, 16, 10).try_cast("long"))
        code = F.when(hexadecimal, code).otherwise(F.when(F.length(digits) <= 7, digits.try_cast("long")))
        named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), x)
        return F.when(x.startswith("&#"), let(code, character)).otherwise(F.coalesce(named, x))

    def character(code: Column) -> Column:
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    hits = F.concat(F.transform(F.regexp_extract_all(link, F.lit(_REFERENCE), F.lit(0)), one), F.array(F.lit("")))
    pieces = F.zip_with(F.split(link, _REFERENCE, -1), hits, lambda gap, hit: F.concat(gap, hit))
    return F.when(link.contains("&"), F.array_join(pieces, "")).otherwise(link)


def _target(url: Column, link: Column) -> Column:
    """A link of a page as an address of its own, steps of its path not yet folded; null for a scheme without a host, such as ``mailto:``."""
    site = F.regexp_extract(url, r"^(?s)(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"^(?s)(.*?:)//", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(url), r"^(?s)(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path_of(url), link))
        .when(link.startswith("#"), url)
        .otherwise(F.concat(site, folder, link))
    )


def judge(pages: DataFrame, rules: Sequence[UrlRule], alias: AliasRules = AliasRules(), default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, page_class, inherited) of every row.

    The longest rule that fits an address decides. An address without a rule
    takes the decision of the addresses that are the same page: addresses alike
    but for what ``alias`` names, and those joined by redirects
    (``<meta http-equiv="refresh">``) or canonical links
    (``<link rel="canonical">``) in ``html``, over any number of steps. Links
    may be relative to the page or to its ``<base href>`` and hold character
    references; ``.`` and ``..`` in paths are folded. Among them an explicit allow goes before a block; if none has a rule, ``default``
    holds. ``page_class`` is the smallest plain address of the class.

    Only classes of plain addresses that a link joins enter the graph, and a
    verdict is gathered per class by a combined aggregate, so hosts and classes
    of any size are fine. A null address or one without ``://`` has an empty
    host and path, fits no rule and is in no class. Repeated rows are judged
    each, null ids stay; other columns are ignored, and ``html`` may be
    missing. An empty table gives an empty result.
    """
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    html = F.col("html") if "html" in pages.columns else F.lit(None).cast("string")
    found = lambda pattern: F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))

    def linked(base: Column) -> Column:
        plain = lambda raw: let(_decoded(raw), lambda x: let(_target(base, x), lambda t: plain_address(t, alias)))
        link = lambda pattern: let(found(pattern), lambda raw: F.when(raw.isNotNull(), plain(raw)))
        return F.array(link(_CANONICAL), link(_REDIRECT))

    base = let(found(_BASE), lambda raw: F.when(raw.isNotNull(), let(_decoded(raw), lambda x: _target(url, x))))
    first = pages.select(
        "page_id", host.alias("host"), path.alias("path"), plain_address(url, alias).alias("plain"),
        let(F.coalesce(base, url), linked).alias("links"),
    )
    first = stage(first.withColumn("place", rule_of(F.col("host"), F.col("path"), rules)), "url-rules")
    edges = first.select(F.col("plain").alias("a"), F.explode("links").alias("b")).where("a <> b")
    joined = components(edges).select(F.col("node").alias("plain"), "component")
    first = first.join(joined, "plain", "left").withColumn("page_class", F.coalesce("component", "plain"))

    verdicts = [r.verdict for r in rules]
    nothing = F.lit(None).cast("string")
    pick = lambda values: F.coalesce(*(F.when(F.col("place") == k, F.lit(v)) for k, v in enumerate(values)), nothing)
    ruled = first.withColumn("own", pick(verdicts))
    classes = (
        ruled.where("own is not null and page_class is not null")
        .groupBy("page_class")
        .agg(F.max(F.col("own") == "allow").alias("allowed"))
        .select("page_class", F.when(F.col("allowed"), F.lit("allow")).otherwise(F.lit("block")).alias("taken"))
    )
    open_ = ruled.where("own is null").join(classes, "page_class", "left")
    decided = ruled.where("own is not null").withColumn("taken", F.lit(None).cast("string"))
    return decided.unionByName(open_).select(
        "page_id", "host", "path", pick([r.name for r in rules]).alias("rule"),
        F.coalesce("own", "taken", F.lit(default)).alias("verdict"), "page_class", F.col("taken").isNotNull().alias("inherited"),
    )
