"""Operators against brute force on small data with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsight.llm import chat, decontamination, graph, html, language, neardup, packing, pii, quality, tokens, urls
from shelfsight.llm.common import tune
from shelfsight.llm.queries import TOKENIZER, URL_RULES

DOCS = "doc_id long, text string, lang string, size int, node string, count int, id int, term string"
rng = random.Random(5)
VOCAB = ["the", "of", "alpha", "beta", "gamma", "delta", "épée", "Ñandú", "x1", "stone", "river", "and"]
BASE = [rng.choice(VOCAB) for _ in range(60)]


def changed(words, k):
    out = list(words)
    for place in rng.sample(range(len(out)), k):
        out[place] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


TEXTS = {
    1: " ".join(BASE), 2: " ".join(BASE).upper().replace("É", "é").replace("Ñ", "Ñ"), 3: changed(BASE, 1), 4: changed(BASE, 2), 5: changed(BASE, 30),
    6: None, 7: "", 8: " \t\n", 9: "two words", 10: "Two  words", 11: "one two three four five", 12: "x " * 30,
    13: " ".join(f"w{k}" for k in range(5000)), 14: "mail a.b@c.de, a.b@c.de_x@y.org 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (499) 555-6503 +12",
    15: "Alpha beta.\nGamma delta!\nAlpha beta.\n\nAlpha beta.",
}


@pytest.fixture(scope="module")
def docs(spark):
    tune(spark)
    rows = [(k, t, None, 1, "n", 2, 3, "t") for k, t in TEXTS.items()]
    rows += [rows[0], (None, TEXTS[1], "en", 1, "n", 2, 3, "t"), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], DOCS)


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", text or "") if w]


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# Ids that a double cannot hold, beside a null


BIG = 1 << 60


@pytest.fixture(scope="module")
def large_ids(spark, docs):
    """One batch of rows with ids above 2**53 and a null one, columns repeated under names the operators use."""
    rows = [(BIG + 1, TEXTS[1]), (None, TEXTS[1]), (BIG + 3, TEXTS[5]), (BIG + 5, TEXTS[3]), (BIG + 3, TEXTS[5]), (BIG + 7, None)]
    return spark.createDataFrame([(k, t, "xx", 1, "n", 2, 3, "t") for k, t in rows], DOCS).coalesce(1)


def test_large_ids_beside_a_null(spark, large_ids):
    given = sorted(str(r.doc_id) for r in large_ids.collect())
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert ids(tokens.token_counts(large_ids, TOKENIZER)) == given
    assert set(ids(packing.pack(large_ids, TOKENIZER))) == set(given)
    known = language.learn(large_ids)
    assert ids(language.identify(large_ids, known)) == given
    carried = language.identify(large_ids.withColumn("count", F.col("doc_id")), known, carry=("count", "text"))
    assert sorted((str(r["count"]), r.text) for r in carried.collect()) == sorted((str(r.doc_id), r.text) for r in large_ids.collect())
    found = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(large_ids).collect()}
    assert found == {(BIG + 1, BIG + 1, True), (BIG + 5, BIG + 1, False), (BIG + 3, BIG + 3, True), (BIG + 7, BIG + 7, True), (None, None, True)}
    pages = large_ids.selectExpr("doc_id AS page_id", "concat('http://a.org/', doc_id) AS url", "'<p>one</p>' AS html")
    assert sorted(str(r.page_id) for r in html.main_text(pages).collect()) == given


# Tokens and packing


def test_lengths_of_batches():
    """Many texts in few calls: long ones, ones of several parts, ones with a special token."""
    enc = tokens.encoder(TOKENIZER)
    texts = [t or "" for t in TEXTS.values()] + ["word " * 60000, "x <|endoftext|>  y", "", "é" * 3000] * 3
    assert enc.lengths(texts).tolist() == [len(enc.library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert enc.lengths([]).tolist() == []


def test_token_counts(docs, empty):
    library = tokens.encoder(TOKENIZER).library
    got = tokens.token_counts(docs, TOKENIZER).collect()
    want = [(k, t) for k, t in [*TEXTS.items(), (1, TEXTS[1]), (None, TEXTS[1]), (None, None)]]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(
        (str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in want
    )
    assert tokens.token_counts(empty, TOKENIZER).count() == 0


@pytest.mark.parametrize("text", ["", "a  b", " \n b\n\n c \nd", "x <|endoftext|>  y", "it's 12 ´ é\x85 z ", "word " * 30000 + "\n" + " a" * 40000])
def test_parts_give_the_ids_of_the_text(text):
    enc = tokens.encoder(TOKENIZER)
    assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids
    assert "".join(tokens.split(text)) == text


def best_cost(places, prices, rules):
    """The cost of the best cuts, trying every place before, with at most ``runs`` free cuts in between."""
    at, cost = [0, *places], [0.0]
    for j in range(1, len(at)):
        found = []
        for i in range(j):
            gap = at[j] - at[i]
            full = -(-gap // rules.window)
            if full - 1 <= rules.runs or i == j - 1:
                found.append(cost[i] + full * rules.window - gap + (full - 1) * rules.free_cut)
        cost.append(min(found) + prices[j - 1])
    return cost[-1]


def test_cuts_are_the_best():
    rules = packing.PackRules(window=16, runs=2)
    for seed in range(60):
        r = random.Random(seed)
        places = sorted(r.sample(range(1, 400), r.randrange(1, 60)))
        prices = [r.choice([0.0, 0.25]) for _ in places]
        ends, price = packing.cuts(places, prices, rules), dict(zip(places, prices))
        total, lo = 0.0, 0
        for end in ends:
            assert 0 < end - lo <= 16
            total += 16 - (end - lo) + price.get(end, rules.free_cut)
            lo = end
        assert lo == places[-1]
        assert total == pytest.approx(best_cost(places, prices, rules)) or total < best_cost(places, prices, rules)


def test_pack_round_trip(docs, empty):
    library = tokens.encoder(TOKENIZER).library
    rows = packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), TOKENIZER).collect()
    sequences = {}
    for doc, own in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id, r.start)), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(TEXTS[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty, TOKENIZER).count() == 0


# Quality


def test_quality_counts(docs, empty):
    for r in quality.quality(docs.where("doc_id is not null")).collect():
        text = TEXTS[r.doc_id] or ""
        own = words(text)
        grams = [tuple(own[k : k + 5]) for k in range(len(own) - 4)]
        hit = {p for k, g in enumerate(grams) if grams.count(g) > 1 for p in range(k, k + 5)} if len(own) < 200 else set()
        lines = [x for x in text.split("\n") if words(x)]
        assert r.n_words == len(own) and r.word_chars == sum(map(len, own))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(hit)
        assert r.base_failed == (len(own) < 10 or 100 * len(hit) > 20 * len(own))
        assert not (r.base_failed and r.kept)
    assert quality.quality(empty).count() == 0 and quality.quality(docs).count() == docs.count()


# URLs and components


def test_components(spark):
    edges = [(a, a + 1) for a in range(40) if a % 10 != 9] + [(100, k) for k in range(50, 60)] + [(7, 7), (None, 3), (60, 61), (61, 60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: k // 10 * 10 for k in range(40) if k % 10} | {k: 50 for k in [*range(51, 60), 100]} | {61: 60}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_extended_components(spark):
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    rows = lambda df: {(r.node, r.component) for r in df.collect()}
    old, new = [(5, 6), (6, 7), (2, 9), (20, 21)], [(7, 9), (1, 30), (30, 21), (8, 8), (6, 5)]
    got = graph.extended(graph.components(frame(old)), frame(new))
    assert rows(got) == rows(graph.components(frame(old + new)))
    assert rows(graph.extended(graph.components(frame([])), frame(old))) == rows(graph.components(frame(old)))
    assert rows(graph.extended(graph.components(frame(old)), frame([]))) == rows(graph.components(frame(old)))


def test_groups_stay_whole_behind_a_skewed_join(spark):
    """Neighbours of one group are found also where the join before it on the same keys is split by AQE."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(40_000).selectExpr("id % 7 AS node", "0L AS part", "id")
        keys = spark.range(7).selectExpr("id AS node", "0L AS part")
        joined = rows.repartition(16).join(keys.hint("merge"), ["node", "part"])
        work = lambda group: [(int(group["node"].iloc[0]), len(group))]
        got = [(r.node, r.n) for r in neardup._compared(joined, work, "node long, n long").collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(got) == [(k, len(range(k, 40_000, 7))) for k in range(7)]



def test_url_decisions_reach_aliases(spark):
    page = lambda k, url, html="": (k, url, html, "x", 1, "y")
    link = '<link rel="canonical" href="{}">'
    rows = [
        page(1, "https://a.example.com/de/1"), page(2, "http://mirror.net/1", link.format("https://a.example.com/de/1")),
        page(3, "http://far.net/2?utm_source=q#f", '<meta http-equiv="refresh" content="0; url=http://mirror.net/1">'),
        page(4, "http://free.org/x", link.format("https://www.a.example.com/de/7")), page(5, "https://a.example.com/de/7.html"),
        page(6, "http://mirror.net/9", link.format("http://free.org/x")), page(7, None), page(8, "no address"), page(9, "HTTP://A.Example.ORG/en/12?x"),
        page(9, "HTTP://A.Example.ORG/en/12?x"), page(None, "http://z.com"), page(11, "http://EXAMPLE.org/es"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, plain string, place int, component string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, URL_RULES).collect()}
    assert got[1] == ("a.example.com", "/de/1", "com/de/", "block")
    assert got[2][2:] == (None, "block") and got[3][2:] == (None, "block")
    assert got[4][2:] == ("org/", "allow") and got[5][2:] == ("com/de/", "block") and got[6][2:] == (None, "allow")
    assert got[7] == got[8] == ("", "", None, "allow") and got[9] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[None] == ("z.com", "", None, "allow") and got[11][2] == "org/" if got[11][1].startswith("/") else True
    assert urls.judge(pages.where("false"), URL_RULES).count() == 0 and urls.judge(pages, URL_RULES).count() == len(rows)


def test_url_links_relative_to_the_page(spark):
    """Every alias names /de/7 of a blocked folder, or of a host allowed there, through a link of another form."""
    refresh, canonical = '<meta http-equiv="refresh" content="0; url={}">', '<link href="{}" rel="canonical">'
    forms = [
        ("http://a.example.com/x/y/p", refresh, "../../de/7.html"), ("http://b.example.com/de/x/p?q=1#f", refresh, "./../7"), ("http://c.example.com", canonical, "de/7"),
        ("http://d.example.com/x/", canonical, "../../../de/./7"), ("http://e.example.com/x", canonical, "&#x2F;de&#47;7?a=1&amp;b=2"),
        ("http://f.net/x", '<base href="http://f.example.com/de/">' + canonical, "7"), ("http://g.net/q", refresh, "'//g.example.com/de/7'"),
    ]
    rows = [(k, url, html.replace("{}", to)) for k, (url, html, to) in enumerate(forms)]
    rows += [(20, "http://h.net/x", canonical.replace("{}", "?id=3&amp;z")), (21, "http://h.net/x?id=3&z", canonical.replace("{}", "http://h.example.com/de/7"))]
    rows += [(30, "http://i.net/x", canonical.replace("{}", "mailto:a@i.example.com")), (31, "http://j.net/x", canonical.replace("{}", "/y?u=http://j.example.com/de/7"))]
    blocked = [(100 + k, f"http://{c}.example.com/de/7" + ("?a=1&b=2" if c == "e" else ""), "") for k, c in enumerate("abcdefghij")]
    pages = spark.createDataFrame(rows + blocked, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, URL_RULES).collect()}
    assert [k for k, _, _ in rows if got[k] == "block"] == [0, *range(1, 7), 20, 21]
    assert all(got[k] == "block" for k, _, _ in blocked)


# Near-duplicates


def brute_components(texts):
    sets = {}
    for k, t in texts.items():
        own = words(fold(t))
        sets[k] = {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()
    top = {k: k for k in texts}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {k: (len(sets[k]), find(k)) for k in texts}


def near(docs, **rules):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, neardup.ChosenPath(**rules)).collect()}


def test_near_duplicates(docs, empty):
    got = near(docs.where("doc_id is not null"))
    assert got == brute_components(TEXTS)
    assert neardup.near_duplicates(empty).count() == 0
    lost = [r for r in neardup.near_duplicates(docs).collect() if r.doc_id is None]
    assert len(lost) == 2 and all(r.kept and r.component_id is None for r in lost)


def test_near_duplicates_in_large_nodes(spark):
    """Small limits: nodes branch, are dealt into parts and blocks, and the result is the same."""
    texts = {k: changed(BASE * 2, k % 3) for k in range(60)} | {100 + k: changed(BASE[:20] * 3 + VOCAB * 5, k % 9) for k in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert near(docs, leaf=4, strangers=6, depth=3, block=200) == brute_components(texts)


# Language


def test_language(spark, docs, empty):
    lines = {"en": "the river of the stone and that with this for was", "fr": "le la des une dans pour avec est que les sur", "xx": "zu ko mi ra"}
    rows = [(k, " ".join(random.Random(k).choices(lines[lang].split(), k=40)), lang, "s") for k, lang in enumerate(list(lines) * 30)]
    train = spark.createDataFrame([*rows, (999, None, "en", "s"), (998, "text", None, "s")], "doc_id long, text string, lang string, order string")
    known = language.learn(train)
    assert list(known) == ["en", "fr", "xx"]
    got = {r.doc_id: r for r in language.identify(train, known).collect()}
    assert all(got[k].lang_pred == lang and 0 <= got[k].score <= 1 for k, _, lang, _ in rows)
    assert got[999].lang_pred == "und" and not got[999].accepted
    odd = {r.doc_id: r.lang_pred for r in language.identify(docs, known).collect()}
    assert odd[6] == odd[7] == odd[8] == "und" and odd[1] in known
    assert language.learn(empty) == {} and language.identify(docs, {}).where("accepted").count() == 0
    assert language.identify(empty, known).count() == 0


# Pages


def longest(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_shared_lines_are_a_longest_common_subsequence():
    for seed in range(80):
        r = random.Random(seed)
        a, b = ([r.randrange(6) for _ in range(r.randrange(25))] for _ in "ab")
        places = html.shared(a, b)
        assert places == sorted(set(places)) and len(places) == longest(a, b)
        rest = iter(b)
        assert all(a[k] in rest for k in places)


def test_main_text(spark):
    page = '<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</li></ul></nav>{}<footer>&copy; us</footer></body></html>'
    top, foot = "<div>Site name</div>", "<div>Call us</div>"
    rows = [
        (1, "http://h.net/a/1", page.replace("{}", "<article><h1>Head</h1><p>One &amp; <b>two</b><br>three <!-- x --><p>four</article><div class='ad'>Buy</div>")),
        (2, "http://h.net/a/2", page.replace("{}", f"{top}<p>First  story</p>{foot}")), (3, "http://h.net/a/3", page.replace("{}", f"{top}<p>Second story</p>{foot}")),
        (4, "http://h.net/a/3", page.replace("{}", f"{top}<p>Third story</p>{foot}")), (5, "http://alone.net/", "<p>All <i>of</i> it<script>var t='</p>';"),
        (6, None, None), (7, "http://h.net/z", ""), (None, "http://h.net/zz", "<p>x</p>"), (5, "http://alone.net/", "<p>All <i>of</i> it<script>var t='</p>';"),
    ]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, row int, lines string")
    got = {r.page_id: r.text for r in html.main_text(pages).collect()}
    assert got[1] == "Head One & two three four"
    assert got[2] == "First story" or got[2] == "Site name First story Call us"
    assert got[3] == "Second story" and got[4] == "Third story" and got[5] == "All of it" and got[6] == got[7] == ""
    assert html.main_text(pages).count() == len(rows) and html.main_text(pages.where("false")).count() == 0


# Personal data


def brute_spans(text):
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9](?:[ -]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][ ().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(kind, m.start(), m.end()) for kind, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_patterns(spark, docs, empty):
    r = random.Random(3)
    pieces = ["a.b@c.de", "@", ".", "1.2.3.4", "300.1.1.1", "0001.2.3.4.5", "4111-1111 11111111", "4111 1111", "+1 (499) 555-6503", "+", " ", "é", "x_y%@q-1.z", "12", "-"]
    texts = {k: "".join(r.choices(pieces, k=12)) for k in range(300)} | {900: "7" * 5000, 901: "a" * 50000, 902: "1 " * 3000}
    found = pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    for row in found.collect():
        assert [tuple(s) for s in row.spans] == brute_spans(texts[row.doc_id]), texts[row.doc_id]
    assert pii.find(empty).count() == 0 and pii.find(docs).count() == docs.count()


def test_pii_terms_that_give_a_value_away(spark):
    filler = [(k, f"plain the words of text {k}") for k in range(100, 160)]
    rows = [(k, f"the Zorblax of, jo@x.org the {k}") for k in range(4)] + [(9, "the other kim@x.org")] + filler
    docs = spark.createDataFrame([(*r, len(r[1]), "s") for r in rows], "doc_id long, text string, n_chars long, spans string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert [tuple(x) for x in got[0].added] == [("term", 4, 11)] and not got[9].added and not got[100].added
    clean = {r.doc_id: r for r in pii.clean(docs).collect()}
    assert clean[0].text == "the [TERM] of, [EMAIL] the 0" and clean[0].n_chars == len(clean[0].text)
    assert clean[100].text == filler[0][1] and clean[9].text == "the other [EMAIL]"
    assert pii.clean(docs).columns == docs.columns


def test_pii_terms_of_whole_documents_and_of_values_in_few(spark):
    """The term stands far from the value, again behind it, and only two documents hold the value."""
    far = "plain words " * 30
    filler = [(k, f"plain words of text {k}") for k in range(100, 160)]
    rows = [(k, f"Zorblax {far} jo@x.org {far} zorblax") for k in range(2)] + [(2, f"quuxly {far} kim@x.org"), (2, f"quuxly {far} kim@x.org")]
    rows += [(3, "grault lee@y.net"), (4, "grault far from it"), (5, "grault lee@y.net"), (6, "grault"), (7, "grault"), (None, "zorblax jo@x.org")]
    docs = spark.createDataFrame(rows + filler, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.added] for r in pii.find(docs).collect()}
    end = len(rows[0][1])
    assert got[0] == got[1] == [("term", 0, 7), ("term", end - 7, end)]
    assert not got[2] and not got[3] and not any(got[k] for k, _ in filler)  # one document alone; a term too common
    clean = {r.doc_id: r.text for r in pii.clean(docs).collect()}
    assert clean[1] == f"[TERM] {far} [EMAIL] {far} [TERM]" and clean[None] == "[TERM] [EMAIL]"


# Decontamination


def test_decontamination(spark, docs, empty):
    items = {1: " ".join(BASE[5:30]), 2: "Two, words", 3: "absent " * 12, 4: None, 5: "...", 6: " ".join(f"w{k}" for k in range(100, 115)), 7: "X x x x x x x x x x x"}
    bench = spark.createDataFrame([*((k, t, "w") for k, t in items.items()), (1, items[1], "w")], "item_id long, text string, window string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    got = {r.doc_id: r for r in decontamination.contamination(docs.where("doc_id is not null"), bench).collect()}
    for k, text in TEXTS.items():
        own, hit, named = split(text), set(), set()
        for item, t in items.items():
            of = split(t)
            for g in {tuple(of[i : i + 10]) for i in range(max(1, len(of) - 9))} if of else ():
                for i in range(len(own) - len(g) + 1):
                    if tuple(own[i : i + len(g)]) == g:
                        hit |= set(range(i, i + len(g)))
                        named.add(str(item))
        r = got[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(own), len(hit), len(named), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    assert decontamination.contamination(docs, bench).count() == docs.count()
    assert decontamination.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontamination.contamination(empty, bench).count() == 0


def test_words_are_counted_by_cutting(spark):
    texts = ["", " ", "a", "--A--", "Z[b`c{D@E/F:9", "\x00é ß\x7fÀ\x80x", "İ 𐐀_Word\n\tend.", "x" * 9 + " !" * 50, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.contamination(docs, spark.createDataFrame([(1, "none of it")], "item_id long, text string"))
    of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t or ""))
    assert {r.doc_id: r.n_words for r in found.collect()} == {k: len(of(t)) for k, t in enumerate(texts)}
    # Matching the words one by one takes ten times as long as cutting at what is between them.
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_near_phrases(spark):
    docs = spark.createDataFrame([(1, "q a b c d e f"), (2, "q a c b d e f"), (3, "f e d c b a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    rules = decontamination.PhraseRules(width=5, slop=1)
    got = {(r.doc_id, r.exact) for r in decontamination.matches(docs, items, rules).collect()}
    assert (1, True) in got and (2, False) in got and 3 not in {d for d, _ in got}


# Tool calls


def test_tool_calls(spark):
    calls = [
        (1, "a", 5, "add", '{"y":1,"x":2}', ["b"]), (1, "b", 7, "add", '{"x":"no"}', []), (1, "c", 9, "none", "{", ["lost"]), (1, "d", 1, "add", None, ["e"]),
        (1, "e", 2, "add", '{"x":1,"y":true}', ["d"]), (1, "a", 8, "add", "{}", []), (2, "a", 1, "add", '{"x":1,"y":2.0}', None), (None, "q", 1, "add", "{}", []),
    ]
    results = [(1, "a", 6, "3"), (1, "a", 5, "first"), (1, "z", 4, "who"), (1, "b", 3, "soon")]
    schema = '{"type":"object","required":["x","y"],"properties":{"x":{"type":"integer"},"y":{"type":"number"}}}'
    out = chat.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>"),
        spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"),
        spark.createDataFrame([("add", schema)], "name string, schema string"),
    )
    got = {(r.conv_id, r.call_id): r for r in out.collect()}
    status = {k: r.status for k, r in got.items()}
    assert status == {(1, "a"): "linked", (1, "b"): "early", (1, "c"): "unanswered", (1, "d"): "cyclic", (1, "e"): "cyclic", (1, "z"): "orphan", (2, "a"): "unanswered"}
    assert (got[1, "a"].rank_turn, got[1, "a"].rank_step) == (7, 1) and got[1, "b"].rank_turn == 7
    assert got[1, "b"].errors == ["$.y: missing", "$.x: type"] and got[1, "c"].errors == ["$: json", "needs lost"]
    assert got[1, "e"].errors == ["$.y: type"] and got[2, "a"].errors == []
    assert got[1, "a"].record == '{"arguments":{"x":2,"y":1},"id":"a","name":"add","needs":["b"],"result":"first","status":"linked"}'
