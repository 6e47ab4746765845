"""Periodic runs, fill-in-the-middle and the quality field: brute force, round trips and labels not seen."""

import hashlib
import itertools
import pathlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from shelfsight.llm import infill, linefield, periodic, queries
from shelfsight.llm.common import tune
from shelfsight.llm.sql import ORACLES

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, quality int, features string, seed int, n int, score double, count int"
BIG = 1 << 60
rng = random.Random(11)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

LONG = " ".join(f"w{k % 700}" for k in range(7000)) + " tail" * 9
TEXTS = {
    1: "a b " * 9, 2: "x x x x x x", 3: "x x x x x", 4: None, 5: "", 6: " \t\n", 7: "one two three", 8: "a b a b a b a b a c",
    9: "the cat sat. " * 4 + "a a a a a a a", 10: LONG, 11: "text <P> with a marker", 12: "one\x0btwo three  four\n\nfive \r\n",
    13: "äöü 😀 " * 40, 14: "a\nb\nc\n" * 30, 15: " lead and end ", 16: "x" * 5000, 17: "<S <P M> <M  >" * 3, 18: "word " * 300,
}
ROWS = [(k, t) for k, t in TEXTS.items()]
ROWS += [ROWS[0], (BIG + 1, "a b c " * 8), (None, "a b c " * 8), (BIG + 3, "q " * 20), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    tune(spark)
    return spark.createDataFrame([(k, t, None, 1, "f", 3, 4, 0.5, 6) for k, t in ROWS], DOCS).coalesce(1)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_runs(w, shortest=6, repeats=4):
    """Every stretch with a smallest period that no neighbour continues, by trying all periods."""
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, repeats * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_against_all_periods(letters):
    r = random.Random(letters)
    for _ in range(400):
        w = []
        for _ in range(r.randrange(6)):
            w += [r.choice("abc"[:letters]) for _ in range(r.randrange(1, 7))] * r.randrange(1, 8)
            w += [f"u{r.random()}"] * (r.random() < 0.3)
        assert periodic.word_runs(w) == brute_runs(w)
        for rules in (periodic.RunRules(2, 2), periodic.RunRules(3, 3)):
            assert periodic.word_runs(w, rules) == brute_runs(w, rules.shortest, rules.repeats)
        # The whole sequence without the narrowing to crowded stretches.
        ids = [sorted(set(w)).index(x) for x in w]
        assert periodic.runs_of(ids) == brute_runs(w)


def test_extensions_and_order_of_suffixes():
    r = random.Random(3)
    for _ in range(100):
        s = [r.randrange(3) for _ in range(r.randrange(1, 30))]
        ext = periodic.Extensions(s)
        pairs = list(itertools.permutations(range(len(s) + 1), 2))
        a, b = np.array(pairs).T
        common = lambda i, j: next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), 0)
        assert ext.between(a, b).tolist() == [common(i, j) for i, j in pairs]
        assert np.argsort(ext.rank).tolist() == sorted(range(len(s) + 1), key=lambda i: s[i:])


def test_suffix_tree_is_linear_in_nodes():
    for s in ([0] * 500, [0, 1] * 250, [rng.randrange(4) for _ in range(500)], list(range(500))):
        assert len(periodic.SuffixTree(s).starts) <= 2 * (len(s) + 1)


def want_runs(doc_id, text, seeded=True):
    w = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if seeded and doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(w), len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def same(got, want):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_periodic_runs(docs, empty):
    found = periodic.periodic_runs(docs)
    same(found.drop("runs", "collapsed").collect(), [want_runs(k, t, False) for k, t in ROWS])
    assert periodic.periodic_runs(empty).count() == 0
    two = {r.doc_id: r for r in found.collect() if r.doc_id}
    assert two[1].collapsed == "a b" and two[8].collapsed == "a b c" and [tuple(r) for r in two[2].runs] == [(0, 6, 1)]
    assert two[3].n_runs == 0 and two[3].start is None


def test_op11_on_the_given_documents(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    same(queries.op11_periodic_runs(spark, str(tmp_path)).collect(), [want_runs(k, t) for k, t in ROWS])
    if pathlib.Path(DATA).is_dir():
        given = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
        same(queries.op11_periodic_runs(spark, DATA).collect(), [want_runs(*r) for r in given])


def test_units_are_found_by_number():
    for _ in range(300):
        text = "".join(rng.choice("ab  \n\x0b é😀") for _ in range(rng.randrange(40)))
        ends = [0, *(m.end() for m in UNITS.finditer(text))]
        for block in (1, 2, 3, 7, 64):
            tree = infill.UnitTree(text, block)
            assert [tree.end(k) for k in range(tree.count + 1)] == ends


def want_infill(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    assert "".join(units) == text
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    form = "plain" if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sizes = (None, None) if form == "plain" else (len(p), len(m))
    return (doc_id, n, form, *sizes, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), out)


def test_infill(docs, empty):
    same(infill.infill(docs).collect(), [want_infill(k, t) for k, t in ROWS])
    assert infill.infill(empty).count() == 0


def test_infill_of_many_ids_in_small_blocks(spark):
    rows = [(k, rng.choice(list(TEXTS.values()))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = infill.infill(df, infill.InfillRules(block=8))
    same(found.collect(), [want_infill(k, t) for k, t in rows])
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_op12_equals_its_sql(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(ORACLES["op12_fill_in_middle"])
    got = queries.op12_fill_in_middle(spark, str(tmp_path))
    assert got.columns == want.columns
    same(got.collect(), want.fetchall())


# The quality field


def brute_marginals(good, moves):
    """Chances by summing over all sequences of states."""
    total, chance, pairs = 0.0, np.zeros(len(good)), np.zeros((2, 2))
    for states in itertools.product((0, 1), repeat=len(good)):
        weight = np.exp(sum(g for g, s in zip(good, states) if s) + sum(moves[a, b] for a, b in zip(states, states[1:])))
        total += weight
        chance += weight * np.array(states)
        for a, b in zip(states, states[1:]):
            pairs[a, b] += weight
    return chance / total, pairs / total, np.log(total)


def test_marginals_against_all_sequences():
    r = np.random.default_rng(4)
    for _ in range(20):
        sizes = r.integers(1, 7, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        good, moves = r.normal(0, 3, first[-1]), r.normal(0, 2, (2, 2))
        chance, pairs, total = linefield.marginals(good, first, moves)
        each = [brute_marginals(good[a:b], moves) for a, b in zip(first, first[1:])]
        assert np.allclose(chance, np.concatenate([e[0] for e in each]))
        assert np.allclose(pairs, sum(e[1] for e in each)) and np.isclose(total, sum(e[2] for e in each))


def test_counts_do_not_depend_on_pieces_or_batches():
    texts = [t or "" for t in TEXTS.values()] + ["", "\n\n", "A!! B!!\nA!! B!!\n", "z"]
    whole = linefield.Counts(texts, linefield.FieldRules())
    total = int(whole.first[-1])
    want = whole.own_features(0, total)
    assert np.isfinite(want).all() and want.shape == (total, len(linefield.FEATURES) + 1)
    assert total == sum(len(t.split("\n")) for t in texts)
    assert whole.lengths.tolist() == [len(x) for t in texts for x in t.split("\n")]
    for size in (64, 1000):
        parts = linefield.Counts([t for t in texts if t != TEXTS[16]], linefield.FieldRules(piece=size))
        alike = linefield.Counts([t for t in texts if t != TEXTS[16]], linefield.FieldRules())
        assert (parts.kinds == alike.kinds).all() and (parts.words[:, :4] == alike.words[:, :4]).all() and (parts.last == alike.last).all()
    weights = np.random.default_rng(2).normal(size=linefield.WIDTH)
    direct = linefield.with_neighbours(want, whole.first) @ weights
    for block in (1, 7, 1 << 14):
        assert np.allclose(linefield.weights_of_lines(whole, weights, block), direct)


def test_features_of_a_line():
    own = dict(zip(linefield.FEATURES, linefield.Counts(["LOUD!! x x 12\nLOUD!! x x 12"], linefield.FieldRules()).own_features(0, 2).T))
    assert own["letters"] ** 2 == pytest.approx([6 / 13] * 2) and own["capitals"] ** 2 == pytest.approx([4 / 6] * 2)
    assert own["calls"] ** 2 == pytest.approx([2 / 13] * 2) and own["repeated_words"] ** 2 == pytest.approx([0.25] * 2)
    assert own["loud_words"] ** 2 == pytest.approx([0.25] * 2) and own["repeated_line"].tolist() == [0, 1]


def made_text(good):
    line = lambda: " ".join(rng.choice(["stone", "river", "the", "and", "walks", "deep"]) for _ in range(9))
    clean = [line().capitalize() + "." for _ in range(rng.randrange(2, 6))]
    return "\n".join(clean if good else [*clean[:1], *(" | ".join(line().split()) + " |" for _ in range(6))])


def test_quality_learns_from_labels(spark, docs, empty):
    made = [(k, made_text(k % 2)) for k in range(200)] + [(BIG + 1, made_text(1)), (None, made_text(0)), (7, made_text(1))]
    texts = spark.createDataFrame([(k, t, "x", 0, "f", 1, 1, 0.0, 1) for k, t in made], DOCS)
    labels = spark.createDataFrame(
        [*((k, k % 2, 0) for k in range(100)), (None, 1, 0), (3, None, 0), (5, 1, 1), (5, 1, 1), (6, 7, 0)], "doc_id long, quality int, text int"
    )
    field = linefield.learn(texts, labels)
    found = linefield.quality(texts, field).collect()
    assert len(found) == len(made)
    for r in found:
        good = 0 if r.doc_id is None else 1 if r.doc_id in (7, BIG + 1) else r.doc_id % 2
        assert 0 <= r.score <= 1 and r.predicted == good, r
    whole = {r.doc_id: r.score for r in linefield.quality(docs, field).collect()}
    assert len(whole) == len({k for k, _ in ROWS}) and whole[4] == whole[5]
    assert linefield.quality(empty, field).count() == 0
    # No labels at all: nothing is known.
    blind = linefield.learn(texts, labels.where("false"))
    assert {(r.score, r.predicted) for r in linefield.quality(docs, blind).collect()} == {(0.5, 0)}
    blind = linefield.learn(empty, labels)
    assert {r.score for r in linefield.quality(docs, blind).collect()} == {0.5}


def test_scores_do_not_depend_on_the_batch():
    field = linefield.Field(np.random.default_rng(2).normal(size=linefield.WIDTH), np.eye(2), (0.3, 2.0))
    texts = [t or "" for t in TEXTS.values()]
    together = linefield.score(texts, field)
    assert np.allclose(together, [linefield.score([t], field)[0] for t in texts])


@pytest.mark.skipif(not pathlib.Path(DATA).is_dir(), reason="no test data")
def test_op13_on_labels_not_seen(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    found = queries.op13_quality_classifier(spark, DATA).collect()
    assert len(found) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7)
    judged = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged) and len(judged) > 5
