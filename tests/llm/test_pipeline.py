"""The pipeline over the smallest tables: each stage against its operator's result, worked out anew."""

import pathlib
import zlib

import numpy as np
import pytest

import corpus_pipeline as pipeline
from shelfsight.llm import tokens

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).is_dir(), reason="no test data")


def test_stages(spark):
    from test_operators import brute_components, brute_spans, fold

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [{r.doc_id: r for r in docs.collect()}]
    for _, function in pipeline.STAGES[:-1]:
        docs = pipeline.stage(function(spark, docs, DATA), "test")
        assert docs.columns == list(pipeline.DOCUMENTS)
        seen.append({r.doc_id: r for r in docs.collect()})
        assert docs.count() == len(seen[-1])
    given, spoken, single, clean, safe = seen
    assert len(spoken) >= 0.98 * len(given)
    found = brute_components({k: r.text for k, r in spoken.items()})
    assert set(single) == {k for k, (_, top) in found.items() if top == k}
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        own = split(r.text)
        windows |= {tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9))} if own else set()
    for k, r in single.items():
        own = split(r.text)
        leaks = any(tuple(own[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(own) - n + 1))
        assert leaks != (k in clean)
    assert set(safe) == set(clean)
    for k, r in safe.items():
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        if not brute_spans(clean[k].text):
            assert r.text == clean[k].text
    pieces = pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    enc = tokens.encoder(pipeline.TOKENIZER)
    for r in pieces:
        ids = np.append(enc.encode(safe[r.doc_id].text), np.uint32(0)).astype("<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
    assert sum(r.length for r in pieces) == sum(len(enc.encode(r.text)) + 1 for r in safe.values())


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text, "en"), (5, text, "de"), (3, text + " more", "en"), (3, "quite another text", "en"), (None, text, "en"), (None, text, "en"), (9, "short", "en")]
    docs = spark.createDataFrame([(a, b, c, "s", 1) for a, b, c in rows], "doc_id long, text string, lang string, source string, n_chars int")
    left = pipeline.near_duplicates(spark, docs, DATA)
    assert left.columns == list(pipeline.DOCUMENTS)
    got = sorted((str(r.doc_id), r.text, r.lang) for r in left.collect())
    assert got == [("3", "quite another text", "en"), ("9", "short", "en"), ("None", text, "en"), ("None", text, "en")]
