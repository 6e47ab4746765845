"""Token ids and token counts of whole texts, by a public tokenizer.

A long text is cut before a single space that a non-space follows. There the
pre-tokenizer always starts a new piece, so the ids of the parts are the ids of
the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BOUNDARY = re.compile(r"(?= \S)")
#: Bytes of text encoded by one call.
BATCH_BYTES = 1 << 20
#: How the byte-level pre-tokenizer of the ``tokenizers`` library cuts a text (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _fast_engine(path: str, library) -> tuple[Callable[[str], list[int]], Callable[[list[str]], list[list[int]]]]:
    """Ids of a part without special tokens, and of a batch of parts.

    A byte-level vocabulary whose ids follow its merges gives the same ids in
    the ``tiktoken`` library, several times faster; any other goes through
    ``tokenizers`` itself.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"] and not spec["normalizer"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", ())]
    ranks = [model["vocab"][m] for m in merged] if plain else [1, 0]
    if ranks != sorted(ranks) or len(merged) + 256 != len(model["vocab"]):
        return (
            lambda part: library.encode(part, add_special_tokens=False).ids,
            lambda parts: [e.ids for e in library.encode_batch(parts, add_special_tokens=False)],
        )
    import tiktoken

    to_byte = _bytes_of_characters()
    vocab = {bytes(to_byte[c] for c in token): number for token, number in model["vocab"].items()}
    engine = tiktoken.Encoding("part", pat_str=BYTE_LEVEL, mergeable_ranks=vocab, special_tokens={})
    # A task has one core; a batch starts a thread, which a single part does without.
    return engine.encode_ordinary, lambda parts: engine.encode_ordinary_batch(parts, num_threads=1)


class Encoder:
    """Ids of texts as arrays of unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.engine, self.engine_of_batch = _fast_engine(path, self.library)

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):  # the library cuts white space before one in another way
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.concatenate([np.array(ids, "<u4") for ids in map(self.engine, split(text))])

    def lengths(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has. The parts of all texts are encoded in batches of about the same bytes."""
        out = np.zeros(len(texts), np.int64)
        parts, owners = [], []
        for at, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[at] = len(self.encode(text))
            else:
                own = split(text)
                parts += own
                owners += [at] * len(own)
        sizes = [len(part.encode()) for part in parts]
        for lo, hi in batches(sizes, BATCH_BYTES):
            np.add.at(out, owners[lo:hi], [len(ids) for ids in self.engine_of_batch(parts[lo:hi])])
        return out


def split(text: str, least: int = 1 << 16) -> list[str]:
    """A long text in parts, each cut at a place where that changes nothing."""
    parts, start = [], 0
    while len(text) - start > least and (at := BOUNDARY.search(text, start + least)):
        parts.append(text[start : at.start()])
        start = at.start()
    return [*parts, text[start:]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def batches(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of about ``limit`` together; one alone may be larger."""
    start, total, at = 0, 0, -1
    for at, size in enumerate(sizes):
        if total + size > limit and at > start:
            yield start, at
            start, total = at, 0
        total += size
    if at >= start:
        yield start, at + 1


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row.

    ``tokenizer`` is the path of a file of the ``tokenizers`` library. No begin,
    end or added tokens; the string of a special token in a text counts as the
    library counts it by default. Nothing is cut off.

    A null or empty text has 0 bytes and 0 tokens. A repeated row is counted
    each time, a null id is passed through, other columns are ignored, an empty
    table gives an empty result. Lengths only leave the workers.
    """
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for frame in frames:
            tokens = enc.lengths(frame.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), frame.column("n_bytes"), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
