"""Quality of a document from its lines: a linear-chain conditional random field with two states, bad and good.

The features of a line are shares of kinds of characters and words, and the same
of the lines beside it. The field is fitted on a bounded sample of labelled
documents; a document's score is the mean marginal of its lines, weighted by
their lengths, on the scale of the labels.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

OTHER, UPPER, LETTER, DIGIT, SPACE, STOP, CALL, LINE = range(8)
KINDS = 8
FEATURES = (
    "letters", "capitals", "digits", "spaces", "stops", "calls", "others", "signed_words", "bare_words", "loud_words",
    "repeated_words", "word_length", "length", "empty", "ended", "repeated_line",
)
WIDTH = 1 + 3 * (len(FEATURES) + 1)


@dataclass(frozen=True)
class FieldRules:
    """The fit sees at most ``documents`` rows of each label, of at most ``lines`` lines: the bound of the sample."""

    documents: int = 1500
    lines: int = 200
    rounds: int = 150
    rate: float = 0.1
    ridge: float = 1e-4
    look_back: int = 4  # words before, among which a repeated word is looked for
    piece: int = 1 << 19  # code points worked on at a time
    cut: float = 0.7


@dataclass(frozen=True)
class Field:
    """Weights of a line's features for good against bad, of the four transitions, and the scale from marginals to labels."""

    weights: np.ndarray
    moves: np.ndarray
    scale: tuple[float, float]


@cache
def kinds() -> np.ndarray:
    """The kind of each code point."""
    out = np.zeros(0x110000, np.uint8)
    for code in range(len(out)):
        category = unicodedata.category(chr(code))
        if category == "Lu":
            out[code] = UPPER
        elif category[0] in "LM":
            out[code] = LETTER
        elif category[0] == "N":
            out[code] = DIGIT
        elif category[0] in "Z":
            out[code] = SPACE
    out[list(b" \t\x0b\x0c\r\x85")] = SPACE
    out[list(b".,;:'\"()-")] = STOP
    out[list(b"!?")] = CALL
    out[10] = LINE
    return out


_ODD = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.uint64) * 2 + 1


def pieces(text: str, limit: int) -> Iterator[str]:
    """A text in parts of about ``limit`` code points, cut behind a line end, else behind a space, else anywhere."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind("\n", at, at + limit), 0) or max(text.rfind(" ", at, at + limit), 0)
        cut = cut + 1 if cut >= at and cut else at + limit
        yield text[at:cut]
        at = cut
    yield text[at:]


class Counts:
    """Sums over the lines of a list of texts; the lines of all texts are numbered through."""

    def __init__(self, texts: Sequence[str], rules: FieldRules):
        self.rules = rules
        lines = np.array([t.count("\n") + 1 for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(lines)])
        total = int(self.first[-1])
        self.kinds = np.zeros((total, KINDS), np.int32)
        self.words = np.zeros((total, 5), np.int32)  # all, with another sign, without letter or digit, in capitals, repeated
        self.hash = np.zeros(total, np.uint64)
        self.last = np.zeros(total, np.uint8)
        start, joined, size = 0, [], 0
        for text in texts:
            for part in pieces(text, rules.piece):
                joined.append(part)
                size += len(part)
                if size >= rules.piece:
                    start, joined, size = self._add("".join(joined), start), [], 0
            joined.append("\n")  # the end of a text ends its last line
        self._add("".join(joined), start)

    def _add(self, text: str, start: int) -> int:
        """Add a part of the joined texts whose first character is in line ``start``; the line behind its end."""
        if not text:
            return start
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        kind = kinds()[code]
        ends = kind == LINE
        line = np.cumsum(ends)
        after = start + int(line[-1])
        line -= ends  # a line break belongs to the line it ends
        lines = int(line[-1]) + 1
        own = slice(start, start + lines)
        self.kinds[own] += np.bincount(line * KINDS + kind, minlength=lines * KINDS).reshape(lines, KINDS).astype(np.int32)
        inner = (kind != SPACE) & ~ends
        heads = np.flatnonzero(inner & np.concatenate([[True], ~inner[:-1]]))
        if not len(heads):
            return after
        tails = np.flatnonzero(inner & np.concatenate([~inner[1:], [True]]))
        size = tails - heads + 1
        place = np.flatnonzero(inner)
        begin = np.cumsum(size) - size  # of each word among the places
        within = lambda which: np.add.reduceat((kind[place] == which).astype(np.int32), begin)
        other, upper, lower, digit = map(within, (OTHER, UPPER, LETTER, DIGIT))
        inside = np.arange(len(place)) - np.repeat(begin, size)
        hashes = np.add.reduceat((code[place].astype(np.uint64) + np.uint64(1)) * _ODD[inside % len(_ODD)], begin)
        at = line[heads]
        number = np.arange(len(heads))
        number -= np.maximum.accumulate(np.where(np.concatenate([[True], at[1:] != at[:-1]]), number, 0))  # in its line
        repeated = np.zeros(len(heads), bool)
        for back in range(1, self.rules.look_back + 1):
            repeated[back:] |= (hashes[back:] == hashes[:-back]) & (at[back:] == at[:-back])
        of = (np.ones(len(heads), bool), other > 0, upper + lower + digit == 0, (upper > 1) & (lower == 0), repeated)
        for k, which in enumerate(of):
            self.words[own, k] += np.bincount(at[which], minlength=lines).astype(np.int32)
        np.add.at(self.hash, start + at, hashes * _ODD[number % len(_ODD)])
        self.last[start + at] = kind[tails]  # the last of equal indices stays
        return after

    @property
    def lengths(self) -> np.ndarray:
        return self.kinds[:, :LINE].sum(axis=1)

    def own_features(self, lo: int, hi: int) -> np.ndarray:
        """One row for each line of a range: its features and a one."""
        k, w = self.kinds[lo:hi].astype(float), self.words[lo:hi].astype(float)
        size = k[:, :LINE].sum(axis=1)
        chars, words, letters = np.maximum(size, 1), np.maximum(w[:, 0], 1), k[:, UPPER] + k[:, LETTER]
        same = w[:, 0] > 0
        same[1:] &= self.hash[lo + 1 : hi] == self.hash[lo : hi - 1]
        same[:1] &= self.hash[lo : lo + 1] == self.hash[max(lo - 1, 0) : max(lo - 1, 0) + 1]
        heads = self.first[:-1]
        same[heads[(heads >= lo) & (heads < hi)] - lo] = False
        last = self.last[lo:hi]
        shares = [
            letters / chars, k[:, UPPER] / np.maximum(letters, 1), k[:, DIGIT] / chars, k[:, SPACE] / chars, k[:, STOP] / chars,
            k[:, CALL] / chars, k[:, OTHER] / chars, w[:, 1] / words, w[:, 2] / words, w[:, 3] / words, w[:, 4] / words,
        ]
        others = [
            np.minimum((size - k[:, SPACE]) / words, 30) / 30, np.log1p(size) / 12, size == 0, (last == STOP) | (last == CALL), same,
            np.ones(len(size)),
        ]
        return np.stack([*map(np.sqrt, shares), *others], axis=1)


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row a line: a constant, its features, those of the line before and of the line after in its document."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([np.ones((len(own), 1)), own, before, after], axis=1)


def weights_of_lines(counts: Counts, weights: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """``with_neighbours(...) @ weights`` for all lines, a block of lines at a time."""
    total, first = int(counts.first[-1]), counts.first
    parts = weights[1:].reshape(3, -1).T
    each = np.empty((total, 3))
    for lo in range(0, total, block):
        each[lo : lo + block] = counts.own_features(lo, min(lo + block, total)) @ parts
    each[first[1:] - 1, 1] = np.where(first[1:] < total, 0, each[first[1:] - 1, 1])  # the last line is before no other
    each[first[:-1], 2] = np.where(first[:-1] > 0, 0, each[first[:-1], 2])
    out = weights[0] + each[:, 0]
    out[1:] += each[:-1, 1]
    out[:-1] += each[1:, 2]
    return out


def marginals(good: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(chance that a line is good, sums of the chances of each move by document, log of the partition functions together).

    ``good`` are the weights of good against bad, lines of a document in a row
    from ``first``. Forward and backward go line by line over all documents that
    still have a line, longest documents first.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # documents with a line at each step
    pull = np.exp(moves - moves.max())
    # State weights 1 and e^good, over their larger one.
    top = np.maximum(good, 0)
    state = np.stack([np.exp(-top), np.exp(good - top)], axis=1)
    ahead = np.empty_like(state)
    scale = np.empty(len(good))
    total = float(top.sum()) + float(moves.max()) * float((size - 1).sum())
    for step in range(longest):
        at = begin[: active[step]] + step
        value = state[at] if step == 0 else state[at] * (ahead[at - 1] @ pull)
        scale[at] = value.sum(axis=1)
        ahead[at] = value / scale[at][:, None]
    back = np.ones_like(state)
    pairs = np.zeros((2, 2))
    for step in range(longest - 1, 0, -1):
        at = begin[: active[step]] + step
        come = state[at] * back[at] / scale[at][:, None]
        back[at - 1] = come @ pull.T
        pairs += pull * (ahead[at - 1].T @ come)
    chance = ahead * back
    return chance[:, 1] / chance.sum(axis=1), pairs, total + float(np.log(scale).sum())


def _adam(start: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], rules: FieldRules) -> np.ndarray:
    value, slow, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, rules.rounds + 1):
        g = gradient(value)
        slow, square = 0.9 * slow + 0.1 * g, 0.99 * square + 0.01 * g * g
        rate = rules.rate * min(1.0, 3 * (1 - step / (rules.rounds + 1)))
        value -= rate * (slow / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return value


def _weighted(chance: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean chance of each document's lines, weighted by their lengths and one more, so that empty lines count too."""
    weight = length + 1.0
    return np.add.reduceat(chance * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def fit(features: np.ndarray, lengths: np.ndarray, first: np.ndarray, labels: np.ndarray, rules: FieldRules = FieldRules()) -> Field:
    """A field for lines of labelled documents.

    The labels are of documents. Lines are told apart without moves first;
    the lines of a bad document that look good there count as good, but for its
    worst one, and the field with moves is fitted to these lines.
    """
    if not len(labels):
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), (0.0, 0.0))
    size = np.diff(first)
    share = np.repeat(1.0 / size, size) / len(labels)  # each document counts once
    of_line = np.repeat(labels, size).astype(float)
    alone = _adam(
        np.zeros(WIDTH), lambda w: features.T @ (share * (1 / (1 + np.exp(-np.clip(features @ w, -40, 40))) - of_line)) + rules.ridge * w, rules
    )
    score = features @ alone
    worst = np.minimum.reduceat(score, first[:-1])
    state = ((of_line > 0) | ((score > 0) & (score > np.repeat(worst, size)))).astype(int)
    inner = np.ones(len(state), bool)
    inner[first[:-1]] = False
    follow = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[follow - 1], state[follow]), 1.0)

    def gradient(value: np.ndarray) -> np.ndarray:
        chance, pairs, _ = marginals(features @ value[:WIDTH], first, value[WIDTH:].reshape(2, 2))
        return np.concatenate([features.T @ (chance - state), (pairs - seen).ravel()]) / len(state) + rules.ridge * value

    value = _adam(np.concatenate([alone, np.zeros(4)]), gradient, rules)
    weights, moves = value[:WIDTH], value[WIDTH:].reshape(2, 2)
    mean = _weighted(marginals(features @ weights, first, moves)[0], lengths, first) - 0.5
    column = np.stack([np.ones(len(mean)), mean])
    slope = lambda v: (1 / (1 + np.exp(-v @ column)) - labels) @ column.T / len(labels) + rules.ridge * v
    scale = _adam(np.array([0.0, 4.0]), slope, rules)
    return Field(weights, moves, (float(scale[0]), float(scale[1])))


def learn(docs: DataFrame, labels: DataFrame, rules: FieldRules = FieldRules()) -> Field:
    """A field fitted to the labels 0 and 1 of ``quality``.

    Drawn are, by a hash of the id, up to ``rules.documents`` rows of each label
    whose text has no more than ``rules.lines`` lines. Rows without id or label
    are passed over. Of repeated labels of an id the smaller counts, of its
    repeated texts the first in order; without a text it has no part. Without any
    label all scores are 0.5. The features of the drawn lines come to the driver,
    at most ``2 * documents * lines`` rows of 17 numbers.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    short = F.size(F.split("text", "\n")) <= rules.lines
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & short)
    # Ids first: they are few bytes, and a bounded number of them is broadcast to the texts.
    drawn = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(rules.documents) for q in (0, 1)]
    own = texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counts(batch.column("text").to_pylist(), rules)
            first, lengths = counts.first.tolist(), counts.lengths
            rows = [counts.own_features(a, b).astype("<f4").tobytes() for a, b in zip(first, first[1:])]
            sizes = [lengths[a:b].astype("<i8").tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary()), pa.array(sizes, pa.binary())],
                ["doc_id", "quality", "features", "lengths"],
            )

    found = own.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(
        run, "doc_id long, quality int, features binary, lengths binary"
    ).collect()
    found.sort(key=lambda r: r.doc_id)
    width = len(FEATURES) + 1
    each = [np.frombuffer(r.features, "<f4").reshape(-1, width) for r in found]
    first = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    features = with_neighbours(np.concatenate([np.empty((0, width)), *each]), first)
    lengths = np.concatenate([np.empty(0), *(np.frombuffer(r.lengths, "<i8") for r in found)])
    return fit(features, lengths, first, np.array([r.quality for r in found]), rules)


def score(texts: Sequence[str], field: Field, rules: FieldRules = FieldRules()) -> np.ndarray:
    """The quality of each text, from 0 to 1."""
    counts = Counts(texts, rules)
    chance = marginals(weights_of_lines(counts, field.weights), counts.first, field.moves)[0]
    base, slope = field.scale
    return 1 / (1 + np.exp(-base - slope * (_weighted(chance, counts.lengths, counts.first) - 0.5)))


def quality(docs: DataFrame, field: Field, rules: FieldRules = FieldRules()) -> DataFrame:
    """(doc_id, score, predicted) of every row, from its whole text alone.

    A null text is an empty one, and that is one empty line. Repeated rows are
    each answered alike, null ids stay, other columns are ignored, an empty table
    gives an empty result. Memory is bounded by ``rules.piece`` and about 200
    bytes a line of the longest text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out, lo, size = [], 0, 0
            for at, text in enumerate(texts):
                if size and size + len(text) > rules.piece:
                    out.append(score(texts[lo:at], field, rules))
                    lo, size = at, 0
                size += len(text)
            if lo < len(texts):
                out.append(score(texts[lo:], field, rules))
            scores = np.concatenate([np.empty(0), *out])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= rules.cut).astype("i4"))], ["doc_id", "score", "predicted"]
            )

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def fold_of(doc_id: Column, folds: int = 4) -> Column:
    """The fold of a document by a checksum of its id; fold 2 is held out. A null id has none."""
    return F.crc32(doc_id.cast("string")) % folds
