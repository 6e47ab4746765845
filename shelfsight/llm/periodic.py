"""Periodic runs of words: stretches that repeat a short sequence of words many times.

Runs are found by the runs theorem. Of the suffixes of a sequence, take for each
the next smaller one, in an order of the words and in the reverse order: the
part in between is a Lyndon word, and each run holds one whose length is the
run's period. A candidate is extended to both sides by the longest common
extension of two places, which is the depth of the lowest common ancestor of two
leaves of a suffix tree: Ukkonen's tree of the sequence to the right, that of the
reversed sequence to the left. Ancestors are minima of depths along an Euler tour.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)

Run = tuple[int, int, int]


@dataclass(frozen=True)
class RunRules:
    """A run of period q has ``max(shortest, repeats * q)`` words at least; ``repeats`` is 2 or more."""

    shortest: int = 6
    repeats: int = 4


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers of 0 and more, ended by the smaller number -1.

    Node 0 is the root. An edge is the part ``starts[v]`` to ``ends[v]`` of the
    sequence above node v; the edge of a leaf is open and ends with the sequence.
    """

    def __init__(self, values: Sequence[int]):
        s = self.values = [*values, -1]
        size = len(s)
        self.starts, self.ends, self.children = [0], [0], [{}]
        starts, ends, children, links = self.starts, self.ends, self.children, [0]
        node = edge = length = pending = 0  # the active point: node, first place of the edge, places down that edge
        for at, value in enumerate(s):
            pending += 1
            last = 0  # the inner node made before, which waits for its suffix link
            while pending:
                if not length:
                    edge = at
                below = children[node].get(s[edge])
                if below is None:
                    starts.append(at), ends.append(size), children.append(None), links.append(0)
                    children[node][s[edge]] = len(starts) - 1
                    if last:
                        links[last], last = node, 0
                else:
                    span = min(ends[below], at + 1) - starts[below]
                    if length >= span:  # the active point lies further down
                        node, edge, length = below, edge + span, length - span
                        continue
                    if s[starts[below] + length] == value:  # already there, and so are all shorter suffixes
                        length += 1
                        if last:
                            links[last] = node
                        break
                    middle = len(starts)
                    starts += [starts[below], at]
                    ends += [starts[below] + length, size]
                    children += [{s[starts[below] + length]: below, value: middle + 1}, None]
                    links += [0, 0]
                    children[node][s[edge]] = middle
                    starts[below] += length
                    if last:
                        links[last] = middle
                    last = middle
                pending -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = at - pending + 1


class Extensions:
    """Longest common extensions of any two places of a sequence in constant time, and the order of its suffixes."""

    def __init__(self, values: Sequence[int]):
        tree = SuffixTree(values)
        size = len(tree.values)
        tour: list[int] = []  # depths in values along the Euler tour
        order: list[int] = []  # suffixes from the smallest
        first = [0] * size
        starts, ends, children = tree.starts, tree.ends, tree.children
        depth = [0] * len(starts)
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at an inner node
                tour.append(depth[~v])
                continue
            below = children[v]
            if below is None:
                suffix = size - depth[v]
                first[suffix] = len(tour)
                order.append(suffix)
                tour.append(depth[v])
                continue
            tour.append(depth[v])
            own = depth[v]
            for key in sorted(below, reverse=True):
                w = below[key]
                depth[w] = own + ends[w] - starts[w]
                stack += [~v, w]
        self.first = np.array(first, np.int64)
        self.rank = np.empty(size, np.int64)
        self.rank[order] = np.arange(size)
        rows = [np.array(tour, np.int32)]
        for step in range(1, len(tour).bit_length()):
            half = 1 << step - 1
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.minima = rows

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values agree from the places ``a`` and ``b`` on, which differ."""
        lo, hi = np.sort([self.first[a], self.first[b]], axis=0)
        step = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(step):
            own = step == k
            row = self.minima[k]
            out[own] = np.minimum(row[lo[own]], row[hi[own] - (1 << k) + 1])
        return out


def next_smaller(rank: Sequence[int]) -> list[int]:
    """For each place the next one of a smaller number; the length where there is none."""
    size = len(rank)
    out, open_ = [size] * size, []
    for at, value in enumerate(rank):
        while open_ and rank[open_[-1]] > value:
            out[open_.pop()] = at
        open_.append(at)
    return out


def runs_of(values: Sequence[int], rules: RunRules = RunRules()) -> list[Run]:
    """(start, length, period) of every run of a sequence of numbers of 0 and more, in that order of start and period."""
    size = len(values)
    if size < rules.shortest:
        return []
    right, left = Extensions(values), Extensions(values[::-1])
    rank = right.rank[:size]
    found = []
    for order in (rank, -rank):
        # The end of the sequence is smaller than all words in the first order, larger in the second. The word
        # behind a run is smaller than the one a period before it in one of the two; that order shows the run.
        root = np.array(next_smaller(order.tolist()), np.int64)
        at = np.flatnonzero(root < size)
        period = root[at] - at
        ahead = right.between(at, at + period)
        behind = left.between(size - at, size - at - period)
        length = behind + period + ahead
        own = length >= np.maximum(rules.shortest, rules.repeats * period)
        found.append(np.stack([at - behind, length, period], axis=1)[own])
    found = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in found[np.lexsort((found[:, 2], found[:, 0]))].tolist()]


def crowded(words: Sequence, rules: RunRules) -> list[tuple[int, int]]:
    """Ranges of places outside which there is no run.

    Each word of a run stands in it ``repeats`` times or more, so a rarer word
    ends all runs, in the whole text and again in each range left. Rounds grow
    with the logarithm of the length; more would only make the ranges smaller.
    """
    ranges = [(0, len(words))]
    for _ in range(len(words).bit_length()):
        out = []
        for lo, hi in ranges:
            many = {w for w, n in Counter(words[lo:hi]).items() if n >= rules.repeats}
            start = None
            for at in range(lo, hi):
                if words[at] in many:
                    if start is None:
                        start = at
                elif start is not None:
                    out.append((start, at))
                    start = None
            if start is not None:
                out.append((start, hi))
        out = [(lo, hi) for lo, hi in out if hi - lo >= rules.shortest]
        if out == ranges:
            break
        ranges = out
    return ranges


def word_runs(words: Sequence[str], rules: RunRules = RunRules()) -> list[Run]:
    """(start, length, period) of every run of a list of words, by start and period."""
    ranges = crowded(words, rules)
    if not ranges:
        return []
    # One sequence of all ranges; between two of them a number that stands nowhere else.
    number: dict[str, int] = {}
    sequence, place = [], []
    for gap, (lo, hi) in enumerate(ranges):
        sequence += [number.setdefault(w, len(number)) for w in words[lo:hi]]
        sequence.append(len(words) + gap)
        place += range(lo, hi + 1)
    return [(place[start], length, period) for start, length, period in runs_of(sequence, rules)]


def collapse(words: Sequence[str], runs: Sequence[Run]) -> list[str]:
    """The words without those that a run holds after its first period."""
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\x01" * (length - period)
    return [w for w, gone in zip(words, dropped) if not gone] if runs else list(words)


def spread(words: Sequence[str], start: int, period: int) -> list[str]:
    """The words with those from ``start`` on replaced by the first ``period`` of them over and over."""
    part = list(words[start : start + period])
    rest = len(words) - start
    return [*words[:start], *(part * -(-rest // period))[:rest]]


def periodic_runs(docs: DataFrame, rules: RunRules = RunRules(), seed: Column | None = None) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs, collapsed).

    The words of a text are its parts without a space or one of the characters 9
    to 13. A run is a stretch of words with a smallest period q that no word
    before or after it continues; ``RunRules`` gives its least length. ``start``
    to ``exponent_milli`` describe the longest run (ties: the first, then the one
    of the smaller period) and are null without a run. ``runs`` are all of them by
    start and period, ``collapsed`` the words left when each run is cut down to
    its first period, joined by a space.

    With ``seed``, a number h per row, a row with h % 10 = 0 is made periodic
    first: words from a on repeat the first p of them, where g = h / 10 in whole
    numbers, a = g % n and p = 1 + (n - a) / (3 + g % 8) for n words. A null
    seed leaves the text as it is.

    A null text has no words and so no run; so has an empty one. Repeated rows
    and null ids are each answered, other columns are ignored, an empty table
    gives an empty result. Texts are answered one by one, so memory grows with the
    longest stretch of frequent words of one text, about 1 kB a word of it.
    """
    names = [part.split()[0] for part in COLUMNS.split(", ")][:9]
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def answer(text: str | None, h: int | None) -> tuple:
        words = WORD.findall(text or "")
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            words = spread(words, a, 1 + (n - a) // (3 + g % 8))
        runs = word_runs(words, rules)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        collapsed = " ".join(collapse(words, runs))
        return (
            len(words), len(runs), start, length, period, None if length is None else 1000 * length // period,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest(),
            [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [*[pa.int64()] * 6, pa.string(), pa.string(), run_type, pa.string()]
        for batch in batches:
            rows = [answer(t, h) for t, h in zip(batch.column("text").to_pylist(), batch.column("seed").to_pylist())]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [*names, "runs", "collapsed"])

    seed = F.lit(None) if seed is None else seed
    return docs.select("doc_id", "text", seed.cast("long").alias("seed")).mapInArrow(run, COLUMNS)
