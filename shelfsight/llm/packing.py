"""Packing documents into fixed windows of tokens, in order."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfsight.llm.tokens import batches, encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class PackRules:
    """Costs, in tokens of padding, of a cut after a sentence and of one elsewhere in a document."""

    window: int = 1024
    end_id: int = 0
    sentence_cut: float = 0.25
    free_cut: float = 1.0
    runs: int = 5  # full windows with free cuts between two places, at most, and one more
    horizon: int = 128  # windows looked at together
    settle: int = 8  # windows at the end of a horizon that are decided again with the next one


def cuts(places: list[int], prices: list[float], rules: PackRules, start: int = 0) -> list[int]:
    """Where the sequences end that cover ``start`` up to the last place at the least cost.

    A sequence ends at a place, for its price, or full, for the price of a free
    cut. With f(i) the least cost up to place i, c its position and k the full
    sequences in between,

        f(j) = price(j) + min over k and k w < c(j) - c(i) <= (k + 1) w
                          of f(i) + k free + (k + 1) w - (c(j) - c(i))

    For each k that is a sliding minimum of f(i) + c(i), kept in a monotone
    queue, so the work is linear in the places. Over a longer gap only its
    start can be the place before.
    """
    w, free = rules.window, rules.free_cut
    at, key, cost, back = [start, *places], [float(start)], [0.0], [-1]
    # Of each queue: its indices, the first index not yet let in, the distances between which one stays, the rest of the cost.
    queues = [[deque(), 0, k * w, (k + 1) * w, (k + 1) * w + k * free] for k in range(rules.runs + 1)]
    for j in range(1, len(at)):
        here, best, origin = at[j], float("inf"), -1
        for queue in queues:
            inside, enter, least, most, rest = queue
            until = here - least
            while enter < j and at[enter] < until:
                value = key[enter]
                while inside and key[inside[-1]] >= value:
                    inside.pop()
                inside.append(enter)
                enter += 1
            queue[1] = enter
            until = here - most
            while inside and at[inside[0]] < until:
                inside.popleft()
            if inside and key[inside[0]] + rest < best:
                best, origin = key[inside[0]] + rest, inside[0]
        best -= here
        if origin < 0:
            gap = here - at[j - 1]
            full = -(-gap // w)
            best, origin = cost[j - 1] + full * w - gap + (full - 1) * free, j - 1
        best += prices[j - 1]
        cost.append(best)
        key.append(best + here)
        back.append(origin)
    ends, j = [], len(at) - 1
    while j > 0:
        lo, hi = at[back[j]], at[j]
        ends.append([*range(lo + w, hi, w), hi])
        j = back[j]
    return [e for part in reversed(ends) for e in part]


def sentence_ends(ids: np.ndarray, closes: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Positions after a token that closes a sentence and before one that starts with white space."""
    return np.flatnonzero(closes[ids[:-1]] & opens[ids[1:]]) + 1


class Packer:
    """Takes documents in order, gives the pieces of the sequences as they are settled."""

    def __init__(self, rules: PackRules, closes: np.ndarray, opens: np.ndarray, first_sequence: int):
        self.rules, self.closes, self.opens, self.sequence = rules, closes, opens, first_sequence
        self.docs: list[list] = []  # id, tokens of the document, tokens already placed, the other ids
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append([doc_id, len(ids), 0, ids])
        self.held += len(ids)
        if self.held >= self.rules.horizon * self.rules.window:
            self._place(self._plan()[: -self.rules.settle])

    def _plan(self) -> list[int]:
        places, prices, base = [], [], 0
        for _, _, _, ids in self.docs:
            inner = sentence_ends(ids, self.closes, self.opens)
            places += (inner + base).tolist()
            prices += [self.rules.sentence_cut] * len(inner)
            base += len(ids)
            places.append(base)
            prices.append(0.0)
        return cuts(places, prices, self.rules)

    def finish(self) -> None:
        """The rest. The last sequence is cut into powers of two, which need no padding."""
        if not self.docs:
            return
        ends = self._plan()
        lo = ends[-2] if len(ends) > 1 else 0
        left = ends.pop() - lo
        for bit in range(left.bit_length() - 1, -1, -1):
            if left >> bit & 1:
                lo += 1 << bit
                ends.append(lo)
        self._place(ends)

    def _place(self, ends: list[int]) -> None:
        lo, queue = 0, deque(self.docs)
        for hi in ends:
            offset = 0
            while lo < hi:
                doc = queue[0]
                take = min(hi - lo, len(doc[3]))
                piece, doc[3] = doc[3][:take], doc[3][take:]
                self.rows.append((doc[0], doc[2], take, zlib.crc32(piece.tobytes()), doc[1], self.sequence, offset))
                doc[2] += take
                offset += take
                lo += take
                if not len(doc[3]):
                    queue.popleft()
            self.sequence += 1
        self.docs = list(queue)
        self.held -= ends[-1] if ends else 0


def pack(docs: DataFrame, tokenizer: str, rules: PackRules = PackRules()) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of the packed documents.

    A document is its ids by the file ``tokenizer`` (no tokens added) and the
    end id. The rows of a partition are packed in their order, into sequences
    of at most ``window`` ids; each id is in one piece. Cuts fall at the ends of
    documents, at sentences or, at the highest price, anywhere, so that padding
    and prices together are least (:func:`cuts`). Nothing is shuffled; the last
    sequence of a partition is cut into powers of two instead of being padded.

    A null or empty text is the end id alone. Repeated rows are packed each
    time, null ids are passed through, other columns ignored; an empty table
    gives no rows. A sequence number holds the partition in its upper bits.
    """
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        size = max(enc.library.get_vocab().values()) + 2
        closes, opens = np.zeros(size, bool), np.zeros(size, bool)
        for token, number in enc.library.get_vocab().items():
            closes[number] = token.endswith((".", "!", "?", "Ċ"))
            opens[number] = token.startswith(("Ġ", "Ċ", "č"))
        end = np.array([rules.end_id], "<u4")
        packer = Packer(rules, closes, opens, TaskContext.get().partitionId() << 33)

        names = [c.split()[0] for c in PIECES.split(", ")]
        types = [pa.int64()] * len(names)

        def settled() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for frame in frames:
            texts, ids = frame.column("text").to_pylist(), frame.column("doc_id").to_pylist()
            for lo, hi in batches(map(len, texts), 4 << 20):
                for name, text in zip(ids[lo:hi], texts[lo:hi]):
                    packer.add(name, np.concatenate([enc.encode(text), end]))
                yield settled()
        packer.finish()
        yield settled()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, PIECES)
