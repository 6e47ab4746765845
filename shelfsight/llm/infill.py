"""Fill-in-the-middle examples: a text cut in three at word ends, its parts put in another order between markers.

The places of the cuts are numbers of units; a unit is a word with the white
space before it, or the white space after the last word. A Fenwick tree over
blocks of the text holds how many units end in them and how many code points
they have. A descent from the largest power of two finds the block in which the
k-th unit ends, and the end itself is looked up in that block only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACES = frozenset(" \t\n\x0b\x0c\r")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN, SUFFIX_FIRST, PREFIX_FIRST = "plain", "spm", "psm"
COLUMNS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, output string"
)


@dataclass(frozen=True)
class InfillRules:
    """``rate`` of 100 texts are cut; of these ``suffix_first`` of 100 start with the suffix. ``seed`` precedes the id that is hashed."""

    seed: str = "42:"
    rate: int = 50
    suffix_first: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    block: int = 1024  # code points

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class UnitTree:
    """The ends of the units of a text, found by their number."""

    def __init__(self, text: str, block: int = 1024):
        self.text, self.block = text, block
        size = -(-len(text) // block)
        self.units, self.chars = [0] * (size + 1), [0] * (size + 1)
        for b in range(size):
            ends = self._ends(b)
            self._add(b + 1, len(ends), min(block, len(text) - b * block))
        self.size = size
        self.count = self._sum(size)[0]

    def _ends(self, b: int) -> list[int]:
        """Where units end within a block, counted from its start; the place behind the block's last code point is within."""
        lo, hi = b * self.block, min((b + 1) * self.block, len(self.text))
        ends = [m.end() for m in WORD.finditer(self.text[lo:hi])]
        if hi == len(self.text):
            if self.text[hi - 1] in SPACES:
                ends.append(hi - lo)
        elif ends and ends[-1] == hi - lo and self.text[hi] not in SPACES:
            ends.pop()  # the word goes on in the next block
        return ends

    def _add(self, at: int, units: int, chars: int) -> None:
        while at < len(self.units):
            self.units[at] += units
            self.chars[at] += chars
            at += at & -at

    def _sum(self, at: int) -> tuple[int, int]:
        units = chars = 0
        while at:
            units, chars, at = units + self.units[at], chars + self.chars[at], at & (at - 1)
        return units, chars

    def end(self, k: int) -> int:
        """The code points up to the end of the k-th unit, counted from 1; 0 for k = 0."""
        if k == 0:
            return 0
        at = chars = 0
        step = 1 << self.size.bit_length()
        while step:  # the last block before which fewer than k units end
            if at + step <= self.size and self.units[at + step] < k:
                at += step
                k -= self.units[at]
                chars += self.chars[at]
            step >>= 1
        return chars + self._ends(at)[k - 1]


def arrange(text: str, cuts: tuple[int, int], form: str, rules: InfillRules) -> str:
    """The text in an order of its parts; ``cuts`` are code points."""
    lo, hi = cuts
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if form == PREFIX_FIRST:
        return f"{rules.prefix}{prefix}{rules.suffix}{suffix}{rules.middle}{middle}"
    if form == SUFFIX_FIRST:
        return f"{rules.suffix}{suffix}{rules.prefix}{prefix}{rules.middle}{middle}"
    return text


def restore(output: str, form: str, rules: InfillRules) -> str:
    """The text that ``arrange`` was given. A marker stands once in an arranged text, so each is found by searching."""
    if form == PREFIX_FIRST:
        prefix, rest = output.removeprefix(rules.prefix).split(rules.suffix, 1)
        suffix, middle = rest.split(rules.middle, 1)
    elif form == SUFFIX_FIRST:
        suffix, rest = output.removeprefix(rules.suffix).split(rules.prefix, 1)
        prefix, middle = rest.split(rules.middle, 1)
    else:
        return output
    return prefix + middle + suffix


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def infill(docs: DataFrame, rules: InfillRules = InfillRules()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, output) of every row.

    Four numbers are the first 32 hexadecimal digits of the hash of ``seed``
    and the id, in eights. The first two, modulo n + 1, are the units before the
    cuts; the third, modulo 100, tells whether the text is cut, the fourth in
    which order. A text that is empty or holds a marker stays ``plain``; its
    lengths of prefix and middle are null. ``restored_sha256`` is of the text
    rebuilt from the output and the form.

    A null text is an empty one. A null id is hashed as no digits. Repeated rows
    are each answered alike, other columns are ignored, an empty table gives an
    empty result. Any length of text: memory is a few times its size.
    """
    def answer(text: str, digits: str) -> tuple:
        h = [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]
        tree = UnitTree(text, rules.block)
        n = tree.count
        if not text or any(m in text for m in rules.markers) or h[2] % 100 >= rules.rate:
            return n, PLAIN, None, None, _hex(text), _hex(restore(text, PLAIN, rules)), text
        form = SUFFIX_FIRST if h[3] % 100 < rules.suffix_first else PREFIX_FIRST
        lo, hi = (tree.end(k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        output = arrange(text, (lo, hi), form, rules)
        return n, form, lo, hi - lo, _hex(output), _hex(restore(output, form, rules)), output

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = [part.split()[0] for part in COLUMNS.split(", ")]
        for batch in batches:
            rows = [answer(t, d) for t, d in zip(batch.column("text").to_pylist(), batch.column("digits").to_pylist())]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    digits = F.sha2(F.concat(F.lit(rules.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.substring(digits, 1, 32).alias("digits")).mapInArrow(run, COLUMNS)
