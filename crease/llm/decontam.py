"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared as lower-case words joined by single blanks.
An item of m characters may be met with up to ``k = floor(rate * m)`` edits
(insertions, deletions, substitutions).  It is cut into ``k + 1`` pieces: k edits
leave at least one piece untouched, so every match has an exact piece hit, found
by one Aho-Corasick pass over the text with the pieces of all items.  Each hit
fixes where in the text the item would lie, and Myers' bit-parallel algorithm
(Myers 1999, in Hyyro's form) gives the edit distance there.

Chance hits of short pieces end early (Navarro and Baeza-Yates, 1999): the pieces
are paired up in a tree.  If every child of a node had at least as many edits as
pieces, so would the node; so in a match, with fewer edits than pieces in all,
some piece has at every node above it fewer edits than pieces there.  A hit is
compared node by node upwards and given up at the first that fails.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from crease.llm.text import forget_in_worker
from crease.session import materialize

RATE = 0.08           # edits allowed per character of an item
ITEM_BYTES = 1 << 19  # bytes of test items that a task matches at once (its automaton takes some hundred times that)
MIN_CHARS = 30        # items shorter than this after normalising are met exactly, as whole words
_WORDS = re.compile(r"[^\W_]+")
_ASCII = re.compile(r"[a-z0-9]+")
#: ASCII only: capitals as small letters, everything but letters and digits as blanks
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def normalise(text: str | None) -> str:
    """Words (runs of letters and digits) in lower case, joined by single blanks."""
    if not text:
        return ""
    if text.isascii():
        return " ".join(text.encode().translate(_TABLE).decode().split())
    return " ".join(_WORDS.findall(text.lower()))


def positions(pattern: str) -> dict[str, int]:
    """For each character of the pattern, the bits of its places."""
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    return eq


def myers(eq: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of a whole pattern in ``text``, at most
    ``limit`` edits (the first of the best ends), or None.  The match may begin
    anywhere.  The pattern is given by its ``positions`` and length ``m`` > 0."""
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        x = eq.get(c, 0)
        xv = x | mv
        xh = (((x & pv) + pv) ^ pv) | x
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score <= limit and (best is None or score < best[0]):
                best = (score, j + 1)
                if score == 0:
                    return best
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best


class Matcher:
    """All test items as one automaton of pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items: list[tuple] = []
        pieces: dict[str, list] = {}
        for number, text in items:
            norm = normalise(text)
            if not norm:
                continue
            k = int(rate * len(norm)) if len(norm) >= MIN_CHARS else 0
            cuts = [round(i * len(norm) / (k + 1)) for i in range(k + 2)]
            paths = self._paths(norm, cuts, 0, k + 1)
            for i, path in enumerate(paths):
                pieces.setdefault(norm[cuts[i]:cuts[i + 1]], []).append((len(self.items), cuts[i], path))
            self.items.append((number, norm, k, positions(norm[::-1])))
        self.automaton = None
        if pieces:
            self.automaton = ahocorasick.Automaton()
            for piece, where in pieces.items():
                self.automaton.add_word(piece, (len(piece), where))
            self.automaton.make_automaton()

    def _paths(self, norm: str, cuts: list[int], lo: int, hi: int) -> list[list[tuple]]:
        """For each piece lo..hi-1 the nodes above it, the smallest first; a node is
        (positions, length, offset in the item, edits allowed)."""
        node = (positions(norm[cuts[lo]:cuts[hi]]), cuts[hi] - cuts[lo], cuts[lo], hi - lo - 1)
        if hi - lo == 1:
            return [[node]]
        mid = (lo + hi) // 2
        return [[*path, node] for path in self._paths(norm, cuts, lo, mid) + self._paths(norm, cuts, mid, hi)]

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best match of each item met, in the
        normalised text; ``start`` is the latest start that gives that distance."""
        if self.automaton is None:
            return []
        norm = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        for last, (size, where) in self.automaton.iter(norm):
            for at, offset, path in where:
                number, item, k, _ = self.items[at]
                if at in best and best[at][0] == 0:
                    continue
                begin = last + 1 - size - offset            # where the item would begin without edits
                got = (0, begin + len(item)) if k == 0 else None
                for eq, m, o, edits in path[1:]:
                    lo = max(0, begin + o - edits)
                    got = myers(eq, m, norm[lo:begin + o + m + edits], edits)
                    if got is None:
                        break
                    got = (got[0], lo + got[1])
                if got is None or at in best and got[0] >= best[at][0]:
                    continue
                if len(item) < MIN_CHARS and not self._whole(norm, begin, begin + len(item)):
                    continue
                best[at] = got
        out = []
        for at, (distance, end) in sorted(best.items()):
            number, item, k, reverse = self.items[at]
            back = myers(reverse, len(item), norm[max(0, end - len(item) - k):end][::-1], distance)
            out.append((number, distance, end - back[1], end))
        return out

    @staticmethod
    def _whole(norm: str, start: int, end: int) -> bool:
        return (start == 0 or norm[start - 1] == " ") and (end == len(norm) or norm[end] == " ")


def _blocks(benchmark: DataFrame, item_bytes: int) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """How many blocks of about ``item_bytes`` the test items make, and the blocks in
    turn.  So driver and tasks hold one block at a time, however large the benchmark."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / item_bytes))
    return n, (sorted((r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect())
               for k in range(n))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
               text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per document and item met: ``doc_id, item_id, distance, start, end``.

    Positions count characters of the normalised text, end exclusive.  Null or
    empty texts and items meet nothing; an item_id with several texts is met by
    any of them (a row for each text met); repeated rows are matched each for
    itself.  No items or no documents: no rows.  The items pass in blocks, each over
    all documents; the results of several blocks are written one after the other.
    """
    blocks, items = _blocks(benchmark, item_bytes)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = []
    for block in items:
        got = texts.mapInArrow(_finder(block, rate), "doc_id long, item_id long, distance long, start long, end long")
        found.append(materialize(got, "leaks") if blocks > 1 else got)
    return reduce(DataFrame.union, found)


def _finder(items: list[tuple[int, str]], rate: float):
    def run(batches):
        forget_in_worker()
        matcher = Matcher(items, rate)
        for b in batches:
            rows = [(d, *hit) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                    for hit in matcher.find(t)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "item_id", "distance", "start", "end"])

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
               item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows that meet no item, with the columns they had.  The items pass in blocks;
    what a block leaves is written before the next."""
    name = "__leaks"
    while name in docs.columns:                   # a column of that name in the input is kept
        name += "_"
    schema = StructType(list(docs.schema)).add(name, LongType())
    blocks, items = _blocks(benchmark, item_bytes)
    for k, block in enumerate(items):
        docs = docs.mapInArrow(_counter(block, rate, text_col, name), schema).where(F.col(name) == 0).drop(name)
        if k < blocks - 1:
            docs = materialize(docs, "leaks-left")
    return docs


def _counter(items: list[tuple[int, str]], rate: float, text_col: str, name: str):
    def run(batches):
        forget_in_worker()
        matcher = Matcher(items, rate)
        for b in batches:
            at = b.schema.get_field_index(text_col)
            hits = pa.array([len(matcher.find(t)) for t in b.column(at).to_pylist()], pa.int64())
            yield b.append_column(name, hits)

    return run
