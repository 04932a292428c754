"""Benchmark decontamination by pigeonhole edit matching.

An item of length m with k allowed edits is cut into k + 1 pieces. Where a text
holds the item with at most k edits, one piece at least is there unchanged. An
Aho-Corasick automaton finds all piece hits; each hit says where the item would
lie, and Myers' bit-parallel algorithm computes the smallest distance in that
stretch. Pieces are the leaves of a tree of halves: k errors leave one half at
most a or the other at most b of a + b = k - 1, so a hit is first checked
against the small stretches above its piece, and most chance hits end there. Case
and runs of white space are levelled on both sides; matches are told in places of
the text as it is. Items under WHOLE characters are in many words by chance, so
they are searched with a blank at each end: only whole words match them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, texts

ERROR_RATE = 0.1
WHOLE = 20
BLOCK_CHARS = 2_000_000


def levelled(text: str) -> str:
    return " ".join(text.casefold().split())


def pieces(item: str, budget: int) -> list[tuple[int, str, list[tuple[int, int, int]]]]:
    """(offset, piece, stretches above it but for the whole, smallest first) of ``budget`` + 1 pieces.

    A stretch is (begin, end, errors) within the item.
    """
    out = []

    def halved(a: int, z: int, k: int, above: list[tuple[int, int, int]]) -> None:
        if k == 0:
            out.append((a, item[a:z], above))
            return
        left = (k - 1) // 2
        cut = a + (z - a) * (left + 1) // (k + 1)
        above = [(a, z, k), *above] if (a, z) != (0, len(item)) else above
        halved(a, cut, left, above)
        halved(cut, z, k - 1 - left, above)

    halved(0, len(item), budget, [])
    return out


def best_distance(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any stretch of ``text``, and where the first such ends.

    ``anchored`` asks for stretches that begin where the text begins.
    """
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top, low = (1 << m) - 1, 1 << m - 1, int(anchored)
    pv, mv, score, best, end = full, 0, m, m, 0
    get = peq.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, j
        ph = ph << 1 | low
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
    return best, end


def places(text: str) -> list[int]:
    """For each character of the levelled text the place in ``text`` it comes from, and the end after the last."""
    out: list[int] = []
    gap = False
    for i, c in enumerate(text):
        if c.isspace():
            gap = True
            continue
        if gap and out:
            out.append(out[-1] + 1)
        gap = False
        out += [i] * len(c.casefold())
    return out


class Matcher:
    """The pieces of one block of items, and the search for them in a text."""

    def __init__(self, items: list[tuple[int | None, str, int]]):
        self.items = items  # (item_id, levelled text, budget); ids need not be different or there
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int, list[tuple[str, int, int]]]]] = {}
        for n, (_, text, budget) in enumerate(items):
            for offset, piece, above in pieces(text, budget):
                where.setdefault(piece, []).append((n, offset, [(text[a:z], a, k) for a, z, k in above]))
        for piece, spots in where.items():
            self.automaton.add_word(piece, (len(piece), spots))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def _spots(self, text: str) -> dict[int, list[int]]:
        """Item number to the places where it would begin, for the piece hits that stand up to a first look."""
        spots: dict[int, list[int]] = {}
        for last, (size, hits) in self.automaton.iter(text):
            begin = last + 1 - size
            for n, offset, above in hits:
                spot = begin - offset
                near = spots.get(n)
                if near and abs(spot - near[-1]) <= offset + len(self.items[n][1]):
                    near.append(spot)  # next to a stretch that is searched anyway: no look of its own
                    continue
                for part, a, k in above:
                    lo = spot + a - k
                    if best_distance(part, text[max(0, lo) : spot + a + len(part) + k])[0] > k:
                        break
                else:
                    spots.setdefault(n, []).append(spot)
        return spots

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, begin, end) of each item's best match, the first of equals, in places of ``text``."""
        if self.empty:
            return []
        level = f" {levelled(text)} "
        out = []
        where: list[int] = []
        for n, begins in self._spots(level).items():
            _, pattern, budget = self.items[n]
            best = None
            for lo, hi in _merged(sorted(begins), len(pattern), budget):
                lo = max(0, lo)
                d, end = best_distance(pattern, level[lo:hi])
                if d <= budget and (best is None or d < best[0]):
                    best = d, lo, lo + end
            if best:
                d, lo, end = best
                _, back = best_distance(pattern[::-1], level[lo:end][::-1], anchored=True)
                where = where or [0, *places(text), len(text)]  # the blank at each end is its own place
                begin, last = end - back, end - 1
                while begin < last and level[begin] == " ":
                    begin += 1
                while begin < last and level[last] == " ":
                    last -= 1
                out.append((n, d, where[begin], where[last] + 1))
        return out

    def holds(self, text: str) -> bool:
        return bool(self.find(text))


def _merged(begins: list[int], m: int, budget: int) -> Iterator[tuple[int, int]]:
    """Stretches of the text that hold every match near the places hit, joined where they overlap."""
    lo = hi = None
    for b in begins:
        a, z = b - budget, b + m + budget
        if hi is not None and a <= hi:
            hi = max(hi, z)
        else:
            if hi is not None:
                yield lo, hi
            lo, hi = a, z
    if hi is not None:
        yield lo, hi


def prepared(text: str, error_rate: float) -> tuple[str, int]:
    """An item as it is searched, and its budget; short ones have a blank at each end."""
    text = levelled(text)
    budget = int(len(text) * error_rate)
    return (f" {text} " if len(text) < WHOLE else text), budget


def item_blocks(benchmark: DataFrame, error_rate: float) -> Iterator[list[tuple[int | None, str, int]]]:
    """The stated query set in blocks of about BLOCK_CHARS characters, read one block at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string")).where(F.trim("text") != "").toLocalIterator():
        text, budget = prepared(r.text, error_rate)
        if not text.strip():
            continue
        block.append((r.item_id, text, budget))
        size += len(text)
        if size > BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """One row (doc_id, item_id, distance, allowed, begin, end) per document row and item it holds.

    ``begin`` and ``end`` (exclusive) are code points of the text. All items are
    searched, whatever their length; an item with a null id keeps the null, of
    items with one id each is answered. Null and blank items are in no text.
    Null texts hold nothing; a null doc_id keeps its rows; repeated rows are
    answered each; columns of any other name are ignored. Empty tables give no
    rows. The documents are not shuffled: each block of items is sent to them.
    """
    sc = docs.sparkSession.sparkContext
    docs = texts(docs)

    def searched(block: list[tuple[int | None, str, int]]) -> DataFrame:
        sent = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for batch in batches:
                rows = []
                for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    rows += [(doc, sent.value[n][0], d, sent.value[n][2], a, z) for n, d, a, z in matcher.find(t.as_py())]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "distance", "allowed", "begin", "end"])

        return docs.mapInArrow(run, SCHEMA)

    parts = [searched(b) for b in item_blocks(benchmark, error_rate)]
    return reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], SCHEMA)


def without_items(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of ``benchmark``; nothing is shuffled.

    Rows are judged one by one: null ids, repeated rows and null texts stay as
    they are, and an empty table or an empty benchmark takes nothing away.
    """
    at = docs.columns.index("text")

    def cleaned(rows: DataFrame, block: list[tuple[int | None, str, int]]) -> DataFrame:
        sent = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.holds(t.as_py() or "") for t in batch.column(at)], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return reduce(cleaned, item_blocks(benchmark, error_rate), docs)


SCHEMA = "doc_id long, item_id long, distance int, allowed int, begin int, end int"


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
