"""Near copies by word shingles: candidates from covering SimHash and MinHash bands, then an exact Jaccard check.

Two texts are near copies if their sets of five-word shingles (lowered words; a
shorter text is one shingle) have a Jaccard similarity of at least 0.8. Equal
word sequences are merged first, so texts without words are copies of each other.

The first candidates are those of the covering SimHash operator: fingerprints of
the five-word shingles within its radius of three bits. At a similarity of 0.8
fingerprints differ at about ten of 64 bits, and masks that cover such a radius
would be as many as the pairs, so a second source takes what lies further apart:
a pair at 0.8 shares none of 40 bands of 6 minima with probability
(1 - 0.8^6)^40, under 6 in a million, and one above it less often.

Buckets are not compared all with all. Their members are checked against a
leader, and what is linked is joined into components; where several components
still meet in a bucket, its texts are brought together and the members of
different ones compared by their rarest shingles. The components are thus those
of all candidate pairs, however full a bucket is, and the links of a bucket are
fewer than its members.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import free_name, lowered_words, staged
from .components import connected_components

WIDTH = 5
BANDS, ROWS = 40, 6
SEED = 42
ROW = "__row"
_RNG = np.random.default_rng(SEED)
_MIX = _RNG.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)[:, None]
_ODD = (_RNG.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1))[:, None]
_SALTS = _RNG.integers(0, 1 << 64, 4, dtype=np.uint64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 4096


def shingles(words: list[bytes], width: int = WIDTH) -> set[bytes]:
    """The sets of ``width`` neighbouring words; a shorter text is one shingle, a text without words none."""
    k = min(width, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def near(a: set[bytes], b: set[bytes]) -> bool:
    """Jaccard similarity of at least 0.8, in whole numbers."""
    return 9 * len(a & b) >= 4 * (len(a) + len(b))


def gram_hashes(grams: set[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype=np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed 64-bit key a band from the hashes of the shingles; the band's number is part of it."""
    minima = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _SLICE):
        np.minimum(minima, ((hashes[None, at : at + _SLICE] ^ _MIX) * _ODD).min(axis=1), out=minima)
    data, step = minima.tobytes(), ROWS * 8
    return np.array([xxhash.xxh64_intdigest(data[i * step : (i + 1) * step], i) for i in range(BANDS)], dtype=np.uint64).view(np.int64).tolist()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, doc_id, text) to (row, doc_id, node, n, fp, bands): node names the word sequence, n counts its shingles, fp is their SimHash."""
    for batch in batches:
        nodes, sizes, prints, bands = [], [], [], []
        for t in batch.column(2).cast(pa.binary()).to_pylist():
            words = lowered_words(t or b"")
            grams = shingles(words)
            nodes.append(xxhash.xxh64_intdigest(b" ".join(words), SEED + 1))
            sizes.append(len(grams))
            hashes = gram_hashes(grams)
            prints.append(simhash.majority(hashes))
            bands.append(band_keys(hashes) if grams else [])
        columns = [batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, [ROW, "doc_id", "node", "n", "fp", "bands"])


def _by_bucket(body: Callable[..., Iterator[pa.RecordBatch]]):
    """Over rows sorted by their first column: ``body`` on the columns of whole buckets, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = columns[0]
            if held and keys[0] != held[-1][0][-1]:
                yield from body(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            cut = int(np.searchsorted(keys, keys[-1]))  # where the last bucket starts
            if cut:
                yield from body(*map(np.concatenate, zip(*held, [c[:cut] for c in columns], strict=True)))
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield from body(*map(np.concatenate, zip(*held, strict=True)))

    return run


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def _led(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The members of buckets of two nodes or more, each with the bucket's leader."""
    starts = _starts(keys)
    lengths = np.diff(np.r_[starts, len(keys)])
    order = (nodes.view(np.uint64) ^ _SALTS[keys & 3]) * _SPREAD
    first = order == np.repeat(np.minimum.reduceat(order, starts), lengths)
    several = np.repeat(lengths > 1, lengths)
    leader, leader_n = (np.repeat(c[first], lengths) for c in (nodes, sizes))
    columns = [pa.array(c[several]) for c in (keys, nodes, sizes, leader, leader_n)]
    yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "leader", "leader_n"])


def _forest(roots: list[int], texts: list[str]) -> list[tuple[int, int]]:
    """Links (positions) that join the near copies among members of different components, none to spare.

    A member at 0.8 shares one at least of any member's rarest fifth of shingles
    and one more, so only who holds one of these is compared.
    """
    ids: dict[bytes, int] = {}
    sets = [{ids.setdefault(g, len(ids)) for g in shingles(lowered_words(t.encode()))} for t in texts]
    holders: list[list[int]] = [[] for _ in ids]
    for i, grams in enumerate(sets):
        for g in grams:
            holders[g].append(i)
    above = {r: r for r in roots}
    size = Counter(roots)
    most = max(size, key=size.get)

    def top(r: int) -> int:
        while above[r] != r:
            above[r] = r = above[above[r]]
        return r

    links = []
    for i, grams in enumerate(sets):
        if roots[i] == most:  # the other member of a pair asks
            continue
        rare = sorted(grams, key=lambda g: len(holders[g]))[: len(grams) - -(-4 * len(grams) // 5) + 1]
        for j in dict.fromkeys(j for g in rare for j in holders[g]):
            x, y = top(roots[i]), top(roots[j])
            if x != y and near(grams, sets[j]):
                above[max(x, y)] = min(x, y)
                links.append((i, j))
    return links


def _bridges(keys: np.ndarray, roots: np.ndarray, nodes: np.ndarray, texts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between components that meet in a bucket."""
    starts = [*_starts(keys).tolist(), len(keys)]
    found = [(int(nodes[lo + i]), int(nodes[lo + j])) for lo, hi in zip(starts, starts[1:], strict=False) for i, j in _forest(roots[lo:hi].tolist(), texts[lo:hi].tolist())]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text of a, text of b) to the pairs that are near copies; neighbours with one text share its shingles."""
    known: dict[int, tuple[int | None, set[bytes]]] = {0: (None, set()), 1: (None, set())}

    def grams(side: int, node: int, column: pa.Array, i: int) -> set[bytes]:
        if known[side][0] != node:
            known[side] = (node, shingles(lowered_words(column[i].as_py())))
        return known[side][1]

    for batch in batches:
        ids = [batch.column(c).to_pylist() for c in (0, 1)]
        sides = [batch.column(c).cast(pa.binary()) for c in (2, 3)]
        kept = [near(grams(0, a, sides[0], i), grams(1, b, sides[1], i)) for i, (a, b) in enumerate(zip(*ids, strict=True))]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept, pa.bool_())), batch.column(1).filter(pa.array(kept, pa.bool_()))], ["a", "b"])


def near_links(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose texts, rows (node, text), are near copies."""
    both = pairs.join(bodies.toDF("a", "first"), "a").join(bodies.toDF("b", "second"), "b")
    return staged(both.select("a", "b", "first", "second").mapInArrow(_alike, "a long, b long"), "near-links")


def covering_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, fp) from the covering SimHash operator: of equal fingerprints, and of linked ones."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    alike = nodes.join(first, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = simhash.near_links(first.select("fp"))
    ends = links.join(first.toDF("a", "x"), "a").join(first.toDF("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return alike.union(ends)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns: of each group of near copies the row with the smallest doc_id.

    Rows are told apart by a key of their own, so one with a null doc_id stays
    unless its text has a copy; it is kept last. A null text counts as empty.
    Of repeated rows one stays. An empty table gives no rows.
    """
    key = free_name(docs.columns, ROW)
    rows = staged(docs.withColumn(key, F.monotonically_increasing_id()), "near-rows")
    keyed = rows.select(F.col(key).alias(ROW), "doc_id", F.col("text").cast("string").alias("text"))
    own = staged(keyed.mapInArrow(_signatures, f"{ROW} long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, n int, fp long, bands array<long>"), "near-own")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", ROW)
    nodes = staged(own.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min(order).alias("best")), "near-nodes")

    dealt = nodes.select(F.explode("bands").alias("key"), "node", "n").repartition("key").sortWithinPartitions("key")
    live = staged(dealt.mapInArrow(_by_bucket(_led), "key long, node long, n int, leader long, leader_n int"), "near-live")
    alike = 5 * F.least("n", "leader_n") >= 4 * F.greatest("n", "leader_n")
    led = live.where("node <> leader").where(alike).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    pairs = staged(led.union(covering_pairs(nodes.where("n > 0").select("node", "fp"))).distinct(), "near-pairs")
    seen = live.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    shown = seen.join(nodes.select("node", F.col(f"best.{ROW}").alias(ROW)), "node")
    bodies = staged(keyed.select(ROW, "text").join(shown, ROW).select("node", F.coalesce("text", F.lit("")).alias("text")), "near-bodies")
    links = near_links(pairs, bodies)

    roots = connected_components(links)
    placed = live.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"), "node")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    meeting = placed.join(mixed, "key").join(bodies, "node").select("key", "root", "node", "text")
    meeting = meeting.repartition("key").sortWithinPartitions("key")
    more = staged(meeting.mapInArrow(_by_bucket(_bridges), "a long, b long"), "near-bridges")
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    firsts = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    return rows.join(firsts.select(F.col(f"best.{ROW}").alias(key)), key, "left_semi").select(*docs.columns)
