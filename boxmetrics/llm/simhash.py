"""SimHash near-duplicates found with covering locality-sensitive hashing.

A covering family for radius 3 has a mask for each nonzero vector v of F2^4.
Bit position i carries a vector c(i) of F2^4; mask v keeps the positions with
<c(i), v> = 1. At most three differing positions give at most three linear
conditions, so some nonzero v is orthogonal to all of them: under that mask
both fingerprints are equal. No pair within the radius is missed. The masks
are balanced: each keeps exactly half of the open positions.

Fingerprints are made distinct before the tables are built. A bucket that is
too large for comparing its members is not compared: its members go on to the
masks of the next level, which split the positions still open (64, 32, 16, 8),
so a bucket of the third level can hold 256 fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowered_words, staged, texts
from .components import connected_components

SEED = 42
WIDTH = 3
RADIUS = 3
BUCKET = 1024
_VECTORS = 1 << (RADIUS + 1)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(data: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """SimHash of UTF-8 bytes: a bit is 1 if set in over half of the shingles' hashes; 0 without words."""
    words = lowered_words(data)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    k = min(width, len(words))
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    return majority(np.array([digest(view[a:b], seed) for a, b in zip(starts, ends[k - 1 :], strict=False)], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the 64-bit hashes; 0 without any."""
    columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row (doc_id, fp long) per row of ``docs``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).cast(pa.binary()).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def covering_masks(fixed: int = 0) -> list[int]:
    """The masks of the covering family over the positions not in ``fixed``, each joined with ``fixed``."""
    open_bits = [i for i in range(64) if not fixed >> i & 1]
    out = []
    for v in range(1, _VECTORS):
        keep = (1 << i for j, i in enumerate(open_bits) if ((j % _VECTORS) & v).bit_count() & 1)
        out.append(fixed | sum(keep))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between members of one bucket: each member to the smallest one it reaches, itself left out."""
    near = np.bitwise_count(run[:, None] ^ run[None, :]) <= radius
    label = np.arange(len(run))
    while True:
        low = np.where(near, label[None, :], len(run)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(run)))
    return run[moved], run[label[moved]]


def _bucket_links(radius: int, limit: int):
    """Over rows sorted by (mask, key, fp): links of each bucket, or its members under the next masks."""

    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

    def deeper(mask: np.uint64, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        for m in covering_masks(int(mask)):
            yield rows(1, members, np.full(len(members), m, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = key = None
        held = np.empty(0, np.uint64)
        over = False

        def close() -> Iterator[pa.RecordBatch]:
            if over:
                if len(held):
                    yield from deeper(mask, held)
            elif len(held) > 1:
                a, b = _forest(held, radius)
                if len(a):
                    yield rows(0, a, b)

        for batch in batches:
            if not batch.num_rows:
                continue
            ms, fps = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            keys = ms & fps
            cuts = np.flatnonzero((ms[1:] != ms[:-1]) | (keys[1:] != keys[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(ms)]
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if lo or mask is None or ms[0] != mask or keys[0] != key:
                    yield from close()
                    mask, key, held, over = ms[lo], keys[lo], np.empty(0, np.uint64), False
                held = np.concatenate([held, fps[lo:hi]]) if len(held) else fps[lo:hi]
                if over or len(held) > limit:
                    over = True
                    yield from deeper(mask, held)
                    held = np.empty(0, np.uint64)
        if mask is not None:
            yield from close()

    return run


def near_links(fps: DataFrame, radius: int = RADIUS, limit: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) whose closure joins all pairs within the radius."""
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks()])
    rows = fps.select(F.explode(masks).alias("mask"), "fp")
    links = None
    for _ in range(3):
        dealt = rows.withColumn("key", F.col("mask").bitwiseAND(F.col("fp"))).repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found = staged(dealt.select("mask", "fp").mapInArrow(_bucket_links(radius, limit), "kind int, a long, b long"), "simhash-links")
        mine = found.where("kind = 0").select("a", "b")
        links = mine if links is None else links.union(mine)
        rows = found.where("kind = 1").select(F.col("b").alias("mask"), F.col("a").alias("fp")).distinct()
        if found.where("kind = 1").isEmpty():
            break
    return links


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row (doc_id, fp, component_id) per row of ``docs``.

    Documents whose fingerprints differ at ``radius`` bits or fewer are linked;
    component_id is the smallest doc_id reachable. Texts without words have
    fingerprint zero and are linked like any other. A null doc_id keeps its row
    and is never the smallest unless its component has no other id. Repeated
    rows are kept. An empty table gives no rows.
    """
    own = staged(fingerprints(docs), "simhash-fingerprints")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def op10_simhash_covering(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
