"""Repeated passages found with a count-min prefilter and an exact second pass.

Each window of 50 words is counted under its anchor, the smallest hash among
its 25-word grams: equal windows have equal anchors, so the count of an anchor
is never below the number of documents that hold the window. A run of windows
with one anchor adds one to it, which keeps the sketch small. Partition
sketches of two rows are merged by cell range; the second pass hashes every
window again and keeps only those whose anchor was counted twice or more in
both rows. Windows that do not repeat are lost there; none that repeats is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, texts

WINDOW = 50
CHUNK_BITS = 18
MAX_BITS = 28
ROWS = 2
HOT = 2000
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_FLUSH = 4_000_000


def _rolled(tokens: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes (mod 2^64) of all runs of ``width`` tokens, by doubling."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, power = None, 0, base
    block, size = tokens, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out, have = block, size
            else:
                m = len(tokens) - have - size + 1
                out = out[:m] * power + block[have : have + m]
                have += size
        left >>= 1
        if left:
            m = len(block) - size
            block = block[:m] * power + block[size : size + m]
            with np.errstate(over="ignore"):
                power = power * power
            size *= 2
    return out[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


class _Hashes(dict):
    """Token to 64-bit hash, kept for the tokens of late; emptied when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _grouped(rows: Iterator[tuple], window: int, tokens: int = 200_000) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]]:
    """Documents (text last) that hold a window, some at a time.

    Yields (rows, token hashes of all of them, where each begins, for each
    window start its row or -1 where a window would leave the row).
    """
    seen, some, parts, n = _Hashes(), [], [], 0

    def joined():
        lens = np.array([len(p) for p in parts])
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        row = np.repeat(np.arange(len(parts)), lens)
        left = starts[row] + lens[row] - np.arange(len(row))
        return some, np.concatenate(parts), starts, np.where(left >= window, row, -1)[: len(row) - window + 1]

    for r in rows:
        words = r[-1].split()
        if len(words) < window:
            continue
        some.append(r)
        parts.append(np.fromiter(map(seen.__getitem__, words), np.uint64, len(words)))
        n += len(words)
        if n > tokens:
            yield joined()
            some, parts, n = [], [], 0
    if parts:
        yield joined()


def _anchors(tokens: np.ndarray, window: int) -> np.ndarray:
    """For each window the smallest mixed hash of its grams of half the width."""
    gram = window // 2
    low = _mixed(_rolled(tokens, gram, _ODD[0]))
    span = window - gram + 1
    size, block = 1, low
    while size * 2 <= span:
        block = np.minimum(block[:-size], block[size:])
        size *= 2
    n = len(tokens) - window + 1
    return np.minimum(block[:n], block[span - size : span - size + n])


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (_mixed(anchors * _ODD[row]) >> np.uint64(64 - bits)).astype(np.int64)


def sketch_bits(docs: DataFrame) -> int:
    """Cells a row as a power of two: about four a counted anchor, at most 2^28 (32 MB as a bitmap)."""
    size = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MAX_BITS, max(CHUNK_BITS, int(size // 20).bit_length()))


def _partial_sketch(window: int, bits: int):
    """Rows (row, chunk, once, more): bitmaps of the cells that a part of the rows hits, and hits again."""
    chunks, span = 1 << max(0, bits - CHUNK_BITS), 1 << min(bits, CHUNK_BITS)

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchors = np.concatenate(parts)
        packer = zstandard.ZstdCompressor(level=1)
        for row in range(ROWS):
            cells, counts = np.unique(_cells(anchors, row, bits), return_counts=True)
            at = np.searchsorted(cells, np.arange(chunks + 1) * span)
            out: dict[str, list] = {"row": [], "chunk": [], "once": [], "more": []}
            for c in range(chunks):
                lo, hi = at[c], at[c + 1]
                if lo == hi:
                    continue
                once, more = np.zeros(span, np.uint8), np.zeros(span, np.uint8)
                own = cells[lo:hi] - c * span
                once[own] = 1
                more[own[counts[lo:hi] > 1]] = 1
                for k, v in (("row", row), ("chunk", c), ("once", packer.compress(np.packbits(once).tobytes())), ("more", packer.compress(np.packbits(more).tobytes()))):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("row", pa.int32()), ("chunk", pa.int32()), ("once", pa.binary()), ("more", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        rows = ((t,) for batch in batches for t in batch.column(0).cast(pa.binary()).to_pylist())
        for _, tokens, _, row in _grouped(rows, window):
            a = _anchors(tokens, window)
            whole = row >= 0
            begins = np.concatenate([[True], (a[1:] != a[:-1]) | (row[1:] != row[:-1])])
            a = a[whole & begins]
            parts.append(a)
            n += len(a)
            if n > _FLUSH:
                yield from flush(parts)
                parts, n = [], 0
        if parts:
            yield from flush(parts)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up partial sketches as they stream in; holds two bitmaps a chunk, whatever comes."""
    held: dict[tuple[int, int], list[np.ndarray]] = {}
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        for row, chunk, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            once, more = (np.frombuffer(opener.decompress(x), np.uint8) for x in (once, more))
            have = held.setdefault((row, chunk), [np.zeros(len(once), np.uint8), np.zeros(len(once), np.uint8)])
            have[1] |= more | (have[0] & once)
            have[0] |= once
    packer = zstandard.ZstdCompressor(level=1)
    for (row, chunk), (_, more) in held.items():
        yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "more": [packer.compress(more.tobytes())]})


def repeated_cells(docs: DataFrame, window: int = WINDOW) -> tuple[int, list[bytes]]:
    """The merged sketch as (bits, a bitmap a row) of cells counted twice or more; at most 64 MB."""
    bits = sketch_bits(docs)
    parts = texts(docs).select("text").mapInArrow(_partial_sketch(window, bits), "row int, chunk int, once binary, more binary")
    merged = parts.repartition("row", "chunk").mapInArrow(_merged, "row int, chunk int, more binary")
    span = (1 << min(bits, CHUNK_BITS)) // 8
    maps = [bytearray((1 << bits) // 8) for _ in range(ROWS)]
    opener = zstandard.ZstdDecompressor()
    for r in merged.toLocalIterator():
        maps[r.row][r.chunk * span : (r.chunk + 1) * span] = opener.decompress(bytes(r.more))
    return bits, [bytes(m) for m in maps]


def candidate_windows(docs: DataFrame, window: int, bits: int, cells) -> DataFrame:
    """Windows whose estimated count is two or more: (h, g, doc_id, same, at); ``cells`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(m, np.uint8) for m in cells.value]
        rows = (
            r
            for batch in batches
            for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True)
            if r[0] is not None
        )
        for some, tokens, starts, row in _grouped(rows, window):
            anchors = _anchors(tokens, window)
            at = np.flatnonzero(row >= 0)
            for r in range(ROWS):
                c = _cells(anchors[at], r, bits)
                at = at[(maps[r][c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1).astype(bool)]
            if not len(at):
                continue
            h = _mixed(_rolled(tokens, window, _ODD[0]))[at].view(np.int64)
            g = (_mixed(_rolled(tokens, window, _ODD[1]))[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            own = row[at]
            doc, same = (np.array([x[i] for x in some], kind)[own] for i, kind in ((0, np.int64), (1, np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, g, doc, same, (at - starts[own]).astype(np.int32))], ["h", "g", "doc_id", "same", "at"])

    return docs.mapInArrow(run, "h long, g int, doc_id long, same int, at int")


def later_windows(found: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of ``found`` whose window also starts in an earlier document.

    ``first`` has (h, g, low, n). A window with over 1/HOT of all rows is looked up
    in a broadcast table, which holds fewer than HOT rows whatever the corpus; its rows
    then spread over the partitions of the join with the other windows.
    """
    total = first.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(first.where(F.col("n") > total / HOT).select("h", "g", F.col("low").alias("hot_low")))
    rest = first.select(F.col("h").alias("key"), F.col("g").alias("more"), "low")
    known = F.col("hot_low").isNotNull()
    spread = F.when(known, F.xxhash64("doc_id", "at")).otherwise(F.col("h"))
    dealt = found.join(hot, ["h", "g"], "left").withColumn("key", spread).withColumn("more", F.col("g"))
    return dealt.join(rest, ["key", "more"], "left").where(F.col("doc_id") > F.coalesce("hot_low", "low"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row (doc_id, n_words, n_removed, kept) per row: the words that no earlier document's window covers.

    A word goes if a window over it also starts in a document with a smaller
    doc_id; windows are judged on the input. Windows are told apart by 96 hash
    bits. Texts shorter than a window, and null ones, lose nothing. A row with a
    null doc_id is neither earlier nor later than another: it keeps all. Rows
    with one doc_id are judged each for itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    keyed = texts(docs).select("doc_id", F.hash("text").alias("same"), "text")
    bits, maps = repeated_cells(docs, window)
    cells = spark.sparkContext.broadcast(maps)
    found = candidate_windows(keyed, window, bits, cells)
    counted = found.groupBy("h", "g").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    first = staged(counted.where("low < high").drop("high"), "substring-windows")
    covered = later_windows(found, first).groupBy("doc_id", "same").agg(F.collect_list("at").alias("at"))
    joined = keyed.join(covered, ["doc_id", "same"], "left").select("doc_id", "text", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for t, at in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), strict=True):
                words = t.split()
                if at.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.unique(at.values.to_numpy())
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    left = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op8_substring_countmin(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM w WHERE len(words) >= 50
), h AS (
  SELECT doc_id, pos, md5_number(array_to_string(words[pos:pos + 49], ' ')) AS h FROM s
), m AS (
  SELECT h, min(doc_id) AS low FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)
), c AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM h JOIN m USING (h) WHERE doc_id > low
), p AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w
), k AS (
  SELECT p.doc_id, count(*) AS n_removed_not, string_agg(p.word, ' ' ORDER BY p.pos) AS kept
  FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.pos = c.pos WHERE c.pos IS NULL GROUP BY p.doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words,
       (len(w.words) - coalesce(k.n_removed_not, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
