"""Ranked lexical search with block-max pruning.

The index is a table of blocks: a run of documents as they lie in the input,
their forward index (terms and frequencies, document by document) and for each
term of the block its highest frequency and the shortest document that holds
it. Those two bound the term's share of any score in the block, whatever the
statistics of the corpus turn out to be, so a block never has to be rewritten.

A search sums these bounds to one for each block and query. The blocks of the
highest bounds of each query, over the whole index, are scored first; their
20th score is a floor for all tasks. Then each task takes its blocks in the
order of their bounds, scores them from the forward index and stops at the
first bound below the floor or the 20th score it has found itself. A bound
that equals it is still looked at, as ties go by document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, table

TOP = 20
#: Documents of a block; small blocks have tight bounds.
BLOCK_DOCS = 4
BLOCK_POSTINGS = 1 << 16
#: Blocks of the highest bounds that are scored first, for each query.
SEEDS = 8
#: Blocks that are written at a time, and bytes of a row group of the index: both bound what a task holds.
BATCH = 64
ROW_GROUP = 4_000_000
#: Blocks that a task holds while it goes through them in the order of bounds.
GROUP = 256
#: Bytes and number of the query texts that are searched for in one reading of the index.
QUERY_BYTES = 2_000_000
QUERY_ITEMS = 4096
#: ASCII letters and digits and all other characters from U+0080 on make up terms; A-Z are lowered.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_EXACT = 1 << 53
_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("docs", pa.list_(pa.int64())),
        ("lens", pa.list_(pa.int64())),
        ("terms", pa.string()),  # of the block, a line each
        # numbers of a block, 32 bits each, as bytes: by term, by document (where its postings end), by posting
        ("df", pa.binary()),
        ("max_tf", pa.binary()),
        ("min_len", pa.binary()),
        ("ends", pa.binary()),
        ("post_term", pa.binary()),
        ("post_tf", pa.binary()),
    ]
)
_BLOCK_DDL = "block long, docs array<long>, lens array<long>, terms string, df binary, max_tf binary, min_len binary, ends binary, post_term binary, post_tf binary"


def _packed(numbers) -> bytes:
    return np.asarray(numbers, "<i4").tobytes()


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<i4").astype(np.int64)


def terms(data: bytes) -> list[bytes]:
    """The terms of UTF-8 bytes, in order, repeats included."""
    return data.translate(_FOLD).split()


class _Block:
    """Documents gathered for one block."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.docs: list[int | None] = []
        self.lens: list[int] = []
        self.ends: list[int] = []
        self.post_term: list[int] = []
        self.post_tf: list[int] = []

    def add(self, doc_id: int | None, counts: Counter) -> None:
        ids = self.ids
        self.post_term += [ids.setdefault(t, len(ids)) for t in counts]
        self.post_tf += counts.values()
        self.docs.append(doc_id)
        self.lens.append(sum(counts.values()))
        self.ends.append(len(self.post_term))

    def full(self) -> bool:
        return len(self.docs) >= BLOCK_DOCS or len(self.post_term) >= BLOCK_POSTINGS

    def row(self, block: int) -> dict:
        at, tf = np.array(self.post_term), np.array(self.post_tf)
        lens = np.repeat(self.lens, np.diff(self.ends, prepend=0))
        max_tf, min_len = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), np.iinfo(np.int32).max, np.int64)
        np.maximum.at(max_tf, at, tf)
        np.minimum.at(min_len, at, lens)
        return {
            "block": block,
            "docs": self.docs,
            "lens": self.lens,
            "terms": b"\n".join(self.ids).decode(),
            "df": _packed(np.bincount(at, minlength=len(self.ids))),
            "max_tf": _packed(max_tf),
            "min_len": _packed(min_len),
            "ends": _packed(self.ends),
            "post_term": _packed(at),
            "post_tf": _packed(tf),
        }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held, rows = TaskContext.get().partitionId() << 32, _Block(), []
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
            counts = Counter(terms(text.as_py()))
            if counts:
                held.add(doc_id.as_py(), counts)
            if held.full():
                rows.append(held.row(number))
                number, held = number + 1, _Block()
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_pylist(rows, _BLOCK)
                rows = []
    if held.docs:
        rows.append(held.row(number))
    yield pa.RecordBatch.from_pylist(rows, _BLOCK)


def indexed(docs: DataFrame) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text), in the shared folder; nothing is shuffled.

    A document without a term, as a null text, is in no block and never found.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return staged(rows.mapInArrow(_blocks, _BLOCK_DDL), "rank-blocks", **{"parquet.block.size": ROW_GROUP})


class Queries(NamedTuple):
    """Some queries by term: those of term t are ``query[start[t]:start[t + 1]]``, each with the term's repeats in it."""

    vocab: pa.Array
    start: np.ndarray
    query: np.ndarray
    repeats: np.ndarray
    count: int


def _queries(texts: list[str]) -> Queries:
    vocab: dict[bytes, int] = {}
    rows = [(vocab.setdefault(t, len(vocab)), q, n) for q, text in enumerate(texts) for t, n in Counter(terms(text.encode())).items()]
    flat = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return Queries(pa.array([t.decode() for t in vocab], pa.string()), np.searchsorted(flat[:, 0], np.arange(len(vocab) + 1)), flat[:, 1], flat[:, 2], len(texts))


def query_blocks(items: DataFrame, limit: int = QUERY_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """Items (item_id, text) some at a time, texts of ``limit`` bytes or one more text, 4,096 at most."""
    held, size = [], 0
    for item_id, text in items.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))).toLocalIterator():
        held.append((item_id, text))
        size += len(text.encode())
        if size >= limit or len(held) >= QUERY_ITEMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def document_counts(blocks: DataFrame, vocab) -> dict[int, int]:
    """In how many documents the terms of a broadcast vocabulary stand, by their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(vocab.value), np.int64)
        for some in _groups(batches):
            at = np.concatenate(_term_ids(vocab.value, some.column(0)))
            np.add.at(out, at[at >= 0], np.concatenate([_numbers(v) for v in some.column(1)])[at >= 0])
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], ["term", "n"])

    found = blocks.select("terms", "df").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in found.collect()}


class Model(NamedTuple):
    """What a score needs besides the index: statistics of the corpus and weights of the query terms."""

    queries: Queries
    weight: np.ndarray
    n_docs: int
    n_terms: int

    def share(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 75 + (25 * length * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)

    def bounds(self, ids: np.ndarray, max_tf: np.ndarray, min_len: np.ndarray) -> np.ndarray:
        """For each query the most that a document of a block can score; ``ids`` are query terms or -1."""
        q, out = self.queries, np.zeros(self.queries.count, np.int64)
        known = np.flatnonzero(ids >= 0)
        most = self.weight[ids[known]] * self.share(max_tf[known], min_len[known])
        lo, n = q.start[ids[known]], q.start[ids[known] + 1] - q.start[ids[known]]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        np.add.at(out, q.query[at], np.repeat(most, n) * q.repeats[at])
        return out


class _Forward:
    """The forward index of a block, cut down to query terms, with what each posting adds to a score."""

    def __init__(self, model: Model, ids: np.ndarray, row) -> None:
        self.docs = row["docs"]
        ends, at = _numbers(row["ends"]), _numbers(row["post_term"])
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        lens, keep = row["lens"].values.to_numpy(), ids[at] >= 0
        self.doc, self.term = doc[keep], ids[at[keep]]
        self.gain = model.weight[self.term] * model.share(_numbers(row["post_tf"])[keep], lens[self.doc])

    def scores(self, repeats: np.ndarray, bound: int) -> np.ndarray:
        gains = self.gain * repeats[self.term]
        if bound < _EXACT:  # sums below 2^53 are exact in doubles
            return np.bincount(self.doc, gains, len(self.docs)).astype(np.int64)
        out = np.zeros(len(self.docs), np.int64)
        np.add.at(out, self.doc, gains)
        return out


class _Best:
    """The best documents of each query that a task has seen: (score, doc_id), null ids last among equals."""

    def __init__(self, count: int, floors: np.ndarray) -> None:
        self.rows: list[list[tuple[int, int | None]]] = [[] for _ in range(count)]
        self.floors = floors.copy()

    def add(self, q: int, scores: np.ndarray, docs) -> None:
        some = np.flatnonzero(scores >= self.floors[q])
        if len(some):
            rows = self.rows[q] + [(int(scores[i]), docs[int(i)].as_py()) for i in some]
            rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
            self.rows[q] = rows[:TOP]
            if len(rows) >= TOP:
                self.floors[q] = max(self.floors[q], rows[TOP - 1][0])

    def batch(self) -> pa.RecordBatch:
        flat = [(q, *r) for q, rows in enumerate(self.rows) for r in rows]
        cols = list(zip(*flat, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query", "score", "doc_id"])


def _term_ids(vocab: pa.Array, column) -> list[np.ndarray]:
    """For each block of a batch its terms as numbers of query terms, or -1."""
    lines = pc.split_pattern(column, pattern="\n")
    flat = pc.index_in(lines.flatten(), value_set=vocab).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(flat, np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False))[:-1])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, GROUP) for at in range(0, batch.num_rows, GROUP))


def _seeds(model, seeds: int):
    """Blocks (block, terms, max_tf, min_len) to the ``seeds`` highest bounds that a task has for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        q = np.arange(m.queries.count)
        top, names = np.zeros((seeds, len(q)), np.int64), np.zeros((seeds, len(q)), np.int64)
        for some in _groups(batches):
            ids = _term_ids(m.queries.vocab, some.column("terms"))
            new = np.stack([m.bounds(t, _numbers(a), _numbers(b)) for t, a, b in zip(ids, some.column("max_tf"), some.column("min_len"), strict=True)])
            both = np.concatenate([top, new])
            order = np.argsort(-both, axis=0, kind="stable")[:seeds]
            kept = names[np.minimum(order, seeds - 1), q]
            names = np.where(order < seeds, kept, some.column("block").to_numpy()[np.maximum(order - seeds, 0)])
            top = np.take_along_axis(both, order, axis=0)
        found = top > 0
        where = np.broadcast_to(q, top.shape)[found]
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(names[found]), pa.array(top[found])], ["query", "block", "bound"])

    return run


def _scored(model, floors: np.ndarray, only=None):
    """Blocks to the best documents of each query in a task; ``only`` (block to queries, broadcast) names the pairs to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        q = m.queries
        by_query = np.argsort(q.query, kind="stable")
        cuts = np.searchsorted(q.query[by_query], np.arange(q.count + 1))
        term_of = np.repeat(np.arange(len(q.vocab)), np.diff(q.start))
        best, repeats = _Best(q.count, floors), np.zeros(len(q.vocab), np.int64)
        for some in _groups(batches):
            rows = [{n: some.column(n)[i] for n in some.schema.names} for i in range(some.num_rows)]
            ids = _term_ids(q.vocab, some.column("terms"))
            bounds = np.stack([m.bounds(t, _numbers(r["max_tf"]), _numbers(r["min_len"])) for t, r in zip(ids, rows, strict=True)])
            if only is not None:
                wanted = np.zeros(bounds.shape, bool)
                for i, r in enumerate(rows):
                    wanted[i, only.value.get(r["block"].as_py(), [])] = True
                bounds[~wanted] = 0
            ready: list[_Forward | None] = [None] * len(rows)
            for k in np.flatnonzero(bounds.max(axis=0) >= best.floors):
                own = by_query[cuts[k] : cuts[k + 1]]
                repeats[term_of[own]] = q.repeats[own]
                for i in np.argsort(-bounds[:, k], kind="stable"):
                    if bounds[i, k] < best.floors[k]:
                        break
                    if ready[i] is None:
                        ready[i] = _Forward(m, ids[i], rows[i])
                    best.add(k, ready[i].scores(repeats, bounds[i, k]), ready[i].docs)
                repeats[term_of[own]] = 0
        yield best.batch()

    return run


def _top(keep: int):
    """Rows (query, value, id) of whole queries to the ``keep`` of the highest values, equal ones by id, null last, with their rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(4)]
        place = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column(2)
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()]
            query, value, none, at = (np.concatenate(x) for x in zip(held, new, strict=True))
            order = np.lexsort((at, none, -value, query))
            ranked = query[order]
            place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
            order, place = order[place < keep], place[place < keep]
            held = [x[order] for x in (query, value, none, at)]
        query, value, none, at = held
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(place + 1, pa.int32()), pa.array(value), pa.array(at, mask=none > 0)], ["query", "rank", "value", "id"])

    return run


def _best_of_all(found: DataFrame, keep: int = TOP) -> DataFrame:
    """The best of what the tasks found; a task sends no more than ``keep`` rows a query, and as many are held of each."""
    return found.repartition("query").mapInArrow(_top(keep), "query long, rank int, value long, id long")


def search(blocks: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of each item: (item_id, rank, doc_id, score); needs ``indexed`` blocks.

    Items with a null or a repeated id are searched for row by row, each with
    ranks of its own; an item without a term, as one with a null text, finds
    nothing. Documents with one id are all ranked. Equal scores are in the
    order of doc_id, null last. An empty index or no items give no rows.
    """
    spark = blocks.sparkSession
    sc = spark.sparkContext
    sums = blocks.agg(F.sum(F.size("docs")), F.sum(F.expr("aggregate(lens, 0L, (a, x) -> a + x)"))).first()
    parts = []
    for held in query_blocks(items) if sums[0] else ():
        queries = _queries([text for _, text in held])
        vocab = sc.broadcast(queries.vocab)
        df = document_counts(blocks, vocab)
        vocab.destroy()
        weight = np.array([math.floor(1000 * math.log((2 * sums[0] + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(queries.vocab))], np.int64)
        model = sc.broadcast(Model(queries, weight, *sums))
        bounds = blocks.select("block", "terms", "max_tf", "min_len").mapInArrow(_seeds(model, SEEDS), "query long, block long, bound long")
        first = _best_of_all(bounds.select("query", "bound", "block"), SEEDS).groupBy(F.col("id").alias("block")).agg(F.collect_list("query").alias("queries"))
        seeds = {r.block: r.queries for r in first.collect()}  # at most SEEDS for each query
        only = sc.broadcast(seeds)
        schema = "query long, score long, doc_id long"
        floors = np.ones(queries.count, np.int64)
        known = blocks.join(F.broadcast(spark.createDataFrame([(b,) for b in seeds], "block long")), "block", "left_semi").select(*blocks.columns)
        for r in _best_of_all(known.mapInArrow(_scored(model, floors, only), schema)).where(F.col("rank") == TOP).collect():
            floors[r["query"]] = r["value"]
        best = staged(_best_of_all(blocks.mapInArrow(_scored(model, floors), schema)), "rank-best")
        only.destroy()
        model.destroy()
        names = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(held)], "query long, item_id long")
        parts.append(best.join(F.broadcast(names), "query").select("item_id", "rank", F.col("id").alias("doc_id"), F.col("value").alias("score")))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_block_max(spark, sf_dir: str) -> DataFrame:
    return search(indexed(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS t FROM documents),
sized AS (SELECT k, doc_id, len(t)::BIGINT AS n, t FROM docs WHERE len(t) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
wanted AS (SELECT q, item_id, term, count(*)::BIGINT AS repeats FROM (
  SELECT b.q, b.item_id, unnest(b.t) AS term FROM (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS t FROM benchmark) b) GROUP BY ALL),
postings AS (SELECT k, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT k, doc_id, n, unnest(t) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, corpus GROUP BY term, n_docs),
shares AS (SELECT p.k, p.doc_id, p.term, w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * c.n_docs) // c.n_terms))) AS gain
  FROM postings p JOIN weights w USING (term), corpus c),
scored AS (SELECT q, item_id, k, doc_id, sum(gain * repeats)::BIGINT AS score FROM wanted JOIN shares USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
