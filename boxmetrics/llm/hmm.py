"""Hidden Markov language model with partition-wise Baum-Welch counts.

Symbols are the most frequent training words (up to HEAD of them), the end of a
text, and TAIL classes of all other words by their last bytes. Baum-Welch runs
over all training texts, whole: each task sums expected counts for its texts,
Spark adds them up by symbol, and the driver receives one row a symbol, a bound
that does not depend on the corpus. The parameters are first updated after each
of SLICES parts of the texts, which brings them near a maximum in one pass, then
after all texts at once, until the likelihood gains less than GAIN. A word of a
tail class has the class's probability times its share (c + 0.5) within the
class, where one unknown word a class stands for all others; so the model is a
distribution over words. Word counts are aggregated by Spark and joined to the
texts' tail words by key; no vocabulary is ever gathered.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowered_words, remainder, staged, table

STATES = 8
HEAD = 1 << 16
TAIL = 256
SLICES = 4
GAIN = 0.002  # of the log likelihood; a smaller one ends the rounds
HELD = 2_200_000  # symbols whose vectors are held at once; more are run through CHUNK steps at a time
CHUNK = 512
SMOOTHING = 20.0


def word_key(word: bytes) -> int:
    """64-bit key of a word, signed as Spark's long."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def tail_class(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) % TAIL


# ---------------------------------------------------------------- word counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial word counts; emptied into rows before the counter grows large."""
    counts: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        words = list(counts)
        keys = np.fromiter(map(word_key, words), np.int64, len(words))
        classes = np.fromiter(map(tail_class, words), np.int32, len(words))
        out = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(classes), pa.array(np.fromiter(counts.values(), np.int64, len(words)))], ["key", "tail", "n"])
        counts.clear()
        return out

    for batch in batches:
        for t in batch.column(0).cast(pa.binary()).to_pylist():
            counts.update(lowered_words(t))
            if len(counts) > 250_000:
                yield rows()
    if counts:
        yield rows()


def word_counts(train: DataFrame) -> DataFrame:
    """(key, tail, n) of every distinct word."""
    parts = train.select("text").mapInArrow(_counted, "key long, tail int, n long")
    return parts.groupBy("key").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- symbols


class Symbols(dict):
    """Words to symbols: 0 the end, then the head words, then the tail classes. Remembers words of late."""

    def __init__(self, head: np.ndarray):
        super().__init__()
        self.ids = {k: i for i, k in enumerate(head.tolist(), 1)}
        self.first_tail = len(head) + 1

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        i = self.ids.get(word_key(word))
        self[word] = i = self.first_tail + tail_class(word) if i is None else i
        return i

    def of(self, words: list[bytes]) -> np.ndarray:
        """The symbols of a text, the end last."""
        out = np.zeros(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return out


def expected_counts(docs: list[np.ndarray], pi: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch sums of many texts at once: starts, moves, (symbol, state) uses, log likelihood.

    ``emit`` has a row a symbol. All texts take a step together; shorter ones
    drop out as the step passes their end. Where all vectors are too many to
    hold, only those of CHUNK steps are: a first sweep keeps the forward vector at the begin of each stretch, the
    second goes from the last stretch to the first, runs each forward again and
    then backward, and hands the backward vector on to the one before.
    """
    sizes = np.array([len(d) for d in docs])
    order = np.argsort(-sizes, kind="stable")
    flat, begins, sizes = np.concatenate(docs), (np.cumsum(sizes) - sizes)[order], sizes[order]
    k, longest = len(pi), int(sizes[0])
    pi, move, emit = (x.astype(np.float32) for x in (pi, move, emit))  # vectors are scaled at each step; sums are kept in 64 bits
    back = np.ascontiguousarray(move.T)
    live = lambda t: int(np.searchsorted(-sizes, -t, side="left"))  # texts longer than t
    symbols = lambda t, n: flat[begins[:n] + t]

    def step(a: np.ndarray | None, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = e * pi if a is None else (a[: len(e)] @ move) * e
        s = 1 / (a @ ones)
        a *= s[:, None]
        return a, s

    ones = np.ones(k, np.float32)

    chunk = longest if len(flat) <= HELD else CHUNK
    entering: list[np.ndarray | None] = [None]  # the forward vectors at the end of the stretch before
    for begin in range(0, longest - chunk, chunk):
        a, n = entering[-1], live(begin + chunk)
        for t in range(begin, begin + chunk):
            a, _ = step(a, emit[symbols(t, n)])
        entering.append(a)

    uses, moves, first, ll = np.zeros((emit.shape[0], k)), np.zeros((k, k)), np.zeros(k), 0.0
    cells: list[np.ndarray] = []
    weights: list[np.ndarray] = []
    held = 0

    def put_down() -> None:
        nonlocal held
        if cells:
            at, w = np.concatenate(cells), np.concatenate(weights)
            for i in range(k):
                uses[:, i] += np.bincount(at, weights=w[:, i], minlength=len(uses))
        cells.clear()
        weights.clear()
        held = 0

    onward = None  # of the step after: emission times backward vector, scaled
    for begin in range((longest - 1) // chunk * chunk, -1, -chunk):
        alphas, scales, cast = [], [], []
        a = entering.pop()
        for t in range(begin, min(begin + chunk, longest)):
            x = symbols(t, live(t))
            e = emit[x]
            a, s = step(a, e)
            alphas.append(a)
            scales.append(s)
            e *= s[:, None]  # what the backward vector of this step is scaled by
            cast.append((x, e))
        ll -= float(sum(np.log(s.astype(np.float64)).sum() for s in scales))
        while alphas:
            a, (x, e) = alphas.pop(), cast.pop()
            gamma = a
            if onward is not None:
                m = len(onward)
                b = onward @ back
                moves += a[:m].T @ onward
                gamma = a.copy()
                gamma[:m] *= b
                e[:m] *= b
            cells.append(x)
            weights.append(gamma)
            held += len(x)
            last, onward = gamma, e
            if held > 1_000_000:
                put_down()
        first = last.sum(axis=0, dtype=np.float64)
    put_down()
    return first, moves * move, uses, ll


def log_likelihoods(docs: list[np.ndarray], pi: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Exact natural-log likelihood of each text by the scaled forward recursion.

    A long text is cut into chunks that run side by side: a later chunk is run
    from each state, and the chunks' matrices are multiplied in order.
    """
    k = len(pi)
    flat, begins, sizes, owner, start = np.concatenate(docs), [], [], [], []
    at = 0
    for d, doc in enumerate(docs):
        for c in range(0, len(doc), CHUNK):
            rows = 1 if c == 0 else k
            begins += [at + c] * rows
            sizes += [min(CHUNK, len(doc) - c)] * rows
            owner += [d] * rows
            start += [-1] if c == 0 else range(k)
        at += len(doc)
    sizes, begins, start = np.array(sizes), np.array(begins), np.array(start)
    order = np.argsort(-sizes, kind="stable")
    size_o, begin_o, start_o = sizes[order], begins[order], start[order]
    a = np.where(start_o[:, None] < 0, pi[None, :], move[np.maximum(start_o, 0)])
    last = np.zeros_like(a)
    total = np.zeros(len(order))
    for t in range(int(size_o[0])):
        n = int(np.searchsorted(-size_o, -t, side="left"))
        if t:
            last[n : len(a)] = a[n:]
            a = a[:n] @ move
        a = a * emit[flat[begin_o[:n] + t]]
        s = a.sum(axis=1)
        total[:n] += np.log(s)
        a /= s[:, None]
    last[: len(a)] = a
    ends, logs = np.empty_like(last), np.empty_like(total)
    ends[order], logs[order] = last, total
    out = np.zeros(len(docs))
    i = 0
    for d, doc in enumerate(docs):
        vector, ll = ends[i], logs[i]
        i += 1
        for _ in range(CHUNK, len(doc), CHUNK):
            scaled = np.exp(logs[i : i + k] - logs[i : i + k].max())
            onward = (vector * scaled) @ ends[i : i + k]
            s = onward.sum()
            ll += np.log(s) + logs[i : i + k].max()
            vector = onward / s
            i += k
        out[d] = ll
    return out


# ---------------------------------------------------------------- training


class Model:
    """What scoring needs; its size is bounded by HEAD, TAIL and STATES."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, tail_mass: np.ndarray, total: int, distinct: int, texts_seen: int, states: int):
        self.head, self.counts, self.tail_mass = head, counts, tail_mass
        self.total, self.distinct, self.texts_seen = total, distinct, texts_seen
        mass = np.concatenate([[texts_seen + 0.5], counts + 0.5, tail_mass])
        self.share = mass / mass.sum()
        rng = np.random.default_rng(1)
        tilt = rng.gamma(4.0, 0.25, size=(len(mass), states))
        self.pi = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        self.emit = tilt * self.share[:, None]
        self.emit /= self.emit.sum(axis=0)

    def update(self, first: np.ndarray, moves: np.ndarray, uses: np.ndarray) -> None:
        """Maximisation, smoothed towards the words' shares so that no word is impossible."""
        self.pi = (first + 1) / (first + 1).sum()
        self.move = (moves + 1) / (moves + 1).sum(axis=1, keepdims=True)
        self.emit = (uses + SMOOTHING * self.share[:, None]) / (uses.sum(axis=0) + SMOOTHING)


_GROUP, _LONG = 400_000, 2_000_000


def encoded(docs: DataFrame, head: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, same, learn, text) with the text's symbols (32-bit) and the keys of its tail words (64-bit) in its place."""
    sent = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                out, keys = [], []
                for t in part.column(3).cast(pa.binary()).to_pylist():
                    words = lowered_words(t)
                    found = symbols.of(words)
                    out.append(found.tobytes())
                    rare = np.flatnonzero(found >= symbols.first_tail).tolist()
                    keys.append(np.fromiter((word_key(words[j]) for j in rare), np.int64, len(rare)).tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(out, pa.binary()), pa.array(keys, pa.binary())], ["doc_id", "same", "learn", "symbols", "rare"])

    return docs.mapInArrow(run, "doc_id long, same long, learn boolean, symbols binary, rare binary")


def _groups(batches: Iterator[pa.RecordBatch], limit: int = _GROUP, long_limit: int = _LONG) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Rows whose last column is encoded, some at a time: about ``limit`` symbols; texts of over CHUNK by themselves, ``long_limit`` at a time."""
    held: list[tuple[list, list]] = [([], []), ([], [])]
    sizes, limits = [0, 0], (limit, long_limit)
    for batch in batches:
        *ids, seqs = (c.to_pylist() for c in batch.columns)
        for row, s in zip(zip(*ids, strict=True) if ids else ((),) * len(seqs), seqs, strict=True):
            doc = np.frombuffer(s, np.int32)
            kind = int(len(doc) > CHUNK)
            held[kind][0].append(row)
            held[kind][1].append(doc)
            sizes[kind] += len(doc)
            if sizes[kind] > limits[kind]:
                yield held[kind]
                held[kind], sizes[kind] = ([], []), 0
    for group in held:
        if group[1]:
            yield group


def baum_welch_round(learned: DataFrame, model: Model) -> float:
    """One round over all encoded training texts; returns the log likelihood before it."""
    sent = learned.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.pi)
        first, moves, uses, ll = np.zeros(k), np.zeros((k, k)), np.zeros((len(m.share), k)), 0.0
        for _, docs in _groups(batches):
            f, mv, u, x = expected_counts(docs, m.pi, m.move, m.emit)
            first, moves, uses, ll = first + f, moves + mv, uses + u, ll + x
        # rows -1, -2: starts and likelihood; -3 - i: moves from state i
        head = np.concatenate([first[None], np.full((1, k), ll), moves])
        used = np.flatnonzero(uses.any(axis=1))
        keys = np.concatenate([-1 - np.arange(k + 2), used])
        table = np.concatenate([head, uses[used]])
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), *[pa.array(np.ascontiguousarray(table[:, i])) for i in range(k)]], ["symbol", *[f"s{i}" for i in range(k)]])

    k = len(model.pi)
    schema = "symbol int, " + ", ".join(f"s{i} double" for i in range(k))
    sums = learned.select("symbols").mapInArrow(run, schema).groupBy("symbol").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]).toArrow()
    symbol = sums.column(0).to_numpy()
    values = np.stack([sums.column(i + 1).to_numpy() for i in range(k)], axis=1)
    at = {int(s): v for s, v in zip(symbol[symbol < 0], values[symbol < 0], strict=True)}
    if not at:
        return 0.0
    uses = np.zeros((len(model.share), k))
    uses[symbol[symbol >= 0]] = values[symbol >= 0]
    model.update(at[-1], np.stack([at[-3 - i] for i in range(k)]), uses)
    sent.destroy()
    return float(at[-2][0])


def start_model(counts: DataFrame, texts_seen: int, states: int = STATES, head: int = HEAD) -> Model:
    """Symbols and first parameters from the word counts: the commonest words that occur twice, ``head`` at most.

    A histogram of the counts tells from which count on the words are no more
    than ``head``; words of one count are taken all or none.
    """
    total = counts.agg(F.sum("n"), F.count("*")).first()
    room, least = head, None
    for r in counts.where("n > 1").groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        room -= r.words
        if room < 0:
            break
        least = r.n
    top = counts.where(F.col("n") >= F.lit(least)).select("key", "tail", "n").orderBy("key").collect() if least else []
    mass = np.full(TAIL, 0.5)
    for r in counts.groupBy("tail").agg((F.sum("n") + 0.5 * F.count("*")).alias("m")).collect():
        mass[r["tail"]] += float(r.m)
    for r in top:
        mass[r["tail"]] -= r.n + 0.5
    keys, numbers = np.array([r.key for r in top], np.int64), np.array([r.n for r in top], np.float64)
    return Model(keys, numbers, mass, int(total[0] or 0) + texts_seen, int(total[1]) + (texts_seen > 0), texts_seen, states)


def train(learned: DataFrame, model: Model, gain: float = GAIN, slices: int = SLICES) -> list[float]:
    """Baum-Welch until the likelihood settles; the log likelihoods before each round over all texts.

    The first pass updates after each of ``slices`` parts of the texts, by a
    hash. All further rounds are over all of them, so the counts that the model
    ends with are those of all texts.
    """
    part = F.pmod(F.xxhash64("same", "doc_id"), F.lit(slices))
    for i in range(slices if slices > 1 else 0):
        baum_welch_round(learned.where(part == i), model)
    seen: list[float] = []
    while len(seen) < 2 or seen[-1] - seen[-2] > gain * abs(seen[-2]):
        seen.append(baum_welch_round(learned, model))
        if not seen[-1]:  # no texts
            break
    return seen


# ---------------------------------------------------------------- scoring


def score_texts(docs: DataFrame, learn: Column, states: int = STATES, head: int = HEAD, gain: float = GAIN) -> DataFrame:
    """One row (doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    The model learns from the rows where ``learn`` is true. ``base_score`` is
    the smoothed word-frequency score, ``score`` the model's log10 probability
    of the whole text. Null texts are empty: one end token. Repeated rows get a
    row each; a null doc_id keeps its row. Without training texts all counts
    are zero and both scores are those of the smoothing. An empty table gives
    no rows.
    """
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    own = own.select("doc_id", F.xxhash64("text").alias("same"), "learn", "text")
    learned = own.where("learn")
    counts = staged(word_counts(learned), "hmm-counts")
    model = start_model(counts, learned.count(), states, head)
    sequences = staged(encoded(own, model.head), "hmm-symbols")
    train(sequences.where("learn"), model, gain)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        tail0 = len(m.head) + 1
        known = np.concatenate([[m.texts_seen], m.counts])
        logs = np.log10(np.concatenate([known + 0.5, m.tail_mass]))
        for rows, texts_ in _groups(batches, long_limit=_GROUP):
            ll = log_likelihoods(texts_, m.pi, m.move, m.emit) / math.log(10)
            out = []
            for r, d, x in zip(rows, texts_, ll.tolist(), strict=True):
                in_head = d[d < tail0]
                out.append((*r, len(d), int((known[in_head] > 0).sum()), float(logs[in_head].sum()), x - float(logs[d[d >= tail0]].sum())))
            cols = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "same", "n_tokens", "head_known", "head_log", "model_log"])

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                found = [np.unique(np.frombuffer(b, np.int64), return_counts=True) for b in part.column(2).to_pylist()]
                each = np.array([len(k) for k, _ in found], np.int64)
                at = pa.array(np.repeat(np.arange(part.num_rows), each))
                keys, times = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(keys), pa.array(times.astype(np.int32))], ["doc_id", "same", "key", "times"])

    scored = sequences.select("doc_id", "same", "symbols").mapInArrow(forward, "doc_id long, same long, n_tokens long, head_known long, head_log double, model_log double")
    # rows that are equal have equal words: they are looked up once
    repeats = not sequences.groupBy("doc_id", "same").count().where("count > 1").isEmpty()
    rare = sequences.select("doc_id", "same", "rare")
    rare = (rare.dropDuplicates(["doc_id", "same"]) if repeats else rare).mapInArrow(tails, "doc_id long, same long, key long, times int")
    looked = rare.join(counts.select("key", "n"), "key", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    by_text = looked.groupBy("doc_id", "same").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("tail_log"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    by_text = by_text.withColumnsRenamed({"doc_id": "d", "same": "s"})
    joined = scored.join(by_text, scored.doc_id.eqNullSafe(by_text.d) & (scored.same == by_text.s), "left")
    z = math.log10(model.total + 0.5 * (model.distinct + 1))
    tail = F.coalesce("tail_log", F.lit(0.0))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail - F.col("n_tokens") * z).alias("base_score"),
        (F.col("model_log") + tail).alias("score"),
    )


def op3_hmm_score(spark, sf_dir: str) -> DataFrame:
    held = remainder("doc_id", 5) == 1
    out = score_texts(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
