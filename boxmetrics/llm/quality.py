"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are labelled good texts of the training part; all training
texts are unlabelled, labels or not. With class prior pi and logistic loss the
risk is pi E_p[l(+)] + max(0, E_u[l(-)] - pi E_p[l(-)]): the second part, the
risk on hidden negatives, cannot be negative, so it is not driven below zero by
fitting the unlabelled texts. The prior is estimated from the scores of a first
fit. Means, gradients and curvatures are sums over all unlabelled texts, taken by
Spark; what reaches the driver is of the size of the features, not of the
corpus. Features are surface statistics of the text and hashed word shapes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder, staged, table, texts

POSITIVES = 4000  # trusted positives, about
BUCKETS = 256
STATS = 16
ROUNDS = 12
GAIN = 1e-4  # of the risk; a smaller one ends the rounds
RIDGE = 0.05  # on standardised features: without it rare shapes decide
CELLS = 512  # of a histogram of scores
THRESHOLD = 0.5
_SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"))


class Shapes(dict):
    """Word to the bucket of its shape: letters, capitals and digits in runs, other signs as they are."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        shape = word
        for pattern, sign in _SHAPES:
            shape = pattern.sub(sign, shape)
        self[word] = b = xxhash.xxh32_intdigest(shape[-8:]) % BUCKETS
        return b


def features(text: bytes, shapes: Shapes) -> np.ndarray:
    out = np.zeros(STATS + BUCKETS, np.float32)
    words = text.split()
    if not words:
        out[0] = 1
        return out
    raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, k = len(text), len(words)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lengths = np.fromiter(map(len, words), np.int64, k)
    capitals, smalls, digits = raw[65:91].sum(), raw[97:123].sum() + raw[128:].sum(), raw[48:58].sum()
    signs = n - capitals - smalls - digits - raw[32] - raw[9:14].sum()
    out[:STATS] = (
        0, np.log1p(k) / 5, capitals / n, digits / n, signs / n, raw[124] / k, (raw[33] + raw[63]) / k, (raw[35:39].sum() + raw[42]) / k,
        len(counts) / k, counts.most_common(1)[0][1] / k, repeats / k, lengths.mean() / 10, lengths.std() / 10,
        len(set(lines)) / len(lines), k / len(lines) / 50, (raw[46] + raw[44]) / k,
    )
    np.add.at(out, STATS + np.fromiter(map(shapes.__getitem__, words), np.int64, k), np.float32(1 / k))
    return out


def estimate_prior(positive: np.ndarray, cells: np.ndarray, edges: np.ndarray, n_positive: int | None = None) -> float:
    """The share of positives among the unlabelled that their scores allow, from histograms over one set of edges.

    ``positive`` and ``cells`` count scores by cell. Below a threshold the
    unlabelled hold the hidden negatives there and the prior's share of the
    positives: where the positives have a density, the ratio of the densities
    cannot be under the prior, and comes to it where negatives are rare. The
    ratio over the top of the positives' scores is taken where it is least, over
    stretches with a twentieth of the positives at least.
    """
    p, u = positive / max(positive.sum(), 1), cells / max(cells.sum(), 1)
    tail_p, tail_u = np.cumsum(p[::-1])[::-1], np.cumsum(u[::-1])[::-1]
    ratios = [(tail_u[i] - tail_u[j]) / (tail_p[i] - tail_p[j]) for i, j in _stretches(tail_p)]
    return float(np.clip(min(ratios, default=0.5), 0.05, 0.95))


def _stretches(tail: np.ndarray, least: float = 0.2) -> list[tuple[int, int]]:
    """Pairs of cells between which lie ``least`` of the positives or just more, at every tenth of them."""
    out = []
    for low in np.arange(least, 1.0001, 0.1):
        i = int(np.searchsorted(-tail, -low, side="right")) - 1
        j = int(np.searchsorted(-tail, -(low - least), side="right"))
        if 0 <= i < j < len(tail) and tail[i] - tail[j] > least / 2:
            out.append((i, j))
    return out


class Scorer:
    """A linear score of standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights  # intercept last

    def levelled(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.mean) / self.scale, np.ones(len(x))]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Row by row, so that equal texts have equal scores whatever stands beside them."""
        return ((x.astype(np.float64) - self.mean) / self.scale * self.weights[:-1]).sum(axis=1) + self.weights[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _stacked(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.stack([np.frombuffer(b, np.float32) for b in rows]).astype(np.float64) if rows else np.zeros((0, STATS + BUCKETS))


def _summed(featured: DataFrame, sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``sums`` over blocks of feature rows, added up: by task first, then by Spark, cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = sums(_stacked(batch.column(0).slice(i, 2048)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["cell", "v"])

    rows = featured.select("x").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(rows.num_rows)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])


def fit(positive: np.ndarray, unlabelled: Callable[[Callable], np.ndarray], prior: float, start: Scorer, rounds: int = ROUNDS, ridge: float = RIDGE) -> Scorer:
    """Minimise the non-negative risk by Newton steps from ``start``.

    ``unlabelled`` adds up a function of blocks of features over all unlabelled
    texts. While the risk on hidden negatives is above zero, a step is of the
    whole risk; where it has fallen below, the step undoes that.
    """
    w, last = start.weights, None
    p = start.levelled(positive)
    d = p.shape[1]
    for _ in range(rounds):
        now = Scorer(start.mean, start.scale, w)

        def sums(x: np.ndarray, now: Scorer = now) -> np.ndarray:
            x = now.levelled(x)
            f = _sigmoid(x @ now.weights)
            loss = -np.log1p(-np.minimum(f, 1 - 1e-12)).sum()
            return np.concatenate([[len(x), loss], x.T @ f, ((x * (f * (1 - f))[:, None]).T @ x).ravel()])

        s = unlabelled(sums)
        if not len(s) or not s[0]:
            return now
        n, loss_u, g_u, h_u = s[0], s[1] / s[0], s[2 : 2 + d] / s[0], s[2 + d :].reshape(d, d) / s[0]
        fp = _sigmoid(p @ w)
        loss_p = -np.log1p(-np.minimum(fp, 1 - 1e-12)).mean()  # of positives taken as negative
        g_minus = p.T @ fp / len(p)
        hidden = loss_u - prior * loss_p
        risk = prior * -np.log(np.maximum(fp, 1e-12)).mean() + max(0.0, hidden) + ridge / 2 * w @ w
        if last is not None and last - risk < GAIN * abs(last):
            break
        last = risk
        if hidden >= 0:  # the losses of a positive either way differ by its score, so their curvatures cancel
            g = g_u - prior * p.mean(axis=0) + ridge * w
            w = w - np.linalg.solve(h_u + ridge * np.eye(d), g)
        else:
            g = g_u - prior * g_minus
            w = w + 0.5 * np.linalg.solve(h_u + ridge * np.eye(d), g)
    return Scorer(start.mean, start.scale, w)


def train(featured: DataFrame, positives: DataFrame) -> Scorer | None:
    """The scorer from the features of all training texts (doc_id, x) and the ids of the trusted positives; None without either."""
    p = _stacked(featured.join(F.broadcast(positives), "doc_id").select("x").orderBy("x").toArrow().column(0).combine_chunks())
    if not len(p):
        return None
    total = lambda sums: _summed(featured, sums)
    m = total(_moments)
    k = p.shape[1]
    mean = m[1 : 1 + k] / m[0]
    scale = np.sqrt(np.maximum(m[1 + k :] / m[0] - mean**2, 0)) + 1e-3
    first = fit(p, total, 0.5, Scorer(mean, scale, np.zeros(k + 1)), rounds=4)
    own = first.scores(p)
    edges = np.linspace(own.min() - 1e-9, own.max() + 1e-9, CELLS + 1)[1:-1]
    cells = total(lambda x: np.bincount(np.searchsorted(edges, first.scores(x)), minlength=CELLS).astype(float))
    # what lies below all positives is negative for sure and belongs to no cell of theirs
    prior = estimate_prior(np.bincount(np.searchsorted(edges, own), minlength=CELLS).astype(float), cells, edges)
    return fit(p, total, prior, first)


def features_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, x, more...): the features of each whole text as 32-bit numbers; a null text is empty."""
    schema = "doc_id long, x binary" + "".join(f", {c} boolean" for c in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                x = [features(t, shapes).tobytes() for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.binary()), *part.columns[2:]], ["doc_id", "x", *more])

    return texts(docs, *more).mapInArrow(run, schema)


def trusted(labels: DataFrame, size: int = POSITIVES) -> DataFrame:
    """About ``size`` ids labelled good, chosen by hash; an id with contradicting labels is none."""
    named = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y")).where("y = 1").select("doc_id")
    n = named.count()
    share = min(1.0, size / n) if n else 1.0
    return named.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < int(share * (1 << 30)))


def score_quality(docs: DataFrame, learn: Column, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row (doc_id, score, predicted) per row of ``docs``, scored over its whole text.

    The model learns from the rows where ``learn`` is true and ``labels`` of
    them. Null texts are empty; empty texts share one feature of their own.
    Repeated rows are kept, a null doc_id keeps its row; a null label counts as
    none. Without a positive every score is 0.5. Empty tables give no rows.
    """
    own = staged(features_of(docs.withColumn("__learn", F.coalesce(learn, F.lit(False))), "__learn"), "quality-features")
    sent = docs.sparkSession.sparkContext.broadcast(train(own.where("__learn").select("doc_id", "x"), trusted(labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                s = np.full(part.num_rows, 0.5) if model is None else _sigmoid(model.scores(_stacked(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return own.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out():
    return remainder("doc_id", 3) == 1


def op6_quality_pu(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_quality(docs, ~held_out(), labels.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
