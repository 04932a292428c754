"""Toxicity by compression distance: one zstandard dictionary of toxic text, one of ordinary text.

A text is cut into windows of WINDOW words, each STRIDE words after the last. A
window is compressed with each dictionary; how much shorter the toxic one makes
it is the window's distance. The ordinary dictionary is trained on windows of
ordinary texts. Toxic texts are ordinary text for the most part, so the toxic
dictionary is the ordinary one followed by one trained on those words of toxic
texts that a log-likelihood ratio of byte grams finds to mark them: what both
hold cancels out in the distance. Both end with the same carrier bytes, which
go before each window: without them zstandard would store a short window as it
is, whatever the dictionary holds. A text is scored by how many of its windows
reach each of several distances, by a logistic calibration; each half of the
sample is measured with dictionaries of the other half, so the calibration sees
distances as texts not learned from have them.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowered_words, remainder, table, texts

SAMPLE = 8000  # labelled texts, about; all that is learned comes from them
GRAM = 6
MIN_RATIO = 60.0  # log-likelihood ratio of a marking gram
DICT_BYTES = 16384
TRAIN_BYTES = 200 * DICT_BYTES  # of ordinary windows, about
LEAST_BYTES = 512
WINDOW, STRIDE = 4, 2
STEPS = (-4, -2, 0, 2, 4, 6, 8, 10, 14)
THRESHOLD = 0.3
RIDGE = 5.0
CARRIER = bytes(range(128, 192))
N_FEATURES = 2 * len(STEPS) + 4


def sample_labelled(docs: DataFrame, labels: DataFrame, column: str, size: int) -> DataFrame:
    """About ``size`` texts with labels (doc_id, text, y), chosen by a hash of the id; of copies and most near copies one.

    Conflicting labels of one id count as the larger; null labels are left out.
    """
    named = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    n = named.count()
    share = min(1.0, size / n) if n else 1.0
    named = named.where(F.pmod(F.xxhash64("doc_id", F.lit(column)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the chosen ids are about `size` rows whatever the tables' size, so they are sent to the documents
    found = texts(docs).join(F.broadcast(named), "doc_id")
    return found.mapInArrow(_signed, "doc_id long, text string, y int, first long, second long").dropDuplicates(["first"]).dropDuplicates(["second"]).select("doc_id", "text", "y")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two minima of hashes of a text's five-word shingles: copies and most near copies share one of them."""
    for batch in batches:
        low = ([], [])
        for t in batch.column(1).cast(pa.binary()).to_pylist():
            words = lowered_words(t)
            runs = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
            for seed in (0, 1):
                low[seed].append(min(xxhash.xxh64_intdigest(r, seed) for r in runs))
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in low]], ["doc_id", "text", "y", "first", "second"])


def grams(word: bytes) -> list[bytes]:
    b = b" " + word + b" "
    return [b[i : i + GRAM] for i in range(max(1, len(b) - GRAM + 1))]


def windows_of(words: list[bytes], window: int = WINDOW, stride: int = STRIDE) -> list[bytes]:
    """Runs of ``window`` words, one each ``stride`` words; every word is in one. No words, no windows."""
    return [b" ".join(words[i : i + window]) for i in range(0, max(1, len(words) - window + stride), stride)] if words else []


def marking_grams(sample: DataFrame, texts_by: dict[tuple[int, bool], int]) -> list[set[bytes]]:
    """Grams that stand in far more toxic texts than their number explains: of both halves, of half 0, of half 1.

    ``sample`` has (text, y, half); ``texts_by`` counts its texts by half and class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(4)]

        def rows() -> pa.RecordBatch:
            keys = list(set().union(*counts))
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts]], ["gram", "o0", "t0", "o1", "t1"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for t, y, h in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                counts[2 * h + (y > 0)].update({g for w in set(lowered_words(t)) for g in grams(w)})
                if sum(map(len, counts)) > 300_000:
                    yield rows()
        yield rows()

    parts = sample.select("text", "y", "half").mapInArrow(run, "gram binary, o0 long, t0 long, o1 long, t1 long")
    counted = parts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("o0", "t0", "o1", "t1")]).withColumns({"o": F.col("o0") + F.col("o1"), "t": F.col("t0") + F.col("t1")})

    def marks(a, b, n_toxic: int, n_other: int):
        if not n_toxic or not n_other:
            return F.lit(False)
        n = float(n_toxic + n_other)
        p = (a + b) / n

        def part(seen, expected):
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        ratio = 2 * (part(a, n_toxic * p) + part(b, n_other * p) + part(n_toxic - a, n_toxic * (1 - p)) + part(n_other - b, n_other * (1 - p)))
        # a small sample cannot reach a high ratio: there a tenth of what it could reach
        least = min(MIN_RATIO, 0.1 * 2 * (n_toxic * np.log(n / n_toxic) + n_other * np.log(n / n_other)))
        return (a >= 3) & (a * n_other > 3 * b * n_toxic) & (ratio > float(least))

    of = lambda y, *halves: sum(texts_by.get((h, y), 0) for h in halves)
    flags = [marks(F.col("t"), F.col("o"), of(True, 0, 1), of(False, 0, 1)), *[marks(F.col(f"t{h}"), F.col(f"o{h}"), of(True, h), of(False, h)) for h in (0, 1)]]
    found = counted.select("gram", *[f.alias(f"m{i}") for i, f in enumerate(flags)]).where("m0 OR m1 OR m2").collect()
    return [{bytes(r.gram) for r in found if r[f"m{i}"]} for i in range(3)]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train one, a raw one of the commonest samples."""
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    if len(trained) >= LEAST_BYTES:
        return trained
    common = [w for w, _ in Counter(samples).most_common(500)]
    return b"".join(reversed(common))[-DICT_BYTES:].rjust(8, b" ")


class Distances:
    """Window to the bytes by which the toxic dictionary compresses it shorter."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.pair = []
        for d in (toxic, ordinary):
            d = zstandard.ZstdCompressionDict(d + CARRIER)
            d.precompute_compress(level=3)
            self.pair.append(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __getitem__(self, window: bytes) -> int:
        toxic, ordinary = self.pair
        spaced = CARRIER + b" " + window + b" "
        return len(ordinary(spaced)) - len(toxic(spaced))


def features(text: bytes, distances: Distances) -> np.ndarray:
    windows = windows_of(lowered_words(text))
    if not windows:
        return np.zeros(N_FEATURES)
    d = np.fromiter(map(distances.__getitem__, windows), np.int64, len(windows))
    over = np.array([(d >= s).sum() for s in STEPS])
    top = np.sort(d)[-3:]
    return np.concatenate([over / len(d), np.log1p(over), [d.mean(), top[-1], top.mean(), np.log1p(len(d))]])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Classifier:
    def __init__(self, toxic: bytes, ordinary: bytes, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.toxic, self.ordinary, self.mean, self.scale, self.weights = toxic, ordinary, mean, scale, weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_dictionaries(sample: DataFrame, texts_by: dict[tuple[int, bool], int], ordinary_bytes: int) -> list[tuple[bytes, bytes]]:
    """(toxic, ordinary) dictionaries learned from the whole sample, from its half 0 and from its half 1."""
    marks = marking_grams(sample, texts_by)
    sent = sample.sparkSession.sparkContext.broadcast(marks)
    every = max(1, ordinary_bytes // TRAIN_BYTES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        for batch in batches:
            rows = []
            for t, y, h in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = lowered_words(t)
                if y > 0:
                    for w in words:
                        gs = grams(w)
                        kinds = [not m.isdisjoint(gs) for m in marks]
                        if any(kinds):
                            rows.append((h, True, kinds[0], kinds[1 + h], b" " + w + b" "))
                else:
                    rows += [(h, False, True, True, w) for w in windows_of(words, WINDOW, WINDOW) if xxhash.xxh32_intdigest(w) % every == 0]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["half", "toxic", "whole", "own", "window"])

    rows = sample.select("text", "y", "half").mapInArrow(cut, "half int, toxic boolean, whole boolean, own boolean, window binary").toArrow()
    half, toxic, whole, own, window = (rows.column(i).to_pylist() for i in range(5))
    found = sorted(zip(window, half, toxic, whole, own, strict=True))
    random.Random(1).shuffle(found)  # training takes stretches of neighbours: equal words must not stand together
    out = []
    for h in (None, 0, 1):
        kinds = [[w for w, hh, t, all_, mine in found if t == y and (all_ if h is None else hh == h and mine)] for y in (True, False)]
        ordinary = _dictionary(kinds[1])
        out.append((ordinary + _dictionary(kinds[0]), ordinary))
    sent.destroy()
    return out


def train_classifier(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Classifier | None:
    """Dictionaries and calibration from a sample of ``size`` labelled texts; None without both classes."""
    spark = docs.sparkSession
    sample = sample_labelled(docs, labels, "toxic", size).withColumn("half", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int"))
    sample = sample.repartition(16, "doc_id").persist()
    try:
        found = sample.groupBy("half", (F.col("y") > 0).alias("toxic")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
        texts_by = {(r.half, r.toxic): r.n for r in found}
        if len({y for _, y in texts_by}) < 2:
            return None
        pairs = train_dictionaries(sample, texts_by, sum(r.size for r in found if not r.toxic))
        both = spark.sparkContext.broadcast(pairs)

        def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            other = [Distances(*both.value[2]), Distances(*both.value[1])]  # for texts of half 0, of half 1
            for batch in batches:
                x = [features(t, other[h]).tobytes() for t, h in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1)], ["x", "y"])

        rows = sample.select("text", "y", "half").mapInArrow(featured, "x binary, y int").toArrow()
    finally:
        sample.unpersist()
    x = np.stack([np.frombuffer(b) for b in rows.column(0).to_pylist()])
    y = (rows.column(1).to_numpy() > 0).astype(float)
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Classifier(*pairs[0], mean, scale, logistic((x - mean) / scale, y, RIDGE))


def score_toxicity(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, size: int = SAMPLE) -> DataFrame:
    """One row (doc_id, score, predicted) per row of ``docs``, scored over its whole text.

    Null texts are empty; an empty text has no windows and is scored from zeros.
    Equal texts have equal scores, repeated rows are kept, a null doc_id keeps
    its row. Without labels of both classes every score is 0. Empty tables
    give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train_classifier(train_docs, labels, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        distances = Distances(model.toxic, model.ordinary) if model else None
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            p = model.probability(np.array([features(t, distances) for t in raw]).reshape(len(raw), -1)) if model and raw else np.zeros(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_ordinary(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; nothing is shuffled.

    Rows are judged one by one by their text, a null one as empty: null ids and
    repeated rows stay as many as they are. Without labels of both classes, and
    of an empty table, nothing is taken away.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train_classifier(train_docs, labels, size))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        distances = Distances(model.toxic, model.ordinary) if model else None
        for batch in batches:
            if model and batch.num_rows:
                raw = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
                p = model.probability(np.array([features(t, distances) for t in raw]))
                batch = batch.filter(pa.array(p < threshold))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def held_out():
    return remainder("doc_id", 4) == 2


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; labels are learned only from rows that are not held out."""
    return score_toxicity(docs, docs.where(~held_out()), labels.where(~held_out()))


def op4_toxicity_zstd(spark, sf_dir: str) -> DataFrame:
    out = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
