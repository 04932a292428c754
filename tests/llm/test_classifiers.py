import math
import random
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from boxmetrics.llm import quality, toxicity

from ..conftest import MEDIUM, SMALL
from .cases import AWKWARD, docs


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def held(spark, out, column):
    rows = out.where("held_out").join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").select("score", "predicted", column).toPandas()
    return rows[column].to_numpy(), rows["score"].to_numpy(), rows["predicted"].to_numpy()


def test_distances_are_real_compressed_lengths():
    words = [b"alpha", b"beta", b"gamma"] * 50
    d = toxicity.Distances(b"scum idiot worthless " * 3, b" ".join(words))
    for w in (b"idiot", b"alpha beta", b"", b"x" * 5000):
        size = []
        for raw in (b"scum idiot worthless " * 3, b" ".join(words)):
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw + toxicity.CARRIER), write_content_size=False, write_checksum=False, write_dict_id=False)
            size.append(len(c.compress(toxicity.CARRIER + b" " + w + b" ")))
        assert d[w] == size[1] - size[0]
    assert d[b"worthless"] > d[b"beta"]


def test_toxic_words_are_learned_from_labels(spark):
    rng = random.Random(1)
    plain = ["".join(rng.choices("abcdefg", k=rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=rng.randint(20, 80))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(["zonkwit", "murgle", "quavik"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(labels[:600], "doc_id long, toxic int")
    out = {r.doc_id: r.score for r in toxicity.score_toxicity(docs(spark, rows), docs(spark, rows[:600]), table).collect()}
    y = np.array([t for i, t in labels if i >= 600])
    got = auc(y, np.array([out[i] for i in range(600, 900)]))
    assert got > 0.9, got


def test_toxicity_query_on_held_out_rows(spark):
    out = toxicity.op4_toxicity_zstd(spark, MEDIUM).persist()
    assert out.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    y, s, p = held(spark, out, "toxic")
    assert auc(y, s) > 0.75 and all(0 <= x <= 1 for x in s) and ((s >= 0.3) == (p == 1)).all()


def test_toxicity_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1), (9, 0), (10, 0), (10, None), (None, 1), (7, 0), (7, 0)], "doc_id long, toxic int")
    frame = docs(spark, AWKWARD)
    got = toxicity.score_toxicity(frame, frame, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[10]) == 1 and by_id[9] == by_id[10] and by_id[1] == by_id[2] == by_id[3]
    none = toxicity.score_toxicity(frame, frame, labels.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_toxicity(docs(spark, []), docs(spark, []), labels).count() == 0


def brute_risk(w, p, u, prior):
    loss = lambda z: np.log1p(np.exp(-z))
    zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
    return prior * loss(zp).mean() + max(0.0, loss(-zu).mean() - prior * loss(-zp).mean())


def fitted(p, u, prior, ridge=1e-6, rounds=12):
    start = quality.Scorer(u.mean(axis=0), u.std(axis=0) + 1e-3, np.zeros(p.shape[1] + 1))
    return quality.fit(p, lambda sums: sums(u), prior, start, rounds=rounds, ridge=ridge)


def test_non_negative_risk_is_minimised():
    rng = np.random.default_rng(0)
    p = rng.normal(1.5, 1, (400, 2))
    hidden = rng.random(1500) < 0.7
    u = np.where(hidden[:, None], rng.normal(1.5, 1, (1500, 2)), rng.normal(-1.5, 1, (1500, 2)))
    m = fitted(p, u, 0.7)
    assert ((m.scores(u) > 0) == hidden).mean() > 0.93
    ps, us = (p - m.mean) / m.scale, (u - m.mean) / m.scale
    best = brute_risk(m.weights, ps, us, 0.7)
    for _ in range(200):
        assert best <= brute_risk(m.weights + rng.normal(0, 0.3, 3), ps, us, 0.7) + 1e-3
    first = fitted(p, u, 0.5)
    own = first.scores(p)
    edges = np.linspace(own.min(), own.max(), 201)[1:-1]
    cells = [np.bincount(np.searchsorted(edges, x), minlength=200) for x in (own, first.scores(u))]
    assert abs(quality.estimate_prior(*cells, edges) - 0.7) < 0.12


def test_risk_on_hidden_negatives_does_not_stay_below_zero():
    rng = np.random.default_rng(1)
    p, u = rng.normal(0.5, 1, (60, 30)), rng.normal(0, 1, (80, 30))  # few texts, many features: they can be fitted apart
    m = fitted(p, u, 0.6)
    loss = lambda z: np.log1p(np.exp(z)).mean()
    assert loss(m.scores(u)) - 0.6 * loss(m.scores(p)) > -0.1


def test_quality_query_against_brute_force(spark):
    """Plain gradient descent over all rows at once, in place of sums by task and Newton steps."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    shapes = quality.Shapes()
    x = np.stack([quality.features((r.text or "").encode(), shapes) for r in rows]).astype(float)
    learn = np.array([zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows])
    good = np.array([label.get(r.doc_id) == 1 for r in rows]) & learn
    mean, scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-3
    level = np.c_[(x - mean) / scale, np.ones(len(x))]
    u, p = level[learn], level[good]

    def descend(prior, w, steps=4000):
        for _ in range(steps):
            f, fp = 1 / (1 + np.exp(-(u @ w))), 1 / (1 + np.exp(-(p @ w)))
            assert -np.log1p(-f).mean() + prior * np.log1p(-fp).mean() > 0  # the clamp is not met here
            w = w - 0.02 * (u.T @ f / len(u) - prior * p.mean(axis=0) + quality.RIDGE * w)
        return w

    first = descend(0.5, np.zeros(level.shape[1]))
    own = p @ first
    edges = np.linspace(own.min() - 1e-9, own.max() + 1e-9, quality.CELLS + 1)[1:-1]
    cells = [np.bincount(np.searchsorted(edges, z @ first), minlength=quality.CELLS) for z in (p, u)]
    w = descend(quality.estimate_prior(*cells, edges), first)
    want = {r.doc_id: 1 / (1 + np.exp(-z)) for r, z in zip(rows, level @ w, strict=True)}
    got = quality.op6_quality_pu(spark, SMALL).collect()
    assert len(got) == len(rows)
    assert max(abs(r.score - want[r.doc_id]) for r in got) < 0.05
    assert all(r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_toxicity_query_against_brute_force(spark):
    """Windows, compressed lengths and probabilities by plain code, with the dictionaries and weights learned."""
    table, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    m = toxicity.train_classifier(table.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    assert m.toxic.startswith(m.ordinary)
    pair = [zstandard.ZstdCompressionDict(d + toxicity.CARRIER) for d in (m.toxic, m.ordinary)]

    def length(window, d):
        c = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(c.compress(toxicity.CARRIER + b" " + window + b" "))

    got = {r.doc_id: r for r in toxicity.op4_toxicity_zstd(spark, SMALL).collect()}
    rows = sorted(table.collect(), key=lambda r: len(r.text or ""))
    for r in rows[:40]:
        words = (r.text or "").encode().lower().split()
        d = []
        for i in range(0, len(words), 2):
            if i == 0 or i + 2 < len(words):  # the next window would begin past the last word but one
                d.append(length(b" ".join(words[i : i + 4]), pair[1]) - length(b" ".join(words[i : i + 4]), pair[0]))
        if not d:
            x = np.zeros(toxicity.N_FEATURES)
        else:
            over = [sum(v >= s for v in d) for s in toxicity.STEPS]
            top = sorted(d)[-3:]
            x = np.array([*[o / len(d) for o in over], *[math.log1p(o) for o in over], sum(d) / len(d), top[-1], sum(top) / len(top), math.log1p(len(d))])
        z = ((x - m.mean) / m.scale * m.weights[:-1]).sum() + m.weights[-1]
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-z))) < 1e-9 and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.3)
    assert len(got) == len(rows) and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_quality_query_on_held_out_rows(spark):
    out = quality.op6_quality_pu(spark, MEDIUM).persist()
    assert out.count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    y, s, p = held(spark, out, "quality")
    assert auc(y, s) > 0.85 and ((s >= 0.5) == (p == 1)).all() and (p == y).mean() > 0.9


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(4, 1), (9, 1), (10, 0), (10, None), (None, 1)], "doc_id long, quality int")
    frame = docs(spark, AWKWARD)
    got = quality.score_quality(frame, F.lit(True), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert all(0 <= r.score <= 1 and math.isfinite(r.score) for r in got)
    assert {r.score for r in quality.score_quality(frame, F.lit(True), labels.where("quality = 0")).collect()} == {0.5}
    assert quality.score_quality(docs(spark, []), F.lit(True), labels).count() == 0
