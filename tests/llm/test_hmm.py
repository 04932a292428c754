import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxmetrics.llm import hmm

from ..conftest import SMALL
from .cases import AWKWARD, docs


def model(rng, k=3, s=6):
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return norm(rng.random(k)), norm(rng.random((k, k))), norm(rng.random((k, s))).T.copy()


def brute_likelihood(seq, pi, move, emit):
    total = 0.0
    for path in itertools.product(range(len(pi)), repeat=len(seq)):
        p = pi[path[0]] * emit[seq[0], path[0]]
        for i in range(1, len(seq)):
            p *= move[path[i - 1], path[i]] * emit[seq[i], path[i]]
        total += p
    return math.log(total)


def forward(seq, pi, move, emit):
    a, ll = None, 0.0
    for s in seq:
        a = (pi if a is None else a @ move) * emit[s]
        ll += math.log(a.sum())
        a = a / a.sum()
    return ll


def test_forward_is_exact(monkeypatch):
    rng = np.random.default_rng(0)
    pi, move, emit = model(rng)
    seqs = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 2, 5, 6, 3)]
    got = hmm.log_likelihoods(seqs, pi, move, emit)
    assert np.allclose(got, [brute_likelihood(s, pi, move, emit) for s in seqs])
    monkeypatch.setattr(hmm, "CHUNK", 4)  # long texts in chunks: the same value
    long = seqs + [rng.integers(0, 6, n).astype(np.int32) for n in (4, 8, 9, 41)]
    assert np.allclose(hmm.log_likelihoods(long, pi, move, emit), [forward(s, pi, move, emit) for s in long])


@pytest.mark.parametrize("chunk", [512, 1, 2, 3])
def test_expected_counts_equal_brute_force(monkeypatch, chunk):
    """However few steps are held at a time, no text is cut."""
    monkeypatch.setattr(hmm, "CHUNK", chunk)
    monkeypatch.setattr(hmm, "HELD", 100 if chunk == 512 else 0)
    rng = np.random.default_rng(4)
    pi, move, emit = model(rng)
    seqs = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 4, 5, 6, 2)]
    first, moves, uses, ll = hmm.expected_counts(seqs, pi, move, emit)
    f2, m2, u2 = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for s in seqs:
        z = math.exp(brute_likelihood(s, pi, move, emit))
        for path in itertools.product(range(3), repeat=len(s)):
            p = pi[path[0]] * emit[s[0], path[0]]
            for i in range(1, len(s)):
                p *= move[path[i - 1], path[i]] * emit[s[i], path[i]]
            p /= z
            f2[path[0]] += p
            for i, q in enumerate(path):
                u2[s[i], q] += p
                if i:
                    m2[path[i - 1], q] += p
    assert np.allclose(first, f2) and np.allclose(moves, m2) and np.allclose(uses, u2)
    assert ll == pytest.approx(sum(brute_likelihood(s, pi, move, emit) for s in seqs))


def brute_base(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = [(i, [*(t or "").translate(lower).encode().split(), None]) for i, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in toks]
    c = Counter(w for (_, ws), h in zip(toks, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for (i, ws), h in zip(toks, held, strict=True)]


def same(got, want):
    got, want = sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_query_base_and_held_out_gain(spark):
    got = [tuple(r) for r in hmm.op3_hmm_score(spark, SMALL).collect()]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    same(got, brute_base(rows))
    held = [(r[5], r[6]) for r in got if r[1]]
    assert sum(s for _, s in held) > sum(b for b, _ in held)  # the states help on texts not learned from


def test_awkward_rows(spark):
    frame = docs(spark, AWKWARD)
    got = [tuple(r) for r in hmm.score_texts(frame, ~(hmm.remainder("doc_id", 5) == 1), gain=1.0).collect()]
    want = brute_base(AWKWARD)
    same([(g[0], None, *g[1:]) for g in got], [(w[0], None, *w[2:]) for w in want])
    assert all(math.isfinite(g[5]) for g in got)
    empty = docs(spark, [])
    assert hmm.score_texts(empty, F.lit(True)).count() == 0
    alone = hmm.score_texts(docs(spark, [(1, "a b")]), F.lit(False)).collect()[0]
    assert (alone.n_tokens, alone.n_known, alone.train_tokens) == (3, 0, 0) and math.isfinite(alone.score)


def test_score_is_the_models_probability_of_the_text(spark):
    """The whole query by plain code: head words and classes, Baum-Welch by the same schedule, forward over the text."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["x"]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(61)], k=rng.randint(0, 30)))) for i in range(120)] + [(200, "never seen words")]
    frame = docs(spark, rows)
    learn = F.col("doc_id") < 100
    got = {r.doc_id: r.score for r in hmm.score_texts(frame, learn, states=2, head=10, gain=0.05).collect()}
    train = [t.encode().split() for i, t in rows if i < 100]
    c = Counter(w for ws in train for w in ws)
    by_count = sorted({n for n in c.values() if n > 1}, reverse=True)
    least = max((n for n in by_count if sum(v >= n for v in c.values()) <= 10), key=lambda n: sum(v >= n for v in c.values()))
    head = sorted((w for w in c if c[w] >= least), key=hmm.word_key)
    mass = np.full(hmm.TAIL, 0.5)
    for w in c:
        if w not in head:
            mass[hmm.tail_class(w)] += c[w] + 0.5
    m = hmm.Model(np.array([hmm.word_key(w) for w in head]), np.array([float(c[w]) for w in head]), mass, sum(c.values()) + 100, len(c) + 1, 100, 2)
    symbol = lambda w: head.index(w) + 1 if w in head else len(head) + 1 + hmm.tail_class(w)
    seqs = {i: np.array([*map(symbol, t.encode().split()), 0], np.int32) for i, t in rows}
    keyed = frame.select("doc_id", F.pmod(F.xxhash64(F.xxhash64(F.coalesce("text", F.lit(""))), "doc_id"), F.lit(hmm.SLICES)).alias("part")).collect()
    part = {r.doc_id: r.part for r in keyed}
    for k in range(hmm.SLICES):
        m.update(*hmm.expected_counts([seqs[i] for i in seqs if i < 100 and part[i] == k], m.pi, m.move, m.emit)[:3])
    seen = []
    while len(seen) < 2 or seen[-1] - seen[-2] > 0.05 * abs(seen[-2]):
        *sums, ll = hmm.expected_counts([seqs[i] for i in seqs if i < 100], m.pi, m.move, m.emit)
        m.update(*sums)
        seen.append(ll)
    for i, t in rows:
        score = forward(seqs[i], m.pi, m.move, m.emit) / math.log(10)
        for w in t.encode().split():
            if w not in head:  # its share of its class
                score += math.log10(c[w] + 0.5) - math.log10(mass[hmm.tail_class(w)])
        assert got[i] == pytest.approx(score, rel=1e-6), (i, t)


def test_rounds_go_on_until_the_likelihood_settles(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["aa bb", "cc dd", "ee ff", "gg"], k=12))) for i in range(60)]
    frame = docs(spark, rows)
    m = hmm.start_model(hmm.word_counts(frame.select("text")), 60, states=3, head=8)
    seqs = hmm.encoded(frame.select("doc_id", F.lit(0).cast("long").alias("same"), F.lit(True).alias("learn"), "text"), m.head)
    seen = hmm.train(seqs, m, gain=1e-3, slices=2)
    assert seen == sorted(seen) and len(seen) > 2 and seen[-1] - seen[-2] <= 1e-3 * abs(seen[-2]) < seen[1] - seen[0] + 1


def test_words_of_a_class_sum_to_one(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd", "eee", "fff"], k=5))) for i in range(30)]
    frame = docs(spark, rows)
    counts = hmm.word_counts(frame.select("text"))
    m = hmm.start_model(counts, 30, states=2, head=3)
    seqs = hmm.encoded(frame.select("doc_id", F.lit(0).cast("long").alias("same"), F.lit(True).alias("learn"), "text"), m.head)
    before = [hmm.baum_welch_round(seqs, m) for _ in range(3)]
    assert before == sorted(before)  # the likelihood rises
    assert m.emit.sum(axis=0) == pytest.approx([1, 1]) and m.move.sum(axis=1) == pytest.approx([1, 1]) and m.pi.sum() == pytest.approx(1)
