import math
import random

import pytest

from boxmetrics.llm import mixing

from ..conftest import MEDIUM
from .cases import AWKWARD, docs


def brute_weights(p, a):
    raw = [x**a for x in p]
    return [r / sum(raw) for r in raw]


def brute_exponent(p, target_entropy=None, repetition_limit=None, share=None):
    """Plain bisection over the list of shares."""
    lo, hi = 0.0, 1.0 if repetition_limit is not None else 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        q = brute_weights(p, mid)
        if target_entropy is not None:
            low = -sum(x * math.log(x) for x in q if x > 0) >= target_entropy
        else:
            ratios = [w / x for w, x in zip(q, p, strict=True)]
            low = (max(ratios) / min(ratios) if share is None else max(ratios) * share) > repetition_limit
        lo, hi = (mid, hi) if low else (lo, mid)
    return lo


def solve(spark, p, **kwargs):
    return mixing.solve_exponent(mixing.Curve(spark.createDataFrame([(float(x),) for x in p], "share double")), **kwargs)


def test_exponent_meets_targets(spark):
    p = [0.6, 0.25, 0.1, 0.05]
    natural = mixing.entropy(p)
    for target in (1.3, natural, 0.5, 0.1):  # below the shares' own entropy the exponent exceeds 1
        a = solve(spark, p, target_entropy=target)
        assert mixing.entropy(mixing.weights_at(p, a)) == pytest.approx(target) and (a > 1 + 1e-9) == (target < natural - 1e-9)
        assert a == pytest.approx(brute_exponent(p, target_entropy=target))
    a = solve(spark, p, repetition_limit=3.0)
    assert a == pytest.approx(brute_exponent(p, repetition_limit=3.0))
    q = mixing.weights_at(p, a)
    assert max(w / s for w, s in zip(q, p, strict=True)) / min(w / s for w, s in zip(q, p, strict=True)) == pytest.approx(3.0)
    assert solve(spark, p, target_entropy=9) == 0
    assert mixing.weights_at(p, solve(spark, p, target_entropy=0)) == pytest.approx([1, 0, 0, 0])
    assert solve(spark, p, repetition_limit=1) == pytest.approx(1) and solve(spark, [], repetition_limit=2) == 0
    many = [i / 5_000_050_000 for i in range(1, 100_001)]  # as many sources as there are
    a = solve(spark, many, repetition_limit=10.0)
    assert (many[0] / many[-1]) ** (a - 1) == pytest.approx(10.0)
    with pytest.raises(ValueError):
        solve(spark, p)


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r.source, []).append(r)
    return out


def test_budget_weights_and_epochs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), rng.choice(["big"] * 8 + ["mid", "mid", "low"])) for i in range(1500)]
    words = {i: len(t.split()) for i, t, _ in rows}
    tokens = {s: sum(words[i] for i, _, x in rows if x == s) for s in ("big", "mid", "low")}
    total = sum(tokens.values())
    for budget, kwargs in ((None, {"repetition_limit": 2.5}), (total, {"target_entropy": 1.0}), (total // 3, {"repetition_limit": 1.0})):
        got = mixing.mix(docs(spark, rows), budget=budget, block_tokens=200, **kwargs).collect()
        p = [tokens[s] / total for s in sorted(tokens)]
        q = brute_weights(p, brute_exponent(p, **kwargs, share=budget / total if budget else None))
        want = budget or total / min(w / s for w, s in zip(q, p, strict=True))
        for (s, uses), w in zip(sorted(by_source(got).items()), q, strict=True):
            used = sum(u.tokens for u in uses)
            assert -1 <= used - want * w <= 31  # the last document may cross the budget
            times = {}
            for u in uses:
                times[u.doc_id] = times.get(u.doc_id, 0) + 1
            assert max(times.values()) <= math.ceil(want * w / tokens[s] + 1e-6)
            if budget is None:  # nothing is lost
                assert len(times) == sum(x == s for _, _, x in rows)
            assert all(0 <= u["at"] <= 1 for u in uses)
            assert len({(u.epoch, u.doc_id) for u in uses}) == len(uses)
        again = mixing.mix(docs(spark, rows), budget=budget, block_tokens=200, **kwargs).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_orders_differ_between_epochs(spark):
    rows = [(i, "a b c d", "s" if i % 4 else "t") for i in range(400)]
    got = mixing.mix(docs(spark, rows), repetition_limit=3.0, block_tokens=100).where("source = 't'").collect()
    orders = [[u.doc_id for u in sorted(got, key=lambda u: (u["at"], u.within)) if u.epoch == e] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_query_keeps_every_document(spark):
    got = mixing.op7_temperature_mix(spark, MEDIUM)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()


def test_awkward_rows(spark):
    rows = [(*r, "one" if n % 2 else None) for n, r in enumerate(AWKWARD)] + [(50, "", "only empty")]
    got = mixing.mix(docs(spark, rows), repetition_limit=2.0).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} and {r.source for r in got} == {"", "one", "only empty"}
    assert mixing.mix(docs(spark, []), repetition_limit=2.0).count() == 0
    assert {r.doc_id for r in mixing.mix(docs(spark, [(1, ""), (2, None)]), target_entropy=0.5).collect()} == {1, 2}


def test_query_against_brute_force(spark):
    """Weights by plain bisection; every use of a document, its epochs, and what each source was given."""
    table = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    words = {r.doc_id: len((r.text or "").split()) for r in table}  # these texts hold no other blanks
    own = {}
    for r in table:
        own[r.source] = own.get(r.source, 0) + words[r.doc_id]
    names = sorted(own)
    p = [own[s] / sum(own.values()) for s in names]
    q = brute_weights(p, brute_exponent(p, repetition_limit=2.0))
    total = sum(own.values()) / min(w / x for w, x in zip(q, p, strict=True))
    used, times = {}, {}
    for r in mixing.op7_temperature_mix(spark, MEDIUM).collect():
        assert r.tokens == words[r.doc_id]
        used[r.source] = used.get(r.source, 0) + r.tokens
        times[r.doc_id] = times.get(r.doc_id, []) + [r.epoch]
    for s, w in zip(names, q, strict=True):
        assert -1 <= used[s] - total * w <= max(words.values())
    assert set(times) == set(words)
    assert all(e == list(range(len(e))) for e in map(sorted, times.values()))


def test_hot_keys_are_spread(spark):
    rows = [(None, "a b c d", "s")] * 600 + [(1, "a b c d", "s")] * 600
    got = mixing.mix(docs(spark, rows), repetition_limit=1.0, block_tokens=100)
    assert got.count() == 1200
    assert got.groupBy("block").count().agg({"count": "max"}).first()[0] < 100


def test_the_mixture_does_not_depend_on_how_the_rows_lie(spark):
    rows = [(i % 90 if i % 7 else None, f"w {i % 50} " * (i % 9), "ab"[i % 3 == 0]) for i in range(300)] + [(5, "same same", "a")] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted(map(tuple, mixing.mix(docs.repartition(n), repetition_limit=2.0, block_tokens=40).drop("_").collect()), key=repr) for n in (2, 5, 50)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) >= len(rows)
