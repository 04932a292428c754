"""Ranked search: terms, blocks and bounds, the whole search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from boxmetrics.llm import ranked

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items):
    rows = [(d, Counter(plain_terms(t))) for d, t in docs]
    rows = [(d, c, sum(c.values())) for d, c in rows if c]
    count, total = len(rows), sum(n for *_, n in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in rows:
            m = 75 + (25 * n * count) // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:20])]
    return sorted(out, key=repr)


def found(spark, docs, items, parts=3):
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = ranked.search(ranked.indexed(rows), spark.createDataFrame(items, "item_id long, text string"))
    return sorted(map(tuple, got.collect()), key=repr)


def random_docs(rng, n, vocab=60):
    words = [f"w{i}" for i in range(vocab)] + ["Über", "ÜBER", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 3, 20, 200])))) for i in range(n)]


def test_terms():
    for text in ["", "A-b_C9 Éé x　y", "a\x00b\x7fc", "[x]{y}@z`"]:
        assert [t.decode() for t in ranked.terms(text.encode())] == plain_terms(text)
    every = "".join(chr(c) for c in range(0x180))
    assert [t.decode() for t in ranked.terms(every.encode())] == plain_terms(every)


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_scoring_every_document(spark, seed):
    rng = random.Random(seed)
    docs = random_docs(rng, 400)
    docs += [(1000 + i, docs[7][1] + " w3") for i in range(60)]  # ties past the 20th place
    items = [(i, t) for i, (_, t) in enumerate(random_docs(rng, 25))] + [(90, "w3 w3 w3 w50"), (91, "nowhere")]
    assert found(spark, docs, items) == plain_search(docs, items)


def test_awkward_rows(spark):
    docs = [(None, "a b"), (1, None), (2, ""), (3, "a"), (3, "a"), (3, "b"), (None, "a b"), (4, "!?"), (5, "a " * 30_000)]
    items = [(1, "a b"), (1, "a"), (None, "b"), (2, None), (3, "zz")]
    assert found(spark, docs, items) == plain_search(docs, items)
    assert found(spark, docs, []) == [] and found(spark, [], items) == [] and found(spark, [(1, None)], items) == []


def test_a_term_of_every_document_weighs_nothing_but_is_allowed(spark):
    docs = [(i, "a") for i in range(600)]
    assert found(spark, docs, [(1, "a")]) == plain_search(docs, [(1, "a")])


def test_extra_columns_and_blocks_of_items(spark, monkeypatch):
    rng = random.Random(8)
    docs, items = random_docs(rng, 120), [(i, t) for i, (_, t) in enumerate(random_docs(rng, 12)) if t]
    monkeypatch.setattr(ranked, "QUERY_ITEMS", 3)
    rows = spark.createDataFrame([(d, t, 1, "q") for d, t in docs], "doc_id int, text string, rank int, query string")
    asked = spark.createDataFrame([(i, t, 1, "b") for i, t in items], "item_id int, text string, score int, block string")
    got = sorted(map(tuple, ranked.search(ranked.indexed(rows), asked).collect()), key=repr)
    assert got == plain_search(docs, items)


def test_bounds_are_never_below_a_score_and_blocks_are_passed_over(spark):
    rng = random.Random(3)
    docs = random_docs(rng, 300)
    queries = ranked._queries([t for _, t in random_docs(rng, 20)])
    vocab = queries.vocab.to_pylist()
    weight = np.array([rng.randrange(9000) for _ in vocab])
    model = ranked.Model(queries, weight, 300, 300 * 40)
    block = ranked._Block()
    for d, t in docs:
        if t:
            block.add(d, Counter(ranked.terms(t.encode())))
        if t and block.full():
            row = block.row(0)
            ids = np.array([vocab.index(t) if t in vocab else -1 for t in row["terms"].split("\n")])
            table = ranked.pa.RecordBatch.from_pylist([row], ranked._BLOCK)
            scalars = {n: table.column(n)[0] for n in table.schema.names}
            bounds = model.bounds(ids, ranked._numbers(scalars["max_tf"]), ranked._numbers(scalars["min_len"]))
            forward = ranked._Forward(model, ids, scalars)
            for q in range(queries.count):
                repeats = np.zeros(len(vocab), np.int64)
                at = np.flatnonzero(queries.query == q)
                repeats[np.searchsorted(queries.start, at, side="right") - 1] = queries.repeats[at]
                low = forward.scores(repeats, 0)
                assert low.max() <= bounds[q] and (low == forward.scores(repeats, ranked._EXACT)).all()
            block = ranked._Block()
