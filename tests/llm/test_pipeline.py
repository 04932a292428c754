import re

import corpus_pipeline
from boxmetrics.llm import decontam, mixing, toxicity

from ..conftest import SMALL
from .test_mixing import brute_exponent, brute_weights
from .test_pii import brute as base_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_first_of_near_copies(rows):
    """Smallest ids of the groups of near copies: all pairs by their sets of five-word shingles, Jaccard 0.8 or more."""
    sets = {}
    for i, t in rows:
        words = t.encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in ids if top(i) == i)


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).persist()
        outs[name] = docs.collect()
        if name != "mix":
            assert docs.columns == COLUMNS
    toxic, near, clean, pii, mix = outs.values()

    score = {r.doc_id: r.predicted for r in toxicity.op4_toxicity_zstd(spark, SMALL).collect()}
    assert sorted(r.doc_id for r in toxic) == sorted(d for d in before if not score[d])
    assert all(r == before[r.doc_id] for r in toxic)

    assert sorted(r.doc_id for r in near) == brute_first_of_near_copies([(r.doc_id, r.text or "") for r in toxic])

    bench = [decontam.prepared(r.text or "", decontam.ERROR_RATE) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = set()
    for r in near:
        t = f" {decontam.levelled(r.text or '')} "
        for b, budget in bench:
            if decontam.best_distance(b, t)[0] <= budget:
                held.add(r.doc_id)
                break
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in near if r.doc_id not in held)
    assert held

    texts = {r.doc_id: r.text for r in clean}
    assert sorted(r.doc_id for r in pii) == sorted(texts)
    for r in pii:
        assert not base_spans(r.text or "") and r.n_chars == len(r.text)
        if not base_spans(texts[r.doc_id]) and "<secret>" not in r.text:
            assert r.text == texts[r.doc_id]

    assert {r.doc_id for r in mix} == set(texts)  # nothing is lost in the mixture
    masked = {r.doc_id: r.text for r in pii}
    words = {}
    for r in mix:
        assert r.text == masked[r.doc_id] and r.tokens == len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        words[r.source] = words.get(r.source, 0) + r.tokens
    own = {}
    for r in pii:
        own[r.source] = own.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    shares = [own[s] / sum(own.values()) for s in sorted(own)]
    q = brute_weights(shares, brute_exponent(shares, repetition_limit=corpus_pipeline.REPETITION_LIMIT))
    total = sum(own.values()) / min(w / p for w, p in zip(q, shares, strict=True))
    longest = max(r.tokens for r in mix)
    for s, w in zip(sorted(own), q, strict=True):
        assert -1 <= words[s] - total * w <= longest


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == docs.columns and set(COLUMNS) <= set(got.columns)
    uses = lambda df: sorted((r.doc_id, r.text, r.source, r.n_chars, r.tokens, r.epoch, r.block, r.at) for r in df.collect())
    assert uses(got) == uses(docs) and got.count() > 0
