import random

import xxhash
from pyspark.sql import types as T

from boxmetrics.llm import simhash

from ..conftest import SMALL
from .cases import AWKWARD, docs


def brute_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not w:
        return 0
    k = min(3, len(w))
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    """rows (doc_id, fp) to the smallest doc_id reachable, all pairs compared."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    low = {}
    for d, f in rows:
        if d is not None:
            low[find(f)] = min(d, low.get(find(f), d))
    return [(d, f, low.get(find(f))) for d, f in rows]


def test_masks_cover_radius_three():
    rng = random.Random(3)
    for fixed in (0, simhash.covering_masks()[4], simhash.covering_masks(simhash.covering_masks()[2])[7]):
        masks = simhash.covering_masks(fixed)
        open_bits = [i for i in range(64) if not fixed >> i & 1]
        assert len(masks) == 15 and all((m & ~fixed).bit_count() == len(open_bits) // 2 for m in masks)
        for _ in range(3000):
            gap = sum(1 << b for b in rng.sample(open_bits, rng.randint(1, 3)))
            assert any(m & gap == 0 for m in masks)


def test_fingerprints(spark):
    rows = docs(spark, AWKWARD)
    got = sorted((str(r.doc_id), r.fp % 2**64) for r in simhash.fingerprints(rows).collect())
    assert got == sorted((str(i), brute_fingerprint(t or "")) for i, t in AWKWARD)


def clusters(rng, groups, size):
    out = []
    for _ in range(groups):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
    return out


def test_links_find_every_pair_even_in_full_buckets(spark):
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    dense = [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in clusters(rng, 150, 12) + dense})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for limit in (1024, 6):
        links = simhash.near_links(frame, limit=limit).collect()
        want = brute_components([(i, f % 2**64) for i, f in enumerate(fps)])
        root = {f: f for f in fps}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for r in links:
            a, b = find(r.a), find(r.b)
            root[max(a, b)] = min(a, b)
        groups = {}
        for i, f in enumerate(fps):
            groups.setdefault(find(f), []).append(i)
        low = {i: g[0] for g in groups.values() for i in g}
        assert [low[i] for i in range(len(fps))] == [w[2] for w in want]


def test_query_equals_brute_force(spark):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.op10_simhash_covering(spark, SMALL).collect()}
    rows = [(r.doc_id, brute_fingerprint(r.text or "")) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got == {(d, f"{f:016x}", c) for d, f, c in brute_components(rows)}


def test_awkward_rows(spark):
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs(spark, AWKWARD)).collect()), key=str)
    assert got == sorted(brute_components([(i, brute_fingerprint(t or "")) for i, t in AWKWARD]), key=str)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.near_duplicates(docs(spark, AWKWARD)).schema["component_id"].dataType == T.LongType()
