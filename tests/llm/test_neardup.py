import random

from boxmetrics.llm import neardup

from .cases import AWKWARD, docs


def brute_kept(rows):
    """Positions of the rows (doc_id, text) kept, all pairs compared: five-word shingles, similarity 0.8."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) * 10 >= 8 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return sorted(min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)) for g in groups.values())


def changed(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"w{rng.randint(0, 5000)}"
    return out


def near_copies(rng):
    """Groups of near copies: chains, copies of one text that differ among themselves, and lone texts."""
    out = []
    for g in range(40):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 300))]
        out.append(base)
        for _ in range(rng.randint(0, 6)):
            base = changed(rng, out[-1] if g % 2 else base, max(1, len(base) // rng.choice([45, 60, 100])))
            out.append(base)
    centre = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    out += [changed(rng, centre, 4) for _ in range(60)]
    return [(i, " ".join(w)) for i, w in enumerate(out)]


def test_keeps_what_all_pairs_keep(spark):
    rng = random.Random(4)
    rows = near_copies(rng)
    rng.shuffle(rows)
    want = sorted(rows[i][0] for i in brute_kept(rows))
    got = neardup.keep_first(docs(spark, rows))
    assert sorted(r.doc_id for r in got.collect()) == want
    assert len(want) < len(rows) - 100


def test_near_copies_past_three_bits_go(spark):
    from boxmetrics.llm import simhash

    rng = random.Random(9)
    rows = []
    for i in range(30):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(changed(rng, base, 2)))]
    prints = [simhash.fingerprint(t.encode()) for _, t in rows]
    assert sum((a ^ b).bit_count() > 3 for a, b in zip(prints[::2], prints[1::2], strict=True)) > 10
    assert sorted(r.doc_id for r in neardup.keep_first(docs(spark, rows)).collect()) == list(range(0, 60, 2))


def test_awkward_rows(spark):
    rows = docs(spark, AWKWARD)
    got = neardup.keep_first(rows)
    assert got.columns == rows.columns
    want = [AWKWARD[i] for i in brute_kept(AWKWARD)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert neardup.keep_first(docs(spark, [])).count() == 0
