import random

from boxmetrics.llm import decontam

from ..conftest import SMALL
from .cases import AWKWARD, docs


def brute(pattern, text):
    """Smallest edit distance of pattern to any stretch of text, by rows of the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        at = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("abcd ")
        elif kind == 1:
            del s[at]
        else:
            s.insert(at, rng.choice("abcd "))
    return "".join(s)


def test_myers_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        if rng.random() < 0.5:
            t = t[:20] + edited(rng, p, 3) + t[20:] if len(p) > 4 else t
        assert decontam.best_distance(p, t)[0] == brute(p, t)


def test_no_match_is_missed(spark):
    rng = random.Random(2)
    items = ["".join(rng.choices("abcd ", k=rng.randint(25, 120))).strip() for _ in range(12)]
    rows = []
    for i in range(80):
        t = "".join(rng.choices("abcd ", k=rng.randint(0, 200)))
        if i % 2:
            x = rng.choice(items)
            t = t[:50] + edited(rng, x, rng.randint(0, len(x) // 7)) + t[50:]
        rows.append((i, t))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontam.contaminated(docs(spark, rows), bench).collect()}
    want = set()
    for i, t in rows:
        for n, x in enumerate(items):
            p = decontam.levelled(x)
            if (d := brute(p, decontam.levelled(t))) <= int(len(p) * decontam.ERROR_RATE):
                want.add((i, n, d))
    assert got == want and len(want) > 20


def test_blocks_give_the_same_rows(spark, monkeypatch):
    whole = sorted(map(tuple, decontam.op2_decontaminate(spark, SMALL).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 500)
    assert sorted(map(tuple, decontam.op2_decontaminate(spark, SMALL).collect())) == whole and whole


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (None, "the same text as another row"), (5, "THE same  text as another row"), (6, "word " * 40)], "item_id long, text string")
    got = sorted(((str(r.doc_id), r.item_id, r.distance) for r in decontam.contaminated(docs(spark, AWKWARD), bench).collect()), key=str)
    assert got == sorted([("10", 5, 0), ("10", 5, 0), ("7", 6, 0), ("9", 5, 0), *[(i, None, 0) for i in ("9", "10", "10")]], key=str)
    assert decontam.contaminated(docs(spark, []), bench).count() == 0
    assert decontam.contaminated(docs(spark, AWKWARD), bench.limit(0)).count() == 0


def test_short_items_match_whole_words_within_their_budget(spark):
    items = [(1, "ab"), (2, "Ünit Test"), (3, "exact phrase x")]
    rows = [(1, "cab abc ab"), (2, "cab abc"), (3, "a unit  test"), (4, "an ünit\ntest."), (5, "AN ÜNIT \n TEST"), (6, "exct phrase x"), (7, "exct phras x"), (8, "ab")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.begin, r.end) for r in decontam.contaminated(docs(spark, rows), bench).collect())
    assert got == [(1, 1, 0, 8, 10), (5, 2, 0, 3, 14), (6, 3, 1, 0, 13), (8, 1, 0, 0, 2)]


def test_places_are_those_of_the_text(spark):
    item = "the quick brown fox jumps over the lazy dog again"
    text = "  Straße \t The QUICK  brown\nfox jumped over the lazy dog again, and more"
    bench = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    rows = decontam.contaminated(docs(spark, [(1, text)]), bench).collect()
    assert sorted((str(r.item_id), r.distance) for r in rows) == [("1", 2), ("1", 2), ("None", 2)]
    assert {text[r.begin : r.end] for r in rows} == {"The QUICK  brown\nfox jumped over the lazy dog again"}


def test_rows_stay_as_they_are(spark):
    bench = spark.createDataFrame([(None, "the same text as another row"), (2, None)], "item_id long, text string")
    frame = docs(spark, AWKWARD)
    got = decontam.without_items(frame, bench)
    want = [r for r in frame.collect() if "same text" not in (r.text or "")]
    assert got.columns == frame.columns and sorted(map(str, got.collect())) == sorted(map(str, want))
    assert decontam.without_items(docs(spark, []), bench).count() == 0
    assert decontam.without_items(frame, bench.limit(0)).count() == len(AWKWARD)
