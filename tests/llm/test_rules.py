"""Quality rules: counts and quantiles against plain code, thresholds of small groups, awkward rows."""

import random
import re
from collections import Counter

import pytest

from boxmetrics.llm import rules

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dups = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def random_text(rng):
    line = " ".join(rng.choice(["a", "bb", "cé", "d#", "e f"]) for _ in range(rng.randrange(1, 14)))
    return rng.choice(["\n", " ", "\t\n", "\r\n", "\v"]).join(rng.choice([line, line + " x", " ".join(rng.choice("pqrs") for _ in range(rng.randrange(30))), "", "  "]) for _ in range(rng.randrange(9)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ["", " ", "a " * 7, "a " * 8, "a " * 9, "x y\nx y\n\n\nx y"] + [random_text(rng) for _ in range(300)]


def test_counts_equal_plain_code(spark, texts):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in rules.measured(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(t), repr(t)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_a_very_long_text(spark):
    text = " ".join(str(i) for i in range(400_000)) + " " + " ".join(str(i) for i in range(100))
    r = rules.measured(spark.createDataFrame([(1, text, "en", "s")], SCHEMA)).first()
    assert (r.n_words, r.n_repeat_words) == (400_100, 200)


def test_cells_know_values_to_a_thirtysecond(spark):
    values = [*range(3000), *(random.Random(1).randrange(1 << 50) for _ in range(500))]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for v, c in df.select("v", rules.cell(df.v)).collect():
        assert c <= v and v - c <= v / 32 and (v >= 64 or c == v)


def test_sketches_merge_and_give_quartiles(spark):
    rng = random.Random(2)
    values = [(rng.choice(["a", "b"]), int(rng.lognormvariate(5, 1))) for _ in range(3000)]
    df = spark.createDataFrame([("", s, v, v, v, v) for s, v in values], "lang string, source string, word_length long, symbol_share long, line_share long, repeat_share long")
    parts = rules.sketches(df.where("source = 'a'")).union(rules.sketches(df.where("source = 'b'")))
    whole = {tuple(r) for r in rules.merged(rules.sketches(df)).collect()}
    assert {tuple(r) for r in rules.merged(parts).collect()} == whole
    for keys, held in ((["source"], None), ([], [v for _, v in values])):
        for r in rules.quartiles(rules.merged(parts, *keys), *keys).collect():
            mine = sorted(held if held is not None else [v for s, v in values if s == r.source])
            for q, got in ((1, r.q1), (3, r.q3)):
                true = mine[-(-q * len(mine) // 4) - 1]
                assert got <= true <= got + true / 32 and r["size"] == len(mine)


def words(n, of="abcd", rng=random.Random(9)):
    return " ".join("".join(rng.choice("klmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_thresholds_follow_the_source_and_small_groups_the_language(spark):
    rng = random.Random(4)
    rows = [(i, words(60), "en", "prose") for i in range(300)]
    rows += [(1000 + i, " ".join(w + rng.choice(["#", "%", ""]) for w in words(60).split()), "en", "code") for i in range(300)]
    rows += [(2000, words(60), "en", "small"), (2001, " ".join(w + "#" for w in words(60).split()), "en", "prose"), (2002, words(60), "xx", "tiny")]
    got = {r.doc_id: r for r in rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].kept for i in range(300)) and all(got[1000 + i].kept for i in range(300)), "what a source does as a rule is no fault"
    assert not got[2001].kept and got[2000].kept
    assert [got[i].level for i in (0, 1000, 2000, 2002)] == ["source", "source", "language", "all"]


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (1, "", "en", None), (1, "", "en", None), (1, words(40), None, "s"), (None, words(40), "en", "s")]
    docs = spark.createDataFrame([(*r, "extra", 7) for r in rows], SCHEMA + ", kept string, n_words int")
    got = rules.judged(docs).select("doc_id", "n_words", "base_failed", "kept").collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in got) == [(0, 0, True, False), (0, 40, False, True), (1, 0, True, False), (1, 0, True, False), (1, 40, False, True)]
    assert rules.judged(docs.limit(0)).count() == 0


def test_the_same_however_dealt(spark):
    docs = spark.createDataFrame([(i, words(30 + i % 7), "en", "ab"[i % 2]) for i in range(500)], SCHEMA)
    a, b = (sorted(map(tuple, rules.judged(docs.repartition(n)).drop("salt").collect())) for n in (2, 9))
    assert a == b
