"""Conversation repair: a plain search over all edits, chunks across tasks, awkward rows."""

import hashlib
import heapq
import random
import re

import pytest

from boxmetrics.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
ORDER = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """Cheapest edits by uniform-cost search over (turns done, roles so far as a grammar state), least audit first among equals."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = [c for c in text if c not in " \t\n\r\x0b\x0c"]
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    heap, done, best = [(0, "", 0, "", ())], set(), None
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        last = (i, roles[-1:], bool(roles))
        if last in done:
            continue
        done.add(last)
        if i == len(rows) and ORDER.fullmatch(roles):
            best = (cost, audit, out)
            break
        options = [("I", 3, 0, r, "") for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            options.append(("D", 4, 1, None, None))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                options += [("K", more, 1, role, text), *[("R", 3 + more, 1, r, text) for r in ("user", "assistant")]]
        for letter, price, step, role, text in options:
            new = roles if role is None else roles + (role[:1] or "?")
            if re.fullmatch(r"s?(ua)*u?", new):
                heapq.heappush(heap, (cost + price, audit + letter, i + step, new, out if role is None else (*out, f"{role}:{text}")))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    letters = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(spark, rows, parts=4):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        got = {r.conv_id: tuple(r[c] for c in COLS) for r in repair.summary(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    convs = {}
    for conv, *rest in rows:
        convs.setdefault(conv, []).append(rest)
    assert got.keys() == convs.keys()
    for conv, turns in convs.items():
        assert got[conv] == plain(turns), (conv, turns)


def random_rows(rng, convs, most=7):
    out = []
    for c in range(convs):
        for i in range(rng.randrange(1, most)):
            turn = rng.choice([i, i, i, i, i + 3, 2, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "u"])
            text = rng.choice(["Yes.", "No!", "a?", "cut", "", " \t", None, "é. \n", f"t{i}.", f"t{i}."])
            out.append((c if c else None, turn, role, text))
            if rng.random() < 0.1:
                out.append(out[-1])
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_random_conversations(spark, parts):
    check(spark, random_rows(random.Random(parts), 250), parts)


@pytest.mark.parametrize("seed", range(2))
def test_long_conversations_in_chunks_over_tasks(spark, monkeypatch, seed):
    monkeypatch.setattr(repair, "CHUNK_TURNS", 5)
    rng = random.Random(seed)
    rows = [(c, rng.choice([i, i // 3, None]) if c == 2 else i, rng.choice(["user", "assistant", "system"] if c else ["user", "assistant"]), rng.choice([f"{i}.", f"{i}", f"{i % 9}!", ""])) for c in range(4) for i in range(60)]
    rows += [(9, 1, "user", "same.")] * 40 + [(9, 2, "assistant", "end.")] * 3
    check(spark, rows + random_rows(rng, 30), 7)


def test_a_hot_conversation(spark):
    n = 3000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(n)] + [(1, n, "user", "copy.")] * 5000
    got = repair.summary(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1 and got[0].cost == 4 * 4999 + 3 and got[0].audit == "K" * (n + 1) + "D" * 4999 + "I" and got[0].duplicate == 4999
    pieces = repair.repair(spark.createDataFrame(rows, SCHEMA))
    left = repair.repaired_turns(pieces).orderBy("part", "seq", "at").collect()
    assert [r.text for r in left] == [f"turn {i}." for i in range(n)] + ["copy.", ""]


def test_a_very_long_text_and_extra_columns(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + ".", 1, "a"), (1, 1, "assistant", "y" * 3_000_000 + ".", 2, "b"), (1, 2, "user", "q.", 3, "c")]
    got = repair.summary(spark.createDataFrame(rows, SCHEMA + ", cost long, audit string")).first()
    assert (got.cost, got.audit) == (3, "KKKI")


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", f"One. Two! {c}?") for c in range(30) for t in (0, 1, None)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert repair.summary(spark.createDataFrame([], SCHEMA)).count() == 0
