import hashlib
import random

import duckdb

from boxmetrics.llm import substring

from ..conftest import MEDIUM
from .cases import AWKWARD, docs


def brute(rows, n):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - n + 1):
                key = tuple(w[k : k + n])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for k in range(len(w) - n + 1):
                if first[tuple(w[k : k + n])] < i:
                    gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def test_equals_brute_force_on_small_windows(spark):
    rng = random.Random(2)
    for window in (4, 7):
        rows = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 40)))) for i in range(60)] + AWKWARD[:6] + AWKWARD[8:12]
        got = sorted((tuple(r) for r in substring.remove_repeats(docs(spark, rows), window).collect()), key=str)
        assert got == brute(rows, window)


def test_awkward_rows(spark):
    got = sorted((tuple(r) for r in substring.remove_repeats(docs(spark, AWKWARD)).collect()), key=str)
    assert got == brute(AWKWARD, 50)
    assert substring.remove_repeats(docs(spark, [])).count() == 0


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in substring.op8_substring_countmin(spark, MEDIUM).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{MEDIUM}/documents.parquet')")
    assert got == sorted(con.sql(substring.OP8_SQL).fetchall())
    assert sum(r[2] for r in got) > 0
    assert all(r[3] == hashlib.sha256(b"").hexdigest() for r in got if r[1] == r[2])
