"""Running states against stepping through the rows one by one."""

import random

import pytest

from boxmetrics.operators import layout as ly
from boxmetrics.operators.scan import Machine

COUNTER = Machine([{"n": n, "odd": n % 2 == 1} for n in range(5)], {"add": [0, 1, 3]}, lambda s, x: {"n": (s["n"] + x["add"]) % 5, "odd": (s["n"] + x["add"]) % 5 % 2 == 1})


@pytest.mark.parametrize("machine", [COUNTER, ly.BOOK, ly.TABLES], ids=["counter", "book", "tables"])
def test_states_equal_stepping(spark, machine):
    rng = random.Random(len(machine.states))
    rows = [(doc, i, rng.randrange(len(machine.symbols))) for doc, n in enumerate((0, 1, 63, 64, 65, 300)) for i in range(n)]
    want, state = {}, 0
    for doc, i, symbol in rows:
        state = 0 if i == 0 else state
        want[doc, i] = state
        state = machine.table[symbol * len(machine.states) + state]
    df = spark.createDataFrame(rows, "doc int, line int, symbol int").repartition(3)
    got = {(r.doc, r.line): r.state for r in machine.before(df, ["doc"], ["line"], "symbol").collect()}
    assert got == want


def test_symbols_and_flags(spark):
    from pyspark.sql import functions as F

    rows = [(a, b, c) for a in ("more", "title", "figures", None) for b in (True, False) for c in (True, None)]
    df = spark.createDataFrame(rows, "kind string, titled boolean, whole boolean")
    got = df.select("*", ly.BOOK.symbol(kind=F.col("kind"), titled=F.col("titled"), whole=F.col("whole")).alias("s")).collect()
    for r in got:
        assert ly.BOOK.symbols[r.s] == {"kind": r.kind or "more", "titled": r.titled, "whole": bool(r.whole)}
    states = spark.range(len(ly.BOOK.states)).select(ly.BOOK.flag(F.col("id").cast("int"), "film").alias("film"), ly.BOOK.flag(F.col("id").cast("int"), "early").alias("early")).collect()
    assert [(r.film, r.early) for r in states] == [(s["film"], s["early"]) for s in ly.BOOK.states]
