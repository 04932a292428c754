"""Pairs of like texts against comparing all of them."""

import random

import pytest
from pyspark.sql import functions as F

from boxmetrics.operators import pairs as pr


def overlap(a, b):
    x, y = set(a.split(" ")), set(b.split(" "))
    return 1.0 if a == b else 0.8 if a in b or b in a else len(x & y) / max(len(x), len(y))


def texts(rng, n):
    words = [f"w{i}" for i in range(40)] + ["w", "the", "of"]
    weights = [1 / (i + 1) for i in range(40)] + [1, 2, 2]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(1, 8))) for _ in range(n)] + ["", "w", "1", None, "the of", "w1 w2"]


@pytest.mark.parametrize("least", [0.34, 0.5, 0.75, 0.9, 1.0])
def test_similar_texts_equal_all_pairs(spark, least):
    rng = random.Random(int(least * 100))
    a, b = texts(rng, 150), texts(rng, 120)
    left, right = spark.createDataFrame([(t,) for t in a], "a string"), spark.createDataFrame([(t,) for t in b], "b string")
    got = {(r.a, r.b): round(r.score, 9) for r in pr.similar_texts(left, right, least).collect()}
    want = {(x, y): round(overlap(x, y), 9) for x in set(a) - {None, ""} for y in set(b) - {None, ""} if overlap(x, y) >= least - 1e-9}
    assert got == want


def test_no_common_word_brings_all_texts_together(spark):
    """Titles that all share two frequent words are met only where their own words agree."""
    n = 2000
    df = spark.createDataFrame([(f"the film of number{i} part{i // 2} city{i}",) for i in range(n)], "a string")
    left = df.withColumn("x", F.split("a", " "))
    right = left.select(F.col("a").alias("b"), F.col("x").alias("y"))
    counts = left.select(F.explode("x").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    keys = pr._by_rarity(left, "a", "x", counts).select(F.explode(pr._keys(0.6)).alias("key")).groupBy("key").count()
    assert keys.agg(F.max("count")).first()[0] <= 2
    assert pr.similar_sets(left, right, 0.6).count() == 2 * n


def test_empty_sides(spark):
    some, none = spark.createDataFrame([("x y",)], "a string"), spark.createDataFrame([], "b string")
    assert pr.similar_texts(some, none, 0.5).count() == 0
