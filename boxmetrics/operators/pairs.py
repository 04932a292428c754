"""Pairs of texts that are alike, without comparing all: prefixes of rare words, and rare grams for one within another.

Both joins are exact: a pair of at least the stated likeness is never missed.
Texts come in once each; rows with equal texts are joined back by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxmetrics.functions import text as tx

GRAM = 3


def _by_rarity(rows: DataFrame, name: str, words: str, counts: DataFrame) -> DataFrame:
    """Texts with their words, the rarest of all texts first."""
    each = rows.select(name, F.explode(words).alias("word")).join(counts, "word")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda w: w["word"])
    return each.groupBy(name).agg(ordered.alias("words"))


def _keys(least: float) -> Column:
    """What a text is looked up by: single words if one common word may do, else pairs of words, of its rarest.

    Two sets that share k words share two of the first n - k + 2, by any order that both follow.
    """
    size = F.size("words")
    need = F.ceil(size * F.lit(least) - 1e-9)
    first = F.slice("words", 1, F.least(size, size - need + 2).cast("int"))
    pairs = F.flatten(F.transform(first, lambda a, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda b: F.concat(a, F.lit(" "), b))))
    return F.concat(F.when(need <= 1, F.col("words")).otherwise(F.array().cast("array<string>")), pairs)


def similar_sets(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of texts whose words (a, x and b, y: arrays of distinct words) meet: common words over the larger set at ``least``.

    A common word or pair of words brings only those texts together that have it
    among their rarest, so frequent words do so only where they are enough by
    themselves; heavy keys of the join are left to Spark to split. Texts without
    words have no partners.
    """
    both = left.select(F.explode("x").alias("word")).union(right.select(F.explode("y").alias("word")))
    counts = both.groupBy("word").agg(F.count("*").alias("n"))
    a = _by_rarity(left, "a", "x", counts).select("a", F.col("words").alias("x"), F.explode(_keys(least)).alias("key"))
    b = _by_rarity(right, "b", "y", counts).select("b", F.col("words").alias("y"), F.explode(_keys(least)).alias("key"))
    larger, smaller = F.greatest(F.size("x"), F.size("y")), F.least(F.size("x"), F.size("y"))
    enough = lambda common: common >= larger * F.lit(least) - 1e-9
    return a.join(b, "key").where(enough(smaller) & enough(F.size(F.array_intersect("x", "y")))).select("a", "b").distinct()


def _grams(c: Column, size: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - size + 1, F.lit(1))), lambda i: F.substring(c, i, size)))


def containing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) in which ``b`` stands within ``a``: each b is looked up by its rarest gram, or as a whole if it is short."""
    whole = F.filter(F.concat(*[_grams(F.col("a"), n) for n in range(1, GRAM + 1)]), lambda g: g != "")
    index = left.select("a", F.explode(F.array_distinct(whole)).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    of_b = F.when(F.length("b") < GRAM, F.array("b")).otherwise(_grams(F.col("b"), GRAM))
    asked = right.where("b <> ''").select("b", F.explode(of_b).alias("gram")).join(counts, "gram", "left")
    rarest = asked.groupBy("b").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return index.join(rarest, "gram").where(F.col("a").contains(F.col("b"))).select("a", "b").distinct()


def similar_texts(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, score) of distinct texts with :func:`boxmetrics.functions.text.token_overlap` at ``least`` (above 0) or more.

    Null and empty texts have no partners.
    """
    a = left.where("a <> ''").select("a").distinct()
    b = right.where("b <> ''").select("b").distinct()
    words = lambda c: F.array_distinct(F.split(c, " "))
    found = similar_sets(a.withColumn("x", words("a")), b.withColumn("y", words("b")), least)
    if least <= 0.8:
        turned = containing(b.select(F.col("b").alias("a")), a.select(F.col("a").alias("b"))).select(F.col("b").alias("a"), F.col("a").alias("b"))
        found = found.union(containing(a, b)).union(turned).distinct()
    return found.withColumn("score", tx.token_overlap(F.col("a"), F.col("b"))).where(F.col("score") >= least - 1e-9)
