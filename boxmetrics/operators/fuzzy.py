"""Fuzzy title search: trigram blocking by an equi-join, then a sequence ratio."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def trigrams(c: Column) -> Column:
    """The distinct trigrams of the text with two blanks at each end."""
    padded = F.concat(F.lit("  "), c, F.lit("  "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, 3)))


@F.pandas_udf(DoubleType())
def ratio(query: pd.Series, candidate: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(query, candidate, strict=True)], dtype="float64")


# Titles a gram may be in and still block, titles compared, least ratio, ids kept.
COMMON, SCORED, LEAST, BEST = 3000, 100, 0.55, 5


def fuzzy_candidates(queries: DataFrame, catalogue: DataFrame, common: int = COMMON, scored: int = SCORED, least: float = LEAST, best: int = BEST) -> DataFrame:
    """Up to ``best`` catalogue rows (id, key) for each query (query_id, key).

    Keys are looked up once each, however many rows have them; ids come back
    after the ranking. Grams of more than ``common`` keys do not block; a query
    all of whose grams are so common is looked up by its rarest one. Of the keys
    found the ``scored`` with most shared grams are compared, and an equal key
    always. Null or empty keys find nothing.
    """
    keys = lambda df, name: df.where(F.length("key") > 0).select(F.col("key").alias(name)).distinct()
    asked, known = keys(queries, "asked"), keys(catalogue, "found")
    index = known.select("found", F.explode(trigrams(F.col("found"))).alias("gram"))
    sizes = index.groupBy("gram").agg(F.count("*").alias("n"))
    grams = asked.select("asked", F.explode(trigrams(F.col("asked"))).alias("gram")).join(sizes, "gram")
    rarest = Window.partitionBy("asked").orderBy("n", "gram")
    grams = grams.withColumn("_n", F.row_number().over(rarest)).where((F.col("n") <= common) | (F.col("_n") == 1)).select("asked", "gram")
    shared = grams.join(index, "gram").groupBy("asked", "found").agg(F.count("*").alias("shared"))
    near = Window.partitionBy("asked").orderBy((F.col("asked") != F.col("found")).cast("int"), F.desc("shared"), "found")
    block = shared.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= scored)
    rows = block.select("asked", "found", ratio("asked", "found").alias("score")).where(F.col("score") >= least)
    # a key has one id at least: keys of lower scores than the best few are not needed
    rows = rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("asked").orderBy(F.desc("score")))).where(F.col("_n") <= best)
    # of one key the smallest ids alone can be kept, and queries of one key are answered alike: neither brings all its rows
    few = Window.partitionBy("found").orderBy("id")
    known_ids = catalogue.select("id", F.col("key").alias("found")).join(rows.select("found").distinct(), "found", "left_semi")
    known_ids = known_ids.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= best).drop("_n")
    place = Window.partitionBy("asked").orderBy(F.desc("score"), "id")
    answers = rows.drop("_n").join(known_ids, "found").withColumn("place", F.row_number().over(place)).where(F.col("place") <= best)
    answers = answers.drop("place").join(queries.select("query_id", F.col("key").alias("asked")), "asked")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")  # a query may have several keys
    return answers.withColumn("place", F.row_number().over(place)).where(F.col("place") <= best).select("query_id", "id", "score", "place")


def unresolved(queries: DataFrame, assigned: DataFrame, exact: DataFrame) -> DataFrame:
    """The queries (query_id, key) that have neither an assignment nor a catalogue key equal to theirs: only these are searched for."""
    return queries.join(assigned.select("query_id"), "query_id", "left_anti").join(exact.select("key"), "key", "left_anti").select(*queries.columns)
