"""Incremental ingest: each file once, each period once, restartable after a failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def first_of_period(rows: DataFrame, period: list[str], order: list[str]) -> DataFrame:
    """All rows, ``loaded`` 1 for the first of its period and 0 for those that only repeat it."""
    w = Window.partitionBy(*period).orderBy(*order)
    return rows.withColumn("loaded", (F.row_number().over(w) == 1).cast("int"))


def not_done(ids: DataFrame, progress: DataFrame, key: str, done: tuple[str, ...] = ("ok", "empty")) -> DataFrame:
    """What a resumed run has still to fetch: ids without progress, and those that failed."""
    return ids.join(progress.where(F.col("status").isin(*done)).select(key), key, "left_anti")


def incomplete(seen: DataFrame, period: str, kind: str, expected: list[str]) -> DataFrame:
    """Per period the expected kinds that are missing, joined by commas."""
    got = seen.groupBy(period).agg(F.collect_set(kind).alias("got"))
    missing = F.array_except(F.array(*[F.lit(e) for e in expected]), "got")
    return got.select(period, F.array_join(F.array_sort(missing), ",").alias("missing"))


def _between(df: DataFrame, low, high, key: str) -> DataFrame:
    """Rows whose first key may lie in a range; the bounds reach the scan of the sorted key files."""
    return df if low is None or high is None else df.where(F.col(key).between(F.lit(low), F.lit(high)))


def ingest_available(spark: SparkSession, folder: str, schema: StructType, target: str, state: str, keys: list[str], fmt: str = "json") -> None:
    """Load the files of ``folder`` that earlier calls have not, then stop.

    Every micro-batch is written to its own partition, which a repeated batch
    overwrites; rows whose keys are in an earlier batch are left out. Nulls in
    keys are equal to each other. A batch without rows writes none and hinders no
    later one. Beside the target lie the keys of each batch, sorted, and a table of
    the least and largest key of every batch so far: a batch reads the keys of
    those batches alone whose range meets its own, and of these what lies in it.
    """
    known, ranges = f"{target}-keys", f"{target}-ranges"
    key_schema = StructType([schema[k] for k in keys])
    range_schema = StructType().add("number", "long").add("lo", key_schema).add("hi", key_schema)
    key = F.struct(*keys)

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates(keys).persist()
        try:
            span = rows.agg(F.lit(number).cast("long").alias("number"), F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL").persist()
            earlier = spark.read.schema(range_schema).parquet(f"{ranges}/batch={number - 1}") if number else spark.createDataFrame([], range_schema)
            mine = span.select(F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
            meets = earlier.join(F.broadcast(mine), (F.col("lo") <= F.col("_hi")) & (F.col("hi") >= F.col("_lo")))
            numbers = [r.number for r in meets.select("number").collect()]  # one a batch at most
            new = rows
            if numbers:
                low, high = span.select(f"lo.{keys[0]}", f"hi.{keys[0]}").first()
                seen = spark.read.schema(key_schema).parquet(*[f"{known}/batch={n}" for n in numbers])
                seen = _between(seen, low, high, keys[0]).select(*[F.col(k).alias(f"_{k}") for k in keys])
                same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
                new = rows.join(seen, same, "left_anti")
            new.write.mode("overwrite").parquet(f"{target}/batch={number}")
            taken = spark.read.schema(schema).parquet(f"{target}/batch={number}").select(*keys)
            taken.sort(*keys).write.mode("overwrite").parquet(f"{known}/batch={number}")
            span_taken = taken.agg(F.lit(number).cast("long").alias("number"), F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL")
            earlier.union(span_taken).coalesce(1).write.mode("overwrite").parquet(f"{ranges}/batch={number}")
            span.unpersist()
        finally:
            rows.unpersist()

    stream = spark.readStream.format(fmt).schema(schema).load(folder)
    stream.writeStream.foreachBatch(load).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def each_whole(documents: DataFrame, key: str, valid: Column) -> DataFrame:
    """The rows of documents all of whose rows are valid: one bad row takes back its document, and no other."""
    bad = documents.where(~F.coalesce(valid, F.lit(False))).select(key).distinct()
    return documents.join(bad, key, "left_anti")
