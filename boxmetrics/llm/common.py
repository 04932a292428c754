"""What the training-data operators share: inputs, shared staging, word splitting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null becomes empty), with no other column that could clash."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset and all tasks run in this process, as in local tests, a
    temporary folder is chosen and set. Staged tables stay there until the folder is
    cleared, so that a lost executor can read them again.
    """
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not known:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        known = tempfile.mkdtemp(prefix="spark-shared-")
        sc.setCheckpointDir(known)
    return known.rstrip("/")


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def lowered_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes with A-Z lowered; bytes.split() cuts at just these."""
    return data.lower().split()
