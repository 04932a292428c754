"""A corpus made ready for training: five stages, each one of the operators.

toxicity drops documents that the compression classifier rejects; near_dedup
keeps one document of each group of near copies, by five-word shingles and a
similarity of 0.8 or more: candidates come from the covering SimHash operator and,
beyond its radius, from MinHash bands; decontaminate drops documents that hold a
benchmark item; pii masks personal data in the texts; mix gives
each use of a document in a mixture of the sources, hot sources once and small
ones up to twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxmetrics.llm import decontam, mixing, neardup, pii, toxicity
from boxmetrics.llm.common import free_name, staged, table

REPETITION_LIMIT = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, each judged by its own text; a null text counts as empty."""
    known = ~toxicity.held_out()
    return toxicity.keep_ordinary(docs, docs.where(known), table(spark, sf_dir, "labels").where(known))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id; rows without an id come last, none is lost that has no copy."""
    return neardup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null texts hold none."""
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind, n_chars brought up to date; null texts stay null."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document, all of its columns and the mixture's: tokens, epoch, block, at, within.

    Rows are named by all that is in them, and by a number where they repeat, so
    null and repeated ids lose and multiply nothing and the mixture is the same
    however the rows lie. A column of the mixture whose name a document column
    has already gets an underscore before it.
    """
    row = free_name(docs.columns, "__row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    whole = F.sha2(F.to_json(F.struct(*[F.col(c) for c in docs.columns])), 256).alias("__name")
    keyed = rows.select("doc_id", "text", "source", F.col(row).alias("__row"), whole)
    uses = mixing.mix(keyed, repetition_limit=REPETITION_LIMIT, carry=("__row",), name="__name").drop("doc_id", "source").withColumnRenamed("__row", row)
    uses = uses.withColumnsRenamed({c: free_name(docs.columns, c) for c in uses.columns if c != row})
    return rows.join(uses, row).drop(row)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", mask_pii),
    ("mix", mix_sources),
]

#: SQL cannot express the stages; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
