"""Inputs that every operator must stand: nulls, empty and long texts, ties, clashing columns."""

from pyspark.sql import types as T

WIDE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *[T.StructField(c, T.StringType()) for c in ("fp", "h", "g", "at", "same", "score", "a", "b", "key", "mask", "low", "root", "kept", "words", "id", "gif")],
    ]
)


def docs(spark, rows):
    """Rows (doc_id, text[, source]) as documents with clashing extra columns."""
    out = []
    for r in rows:
        i, t, s = (*r, "src0")[:3]
        out.append((i, t, "en", s, None if t is None else len(t), *["x"] * 16))
    return spark.createDataFrame(out, WIDE)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "a"),
    (5, "a b"),
    (6, "ünïcödé 😀 \x00 text"),
    (7, "word " * 30_000),
    (8, "x" * 100_000),
    (9, "The same text as another row, ten words in all."),
    (10, "The same text as another row, ten words in all."),
    (10, "The same text as another row, ten words in all."),
    (None, "a text without an id"),
    (11, "7" * 20_000 + " " + "1-" * 10_000),
]
