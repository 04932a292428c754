"""Quality rules whose thresholds come from the data: a quantile sketch per language and source.

Each document is measured (word length, symbols, repeated lines, repeated
words). A sketch of a measure is the table of its counts by leading bits:
values keep their six highest bits, so a sketch has at most 32 cells for each
power of two, a value is known to within 1/32 of itself, and sketches merge by
adding counts. The sketches of sources merge into those of languages, and
those into one of all; a group of few documents takes the thresholds of the
next wider one. Thresholds are far-out fences, quartiles and three times the
spread between them, so that what few documents do is an outlier and what a
source does as a rule is not. They are joined back to the documents.

Nothing is random: equal tables give equal thresholds, however they are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
BITS = 6
#: Documents a group needs for thresholds of its own.
LEAST = 200
FENCE = 3
SALTS = 16
BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
#: Measures in thousandths: (name, numerator, denominator, least spread, whether low values are faults too).
#: With the least spread, one repeated line or symbol in a short text is no outlier where others have none.
MEASURES = [
    ("word_length", "word_chars", "n_words", 300, True),
    ("symbol_share", "n_symbols", "n_words", 10, False),
    ("line_share", "n_dup_lines", "n_lines", 150, False),
    ("repeat_share", "n_repeat_words", "n_words", 80, False),
]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(docs: list[list[bytes]], width: int = WINDOW) -> np.ndarray:
    """For each document (its words) how many words lie in windows that it holds twice or more.

    Windows are first told apart by a hash, which never parts equal ones; those
    that share a hash are then compared word by word.
    """
    out = np.zeros(len(docs), np.int64)
    long = [i for i, words in enumerate(docs) if len(words) > width]
    if not long:
        return out
    known: dict[bytes, int] = {}
    lens = np.array([len(docs[i]) for i in long])
    ids = np.fromiter((known.setdefault(w, len(known)) for i in long for w in docs[i]), np.int64, int(lens.sum()))
    owner = np.repeat(np.arange(len(long)), lens)
    ends = np.cumsum(lens)
    starts = np.flatnonzero(np.arange(len(ids)) + width <= ends[owner])
    keys = owner[starts].astype(np.uint64)
    values = ids.astype(np.uint64)
    for k in range(width):
        keys = (keys ^ values[starts + k]) * _ODD
        keys ^= keys >> np.uint64(29)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return out
    member = np.zeros(len(starts), bool)
    member[order[1:][same]] = True
    member[order[:-1][same]] = True
    some = starts[member]
    rows = np.column_stack([owner[some], *[ids[some + k] for k in range(width)]])
    _, at, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    found = some[counts[at.reshape(-1)] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    out[long] = np.bincount(owner[covered], minlength=len(long))
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, lang, source, text) to the counts of each text, about 200,000 words at a time."""

    def rows(cols: dict, held: list[list[bytes]]) -> pa.RecordBatch:
        cols["n_repeat_words"] = repeated_words(held)
        return pa.RecordBatch.from_pydict(cols)

    for batch in batches:
        ids, langs, sources = (batch.column(i) for i in range(3))
        data = batch.column(3).cast(pa.binary())
        begin, held, counts, words_held = 0, [], [], 0
        for i, text in enumerate(data):
            raw = text.as_py()
            words = raw.split()
            lines = [line for line in raw.split(b"\n") if line.strip()]
            solid = raw.translate(None, BLANKS)
            counts.append((len(words), len(solid.decode()), len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), len(lines)))
            held.append(words)
            words_held += len(words)
            if words_held >= 200_000 or i == len(data) - 1:
                n = i + 1 - begin
                cols = {"doc_id": ids.slice(begin, n), "lang": langs.slice(begin, n), "source": sources.slice(begin, n)}
                cols |= dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"), np.array(counts, np.int64).T, strict=True))
                yield rows(cols, held)
                begin, held, counts, words_held = i + 1, [], [], 0


def measured(docs: DataFrame) -> DataFrame:
    """One row of counts per row of ``docs``; null text, lang and source count as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    schema = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names, text).mapInArrow(_measured, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    shares = [F.expr(f"1000 * {top} div greatest({below}, 1)").alias(name) for name, top, below, _, _ in MEASURES]
    return out.select("*", failed.alias("base_failed"), *shares)


def cell(value: Column, bits: int = BITS) -> Column:
    """A whole number without all but its ``bits`` highest bits: the least value of its cell of a sketch."""
    drop = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """Rows of measures to their sketches: (lang, source, measure, cell, n); counts of partitions are added."""
    cells = F.array(*[F.struct(F.lit(name).alias("measure"), cell(F.col(name)).alias("cell")) for name, *_ in MEASURES])
    return rows.select("lang", "source", F.inline(cells)).groupBy("lang", "source", "measure", "cell").agg(F.count("*").alias("n"))


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Sketches of wider groups, by adding up those of their parts."""
    return parts.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """For each group and measure its size and quartile cells: (keys, measure, size, q1, q3).

    A quartile is the first cell at which the counts so far reach its share of the group.
    """
    group = Window.partitionBy(*keys, "measure")
    counted = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("cell")), "size": F.sum("n").over(group)})
    reached = [F.min(F.when(4 * F.col("upto") >= q * F.col("size"), F.col("cell"))).alias(f"q{q}") for q in (1, 3)]
    return counted.groupBy(*keys, "measure").agg(F.first("size").alias("size"), *reached)


def thresholds(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """Fences for each (lang, source) of ``rows`` that do not fail already: (lang, source, level, lo_ and hi_ of each measure).

    ``level`` says whose sketch they come from: source, language or all.
    """
    parts = staged(sketches(rows.where("not base_failed")), "rule-sketches")
    own = quartiles(parts, "lang", "source")
    langs = quartiles(merged(parts, "lang"), "lang")
    everything = quartiles(merged(parts))
    named = own.select("lang", "source", "measure", F.struct("size", "q1", "q3").alias("own"))
    named = named.join(langs.select("lang", "measure", F.struct("size", "q1", "q3").alias("wide")), ["lang", "measure"])
    named = named.join(everything.select("measure", F.struct("size", "q1", "q3").alias("whole")), "measure")
    level = F.when(F.col("own.size") >= least, "source").when(F.col("wide.size") >= least, "language").otherwise("all")
    pick = F.when(F.col("own.size") >= least, F.col("own")).when(F.col("wide.size") >= least, F.col("wide")).otherwise(F.col("whole"))
    spread = F.coalesce(*[F.when(F.col("measure") == name, F.lit(small)) for name, _, _, small, _ in MEASURES])
    fence = FENCE * F.greatest(F.col("pick.q3") - F.col("pick.q1"), spread)
    named = named.select("lang", "source", "measure", level.alias("level"), pick.alias("pick"))
    named = named.select("lang", "source", "measure", "level", (F.col("pick.q1") - fence).alias("lo"), (F.col("pick.q3") + fence).alias("hi"))
    ends = [F.max(F.when(F.col("measure") == name, F.col(end))).alias(f"{end}_{name}") for name, *_ in MEASURES for end in ("lo", "hi")]
    return named.groupBy("lang", "source").agg(F.first("level").alias("level"), *ends)


def judged(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The counts of each row of ``docs``, ``base_failed``, the level of its thresholds, and ``kept``.

    A row is kept if it does not fail the base rules and no measure lies past
    its fence. Rows with null or repeated ids are kept apart; null text, lang
    and source count as empty. Where all rows of a group fail the base rules
    it has no thresholds (``level`` null) and needs none. An empty table gives
    no rows. Rows of a hot source are dealt over several tasks for the join.
    """
    rows = staged(measured(docs), "rule-measures")
    limits = thresholds(rows, least).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.hash("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
    passed = F.lit(True)
    for name, _, _, _, low in MEASURES:
        passed &= F.col(name) <= F.col(f"hi_{name}")
        if low:
            passed &= F.col(name) >= F.col(f"lo_{name}")
    kept = ~F.col("base_failed") & F.coalesce(passed, F.lit(True))
    return dealt.join(limits, ["lang", "source", "salt"], "left").withColumn("kept", kept)


def op13_quality_quantiles(spark, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "level")


def _limits_sql() -> str:
    spread = "CASE measure " + " ".join(f"WHEN '{name}' THEN {small}" for name, _, _, small, _ in MEASURES) + " END"
    ends = ", ".join(f"max(CASE WHEN measure = '{name}' THEN {sign} END) AS {end}_{name}" for name, *_ in MEASURES for end, sign in (("lo", "q1 - fence"), ("hi", "q3 + fence")))
    return f"""SELECT lang, source, min(level) AS level, {ends} FROM (
  SELECT *, {FENCE} * greatest(q3 - q1, {spread}) AS fence FROM picked) GROUP BY lang, source"""


def _quartiles_sql(keys: str) -> str:
    by = ", ".join([*keys.split(), "measure"])
    return f"""SELECT {by}, max(size) AS size, min(CASE WHEN 4 * upto >= size THEN cell END) AS q1, min(CASE WHEN 4 * upto >= 3 * size THEN cell END) AS q3 FROM (
  SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY {by}) AS size
  FROM (SELECT {by}, cell, sum(n) AS n FROM cells GROUP BY {by}, cell)) GROUP BY {by}"""


_WORDS = r"[^\x20\x09-\x0D]+"
_passed_sql = " AND ".join(f"{name} <= hi_{name}" + (f" AND {name} >= lo_{name}" if low else "") for name, *_, low in MEASURES)
_pick_sql = ", ".join(f"CASE WHEN o.size >= {LEAST} THEN o.{q} WHEN l.size >= {LEAST} THEN l.{q} ELSE a.{q} END AS {q}" for q in ("q1", "q3"))

#: Rows of documents are told apart by a number of their own.
OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{_WORDS}') AS w FROM docs),
windows AS (SELECT k, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT k, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM worded)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, {WINDOW})) AS j) GROUP BY k),
lined AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{_WORDS}') GROUP BY k),
counted AS (
  SELECT d.k, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n_dup, 0) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM worded d LEFT JOIN lined l ON d.k = l.k LEFT JOIN covered c ON d.k = c.k),
rows_ AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
    {", ".join(f"(1000 * {top}) // greatest({below}, 1) AS {name}" for name, top, below, _, _ in MEASURES)} FROM counted),
cells AS (
  SELECT lang, source, m.name AS measure, (m.v >> greatest(length(bin(m.v)) - {BITS}, 0)) << greatest(length(bin(m.v)) - {BITS}, 0) AS cell, count(*) AS n
  FROM (SELECT lang, source, unnest([{", ".join(f"{{'name': '{name}', 'v': {name}::BIGINT}}" for name, *_ in MEASURES)}]) AS m FROM rows_ WHERE NOT base_failed)
  GROUP BY ALL),
own AS ({_quartiles_sql("lang source")}),
langs AS ({_quartiles_sql("lang")}),
whole AS ({_quartiles_sql("")}),
picked AS (
  SELECT o.lang, o.source, o.measure, CASE WHEN o.size >= {LEAST} THEN 'source' WHEN l.size >= {LEAST} THEN 'language' ELSE 'all' END AS level, {_pick_sql}
  FROM own o JOIN langs l ON o.lang = l.lang AND o.measure = l.measure JOIN whole a ON o.measure = a.measure),
limits AS ({_limits_sql()})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({_passed_sql}, TRUE) AS kept, level
FROM rows_ r LEFT JOIN limits t ON r.lang = t.lang AND r.source = t.source
"""
