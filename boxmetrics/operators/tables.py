"""Merging, catalogues, matching and checks on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def first_source_wins(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    return first.unionByName(second.join(first, key, "left_anti"))


def completeness(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])


def canonical(sources: list[DataFrame], key: str, fields: list[str]) -> DataFrame:
    """All sources together, per key the most complete row; a tie goes to the earlier source."""
    tagged = [s.withColumn("origin", F.lit(i)) for i, s in enumerate(sources)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return best_row(union.withColumn("complete", completeness(fields)), [key], [F.desc("complete"), F.col("origin")])


def latest(updates: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One update a key: the first in ``order``; without one the largest by all its columns, so that a rerun agrees."""
    rest = [F.desc_nulls_last(c) for c in updates.columns if c not in keys]
    return best_row(updates, keys, order or rest or [F.col(keys[0])])


def merge_latest(base: DataFrame, updates: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Upsert: a row of ``updates`` replaces the rows of ``base`` with its key; of several for a key one counts, see :func:`latest`."""
    return base.join(updates.select(*keys), keys, "left_anti").unionByName(latest(updates, keys, order))


def insert_if_absent(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return base.unionByName(rows.join(base.select(*keys), keys, "left_anti"))


def guarded_merge(base: DataFrame, updates: DataFrame, key: str, protected: Column, value: str) -> DataFrame:
    """Upsert of one column that leaves protected rows as they are; ``protected`` reads the base's columns. A key is updated once."""
    new = latest(updates.select(key, value), [key]).select(F.col(key).alias("_key"), F.col(value).alias("_new"))
    joined = base.join(new, base[key] == new["_key"], "left")
    return joined.withColumn(value, F.when(protected | F.col("_key").isNull(), F.col(value)).otherwise(F.col("_new"))).drop("_key", "_new")


def source_sets(tagged: DataFrame, key: str, tag: str) -> DataFrame:
    """Per key the sorted set of its sources, joined by commas."""
    return tagged.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(tag)), ",").alias("sources"))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows a rule, with the number that break it."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("broken")) for n in rules])).alias("r")).select("r.rule", "r.broken")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def plausible_year(made: Column, granted: Column, kind: Column) -> Column:
    """Whether a year of making fits a grant: redemption grants look back six years, others two back to six on."""
    low = F.when(kind == "redemption", granted - 6).when(kind.isNull(), granted - 6).otherwise(granted - 2)
    high = F.when(kind == "redemption", granted).otherwise(granted + 6)
    return F.coalesce(made.between(low, high), F.lit(False))


def candidates(queries: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Queries (query_id, key, year, kind) with the catalogue rows (id, key, year) of their key.

    One row a query: number of distinct ids, the smallest, and whether it is
    alone and of a plausible year.
    """
    # one row a key before the join: a common key does not meet all of its queries
    first = F.min(F.struct("id", F.col("year").alias("made"))).alias("first")
    c = catalogue.groupBy("key").agg(F.count_distinct("id").alias("n"), first)
    out = queries.join(c, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fits = plausible_year(F.col("first.made"), F.col("year"), F.col("kind"))
    return out.select("query_id", "n", F.col("first.id").alias("id"), (F.col("n") == 1).alias("alone"), ((F.col("n") == 1) & fits).alias("safe"))


def route(found: DataFrame) -> DataFrame:
    """matched, year_conflict, pending or none for each query of :func:`candidates`."""
    return found.withColumn("route", F.when(F.col("safe"), "matched").when(F.col("alone"), "year_conflict").when(F.col("n") > 1, "pending").otherwise("none"))


# Ranks that a quantile is looked for between, as shares beside its own; groups below the size take the wider ones.
NARROW, WIDE, WIDE_BELOW, WHOLE_BELOW = 0.001, 0.02, 5000, 200


def percentile_tiers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact quantiles per group and, above each, the number and mean of the values (tiers overlap).

    A sketch of each group's ranks gives two values between which a quantile
    must lie. The values below are counted, those between (0.2 % of a large group
    for each quantile) are ordered, and all are read once more for the tiers: a
    group's values never meet in one task, whatever the values are.
    """
    ps = (25, 50, 75, 90)
    two = lambda c: F.round(c.cast("decimal(38,6)"), 2).cast("double")
    v = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    ends = [max(0.0, min(1.0, p / 100 + d)) for p in ps for d in (-NARROW, NARROW, -WIDE, WIDE)]
    span = v.groupBy("g").agg(F.count("*").alias("all"), F.min("v").alias("least"), F.max("v").alias("most"), F.percentile_approx("v", ends, 10000).alias("e"))

    def end(i: int, high: int) -> Column:
        whole = F.col("most" if high else "least")
        return F.when(F.col("all") < WHOLE_BELOW, whole).when(F.col("all") < WIDE_BELOW, F.col("e")[4 * i + 2 + high]).otherwise(F.col("e")[4 * i + high])

    span = span.select("g", "all", *[end(i, h).alias(f"{n}{p}") for i, p in enumerate(ps) for h, n in ((0, "lo"), (1, "hi"))])
    # each value is told apart from the bounds once: sketches are not the same if made again, and counts by two of them do not add up
    placed = v.join(span, "g")
    inside = [F.col("v").between(F.col(f"lo{p}"), F.col(f"hi{p}")) for p in ps]
    zones = [F.when(F.col("v") < F.col(f"lo{p}"), -1).when(i, 0).otherwise(1).alias(f"zone{p}") for p, i in zip(ps, inside, strict=True)]
    cells = placed.select("g", "all", *zones, F.when(reduce(lambda a, b: a | b, inside), F.col("v")).alias("v"))
    cells = cells.groupBy("g", "all", *[f"zone{p}" for p in ps], "v").agg(F.count("*").alias("n"))
    each = F.array(*[F.when(F.col(f"zone{p}") <= 0, F.struct(F.lit(p).alias("p"), F.when(F.col(f"zone{p}") == 0, F.col("v")).alias("v"))) for p in ps])
    between = cells.select("g", "all", "n", F.explode(F.array_compact(each)).alias("c")).groupBy("g", "all", "c.p", "c.v").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("g", "p").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = between.withColumn("last", F.sum("n").over(upto))  # with those below, which have no value: ranks last - n .. last - 1
    at = (F.col("all") - 1) * F.col("p") / 100
    holds = lambda rank: (F.col("last") > rank) & (F.col("last") - F.col("n") <= rank)
    found = ranked.groupBy("g", "p").agg(F.max(F.when(holds(F.floor(at)), F.col("v"))).alias("a"), F.max(F.when(holds(F.ceil(at)), F.col("v"))).alias("b"), F.first(at).alias("at"))
    cut = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    q = found.groupBy("g").agg(*[F.max(F.when(F.col("p") == p, cut)).alias(f"q{p}") for p in ps])
    above = [F.col("v") >= F.col(f"q{p}") for p in ps]
    counts = [F.count_if(a).alias(f"n{p}") for a, p in zip(above, ps, strict=True)]
    means = [two(F.avg(F.when(a, F.col("v")))).alias(f"mean{p}") for a, p in zip(above, ps, strict=True)]
    cuts = [two(F.first(f"q{p}")).alias(f"p{p}") for p in ps]
    return v.join(q, "g").groupBy(F.col("g").alias(group)).agg(*cuts, *counts, *means)


def mature(released: Column, made: Column, as_of: str, months: int = 2) -> Column:
    """Out for ``months`` at ``as_of``; without a release day, made before that year."""
    day = F.lit(as_of).cast("date")
    return F.coalesce(released < F.add_months(day, -months), made < F.year(day), F.lit(False))


def efficiency(df: DataFrame, units: str, amount: str) -> Column:
    """Units per thousand of amount."""
    return F.round((1000.0 * F.col(units).cast("double") / F.nullif(F.col(amount).cast("double"), F.lit(0.0))).cast("decimal(38,6)"), 4).cast("double")
