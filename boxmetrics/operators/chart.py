"""Weekly charts: ranks, totals, concentration, capacity, decay and attendance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Places of a chart, weeks looked back on, weeks from which there are statistics and levels, deviations of a level.
SIZE, LAST, LEAST, FULL, WIDTH = 25, 52, 4, 8, 1.5


def weekly_chart(facts: DataFrame, size: int = SIZE) -> DataFrame:
    """Facts (film, day, revenue, spectators, venue) to the ``size`` best films of each week.

    Adds rank within the week, and per film the chart week's number and running totals.
    """
    rows = facts.withColumn("week", F.to_date(F.date_trunc("week", "day")))
    totals = rows.groupBy("week", "film").agg(F.sum("revenue").alias("revenue"), F.sum("spectators").cast("long").alias("spectators"), F.count("*").alias("screens"))
    best = Window.partitionBy("week").orderBy(F.desc("revenue"), "film")
    ranked = totals.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    # venues are told apart only for the films of the chart, which has ``size`` rows a week and can be sent to all tasks
    shown = rows.select("week", "film", "venue").join(F.broadcast(ranked), ["week", "film"])
    ranked = shown.groupBy(*ranked.columns).agg(F.count_distinct("venue").alias("venues"))
    run = Window.partitionBy("film").orderBy("week")
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranked.withColumn("run_week", F.row_number().over(run))
        .withColumn("revenue_total", F.sum("revenue").over(upto))
        .withColumn("spectators_total", F.sum("spectators").over(upto))
    )


def ranking(chart: DataFrame, week: str) -> DataFrame:
    return chart.where(F.col("week") == F.lit(week).cast("date"))


def weekly_totals(chart: DataFrame) -> DataFrame:
    return chart.groupBy("week").agg(F.sum("revenue").alias("revenue"), F.sum("spectators").alias("spectators"), F.max("venues").alias("most_venues"), F.count("*").alias("films"))


def summary(chart: DataFrame) -> DataFrame:
    """One row of distinct counts and the period; a pair with a null member counts."""
    return chart.agg(
        F.count_distinct("film").alias("films"),
        F.count_distinct(F.struct("week", "rank")).alias("places"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )


def openings(chart: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best first weeks by spectators."""
    return chart.where("run_week = 1").orderBy(F.desc_nulls_last("spectators"), "film").limit(k)


def top_of_year(chart: DataFrame, year: int, k: int = 20) -> DataFrame:
    """Films of a year by their largest running total; the first week is taken over all years."""
    first = F.min("week").over(Window.partitionBy("film"))
    rows = chart.withColumn("released", first).where(F.year("week") == year)
    return rows.groupBy("film").agg(F.max("revenue_total").alias("revenue"), F.min("released").alias("released")).orderBy(F.desc_nulls_last("revenue"), "film").limit(k)


def _share(part: Column) -> Column:
    return F.round((100.0 * part / F.nullif(F.sum("spectators").cast("double"), F.lit(0.0))).cast("decimal(18,6)"), 1).cast("double")


def segments(chart: DataFrame) -> DataFrame:
    """Percent of each week's spectators on ranks 1, 2-3, 4-5 and the rest."""

    def between(lo: int, hi: int) -> Column:
        return _share(F.sum(F.when(F.col("rank").between(lo, hi), F.col("spectators")).otherwise(0)).cast("double"))

    return chart.groupBy("week").agg(between(1, 1).alias("top1"), between(2, 3).alias("top3"), between(4, 5).alias("top5"), between(6, 1 << 30).alias("rest"))


def segment_stats(shares: DataFrame, last: int = LAST, least: int = LEAST, full: int = FULL) -> DataFrame:
    """Mean, sample deviation and quartiles of the top share over the last weeks.

    Mean and deviation are rounded before anyone uses them. Fewer than ``least``
    weeks give nulls, fewer than ``full`` the flag ``low_data``.
    """
    recent = shares.orderBy(F.desc("week")).limit(last).where("top1 IS NOT NULL")
    q = F.percentile("top1", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    one = lambda c: F.round(c.cast("decimal(18,6)"), 1).cast("double")
    stats = recent.agg(F.count("*").alias("weeks"), one(F.avg("top1")).alias("mean"), one(F.stddev_samp("top1")).alias("deviation"), q.alias("q"))
    known = F.col("weeks") >= least
    return stats.select("weeks", F.when(known, F.col("mean")).alias("mean"), F.when(known, F.col("deviation")).alias("deviation"), *[F.when(known, one(F.col("q")[i])).alias(f"p{p}") for i, p in enumerate((25, 50, 75))], (F.col("weeks") < full).alias("low_data"))


def classify(shares: DataFrame, stats: DataFrame, width: float = WIDTH) -> DataFrame:
    """Each week's top share against mean and deviation, refined by quartiles; no level where the weeks are too few.

    ``stats`` is the one row of :func:`segment_stats`.
    """
    s = shares.join(F.broadcast(stats), F.lit(True))
    x = F.col("top1")
    kind = (
        F.when(F.col("mean").isNull() | F.col("low_data"), None)
        .when(x > F.col("mean") + width * F.col("deviation"), "very high")
        .when(x < F.greatest(F.col("mean") - width * F.col("deviation"), F.lit(0.0)), "very low")
        .when(x > F.col("p75"), "high")
        .when(x < F.col("p25"), "low")
        .otherwise("normal")
    )
    return s.select("week", "top1", "top3", "top5", "rest", kind.alias("level"))


def capacity(totals: DataFrame) -> DataFrame:
    """Each week's spectators among all weeks: percent of weeks not above it, and least, most and floored mean.

    Weeks are counted by value, values by their cell of ten leading bits; the
    cells, a bounded list, say how many weeks lie below each, and the order within
    a cell is a matter of that cell alone.
    """
    cell = F.call_function("shiftright", F.col("spectators"), F.greatest(F.length(F.bin("spectators")) - 10, F.lit(0))) + 1024 * F.length(F.bin("spectators"))
    by_value = totals.where("spectators IS NOT NULL").groupBy("spectators", cell.alias("cell")).agg(F.count("*").alias("n"))
    cells = by_value.groupBy("cell").agg(F.sum("n").alias("n")).agg(F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("cells"))
    all_weeks = totals.agg(F.count("*").alias("weeks"), F.min("spectators").alias("least"), F.max("spectators").alias("most"), F.floor(F.avg("spectators")).alias("mean"))
    one = F.broadcast(all_weeks.join(F.broadcast(cells), F.lit(True)))
    upto = Window.partitionBy("cell").orderBy("spectators").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lower = F.aggregate(F.filter("cells", lambda c: c["cell"] < F.col("cell")), F.lit(0).cast("long"), lambda s, c: s + c["n"])
    values = by_value.withColumn("within", F.sum("n").over(upto)).join(one, F.lit(True))
    percent = F.round((100.0 * (lower + F.col("within")) / F.col("weeks")).cast("decimal(18,6)"), 0).cast("int")
    below = values.select("spectators", percent.alias("percentile"), "least", "most", "mean")
    return totals.join(below, "spectators").select("week", "spectators", "percentile", "least", "most", "mean")


def decay_curve(chart: DataFrame, weeks: int = 10) -> DataFrame:
    """Mean share of a film's total by chart week, over films that ever led, and the mean running share."""
    whole = Window.partitionBy("film")
    films = chart.withColumn("_best", F.min("rank").over(whole)).where("_best = 1")
    total = F.nullif(F.sum("spectators").over(whole).cast("double"), F.lit(0.0))
    rows = films.select("run_week", (F.col("spectators") / total).alias("share"), (F.col("spectators_total") / total).alias("upto"))
    six = lambda c: F.round(F.avg(c).cast("decimal(18,9)"), 6).cast("double")
    return rows.where(F.col("run_week") <= weeks).groupBy("run_week").agg(six("share").alias("share"), six("upto").alias("running_share"), F.count("*").alias("films"))


def calendar_week(day: Column) -> Column:
    """Week 1 to 52 by the day of the year; the last days count to week 52."""
    return F.least(F.ceil(F.dayofyear(day) / 7.0), F.lit(52)).cast("int")


def attendance(facts: DataFrame, day: str, value: str) -> DataFrame:
    return facts.groupBy(F.year(day).alias("year"), calendar_week(F.col(day)).alias("calendar_week")).agg(F.sum(value).cast("long").alias("attendance"))


def attendance_mean(by_week: DataFrame) -> DataFrame:
    """Floored mean over the years per calendar week; years without all 52 weeks are left out."""
    complete = by_week.groupBy("year").agg(F.count("*").alias("n")).where("n = 52").select("year")
    return by_week.join(complete, "year", "left_semi").groupBy("calendar_week").agg(F.expr("sum(attendance) div count(*)").alias("attendance"), F.count("*").alias("years"))


def search(chart: DataFrame, names: DataFrame, query: str, k: int = 15) -> DataFrame:
    """Films whose name or label holds ``query`` (two characters at least), by spectators."""
    if len(query) < 2:
        return chart.limit(0).select("film")
    found = names.where(F.col("name").ilike(f"%{query}%") | F.col("label").ilike(f"%{query}%"))
    best = chart.join(found, "film").groupBy("film", "name", "label")
    return best.agg(F.count("*").alias("weeks"), F.max("spectators_total").alias("spectators"), F.min("rank").alias("best_rank")).orderBy(F.desc_nulls_last("spectators"), "film").limit(k)
