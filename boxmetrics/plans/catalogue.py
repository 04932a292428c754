"""The registered queries: operators bound to the tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxmetrics.functions import text as tx
from boxmetrics.operators import chart as ch
from boxmetrics.operators import pairs as pr
from boxmetrics.operators import tables as tb

WEEK, AS_OF = "1997-06-02", "2001-06-30"
QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str):
    def put(f):
        QUERIES[name] = f
        ORACLE[name] = sql
        return f

    return put


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a small file, which one or two tasks read, dealt to as many tasks as a shuffle has: for work that is heavy on each row."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def facts(spark, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("film"),
        F.col("l_shipdate").alias("day"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("revenue"),
        F.col("l_quantity").cast("long").alias("spectators"),
        F.col("l_suppkey").alias("venue"),
    )


def weekly(spark, d: str) -> DataFrame:
    return ch.weekly_chart(facts(spark, d))


CHART = """WITH t AS (
  SELECT date_trunc('week', l_shipdate)::DATE AS week, l_partkey AS film, sum(l_extendedprice::DECIMAL(14,2)) AS revenue,
         sum(l_quantity::BIGINT)::BIGINT AS spectators, count(DISTINCT l_suppkey) AS venues, count(*) AS screens
  FROM lineitem GROUP BY 1, 2
), r AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY revenue DESC, film) AS rank FROM t),
chart AS (
  SELECT *, row_number() OVER w AS run_week, sum(revenue) OVER w AS revenue_total, (sum(spectators) OVER w)::BIGINT AS spectators_total
  FROM r WHERE rank <= 25 WINDOW w AS (PARTITION BY film ORDER BY week)
)"""
MONEY = "revenue::DOUBLE AS revenue"
SEGMENTS = CHART + """, seg AS (
  SELECT week, round((100.0 * sum(CASE WHEN rank = 1 THEN spectators ELSE 0 END)::DOUBLE / sum(spectators)::DOUBLE)::DECIMAL(18,6), 1)::DOUBLE AS top1,
    round((100.0 * sum(CASE WHEN rank BETWEEN 2 AND 3 THEN spectators ELSE 0 END)::DOUBLE / sum(spectators)::DOUBLE)::DECIMAL(18,6), 1)::DOUBLE AS top3,
    round((100.0 * sum(CASE WHEN rank BETWEEN 4 AND 5 THEN spectators ELSE 0 END)::DOUBLE / sum(spectators)::DOUBLE)::DECIMAL(18,6), 1)::DOUBLE AS top5,
    round((100.0 * sum(CASE WHEN rank > 5 THEN spectators ELSE 0 END)::DOUBLE / sum(spectators)::DOUBLE)::DECIMAL(18,6), 1)::DOUBLE AS rest
  FROM chart GROUP BY week
), stats AS (
  SELECT count(*) AS weeks, round(avg(top1)::DECIMAL(18,6), 1)::DOUBLE AS mean, round(stddev_samp(top1)::DECIMAL(18,6), 1)::DOUBLE AS deviation,
    round(quantile_cont(top1, 0.25)::DECIMAL(18,6), 1)::DOUBLE AS p25, round(quantile_cont(top1, 0.5)::DECIMAL(18,6), 1)::DOUBLE AS p50, round(quantile_cont(top1, 0.75)::DECIMAL(18,6), 1)::DOUBLE AS p75
  FROM (SELECT * FROM seg ORDER BY week DESC LIMIT 52)
)"""


def money(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("revenue").cast("double"))


@query("available_weeks", CHART + " SELECT DISTINCT week FROM chart ORDER BY week DESC")
def available_weeks(spark, d):
    return weekly(spark, d).select("week").distinct().orderBy(F.desc("week"))


@query("available_years", "SELECT DISTINCT year(l_shipdate)::INT AS year FROM lineitem ORDER BY year DESC")
def available_years(spark, d):
    return facts(spark, d).select(F.year("day").alias("year")).distinct().orderBy(F.desc("year"))


@query("weekly_ranking", CHART + f""" SELECT rank::INT AS rank, film, {MONEY}, spectators, run_week::INT AS run_week, p_name AS name,
  regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS name_key FROM chart JOIN part ON p_partkey = film WHERE week = DATE '{WEEK}'""")
def weekly_ranking(spark, d):
    names = read(spark, d, "part").select(F.col("p_partkey").alias("film"), F.col("p_name").alias("name"))
    rows = money(ch.ranking(weekly(spark, d), WEEK)).join(names, "film")
    return rows.select("rank", "film", "revenue", "spectators", "run_week", "name", tx.raw_key(F.col("name")).alias("name_key"))


@query("weekly_totals", CHART + " SELECT week, sum(revenue)::DOUBLE AS revenue, sum(spectators)::BIGINT AS spectators, max(venues) AS most_venues, count(*) AS films FROM chart GROUP BY week")
def weekly_totals(spark, d):
    return money(ch.weekly_totals(weekly(spark, d)))


@query("stats_summary", CHART + " SELECT count(DISTINCT film) AS films, count(DISTINCT (week, rank)) AS places, min(week) AS first_week, max(week) AS last_week FROM chart")
def stats_summary(spark, d):
    return ch.summary(weekly(spark, d))


@query("top_openings", CHART + f" SELECT film, week, spectators, {MONEY} FROM chart WHERE run_week = 1 ORDER BY chart.spectators DESC NULLS LAST, film LIMIT 10")
def top_openings(spark, d):
    return money(ch.openings(weekly(spark, d))).select("film", "week", "spectators", "revenue")


@query("top_year", CHART + """ SELECT film, max(revenue_total)::DOUBLE AS revenue, min(released) AS released
  FROM (SELECT *, min(week) OVER (PARTITION BY film) AS released FROM chart) WHERE year(week) = 1997 GROUP BY film ORDER BY max(revenue_total) DESC NULLS LAST, film LIMIT 20""")
def top_year(spark, d):
    return money(ch.top_of_year(weekly(spark, d), 1997))


@query("concentration", SEGMENTS + """ SELECT week, top1, top3, top5, rest, CASE WHEN weeks < 8 THEN NULL WHEN top1 > mean + 1.5 * deviation THEN 'very high'
  WHEN top1 < greatest(mean - 1.5 * deviation, 0.0) THEN 'very low' WHEN top1 > p75 THEN 'high' WHEN top1 < p25 THEN 'low' ELSE 'normal' END AS level FROM seg, stats""")
def concentration(spark, d):
    shares = ch.segments(weekly(spark, d))
    return ch.classify(shares, ch.segment_stats(shares))


@query("concentration_stats", SEGMENTS + " SELECT weeks, CASE WHEN weeks >= 4 THEN mean END AS mean, CASE WHEN weeks >= 4 THEN deviation END AS deviation, CASE WHEN weeks >= 4 THEN p25 END AS p25, CASE WHEN weeks >= 4 THEN p50 END AS p50, CASE WHEN weeks >= 4 THEN p75 END AS p75, weeks < 8 AS low_data FROM stats")
def concentration_stats(spark, d):
    return ch.segment_stats(ch.segments(weekly(spark, d)))


@query("capacity_insight", CHART + """, w AS (SELECT week, sum(spectators)::BIGINT AS spectators FROM chart GROUP BY week)
  SELECT week, spectators, round((100.0 * cume_dist() OVER (ORDER BY spectators))::DECIMAL(18,6), 0)::INT AS percentile, min(spectators) OVER () AS least, max(spectators) OVER () AS most, floor(avg(spectators) OVER ())::BIGINT AS mean FROM w""")
def capacity_insight(spark, d):
    return ch.capacity(ch.weekly_totals(weekly(spark, d)).select("week", "spectators"))


@query("decay_curve", CHART + """, f AS (SELECT *, sum(spectators) OVER (PARTITION BY film)::DOUBLE AS whole FROM chart WHERE film IN (SELECT film FROM chart WHERE rank = 1))
  SELECT run_week::INT AS run_week, round(avg(spectators / whole)::DECIMAL(18,9), 6)::DOUBLE AS share, round(avg(spectators_total / whole)::DECIMAL(18,9), 6)::DOUBLE AS running_share, count(*) AS films
  FROM f WHERE run_week <= 10 GROUP BY run_week""")
def decay_curve(spark, d):
    return ch.decay_curve(weekly(spark, d))


@query("attendance_by_week", "SELECT year(ts)::INT AS year, least(ceil(dayofyear(ts) / 7.0), 52)::INT AS calendar_week, count(*)::BIGINT AS attendance FROM events GROUP BY 1, 2")
def attendance_by_week(spark, d):
    return ch.attendance(read(spark, d, "events").withColumn("one", F.lit(1)), "ts", "one")


@query("attendance_average", """WITH a AS (SELECT year(l_shipdate) AS y, least(ceil(dayofyear(l_shipdate) / 7.0), 52)::INT AS calendar_week, sum(l_quantity::BIGINT) AS n FROM lineitem GROUP BY 1, 2)
  SELECT calendar_week, (sum(n)::BIGINT // count(*))::BIGINT AS attendance, count(*) AS years FROM a WHERE y IN (SELECT y FROM a GROUP BY y HAVING count(*) = 52) GROUP BY calendar_week""")
def attendance_average(spark, d):
    return ch.attendance_mean(ch.attendance(facts(spark, d), "day", "spectators"))


@query("search_weekly", CHART + """ SELECT film, p_name AS name, p_brand AS label, count(*) AS weeks, max(spectators_total) AS spectators, min(rank)::INT AS best_rank
  FROM chart JOIN part ON p_partkey = film WHERE p_name ILIKE '%re%' OR p_brand ILIKE '%re%' GROUP BY ALL ORDER BY spectators DESC NULLS LAST, film LIMIT 15""")
def search_weekly(spark, d):
    names = read(spark, d, "part").select(F.col("p_partkey").alias("film"), F.col("p_name").alias("name"), F.col("p_brand").alias("label"))
    return ch.search(weekly(spark, d), names, "re")


@query("percentile_tiers", """WITH o AS (SELECT year(o_orderdate)::INT AS year, o_totalprice::DOUBLE AS v FROM orders),
  q AS (SELECT year, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS b, quantile_cont(v, 0.75) AS c, quantile_cont(v, 0.9) AS e FROM o GROUP BY year)
  SELECT year, round(any_value(a)::DECIMAL(18,6), 2)::DOUBLE AS p25, round(any_value(b)::DECIMAL(18,6), 2)::DOUBLE AS p50, round(any_value(c)::DECIMAL(18,6), 2)::DOUBLE AS p75, round(any_value(e)::DECIMAL(18,6), 2)::DOUBLE AS p90,
    count(*) FILTER (v >= a) AS n25, count(*) FILTER (v >= b) AS n50, count(*) FILTER (v >= c) AS n75, count(*) FILTER (v >= e) AS n90,
    round((avg(v) FILTER (v >= a))::DECIMAL(18,6), 2)::DOUBLE AS mean25, round((avg(v) FILTER (v >= b))::DECIMAL(18,6), 2)::DOUBLE AS mean50, round((avg(v) FILTER (v >= c))::DECIMAL(18,6), 2)::DOUBLE AS mean75, round((avg(v) FILTER (v >= e))::DECIMAL(18,6), 2)::DOUBLE AS mean90
  FROM o JOIN q USING (year) GROUP BY year""")
def percentile_tiers(spark, d):
    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("double").alias("v"))
    return tb.percentile_tiers(o, "year", "v")


GRANTS = """WITH u AS (SELECT l_orderkey AS id, sum(l_quantity::BIGINT)::BIGINT AS units FROM lineitem GROUP BY 1),
g AS (SELECT o_orderkey AS id, units, o_totalprice::DECIMAL(18,2) AS amount, o_orderdate::DATE AS released FROM orders JOIN u ON id = o_orderkey)"""


def grants(spark, d):
    units = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum(F.col("l_quantity").cast("long")).alias("units"))
    orders = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.col("o_orderdate").cast("date").alias("released"))
    return orders.join(units, "id")


@query("efficiency_global", GRANTS + f" SELECT count(*) AS films, sum(units)::BIGINT AS units, round((1000.0 * sum(units)::DOUBLE / nullif(sum(amount)::DOUBLE, 0))::DECIMAL(18,6), 4)::DOUBLE AS efficiency FROM g WHERE released < (DATE '{AS_OF}' - INTERVAL 2 MONTH)::DATE")
def efficiency_global(spark, d):
    g = grants(spark, d).where(tb.mature(F.col("released"), F.year("released"), AS_OF))
    total = g.agg(F.count("*").alias("films"), F.sum("units").alias("units"), F.sum("amount").alias("amount"))
    return total.select("films", "units", tb.efficiency(total, "units", "amount").alias("efficiency"))


def _efficient(spark, d, order, floor):
    g = grants(spark, d).where(tb.mature(F.col("released"), F.year("released"), AS_OF) & (F.col("amount") >= floor))
    e = g.select("id", "units", tb.efficiency(g, "units", "amount").alias("efficiency"))
    return e.orderBy(order("efficiency"), "id").limit(50)


_EFF = GRANTS + " SELECT id, units, round((1000.0 * units::DOUBLE / nullif(amount::DOUBLE, 0))::DECIMAL(18,6), 4)::DOUBLE AS efficiency FROM g WHERE released < (DATE '{}' - INTERVAL 2 MONTH)::DATE AND amount >= {} ORDER BY efficiency {}, id LIMIT 50"


@query("efficiency_top", _EFF.format(AS_OF, 5000, "DESC NULLS LAST"))
def efficiency_top(spark, d):
    return _efficient(spark, d, F.desc_nulls_last, 5000)


@query("efficiency_bottom", _EFF.format(AS_OF, 50000, "ASC NULLS LAST"))
def efficiency_bottom(spark, d):
    return _efficient(spark, d, F.asc_nulls_last, 50000)


@query("years_union", "SELECT DISTINCT year FROM (SELECT year(o_orderdate)::INT AS year FROM orders UNION SELECT year(l_shipdate)::INT FROM lineitem UNION SELECT year(ts)::INT FROM events)")
def years_union(spark, d):
    years = [read(spark, d, t).select(F.year(c).alias("year")) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    return years[0].unionByName(years[1]).unionByName(years[2]).distinct()


@query("source_membership", "SELECT id, array_to_string(list_sort(list(DISTINCT s)), ',') AS sources FROM (SELECT o_orderkey AS id, 'orders' AS s FROM orders UNION ALL SELECT l_orderkey, 'lines' FROM lineitem) GROUP BY id")
def source_membership(spark, d):
    a = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("orders").alias("s"))
    b = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit("lines").alias("s"))
    return tb.source_sets(a.unionByName(b), "id", "s")


def sources(spark, d):
    """The customers as a catalogue and its staging twin: overlapping, with fields missing here and there."""
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    first = c.where("c_acctbal < 7000").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    return first, c.where("c_acctbal > 2000").withColumn("c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")))


_SOURCES = """WITH a AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_acctbal < 7000),
b AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name, c_mktsegment FROM customer WHERE c_acctbal > 2000)"""


@query("catalog_union", _SOURCES + " SELECT * FROM a UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)")
def catalog_union(spark, d):
    return tb.first_source_wins(*sources(spark, d), "c_custkey")


@query("catalog_canonical", _SOURCES + """ SELECT c_custkey, c_name, c_mktsegment, origin, complete FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY complete DESC, origin) AS n FROM
  (SELECT *, (c_name IS NOT NULL)::INT + (c_mktsegment IS NOT NULL)::INT AS complete FROM (SELECT *, 0 AS origin FROM a UNION ALL SELECT *, 1 FROM b))) WHERE n = 1""")
def catalog_canonical(spark, d):
    return tb.canonical(list(sources(spark, d)), "c_custkey", ["c_name", "c_mktsegment"])


@query("gold_history", """WITH s AS (
  SELECT year(l_shipdate)::INT AS year, l_partkey AS film, sum(l_extendedprice::DECIMAL(14,2)) AS revenue, 'lines' AS origin, CASE WHEN l_partkey % 2 = 0 THEN 'domestic' ELSE 'foreign' END AS class FROM lineitem GROUP BY ALL
  UNION ALL SELECT year(o_orderdate)::INT, o_custkey, sum(o_totalprice::DECIMAL(14,2)), 'orders', CASE WHEN o_custkey % 2 = 0 THEN 'domestic' ELSE 'foreign' END FROM orders GROUP BY ALL)
  SELECT year, film, class, origin, revenue::DOUBLE AS revenue FROM (SELECT *, row_number() OVER (PARTITION BY film, class ORDER BY revenue DESC NULLS LAST, year, origin) AS n FROM s) WHERE n = 1""")
def gold_history(spark, d):
    kind = F.when(F.col("film") % 2 == 0, "domestic").otherwise("foreign").alias("class")
    lines = facts(spark, d).groupBy(F.year("day").alias("year"), "film").agg(F.sum("revenue").alias("revenue")).withColumn("origin", F.lit("lines"))
    o = read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("film")).agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("revenue")).withColumn("origin", F.lit("orders"))
    rows = lines.unionByName(o).select("*", kind)
    return money(tb.best_row(rows, ["film", "class"], [F.desc_nulls_last("revenue"), F.col("year"), F.col("origin")])).select("year", "film", "class", "origin", "revenue")


@query("merge_upsert", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, max((n_chars % 7)::INT) FROM documents GROUP BY doc_id")
def merge_upsert(spark, d):
    base = read(spark, d, "labels").select("doc_id", "quality")
    return tb.merge_latest(base, read(spark, d, "documents").select("doc_id", (F.col("n_chars") % 7).cast("int").alias("quality")), ["doc_id"])


@query("insert_if_absent", "SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, 9 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def insert_if_absent(spark, d):
    base = read(spark, d, "labels").select("doc_id", "quality")
    return tb.insert_if_absent(base, read(spark, d, "documents").select("doc_id", F.lit(9).alias("quality")), ["doc_id"])


@query("guarded_merge", "SELECT l.doc_id, CASE WHEN toxic = 1 OR d.q IS NULL THEN quality ELSE d.q END AS quality, toxic FROM labels l LEFT JOIN (SELECT doc_id, max((n_chars % 7)::INT) AS q FROM documents GROUP BY doc_id) d ON d.doc_id = l.doc_id")
def guarded_merge(spark, d):
    new = read(spark, d, "documents").select("doc_id", (F.col("n_chars") % 7).cast("int").alias("quality"))
    return tb.guarded_merge(read(spark, d, "labels").select("doc_id", "quality", "toxic"), new, "doc_id", F.col("toxic") == 1, "quality")


@query("constraint_check", "SELECT 'quantity_positive' AS rule, count(*) FILTER (NOT coalesce(l_quantity > 0, false)) AS broken FROM lineitem UNION ALL SELECT 'discount_small', count(*) FILTER (NOT coalesce(l_discount <= 0.05, false)) FROM lineitem")
def constraint_check(spark, d):
    return tb.violations(read(spark, d, "lineitem"), {"quantity_positive": F.col("l_quantity") > 0, "discount_small": F.col("l_discount") <= 0.05})


@query("repeated_keys", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, d):
    return tb.repeated_keys(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("id_band_histogram", "SELECT (o_orderkey // 1000)::BIGINT AS band, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1")
def id_band_histogram(spark, d):
    return read(spark, d, "orders").groupBy(F.expr("o_orderkey div 1000").alias("band")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("ingest_rate", "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1")
def ingest_rate(spark, d):
    return read(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("unmatched_titles", "SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) l ON l_partkey = p_partkey WHERE l_partkey IS NULL")
def unmatched_titles(spark, d):
    sold = read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return read(spark, d, "part").select("p_partkey", "p_name").join(sold, "p_partkey", "left_anti")


@query("semi_ids", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def semi_ids(spark, d):
    big = read(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, d, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("anti_or", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)")
def anti_or(spark, d):
    big = read(spark, d, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    other = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return read(spark, d, "customer").select("c_custkey").join(big, "c_custkey", "left_anti").join(other, "c_custkey", "left_anti")


def _match_parts(spark, d):
    return read(spark, d, "part").select("p_partkey", tx.title_key(F.concat_ws(" ", "p_name", "p_brand")).alias("key"))


def _match_orders(spark, d):
    return read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("p_partkey"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderpriority") == "1-URGENT", "redemption").when(F.col("o_orderpriority") != "5-LOW", "other").alias("kind"))


def _match_made(part):
    return (part % 12 + 1988).cast("int")


def _match_sides(spark, d):
    """Orders ask for the part of their number by name and brand; all parts are the catalogue."""
    parts = _match_parts(spark, d)
    return _match_orders(spark, d).join(parts, "p_partkey").select(F.col("o_orderkey").alias("query_id"), "key", "year", "kind"), parts.select("key", F.col("p_partkey").alias("id"), _match_made(F.col("p_partkey")).alias("year"))


def _match(spark, d):
    return tb.route(tb.candidates(*_match_sides(spark, d)))


_MATCH = """WITH n AS (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', ' ', 'g')) AS key FROM part),
c AS (SELECT key, p_partkey AS id, (p_partkey % 12 + 1988)::INT AS made FROM n),
q AS (SELECT o_orderkey AS query_id, key, year(o_orderdate)::INT AS year, CASE o_orderpriority WHEN '1-URGENT' THEN 'redemption' WHEN '5-LOW' THEN NULL ELSE 'other' END AS kind FROM orders JOIN n ON p_partkey = o_custkey),
h AS (SELECT query_id, id, coalesce(made BETWEEN CASE WHEN kind = 'other' THEN year - 2 ELSE year - 6 END AND CASE WHEN kind = 'redemption' THEN year ELSE year + 6 END, false) AS fits FROM q LEFT JOIN c USING (key)),
g AS (SELECT query_id, count(DISTINCT id) AS n, min(id) AS id, coalesce(bool_or(fits), false) AS fits FROM h GROUP BY query_id),
r AS (SELECT query_id, n, id, n = 1 AS alone, n = 1 AND fits AS safe, CASE WHEN n = 1 AND fits THEN 'matched' WHEN n = 1 THEN 'year_conflict' WHEN n > 1 THEN 'pending' ELSE 'none' END AS route FROM g)"""


@query("match_candidates", _MATCH + " SELECT query_id, n, id, alone, safe FROM r")
def match_candidates(spark, d):
    return _match(spark, d).select("query_id", "n", "id", "alone", "safe")


@query("match_route", _MATCH + " SELECT query_id, id, route FROM r")
def match_route(spark, d):
    return _match(spark, d).select("query_id", "id", "route")


@query("match_stats", _MATCH + " SELECT count(*) AS total, count(*) FILTER (route = 'matched') AS matched, count(*) FILTER (route = 'year_conflict') AS conflict, count(*) FILTER (route = 'pending') AS pending, count(*) FILTER (route = 'none') AS missing FROM r")
def match_stats(spark, d):
    names = {"matched": "matched", "conflict": "year_conflict", "pending": "pending", "missing": "none"}
    return _match(spark, d).agg(F.count("*").alias("total"), *[F.count_if(F.col("route") == v).alias(k) for k, v in names.items()])


_UNACCENT = "replace(replace(replace(replace(strip_accents(lower({})), 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'), 'ø', 'o')"
_TITLE = "CASE (doc_id + line) % 4 WHEN 0 THEN t || ', La' WHEN 1 THEN t || ' (2019)' WHEN 2 THEN t || ' (V.O.), unos' ELSE t END"
_OPENED = f"regexp_replace(trim(regexp_replace({_TITLE}, '\\([^)]*\\)', ' ', 'g')), '^(.*),\\s*(el|la|los|las|un|una|unos|unas)$', '\\2 \\1', 'i')"
_LINES = "(SELECT doc_id, unnest(l) AS t, (unnest(range(0, len(l))))::INT AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"


def _titles(spark, d):
    """All lines of the documents as titles: some with an article behind, some with a note in brackets."""
    lines = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    kind = (F.col("doc_id") + F.col("line")) % 4
    title = F.concat("t", F.when(kind == 0, ", La").when(kind == 1, " (2019)").when(kind == 2, " (V.O.), unos").otherwise(""))
    return lines.select("doc_id", "line", title.alias("title"))


@query("title_norm", f"SELECT doc_id, line, trim(regexp_replace({_UNACCENT.format(_OPENED)}, '[^a-z0-9]+', ' ', 'g')) AS title_key, regexp_replace({_UNACCENT.format(_TITLE)}, '[^a-z0-9]', '', 'g') AS alnum_key, regexp_replace(lower({_TITLE}), '[^a-z0-9]', '', 'g') AS raw_key FROM {_LINES}")
def title_norm(spark, d):
    t = F.col("title")
    return _titles(spark, d).select("doc_id", "line", tx.title_key(t).alias("title_key"), tx.alnum_key(t).alias("alnum_key"), tx.raw_key(t).alias("raw_key"))


@query("norm_search", f"SELECT doc_id FROM documents WHERE contains(regexp_replace({_UNACCENT.format('text')}, '[^a-z0-9]', '', 'g'), 'cionesta')")
def norm_search(spark, d):
    return read(spark, d, "documents").where(tx.alnum_key(F.col("text")).contains("cionesta")).select("doc_id")


@query("parse_numbers", "SELECT o_orderkey, o_totalprice::DECIMAL(18,2)::DOUBLE AS euros, (o_totalprice::DECIMAL(18,2) * 100)::BIGINT AS digits FROM orders")
def parse_numbers(spark, d):
    shown = tx.spanish_number(F.col("o_totalprice").cast("decimal(18,2)"))
    return read(spark, d, "orders").select("o_orderkey", tx.parse_euros(F.concat(shown, F.lit(" €"))).cast("double").alias("euros"), tx.parse_digits(shown).alias("digits"))


OVERLAP = "(CASE WHEN a.name = b.name THEN 1.0 WHEN contains(a.name, b.name) OR contains(b.name, a.name) THEN 0.8 ELSE len(list_intersect(list_distinct(string_split(a.name, ' ')), list_distinct(string_split(b.name, ' '))))::DOUBLE / greatest(len(list_distinct(string_split(a.name, ' '))), len(list_distinct(string_split(b.name, ' ')))) END)::DOUBLE"


@query("token_score", f"""WITH n AS (SELECT DISTINCT lower(p_name || ' ' || p_type) AS name FROM part), p AS (SELECT a.name AS a, b.name AS b, {OVERLAP} AS score FROM n a, n b)
  SELECT a, b, round(score::DECIMAL(18,6), 4)::DOUBLE AS score FROM p WHERE score >= 0.6""")
def token_score(spark, d):
    """All pairs of titles at a likeness of 0.6 or more."""
    n = read(spark, d, "part").select(F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("a"))
    pairs = pr.similar_texts(n, n.select(F.col("a").alias("b")), 0.6)
    return pairs.select("a", "b", F.round(F.col("score").cast("decimal(18,6)"), 4).cast("double").alias("score"))


@query("snapshot_history", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(event_type, (ts, event_id)) AS latest FROM events GROUP BY user_id")
def snapshot_history(spark, d):
    return read(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.max_by("event_type", F.struct("ts", "event_id")).alias("latest"))


@query("link_extract", r"""SELECT page_id, pos::INT AS pos, link FROM (SELECT page_id, unnest(l) AS link, unnest(range(0, len(l))) AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))""")
def link_extract(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return read(spark, d, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))
