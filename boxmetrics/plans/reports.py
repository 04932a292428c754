"""Registered queries of layouts, pages, decisions and reports, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from boxmetrics.functions import numbers as nb
from boxmetrics.functions import text as tx
from boxmetrics.operators import decisions as dc
from boxmetrics.operators import layout as ly
from boxmetrics.operators import pages as pg
from boxmetrics.operators import pairs as pr
from boxmetrics.operators import tables as tb
from boxmetrics.plans import catalogue as base
from boxmetrics.plans.catalogue import CHART, facts, query, read, spread
from boxmetrics.plans.records import _OVERLAP, ROUND4, round4

# ---------------------------------------------------------------- reports by name






def annual_rows(spark, d):
    """Customers by year as a yearly report: rank, name, first order, revenue, number of orders."""
    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(14,2)").alias("v"))
    per = o.groupBy("year", "c_custkey").agg(F.sum("v").alias("revenue"), F.min("day").alias("released"), F.count("*").alias("orders"))
    ranked = per.withColumn("rank", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("revenue"), "c_custkey")))
    return ranked.join(read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("title")), "c_custkey")


def report_order(name: str) -> list:
    """The columns a yearly report is sorted by; a name that is not known gives the rank."""
    known = {
        "title": [F.asc("title")],
        "released": [F.asc_nulls_last("released"), F.asc("rank")],
        "revenue": [F.desc_nulls_last("revenue"), F.asc("rank")],
        "orders": [F.desc_nulls_last("orders"), F.asc("rank")],
    }
    return known.get(name, [F.asc("rank")])


def annual_report(spark, d, year: int, order: str = "rank", query: str | None = None, limit: int = 20):
    rows = dc.searched(annual_rows(spark, d).where(F.col("year") == year), "title", query)
    return base.money(rows.orderBy(*report_order(order)).limit(limit)).select("rank", "title", "released", "revenue", "orders")


_ANNUAL = """WITH p AS (SELECT year(o_orderdate)::INT AS year, o_custkey, sum(o_totalprice::DECIMAL(14,2)) AS revenue, min(o_orderdate)::DATE AS released, count(*) AS orders FROM orders GROUP BY ALL),
  r AS (SELECT *, (row_number() OVER (PARTITION BY year ORDER BY revenue DESC, o_custkey))::INT AS rank FROM p), t AS (SELECT r.*, c_name AS title FROM r JOIN customer ON c_custkey = o_custkey)
  SELECT rank, title, released, revenue::DOUBLE AS revenue, orders FROM t WHERE year = 1997"""


@query("annual_by_release", _ANNUAL + " ORDER BY t.released NULLS LAST, t.rank LIMIT 20")
def annual_by_release(spark, d):
    return annual_report(spark, d, 1997, "released")


@query("annual_by_orders", _ANNUAL + " AND title ILIKE '%7%' ORDER BY t.orders DESC NULLS LAST, t.rank LIMIT 20")
def annual_by_orders(spark, d):
    return annual_report(spark, d, 1997, "orders", "7")


@query("annual_unknown_order", _ANNUAL + " ORDER BY t.rank LIMIT 20")
def annual_unknown_order(spark, d):
    return annual_report(spark, d, 1997, "no such order")


# The charts a weekly report can be asked for as.
REPORTS = {"all": None, "domestic": 0, "foreign": 1}


def weekly_report(spark, d, report: str):
    """Week totals of a chart: of all venues, or of even and odd numbered ones as the two kinds; an unknown name gives all."""
    rows, kind = facts(spark, d), REPORTS.get(report)
    from boxmetrics.operators import chart as ch

    return base.money(ch.weekly_totals(ch.weekly_chart(rows if kind is None else rows.where(F.col("venue") % 2 == kind))))


_WEEKLY = " SELECT week, sum(revenue)::DOUBLE AS revenue, sum(spectators)::BIGINT AS spectators, max(venues) AS most_venues, count(*) AS films FROM chart GROUP BY week"


@query("weekly_domestic", CHART.replace("FROM lineitem", "FROM lineitem WHERE l_suppkey % 2 = 0") + _WEEKLY)
def weekly_domestic(spark, d):
    return weekly_report(spark, d, "domestic")


_PARTS = "SELECT film, revenue_total, p_name || ' (' || p_brand || ')' AS title FROM chart JOIN part ON p_partkey = film WHERE rank = 1"


@query("chart_metadata", CHART + f""", tops AS ({_PARTS}), m AS (SELECT regexp_replace(lower('The-' || p_name || '!' || p_brand), '[^a-z0-9]', '', 'g') AS key, p_type AS kind, min(p_retailprice) AS price FROM part GROUP BY ALL)
  SELECT film, revenue_total::DOUBLE AS revenue_total, title, kind, price FROM tops LEFT JOIN m ON key = regexp_replace(lower('the ' || title), '[^a-z0-9]', '', 'g')""")
def chart_metadata(spark, d):
    """Leaders with what is known of their titles: joined on the computed key, and once for each kind of the title."""
    names = read(spark, d, "part").select(F.col("p_partkey").alias("film"), F.format_string("%s (%s)", "p_name", "p_brand").alias("title"))
    top = base.weekly(spark, d).where("rank = 1").join(names, "film").withColumn("key", tx.raw_key(F.concat(F.lit("the "), "title")))
    known = read(spark, d, "part").groupBy(tx.raw_key(F.concat(F.lit("The-"), "p_name", F.lit("!"), "p_brand")).alias("key"), F.col("p_type").alias("kind")).agg(F.min("p_retailprice").alias("price"))
    return top.join(known, "key", "left").select("film", F.col("revenue_total").cast("double").alias("revenue_total"), "title", "kind", "price")


@query("annual_policy", """WITH a AS (SELECT year(l_shipdate)::INT AS year, l_partkey AS film, sum(l_extendedprice::DECIMAL(14,2)) AS v FROM lineitem GROUP BY ALL), b AS (SELECT year(o_orderdate)::INT AS year, o_custkey AS film, sum(o_totalprice::DECIMAL(14,2)) AS v FROM orders GROUP BY ALL),
  u AS (SELECT 'domestic' AS class, 'weekly' AS origin, * FROM a WHERE film % 2 = 0 AND year >= 2000 UNION ALL SELECT 'domestic', 'annual', * FROM b WHERE film % 2 = 0 AND year < 2000
    UNION ALL SELECT 'foreign', 'weekly', * FROM a WHERE film % 2 = 1 AND year >= 1999 AND film NOT IN (SELECT film FROM b WHERE film % 2 = 0) UNION ALL SELECT 'foreign', 'silver', * FROM b WHERE film % 2 = 1 AND year < 1999)
  SELECT class, origin, year, film, v::DOUBLE AS revenue, n::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY class, year ORDER BY v DESC NULLS LAST, film) AS n FROM u) WHERE n <= 10""")
def annual_policy(spark, d):
    """The year's top by class, each year from the source that the policy names for it; the foreign weekly one without films of the domestic list."""
    a = facts(spark, d).groupBy(F.year("day").alias("year"), "film").agg(F.sum("revenue").alias("v"))
    b = read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("film")).agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("v"))
    domestic = b.where("film % 2 = 0").select("film").distinct()
    branches = [
        ("domestic", "weekly", a.where("film % 2 = 0 AND year >= 2000")),
        ("domestic", "annual", b.where("film % 2 = 0 AND year < 2000")),
        ("foreign", "weekly", a.where("film % 2 = 1 AND year >= 1999").join(domestic, "film", "left_anti")),
        ("foreign", "silver", b.where("film % 2 = 1 AND year < 1999")),
    ]
    rows = None
    for kind, origin, df in branches:
        part = df.select(F.lit(kind).alias("class"), F.lit(origin).alias("origin"), "year", "film", "v")
        rows = part if rows is None else rows.unionByName(part)
    w = Window.partitionBy("class", "year").orderBy(F.desc_nulls_last("v"), "film")
    return rows.withColumn("rank", F.row_number().over(w)).where("rank <= 10").select("class", "origin", "year", "film", F.col("v").cast("double").alias("revenue"), "rank")


# ---------------------------------------------------------------- predicates and aggregates


@query("guarded_ids", "SELECT id FROM (SELECT CASE o_orderkey % 7 WHEN 0 THEN 'x' || o_orderkey WHEN 1 THEN o_orderkey || '.0' WHEN 2 THEN '' ELSE o_orderkey::VARCHAR END AS id FROM orders) WHERE CASE WHEN regexp_full_match(id, '[0-9]+') THEN id::BIGINT BETWEEN 100 AND 900 ELSE false END")
def guarded_ids(spark, d):
    kind, key = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    ids = read(spark, d, "orders").select(F.when(kind == 0, F.concat(F.lit("x"), key)).when(kind == 1, F.concat(key, F.lit(".0"))).when(kind == 2, "").otherwise(key).alias("id"))
    return ids.where(nb.guarded_between(F.col("id"), 100, 900))


@query("array_predicates", """WITH u AS (SELECT user_id, list(DISTINCT event_type) AS roles FROM events WHERE value > 50 GROUP BY user_id)
  SELECT user_id, list_contains(roles, 'purchase') AS buys, list_has_all(roles, ['click', 'view']) AS looks, len(roles) AS n FROM u""")
def array_predicates(spark, d):
    u = read(spark, d, "events").where("value > 50").groupBy("user_id").agg(F.collect_set("event_type").alias("roles"))
    return u.select("user_id", F.array_contains("roles", "purchase").alias("buys"), (F.size(F.array_except(F.array(F.lit("click"), F.lit("view")), "roles")) == 0).alias("looks"), F.size("roles").cast("long").alias("n"))


@query("json_keys", "SELECT event_id, json_exists(j, '$.name') AS named, (j->>'$.name') IS NOT NULL AS filled FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{\"name\": \"x\"}' WHEN 1 THEN '{\"name\": null}' ELSE props END::JSON AS j FROM events)")
def json_keys(spark, d):
    kind = F.col("event_id") % 3
    j = F.when(kind == 0, '{"name": "x"}').when(kind == 1, '{"name": null}').otherwise(F.col("props"))
    return read(spark, d, "events").select("event_id", F.coalesce(F.array_contains(F.json_object_keys(j), "name"), F.lit(False)).alias("named"), F.get_json_object(j, "$.name").isNotNull().alias("filled"))


@query("regex_match", "SELECT p_partkey, regexp_matches(p_name, '^red') AS a, regexp_matches(p_brand, '(?i)BRAND#1[0-5]$') AS b, NOT regexp_matches(p_type, 'S.*L') AS c FROM part")
def regex_match(spark, d):
    return read(spark, d, "part").select("p_partkey", F.col("p_name").rlike("^red").alias("a"), F.col("p_brand").rlike("(?i)BRAND#1[0-5]$").alias("b"), (~F.col("p_type").rlike("S.*L")).alias("c"))


@query("first_by_order", "SELECT c_nationkey, first(c_name ORDER BY c_acctbal DESC NULLS LAST, c_custkey) FILTER (c_mktsegment = 'BUILDING') AS richest, count(*) AS n FROM customer GROUP BY c_nationkey")
def first_by_order(spark, d):
    best = F.struct(F.col("c_acctbal").isNotNull(), "c_acctbal", -F.col("c_custkey"))
    building = F.col("c_mktsegment") == "BUILDING"
    return read(spark, d, "customer").groupBy("c_nationkey").agg(F.max_by(F.when(building, F.col("c_name")), F.when(building, best)).alias("richest"), F.count("*").alias("n"))


@query("people_grouped", """WITH n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Roca, Ana ' || (c_custkey % 50) WHEN 1 THEN 'Ana ' || (c_custkey % 50) || ' ROCA' ELSE 'Roca, Ana ' || (c_custkey % 50) || '.' END AS name FROM customer)
  SELECT 'ana ' || (c_custkey % 50) || ' roca' AS key, coalesce(max(CASE WHEN NOT contains(name, ',') THEN name END), min(name)) AS name, count(*) AS films FROM n GROUP BY c_custkey % 50 HAVING count(*) >= 2""")
def people_grouped(spark, d):
    """Forms of a name in one group, shown in the form without a comma where there is one."""
    kind, nr = F.col("c_custkey") % 3, (F.col("c_custkey") % 50).cast("string")
    name = F.when(kind == 0, F.concat(F.lit("Roca, Ana "), nr)).when(kind == 1, F.concat(F.lit("Ana "), nr, F.lit(" ROCA"))).otherwise(F.concat(F.lit("Roca, Ana "), nr, F.lit(".")))
    people = read(spark, d, "customer").select(name.alias("name")).where(F.nullif(F.trim("name"), F.lit("")).isNotNull())
    shown = F.coalesce(F.max(F.when(~F.col("name").contains(","), F.col("name"))), F.min("name"))
    return people.groupBy(tx.person_key(F.col("name")).alias("key")).agg(shown.alias("name"), F.count("*").alias("films")).where("films >= 2")


@query("category_sums", "SELECT year(o_orderdate)::INT AS year, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice::DECIMAL(14,2) ELSE 0 END)::DOUBLE AS urgent, sum(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice::DECIMAL(14,2) ELSE 0 END)::DOUBLE AS high, sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_totalprice::DECIMAL(14,2) ELSE 0 END)::DOUBLE AS other FROM orders GROUP BY 1")
def category_sums(spark, d):
    """Sums by named category; whatever has another name counts to the last."""
    bucket = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").when(F.col("o_orderpriority") == "2-HIGH", "high").otherwise("other")
    rows = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), bucket.alias("bucket"), F.col("o_totalprice").cast("decimal(14,2)").alias("v"))
    total = lambda b: F.sum(F.when(F.col("bucket") == b, F.col("v")).otherwise(0)).cast("double").alias(b)
    return rows.groupBy("year").agg(*[total(b) for b in ("urgent", "high", "other")])


def smoothed_growth(years, first: int, last: int, value: str = "v"):
    """Yearly growth from the mean of the first three years to that of the last three, years without rows as 0; null if either mean is not above 0."""
    mean = lambda a: F.sum(F.when(F.col("year").between(a, a + 2), F.col(value)).otherwise(0.0)) / 3
    a, b = mean(first), mean(last - 2)
    return years.agg(F.when((a > 0) & (b > 0), F.pow(b / F.when(a > 0, a), F.lit(1.0 / (last - 2 - first))) - 1).alias("growth"))


@query("growth", "WITH y AS (SELECT year(o_orderdate)::INT AS year, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS v FROM orders GROUP BY 1) SELECT " + ", ".join(f"(SELECT CASE WHEN a > 0 AND b > 0 THEN round((pow(b / a, 1.0 / {hi - 2 - lo}) - 1)::DECIMAL(18,6), 4)::DOUBLE END FROM (SELECT sum(CASE WHEN year BETWEEN {lo} AND {lo + 2} THEN v ELSE 0 END) / 3 AS a, sum(CASE WHEN year BETWEEN {hi - 2} AND {hi} THEN v ELSE 0 END) / 3 AS b FROM y)) AS {n}" for n, lo, hi in (("whole", 1995, 2001), ("gap", 1994, 2003), ("nothing", 1980, 2001))))
def growth(spark, d):
    y = read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"))
    parts = [smoothed_growth(y, lo, hi).select(round4(F.col("growth")).alias(n)) for n, lo, hi in (("whole", 1995, 2001), ("gap", 1994, 2003), ("nothing", 1980, 2001))]
    return parts[0].join(parts[1], how="cross").join(parts[2], how="cross")  # three single rows


@query("run_counts", "SELECT count(*) FILTER (o_custkey % 10 <> 0 AND c_custkey IS NULL) AS new, count(*) FILTER (o_custkey % 10 <> 0 AND c_custkey IS NOT NULL) AS known, count(*) FILTER (o_custkey % 10 = 0) AS failed FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def run_counts(spark, d):
    rows = read(spark, d, "orders").select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("key"))
    return dc.run_counts(rows, read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key")), "key")


@query("key_year_join", "SELECT o_orderkey, l_partkey FROM (SELECT o_orderkey, lower(p_name || p_brand) AS k, year(o_orderdate) AS y FROM orders JOIN part ON p_partkey = o_custkey) JOIN (SELECT lower(p_name || p_brand) AS k, year(l_shipdate) AS y, min(l_partkey) AS l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL) USING (k, y)")
def key_year_join(spark, d):
    """Matches carried over by normalised title and year; of several the smallest."""
    name = read(spark, d, "part").select("p_partkey", tx.title_key(F.concat_ws(" ", "p_name", "p_brand")).alias("k"))
    asked = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("p_partkey"), F.year("o_orderdate").alias("y")).join(name, "p_partkey")
    found = read(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y")).groupBy("l_partkey", "y").agg(F.lit(1).alias("_")).join(name, name.p_partkey == F.col("l_partkey")).groupBy("k", "y").agg(F.min("l_partkey").alias("l_partkey"))
    return asked.join(found, ["k", "y"]).select("o_orderkey", "l_partkey")


# ---------------------------------------------------------------- titles


_SHOWN = "CASE p_partkey % 5 WHEN 0 THEN p_name || ', La' WHEN 1 THEN p_name || ' (V.O.) 4K' WHEN 2 THEN 'The ' || p_name || ' 25 aniversario -' WHEN 3 THEN p_name || ' las' ELSE p_name || ' Entertainment' END"


def _shown(d):
    kind, name = F.col("p_partkey") % 5, F.col("p_name")
    put = lambda a, b: F.concat(F.lit(a), name, F.lit(b))
    return F.when(kind == 0, put("", ", La")).when(kind == 1, put("", " (V.O.) 4K")).when(kind == 2, put("The ", " 25 aniversario -")).when(kind == 3, put("", " las")).otherwise(put("", " Entertainment"))


_BY5 = "CASE p_partkey % 5 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} ELSE {} END"


@query("title_forms", "SELECT p_partkey, " + _BY5.format("'La ' || p_name", "p_name || ' (V.O.) 4K'", "'The ' || p_name || ' 25 aniversario -'", "p_name || ' las'", "p_name || ' Entertainment'") + " AS shown, " + _BY5.format("p_name || ' la'", "p_name", "p_name", "p_name || ' las'", "p_name || ' entertainment'") + " AS search_key, " + _BY5.format("'La ' || p_name", "p_name || ' 4K'", "'The ' || p_name || ' 25 aniversario -'", "'las ' || p_name", "p_name") + " AS article_first, " + _BY5.format("p_name", "p_name || '  4k'", "'the ' || p_name || ' 25 aniversario -'", "p_name || ' las'", "p_name || ' entertainment'") + " AS head_key, " + _BY5.format("upper(p_name) || ', LA'", "upper(p_name) || ' (V.O.) 4K'", "'THE ' || upper(p_name) || ' 25 ANIVERSARIO -'", "upper(p_name) || ' LAS'", "upper(p_name) || ' ENTERTAINMENT'") + " AS upper_key FROM part")
def title_forms(spark, d):
    t = F.col("t")
    rows = read(spark, d, "part").select("p_partkey", _shown(d).alias("t"))
    return rows.select("p_partkey", tx.shown_title(t).alias("shown"), tx.search_key(t).alias("search_key"), tx.article_first(tx.without_noise(t)).alias("article_first"), tx.head_key(t).alias("head_key"), tx.upper_key(t).alias("upper_key"))


_WORDS = "list_filter(string_split(lower(p_name || ' ' || p_type), ' '), lambda w: len(w) > 2)"


@query("title_shares", f"""WITH n AS (SELECT DISTINCT p_name, p_type FROM part), w AS (SELECT p_name || ' ' || p_type AS title, {_WORDS} AS a FROM n), p AS (SELECT a.title AS asked, b.title AS found, a.a AS x, b.a AS y FROM w a, w b)
  SELECT asked, found, {ROUND4.format("len(list_filter(x, lambda w: contains(lower(found), w)))::DOUBLE / len(x)")} AS share, {ROUND4.format("len(list_intersect(x, y))::DOUBLE / greatest(len(list_distinct(x)), len(list_distinct(y)))")} AS strict FROM p
  WHERE len(list_intersect(x, y))::DOUBLE / greatest(len(list_distinct(x)), len(list_distinct(y))) >= 0.6""")
def title_shares(spark, d):
    """For titles of which 0.6 of the telling words of the longer one are common: that share, and the share found in the other as it stands."""
    t = read(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("asked")).distinct().withColumn("words", tx.telling_words(F.col("asked")))
    u = t.select(F.col("asked").alias("found"), F.col("words").alias("_words"))
    near = pr.similar_sets(t.select(F.col("asked").alias("a"), F.array_distinct("words").alias("x")), u.select(F.col("found").alias("b"), F.array_distinct("_words").alias("y")), 0.6)
    pair = near.select(F.col("a").alias("asked"), F.col("b").alias("found")).join(t, "asked").join(u, "found")
    return pair.select("asked", "found", round4(tx.contained_share(F.col("words"), F.lower("found"))).alias("share"), round4(tx.strict_share(F.col("words"), F.col("_words"))).alias("strict"))


@query("film_match", f"""WITH t AS (SELECT lower(p_name) AS name, p_type AS kind, min(p_partkey) AS id, max(p_retailprice) AS price, min(p_size) AS size FROM part GROUP BY ALL),
  p AS (SELECT a.id AS query_id, b.id AS id, b.size AS size, b.price / 10000.0 AS popularity, b.kind AS kind, least(least({base.OVERLAP} + CASE WHEN abs(a.size - b.size) <= 1 THEN 0.1 ELSE 0.0 END, 1.0) + least(b.price / 10000000.0, 0.05), 1.0) AS score FROM t a, t b WHERE a.name <> b.name AND {base.OVERLAP} >= 0.5 AND NOT (b.price / 10000.0 < 0.2 AND b.size < 5)),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, popularity DESC, id) AS n FROM p)
  SELECT query_id, id, {ROUND4.format('score')} AS score FROM r WHERE n = 1 AND kind IN ('ECONOMY', 'SMALL', 'STANDARD') AND NOT (size * 5 > 0 AND size * 5 < 40)""")
def film_match(spark, d):
    """The best candidate by score among titles half alike, rejected outright if it is foreign or short; unknown ones with few votes are not tried."""
    t = read(spark, d, "part").groupBy(F.lower("p_name").alias("name"), F.col("p_type").alias("kind")).agg(F.min("p_partkey").alias("id"), F.max("p_retailprice").alias("price"), F.min("p_size").alias("size"))
    asked = t.select(F.col("id").alias("query_id"), F.col("name").alias("asked"), F.col("size").alias("year"))
    found = t.select("id", F.col("name").alias("title"), F.col("name").alias("original_title"), F.col("size").alias("released"), (F.col("price") / 10000.0).alias("popularity"), F.col("size").alias("votes"), F.when(F.col("kind").isin("ECONOMY", "SMALL"), "es").otherwise("en").alias("language"), F.when(F.col("kind") == "STANDARD", F.array(F.lit("FR"), F.lit("ES"))).alias("countries"), (F.col("size") * 5).alias("minutes"))
    near = pr.similar_texts(asked.select(F.col("asked").alias("a")), found.select(F.col("title").alias("b")), 0.5).select(F.col("a").alias("asked"), F.col("b").alias("title"))
    best = dc.best_film(asked.join(near, "asked").join(found, "title").where("asked <> title"), domestic=True)
    return best.select("query_id", "id", round4(F.col("score")).alias("score"))


# ---------------------------------------------------------------- queues and decisions


@query("chart_queue", """SELECT title, regexp_replace(lower(title), '[^a-z0-9]', '', 'g') AS key, min(day)::DATE AS released, sum(v)::DOUBLE AS revenue, count(*) AS rows FROM (SELECT c_name AS title, o_orderdate AS day, o_totalprice::DECIMAL(14,2) AS v FROM orders JOIN customer ON c_custkey = o_custkey)
  WHERE title NOT IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING') AND regexp_replace(lower(title), '[^a-z0-9]', '', 'g') NOT IN (SELECT regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') FROM customer WHERE c_acctbal > 0) AND title ILIKE '%1%' GROUP BY title ORDER BY sum(v) DESC NULLS LAST, released DESC NULLS LAST, title LIMIT 25""")
def chart_queue(spark, d):
    c = read(spark, d, "customer")
    annual = read(spark, d, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("title")), "o_custkey").select("title", F.to_date("o_orderdate").alias("released"), F.col("o_totalprice").cast("decimal(14,2)").alias("revenue"), F.lit(1).alias("spectators"))
    sheets = c.where("c_mktsegment = 'BUILDING' OR c_acctbal > 0").select(F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).alias("chart_title"), F.when(F.col("c_acctbal") > 0, F.upper(F.replace("c_name", F.lit("#"), F.lit(" # ")))).alias("title"))
    return base.money(dc.chart_queue(annual, sheets, 25, "1")).drop("spectators")


@query("people_queue", "SELECT c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END AS person_id, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal / 10000 END AS score FROM customer WHERE NOT coalesce(c_custkey % 5 = 0, false) AND (c_custkey % 4 = 0 OR c_mktsegment = 'BUILDING' OR c_custkey % 6 = 0 OR c_acctbal / 10000 < 0.75) ORDER BY CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal / 10000 END NULLS FIRST, c_acctbal DESC NULLS LAST, c_name LIMIT 50")
def people_queue(spark, d):
    k = F.col("c_custkey")
    people = read(spark, d, "customer").select(F.col("c_name").alias("name"), F.when(k % 4 != 0, k).alias("person_id"), F.when(F.col("c_mktsegment") != "BUILDING", F.lit("x")).alias("photo"), F.when(k % 6 != 0, F.col("c_acctbal") / 10000).alias("score"), F.col("c_acctbal").alias("popularity"), F.when(k % 5 == 0, True).alias("reviewed"))
    return dc.people_queue(people).select("name", "person_id", "score")


@query("raw_queue", "WITH r AS (SELECT o_orderkey AS id, p_name || ' ' || p_brand AS title, o_totalprice AS amount, year(o_orderdate)::INT AS year FROM orders JOIN part ON p_partkey = o_custkey WHERE o_orderpriority <> '1-URGENT'), s AS (SELECT p_name || ' ' || p_brand AS title, count(DISTINCT p_partkey) AS n, min(p_partkey) AS sheet FROM part WHERE p_size > 10 GROUP BY 1) SELECT id, title, amount, year, coalesce(n, 0) AS n, sheet FROM r LEFT JOIN s USING (title) WHERE coalesce(n, 0) <> 1 ORDER BY n DESC, amount DESC NULLS LAST, year DESC, id LIMIT 50")
def raw_queue(spark, d):
    name = F.concat_ws(" ", "p_name", "p_brand")
    parts = read(spark, d, "part")
    o = read(spark, d, "orders")
    raw = o.join(parts.select(F.col("p_partkey").alias("o_custkey"), name.alias("title")), "o_custkey").select(F.col("o_orderkey").alias("id"), "title", F.col("o_totalprice").alias("amount"), F.year("o_orderdate").alias("year"))
    matched = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    return dc.raw_queue(raw, matched, parts.where("p_size > 10").select(F.upper(name).alias("title"), F.col("p_partkey").alias("sheet"))).select("id", "title", "amount", "year", "n", "sheet")


@query("film_queue", "SELECT c_custkey AS sheet, c_name AS title FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000) ON o_custkey = c_custkey WHERE o_custkey IS NULL AND c_name ILIKE '%2%' ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END DESC NULLS LAST, c_custkey LIMIT 50")
def film_queue(spark, d):
    sheets = read(spark, d, "customer").select(F.col("c_custkey").alias("sheet"), F.col("c_name").alias("title"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("released"), F.lit(1).alias("year"))
    return dc.film_queue(sheets, read(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("sheet")), 50, "2").select("sheet", "title")


@query("grant_queue", "WITH c AS (SELECT l_orderkey, count(*) AS n, arg_min(l_partkey, (l_linenumber, -l_discount, l_partkey)) AS id, max(l_discount) AS likeness FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT o_orderkey AS grant_id, o_orderstatus AS status, coalesce(n, 0) AS n, id, likeness FROM orders LEFT JOIN c ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, o_totalprice DESC NULLS LAST, year(o_orderdate) DESC, o_orderkey LIMIT 50")
def grant_queue(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "matched").when(F.col("o_orderstatus") == "O", "review").otherwise("pending")
    g = read(spark, d, "orders").select(F.col("o_orderkey").alias("grant_id"), F.lit("").alias("title"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("amount"), status.alias("status"))
    c = read(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("grant_id"), F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("found"), F.col("l_linenumber").alias("rank"), F.col("l_discount").alias("likeness"))
    return dc.grant_queue(g, c).select("grant_id", F.when(F.col("status") == "review", "O").otherwise("P").alias("status"), "n", "id", "likeness")


@query("decisions", """WITH d AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
  SELECT user_id, CASE WHEN event_type IN ('purchase', 'signup') THEN event_id END AS target, CASE WHEN event_type IN ('purchase', 'signup') THEN 'matched' WHEN event_type = 'error' THEN 'no_sheet' ELSE 'review' END AS status, 'manual' AS method FROM d WHERE n = 1 AND event_type <> 'view'
  UNION ALL SELECT c_custkey, c_nationkey::BIGINT, 'matched', 'auto' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def decisions(spark, d):
    """What people decided last, over what was found automatically."""
    kinds = {"purchase": "match", "signup": "change", "error": "none", "view": "clear"}
    action = F.lit("review")
    for kind, name in kinds.items():
        action = F.when(F.col("event_type") == kind, name).otherwise(action)
    made = read(spark, d, "events").select("user_id", action.alias("action"), F.col("event_id").alias("target"), F.lit("").alias("note"), F.struct("ts", "event_id").alias("at"))
    auto = read(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("long").alias("target"), F.lit("matched").alias("status"), F.lit("auto").alias("method"), F.lit("").alias("note"))
    return dc.record_decisions(auto, made, "user_id").drop("note")


@query("renamed_ids", "WITH c AS (SELECT s_suppkey AS id, s_name FROM supplier), x AS (SELECT c_custkey AS old, c_custkey + 50 AS new FROM customer WHERE c_mktsegment = 'BUILDING') SELECT coalesce(new, id) AS id, s_name FROM c LEFT JOIN x ON old = id WHERE new IS NULL OR (new NOT IN (SELECT id FROM c WHERE id NOT IN (SELECT old FROM x))) ")
def renamed_ids(spark, d):
    rows = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_name")
    changes = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") + 50).alias("new"))
    return dc.renamed_ids(rows, "id", changes)


@query("conditional_changes", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'none' WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE NOT coalesce(c_nationkey = 3, false)")
def conditional_changes(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    c = dc.update_where(c, F.col("c_mktsegment") == "BUILDING", {"c_mktsegment": F.lit("HOUSE")})
    c = dc.update_where(c, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("none")})
    return dc.delete_where(c, F.col("c_nationkey") == 3).select("c_custkey", "c_mktsegment")


@query("merge_fields", """WITH e AS (SELECT user_id, list(DISTINCT event_type) AS roles, max(value) AS best FROM events GROUP BY user_id), b AS (SELECT c_custkey AS user_id, ['customer'] AS roles, c_acctbal AS best, c_name AS name FROM customer)
  SELECT coalesce(b.user_id, e.user_id) AS user_id, array_to_string(list_sort(list_distinct(coalesce(b.roles, []) || coalesce(e.roles, []))), ',') AS roles, CASE WHEN e.user_id IS NOT NULL THEN e.best ELSE b.best END AS best, name FROM b FULL JOIN e ON b.user_id = e.user_id""")
def merge_fields(spark, d):
    e = read(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("roles"), F.max("value").alias("best")).withColumn("name", F.lit(None).cast("string"))
    b = read(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.array(F.lit("customer")).alias("roles"), F.col("c_acctbal").alias("best"), F.col("c_name").alias("name"))
    return dc.merge_fields(b, e, "user_id", union=("roles",), fill=("name",)).withColumn("roles", F.array_join("roles", ","))


@query("derived_ids", "SELECT id, CASE WHEN id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN id::VARCHAR WHEN (id::VARCHAR || '40')::BIGINT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN id || '40' END AS found FROM (SELECT s_suppkey AS id FROM supplier)")
def derived_ids(spark, d):
    return dc.derived_ids(read(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))


@query("pending_details", "SELECT c_custkey AS sheet FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')")
def pending_details(spark, d):
    details = read(spark, d, "orders").select(F.col("o_custkey").alias("sheet"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("director"))
    return dc.pending_details(read(spark, d, "customer").select(F.col("c_custkey").alias("sheet")), details)


@query("moved_period", """WITH r AS (SELECT event_type AS kind, ts::DATE AS day FROM events GROUP BY ALL) SELECT kind, day AS "start", day + 2 AS "end" FROM r WHERE NOT (kind = 'error' AND day < DATE '2024-01-10')
  UNION ALL SELECT kind, day + 7, day + 9 FROM r WHERE kind = 'error' AND day < DATE '2024-01-10' AND day + 7 NOT IN (SELECT day FROM r WHERE kind = 'error' AND day >= DATE '2024-01-10')""")
def moved_period(spark, d):
    day = F.to_date("ts")
    rows = read(spark, d, "events").select(F.col("event_type").alias("kind"), day.alias("start"), F.date_add(day, 2).alias("end")).distinct()
    return dc.moved_period(rows, (F.col("kind") == "error") & (F.col("start") < F.lit("2024-01-10").cast("date")), 7, ["kind", "start"])


# ---------------------------------------------------------------- layouts and pages


# Where a printed chart's words stand: name, left edge of the header, left edge of the figures.
_PRINTED = {"rank": ("RANK", 20.0), "title": ("TITULO", 50.0), "distributor": ("DISTRIBUIDORA", 240.0), "week": ("SEM.", 300.0), "cinemas": ("CINES", 330.0), "revenue": ("RECAUDACION", 370.0), "revenue_change": ("+/-%", 420.0), "spectators": ("ESPECTADORES", 460.0), "spectators_change": ("+/-%", 510.0), "revenue_total": ("RECAUDACION", 550.0), "spectators_total": ("ESPECTADORES", 600.0)}
WIDTH, HEIGHT = 680.0, 1000.0


def printed_words(spark, d):
    """The weekly charts as words on pages: a header, a row of words a film whose title runs over two lines, a row of totals."""
    names = read(spark, d, "part").select(F.col("p_partkey").alias("film"), "p_name", "p_brand")
    rows = base.weekly(spark, d).join(names, "film").select(F.col("week").cast("string").alias("doc_id"), "rank", "p_name", "p_brand", "venues", "run_week", tx.spanish_number(F.col("revenue")).alias("revenue"), tx.spanish_number(F.col("spectators"), 0).alias("spectators"), tx.spanish_number(F.col("revenue_total")).alias("revenue_total"), tx.spanish_number(F.col("spectators_total"), 0).alias("spectators_total"))
    top = 160.0 + F.col("rank") * 24
    word = lambda x0, top, text: F.struct(F.lit(float(x0)).alias("x0"), top.alias("top"), text.cast("string").alias("text"))
    at = {n: x for n, (_, x) in _PRINTED.items()}
    first, second = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    cells = [word(at["rank"], top, F.col("rank")), word(at["title"], top + 1, first), word(at["title"], top + 12, second), word(at["distributor"], top, F.col("p_brand")), word(at["week"], top + 0.5, F.col("run_week")), word(at["cinemas"], top, F.col("venues")), word(at["revenue"], top, F.col("revenue")), word(at["revenue"] + 30, top, F.lit("€")), word(at["spectators"], top, F.col("spectators")), word(at["revenue_total"], top, F.col("revenue_total")), word(at["spectators_total"], top, F.col("spectators_total"))]
    body = rows.select("doc_id", F.explode(F.array(*cells)).alias("w"))
    head = rows.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[word(x, F.lit(100.0), F.lit(label)) for label, x in _PRINTED.values()], word(20, F.lit(900.0), F.lit("1234")), word(60, F.lit(900.0), F.lit("TOTAL")), word(50, F.lit(930.0), F.lit("25")))).alias("w"))
    words = body.unionByName(head).select("doc_id", F.lit(1).alias("page"), "w.x0", "w.top", "w.text")
    return words.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("top", "x0")))


@query("layout_chart", CHART + """ SELECT week::VARCHAR AS doc_id, rank::INT AS rank, p_name AS title, p_brand AS distributor, run_week::INT AS run_week, venues::INT AS cinemas, venues::INT AS screens, chart.revenue::DOUBLE AS revenue, chart.spectators AS spectators, revenue_total::DOUBLE AS revenue_total, spectators_total FROM chart JOIN part ON p_partkey = film""")
def layout_chart(spark, d):
    """The printed charts read back: rows, anchors, columns, numbers."""
    words = printed_words(spark, d)
    sizes = words.select("doc_id", "page").distinct().withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})
    rows = ly.parse_chart(words, sizes)
    whole = lambda c: F.col(c).cast("int")
    return rows.where("title <> ''").select("doc_id", whole("rank").alias("rank"), "title", "distributor", whole("week").alias("run_week"), whole("cinemas").alias("cinemas"), whole("screens").alias("screens"), F.col("revenue").cast("double").alias("revenue"), F.col("spectators").cast("long").alias("spectators"), F.col("revenue_total").cast("double").alias("revenue_total"), F.col("spectators_total").cast("long").alias("spectators_total"))


_NUMBERS = "o_totalprice::DECIMAL(14,2)"


@query("clean_numbers", f"SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN rtrim(rtrim(({_NUMBERS})::VARCHAR, '0'), '.') WHEN 1 THEN floor({_NUMBERS})::BIGINT::VARCHAR WHEN 2 THEN '' ELSE (o_orderkey % 100)::VARCHAR END AS n FROM orders")
def clean_numbers(spark, d):
    kind, v = F.col("o_orderkey") % 4, F.col("o_totalprice").cast("decimal(14,2)")
    shown = F.when(kind == 0, F.concat(tx.spanish_number(v), F.lit(" €"))).when(kind == 1, F.concat(F.lit("bleed "), tx.spanish_number(F.floor(v), 0))).when(kind == 2, F.lit("-")).otherwise(F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit("%")))
    return read(spark, d, "orders").select("o_orderkey", nb.clean_number(shown).alias("n"))


@query("film_pages", """SELECT p_partkey, p_name AS title, 'Dir ' || p_brand AS director, (1990 + p_size)::INT AS year, CASE WHEN p_size > 9 THEN make_date(2001, 2, p_size % 28 + 1) END AS released, p_size::INT AS minutes, CASE WHEN p_size % 2 = 0 THEN p_retailprice::DECIMAL(18,2)::DOUBLE END AS grants_total, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS n_grants, p_type || '|' || p_brand AS tags, 'Act ' || p_size || '/role' AS part FROM part""")
def film_pages(spark, d):
    """Pages made of the parts, read back into fields and nested lists."""
    label = lambda name, value: F.concat(F.lit(f"<label>{name}</label> <label class='x'>"), value, F.lit("</label>"))
    size = F.col("p_size").cast("string")
    day = F.when(F.col("p_size") > 9, F.format_string("%02d/02/2001", F.col("p_size") % 28 + 1)).otherwise("-")
    cell = lambda *c: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), x, F.lit("</td>")) for x in c], F.lit("</tr>"))
    head = lambda *h: F.lit("<tr>" + "".join(f"<th> {x} </th>" for x in h) + "</tr>")
    money = F.concat(tx.spanish_number(F.col("p_retailprice").cast("decimal(18,2)")), F.lit(" €"))
    table = lambda *rows: F.concat(F.lit("<table class='t'>"), *rows, F.lit("</table>"))
    html = F.concat(
        F.lit("<html><h2> "), "p_name", F.lit("</h2><script>if (a<b) {}</script>"),
        label("Año de Producción:", (F.col("p_size") + 1990).cast("string")), label("Fecha de Estreno:", day), label("Duración:", F.concat(F.lit("LARGO / "), size, F.lit(" min."))),
        F.lit("<div><label>Etiquetado</label><label>"), "p_type", F.lit("</label><label>Sinopsis en Inglés:</label><label>"), "p_brand", F.lit("</label></div><label>Otra</label>"),
        table(head("Función", "Nombre", "Papel"), cell(F.lit("Intérprete"), F.concat(F.lit("Act "), size), F.lit("role"))),
        table(head("Función", "Nombre", "Notas"), cell(F.lit("Guión"), F.lit("X")), cell(F.lit("Dirigido por"), F.concat(F.lit("Dir <b>"), "p_brand", F.lit("</b>")))),
        table(head("Subvención", "Importe"), F.when(F.col("p_size") % 2 == 0, cell(F.lit("a"), money)).otherwise("")),
        table(head("Subvención", "Importe"), cell(F.lit("b"), F.lit("-"))),
    )
    film = pg.film_page(spread(read(spark, d, "part"), "p_partkey").select("p_partkey", html.alias("html")), "p_partkey", "html")
    return film.select("p_partkey", "title", "director", "year", "released", "minutes", F.col("grants_total").cast("double").alias("grants_total"), F.size("grants").alias("n_grants"), F.array_join("tags", "|").alias("tags"), F.concat(F.col("cast")[0]["name"], F.lit("/"), F.col("cast")[0]["part"]).alias("part"))


@query("film_json", """SELECT conv_id, string_agg(text, ', ' ORDER BY turn) FILTER (role = 'system') AS director, array_to_string(list(role ORDER BY turn)[1:5], ',') AS actors, count(*) AS n FROM conversations GROUP BY conv_id""".replace("SELECT conv_id, string_agg(text, ', ' ORDER BY turn) FILTER (role = 'system')", "SELECT conv_id, coalesce(string_agg(text, ', ' ORDER BY turn) FILTER (role = 'system'), '')"))
def film_json(spark, d):
    """Dialogues as a service's answers: directors joined, five actors, from JSON."""
    person = F.struct("turn", F.when(F.col("role") == "system", "Director").otherwise("Writer").alias("job"), F.col("text").alias("name"), "role")
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(person)).alias("p"))
    crew, cast = F.transform("p", lambda x: F.struct(x["job"].alias("job"), x["name"].alias("name"))), F.transform("p", lambda x: F.struct(x["role"].alias("name")))
    answer = F.to_json(F.struct(F.col("conv_id").alias("id"), F.struct(crew.alias("crew"), cast.alias("cast")).alias("credits")))
    film = c.select("conv_id", F.size("p").cast("long").alias("n"), pg.film_details(answer).alias("f"))
    return film.select("conv_id", "f.director", F.array_join("f.cast", ",").alias("actors"), "n")


@query("page_ids", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN page_id::VARCHAR WHEN 1 THEN page_id::VARCHAR WHEN 2 THEN page_id::VARCHAR END AS id FROM pages")
def page_ids(spark, d):
    kind, i = F.col("page_id") % 4, F.col("page_id").cast("string")
    url = F.when(kind == 0, F.concat(F.lit("/f?x=1&Pelicula="), i)).when(kind == 1, F.concat(F.lit("/a/Caratulas/"), i, F.lit("/big"))).when(kind == 2, F.concat(F.lit("/p/P"), i, F.lit(".pdf"))).otherwise(F.col("url").substr(1, 0))
    return read(spark, d, "pages").select("page_id", pg.id_of_url(url).alias("id"))


# ---------------------------------------------------------------- ingest


@query("expected_weekend", """WITH d AS (SELECT DISTINCT ts::DATE AS day FROM events), w AS (SELECT day, (day - (isodow(day))::INT)::DATE AS sunday FROM d), k AS (SELECT DISTINCT event_type, ts::DATE AS on_day FROM events WHERE value > 97)
  SELECT day, sunday - 2 AS friday, sunday, coalesce(string_agg(kind, ',' ORDER BY kind) FILTER (NOT seen), '') AS missing FROM (SELECT day, sunday, kind, EXISTS (SELECT 1 FROM k WHERE event_type = kind AND on_day BETWEEN sunday - 2 AND sunday) AS seen FROM w, (SELECT unnest(['purchase', 'signup']) AS kind)) GROUP BY day, sunday""")
def expected_weekend(spark, d):
    """For each day the last weekend that is over, and which of the two reports for it are not there."""
    from boxmetrics.functions import dates as dt

    e = read(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    w = e.select("day").distinct().select("day", dt.last_weekend(F.col("day")).alias("w")).select("day", F.col("w.start").alias("friday"), F.col("w.end").alias("sunday"))
    loaded = e.where("value > 97").select("event_type", dt.weekend_start(F.col("day")).alias("friday")).where("friday IS NOT NULL").groupBy("friday").agg(F.collect_set("event_type").alias("got"))
    kinds = F.array(F.lit("purchase"), F.lit("signup"))
    missing = F.array_except(kinds, F.coalesce("got", F.array().cast("array<string>")))
    return w.join(loaded, "friday", "left").select("day", "friday", "sunday", F.array_join(F.array_sort(missing), ",").alias("missing"))


@query("last_wins", "WITH k AS (SELECT lower(p_name) AS key, max(p_partkey) AS id FROM part GROUP BY 1) SELECT p_partkey, id FROM part JOIN k ON key = lower(p_name)")
def last_wins(spark, d):
    """Each part with the last of its key: of several the largest id."""
    p = read(spark, d, "part").select("p_partkey", tx.alnum_key(F.col("p_name")).alias("key"))
    last = tb.best_row(p, ["key"], [F.desc("p_partkey")]).select("key", F.col("p_partkey").alias("id"))
    return p.join(last, "key").select("p_partkey", "id")


@query("exploded_counts", "SELECT role AS person, count(DISTINCT conv_id) AS films, count(*) AS credits FROM conversations WHERE nullif(trim(text), '') IS NOT NULL GROUP BY role HAVING count(*) >= 2")
def exploded_counts(spark, d):
    """Films and credits of a person; the credits decide who is listed, blank ones aside. Rows are counted as they lie, no list is made of them."""
    c = read(spark, d, "conversations").where(F.nullif(F.trim("text"), F.lit("")).isNotNull()).groupBy("role", "conv_id").agg(F.count("*").alias("n"))
    return c.groupBy(F.col("role").alias("person")).agg(F.count("conv_id").alias("films"), F.sum("n").alias("credits")).where("credits >= 2")


@query("sentinels", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, 'none') AS land, c_name FROM customer")
def sentinels(spark, d):
    from boxmetrics.sources import files

    c = read(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("land"), "c_name")
    return files.fill_missing(c, {"land": "none"})


@query("whole_documents", "SELECT l_orderkey, count(*) AS lines FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE NOT coalesce(l_discount < 0.09, false)) GROUP BY 1")
def whole_documents(spark, d):
    """Orders all of whose lines are good: one bad line takes back its order."""
    from boxmetrics.streaming import ingest

    lines = read(spark, d, "lineitem").select("l_orderkey", "l_discount")
    return ingest.each_whole(lines, "l_orderkey", F.col("l_discount") < 0.09).groupBy("l_orderkey").agg(F.count("*").alias("lines"))


@query("array_values", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS roles, list_sort(list(DISTINCT event_type))[1] AS first, len(list(event_type)) AS n FROM events GROUP BY user_id")
def array_values(spark, d):
    """Arrays joined, sorted, indexed and counted."""
    half = lambda k: F.collect_list(F.when(F.col("event_id") % 2 == k, F.col("event_type")))
    u = read(spark, d, "events").groupBy("user_id").agg(half(0).alias("a"), half(1).alias("b"))
    roles = F.array_sort(F.array_union("a", "b"))
    return u.select("user_id", F.array_join(roles, ",").alias("roles"), F.element_at(roles, 1).alias("first"), F.size(F.concat("a", "b")).cast("long").alias("n"))
