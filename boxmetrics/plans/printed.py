"""Registered queries of printed reports, page lists, forms and files: the tables are printed, then read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from boxmetrics.functions import dates as dt
from boxmetrics.functions import html as ht
from boxmetrics.functions import numbers as nb
from boxmetrics.functions import text as tx
from boxmetrics.operators import decisions as dc
from boxmetrics.operators import layout as ly
from boxmetrics.operators import pages as pg
from boxmetrics.plans.catalogue import query, read, spread
from boxmetrics.plans.reports import annual_rows
from boxmetrics.sources import files


def shared_folder(spark, name: str) -> str:
    """A new folder that all tasks see; a temporary one only where all tasks run in this process."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def printed(rows, doc: Column, page: Column, words: list[tuple]):
    """Words (x0, top, text) of each row on pages; what has a null text is not printed."""
    cells = F.array(*[F.struct(F.lit(float(x)).alias("x0"), top.cast("double").alias("top"), text.cast("string").alias("text")) for x, top, text in words])
    out = rows.select(doc.cast("string").alias("doc_id"), page.cast("int").alias("page"), F.explode(F.filter(cells, lambda w: w["text"].isNotNull())).alias("w")).select("doc_id", "page", "w.*")
    return out.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("top", "x0")))


def spanish(c: Column, digits: int = 2) -> Column:
    return tx.spanish_number(c, digits)


# ---------------------------------------------------------------- yearbooks and annual reports

_BOOK = """WITH c AS (SELECT *, abs(c_acctbal)::DECIMAL(14,2) AS v, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) % 4 AS kind FROM customer)"""


def customers(spark, d):
    """Customers as films: the book, the place in it, the name's two parts, and figures."""
    place = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey")) - 1
    c = read(spark, d, "customer").withColumns({"place": place, "v": F.abs(F.col("c_acctbal").cast("decimal(14,2)"))})
    name = F.split("c_name", "#")
    return c.select("c_mktsegment", "c_custkey", "place", "v", (F.col("place") % 4).alias("kind"), name[0].alias("first"), F.concat(F.lit("#"), name[1]).alias("second"))


@query("yearbook", _BOOK + """ SELECT c_mktsegment AS doc_id, 2013 AS year, c_name || CASE kind WHEN 2 THEN ' II' ELSE '' END AS title, make_date(2012, 3, (c_custkey % 28 + 1)::INT) AS authorised,
  CASE kind WHEN 1 THEN 'Dist SA' ELSE 'Dist' END AS distributor, c_custkey * 10 AS spectators, v::DOUBLE AS revenue, (v * 2)::DOUBLE AS revenue_total, CASE kind WHEN 1 THEN 'REINO UNIDO' ELSE 'FRANCIA' END AS country FROM c""".replace("c_name", "replace(c_name, '#', ' #')"))
def yearbook(spark, d):
    """Yearbooks by columns: titles beside their figures, before them, and on both sides; distributors that go on below."""
    c, kind = customers(spark, d), F.col("kind")
    top = 80 + F.col("place") % 20 * 30
    on = lambda k, c: F.when(k, c)
    early = kind >= 2
    line = F.when(early, top + 10).otherwise(top)
    day = F.date_format(F.make_date(F.lit(2012), F.lit(3), (F.col("c_custkey") % 28 + 1).cast("int")), "dd/MM/yy")
    words = [(10, top, F.col("first")), (80, top, F.col("second")), (300, line, day), (350, line, F.lit("Dist")), (520, line, spanish(F.col("c_custkey") * 10, 0)), (570, line, spanish(F.col("v"))), (630, line, spanish(F.col("v") * 2)), (705, line, F.when(kind == 1, "REINO").otherwise("FRANCIA"))]
    words += [(350, top + 10, on(kind == 1, F.lit("SA"))), (705, top + 10, on(kind == 1, F.lit("UNIDO"))), (10, top + 20, on(kind == 2, F.lit("II")))]
    pages = printed(c, F.col("c_mktsegment"), F.floor(F.col("place") / 20) + 1, words)
    return ly.parse_yearbook(pages, 2013, "(?iu)título fecha").withColumns({"revenue": F.col("revenue").cast("double"), "revenue_total": F.col("revenue_total").cast("double")})


@query("yearbook_lines", "SELECT c_mktsegment AS doc_id, 2007 AS year, replace(c_name, '#', ' ') AS title, make_date(2006, 3, (c_custkey % 28 + 1)::INT) AS authorised, 'Uno Films' || CASE WHEN c_custkey % 3 = 0 THEN ' y Compañía' ELSE '' END AS distributor, (c_custkey * 1000)::BIGINT AS spectators, (abs(c_acctbal)::DECIMAL(14,2) % 9000 + 1000)::DOUBLE AS revenue, ((abs(c_acctbal)::DECIMAL(14,2) % 9000 + 1000) * 3)::DOUBLE AS revenue_total, CASE WHEN c_custkey % 2 = 0 THEN 'REINO UNIDO' ELSE 'FRANCIA' END AS country FROM customer")
def yearbook_lines(spark, d):
    """Yearbooks by lines of text, thousands apart as a page sets them."""
    k, v = F.col("c_custkey"), (F.abs(F.col("c_acctbal").cast("decimal(14,2)")) % 9000 + 1000).cast("decimal(14,2)")
    day = F.date_format(F.make_date(F.lit(2006), F.lit(3), (k % 28 + 1).cast("int")), "dd-MM-yy")
    apart = F.replace(spanish(k * 1000, 0), F.lit("."), F.lit(". "))
    text = F.concat_ws(" ", F.replace("c_name", F.lit("#"), F.lit(" ")), day, F.lit("Uno Films"), apart, spanish(v), F.lit("€"), spanish(v * 3), F.lit("€"), F.when(k % 2 == 0, "REINO UNIDO").otherwise("FRANCIA"))
    more = F.when(k % 3 == 0, F.lit("y  Compañía"))
    lines = spread(read(spark, d, "customer"), "c_custkey").select(F.col("c_mktsegment").alias("doc_id"), F.posexplode(F.array(F.lit("TÍTULO FECHA"), text, more)).alias("i", "text"), (k * 3).alias("k")).where("text IS NOT NULL")
    out = ly.parse_yearbook_lines(lines.select("doc_id", (F.col("k") + F.col("i")).alias("line"), "text"), 2007, ["UNIDO", "REINO UNIDO", "FRANCIA"], "(?iu)título fecha")
    return out.withColumns({"revenue": F.col("revenue").cast("double"), "revenue_total": F.col("revenue_total").cast("double")})


_YEARS = """WITH p AS (SELECT year(o_orderdate)::INT AS year, o_custkey, sum(o_totalprice::DECIMAL(14,2)) AS revenue, min(o_orderdate)::DATE AS released, count(*) AS orders FROM orders GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY revenue DESC, o_custkey) AS rank FROM p)"""


def printed_places(rank: Column) -> Column:
    """Where a film of a yearly report is printed, forty to a page: by its rank, and every tenth again, past all other pages."""
    place = (rank - 1).cast("long")
    return F.when(rank % 10 == 0, F.array(place, place + 40_000_000_000)).otherwise(F.array(place))


@query("annual_print", _YEARS + " SELECT year::VARCHAR AS doc_id, rank::INT AS rank, replace(c_name, '#', ' #') AS title, 'Dist Uno' AS distributor, released, revenue::DOUBLE AS revenue, orders AS spectators FROM r JOIN customer ON c_custkey = o_custkey")
def annual_print(spark, d):
    """Annual reports: columns told by dates and ranks; every tenth film is printed again on a later page and counts once."""
    name, rank = F.split("title", "#"), F.col("rank")
    rows = annual_rows(spark, d)
    films = rows.select("*", F.posexplode(printed_places(rank)).alias("again", "place")).withColumn("orders", F.when(F.col("again") == 0, F.col("orders")).otherwise(1))
    films = films.withColumns({"page": (F.floor(F.col("place") / 40) + 1).cast("int"), "line": F.col("place") % 40 + 1})
    heads = rows.select("year").distinct().withColumns({"page": F.lit(1), "line": F.lit(0).cast("long")})
    both = spread(films.unionByName(heads, allowMissingColumns=True).withColumn("doc_id", F.col("year").cast("string")), "doc_id", "page")  # films, not their words
    cells = lambda *w: F.array(*[F.struct(F.lit(float(x)).alias("x0"), F.lit(t).cast("string").alias("text")) for x, t in w])
    head = cells((20, "RANK"), (60, "TÍTULO"), (200, "DISTRIBUIDORA"), (300, "FECHA"))
    film = cells((20, rank), (60, name[0]), (90, F.concat(F.lit("#"), name[1])), (200, "Dist"), (230, "Uno"), (300, F.date_format("released", "dd/MM/yyyy")), (350, spanish(F.col("revenue"))), (390, "€"), (420, spanish(F.col("orders"), 0)))
    shown = F.filter(F.when(F.col("line") == 0, head).otherwise(film), lambda w: w["text"].isNotNull())
    top = F.when(F.col("line") == 0, 10.0).otherwise(28.0 + F.col("line") * 12)
    words = both.select("doc_id", "page", "line", top.alias("top"), F.posexplode(shown).alias("i", "w")).select("doc_id", "page", (F.col("line") * 16 + F.col("i") + 1).alias("pos"), "w.x0", "top", "w.text")
    return ly.parse_annual(words).select("doc_id", "rank", "title", "distributor", "released", F.col("revenue").cast("double").alias("revenue"), "spectators")


@query("two_tables", _YEARS + """ SELECT year::VARCHAR AS doc_id, 2019 AS year, upper(replace(c_name, '#', ' #')) || CASE rank % 3 WHEN 1 THEN ' DE AL LADO' WHEN 2 THEN ' LARGO' ELSE '' END AS title, released, orders AS spectators, revenue::DOUBLE AS revenue
  FROM r JOIN customer ON c_custkey = o_custkey WHERE rank <= 100""")
def two_tables(spark, d):
    """Reports with a table of the hundred best for each metric; titles that go on below, values on the next line."""
    name, rank = F.split(F.upper("title"), "#"), F.col("rank")
    rows = annual_rows(spark, d).where("rank <= 100").withColumn("metric", F.explode(F.array(F.lit(1), F.lit(2))))
    top = 60 + rank * 20
    value = F.when(F.col("metric") == 1, spanish(F.col("orders"), 0)).otherwise(spanish(F.col("revenue")))
    kind = rank % 3
    words = [(125, top, rank), (170, top, name[0]), (250, top, F.concat(F.lit("#"), name[1])), (330, top, F.when(kind == 1, "DE")), (600, top, F.date_format("released", "dd/MM/yyyy")), (650, top, F.when(kind != 2, value)), (170, top + 8, F.when(kind == 1, "AL").when(kind == 2, "LARGO")), (200, top + 8, F.when(kind == 1, "LADO")), (650, top + 8, F.when(kind == 2, value))]
    pages = printed(rows, F.col("year"), F.col("metric"), words).drop("pos")
    title = F.when(F.col("page") == 1, F.array(*map(F.lit, "PRIMERA TABLA ESPECTADORES".split()))).otherwise(F.array(*map(F.lit, "SEGUNDA TABLA RECAUDACIÓN".split())))
    heads = pages.select("doc_id", "page").distinct().select("doc_id", "page", F.posexplode(title).alias("i", "text")).select("doc_id", "page", (100.0 + 90 * F.col("i")).alias("x0"), F.lit(50.0).alias("top"), "text")
    both = pages.unionByName(heads).withColumn("pos", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("top", "x0")))
    return ly.parse_two_tables(both, 2019, 120, 165, 590, "(?i)distribuidoras").withColumn("revenue", F.col("revenue").cast("double"))


# ---------------------------------------------------------------- lists of links and titles

_MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
_KINDS = "(VALUES ('top-25-', 'top'), ('topespanol-', 'domestic'))"


@query("report_links", f"""WITH m AS (SELECT DISTINCT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders)
  SELECT year AS page, 'https://site/dam/' || n || month || '-' || year || '.pdf' AS url, n || month || '-' || year || '.pdf' AS name, kind, year, month FROM m, {_KINDS} k(n, kind)""")
def report_links(spark, d):
    """A page of links a year: months as headings, reports of two kinds, some twice, and other files."""
    m = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()
    stem = F.concat(F.col("month").cast("string"), F.lit("-"), F.col("year").cast("string"))
    link = lambda n: F.concat(F.lit(f'<a href="/dam/{n}'), stem, F.lit('.pdf">x</a>'))
    name = F.initcap(F.element_at(F.array(*map(F.lit, _MONTHS)), F.col("month")))
    block = F.concat_ws("\n", F.concat(F.lit("<h3 class='m'>"), name, F.lit(" "), F.col("year").cast("string"), F.lit("</h3>")), link("top-25-"), link("otro-"), link("topespanol-"), link("top-25-"))
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("month", block.alias("b")))), lambda x: x["b"]), "\n")
    pages = m.groupBy("year").agg(F.concat(F.lit('<a href="/dam/top-25-0.pdf">\nHistórico\n<h3>'), F.col("year").cast("string"), F.lit("</h3>\n"), blocks).alias("html"))
    return pg.report_links(pages, "year", "html", site="https://site")


@query("link_harvest", "SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 3 = 0 THEN 'Unknown Title' ELSE replace(p_name, ' ', ' & ') END AS title FROM part UNION ALL SELECT '-' || s_suppkey, 'Unknown Title' FROM supplier")
def link_harvest(spark, d):
    """Ids and titles from a dump of links, some of them without a title, and ids known from elsewhere."""
    k = F.col("p_partkey")
    text = F.when(k % 3 != 0, F.replace("p_name", F.lit(" "), F.lit(" &amp;\n "))).otherwise("")
    dump = read(spark, d, "part").select(F.concat(F.lit('<p><a class="t" href="/x?y=1&pelicula='), k.cast("string"), F.lit('">'), text, F.lit("</a> ")).alias("html"))
    known = read(spark, d, "supplier").select(F.concat(F.lit("-"), F.col("s_suppkey").cast("string")).alias("id"))
    return pg.harvest(dump, "html", known)


@query("new_finds", "SELECT p_partkey::VARCHAR AS id, p_name AS title FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def new_finds(spark, d):
    dump = read(spark, d, "part").select(F.concat(F.lit("<a href='?pelicula="), F.col("p_partkey").cast("string"), F.lit("'><b>"), F.col("p_name"), F.lit("</b></a>")).alias("html"))
    return pg.new_finds(dump, "html", read(spark, d, "supplier").select(F.col("s_suppkey").alias("id")))


@query("latest_rows", "SELECT p_brand AS page, p_partkey::VARCHAR AS id, p_name AS title, 'Dir ' || p_type AS director, CASE WHEN p_size > 9 THEN 'ES' END AS nationality, 'A' AS rating, make_date(2020, 3, (p_size % 28 + 1)::INT) AS resolved FROM part WHERE p_partkey % 5 <> 0")
def latest_rows(spark, d):
    """Tables of the latest films, a page for each brand; rows without an id or with too few cells are left out."""
    k = F.col("p_partkey")
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    inner = F.concat(F.lit("Dir <table><tr><td>"), F.col("p_type"), F.lit("</table>"))
    day = F.format_string("%d/3/2020", F.col("p_size") % 28 + 1)
    cells = [cell(F.when(k % 10 != 0, k.cast("string")).otherwise("")), cell(F.col("p_name")), cell(F.concat(F.lit("Dir "), "p_type")), cell(F.when(F.col("p_size") > 9, "ES").otherwise("")), cell(F.lit("A")), F.when(k % 10 == 5, F.lit("")).otherwise(cell(day))]
    rows = read(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.collect_list(F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))), "\n").alias("rows"))
    pages = rows.select("p_brand", F.concat(F.lit("<table><thead><tr><th>Id</th></tr></thead><tbody>"), "rows", F.lit("</tbody></table><table><tr><td>other")).alias("html"))
    return pg.latest_rows(pages, "p_brand", "html")


# ---------------------------------------------------------------- forms of texts, numbers and days

# Words as they are printed, and what each form makes of them.
WORDS = ["Dvořák", "Łódź", "Iğdır", "Straße", "ﬁlm", "Ñandú", "Cœur", "Đorđe", "plain"]
_FORMS = {
    "title_key": ["dvorak", "lodz", "igdir", "strasse", "film", "nandu", "coeur", "dorde", "plain"],
    "ascii_key": ["dvorak", "odz", "igdr", "strae", "film", "nandu", "cur", "ore", "plain"],
    "bare_key": ["dvorak", "odz", "igdr", "strae", "lm", "nandu", "cur", "ore", "plain"],
    "upper_key": ["DVORAK", "ŁODZ", "IGDIR", "STRASSE", "FILM", "NANDU", "CŒUR", "ĐORĐE", "PLAIN"],
    "person": ["dvorak", "łodz", "igdır", "straße", "ﬁlm", "nandu", "cœur", "đorđe", "plain"],
}


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][(c_custkey % {len(values)})::INT + 1]"


@query("fold_forms", "SELECT c_custkey, " + ", ".join(f"{_listed(v)} || {sep} || replace({case}(c_name), '#', '{gap}') AS {k}" for (k, v), (sep, case, gap) in zip(_FORMS.items(), (("' '", "lower", " "), ("' '", "lower", " "), ("''", "lower", ""), ("' '", "upper", "#"), ("' '", "lower", " ")), strict=True)) + " FROM customer")
def fold_forms(spark, d):
    """Names with letters of many kinds as the keys have them."""
    word = F.element_at(F.array(*map(F.lit, WORDS)), (F.col("c_custkey") % len(WORDS) + 1).cast("int"))
    t = F.concat_ws(" ", word, "c_name")
    return read(spark, d, "customer").select("c_custkey", tx.title_key(t).alias("title_key"), tx.ascii_title_key(t).alias("ascii_key"), tx.bare_key(t).alias("bare_key"), tx.upper_key(t).alias("upper_key"), tx.person_words(t).alias("person"))


REFERENCES = ["caf&eacute;", "&ntilde;and&uacute;", "&#233;t&#xE9;", "&amp;lt;", "a &lt b", "&notit;", "&hellip;&#128;", "&nosuch; &", "x&nbsp;y"]
_DECODED = ["café", "ñandú", "été", "&lt;", "a < b", "¬it;", "…€", "&nosuch; &", "x y"]


@query("reference_forms", "SELECT page_id, [" + ", ".join(f"'{v}'" for v in _DECODED) + f"][(page_id % {len(_DECODED)})::INT + 1] AS text FROM pages")
def reference_forms(spark, d):
    """References of all kinds, as text between the tags of each page's first heading."""
    ref = F.element_at(F.array(*map(F.lit, REFERENCES)), (F.col("page_id") % len(REFERENCES) + 1).cast("int"))
    return read(spark, d, "pages").select("page_id", ht.element(F.concat(F.lit("<h1 class='x'>"), ref, F.lit("</h1>"), "html"), "h1").alias("text"))


@query("shown_forms", """SELECT c_custkey, 'Ana ' || c_name AS person, 'SPLITTED ' || c_custkey AS undashed, c_custkey || '.000' AS rejoined, 'AeiOuñ' || c_custkey AS marks, CASE c_custkey % 3 WHEN 0 THEN 'top' WHEN 1 THEN 'domestic' END AS kind,
  CASE WHEN c_custkey % 3 = 2 THEN '2021_x.pdf' ELSE ['top-25-', 'cineespanol-'][(c_custkey % 3)::INT + 1] || '2019.pdf' END AS stored, 'Qué tal ' || c_custkey AS safe, CASE WHEN c_custkey % 2 = 0 THEN '1,2 M€' ELSE '12 €' END AS euros, '12,3 %' AS percent, '01/07/2024 12:00' AS at,
  c_name || ' (2001)' || CASE WHEN c_custkey % 2 = 0 THEN ' [x]' ELSE '' END AS label, c_custkey::INT AS minutes, CASE WHEN c_custkey % 3 < 2 THEN 2019 END AS year FROM customer""")
def shown_forms(spark, d):
    """Names, figures and labels as they are printed and searched for."""
    k, name = F.col("c_custkey"), F.col("c_name")
    s = k.cast("string")
    file = F.when(k % 3 == 0, "top-25-2019.pdf").when(k % 3 == 1, "cineespanol-2019.pdf").otherwise("x.pdf")
    return read(spark, d, "customer").select(
        "c_custkey",
        tx.person_query(F.concat(name, F.lit(", Ana"))).alias("person"),
        tx.undashed(F.concat(F.lit("SPLIT- TED "), s)).alias("undashed"),
        tx.rejoined_thousands(F.concat(s, F.lit(". 000"))).alias("rejoined"),
        tx.strip_marks(F.concat(F.lit("ÁéíÓüñ"), s)).alias("marks"),
        tx.report_kind(file).alias("kind"),
        tx.stored_name(file, F.lit(2021)).alias("stored"),
        tx.search_safe(F.concat(F.lit("¿Qué (1960), tal?  "), s)).alias("safe"),
        tx.short_euros(F.when(k % 2 == 0, 1_200_000.0).otherwise(12.0)).alias("euros"),
        tx.percent(F.lit(12.34)).alias("percent"),
        tx.local_time(F.lit("2024-07-01 10:00:00").cast("timestamp")).alias("at"),
        pg.dated_label(name, F.lit("2001-02-03"), F.when(k % 2 == 0, "x")).alias("label"),
        nb.parse_minutes(F.concat(F.lit("LARGOMETRAJE / "), s, F.lit(" min."))).alias("minutes"),
        nb.year_of_name(file).alias("year"),
    )


_DAYS = "SELECT o_orderkey, o_orderdate::DATE AS day, day(o_orderdate)::INT AS d, month(o_orderdate)::INT AS m, year(o_orderdate)::INT AS y FROM orders"


@query("period_forms", f"""WITH o AS ({_DAYS}), e AS (SELECT *, day + 2 AS last FROM o WHERE month(day + 2) = m)
  SELECT o_orderkey, day AS in_name, last AS name_end, day AS in_header, last AS header_end, CASE WHEN o_orderkey % 2 = 0 THEN 'content' ELSE 'name' END AS origin, day AS "start" FROM e""")
def period_forms(spark, d):
    """Weekends of one month, named in file names and in headers; a header counts before a name."""
    day = F.to_date("o_orderdate")
    rows = read(spark, d, "orders").select("o_orderkey", day.alias("day"), F.date_add(day, 2).alias("last")).where(F.month("day") == F.month("last"))
    month = F.element_at(F.array(*map(F.lit, _MONTHS)), F.month("day"))
    figures = lambda c: F.dayofmonth(c).cast("string")
    name = F.concat_ws("-", F.lit("top-25"), figures("day"), figures("last"), month, F.concat(F.year("day").cast("string"), F.lit(".pdf")))
    header = F.concat(F.lit("Fin de Semana. España: "), F.lpad(figures("day"), 2, "0"), F.lit(" - "), F.lpad(figures("last"), 2, "0"), F.lit(" "), F.initcap(month), F.lit(" "), F.year("day").cast("string"))
    rows = rows.withColumns({"name": name, "header": header}).withColumn("text", F.when(F.col("o_orderkey") % 2 == 0, F.col("header")).otherwise("x"))
    rows = rows.withColumns({"p": dt.file_period(F.col("name")), "h": dt.header_period(F.col("header")), "both": dt.report_period(F.col("text"), F.col("name"))})
    return rows.select("o_orderkey", F.col("p.start").alias("in_name"), F.col("p.end").alias("name_end"), F.col("h.start").alias("in_header"), F.col("h.end").alias("header_end"), "both.origin", "both.start")


# ---------------------------------------------------------------- files and versions


@query("file_round_trip", " UNION ALL ".join(f"SELECT '{k}' AS kind, c_custkey, c_name, c_acctbal::DOUBLE AS c_acctbal, {note} AS note FROM customer" for k, note in (("csv", "NULL"), ("tsv", "NULL"), ("json", "NULL"))))
def file_round_trip(spark, d):
    """Customers written as delimited files and JSON lines with an order of columns of their own, and read back by a schema."""
    rows, columns = read(spark, d, "customer"), ["c_name", "c_custkey", "note", "c_acctbal"]
    schema = "c_name string, c_custkey long, note string, c_acctbal double"
    parts = []
    for kind, how in (("csv", ("csv", {"header": "true"})), ("tsv", ("csv", {"header": "true", "sep": "\t"})), ("json", ("json", {}))):
        path = shared_folder(spark, f"rows-{kind}")
        files.write_rows(rows, path, columns, kind)
        parts.append(files.read_rows(spark, path, spark.createDataFrame([], schema).schema, how[0], **how[1]).withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("kind", "c_custkey", "c_name", "c_acctbal", "note")


@query("merge_pruned", "SELECT c_custkey, coalesce(s_name, c_name) AS name, coalesce(s_acctbal, c_acctbal) AS balance FROM customer FULL JOIN (SELECT s_suppkey, s_name, s_acctbal FROM supplier) ON s_suppkey = c_custkey WHERE c_custkey IS NOT NULL")
def merge_pruned(spark, d):
    """Customers as a table in parts, into which the suppliers are merged by number; only the parts touched are written anew."""
    table = files.VersionedTable(spark, shared_folder(spark, "merge"), ["c_custkey"])
    base = read(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    table.replace(base)
    updates = read(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    table.upsert(updates.join(base.select("c_custkey"), "c_custkey", "left_semi"))
    return table.read()


@query("assign_results", "SELECT p_partkey // 5 AS batch, p_name || ' code' || p_partkey AS title, p_partkey AS id FROM part WHERE p_partkey % 4 <> 3")
def assign_results(spark, d):
    """Search results to the parts of their batch of five, the other way round; every fourth result says nothing."""
    k = F.col("p_partkey")
    code = F.concat(F.lit("code"), k.cast("string"))
    batch = F.floor(k / 5).cast("long").alias("batch")
    parts = spread(read(spark, d, "part").withColumn("batch", batch), "batch")
    titles = parts.select("batch", (k % 5).cast("int").alias("pos"), F.concat_ws(" ", "p_name", code).alias("title"))
    text = F.when(k % 4 == 3, "?").otherwise(F.concat_ws(", ", code, F.upper("p_name"), F.lit("catálogo")))
    results = parts.select("batch", (5 - k % 5).cast("int").alias("pos"), k.alias("id"), text.alias("text"))
    return dc.assign_results(results, titles)
