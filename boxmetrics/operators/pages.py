"""Fields, tables and links of web pages, by patterns; built-in expressions throughout.

A page is cut at the tags of tables, rows and cells. How deep a tag lies is the
running sum of the tables opened and closed before it; a table ends at its own
close, and a row or cell at the next tag of its own depth that ends it, whether
or not it has been closed. So a cell that holds a table has the table's text and
cells in it, and cells behind that table stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxmetrics.functions import dates as dt
from boxmetrics.functions import html as ht
from boxmetrics.functions import numbers as nb
from boxmetrics.functions import text as tx

AT_TABLE, AT_CELL = r"(?i)(?=</?table\b)", r"(?i)(?=</?(?:tr|td|th)\b)"
TAG = r"(?is)^<(/?(?:table|tr|td|th))\b"
UNSEEN = r"(?s)<!--.*?-->|(?i)<script.*?</script>|<style.*?</style>"
LABEL = r"(?is)<label\b[^>]*>(.*?)</label>"
NEAR = 80  # fixed value: a label this long or longer is no tag


def inner_text(html: Column) -> Column:
    return tx.squeeze(ht.unescape(F.regexp_replace(html, "<[^>]*>", " ")))


def _all(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def _texts(html: Column, pattern: str) -> Column:
    return F.transform(_all(html, pattern), inner_text)


def labels(html: Column) -> Column:
    """The texts of all labels, in order."""
    return _texts(html, LABEL)


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, r":+$", "")


def label_value(found: Column, name: str) -> Column:
    """The text of the label after the first one called ``name``, a colon at its end aside; null without one."""
    at = F.array_position(F.transform(found, _bare), name.rstrip(":"))
    return F.when(at > 0, F.get(found, at.cast("int")))


def label_after(found: Column, part: str) -> Column:
    """The text of the label after the first one that holds ``part``."""
    at = F.array_position(F.transform(found, lambda x: x.contains(part)), True)
    return F.when(at > 0, F.get(found, at.cast("int")))


def tag_labels(html: Column, start: str, skip: list[str]) -> Column:
    """Labels that follow the one holding ``start`` in the same block, up to the first long one; ``skip`` are left out.

    A block ends where its element does.
    """
    rest = F.regexp_extract(html, rf"(?is)<label\b[^>]*>[^<]*{start}[^<]*</label>(.*)$", 1)
    block = F.regexp_extract(rest, r"(?is)^(.*?)(?:</(?:div|td|li|section|fieldset|form|body)>|$)", 1)
    tags = labels(block)
    end = F.array_position(F.transform(tags, lambda t: F.length(t) >= NEAR), True)
    near = F.when(end > 0, F.slice(tags, 1, (end - 1).cast("int"))).otherwise(tags)
    return F.filter(near, lambda t: (t != "") & ~t.isin(skip))


def with_tables(pages: DataFrame, html: str, name: str = "_tables") -> DataFrame:
    """``pages`` with an array of all tables in the order of their begin: headers, the texts of the first three header
    cells, and rows, the texts of the cells of each row but the first.

    What is in a table is all that lies between its begin and its end: tables
    within it have entries of their own, and their rows and cells count as rows
    and cells of the outer table and row too. Closing tags without an open table
    are left out, and a table that is not closed ends with its page. Nothing is
    shuffled; the work grows with the page, and with the square of its tables.
    """
    cut, sign, depth, piece, level, mark = (f"__{n}" for n in ("cut", "sign", "depth", "piece", "level", "mark"))
    out = pages.withColumn(cut, F.split(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), UNSEEN, ""), AT_TABLE))
    out = out.withColumn(sign, F.transform(cut, lambda c: F.when(c.rlike(r"(?i)^<table\b"), 1).when(c.rlike(r"(?i)^</table\b"), -1).otherwise(0)))
    total = lambda n: F.aggregate(F.slice(sign, 1, n), F.lit(0), lambda a, x: a + x)
    out = out.withColumn(depth, F.transform(F.sequence(F.lit(1), F.size(cut)), total))
    least = lambda i: F.least(F.lit(0), F.array_min(F.slice(depth, 1, i + 1)))  # noqa: E731 (closes without a table)
    out = out.withColumn(depth, F.transform(depth, lambda d, i: d - least(i)))

    def pieces(c: Column, i: Column) -> Column:
        d, close = F.get(F.col(depth), i), F.get(F.col(sign), i) == -1
        tag = lambda p: F.lower(F.regexp_extract(p, TAG, 1))
        return F.transform(F.split(c, AT_CELL), lambda p, k: F.struct(p.alias("html"), tag(p).alias("tag"), (d + (close & (k == 0)).cast("int")).alias("depth")))

    out = out.withColumn(piece, F.transform(F.flatten(F.transform(cut, pieces)), lambda p, i: p.withField("at", i))).withColumn(depth, F.array_max(depth))
    out = out.withColumn(level, F.transform(F.sequence(F.lit(0), F.col(depth) + 1), lambda d: F.filter(piece, lambda p: (p["depth"] == d) & (p["tag"] != ""))))

    def ends(tags: Column, begin: tuple[str, ...], stop: tuple[str, ...]) -> Column:
        """Tags of ``begin`` with the place of the next tag of ``stop`` at their depth."""
        some = F.filter(tags, lambda p: p["tag"].isin(*stop))
        pairs = F.arrays_zip(some.alias("p"), F.slice(some, 2, F.greatest(F.size(some), F.lit(1))).alias("q"))
        found = F.filter(pairs, lambda z: z["p"]["tag"].isin(*begin))
        return F.transform(found, lambda z: F.struct(z["p"]["at"].alias("at"), z["p"]["tag"].alias("tag"), F.coalesce(z["q"]["at"], F.size(piece)).alias("end")))

    tables, rows = ("table", "/table"), ("tr", "/tr", "table", "/table")
    closed = lambda tags: F.transform(F.filter(tags, lambda p: p["tag"].startswith("/")), lambda p: F.struct(p["at"], p["tag"], p["at"].alias("end")))
    all_ends = lambda tags: F.concat(ends(tags, ("td", "th"), (*rows, "td", "/td", "th", "/th")), ends(tags, ("tr",), rows), ends(tags, ("table",), tables), closed(tags))
    # every piece is a tag but for what a page may begin with, so what lies between two places is a slice
    out = out.withColumn(mark, F.array_sort(F.flatten(F.transform(level, all_ends)))).withColumn(piece, F.transform(piece, lambda p: p["html"]))
    lead = F.size(piece) - F.size(mark)
    between = lambda m: F.slice(F.col(mark), m["at"] - lead + 2, F.greatest(m["end"] - m["at"] - 1, F.lit(0)))
    text = lambda m: inner_text(F.array_join(F.slice(F.col(piece), m["at"] + 1, m["end"] - m["at"]), ""))
    of = lambda inside, tag: F.filter(inside, lambda x: x["tag"] == tag)

    def parts(t: Column) -> Column:
        each = of(between(t), "tr")
        cells = F.transform(each, lambda r: F.transform(of(between(r), "td"), text))
        return F.struct(F.transform(F.slice(of(between(t), "th"), 1, 3), text).alias("headers"), cells.alias("rows"))

    return out.withColumn(name, F.transform(of(F.col(mark), "table"), parts)).drop(cut, sign, depth, piece, level, mark)


def _with_headers(found: Column, headers: list[str]) -> Column:
    return F.filter(found, lambda t: F.size(F.array_except(F.array(*map(F.lit, headers)), t["headers"])) == 0)


def _below(t: Column) -> Column:
    """The rows of a table but the first."""
    return F.slice(t["rows"], 2, F.greatest(F.size(t["rows"]), F.lit(1)))


def table_rows(found: Column, headers: list[str], fields: list[str], least: int = 2) -> Column:
    """Rows of the first table with these headers as structs of ``fields``; short rows go, a missing last cell is empty."""
    rows = F.coalesce(_below(F.get(_with_headers(found, headers), F.lit(0))), F.array().cast("array<array<string>>"))
    whole = F.filter(rows, lambda r: F.size(r) >= least)
    return F.transform(whole, lambda r: F.struct(*[F.coalesce(F.get(r, F.lit(i)), F.lit("")).alias(f) for i, f in enumerate(fields)]))


def first_with(rows: Column, field: str, part: str, value: str) -> Column:
    """``value`` of the first row whose ``field`` holds ``part``, in any case; empty without one."""
    hit = F.filter(rows, lambda r: F.lower(r[field]).contains(part))
    return F.coalesce(F.get(hit, F.lit(0))[value], F.lit(""))


def grants(found: Column, headers: list[str]) -> Column:
    """Struct (rows, total): the grants of all tables with these headers, and the sum of the last table that has any amount."""
    hits = _with_headers(found, headers)

    def of(t: Column) -> Column:
        return F.transform(F.filter(_below(t), lambda r: F.size(r) >= 2), lambda r: F.struct(r[0].alias("concept"), tx.parse_euros(r[1]).alias("amount")))

    each = F.transform(hits, of)
    sums = F.transform(each, lambda g: F.struct(F.exists(g, lambda x: F.coalesce(x["amount"], F.lit(0)) != 0).alias("some"), F.aggregate(g, F.lit(0).cast("decimal(38,2)"), lambda s, x: (s + F.coalesce(x["amount"], F.lit(0))).cast("decimal(38,2)")).alias("sum")))
    total = F.try_element_at(F.filter(sums, lambda s: s["some"]), F.lit(-1))["sum"]
    return F.struct(F.flatten(each).alias("rows"), total.cast("decimal(18,2)").alias("total"))


def keyed_values(found: Column, headers: list[str], part: str) -> Column:
    """Second cells of the rows whose first cell holds ``part``, over all tables with these headers."""
    rows = F.flatten(F.transform(_with_headers(found, headers), _below))
    hit = F.filter(rows, lambda r: (F.size(r) >= 2) & F.lower(F.get(r, F.lit(0))).contains(part))
    return F.transform(hit, lambda r: F.trim(r[1]))


def panel_labels(html: Column, tab: str) -> Column:
    """Labels of the first panel with any that stands behind the tab list whose text holds ``tab``."""
    pairs = F.regexp_extract_all(html, F.lit(rf'(?is)<ul\b[^>]*pro-details-tablist[^>]*>(?:(?!</ul>).)*{tab}(?:(?!</ul>).)*</ul>(?:(?!<ul\b).)*?<div\b[^>]*hidden-panel-details[^>]*>(.*?)</div>'), F.lit(1))
    found = F.filter(F.transform(pairs, lambda p: F.filter(labels(p), lambda t: (t != "") & ~t.contains("Empresas Productoras"))), lambda ts: F.size(ts) > 0)
    return F.coalesce(F.get(found, F.lit(0)), F.array().cast("array<string>"))


# Labels and table headers of a film's page.
LABELS = {"rating": "Calificación:", "year": "Año de Producción:", "released": "Fecha de Estreno:", "length": "Duración:", "kind": "Tipo:", "genre": "Género:", "revenue": "Recaudación:", "spectators": "Espectadores:", "nationality": "Nacionalidad:"}
CAST, CREW, SHOOT = ["Función", "Nombre", "Papel"], ["Función", "Nombre", "Notas"], ["Leyenda", "Informacion"]
GRANTS, AWARDS, FESTIVALS = ["Subvención", "Importe"], ["Premios obtenidos"], ["Participación en Festivales"]
SYNOPSES = ["Sinopsis en Castellano:", "Sinopsis en Inglés:"]


def film_page(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """One row per page with a title: all fields of the film, nested where it has lists."""
    page = pages.select(F.col(id_col), F.col(html).alias("_html"), F.nullif(inner_text(F.regexp_extract(F.col(html), r"(?is)<h2\b[^>]*>(.*?)</h2>", 1)), F.lit("")).alias("title")).where("title IS NOT NULL")
    page = with_tables(page.withColumn("_labels", labels(F.col("_html"))), "_html")
    at = {n: label_value(F.col("_labels"), name) for n, name in LABELS.items()}
    found = F.col("_tables")
    cast = table_rows(found, CAST, ["function", "name", "part"])
    crew = table_rows(found, CREW, ["function", "name", "notes"])
    money = grants(found, GRANTS)
    day = lambda part: dt.parse_day(F.try_element_at(keyed_values(found, SHOOT, part), F.lit(-1)))
    return page.select(
        id_col,
        "title",
        first_with(crew, "function", "dirigido", "name").alias("director"),
        at["rating"].alias("rating"),
        F.when(at["year"].rlike(r"^\d+$"), at["year"].try_cast("int")).alias("year"),
        dt.parse_day(at["released"]).alias("released"),
        nb.parse_minutes(at["length"]).alias("minutes"),
        at["kind"].alias("kind"),
        at["genre"].alias("genre"),
        tx.parse_euros(at["revenue"]).alias("revenue"),
        tx.parse_digits(at["spectators"]).alias("spectators"),
        at["nationality"].alias("nationality"),
        F.coalesce(label_after(F.col("_labels"), "Breve sinopsis"), F.lit("")).alias("synopsis"),
        tag_labels(F.col("_html"), "Etiquetado", SYNOPSES).alias("tags"),
        cast.alias("cast"),
        crew.alias("crew"),
        panel_labels(F.col("_html"), "PRODUCTORA").alias("producers"),
        panel_labels(F.col("_html"), "DISTRIBUIDORA").alias("distributors"),
        money["rows"].alias("grants"),
        money["total"].alias("grants_total"),
        day("inicio de rodaje").alias("shoot_began"),
        day("final de rodaje").alias("shoot_ended"),
        keyed_values(found, SHOOT, "lugar").alias("places"),
        table_rows(found, AWARDS, ["award", "section", "person"]).alias("awards"),
        table_rows(found, FESTIVALS, ["festival", "section"], least=1).alias("festivals"),
    )


# How a title, or a release date, stands in the text of a page, in the order tried.
TITLE_PATTERNS = (
    r"(?i)V[ÍI]NCULOS Y REDES SOCIALES\s+(.{1,140}?)\s+cat[áa]logo",
    r"(?i)Download movie Pdf\s+.{0,80}?\s+([A-ZÁÉÍÓÚÜÑ¿¡0-9][^|]{1,120}?)\s+cat[áa]logo",
    r"(?i)(?:Titulo Principal|Título Original):\s*(.{1,100}?)(?:\s+Dirigido|\s+Título|\s+Calificación|$)",
)
DATE_PATTERNS = (r"(?i)Fecha de Estreno:\s*(\d{2}/\d{2}/\d{4})", r"(?i)(?:Estreno en España|Spain Release):\s*(\d{2}/\d{2}/\d{4})")


def first_match(text: Column, patterns: tuple[str, ...]) -> Column:
    """The first group of the first pattern that matches, blanks, dashes and bars at its ends cut off; null without one."""
    return F.coalesce(*[F.nullif(F.btrim(tx.squeeze(F.regexp_extract(text, p, 1)), F.lit(" -|")), F.lit("")) for p in patterns])


def id_of_url(url: Column) -> Column:
    """The film's number in an address of its page, its poster or its leaflet."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in (r"(?i)[?&]pelicula=(\d+)", r"(?i)/Caratulas/(\d+)/", r"(?i)/P(\d+)\.pdf")]
    return F.coalesce(*found)


def latest_rows(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """Rows of the first table of each page (id, title, director, nationality, rating, resolved); those of under six cells or without id or title go."""
    first = with_tables(pages.select(F.col(id_col).alias("page"), F.col(html).alias("_html")), "_html")
    rows = F.coalesce(F.get("_tables", F.lit(0))["rows"], F.array().cast("array<array<string>>"))
    r = first.select("page", F.explode(F.filter(rows, lambda x: F.size(x) >= 6)).alias("c"))
    blank = lambda i: F.nullif(F.col("c")[i], F.lit(""))
    names = ["id", "title", "director", "nationality", "rating"]
    return r.select("page", *[blank(i).alias(n) for i, n in enumerate(names)], F.try_to_date(F.col("c")[5], "d/M/yyyy").alias("resolved")).where("id IS NOT NULL AND title IS NOT NULL")


def report_links(pages: DataFrame, id_col: str, html: str, begin: str = "Hist", link: str = r'href="(/dam/[^"]*\.pdf)"', site: str = "") -> DataFrame:
    """Links to reports with the year and month of the heading above them: (page, url, name, kind, year, month).

    A heading with a year alone changes the year, one with month and year both.
    Reading starts where ``begin`` stands, if anywhere; of a repeated address the
    first counts; files that are no known report are left out.
    """
    text = F.col(html)
    at = F.instr(text, begin)
    section = F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(text)
    line = pages.select(F.col(id_col).alias("page"), F.posexplode(F.split(section, "\n")).alias("line", "text"))
    letters = r"<h3[^>]*>([A-Za-záéíóúÁÉÍÓÚñÑ]+)\s+(\d{4})\s*</h3>"
    month = dt.month_number(F.regexp_extract("text", letters, 1))
    year = F.coalesce(F.when(month.isNotNull(), F.regexp_extract("text", letters, 2).try_cast("int")), F.regexp_extract("text", r"<h3[^>]*>\s*(\d{4})\s*(?:<|$)", 1).try_cast("int"))
    upto = Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = line.select("page", "line", F.nullif(F.regexp_extract("text", link, 1), F.lit("")).alias("path"), F.last(year, True).over(upto).alias("year"), F.last(month, True).over(upto).alias("month")).where("path IS NOT NULL")
    name = F.substring_index("path", "/", -1)
    kept = seen.select("page", "line", F.concat(F.lit(site), F.col("path")).alias("url"), name.alias("name"), tx.report_kind(name).alias("kind"), "year", "month").where("kind IS NOT NULL")
    first = Window.partitionBy("page", "url").orderBy("line")
    return kept.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "line")


def harvest(dump: DataFrame, text: str, known: DataFrame) -> DataFrame:
    """(id, title) of the linked titles in a dump of pages, and of all ids in it or in ``known`` without one the mark "Unknown Title"."""
    pair = r'(?is)<a\b[^>]*[?&]pelicula=(\d+)[^>]*>(.*?)</a>'
    hits = dump.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pair), F.lit(0))).alias("a"))
    titled = hits.select(F.regexp_extract("a", pair, 1).alias("id"), inner_text(F.regexp_extract("a", pair, 2)).alias("title")).where("title <> ''").groupBy("id").agg(F.min("title").alias("title"))
    ids = dump.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?i)[?&]pelicula=(\d+)"), F.lit(1))).alias("id")).union(known.select(F.col("id").cast("string"))).distinct()
    return ids.join(titled, "id", "left").select("id", F.coalesce("title", F.lit("Unknown Title")).alias("title"))


def new_finds(dump: DataFrame, text: str, existing: DataFrame) -> DataFrame:
    """What a harvest has that is not in ``existing`` (id) yet."""
    none = existing.limit(0)
    return harvest(dump, text, none).join(existing.select(F.col("id").cast("string").alias("id")), "id", "left_anti")


# ---------------------------------------------------------------- answers of a film service, as JSON

NAMED = "array<struct<name:string>>"
FILM_JSON = f"id long, title string, original_title string, runtime int, release_date string, original_language string, popularity double, vote_count long, genres {NAMED}, production_companies {NAMED}, production_countries array<struct<iso_3166_1:string>>, credits struct<crew:array<struct<job:string,name:string>>,cast:{NAMED}>, keywords struct<keywords:{NAMED}>, videos struct<results:array<struct<type:string,site:string,key:string>>>"
PERSON_JSON = "id long, name string, images struct<profiles:array<struct<file_path:string,vote_average:double>>>, movie_credits struct<crew:array<struct<job:string,title:string,release_date:string>>,cast:array<struct<title:string,release_date:string,character:string,popularity:double>>>"


def film_details(json: Column) -> Column:
    """A film's answer as a struct: directors in one text, five actors, ten keywords, the first trailer's address."""
    f = F.from_json(json, FILM_JSON)
    names = lambda a: F.coalesce(F.transform(a, lambda x: x["name"]), F.array().cast("array<string>"))
    trailers = F.filter(f["videos"]["results"], lambda v: (v["type"] == "Trailer") & (v["site"] == "YouTube"))
    trailer = F.concat(F.lit("https://www.youtube.com/watch?v="), F.get(trailers, F.lit(0))["key"])
    return F.struct(
        f["id"].alias("id"),
        F.coalesce(f["title"], F.lit("")).alias("title"),
        F.array_join(names(F.filter(f["credits"]["crew"], lambda p: p["job"] == "Director")), ", ").alias("director"),
        F.slice(names(f["credits"]["cast"]), 1, 5).alias("cast"),
        F.slice(names(f["keywords"]["keywords"]), 1, 10).alias("keywords"),
        names(f["genres"]).alias("genres"),
        F.coalesce(F.transform(f["production_countries"], lambda c: c["iso_3166_1"]), F.array().cast("array<string>")).alias("countries"),
        f["original_language"].alias("language"),
        f["runtime"].alias("minutes"),
        F.coalesce(trailer, F.lit("")).alias("trailer"),
    )


def dated_label(title: Column, released: Column, part: Column | None = None) -> Column:
    """Title (year) [part], without what is not known."""
    year = F.substring(F.coalesce(released, F.lit("")), 1, 4)
    out = F.when(year != "", F.concat(title, F.lit(" ("), year, F.lit(")"))).otherwise(title)
    return out if part is None else F.when(F.coalesce(part, F.lit("")) != "", F.concat(out, F.lit(" ["), part, F.lit("]"))).otherwise(out)


def person_details(json: Column, most: int = 50) -> Column:
    """A person's answer as a struct: photos by vote, films directed by date, films acted in by popularity, with their numbers."""
    p = F.from_json(json, PERSON_JSON)

    def down(a: Column, key: str, low: Column) -> Column:
        """By ``key`` from high to low; equal ones as they stood."""
        keyed = F.transform(a, lambda x, i: F.struct(F.coalesce(x[key], low).alias("k"), (-i).alias("i"), x.alias("x")))
        return F.transform(F.sort_array(keyed, asc=False), lambda s: s["x"])

    photos = F.filter(down(p["images"]["profiles"], "vote_average", F.lit(0.0)), lambda i: F.coalesce(i["file_path"], F.lit("")) != "")
    directed = down(F.filter(p["movie_credits"]["crew"], lambda c: c["job"].isin("Director", "Co-Director")), "release_date", F.lit(""))
    acted = down(p["movie_credits"]["cast"], "popularity", F.lit(0.0))
    count = lambda a: F.coalesce(F.size(a), F.lit(0)).alias
    return F.struct(
        p["id"].alias("id"),
        F.transform(photos, lambda i: i["file_path"]).alias("photos"),
        count(directed)("n_directed"),
        F.transform(directed, lambda c: dated_label(c["title"], c["release_date"])).alias("directed"),
        count(acted)("n_acted"),
        F.transform(F.slice(acted, 1, most), lambda c: dated_label(c["title"], c["release_date"], c["character"])).alias("acted"),
    )
