"""Tables read from word positions: rows, header anchors, column bounds, records.

The input is a table of words (doc_id, page, pos, x0, top, text): ``pos`` is the
word's place in its page as the reader found it, ``x0`` its left edge and ``top``
its distance from the head of the page. Pages are independent of each other, so
all of this is grouped and windowed by (doc_id, page) or by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxmetrics.functions import numbers as nb
from boxmetrics.functions import text as tx
from boxmetrics.operators.scan import Machine

PAGE = ["doc_id", "page"]
SHARE = 0.8  # fixed value: a column ends at this part of the way to the next anchor
HEADER = 0.15  # fixed value: part of the page's height that is its header
RIGHT_MARGIN = 100


def bucket_rows(words: DataFrame, tolerance: float = 6) -> DataFrame:
    """``words`` with ``y``: the top rounded (half to even) to a multiple of the tolerance."""
    return words.withColumn("y", F.bround(F.col("top") / tolerance) * tolerance)


def cluster_rows(words: DataFrame, tolerance: float = 3) -> DataFrame:
    """``words`` with ``y``: the top of the first line, in reading order, nearer than the tolerance to the word's own.

    A word near no earlier line begins one; lines do not move as words join them.
    """
    tops = F.transform(F.array_sort(F.collect_list(F.struct("pos", "top"))), lambda w: w["top"])

    def grown(lines: Column, top: Column) -> Column:
        return F.when(F.exists(lines, lambda g: F.abs(g - top) < tolerance), lines).otherwise(F.concat(lines, F.array(top)))

    lines = words.groupBy(*PAGE).agg(F.aggregate(tops, F.array().cast("array<double>"), grown).alias("_lines"))
    return words.join(lines, PAGE).withColumn("y", F.filter("_lines", lambda g: F.abs(g - F.col("top")) < tolerance)[0]).drop("_lines")


def records(words: DataFrame, header: Column) -> DataFrame:
    """Words (with ``y``) below ``header``, each with the ``record`` (the y of its first row) it belongs to.

    A row whose first word is a rank of one or two digits begins a record; rows
    below add to it until a footnote, or a row of totals (three digits or more).
    """
    body = words.where(F.col("y") > header)
    first = F.trim(F.min_by("text", F.struct("x0", "pos")))
    notes = F.max(F.col("text").contains("(*)") | F.col("text").contains("Fuente"))
    rows = body.groupBy(*PAGE, "y").agg(first.alias("first"), notes.alias("note"))
    upto = Window.partitionBy(*PAGE).orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.col("first").rlike(r"^\d{1,2}$")
    event = F.when(begins, F.col("y")).when(F.col("note") | F.col("first").rlike(r"^\d{3,}"), F.lit(-1.0))
    rows = rows.withColumn("record", F.last(event, ignorenulls=True).over(upto)).where("record >= 0")
    return body.join(rows.select(*PAGE, "y", "record"), [*PAGE, "y"])


# Header words that name a column, by pattern; in lists the places are kept left to right.
SINGLE = {"rank": r"RANK", "original": r"^(?!.*TITULO).*ORIGINAL", "distributor": r"DISTRIBUIDORA", "week": r"^SEM\.?$", "cinemas": r"^CINES$", "screens": r"^(?!.*CINES).*PANTALLA"}
SEVERAL = {"title": r"^TITULO$", "revenue": r"RECAUDACI", "change": r"\+/-", "spectators": r"ESPECTADOR|^ESPE"}


def header_anchors(words: DataFrame, header: Column) -> DataFrame:
    """Per page the left edges of the header words: one of each kind in SINGLE, sorted arrays for SEVERAL.

    Of a repeated single word the first in reading order counts; of the word for the original title the last.
    """
    label = tx.strip_marks(F.upper(F.trim("text")))
    head = words.select(*PAGE, "pos", "x0", label.alias("label"), (F.col("top") < header).alias("in_header"))
    hit = lambda p: F.col("in_header") & F.col("label").rlike(p)
    pick = lambda n: F.max_by if n == "original" else F.min_by
    single = [pick(n)(F.when(hit(p), F.col("x0")), F.when(hit(p), F.col("pos"))).alias(n) for n, p in SINGLE.items()]
    several = [F.sort_array(F.collect_list(F.when(hit(p), F.col("x0")))).alias(n) for n, p in SEVERAL.items()]
    return head.groupBy(*PAGE).agg(*single, *several)


def bounds(anchors: list[tuple[str, Column]], width: Column, first: Column | float = 0.0) -> Column:
    """Array of (name, lo, hi) without gaps: each column ends at SHARE of the way to the next anchor; null anchors are left out."""
    named = [F.struct(x.cast("double").alias("x"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, (n, x) in enumerate(anchors)]
    cols = F.array_sort(F.filter(F.array(*named), lambda a: a["x"].isNotNull()))
    first = first if isinstance(first, Column) else F.lit(float(first))

    def edge(a: Column, b: Column) -> Column:
        return a["x"] + SHARE * (b["x"] - a["x"])

    def bound(c: Column, i: Column) -> Column:
        before, after = F.get(cols, i - 1), F.get(cols, i + 1)
        lo = F.when(i == 0, first).otherwise(edge(before, c))
        hi = F.when(after.isNull(), width + RIGHT_MARGIN).otherwise(edge(c, after))
        return F.struct(c["name"].alias("name"), lo.alias("lo"), hi.alias("hi"))

    return F.transform(cols, bound)


# A column of a chart, the header word that it stands under, and the part of the width where it stands
# if the word is missing (none: there is no such column). Of words printed several times: the first, second or last.
FIRST, SECOND, LAST = 0, 1, -1
CHART = [
    ("rank", "rank", None, 0.04),
    ("title", "title", FIRST, 0.06),
    ("original_title", "title", SECOND, 0.24),
    ("distributor", "distributor", None, 0.40),
    ("week", "week", None, 0.505),
    ("cinemas", "cinemas", None, 0.530),
    ("revenue", "revenue", FIRST, 0.620),
    ("revenue_change", "change", FIRST, 0.690),
    ("spectators", "spectators", FIRST, 0.720),
    ("spectators_change", "change", SECOND, 0.800),
    ("revenue_total", "revenue", SECOND, 0.850),
    ("spectators_total", "spectators", SECOND, 0.900),
    ("screens", "screens", None, None),
]
DOMESTIC = [
    ("rank", "rank", None, 0.05),
    ("distributor", "distributor", None, 0.35),
    ("week", "week", None, 0.49),
    ("cinemas", "cinemas", None, 0.51),
    ("revenue", "revenue", FIRST, 0.41),
    ("revenue_change", "change", FIRST, 0.52),
    ("spectators", "spectators", FIRST, 0.63),
    ("spectators_change", "change", LAST, 0.69),
    ("revenue_total", "revenue", LAST, 0.86),
    ("spectators_total", "spectators", LAST, 0.92),
    ("screens", "screens", None, None),
]
# A lone title word right of this part of the width heads the original title.
LONE_TITLE = 0.18
# Columns of averages at thirds of the way between two others; where a change that is printed once is put.
THIRDS = {"revenue_per_cinema": ("revenue_change", "spectators", 1), "revenue_per_screen": ("revenue_change", "spectators", 2), "spectators_per_cinema": ("spectators_change", "revenue_total", 1), "spectators_per_screen": ("spectators_change", "revenue_total", 2)}
CHANGE_SHARE = 0.20
# How far the title is from the rank, how wide it is at least, and how far it ends before the weeks.
TITLE_GAP, TITLE_LEAST, WEEK_GAP = 0.015, 0.05, 0.02


def anchors_of(layout: list[tuple], width: Column) -> dict[str, Column]:
    """Where the columns of a layout stand. The last word of a kind counts only if it is another place than the first."""

    def at(word: str, which: int | None, share: float | None) -> Column:
        usual = F.lit(None) if share is None else width * share
        if which is None:
            return F.coalesce(F.col(word), usual)
        found = F.try_element_at(F.col(word), F.lit(which if which < 0 else which + 1))
        if which == LAST:
            found = F.when(found != F.try_element_at(F.col(word), F.lit(1)), found)
        return F.coalesce(found, usual)

    return {name: at(*how) for name, *how in layout}


def chart_bounds(width: Column) -> Column:
    """Columns of the weekly chart of all films, from :func:`header_anchors`."""
    places = anchors_of(CHART, width)
    alone = F.when(F.size("title") == 1, F.col("title")[0])
    moved = alone > width * LONE_TITLE
    places["original_title"] = F.when(moved, alone).when(alone.isNotNull(), F.coalesce("original", places["original_title"])).otherwise(places["original_title"])
    places["title"] = F.when(moved, width * dict((n, share) for n, *_, share in CHART)["title"]).otherwise(places["title"])
    return bounds(list(places.items()), width)


def domestic_bounds(width: Column) -> Column:
    """Columns of the weekly chart of domestic films, whose centred headers place title and distributor by proportion."""
    at = anchors_of(DOMESTIC, width)
    printed_twice = F.try_element_at("change", F.lit(-1)) != F.try_element_at("change", F.lit(1))
    halfway = at["spectators"] + CHANGE_SHARE * (at["revenue_total"] - at["spectators"])
    at["spectators_change"] = F.when((F.size("change") > 1) & ~printed_twice, halfway).otherwise(at["spectators_change"])
    at |= {n: at[a] + (at[b] - at[a]) * part / 3 for n, (a, b, part) in THIRDS.items()}
    begin = at["rank"] + width * TITLE_GAP
    middle = 1.5 * at["distributor"] - 0.5 * at["week"]  # the header's place, mirrored in the gap before the weeks
    end = F.least(F.greatest(middle, begin + width * TITLE_LEAST), at["week"] - width * WEEK_GAP)
    edges = {"rank": (F.lit(0.0), begin), "title": (begin, end), "distributor": (end, at["week"])}
    text = F.array(*[F.struct(F.lit(n).alias("name"), lo.alias("lo"), hi.alias("hi")) for n, (lo, hi) in edges.items()])
    return F.concat(text, bounds([(n, x) for n, x in at.items() if n not in edges], width, first=at["week"]))


def assign_columns(words: DataFrame, edges: Column, by: list[str]) -> DataFrame:
    """One row per group ``by``: ``fields``, a map from column name to its words joined from left to right.

    A word belongs to the column with lo <= x0 < hi; blanks and lone euro signs are left out.
    """
    column = F.filter(edges, lambda b: (b["lo"] <= F.col("x0")) & (F.col("x0") < b["hi"]))
    placed = words.where(~F.trim("text").isin("", "€")).withColumn("column", F.get(column, F.lit(0))["name"]).where("column IS NOT NULL")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "y", "pos", "text"))), lambda w: w["text"]), " ")
    cells = placed.groupBy(*by, "column").agg(joined.alias("cell"))
    return cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("column", "cell"))).alias("fields"))


TEXT_FIELDS = ("title", "original_title", "distributor")
NUMBER_FIELDS = ("rank", "week", "cinemas", "screens", "revenue", "revenue_change", "spectators", "spectators_change", "revenue_per_cinema", "revenue_per_screen", "spectators_per_cinema", "spectators_per_screen", "revenue_total", "spectators_total")


def parse_chart(words: DataFrame, sizes: DataFrame, domestic: bool = False) -> DataFrame:
    """The rows of a weekly chart (doc_id, page, record, fields by name) from the first page of each document.

    ``sizes`` gives width and height per (doc_id, page). Rows of totals and rows
    without a rank are left out. Charts without a column of screens have the cinemas in it.
    """
    first = words.where("page = 1").join(sizes, PAGE)
    header = F.col("height") * HEADER
    edges = (domestic_bounds if domestic else chart_bounds)(F.col("width"))
    columns = header_anchors(first, header).join(sizes, PAGE).select(*PAGE, edges.alias("edges"))
    body = records(bucket_rows(first), header)
    totals = body.groupBy(*PAGE, "record").agg(F.max(F.upper(F.trim("text")) == "TOTAL").alias("total")).where("NOT total").drop("total")
    cells = assign_columns(body.join(totals, [*PAGE, "record"]).join(columns, PAGE), F.col("edges"), [*PAGE, "record"])
    cell = lambda n: F.coalesce(F.col("fields")[n], F.lit(""))
    rows = cells.where(F.trim(cell("rank")).rlike(r"^\d{1,2}$"))
    number = {n: nb.clean_number(cell(n)) for n in NUMBER_FIELDS}
    number["screens"] = F.coalesce(F.nullif(number["screens"], F.lit("")), number["cinemas"])
    return rows.select(*PAGE, "record", *[F.trim(cell(n)).alias(n) for n in TEXT_FIELDS], *[c.alias(n) for n, c in number.items()])


def first_of_repeated(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with a title, of those that repeat rank and the title's first 15 letters on later pages the first."""
    w = Window.partitionBy("doc_id", "rank", F.substring("title", 1, 15)).orderBy(*order)
    return rows.where("title <> ''").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


# ---------------------------------------------------------------- annual reports


def annual_columns(words: DataFrame) -> DataFrame:
    """Per document the edges of rank, title, distributor and the right part, from its first page (words with ``y``).

    Dates in the rows tell where the right part begins, better than its header; the
    rank ends just before the leftmost second word of rows that begin with a number.
    """
    first = words.where("page = 1")
    line = first.withColumn("line", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("y"))).withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "y").orderBy("x0", "pos")))
    line = line.withColumn("lead", F.first("text").over(Window.partitionBy("doc_id", "y").orderBy("place")))
    label = F.regexp_replace(F.upper("text"), r"^\*+|\*+$", "")
    in_head = F.col("line") <= 15
    named = lambda *n: F.max_by(F.when(in_head & label.isin(*n), F.col("x0")), F.when(in_head & label.isin(*n), F.struct("y", "x0")))
    dated = F.min(F.when(F.col("line").between(4, 25) & F.col("text").rlike(r"^\d{2}/\d{2}/\d{4}$"), F.col("x0"))) - 2
    ranked = F.col("line").between(4, 30) & (F.col("place") == 2) & F.col("lead").rlike(r"^\d+$") & (F.col("lead").try_cast("int") < 300)
    found = line.groupBy("doc_id").agg(named("RANK").alias("rank_x"), named("DISTRIBUIDORA").alias("distributor_x"), dated.alias("date_x"), F.max("x0").alias("right"), F.min(F.when(ranked, F.col("x0"))).alias("second"))
    known = F.col("distributor_x").isNotNull()
    rank = F.when(known, F.coalesce("rank_x", F.lit(0.0))).otherwise(F.col("right") * 0.06)
    return found.select(
        "doc_id",
        F.coalesce(F.col("second") - 1, rank + 15).alias("rank_limit"),
        F.coalesce("distributor_x", F.col("right") * 0.55).alias("distributor_x"),
        F.when(known, F.coalesce("date_x", F.col("right") * 0.73)).otherwise(F.col("right") * 0.73).alias("date_x"),
    )


def parse_annual(words: DataFrame) -> DataFrame:
    """Films of annual reports: (doc_id, page, rank, title, distributor, released, revenue, spectators).

    A row that begins with a number begins a record, the rows below add to it.
    One that has a title and figures but no distributor, below a record that is
    complete already (a distributor and a euro sign), was printed before its own
    rank: it goes to the next record, if that follows at once. Films repeated on
    later pages are taken once.
    """
    lined = bucket_rows(words, 3)
    x = F.col("x0")
    part = F.when(x < F.col("rank_limit"), "rank").when(x < F.col("distributor_x") - 2, "title").when(x < F.col("date_x") - 2, "distributor").otherwise("right")
    edges = F.broadcast(annual_columns(lined))  # a few numbers a document; the plan without the hint sorts all words by document
    placed = lined.join(edges, "doc_id").withColumn("part", part)
    at = F.array_sort(F.collect_list(F.struct("x0", "pos", "text", "part")))
    cell = lambda n: F.transform(F.filter("at", lambda w: w["part"] == n), lambda w: w["text"]).alias(n)
    rows = placed.groupBy(*PAGE, "y").agg(at.alias("at")).select(*PAGE, "y", *[cell(n) for n in ("rank", "title", "distributor", "right")])
    order = Window.partitionBy(*PAGE).orderBy("y")  # one sort for all that follows on a page
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.coalesce(F.get("rank", F.lit(0)).rlike(r"^\d+$"), F.lit(False))
    rows = rows.withColumn("begins", begins).withColumn("record", F.sum(F.col("begins").cast("int")).over(upto)).where("record > 0")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = lambda c: F.max(F.when(c, F.col("record"))).over(earlier) == F.col("record")  # records only rise
    complete = F.coalesce(seen(F.size("distributor") > 0) & seen(F.array_contains("right", "€")), F.lit(False))
    ahead = ~F.col("begins") & (F.size("title") > 0) & (F.size("right") > 0) & (F.size("distributor") == 0) & complete
    rows = rows.withColumn("ahead", ahead)
    carried = lambda n: F.when(F.col("begins") & F.lag("ahead").over(order), F.lag(n).over(order)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({"before": carried("title"), "beside": carried("right")}).where("NOT ahead")
    title, right = F.concat("before", "title"), F.concat("right", "beside")
    joined = lambda c, n: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("y", c.alias("w")))), lambda r: r["w"])).alias(n)
    films = rows.groupBy(*PAGE, "record").agg(F.min("y").alias("y"), F.max(F.when(F.col("begins"), F.get("rank", F.lit(0)))).alias("rank"), joined(title, "title"), joined(F.col("distributor"), "distributor"), joined(right, "right"))
    euro = F.array_position("right", "€")  # from 1; an amount must stand before it
    beside = lambda step: F.when(euro > 1, F.get("right", (euro - 1 + step).cast("int")))
    dated = F.get(F.filter("right", lambda t: t.rlike(r"^\d{2}/\d{2}/\d{4}")), F.lit(0))
    out = films.select(*PAGE, "y", F.col("rank").cast("int").alias("rank"), F.array_join("title", " ").alias("title"), F.array_join("distributor", " ").alias("distributor"), F.try_to_date(dated, "d/M/yyyy").alias("released"), tx.parse_euros(beside(-1)).alias("revenue"), tx.parse_digits(beside(1)).alias("spectators"))
    return first_of_repeated(out, ["page", "y"]).drop("y")


# ---------------------------------------------------------------- yearbooks

# Left edges of the yearbooks' columns up to the named year, and the right edge of the last.
YEARBOOK = {
    2007: (0, 255, 310, 500, 545, 610, 685, 842),
    2008: (0, 260, 315, 485, 550, 610, 670, 842),
    2009: (0, 265, 310, 493, 535, 620, 698, 842),
    2010: (0, 285, 340, 529, 570, 640, 715, 842),
    2012: (0, 305, 350, 525, 570, 640, 720, 842),
    2014: (0, 290, 340, 515, 565, 625, 700, 842),
}
LATEST = (0, 290, 340, 515, 565, 630, 700, 842)
YEARBOOK_FIELDS = ("title", "authorised", "distributor", "spectators", "revenue", "revenue_total", "country")
DAY, WHOLE, MONEY = r"^\d{2}[/-]\d{2}[/-](?:\d{2}|\d{4})$", r"^\d{1,3}(?:\.\d{3})*$|^\d+$", r"^\d[\d.]*(?:,\d{2})?$"


def yearbook_bounds(year: Column, layouts: dict[int, tuple] | None = None, latest: tuple = LATEST) -> Column:
    """The fixed columns of a year's book."""
    edges = lambda e: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for n, a, b in zip(YEARBOOK_FIELDS, e, e[1:], strict=False)])
    out = edges(latest)
    for upto, e in sorted((layouts or YEARBOOK).items(), reverse=True):
        out = F.when(year <= upto, edges(e)).otherwise(out)
    return out


def is_data_row(row: Column | None = None) -> Column:
    """Whether the yearbook fields make a film: a title, a date or none, whole spectators and two amounts."""
    at = lambda n: F.coalesce(F.col(n) if row is None else row[n], F.lit(""))
    bare = lambda n: F.regexp_replace(at(n), r"[€\s]", "")
    return (F.trim(at("title")) != "") & ((bare("authorised") == "") | bare("authorised").rlike(DAY)) & bare("spectators").rlike(WHOLE) & bare("revenue").rlike(MONEY) & bare("revenue_total").rlike(MONEY)


def _book_rule(state: dict, line: dict) -> dict:
    """What a yearbook's line makes of the state: which film is open, and whether its title began on a line before its figures."""
    begun = line["kind"] == "figures" and (line["titled"] or state["film"] == "waiting")
    if begun:
        return {"film": "whole" if line["whole"] else "part", "early": state["film"] == "waiting"}
    if state["film"] in ("none", "waiting"):
        return {"film": "waiting" if line["kind"] == "title" else state["film"], "early": False}
    if line["kind"] != "title":
        return {"film": state["film"], "early": False}
    if state["film"] == "whole":  # a title below: the rest of one that began early, or else the next film's
        return {"film": "whole" if state["early"] else "waiting", "early": False}
    return state


BOOK = Machine(
    [{"film": f, "early": e} for f in ("none", "waiting", "part", "whole") for e in (False, True)],
    {"kind": ["more", "title", "figures"], "titled": [False, True], "whole": [False, True]},
    _book_rule,
)


def parse_yearbook(words: DataFrame, year: int, noise: str, layouts: dict[int, tuple] | None = None) -> DataFrame:
    """Films (doc_id, year, fields) of a year's books by fixed columns; ``noise`` matches lines that are no data.

    A line of figures begins a film. Titles may stand on lines of their own: before
    the figures, after them, or both; other lines go on with the distributor and
    the country. A film whose figures are not whole is left out.
    """
    lined = cluster_rows(words.where("top >= 60"))
    lines = assign_columns(lined.withColumn("edges", yearbook_bounds(F.lit(year), layouts)), F.col("edges"), [*PAGE, "y"])
    cell = lambda n: F.coalesce(tx.squeeze(F.col("fields")[n]), F.lit("")).alias(n)
    lines = lines.select("doc_id", "page", "y", *[cell(n) for n in YEARBOOK_FIELDS])
    lines = lines.where(~F.concat_ws(" ", *[F.nullif(n, F.lit("")) for n in YEARBOOK_FIELDS]).rlike(noise))
    bare = lambda n: F.regexp_replace(n, r"[€\s]", "")
    figures = bare("authorised").rlike(DAY) & bare("spectators").rlike(WHOLE) & (F.col("revenue") != "") & (F.col("revenue_total") != "")
    titled = F.col("title") != ""
    alone = titled & (F.concat(*[f for f in YEARBOOK_FIELDS if f != "title"]) == "")
    kind = F.when(alone, "title").when(figures, "figures").otherwise("more")
    money = bare("revenue").rlike(MONEY) & bare("revenue_total").rlike(MONEY)
    lines = BOOK.before(lines.withColumn("symbol", BOOK.symbol(kind=kind, titled=titled, whole=money)), ["doc_id"], ["page", "y"], "symbol")
    film, early = BOOK.flag(F.col("state"), "film"), BOOK.flag(F.col("state"), "early")
    begins = figures & (titled | (film == "waiting"))
    upto = Window.partitionBy("doc_id").orderBy("page", "y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_ones = alone & (film.isin("none", "waiting") | ((film == "whole") & ~early))
    lines = lines.withColumns({"begins": begins, "film": F.sum(begins.cast("int")).over(upto) + next_ones.cast("int"), "whole": begins & money})
    said = lambda f: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("page", "y", F.col(f).alias("t")))), lambda r: r["t"] != ""), lambda r: r["t"]), " ").alias(f)
    once = lambda f: F.max(F.when(F.col("begins"), F.col(f))).alias(f)
    films = lines.groupBy("doc_id", "film").agg(F.max("whole").alias("whole"), *[(said if f in ("title", "distributor", "country") else once)(f) for f in YEARBOOK_FIELDS])
    return films.where("whole").select("doc_id", F.lit(year).alias("year"), *typed_film(year))


def typed_film(year: int) -> list[Column]:
    """The yearbook fields with their types; dates in years of two digits are not after the book's own year."""
    from boxmetrics.functions import dates as dt

    return [tx.undashed(F.col("title")).alias("title"), dt.parse_yearbook_day(F.col("authorised"), year).alias("authorised"), F.col("distributor"), tx.parse_digits(F.col("spectators")).alias("spectators"), tx.parse_euros(F.col("revenue")).alias("revenue"), tx.parse_euros(F.col("revenue_total")).alias("revenue_total"), F.col("country")]


BLOCK = 4096  # lines of a book that one task numbers at a time
APART = "\u2028"  # between the fields of a line that is read: neither a dot nor a blank of its pattern matches it


def parse_yearbook_lines(lines: DataFrame, year: int, countries: list[str], noise: str) -> DataFrame:
    """Films from text lines (doc_id, line, text): one line a film; lines without a date or a euro sign go on with its distributor.

    A line is matched once. Films are counted within blocks of lines; what a block
    begins with goes on with the last film of the blocks before it.
    """
    money = r"\d[\d.\s]*(?:,\d{2})?"
    land = "|".join(sorted(map(_quoted, countries), key=len, reverse=True))
    row = rf"(?i)^(.+?)\s+(\d{{2}}[/-]\d{{2}}[/-]\d{{2,4}})\s+(.+)\s+(\d{{1,3}}(?:\.\d{{3}})*|\d+)\s+({money})\s*€\s+({money})\s*€\s*({land})$"
    fields = "".join(f"{APART}${i}" for i, _ in enumerate(YEARBOOK_FIELDS, 1)) + APART
    at = F.struct("doc_id", F.floor(F.col("line") / BLOCK).alias("block")).alias("at")
    said = F.when(~F.col("text").rlike(noise), F.regexp_replace("text", row, fields))
    clean = lines.select(at, "line", tx.rejoined_thousands(F.col("text")).alias("text")).select("at", "line", said.alias("said")).repartition("at")
    upto = Window.partitionBy("at").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clean = clean.withColumn("begins", F.coalesce(F.col("said").startswith(APART), F.lit(False))).withColumn("n", F.count_if("begins").over(upto))
    blocks = clean.groupBy("at").agg(F.max("n").alias("n"))  # reads the same columns as what it is joined to, so lines are read and dealt once
    earlier = Window.partitionBy("at.doc_id").orderBy("at.block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("n") > 0, F.struct("at.block", "n")), ignorenulls=True).over(earlier)
    clean = clean.join(blocks.select("at", last.alias("last")), "at")
    clean = clean.withColumn("film", F.when(F.col("n") > 0, F.struct("at.block", "n")).otherwise(F.col("last")))
    clean = clean.where("film IS NOT NULL AND said IS NOT NULL AND (begins OR NOT (said RLIKE '\\\\d{2}[/-]\\\\d{2}[/-]\\\\d{2}' OR contains(said, '€')))")
    field = F.split("said", APART)
    parts = {f: F.when(F.col("begins"), field[i]) for i, f in enumerate(YEARBOOK_FIELDS, 1)}
    clean = clean.select(F.col("at.doc_id").alias("doc_id"), "film", "line", *[F.coalesce(c, F.col("said")).alias(f) if f == "distributor" else c.alias(f) for f, c in parts.items()])
    more = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "distributor"))), lambda s: s["distributor"]), " ")
    films = clean.groupBy("doc_id", "film").agg(*[F.max(f).alias(f) for f in YEARBOOK_FIELDS if f != "distributor"], more.alias("distributor"))
    return films.select("doc_id", F.lit(year).alias("year"), *typed_film(year))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


# ---------------------------------------------------------------- two tables in one document


# Words at the end of a title that say it goes on below.
OPEN_ENDS = r"(?:DE|DEL|LA|EL|LOS|LAS)"


def _table_rule(state: dict, line: dict) -> dict:
    """What a line of a table makes of the state: the open film's value and title, and titles that wait for the next."""
    if line["ranked"]:
        return {"film": True, "valued": line["valued"], "early": state["waiting"], "open": line["open"], "waiting": False}
    if state["film"] and line["valued"] and not state["valued"]:
        return {**state, "valued": True, "early": False, "open": line["open"] if line["titled"] else state["open"]}
    if line["titled"] and state["film"] and (state["early"] or state["open"] or line["goes_on"]):
        return {**state, "early": False, "open": line["open"]}
    return {**state, "waiting": state["waiting"] or (line["titled"] and not line["dated"])}


_BOTH = [False, True]
TABLES = Machine(
    [{"film": f, "valued": v, "early": e, "open": o, "waiting": w} for f in _BOTH for v in _BOTH for e in _BOTH for o in _BOTH for w in _BOTH],
    {"ranked": _BOTH, "valued": _BOTH, "titled": _BOTH, "goes_on": _BOTH, "dated": _BOTH, "open": _BOTH},
    _table_rule,
)


def parse_two_tables(words: DataFrame, year: int, order_left: float, title_left: float, title_right: float, noise: str) -> DataFrame:
    """Films (doc_id, year, title, released, spectators, revenue) of a document with a table for each metric.

    Headings say which table follows; films of both are joined by title and date,
    and one that is in a single table has a null for the other metric.
    """
    lined = cluster_rows(words.where("top >= 45"))
    at = F.array_sort(F.collect_list(F.struct("x0", "pos", "text")))
    lines = lined.groupBy(*PAGE, "y").agg(at.alias("w")).withColumn("text", tx.squeeze(F.array_join(F.transform("w", lambda w: w["text"]), " ")))
    upper = F.upper("text")
    table, seen = upper.contains("TABLA"), lambda s: upper.contains(s)
    heading = F.when(upper.startswith("7.5") | seen("LARGOMETRAJES ESPAÑOLES Y EXTRANJEROS"), "none").when(table & seen("ESPECTADORES") & ~seen("RECAUDACIÓN"), "spectators").when(table & seen("RECAUDACIÓN"), "revenue")
    lines = lines.withColumn("heading", F.coalesce(heading, F.lit(""))).where((F.col("heading") != "") | ~F.col("text").rlike(noise))
    bare = lambda w: F.replace(w["text"], F.lit("€"), F.lit(""))
    kinds = {"day": lambda w: w["text"].rlike(r"^\d{2}/\d{2}/\d{4}$"), "whole": lambda w: bare(w).rlike(WHOLE), "money": lambda w: bare(w).rlike(r"^\d{1,3}(?:\.\d{3})*,\d{2}$")}
    dated = F.array_position(F.transform("w", kinds["day"]), True)
    after = F.slice("w", dated.cast("int") + 1, F.size("w"))
    last = lambda kind: F.coalesce(F.try_element_at(F.transform(F.filter(F.when(dated > 0, after).otherwise(F.col("w")), kinds[kind]), bare), F.lit(-1)), F.lit(""))

    def title(stop: Column) -> Column:
        """The words before ``stop`` (from 1; 0: all) and left of the title's right edge."""
        upto = F.when(stop > 0, F.slice("w", 1, (stop - 1).cast("int"))).otherwise(F.col("w"))
        return tx.squeeze(F.array_join(F.transform(F.filter(upto, lambda w: w["x0"] < title_right), lambda w: w["text"]), " "))

    stop = lambda kind: F.array_position(F.transform("w", kinds[kind]), True)
    lead = F.get("w", F.lit(0))
    rank = (lead["x0"] >= order_left) & lead["text"].rlike(r"^\d+$") & F.coalesce(lead["text"].try_cast("int").between(1, 100), F.lit(False))
    own = F.filter(F.slice("w", 1, F.greatest(dated.cast("int") - 1, F.lit(0))), lambda w: (w["x0"] >= title_left) & (w["x0"] < title_right))
    own = F.when(lead["text"].rlike(r"^\d+$"), F.filter(own, lambda w: w["pos"] != lead["pos"])).otherwise(own)
    fields = {
        "rank": rank,
        "day": F.when(dated > 0, F.get("w", (dated - 1).cast("int"))["text"]).otherwise(""),
        "whole": last("whole"),
        "money": last("money"),
        "title": title(stop("whole")),
        "money_title": title(stop("money")),
        "dated_title": tx.squeeze(F.array_join(F.transform(own, lambda w: w["text"]), " ")),
        "goes_on": tx.strip_marks(upper).rlike("^(DE|DEL) "),
    }
    lines = lines.select("doc_id", "page", "y", "heading", *[c.alias(n) for n, c in fields.items()])
    upto = Window.partitionBy("doc_id").orderBy("page", "y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    metric = F.last(F.nullif("heading", F.lit("")), True).over(upto)
    lines = lines.withColumns({"part": F.count(F.nullif("heading", F.lit(""))).over(upto), "metric": metric}).where("heading = '' AND metric <> 'none'")
    people = F.col("metric") == "spectators"
    ranked = F.col("rank") & (F.col("day") != "")
    said = F.when(ranked, F.col("dated_title")).when(people, F.col("title")).otherwise(F.col("money_title"))
    lines = lines.withColumns({"value": F.when(people, F.col("whole")).otherwise(F.col("money")), "said": said, "ranked": ranked})
    key = tx.upper_key(F.col("said"))
    ended = key.rlike(rf" {OPEN_ENDS}$") | key.rlike("[:-]$") | (~F.col("ranked") & key.rlike(rf"^{OPEN_ENDS}$"))
    flags = {"ranked": F.col("ranked"), "valued": F.col("value") != "", "titled": F.col("said") != "", "goes_on": F.col("goes_on"), "dated": F.col("day") != "", "open": ended}
    lines = TABLES.before(lines.withColumn("symbol", TABLES.symbol(**flags)), ["doc_id", "part"], ["page", "y"], "symbol")
    open_film = lambda n: TABLES.flag(F.col("state"), n)
    adds = ~F.col("ranked") & open_film("film") & (flags["valued"] & ~open_film("valued") | flags["titled"] & (open_film("early") | open_film("open") | F.col("goes_on")))
    waits = ~F.col("ranked") & ~adds & flags["titled"] & (F.col("day") == "")
    within = Window.partitionBy("doc_id", "part").orderBy("page", "y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({"adds": adds, "film": F.sum(F.col("ranked").cast("int")).over(within) + waits.cast("int")}).where(F.col("ranked") | adds | waits)
    named = F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("page", "y", "said"))), lambda r: r["said"] != ""), lambda r: r["said"]), " ")
    worth = F.min_by(F.when(F.col("ranked") | F.col("adds"), F.nullif("value", F.lit(""))), F.when((F.col("ranked") | F.col("adds")) & (F.col("value") != ""), F.struct("page", "y")))
    films = lines.groupBy("doc_id", "part", "film").agg(F.first("metric").alias("metric"), named.alias("title"), F.max(F.when(F.col("ranked"), F.col("day"))).alias("day"), worth.alias("value")).where("day IS NOT NULL")
    films = films.where("title <> ''").withColumn("title", tx.undashed(F.col("title"))).withColumn("key", tx.upper_key(F.col("title")))
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, c))
    merged = films.groupBy("doc_id", "key", "day").agg(F.min("title").alias("title"), pick("spectators", tx.parse_digits(F.col("value"))).alias("spectators"), pick("revenue", tx.parse_euros(F.col("value"))).alias("revenue"))
    return merged.select("doc_id", F.lit(year).alias("year"), "title", F.try_to_date("day", "d/M/yyyy").alias("released"), "spectators", "revenue")
