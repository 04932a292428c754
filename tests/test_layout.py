"""Layouts on words: each rule against plain code or a worked page."""

import random
import re

import pytest
from pyspark.sql import functions as F

from boxmetrics.operators import layout as ly
from boxmetrics.sources.files import WORDS


def words(spark, rows):
    """Rows (page, x0, top, text) of one document, in reading order."""
    return spark.createDataFrame([("d", p, i, float(x), float(t), w) for i, (p, x, t, w) in enumerate(rows)], WORDS)


def test_rows_are_rounded_half_to_even(spark):
    tops = [0, 3, 9, 15, 21, 26.9, 27.1]
    got = ly.bucket_rows(words(spark, [(1, 0, t, "w") for t in tops])).orderBy("pos").collect()
    assert [r.y for r in got] == [round(t / 6) * 6 for t in tops]


def test_greedy_rows_equal_plain_code(spark):
    rng = random.Random(1)
    tops = [round(rng.uniform(0, 40), 1) for _ in range(120)]
    groups, want = [], []
    for t in tops:
        near = next((g for g in groups if abs(g - t) < 3), None)
        if near is None:
            groups.append(near := t)
        want.append(near)
    got = ly.cluster_rows(words(spark, [(1, 0, t, "w") for t in tops])).orderBy("pos").collect()
    assert [r.y for r in got] == want


def test_rows_that_go_on_join_their_record(spark):
    page = [(1, 10, 50, "RANK"), (1, 10, 100, "1"), (1, 40, 100, "First"), (1, 40, 112, "film"), (1, 10, 124, "2"), (1, 40, 124, "Second"), (1, 10, 136, "1234"), (1, 40, 148, "below"), (1, 10, 160, "3"), (1, 40, 160, "Third"), (1, 10, 172, "Fuente:"), (1, 40, 184, "foot")]
    got = ly.records(ly.bucket_rows(words(spark, page)), F.lit(60.0)).groupBy("record").agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("t")).orderBy("record").collect()
    assert [r.t for r in got] == ["1 First film", "2 Second", "3 Third"]


def test_anchors_and_bounds(spark):
    head = [(1, 20, 5, "RANK"), (1, 90, 5, "TÍTULO"), (1, 50, 5, "TITULO"), (1, 160, 5, "ORIGINAL"), (1, 240, 5, "DISTRIBUIDORA"), (1, 300, 6, "SEM."), (1, 330, 6, "CINES"), (1, 370, 6, "RECAUDACIÓN"), (1, 420, 6, "+/-%"), (1, 460, 6, "ESPE"), (1, 550, 6, "RECAUDACION"), (1, 600, 6, "ESPECTADORES"), (1, 10, 300, "CINES")]
    a = ly.header_anchors(words(spark, head), F.lit(100.0)).first()
    assert (a.rank, a.original, a.distributor, a.week, a.cinemas, a.screens) == (20, 160, 240, 300, 330, None)
    assert (a.title, a.revenue, a.change, a.spectators) == ([50, 90], [370, 550], [420], [460, 600])
    anchors = [("a", F.lit(10.0)), ("c", F.lit(100.0)), ("b", F.lit(60.0)), ("none", F.lit(None).cast("double"))]
    got = spark.range(1).select(ly.bounds(anchors, F.lit(200.0)).alias("b")).first().b
    assert [(b.name, b.lo, b.hi) for b in got] == [("a", 0, 50), ("b", 50, 92), ("c", 92, 300)]


@pytest.mark.parametrize("domestic", [False, True])
def test_layouts_without_a_header_have_no_gaps(spark, domestic):
    a = ly.header_anchors(words(spark, [(1, 0, 500, "x")]), F.lit(100.0)).withColumn("width", F.lit(800.0))
    b = a.select((ly.domestic_bounds if domestic else ly.chart_bounds)(F.col("width")).alias("b")).first().b
    assert b[0].lo == 0 and b[-1].hi == 900 and all(x.hi == y.lo for x, y in zip(b, b[1:], strict=False))
    assert [x.name for x in b[:3]] == (["rank", "title", "distributor"] if domestic else ["rank", "title", "original_title"])


def test_domestic_chart(spark):
    head = [(1, 40, 20, "RANK"), (1, 280, 20, "DISTRIBUIDORA"), (1, 392, 20, "SEM."), (1, 408, 20, "CINES"), (1, 440, 20, "RECAUDACION"), (1, 500, 20, "+/-%"), (1, 560, 20, "ESPECTADORES"), (1, 620, 20, "+/-%"), (1, 700, 20, "RECAUDACION"), (1, 760, 20, "ESPECTADORES")]
    row = [(1, 42, 200, "1"), (1, 60, 200, "La"), (1, 75, 200, "tribu"), (1, 250, 200, "Dist"), (1, 395, 200, "3"), (1, 412, 200, "210"), (1, 450, 200, "1.234,50"), (1, 470, 200, "€"), (1, 505, 200, "-12%"), (1, 565, 200, "4.321"), (1, 705, 200, "9.999,00"), (1, 765, 200, "8.888")]
    sizes = spark.createDataFrame([("d", 1, 800.0, 1000.0)], "doc_id string, page int, width double, height double")
    r = ly.parse_chart(words(spark, head + row), sizes, domestic=True).first()
    assert (r.rank, r.title, r.distributor, r.week, r.cinemas, r.screens, r.revenue, r.revenue_change, r.spectators, r.revenue_total, r.spectators_total) == ("1", "La tribu", "Dist", "3", "210", "210", "1234.5", "-12", "4321", "9999", "8888")


def test_annual_report_looks_ahead(spark):
    head = [(1, 20, 10, "RANK"), (1, 60, 10, "TITULO"), (1, 200, 10, "DISTRIBUIDORA"), (1, 300, 10, "FECHA")]
    page = [
        *[(1, 20, y, "x") for y in (20, 30)],
        *[(1, 20, 40, "1"), (1, 60, 40, "Uno"), (1, 200, 40, "Sur"), (1, 300, 40, "01/02/2024"), (1, 350, 40, "10.000"), (1, 380, 40, "€"), (1, 400, 40, "900")],
        *[(1, 20, 99, "2"), (1, 60, 99, "Infiltrada,"), (1, 100, 99, "La"), (1, 200, 99, "Beta"), (1, 230, 99, "Fiction"), (1, 300, 99, "11/10/2024"), (1, 350, 99, "8.000.000,50"), (1, 380, 99, "€"), (1, 400, 99, "1.274.000")],
        *[(1, 60, 111, "Buffalo"), (1, 90, 111, "Kids"), (1, 400, 111, "837.070")],
        *[(1, 20, 114, "3"), (1, 200, 114, "Warner"), (1, 230, 114, "Bros"), (1, 300, 114, "14/08/2024"), (1, 350, 114, "5.000.000"), (1, 380, 114, "€")],
        *[(2, 20, 40, "3"), (2, 60, 40, "Buffalo"), (2, 90, 40, "Kids"), (2, 200, 40, "Warner"), (2, 300, 40, "14/08/2024"), (2, 350, 40, "1"), (2, 380, 40, "€")],
    ]
    got = sorted((r["rank"], r.title, r.distributor, str(r.released), float(r.revenue), r.spectators) for r in ly.parse_annual(words(spark, head + page)).collect())
    assert got == [(1, "Uno", "Sur", "2024-02-01", 10000.0, 900), (2, "Infiltrada, La", "Beta Fiction", "2024-10-11", 8000000.5, 1274000), (3, "Buffalo Kids", "Warner Bros", "2024-08-14", 5000000.0, 837070)]


def line(page, top, **cells):
    at = dict(title=10, authorised=260, distributor=320, spectators=505, revenue=550, revenue_total=615, country=690)
    return [(page, at[k] + 4 * i, top, w) for k, v in cells.items() for i, w in enumerate(v.split())]


def test_yearbook_by_columns(spark):
    figures = dict(authorised="05/03/98", spectators="1.234", revenue="5.000,10", revenue_total="6.000,20", country="FRANCIA")
    rows = [
        *line(1, 50, title="above"),
        *line(1, 100, title="TÍTULO FECHA"),
        *line(1, 120, title="PLAIN FILM", distributor="Uno", **figures),
        *line(1, 130, distributor="SA"),
        *line(1, 140, title="TITLE BEFORE"),
        *line(1, 150, distributor="Dos", **figures),
        *line(1, 160, title="AND AFTER"),
        *line(1, 170, title="NEXT ONE"),
        *line(2, 80, distributor="Tres", **figures),
        *line(2, 100, title="SPLIT- TED", distributor="Cuatro", **figures),
    ]
    got = ly.parse_yearbook(words(spark, rows), 2007, "(?iu)título fecha").collect()
    assert [(r.title, r.distributor) for r in got] == [("PLAIN FILM", "Uno SA"), ("TITLE BEFORE AND AFTER", "Dos"), ("NEXT ONE", "Tres"), ("SPLITTED", "Cuatro")]
    assert {(str(r.authorised), r.spectators, float(r.revenue), float(r.revenue_total), r.country) for r in got} == {("1998-03-05", 1234, 5000.1, 6000.2, "FRANCIA")}


def test_layout_of_a_year(spark):
    b = spark.createDataFrame([(2005,), (2008,), (2009,), (2010,), (2011,), (2012,), (2013,), (2014,), (2015,), (2023,)], "y int").select(ly.yearbook_bounds(F.col("y")).alias("b")).collect()
    assert [r.b[1].lo for r in b] == [255, 260, 265, 285, 305, 305, 290, 290, 290, 290]
    assert [x.lo for x in b[4].b] == [0, 305, 350, 525, 570, 640, 720] and [x.lo for x in b[6].b] == [0, 290, 340, 515, 565, 625, 700] and [x.lo for x in b[8].b] == [0, 290, 340, 515, 565, 630, 700]


def test_data_rows(spark):
    good = {"title": "A", "authorised": "01/02/2003", "distributor": "", "spectators": "1.234", "revenue": "1.000,10 €", "revenue_total": "2", "country": ""}
    rows = [good, {**good, "authorised": ""}, {**good, "title": " "}, {**good, "spectators": "12x"}, {**good, "revenue": ""}, {**good, "authorised": "1/2/03"}]
    df = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{f} string" for f in good))
    assert [r.v for r in df.orderBy("i").select(ly.is_data_row().alias("v")).collect()] == [True, True, False, False, False, False]


def test_yearbook_by_lines(spark):
    text = ["TÍTULO FECHA", "LA PLAYA 05/03/98 Uno Films 1. 234 5.000,10 € 6 000,20 € REINO UNIDO", "y Compañía", "noise 01/01/99", "OTRA 06-03-2001 Dos 77 1,00 € 2,00 € FRANCIA"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(text)], "doc_id string, line int, text string")
    got = sorted(tuple(map(str, r)) for r in ly.parse_yearbook_lines(df, 2007, ["UNIDO", "REINO UNIDO", "FRANCIA"], "(?iu)título fecha").collect())
    assert got == [("d", "2007", "LA PLAYA", "1998-03-05", "Uno Films y Compañía", "1234", "5000.10", "6000.20", "REINO UNIDO"), ("d", "2007", "OTRA", "2001-03-06", "Dos", "77", "1.00", "2.00", "FRANCIA")]


def test_two_tables(spark):
    def row(top, order, title, *rest):
        return [(1, 125, top, str(order)), *[(1, 170 + 20 * i, top, w) for i, w in enumerate(title.split())], *[(1, 600 + 40 * i, top, w) for i, w in enumerate(rest)]]

    page = [
        *[(1, 100 + 60 * i, 50, w) for i, w in enumerate("PRIMERA TABLA ESPECTADORES".split())],
        *row(80, 1, "LA ISLA DE", "01/02/2019", "1.234"),
        (1, 170, 90, "AL LADO"),
        (1, 170, 100, "TITULO"),
        *row(110, 2, "SUELTO", "03/04/2019", "555"),
        *row(120, 3, "SIN VALOR", "05/06/2019"),
        *[(1, 170, 130, "LARGO"), (1, 700, 130, "77")],
        *[(1, 100 + 60 * i, 200, w) for i, w in enumerate("SEGUNDA TABLA RECAUDACIÓN".split())],
        *row(220, 1, "LA ISLA DE AL LADO", "01/02/2019", "9.876,50€"),
        *row(230, 2, "OTRA", "07/08/2019", "1.000,00"),
    ]
    got = {r.title: (str(r.released), r.spectators, r.revenue and float(r.revenue)) for r in ly.parse_two_tables(words(spark, page), 2019, 120, 165, 590, "(?i)distribuidoras").collect()}
    assert got == {"LA ISLA DE AL LADO": ("2019-02-01", 1234, 9876.5), "TITULO SUELTO": ("2019-04-03", 555, None), "SIN VALOR LARGO": ("2019-06-05", 77, None), "OTRA": ("2019-08-07", None, 1000.0)}


def test_repeated_films_count_once(spark):
    df = spark.createDataFrame([("d", 2, 1, "a very long title, one"), ("d", 1, 1, "a very long title, two"), ("d", 1, 2, ""), ("e", 1, 1, "a very long title, one")], "doc_id string, page int, rank int, title string")
    assert sorted((r.doc_id, r.page) for r in ly.first_of_repeated(df, ["page"]).collect()) == [("d", 1), ("e", 1)]
    assert re.match(ly.DAY, "01-02-99")
