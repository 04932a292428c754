"""Choosing, queues, decisions, pages and files on small fixtures."""

import datetime
import difflib
import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from boxmetrics.operators import chart as ch
from boxmetrics.operators import decisions as dc
from boxmetrics.operators import fuzzy
from boxmetrics.operators import pages as pg
from boxmetrics.operators import tables as tb
from boxmetrics.sources import files


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


# ---------------------------------------------------------------- choosing


def test_best_film_is_rejected_outright(spark):
    cols = "query_id int, asked string, year int, id int, title string, original_title string, released int, popularity double, votes int, language string, countries array<string>, minutes int"
    pairs = [
        (1, "La isla", 2010, 10, "Isla", "x", 2011, 9.0, 50, "en", ["US"], 90),  # the best, but foreign
        (1, "La isla", 2010, 11, "Isla mar", "x", 2010, 1.0, 50, "es", ["ES"], 90),
        (2, "Mar", 2010, 20, "Mar", "Mar", 2010, 0.1, 4, "es", ["ES"], 90),  # nobody knows it
        (2, "Mar", 2010, 21, "Mar rojo", "Red", 2010, None, 6, "fr", ["FR", "ES"], 0),
        (3, "Sol", 2010, 30, "Sol", "Sol", 2010, 2.0, 9, "es", ["ES"], 25),  # short
        (4, "Luz", None, 41, "Luz", "Luz", 2010, 5.0, 9, "es", None, None),
        (4, "Luz", None, 40, "Luz", "Luz", 2010, 5.0, 9, "es", None, None),
    ]
    df = spark.createDataFrame(pairs, cols)
    assert [(r.query_id, r.id, round(r.score, 3)) for r in dc.best_film(df).orderBy("query_id").collect()] == [(1, 10, 1.0), (2, 21, 0.9), (3, 30, 1.0), (4, 40, 1.0)]
    assert rows(dc.best_film(df, domestic=True), "query_id", "id") == [(2, 21), (4, 40)]


def test_best_person_of_the_first_few(spark):
    cols = "query_id int, asked string, id int, name string, department string, popularity double"
    pairs = [(1, "Roca, Ana", i, "Ana Roca", "Acting", 90.0) for i in (1,)] + [(1, "Roca, Ana", 10 + i, f"Ana Pi{i}", "Directing", float(i)) for i in range(5)] + [(2, "Sol, Eva", 30, "Eva Sol", "Acting", 1.0), (3, "X", 40, "Y", "Directing", 500.0)]
    got = dc.best_person(spark.createDataFrame(pairs, cols), "Directing").orderBy("query_id").collect()
    assert [(r.query_id, r.id) for r in got] == [(1, 14), (2, 30)]  # the actress comes sixth


def plain_assignment(results, titles):
    left, out = list(titles), []
    for i, text in results:
        best, score = None, 0.0
        for t in left:
            words = [w for w in t.lower().split() if len(w) > 2]
            share = sum(w in text.lower() for w in words) / len(words) if words else 0.0
            if share > score:
                best, score = t, share
        if i is not None and best and (score >= 0.55 or len(left) == 1):
            left.remove(best)
            out.append((best, i))
    return sorted(out)


def test_results_are_assigned_in_turn(spark):
    batches = {1: ([(7, "the isla del mar"), (None, "rojo"), (8, "isla rojo"), (9, "nothing but rojo")], ["Isla mar", "Isla sol", "Rojo vivo"]), 2: ([(5, "unrelated"), (6, "a word of titles")], ["Titles here gone"]), 3: ([], ["a"])}
    res = [(b, n, i, t) for b, (rs, _) in batches.items() for n, (i, t) in enumerate(rs)]
    tit = [(b, n, t) for b, (_, ts) in batches.items() for n, t in enumerate(ts)]
    got = dc.assign_results(spark.createDataFrame(res, "batch int, pos int, id int, text string"), spark.createDataFrame(tit, "batch int, pos int, title string"))
    assert rows(got, "batch", "title", "id") == sorted(((b, *x) for b, (rs, ts) in batches.items() for x in plain_assignment(rs, ts)), key=str)


def test_fuzzy_over_whole_keys(spark):
    known = [(i, "common title") for i in range(10)] + [(20, "common tittle"), (21, "other thing")]
    asked = [(1, "common title"), (2, "comon title"), (3, "zzz"), (4, None)]
    q, c = spark.createDataFrame(asked, "query_id long, key string"), spark.createDataFrame(known, "id long, key string")
    want = []
    for i, a in asked:
        scored = sorted((-difflib.SequenceMatcher(None, a, k).ratio(), n) for n, k in known if a)
        want += [(i, n) for s, n in scored if -s >= 0.55][:5] if a else []
    assert rows(fuzzy.fuzzy_candidates(q, c), "query_id", "id") == sorted(want, key=str)
    assert rows(fuzzy.fuzzy_candidates(q, c, common=1), "query_id", "id") == sorted(want, key=str)  # grams too common: by the rarest
    left = fuzzy.unresolved(q, spark.createDataFrame([(2,)], "query_id long"), c)
    assert rows(left, "query_id") == [(3,), (4,)]


def test_candidates_of_all_kinds(spark):
    c = spark.createDataFrame([("a", 1, 2008), ("b", 2, 1990), ("c", 3, 2009), ("c", 4, 2009), ("a", 1, 2008)], "key string, id int, year int")
    q = spark.createDataFrame([(1, "a", 2010, "redemption"), (2, "b", 2010, "other"), (3, "c", 2010, None), (4, "d", 2010, None)], "query_id int, key string, year int, kind string")
    assert rows(tb.route(tb.candidates(q, c)), "query_id", "n", "id", "route") == [(1, 1, 1, "matched"), (2, 1, 2, "year_conflict"), (3, 2, 3, "pending"), (4, 0, None, "none")]


# ---------------------------------------------------------------- decisions


def test_upserts_take_one_update_a_key(spark):
    base = spark.createDataFrame([(1, 5, 1), (2, 6, 0)], "k int, v int, p int")
    new = spark.createDataFrame([(1, 7), (2, 8), (2, 9), (3, 1)], "k int, v int")
    assert rows(tb.merge_latest(base.drop("p"), new, ["k"])) == [(1, 7), (2, 9), (3, 1)]
    assert rows(tb.merge_latest(base.drop("p"), new, ["k"], [F.asc("v")])) == [(1, 7), (2, 8), (3, 1)]
    assert rows(tb.guarded_merge(base, new, "k", F.col("p") == 1, "v")) == [(1, 5, 1), (2, 9, 0)]


def test_decisions_and_renamed_ids(spark):
    base = spark.createDataFrame([(1, 10, "matched", "auto", ""), (2, 20, "matched", "auto", ""), (3, 30, "matched", "auto", "")], "k int, target int, status string, method string, note string")
    made = spark.createDataFrame([(1, "match", 11, "n", 1), (1, "none", None, "m", 2), (2, "clear", None, None, 1), (4, "change", 40, "o", 1), (5, "review", 50, None, 1)], "k int, action string, target int, note string, at int")
    assert rows(dc.record_decisions(base, made, "k"), "k", "target", "status", "method") == [(1, None, "no_sheet", "manual"), (3, 30, "matched", "auto"), (4, 40, "matched", "manual"), (5, None, "review", "manual")]
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, v string")
    changes = spark.createDataFrame([(1, 9), (2, 3), (4, 9)], "old int, new int")
    assert rows(dc.renamed_ids(table, "id", changes)) == [(3, "c"), (9, "a")]
    assert rows(dc.delete_where(dc.update_where(table, F.col("id") < 3, {"v": F.lit("x")}), F.col("v") == "d")) == [(1, "x"), (2, "x"), (3, "c")]


def test_merging_by_column(spark):
    base = spark.createDataFrame([(1, ["b"], "keep", "old", "x")], "k int, roles array<string>, mine string, fill string, v string")
    new = spark.createDataFrame([(1, ["a", "b"], "new", None, None), (2, None, "first", "f", "y")], base.schema)
    got = dc.merge_fields(base, new, "k", keep=("mine",), union=("roles",), fill=("fill",)).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, ["a", "b"], "keep", "old", None), (2, [], "first", "f", "y")]


def test_queues(spark):
    raw = spark.createDataFrame([(1, "A b", 2010, 5.0), (2, "C", 2011, 9.0), (3, "D", 2012, 1.0), (4, "E", 2012, 3.0)], "id int, title string, year int, amount double")
    sheets = spark.createDataFrame([("a-B", 10), ("c", 11), ("C!", 12)], "title string, sheet int")
    done = spark.createDataFrame([(4,)], "id int")
    assert [r.id for r in dc.raw_queue(raw, done, sheets).collect()] == [2, 3]
    assert [r.id for r in dc.raw_queue(raw, done, sheets, query="b").collect()] == [1]  # searching shows the settled ones
    assert rows(dc.run_counts(spark.createDataFrame([(1,), (7,), (None,)], "id int"), raw.select("id"), "id")) == [(1, 1, 1)]
    assert rows(dc.derived_ids(spark.createDataFrame([(1,), (2,), (3,)], "id int"), spark.createDataFrame([(1,), (140,), (240,)], "id int"))) == [(1, "1"), (2, "240"), (3, None)]


def test_levels_need_eight_weeks(spark):
    def levels(n):
        shares = spark.createDataFrame([(datetime.date(2024, 1, 1) + datetime.timedelta(7 * i), float(v), 0.0, 0.0, 0.0) for i, v in enumerate([10, 11, 12, 50, 11, 10, 12, 11, 10][:n])], "week date, top1 double, top3 double, top5 double, rest double")
        return [r.level for r in ch.classify(shares, ch.segment_stats(shares)).orderBy("week").collect()]

    assert set(levels(3)) == set(levels(7)) == {None}
    assert levels(9)[3] == "very high" and None not in levels(9)


# ---------------------------------------------------------------- pages


PAGE = """<html><h2> Mi <b>Film</b> </h2>
<label>Calificación:</label><label>Apta</label><label>Año de Producción</label><label>2019</label><label>Fecha de Estreno:</label><label>02/09/2020</label>
<label>Duración:</label><label>LARGO / 110 min.</label><label>Recaudación:</label><label>4.094.999,17 €</label><label>Espectadores:</label><label>652.829</label>
<label>Breve sinopsis</label><p><label>Una &amp; historia</label></p>
<div><label>Etiquetado:</label><label>drama</label><label>Sinopsis en Inglés:</label><label>mar</label><label>{long}</label><label>late</label></div><label>outside</label>
<table><tr><th>Función</th><th>Nombre</th><th>Papel</th></tr><tr><td>Act</td><td>Ana</td><td>Eva</td></tr><tr><td>only</td></tr><tr><td>Act</td><td>Pep</td></tr></table>
<table><tr><th>Función</th><th>Nombre</th><th>Notas</th></tr><tr><td>Dirigido por</td><td>Dir  One</td><td></td></tr><tr><td>Codirigido</td><td>Dir Two</td><td>x</td></tr></table>
<table><tr><th>Subvención</th><th>Importe</th></tr><tr><td>a</td><td>1.000,50 €</td></tr><tr><td>b</td><td>2 €</td></tr></table>
<table><tr><th>Subvención</th><th>Importe</th></tr><tr><td>c</td><td>7 €</td></tr></table>
<table><tr><th>Subvención</th><th>Importe</th></tr><tr><td>d</td><td>-</td></tr></table>
<table><tr><th>Leyenda</th><th>Informacion</th></tr><tr><td>Fecha inicio de rodaje</td><td>01/02/2018</td></tr><tr><td>Lugar</td><td>Vigo</td></tr><tr><td>Lugar 2</td><td>Lugo</td></tr></table>
<table><tr><th>Premios obtenidos</th></tr><tr><td>Goya</td><td>Guion</td></tr></table><table><tr><th>Participación en Festivales</th></tr><tr><td>Berlin</td></tr></table>
<ul class="pro-details-tablist"><li>Empresas PRODUCTORAS</li></ul><div class="hidden-panel-details"><label>Empresas Productoras</label><label>Uno SA</label><label>Dos SL</label></div>
<ul class="pro-details-tablist"><li>DISTRIBUIDORA</li></ul><div class="hidden-panel-details"><label>Tres</label></div>
<script>var x = "<h2>no</h2>";</script></html>""".replace("{long}", "z" * 80)


def test_film_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>no title</p>"), (3, "<h2>Bare</h2>"), (4, None)], "id int, html string")
    a, b = pg.film_page(df, "id", "html").orderBy("id").collect()
    assert (a.title, a.director, a.rating, a.year, str(a.released), a.minutes, float(a.revenue), a.spectators, a.kind) == ("Mi Film", "Dir One", "Apta", 2019, "2020-09-02", 110, 4094999.17, 652829, None)
    assert (a.synopsis, a.tags) == ("Una & historia", ["drama", "mar"])
    assert [tuple(x) for x in a.cast] == [("Act", "Ana", "Eva"), ("Act", "Pep", "")] and [x.name for x in a.crew] == ["Dir One", "Dir Two"]
    assert [(x.concept, x.amount and float(x.amount)) for x in a.grants] == [("a", 1000.5), ("b", 2.0), ("c", 7.0), ("d", None)] and float(a.grants_total) == 7.0
    assert (str(a.shoot_began), a.shoot_ended, a.places) == ("2018-02-01", None, ["Vigo", "Lugo"])
    assert [tuple(x) for x in a.awards] == [("Goya", "Guion", "")] and [tuple(x) for x in a.festivals] == [("Berlin", "")]
    assert (a.producers, a.distributors) == (["Uno SA", "Dos SL"], ["Tres"])
    assert (b.title, b.director, b.cast, b.grants_total, b.tags) == ("Bare", "", [], None, [])


def test_text_cascades_and_ids(spark):
    texts = ["x VÍNCULOS Y REDES SOCIALES  La Isla - catálogo de", "Título Original: Mar Rojo Dirigido por X Spain Release: 01/02/2003", "Fecha de Estreno: 05/06/2007 Estreno en España: 01/01/2001", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    got = [(r.a, r.b) for r in df.select(pg.first_match(F.col("t"), pg.TITLE_PATTERNS).alias("a"), pg.first_match(F.col("t"), pg.DATE_PATTERNS).alias("b")).collect()]
    assert got == [("La Isla", None), ("Mar Rojo", "01/02/2003"), (None, "05/06/2007"), (None, None)]


def test_links_latest_rows_and_harvest(spark):
    page = 'skip href="/dam/top-25-0.pdf"\nHist\n<h3 class="s">2020</h3>\n<a href="/dam/a/top-25-1-3-mayo.pdf">\n<h3>Enero 2021</h3>\n<a href="/dam/a/topespanol-1.pdf"> \n<a href="/dam/a/top-25-1-3-mayo.pdf">\n<a href="/dam/other.pdf">'
    df = spark.createDataFrame([(1, page)], "id int, html string")
    assert rows(pg.report_links(df, "id", "html", site="http://s"), "url", "kind", "year", "month") == [("http://s/dam/a/top-25-1-3-mayo.pdf", "top", 2020, None), ("http://s/dam/a/topespanol-1.pdf", "domestic", 2021, 1)]
    cells = lambda *c: "<tr>" + "".join(f"<td> {x} </td>" for x in c) + "</tr>"
    table = "<table><tbody>" + cells("1", "A", "B", "C", "D", "01/02/2024") + cells("2", "", "B", "C", "D", "x") + cells("3", "T", "B", "C") + cells("4", "E", "", "C", "D", "x") + "</tbody></table>"
    assert rows(pg.latest_rows(spark.createDataFrame([(1, table)], "id int, html string"), "id", "html"), "id", "title", "director", "resolved") == [("1", "A", "B", datetime.date(2024, 2, 1)), ("4", "E", None, None)]
    dump = spark.createDataFrame([('<a href="/f?Pelicula=5">Cinco</a> {"u": "?pelicula=6"} <a href="x?a=1&Pelicula=5">Cinco</a>',)], "t string")
    assert rows(pg.new_finds(dump, "t", spark.createDataFrame([(5,)], "id int"))) == [("6", "Unknown Title")]
    assert rows(pg.harvest(dump, "t", spark.createDataFrame([(7,)], "id int"))) == [("5", "Cinco"), ("6", "Unknown Title"), ("7", "Unknown Title")]


def test_answers_of_a_service(spark):
    film = {"id": 1, "title": "T", "runtime": 90, "credits": {"crew": [{"job": "Director", "name": "A"}, {"job": "X", "name": "B"}, {"job": "Director", "name": "C"}], "cast": [{"name": str(i)} for i in range(9)]}, "keywords": {"keywords": [{"name": str(i)} for i in range(12)]}, "videos": {"results": [{"type": "Teaser", "site": "YouTube", "key": "no"}, {"type": "Trailer", "site": "YouTube", "key": "k"}]}, "production_countries": [{"iso_3166_1": "ES"}]}
    person = {"id": 2, "images": {"profiles": [{"file_path": "/a", "vote_average": 1}, {"file_path": "/b", "vote_average": 5}, {"file_path": None, "vote_average": 9}]}, "movie_credits": {"crew": [{"job": "Director", "title": "Old", "release_date": "1999-01-01"}, {"job": "Writer", "title": "No"}, {"job": "Co-Director", "title": "New", "release_date": "2020-05-05"}, {"job": "Director", "title": "None"}], "cast": [{"title": "P", "popularity": 1.0, "release_date": "2001-01-01", "character": "X"}, {"title": "Q", "popularity": 7.0, "character": ""}]}}
    r = spark.createDataFrame([(json.dumps(film), json.dumps(person))], "f string, p string").select(pg.film_details(F.col("f")).alias("f"), pg.person_details(F.col("p")).alias("p")).first()
    assert (r.f.director, r.f.cast, len(r.f.keywords), r.f.trailer, r.f.countries) == ("A, C", list("01234"), 10, "https://www.youtube.com/watch?v=k", ["ES"])
    assert (r.p.photos, r.p.n_directed, r.p.directed, r.p.n_acted, r.p.acted) == (["/b", "/a"], 3, ["New (2020)", "Old (1999)", "None"], 2, ["Q", "P (2001) [X]"])


# ---------------------------------------------------------------- files


def test_signature_stem_and_pairs(spark, tmp_path):
    (tmp_path / "12.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "13.pdf").write_bytes(b"<html>")
    got = files.with_signature(files.read_documents(spark, str(tmp_path), "*.pdf")).select(files.file_stem(F.col("path")).alias("s"), "valid")
    assert rows(got) == [("12", True), ("13", False)]
    (tmp_path / "7.html").write_text("<h2>á</h2> id=99")
    (tmp_path / "8.html").write_text("id=5")
    pages = files.read_pages(spark, str(tmp_path))
    pairs = files.pair_manifests(pages, spark.createDataFrame([("7", "http://x?Pelicula=42")], "stem string, url string"), F.regexp_extract("url", r"Pelicula=(\d+)", 1), F.regexp_extract("html", r"id=(\d+)", 1))
    assert rows(pairs, "stem", "id") == [("7", "42"), ("8", "5")] and "á" in pages.where("stem = '7'").first().html


def test_delimited_sources(spark, tmp_path):
    (tmp_path / "g.csv").write_text("titulo;importe;presupuesto;tipo;anio\nUno, dos ;1,5;;general; 2010 \nTres;x;2;general;2011\nCuatro;2;3;selectiva;\n")
    good, bad = files.read_grants(spark, str(tmp_path / "g.csv"))
    assert rows(good) == [("Cuatro", 2.0, 3.0, "selectiva", None), ("Uno, dos", 1.5, None, "general", 2010)] and [r.line for r in bad.collect()] == ["Tres;x;2;general;2011"]
    (tmp_path / "s.csv").write_text("wrong,header,names\n2010,1.5,\n2011,,3\nx,1,1\n")
    assert rows(files.read_series(spark, str(tmp_path / "s.csv"), ["a", "b"])) == [(2010, 1.5, None), (2011, None, 3.0)]
    (tmp_path / "ids.csv").write_text("﻿id\n5\n\n3,x\nbad\n5\n 9 \n")
    assert [r.id for r in files.read_ids(spark, str(tmp_path / "ids.csv")).orderBy("place").collect()] == [5, 3, 9]
    for name, text in {"a": "Titulo\tfecha_estreno\nUno\t2020-01-02\n\t2020-01-02\n", "b": "2020-01-02,Uno\n", "c": "Uno\t2020-01-02\n"}.items():
        (tmp_path / name).write_text(text)
        assert rows(files.read_titles(spark, str(tmp_path / name))) == [(datetime.date(2020, 1, 2), "Uno")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([Row(b="y", a="x", extra=1)])
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        files.write_rows(df, str(tmp_path / kind), ["a", "b", "c"], kind)
        assert spark.read.text(str(tmp_path / kind)).orderBy("value").first()[0] == sep.join(("a", "b", "c"))
    files.write_rows(df, str(tmp_path / "json"), ["a", "b"], "json")
    assert spark.read.json(str(tmp_path / "json")).columns == ["a", "b"]
    files.append_rows(df, str(tmp_path / "t"))
    files.append_rows(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_assignment_equals_plain_code(spark):
    import random

    rng = random.Random(6)
    vocabulary = ["sol", "mar", "isla", "noche", "tren", "rojo"]
    some = lambda k: " ".join(rng.choices(vocabulary, k=k))
    titles = [(b, i, f"{some(rng.randrange(1, 4))}") for b in range(60) for i in range(rng.randrange(1, 5))]
    results = [(b, i, 100 * b + i if rng.random() < 0.9 else None, some(rng.randrange(0, 5))) for b in range(60) for i in range(rng.randrange(0, 6))]
    want = []
    for b in range(60):
        left = [(p, t) for x, p, t in titles if x == b]
        for _, _, i, text in sorted(r for r in results if r[0] == b and r[2] is not None):
            share = lambda t, text=text: sum(w in text for w in t.split()) / len(t.split())
            best = max(left, key=lambda t: (share(t[1]), -t[0]), default=None)
            if best and share(best[1]) > 0 and (share(best[1]) >= 0.55 or len(left) == 1):
                want.append((b, best[1], i))
                left.remove(best)
    got = dc.assign_results(spark.createDataFrame(results, "batch int, pos int, id int, text string"), spark.createDataFrame(titles, "batch int, pos int, title string"))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 40
