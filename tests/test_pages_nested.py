"""Tables within tables against a plain walk over the tags, and pages of a megabyte."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from boxmetrics.operators import pages as pg

TAG = re.compile(r"<(/?)(table|tr|td|th)\b[^>]*>", re.I)


def walk(html):
    """Tables by a stack of open elements: a tag closes what it ends within its own table."""
    done, stack = [], []  # elements [tag, begin, end]

    def close(tags, at):
        while stack and stack[-1][0] in tags:
            done.append([*stack.pop(), at])

    for m in TAG.finditer(html):
        tag, at = m[2].lower(), m.start()
        inside = ("td", "th")
        if m[1]:
            if tag == "table":
                if any(t == "table" for t, _ in stack):
                    close((*inside, "tr"), at)
                    done.append([*stack.pop(), at])
            elif tag == "tr":
                close((*inside, "tr"), at)
            else:
                close(inside, at)
        else:
            if tag in inside:
                close(inside, at)
            elif tag == "tr":
                close((*inside, "tr"), at)
            if tag != "table" and not any(t == "table" for t, _ in stack):
                continue  # rows and cells outside of tables are nobody's
            stack.append((tag, at))
    while stack:
        done.append([*stack.pop(), len(html)])
    done.sort(key=lambda e: e[1])
    text = lambda e: " ".join(re.sub("<[^>]*>", " ", html[e[1] : e[2]]).split())
    within = lambda e, tag: [x for x in done if x[0] == tag and e[1] < x[1] < e[2]]
    return [([text(h) for h in within(t, "th")[:3]], [[text(c) for c in within(r, "td")] for r in within(t, "tr")]) for t in done if t[0] == "table"]


def tables(spark, *html):
    rows = spark.createDataFrame(list(enumerate(html)), "i int, h string")
    got = pg.with_tables(rows, "h").orderBy("i").collect()
    return [[(list(t.headers), [list(r) for r in t.rows]) for t in r._tables] for r in got]


def test_cells_behind_an_inner_table_stay(spark):
    page = "<p>x</p><table><tr><th>A</th></tr><tr><td>one <table><tr><td>in</td></tr></table> more</td><td>two</td></tr><tr><td>three</table> end <table></table>"
    assert tables(spark, page, "", None, "<b>no table", "</table><td>z</td><table><tr><td>a<td>b</tr><tr><td>c") == [
        [(["A"], [[], ["one in more", "in", "two"], ["in"], ["three"]]), ([], [["in"]]), ([], [])],
        [],
        [],
        [],
        [([], [["a", "b"], ["c"]])],
    ]


@pytest.mark.parametrize("seed", range(3))
def test_random_pages_equal_a_walk(spark, seed):
    rng = random.Random(seed)
    parts = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "x", "y ", "<b>z</b>", "<TABLE class='a'>", "<tr x=1>", "<tbody>", "<thead>"]
    html = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(150)]
    assert tables(spark, *html) == [walk(h) for h in html]


def test_a_large_page_takes_seconds(spark):
    row = "<tr><td>name {0}</td><td>a<table><tr><td>in {0}</td></tr></table></td><td>last {0}</td></tr>"
    flat = "<tr>" + "<td>some words of text {0}</td>" * 5 + "</tr>"
    page = "<table>" + "".join(row.format(i) for i in range(300)) + "</table><table>" + "".join(flat.format(i) for i in range(6000)) + "</table>"
    assert len(page) > 1_000_000
    began = time.time()
    got = tables(spark, page)[0]
    assert time.time() - began < 30
    assert len(got) == 302 and got[0][1][0] == ["name 0", "a in 0", "in 0", "last 0"] and len(got[-1][1]) == 6000


def test_fields_behind_a_nested_table(spark):
    head = "<tr><th>Función</th><th>Nombre</th><th>Notas</th></tr>"
    page = f"<h2>Film</h2><table>{head}<tr><td>Dirigido por<table><tr><td></td></tr></table></td><td>x</td></tr><tr><td>Guión</td><td>Ana Mar&iacute;a</td><td>n</td></tr></table>"
    df = spark.createDataFrame([(1, page)], "id int, h string")
    crew = pg.film_page(df, "id", "h").select(F.col("crew")).first().crew
    assert [(c.function, c.name, c.notes) for c in crew] == [("Dirigido por", "", "x"), ("Guión", "Ana María", "n")]
