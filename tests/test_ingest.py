import difflib
import json

from pyspark.sql import functions as F

from boxmetrics.functions import dates as dt
from boxmetrics.functions import html as ht
from boxmetrics.operators import fuzzy
from boxmetrics.plans import records
from boxmetrics.sources import files
from boxmetrics.streaming import ingest

from .conftest import SMALL


def test_each_file_and_key_once(spark, tmp_path):
    folder, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = spark.createDataFrame([], "kind string, day string").schema
    (tmp_path / "in").mkdir()
    for n, rows in enumerate([[("a", "1"), ("a", "1")], [("a", "1"), ("b", "1")], []]):
        (tmp_path / "in" / f"{n}.json").write_text("".join(json.dumps({"kind": k, "day": x}) + "\n" for k, x in rows))
        ingest.ingest_available(spark, folder, schema, target, state, ["kind", "day"])
    ingest.ingest_available(spark, folder, schema, target, state, ["kind", "day"])
    assert sorted(tuple(r)[:2] for r in spark.read.parquet(target).collect()) == [("a", "1"), ("b", "1")]


def test_version_is_replaced_whole(spark, tmp_path):
    for n in (5, 3):
        at = files.write_version(spark.range(n), str(tmp_path / "t"), 1)
    assert spark.read.parquet(at).count() == 3
    got = files.fill_missing(spark.createDataFrame([(None,), ("x",)], "land string"), {"land": "none"})
    assert sorted(r.land for r in got.collect()) == ["none", "x"]


def test_periods(spark):
    names = ["top_31_al_2_enero_2020.pdf", "top_3_al_5_mayo_2019", "top_3_al_5_foo_2019", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(dt.file_period(F.col("n")).alias("p")).select(F.col("p.start").cast("string"), F.col("p.end").cast("string"))
    assert [tuple(r) for r in df.collect()] == [("2019-12-31", "2020-01-02"), ("2019-05-03", "2019-05-05"), (None, None), (None, None)]
    days = spark.createDataFrame([("31/12/31", "1/2/2020"), ("1/1/30", "2020-2-1"), ("x", "30/2/2020")], "s string, d string")
    got = days.select(dt.parse_short_day(F.col("s"), 30).cast("string"), dt.parse_day(F.col("d")).cast("string")).collect()
    assert [tuple(r) for r in got] == [("1931-12-31", "2020-02-01"), ("2030-01-01", "2020-02-01"), (None, None)]


def test_page_without_fields(spark):
    row = spark.createDataFrame([("<p>a&amp;lt;</p><script>x<b></script>",)], "h string").select(ht.to_text(F.col("h")), ht.element(F.col("h"), "h1"), ht.attribute(F.col("h"), "html", "lang")).first()
    assert tuple(row) == ("a&lt;", None, None)


def grams(s):
    return {f"  {s}  "[i : i + 3] for i in range(len(s) + 2)}


def test_fuzzy_equals_brute_force(spark):
    asked = ["red widget", "rd widgt", "zzz", ""]
    known = ["red widget", "red widgets", "blue widget", "red bolt", None]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id long, key string")
    c = spark.createDataFrame(list(enumerate(known)), "id long, key string")
    got = sorted((r.query_id, r.id, round(r.score, 9)) for r in fuzzy.fuzzy_candidates(q, c).collect())
    want = [(i, j, round(s, 9)) for i, a in enumerate(asked) for j, b in enumerate(known) if a and b and grams(a) & grams(b) and (s := difflib.SequenceMatcher(None, a, b).ratio()) >= 0.55]
    assert got == want and got


def test_fuzzy_query_on_tables(spark):
    rows = records.fuzzy_candidates(spark, SMALL).collect()
    assert all(0.55 <= r.score <= 1 and 1 <= r.place <= 5 for r in rows)
