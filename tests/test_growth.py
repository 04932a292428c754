"""What grows with the square of the rows, or with a group's length, is kept out of the plans; results stay the same."""

import duckdb
import pytest
from pyspark.sql import functions as F

from boxmetrics.operators import fuzzy
from boxmetrics.operators import layout as ly
from boxmetrics.operators import tables as tb
from boxmetrics.plans import printed, records, reports  # noqa: F401

from .conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_are_compared_before_the_rows_are_paired(spark):
    last = plan(records.name_score(spark, SMALL)).split("Join")[0]  # what is done to each pair of rows
    assert "regexp_replace" not in last and "array_intersect" not in last


def test_candidates_are_ranked_before_they_meet_their_queries(spark):
    last = plan(records.candidate_rank(spark, SMALL)).split("Join")[0]  # pairs of rows are neither sorted nor shuffled
    assert "Window" not in last and "row_number" not in last


def test_candidates_of_orders_without_a_day_or_kind(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "C"), (2, "a b", "C"), (3, "d", "C")], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    orders = [(10, 1, None, "1-URGENT"), (11, 2, "1990-01-01 00:00:00", "5-LOW"), (12, 3, "1995-05-05 00:00:00", None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, day string, o_orderpriority string").select("o_orderkey", "o_custkey", F.to_timestamp("day").alias("o_orderdate"), "o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(tuple(r) for r in records.candidate_rank(spark, str(tmp_path)).collect())
    assert got == [(10, 1, True, None, 1), (10, 2, True, None, 2), (11, 1, False, 1, 2), (11, 2, False, 0, 1), (12, 3, False, 4, 1)]


def rows_shuffled(node) -> int:
    """Rows that the exchanges of a plan wrote, after it has run."""
    kind, n = node.nodeName(), 0
    if kind == "Exchange":
        n = node.metrics().apply("shuffleRecordsWritten").value()
    below = [node.executedPlan()] if kind == "AdaptiveSparkPlan" else [node.plan()] if kind.endswith("QueryStage") else [node.children().apply(i) for i in range(node.children().size())]
    return n + sum(rows_shuffled(b) for b in below)


def write_orders_and_parts(spark, path, parts, orders):
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(f"{path}/part.parquet")
    rows = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, day string, o_orderpriority string")
    rows.select("o_orderkey", "o_custkey", F.to_timestamp("day").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority").write.parquet(f"{path}/orders.parquet")


KINDS = ["1-URGENT", "5-LOW", "2-HIGH"]


def test_rankings_are_not_shuffled(spark, tmp_path):
    orders = [(i, i % 500, f"{1995 + i % 7}-03-04 00:00:00", KINDS[i % 3]) for i in range(300)]
    write_orders_and_parts(spark, tmp_path, [(i, "a b", "C") for i in range(500)], orders)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables of size would be joined
    try:
        df = records.candidate_rank(spark, str(tmp_path))
        assert len(df.collect()) == 300 * 500
        assert rows_shuffled(df._jdf.queryExecution().executedPlan()) < 3 * (300 + 500)  # 21 rankings have 10,500 rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


@pytest.mark.parametrize("run, dealt", [(1, 1), (5, 3), (4096, 4)])
def test_rankings_go_on_over_runs_of_ids(spark, tmp_path, monkeypatch, run, dealt):
    monkeypatch.setattr(records, "RUN", run)
    monkeypatch.setattr(records, "DEALT", dealt)
    parts = [(i - 20, ["a b", "d", "e"][i % 7 % 3], "C") for i in range(90)] + [(None, "a b", "C")]
    orders = [(i, i % 80 - 25, None if i % 11 == 0 else f"{1980 + i % 25}-03-04 00:00:00", KINDS[i % 3]) for i in range(200)]
    write_orders_and_parts(spark, tmp_path, parts, orders)
    got = records.candidate_rank(spark, str(tmp_path)).select("query_id", "id", "odd", "distance", "place").collect()
    con = duckdb.connect()
    for t in ("part", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.sql(f"SELECT query_id, id, odd, distance, place FROM ({records.base.ORACLE['candidate_rank']})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(want) > 1000


def test_sums_of_over_twelve_digits_are_rounded(spark):
    rows = spark.createDataFrame([(2251403475513.12345,), (1.00005,), (None,)], "v double")
    assert [r.v for r in rows.select(records.round4(F.col("v")).alias("v")).collect()] == [2251403475513.1235, 1.0001, None]
    large = spark.createDataFrame([("a", 5e12), ("a", 5e12)], "g string, v double")
    assert tb.percentile_tiers(large, "g", "v").first().mean25 == 5e12


def test_bounds_of_quantiles_are_sketched_once(spark):
    """A sketch made twice may differ, by the order its parts arrive in; counts by one and values by the other do not fit."""
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    assert plan(tb.percentile_tiers(rows, "g", "v")).count("percentile_approx") == 1


def test_pages_made_of_a_small_file_are_read_by_many_tasks(spark):
    assert reports.film_pages(spark, SMALL).rdd.getNumPartitions() == 4  # as a shuffle has; the file is one


def test_results_and_titles_are_made_comparable_before_they_meet(spark):
    met = plan(printed.assign_results(spark, SMALL)).split("Join")[0]
    assert "regexp_replace" not in met


def test_queries_of_one_key_are_answered_once(spark):
    queries = spark.createDataFrame([(i, "gran azul") for i in range(30)], "query_id long, key string")
    known = spark.createDataFrame([(i, ["gran azul", "gran azur"][i % 2]) for i in range(40)], "id long, key string")
    got = fuzzy.fuzzy_candidates(queries, known)
    assert sorted((r.query_id, r.place, r.id) for r in got.collect()) == [(q, n + 1, 2 * n) for q in range(30) for n in range(5)]
    assert "windowspecdefinition(found" in plan(got)  # a key's ids are cut to the best before they meet the queries


def test_lines_of_a_book_are_matched_once(spark):
    df = printed.yearbook_lines(spark, SMALL)
    assert plan(df).count(r"\QUNIDO\E)$") == 2  # once for each of two branches that have one exchange
    assert "windowspecdefinition(doc_id" not in plan(df)  # no task has a whole book
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_films_go_on_over_blocks_of_lines(spark, monkeypatch):
    film = "05/03/98 Uno 1.234 5.000,10 € 6.000,20 € FRANCIA"
    text = {0: "of no film", 1: f"FIRST {film}", 2: "and", 3: "título fecha", 6: "more", 7: f"SECOND {film}", 8: "01/01/99", 17: "other", 30: f"THIRD {film}", 31: f"FOURTH {film}", 32: "last", 33: None}
    rows = [(d, i, t) for d in ("d", None) for i, t in text.items()]
    for block in (1, 2, 4, 4096):
        monkeypatch.setattr(ly, "BLOCK", block)
        got = ly.parse_yearbook_lines(spark.createDataFrame(rows, "doc_id string, line int, text string").repartition(5), 2007, ["FRANCIA"], "(?iu)título fecha").collect()
        assert sorted((r.title, r.distributor) for r in got if r.doc_id) == sorted((r.title, r.distributor) for r in got if not r.doc_id)
        assert sorted((r.title, r.distributor) for r in got if r.doc_id) == [("FIRST", "Uno and more"), ("FOURTH", "Uno last"), ("SECOND", "Uno other"), ("THIRD", "Uno")]


def test_words_of_a_document_do_not_meet_in_one_task(spark):
    dealt = plan(printed.annual_print(spark, SMALL)).split("RepartitionByExpression [doc_id")[0]  # what is done after films are dealt by page
    assert "strategy=broadcast" in dealt and "posexplode" in dealt


def test_repeated_films_have_places_of_their_own(spark):
    ranks = [9, 10, 1_000_010, 1_000_020, 2_000_010]
    places = [r.p for r in spark.createDataFrame([(r,) for r in ranks], "rank int").select(F.explode(printed.printed_places(F.col("rank"))).alias("p")).collect()]
    assert len(places) == len(set(places)) == 9


def test_ahead_needs_a_record_that_is_complete(spark):
    head = [(20, 10, "RANK"), (60, 10, "TITULO"), (200, 10, "DISTRIBUIDORA"), (300, 10, "FECHA")]
    film = [(20, 40, "1"), (60, 40, "Uno"), (200, 40, "Sur"), (300, 40, "01/02/2024"), (350, 40, "10"), (380, 40, "€"), (400, 40, "9")]
    bare = [(20, 52, "2"), (60, 52, "Dos"), (300, 52, "01/02/2024"), (60, 64, "beta"), (350, 64, "5"), (380, 64, "€"), (400, 64, "7"), (20, 76, "3"), (60, 76, "Tres")]
    words = [("d", 1, i, float(x), float(t), w) for i, (x, t, w) in enumerate([*head, *film, *bare])]
    got = ly.parse_annual(spark.createDataFrame(words, "doc_id string, page int, pos int, x0 double, top double, text string"))
    assert sorted((r["rank"], r.title) for r in got.collect()) == [(1, "Uno"), (2, "Dos beta"), (3, "Tres")]
