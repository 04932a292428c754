"""Queries that SQL can express against DuckDB, on the smallest tables."""

import duckdb
import pytest

from boxmetrics.llm import registry

from ..conftest import SMALL


@pytest.mark.parametrize("name", ["op11_repair_layers", "op12_block_max", "op13_quality_quantiles"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    rel = con.sql(registry.ORACLE[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr) and got
