import datetime
import decimal

import duckdb
import pytest

from boxmetrics.plans import catalogue, printed, records, reports  # noqa: F401

from .conftest import MEDIUM

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{MEDIUM}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, MEDIUM)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rel = con.sql(catalogue.ORACLE[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(rel.columns) == columns
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want and got
