"""Versions of a table with readers and failing writers, merges that leave parts alone, ingest with little to read."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from boxmetrics.sources.files import VersionedTable
from boxmetrics.streaming import ingest


def rows(spark, values, schema="k long, v string"):
    return spark.createDataFrame(values, schema)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_merge_writes_only_the_parts_it_touches(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], parts=8)
    t.replace(rows(spark, [(i, "old") for i in range(100)] + [(None, "none")]))
    before = files_of(tmp_path / "t" / "data")
    updates = rows(spark, [(3, "new"), (3, "newer"), (None, "some")])
    touched = t.touched(updates)
    assert 1 <= len(touched) <= 2
    assert t.upsert(updates) == 2
    after = files_of(tmp_path / "t" / "data")
    assert before.items() <= after.items() and {int(f.split("part=")[1].split("/")[0]) for f in after.keys() - before.keys()} <= set(touched)
    got = content(t.read())
    assert len(got) == 101 + (0 if (None, "none") not in got else 1) and (3, "newer") in got and (3, "old") not in got and (4, "old") in got
    assert content(t.read(version=1)) == sorted([(i, "old") for i in range(100)] + [(None, "none")], key=repr)


def test_a_reader_sees_the_old_version_of_a_failed_refresh(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], parts=4)
    source = rows(spark, [(i, "a") for i in range(20)])
    counted = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    t.replace(counted(source))
    more = source.union(rows(spark, [(5, "b"), (50, "c")]))
    broken = lambda df: counted(df).withColumn("n", F.when(F.col("k") == 5, F.raise_error("broken").cast("long")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        t.refresh(more, broken, rows(spark, [(5, ""), (50, "")]))
    assert t.version() == 1 and dict(content(t.read())) == {i: 1 for i in range(20)}
    t.refresh(more, counted, rows(spark, [(5, ""), (50, "")]))
    assert t.version() == 2 and dict(content(t.read())) == {i: 2 if i == 5 else 1 for i in [*range(20), 50]}
    gone = source.where("k <> 7")
    t.refresh(gone.union(rows(spark, [(50, "c")])), counted, rows(spark, [(5, ""), (7, "")]))
    assert 7 not in dict(content(t.read())) and dict(content(t.read()))[5] == 1


def test_empty_tables_and_unknown_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], parts=4)
    assert t.version() == 0
    with pytest.raises(LookupError):
        t.read()
    t.replace(rows(spark, []))
    assert content(t.read()) == [] and t.read().columns == ["k", "v"]
    t.upsert(rows(spark, []))
    assert content(t.read()) == []
    t.upsert(rows(spark, [(1, "x")]))
    assert content(t.read()) == [(1, "x")]


SCHEMA = StructType([StructField("day", LongType()), StructField("kind", StringType()), StructField("v", LongType())])


def feed(folder, number, records):
    folder.mkdir(exist_ok=True)
    (folder / f"{number:03}.json").write_text("".join(json.dumps(dict(zip(("day", "kind", "v"), r, strict=True))) + "\n" for r in records))


def test_empty_files_first_and_null_keys(spark, tmp_path):
    folder, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for number, records in enumerate([[], [(1, "a", 1), (None, "a", 2)], [], [(None, "a", 3), (1, "a", 4), (1, None, 5)], [(None, None, 6)], [(None, None, 7), (1, None, 8), (2, "b", 9)]]):
        feed(folder, number, records)
        ingest.ingest_available(spark, str(folder), SCHEMA, target, state, ["day", "kind"])
    assert sorted(r.v for r in spark.read.schema(SCHEMA).parquet(target).collect()) == [1, 2, 5, 6, 9]


def test_bytes_read_do_not_grow_with_history(spark, tmp_path, monkeypatch):
    folder, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    sizes, read = [], type(spark.read).parquet

    def counted(self, *paths, **kw):
        keys = [p for p in paths if "-keys/batch=" in p]
        sizes[-1] += sum(os.path.getsize(os.path.join(p, f)) for p in keys for f in os.listdir(p) if f.endswith(".parquet"))
        return read(self, *paths, **kw)

    monkeypatch.setattr(type(spark.read), "parquet", counted)
    for number in range(50):  # each day comes once more the day after
        feed(folder, number, [(day, f"k{i}", number) for day in (number - 1, number) for i in range(20)])
        sizes.append(0)
        ingest.ingest_available(spark, str(folder), SCHEMA, target, state, ["day", "kind"])
    assert sizes[0] == 0 and 0 < max(sizes[40:]) <= 1.5 * max(sizes[2:10])
    assert spark.read.schema(SCHEMA).parquet(target).count() == 51 * 20
