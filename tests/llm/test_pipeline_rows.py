"""Stages on rows that share a doc_id or have none."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from ..conftest import SMALL
from .cases import AWKWARD, docs

NULLS = [(None, f"a text number {i} that has no id but words of its own {i * i}") for i in range(5)]


def test_near_dedup_keeps_rows_without_an_id_and_other_texts_of_one_id(spark):
    # text "b" has the smaller id elsewhere; the group of "c" must not lose its only row to the repeated id
    rows = [*NULLS, NULLS[0], (1, "b one two three four"), (3, "b one two three four"), (3, "c five six seven eight nine"), (3, "d ten eleven twelve"), (3, "d ten eleven twelve"), (None, "d ten eleven twelve")]
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs(spark, rows), "").collect()), key=repr)
    want = [*NULLS, (1, "b one two three four"), (3, "c five six seven eight nine"), (3, "d ten eleven twelve")]
    assert got == sorted(want, key=repr)


def test_mix_uses_each_row_as_often_as_its_own_place_says(spark):
    rows = [*NULLS, (7, "first text of an id"), (7, "second text of the same id"), (7, "first text of an id"), (8, "alone")]
    got = corpus_pipeline.mix_sources(spark, docs(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(rows, key=repr)
    assert all(r.tokens == len(r.text.split()) for r in got)
    assert [c for c in got[0].asDict() if c.startswith("__")] == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_awkward_rows_empty_tables_and_clashing_names(spark, name, stage):
    """Each stage stands nulls, long texts and repeated rows, keeps what is clean and all columns, and gives none for none."""
    frame = docs(spark, [*AWKWARD, (None, None), (70, "+1 (377) 555-0271")])
    for c in ("__row", "epoch", "block", "within", "tokens", "base", "extra", "spans", "row", "node", "n", "key"):
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit("own"))
    out = stage(spark, frame, SMALL)
    rows = out.collect()
    assert set(frame.columns) <= set(out.columns) and all(r["__row"] == r["epoch"] == r["key"] == "own" or r["key"] == "x" for r in rows)
    texts = sorted(str(r.text) for r in rows)
    every = sorted(str(r.text) for r in frame.collect())
    if name == "near_dedup":
        words = {" ".join((r.text or "").lower().split()) for r in frame.collect()}
        assert len(texts) == len(words)
    elif name == "pii":
        assert len(texts) == len(every) and "<phone>" in texts and texts.count("None") == 2
    else:
        assert texts == every
    assert stage(spark, frame.limit(0), SMALL).count() == 0
