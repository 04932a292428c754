"""Quantiles between sketched values and percent positions, against plain code."""

import datetime
import random

import numpy as np
import pytest

from boxmetrics.operators import chart as ch
from boxmetrics.operators import tables as tb


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(12)
    out = {f"n{n}": [round(rng.lognormvariate(3, 2), 2) for _ in range(n)] for n in (1, 2, 5, 11, 150, 199, 200, 201, 900, 4999, 5000, 9000)}
    out["outlier"] = [float(i) for i in range(6000)] + [1e12]
    out["ties"] = [1.0] * 4000 + [2.0] * 4000 + [3.0]
    out["few"] = [float(rng.randrange(3)) for _ in range(700)]
    return out


def test_quantiles_are_exact(spark, groups):
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("n1", None), ("none", None)]
    got = {r.g: r for r in tb.percentile_tiers(spark.createDataFrame(rows, "g string, v double").repartition(5), "g", "v").collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        for p in (25, 50, 75, 90):
            q = np.quantile(vs, p / 100)
            above = [v for v in vs if v >= q]
            assert abs(got[g][f"p{p}"] - q) <= 0.006, (g, p)
            assert got[g][f"n{p}"] == len(above), (g, p)
            assert abs(got[g][f"mean{p}"] - np.mean(above)) <= 0.006 + 1e-9 * abs(np.mean(above))


def test_only_a_little_of_a_large_group_is_ordered(spark, groups):
    df = spark.createDataFrame([(v,) for v in groups["outlier"]], "v double")
    ends = df.selectExpr("percentile_approx(v, array(0.249, 0.251), 10000) AS e").first().e
    assert df.where(df.v.between(*ends)).count() <= 0.004 * 6001


def test_percent_positions(spark):
    rng = random.Random(4)
    totals = [0, 1, 5, 5, 1023, 1024, 1025, *(rng.randrange(1 << rng.randrange(1, 40)) for _ in range(200))]
    weeks = [(datetime.date(2020, 1, 6) + datetime.timedelta(weeks=i), t) for i, t in enumerate(totals)]
    got = {r.week: r for r in ch.capacity(spark.createDataFrame(weeks, "week date, spectators long")).collect()}
    assert len(got) == len(weeks)
    for week, t in weeks:
        share = 100 * sum(x <= t for x in totals) / len(totals)
        assert abs(got[week].percentile - share) <= 0.5 + 1e-6 and (got[week].least, got[week].most) == (min(totals), max(totals))
    plan = ch.capacity(spark.createDataFrame(weeks, "week date, spectators long"))._jdf.queryExecution().toString()
    assert all("windowspecdefinition(cell" in line for line in plan.splitlines() if "windowspecdefinition(" in line)
