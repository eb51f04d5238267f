import random

import numpy as np
import pytest

from clipstrata.operators import audit, ranges
from clipstrata.plans import windows
from pyspark.sql import functions as F


@pytest.mark.parametrize("keys", [["g"], []])
def test_quantiles_equal_numpy(spark, keys):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 5 + ["a", "b"]), rnd.choice([rnd.random(), 0.5, None, float("nan")]), 1) for _ in range(900)] + [("one", 2.0, 1), ("none", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, _n int").repartition(6)
    got = ranges.quantiles(df, keys, F.col("v"), {"lo": 0.01, "mid": 0.5, "hi": 0.9}).collect()
    by = {}
    for g, v, _ in rows:
        if v is not None and v == v:
            by.setdefault(g if keys else None, []).append(v)
    assert len(got) == len(by)
    for r in got:
        assert np.allclose([r.lo, r.mid, r.hi], np.quantile(by[r.g if keys else None], [0.01, 0.5, 0.9]))
    assert ranges.quantiles(df.limit(0), keys, F.col("v"), {"mid": 0.5}).count() == 0


def test_running_and_numbered(spark):
    df = spark.createDataFrame([(g, i) for g in "ab" for i in range(50)], "g string, i int").repartition(5)
    got = {(r.g, r.i): r.s for r in ranges.running(df, "i", {"s": F.col("i")}, within=["g"]).collect()}
    assert got == {(g, i): i * (i + 1) // 2 for g in "ab" for i in range(50)}
    assert [r.n for r in ranges.numbered(df.filter("g = 'a'").drop("g"), "i", "n").orderBy("i").collect()] == list(range(50))


def test_bins_by_blocks(spark):
    grid = spark.createDataFrame([("c", 0, 0, 24), ("c", 1, 24, 90), ("c", 2, 90, 90), ("d", 0, 3, 5)], "clip string, bin int, first_frame long, stop_frame long")
    frames = spark.createDataFrame([(c, o, "x") for c in "cde" for o in (-1, 0, 3, 4, 23, 24, 50, 89, 90)], "clip string, ordinal long, _b string")
    got = sorted((r.clip, r.ordinal, r.bin) for r in windows.to_bins(frames, grid, "clip", "ordinal").collect())
    assert got == [("c", 0, 0), ("c", 3, 0), ("c", 4, 0), ("c", 23, 0), ("c", 24, 1), ("c", 50, 1), ("c", 89, 1), ("d", 3, 0), ("d", 4, 0)]


def test_no_percentile_over_a_whole_group(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    plan = audit.range_guard(df, ["g"], "v", 0.5, 2.0)._jdf.queryExecution().toString()
    assert "percentile" not in plan.lower()
