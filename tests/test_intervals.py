import random

import pytest

from clipstrata.operators.intervals import periods_and_gaps, to_units
from pyspark.sql import functions as F

SCHEMA = "e string, t string, a long, b long, s1 long, runs string, _a string, what string"


def brute(rows):
    out, by = [], {}
    for e, t, a, b, *_ in rows:
        if e is not None and t is not None and a is not None and b is not None and a != b:
            by.setdefault((e, t), []).append((min(a, b), max(a, b)))
    for k, iv in by.items():
        merged = []
        for a, b in sorted(iv):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(*k, "period", a, b) for a, b in merged]
        out += [(*k, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])]
    return sorted(out)


def run(spark, rows, shard):
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, periods_and_gaps(df, ["e", "t"], "a", "b", shard=shard).collect()))


@pytest.mark.parametrize("shard", [4, 16, 1 << 16])
def test_equals_brute_force(spark, shard):
    rnd = random.Random(shard)
    rows = []
    for _ in range(600):
        a = rnd.randint(-120, 120)
        rows.append((rnd.choice(["x", "y", None, "hot", "hot", "hot"]), rnd.choice(["bin", "depth"]), rnd.choice([a, a, a, None]), a + rnd.choice([0, 1, 2, 3, 5, 8, -4, 40])))
    rows += rows[:100]
    assert run(spark, rows, shard) == brute(rows)


def test_touching_shards_and_long_intervals(spark):
    rows = [("x", "t", 0, 4), ("x", "t", 4, 8), ("x", "t", 9, 10**15), ("x", "t", 10**15 + 3, 10**15 + 4), ("y", "t", -7, -5), ("y", "t", 3, -1)]
    assert run(spark, rows, 4) == brute(rows)


def test_empty(spark):
    assert run(spark, [], 16) == []
    assert run(spark, [("x", "t", None, 3), ("x", "t", 5, 5), (None, "t", 1, 2)], 16) == []


def test_units(spark):
    df = spark.createDataFrame([(0.4996,), (0.0005,), (-0.0004,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(to_units(F.col("x"))).collect()] == [500, 1, 0, None, None, None]
