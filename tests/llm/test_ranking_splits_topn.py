import math
import random

import pytest

from clipstrata.llm import splits
from clipstrata.llm.ranking import Criterion, least_net, outranking
from clipstrata.llm.splits import assign, components, sample_key
from clipstrata.llm.topn import top_n
from pyspark.sql import functions as F


def brute_flow(values, q, p):
    """By all pairs: (plus, minus) of each item over mid-ranks."""
    place = [2 * sum(w < v for w in values) + sum(w == v for w in values) for v in values]
    pref = lambda d: 0 if d <= q else 1 if d >= p else (d - q) / (p - q)
    return [(sum(pref(a - b) for b in place), sum(pref(b - a) for b in place)) for a in place]


@pytest.mark.parametrize(("n", "q", "p"), [(1, 0.02, 0.25), (2, 0.02, 0.25), (61, 0.02, 0.25), (61, 0.0, 0.0), (61, 0.2, 0.9)])
def test_flows_equal_all_pairs(spark, n, q, p):
    rnd = random.Random(n)
    rows = [(f"c{i}", rnd.choice([0.0, -0.0, 0.1, rnd.random()]), float(rnd.randint(0, 3)) * 10**6, rnd.randint(1, 5), "x", 1) for i in range(n)]
    dirty = [("bad1", None, 1.0, 3, "x", 1), ("bad2", float("nan"), 1.0, 3, "x", 1), ("bad3", 1.0, float("inf"), 3, "x", 1), (None, 1.0, 1.0, 3, "x", 1), ("bad4", 1.0, 1.0, None, "x", 1)]
    df = spark.createDataFrame(rows + dirty, "clip string, a double, b double, c int, net string, place int")
    got = {r.clip: r for r in outranking(df, "clip", [Criterion("a"), Criterion("b", weight=2.0), Criterion("c", worse="low")], indifferent=q, preferred=p).collect()}
    assert set(got) == {r[0] for r in rows}
    qq = int(2 * n * q)
    pp = max(qq + 1, int(2 * n * p))
    net = [0.0] * n
    for k, (w, sign) in enumerate(((1, 1), (2, 1), (1, -1)), 1):
        v = [sign * r[k] for r in rows]
        for i, (plus, minus) in enumerate(brute_flow(v, qq, pp)):
            net[i] += w / 4 * (plus - minus) / max(n - 1, 1)
            assert got[rows[i][0]]["abc"[k - 1] + "_worse_than"] == sum(x < v[i] for x in v)
    for i, r in enumerate(rows):
        assert math.isclose(got[r[0]].net, net[i], abs_tol=1e-9)
    order = sorted(got.values(), key=lambda r: (-r.net, r.clip))
    assert [r.place for r in order] == list(range(1, n + 1))
    if n > 1 and p > q:
        assert abs(sum(r.net for r in order)) < 1e-9


def test_bound_on_the_net_of_the_worst(spark):
    """Whatever the ties, an item that is worse than a share of all on every score has at least this net."""
    rnd = random.Random(3)
    for _ in range(6):
        kinds = rnd.choice([2, 5, 30, 1000])
        rows = [(f"c{i:03d}", float(rnd.randint(0, kinds)), float(rnd.randint(0, kinds))) for i in range(90)] + [(f"d{i}", kinds + rnd.random(), kinds + rnd.random()) for i in range(9)]
        got = outranking(spark.createDataFrame(rows, "clip string, a double, b double"), "clip", [Criterion("a"), Criterion("b")]).collect()
        worst = [r for r in got if 10 * min(r.a_worse_than, r.b_worse_than) >= 9 * r.compared]
        assert worst and all(r.net >= least_net(0.9) for r in worst)


def test_no_items(spark):
    assert outranking(spark.createDataFrame([], "clip string, a double"), "clip", [Criterion("a")]).count() == 0


def roots(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is None and b is None:
            continue
        a, b = a or b, b or a
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


@pytest.mark.parametrize(("n", "ties", "limit"), [(40, 25, 10**6), (300, 280, 10**6), (300, 280, 20), (120, 119, 5)])
def test_components(spark, n, ties, limit):
    rnd = random.Random(n + ties + limit)
    edges = [(f"n{rnd.randrange(n):03d}", f"n{rnd.randrange(n):03d}") for _ in range(ties)]
    if ties == n - 1:
        edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(ties)]  # one long chain
        rnd.shuffle(edges)
    edges += [(None, None), ("alone", None), (None, "n000"), ("n001", "n001")] + edges[:9]
    df = spark.createDataFrame([(*e, "x") for e in edges], "a string, b string, node string").repartition(5)
    got = [tuple(r) for r in components(df, "a", "b", task_edges=limit).collect()]
    assert len(got) == len(dict(got)) and dict(got) == roots(edges)


def test_forest_in_pieces():
    import pyarrow as pa

    edges = [(f"a{i}", f"a{i // 2}") for i in range(50)]
    b = pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges]), pa.array([y for _, y in edges])], names=["node", "root"])
    out = [(x, y) for r in splits._forest(iter([b.slice(0, 20), b.slice(20)]), most=10) for x, y in zip(r.column(0).to_pylist(), r.column(1).to_pylist())]
    assert len(set(roots(out).values())) == 1


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


@pytest.mark.parametrize("sizes", [[90, 5, 5], [1] * 57, [0, 0, 3], [50, 20, 20, 3, 3, 3, 1, 1, 1, 1, 1, 1], []])
def test_greedy_split(spark, sizes):
    shares = {"train": 0.7, "validation": 0.2, "test": 0.1}
    df = spark.createDataFrame([(f"g{i:02d}", s, "x") for i, s in enumerate(sizes)] + [(None, 4, "x")], "g string, s long, split string")
    got = {r.g: r.split for r in assign(df, "g", "s", shares).collect()}
    assert set(got) == {f"g{i:02d}" for i in range(len(sizes))}
    total, have = sum(sizes), dict.fromkeys(shares, 0)
    for s in sorted(sizes, reverse=True):  # one at a time
        best = max(shares, key=lambda k: (shares[k] * total - have[k], -list(shares).index(k)))
        have[best] += s
    real = dict.fromkeys(shares, 0)
    for i, s in enumerate(sizes):
        real[got[f"g{i:02d}"]] += s
    assert real == have


def test_sample_ids(spark):
    df = spark.createDataFrame([("ABW_001\t",), (" abw-001",), ("abw 001",), ("",), (" ",), ("N/A",), ("unknown",), (None,), ("-",), ("abw_002",)], "s string")
    assert [r[0] for r in df.select(sample_key(F.col("s"))).collect()] == ["abw_001"] * 3 + [None] * 6 + ["abw_002"]


@pytest.mark.parametrize(("n", "size"), [(3, 60), (1, 16), (0, 16), (50, None), (50, 7)])
def test_top_n(spark, n, size):
    rnd = random.Random(n)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", "c", None]), f"c{i}", rnd.choice([0.5, rnd.random(), None, float("nan"), float("inf")]), rnd.choice([None, 1.0, 2.0]), 7) for i in range(4000)]
    df = spark.createDataFrame(rows + rows[:3], "scene string, clip string, f double, j double, rank int").repartition(8)
    tie = F.coalesce(-F.col("j"), F.lit(float("inf")))
    got = sorted((r.scene, r.clip, r.rank) for r in top_n(df, "scene", "f", n, [tie, F.col("clip")], ["clip"], rows=size).collect())
    want, by = [], {}
    for s, c, f, j, _ in rows + rows[:3]:
        if s is not None and f is not None and not math.isnan(f):
            by.setdefault(s, []).append((-f, -j if j is not None else math.inf, c))
    for s, v in by.items():
        want += [(s, c, i) for i, (_, _, c) in enumerate(sorted(v)[:n], 1)]
    assert got == sorted(want)


def test_top_n_skips(spark, monkeypatch):
    """Row groups below every contained group's N-th score aren't read; those that tie with it are."""
    from clipstrata.llm import topn

    df = spark.range(60000).select(F.lit("hot").alias("g"), F.rand(1).alias("s"), F.col("id").cast("string").alias("c"))
    df = df.unionByName(spark.createDataFrame([(f"g{i:03d}", float(k), f"{i}.{k}") for i in range(300) for k in range(4)], "g string, s double, c string"))
    args = (df, "g", "s", 5, [F.col("c")], ["c"])
    asked = []

    def seen(df, name, real=topn.stored):
        if name == "wave":
            asked.append(1)
        return real(df, name)

    monkeypatch.setattr(topn, "stored", seen)
    n = {r.wave: (r.row_groups, r.n_rows) for r in topn.reads(*args, rows=500).collect()}
    assert asked and n["skipped"][0] > 100 and n["first"][0] + n.get("second", (0, 0))[0] < 12
    assert sum(x for _, x in n.values()) == 60000 + 1200
    got = top_n(*args, rows=500).filter("g = 'hot'").collect()
    want = [r.c for r in df.filter("g = 'hot'").orderBy(F.col("s").desc(), "c").limit(5).collect()]
    assert [r.c for r in sorted(got, key=lambda r: r.rank)] == want
    tied = spark.range(4000).select(F.lit("hot").alias("g"), F.lit(1.0).alias("s"), F.col("id").cast("string").alias("c"))
    assert not topn.reads(tied, "g", "s", 3, [F.col("c")], ["c"], rows=100).filter("wave = 'skipped'").count()


def test_no_rows(spark):
    assert top_n(spark.createDataFrame([], "g string, s double"), "g", "s", 3, [F.col("g")], ["s"]).count() == 0
