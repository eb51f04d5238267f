"""Train, validation and test splits that keep related records together.

Ties between records form components. They are found by distributed union-find: every task builds the forest of its own
edges and passes on only (node, root) edges, fewer than the nodes it saw. Forests are merged hierarchically: from level
to level the edges meet in fewer, larger tasks. A level is entered only while its tasks stay below ``TASK_EDGES``. Where the
edges are too many for that, only those that tie trees of different tasks go on, as a smaller set of edges between roots,
through the same levels; the other nodes then look up their root. So no task ever holds all nodes, at any size, and every
tie is made by a local forest. Components go to splits largest first, each to the split furthest below its target.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstrata.operators.ranges import running
from clipstrata.session import cut, looked_up

#: Edges that one task's forest may hold (some 200 bytes each).
TASK_EDGES = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch], most: int = 2 * TASK_EDGES) -> Iterator[pa.RecordBatch]:
    """(node, root) edges of the forest over the task's edges; a root is the least node of its tree."""
    up: dict[str, str] = {}

    def root(x: str) -> str:
        top = x
        while (y := up.setdefault(top, top)) != top:
            top = y
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def flat() -> Iterator[pa.RecordBatch]:
        nodes = list(up)
        for i in range(0, len(nodes), 50_000):
            part = nodes[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([root(x) for x in part], pa.string())], names=["node", "root"])

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if len(up) > most:  # the forest so far goes out; a later level joins it with the rest
            yield from flat()
            up.clear()
    yield from flat()


def components(edges: DataFrame, a: str, b: str, *, task_edges: int = TASK_EDGES, fan: int = 8) -> DataFrame:
    """(node, root): each node that an edge names, and the least node it is tied to, directly or by a chain.

    Nodes are strings. Edges with a null end tie nothing, and their other end counts as a node. Loops and repeated edges
    change nothing. An empty table gives an empty result.
    """
    spark = edges.sparkSession
    x, y = F.coalesce(F.col(a), F.col(b)).cast("string"), F.coalesce(F.col(b), F.col(a)).cast("string")
    links = edges.select(x.alias("node"), y.alias("root")).filter("node IS NOT NULL")
    schema = "node string, root string"
    grow = partial(_forest, most=2 * task_edges)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    forest = cut(links.mapInArrow(grow, schema))
    n = forest.count()
    while tasks > 1:
        fewer = max(1, tasks // fan)
        if n > task_edges * fewer:
            break
        # trees of different tasks meet where they share a node
        forest = cut(forest.repartition(fewer, "node").mapInArrow(grow, schema))
        n, tasks = forest.count(), fewer
    if tasks == 1:
        if n and forest.rdd.getNumPartitions() > 1:
            forest = cut(forest.repartition(1).mapInArrow(grow, schema))
        return forest
    return _level(forest, task_edges, fan)


def _level(forest: DataFrame, task_edges: int, fan: int) -> DataFrame:
    """One more level where all edges are too many for fewer tasks: the edges that tie trees to each other are merged by
    themselves.

    Nodes with one root tie nothing to anything and rest. The others tie their roots: (root, least root) edges, which go
    through the same merging by levels, are far fewer, as a forest has an edge for each node but ties only for nodes that
    several tasks saw. The answer is joined back to the resting edges on the root; a root that many nodes have is salted on
    the side of the nodes, while its one row is repeated for each salt.
    """
    least = cut(forest.groupBy("node").agg(F.min("root").alias("least"), F.max("root").alias("most")))
    several = least.filter("least <> most").select("node", "least")
    ties = forest.join(several, "node").filter(F.col("root") != F.col("least")).select("root", F.col("least").alias("other")).distinct()
    tops = components(ties, "root", "other", task_edges=task_edges, fan=fan).select(F.col("node").alias("least"), F.col("root").alias("top"))
    return looked_up(least.select("node", "least"), tops, "least", "node", "left").select("node", F.coalesce("top", "least").alias("root"))


def assign(groups: DataFrame, group: str, size: str, shares: dict[str, float]) -> DataFrame:
    """(group, size, split): largest first (ties by name), each to the split furthest below its target.

    Groups are first counted by size. A size held by many groups, as most small ones are, is dealt out as a whole: the
    greedy rule depends only on the sizes, so what each split gets of a size is computed from the counts, and groups of
    the size take their splits in the order of their names. Groups with a null name are left out; a null size is 0.
    """
    if abs(sum(shares.values()) - 1) > 1e-9 or min(shares.values()) < 0:
        raise ValueError("shares must not be negative and must add up to 1")
    g = groups.filter(F.col(group).isNotNull()).select(F.col(group).alias("_g"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_s"))
    counts = g.groupBy("_s").agg(F.count("*").alias("_n"))
    names = list(shares)

    def deal(key, pdf):
        """From the counts by size, (size, split, first, last): which groups of a size, in order, go to which split."""
        import pandas as pd

        pdf = pdf.sort_values("_s", ascending=False)
        total = float((pdf["_s"] * pdf["_n"]).sum()) or 1.0
        got, out = [0.0] * len(names), []
        want = [shares[k] * total for k in names]
        for s, n in zip(pdf["_s"].tolist(), pdf["_n"].tolist()):
            room = [w - x for w, x in zip(want, got)]
            # one at a time to the largest room lowers the rooms to a common level: the most that stays above it is dealt
            # at once, what is left (fewer than two a split) one by one
            lo, hi = min(room) - float(s) * (n + 1), max(room)
            for _ in range(100 if s else 0):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if sum(max(0, int((r - mid) // s)) for r in room) > n else (lo, mid)
            took = [max(0, int((r - hi) // s)) if s else 0 for r in room]
            left = n - sum(took)
            while left:
                best = max(range(len(names)), key=lambda i: (room[i] - float(s) * took[i], -i))
                step = 1 if s else left
                took[best], left = took[best] + step, left - step
            got = [x + float(s) * t for x, t in zip(got, took)]
            at = 0
            for i, t in enumerate(took):
                if t:
                    out.append((s, names[i], at + 1, at + t))
                at += t
        return pd.DataFrame(out, columns=["_s", "split", "first", "last"])

    # one row for each distinct size: at most the square root of twice the number of records
    plan = counts.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(deal, "_s long, split string, first long, last long")
    placed = running(g, "_g", {"_i": F.lit(1).cast("long")}, within=["_s"])
    plan = cut(plan)
    if plan.count() <= 100_000:  # some 60 bytes a row
        plan = F.broadcast(plan)
    return placed.join(plan, "_s").filter(F.col("_i").between(F.col("first"), F.col("last"))).select(F.col("_g").alias(group), F.col("_s").alias(size), "split")


def sample_key(sample: Column) -> Column:
    """A sample id in one spelling: lower case, no outer blanks, one separator; null for ids that stand for none."""
    bare = F.regexp_replace(F.lower(sample), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    one = F.regexp_replace(bare, r"[\s\p{Z}_\-./:]+", "_")
    return F.when(~bare.isin("", "-", "--", "?", ".", "n/a", "na", "null", "none", "nil", "unknown", "undefined", "missing", "nan", "tbd", "_", "#n/a"), one)
