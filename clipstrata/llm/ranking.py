"""One order of items from scores of different scales, by outranking net flow.

Per score, items are compared by their place, not by their value: R = 2 x (items that are strictly less) + (items that are
equal), twice the mid-rank, a whole number from 1 to 2n - 1. The preference of an item over another is a function of the
difference d of their places: 0 up to q, (d - q) / (p - q) up to p, then 1. An item's positive flow is the sum of its
preferences over all others, the negative flow the sum of theirs over it.

No pair is formed. With C(x) the number and S(x) the sum of the places up to x,

    sum over j of P(R_i - R_j) x (p - q) = (p - q) C(R_i - p) + (R_i - q) (C(R_i - q) - C(R_i - p)) - (S(R_i - q) - S(R_i - p))

so four look-ups in sorted prefix sums give both flows, exactly and in whole numbers. All scores go through the same steps
at once, as rows of (score, value). Places and sums come from a sort by range: each range counts by itself, and the totals
of the ranges (one row each) are added as offsets. Equal values are counted to one row before they are shuffled, so ties
cannot make a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.operators.ranges import running
from clipstrata.session import stored


@dataclass(frozen=True)
class Criterion:
    """A score. ``worse``: which end is bad, "high" or "low". ``weight``: share in the net flow, before normalising."""

    column: str
    worse: str = "high"
    weight: float = 1.0


#: Differences of places, as shares of all items: up to the first no preference, from the second on full preference.
INDIFFERENT, PREFERRED = 0.02, 0.25


def places(values: DataFrame) -> DataFrame:
    """(c, v, n, less, place) of each distinct value v of each score c."""
    counts = values.groupBy("c", "v").agg(F.count("*").alias("n"))
    ranked = running(counts, "v", {"upto": F.col("n")}, within=["c"])
    return ranked.select("c", "v", "n", (F.col("upto") - F.col("n")).alias("less"), (2 * F.col("upto") - F.col("n")).alias("place"))


def _flows(rank: DataFrame, n: int, q: int, p: int) -> DataFrame:
    """(c, v, less, ties, plus, minus): the flows of each distinct value, times (p - q)."""
    # each value asks for the prefix sums at four places; data and questions are sorted together, data first on a tie
    own = F.struct(F.lit(-1).alias("i"), F.col("place").alias("x"), F.col("n").alias("n"))
    ask = [F.struct(F.lit(i).alias("i"), x.alias("x"), F.lit(0).cast("long").alias("n")) for i, x in enumerate((F.col("place") - p, F.col("place") - q, F.col("place") + q, F.col("place") + p))]
    both = rank.select("c", F.col("place").alias("_me"), "v", "less", F.col("n").alias("ties"), F.explode(F.array(own, *ask)).alias("_a"))
    both = both.select("c", "_me", "v", "less", "ties", F.col("_a.i").alias("_i"), F.col("_a.x").alias("_x"), F.col("_a.n").alias("_n"))
    both = running(both, "_x", {"k": F.col("_n"), "s": F.col("_n") * F.col("_x")}, [F.col("_i"), F.col("_me")], within=["c"])
    at = lambda k, i: F.max(F.when(F.col("_i") == i, F.col(k))).alias(f"{k}{i}")
    got = both.groupBy("c", "_me").agg(F.max("v").alias("v"), F.max("less").alias("less"), F.max("ties").alias("ties"), *[at(k, i) for k in ("k", "s") for i in range(4)])
    r, d = F.col("_me"), F.lit(p - q)
    plus = d * F.col("k0") + (r - q) * (F.col("k1") - F.col("k0")) - (F.col("s1") - F.col("s0"))
    minus = d * (F.lit(n) - F.col("k3")) + (F.col("s3") - F.col("s2")) - (r + q) * (F.col("k3") - F.col("k2"))
    return got.select("c", "v", "less", "ties", (plus - minus).alias("flow"))


def _joined(values: DataFrame, flow: DataFrame, n: int, heavy: int = 1000) -> DataFrame:
    """Every (item, score) with the flow of its value. Values that more than one in ``heavy`` items have, of which there are
    fewer than ``heavy`` a score, are broadcast; the others are joined by a shuffle, in which no value is hot."""
    hot = F.broadcast(flow.filter(F.col("ties") * heavy > n).select("c", "v", F.struct("less", "flow").alias("_hot")))
    cold = flow.filter(F.col("ties") * heavy <= n).select("c", "v", "less", "flow")
    some = values.join(hot, ["c", "v"], "left")
    done = some.filter("_hot IS NOT NULL").select("_id", "_k", "c", "v", "_hot.less", "_hot.flow")
    return done.unionByName(some.filter("_hot IS NULL").drop("_hot").join(cold, ["c", "v"]))


def least_net(share: float, preferred: float = PREFERRED) -> float:
    """A bound that the net of an item can't be below if on every score it is strictly worse than ``share`` of all items.

    Items that it is preferred to without reserve count 1 each. An item that is worse but not by so much stands, with those
    equal to it, within ``preferred`` of the places on either side of the middle of its ties, so there are at most
    2 x ``preferred`` of all items of this kind. At most 1 - ``share`` are preferred to it.
    """
    return share - 2 * preferred - (1 - share)


def outranking(
    items: DataFrame, key: str, criteria: list[Criterion], *, indifferent: float = INDIFFERENT, preferred: float = PREFERRED
) -> DataFrame:
    """(key, net, place, and for each score its value, worse_than and net): all items that have every score, worst first.

    ``net`` is the weighted mean over the scores of (flow towards worse - flow towards better) / (n - 1), from -1 to 1;
    it grows with badness. ``place`` is 1 for the worst; equal nets are settled by the key. ``<score>_worse_than`` counts
    the items that are strictly better on it. Items with a null key or a score that is null, NaN or infinite are left
    out. A repeated item counts as several. Extra columns are ignored. An empty table gives an empty result.
    """
    ok = F.col(key).isNotNull()
    for c in criteria:
        x = F.col(c.column).cast("double")
        ok = ok & F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    value = [((F.col(c.column) if c.worse == "high" else -F.col(c.column)).cast("double") + F.lit(0.0)) for c in criteria]
    base = items.filter(ok).select(F.col(key).alias("_k"), *[v.alias(f"_v{i}") for i, v in enumerate(value)])
    base = stored(base.withColumn("_id", F.monotonically_increasing_id()), "items")
    n = base.count()
    q = int(2 * n * indifferent)
    p = max(q + 1, int(2 * n * preferred))
    scores = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_v{i}").alias("v")) for i in range(len(criteria))])
    values = base.select("_id", "_k", F.explode(scores).alias("_s")).select("_id", "_k", "_s.c", "_s.v")
    flow = stored(_flows(places(values), n, q, p), "flow")
    of = lambda i, x: F.max(F.when(F.col("c") == i, F.col(x)))
    own = []
    for i, c in enumerate(criteria):
        sign = F.lit(1.0 if c.worse == "high" else -1.0)
        own += [(of(i, "v") * sign).alias(c.column), of(i, "less").alias(f"{c.column}_worse_than"), (of(i, "flow") / F.lit(float(p - q) * max(n - 1, 1))).alias(f"{c.column}_net")]
    out = _joined(values, flow, n).groupBy("_id").agg(F.first("_k").alias("_k"), *own)
    whole = sum(c.weight for c in criteria)
    net = sum((F.lit(c.weight / whole) * F.col(f"{c.column}_net") for c in criteria), F.lit(0.0))
    rest = [x for c in criteria for x in (c.column, f"{c.column}_worse_than", f"{c.column}_net")]
    out = out.select(F.col("_k").alias(key), F.round(net, 12).alias("net"), F.lit(n).alias("compared"), *rest)
    ranked = running(out.withColumn("_down", -F.col("net")), "_down", {"place": F.lit(1).cast("long")}, [F.col(key)])
    return ranked.drop("_down")
