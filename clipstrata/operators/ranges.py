"""Totals and numbers over a whole table in an order, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.session import stored


def running(df: DataFrame, by: list[str] | str, sums: dict[str, Column], first: list[Column] | None = None, within: list[str] | None = None) -> DataFrame:
    """Adds running totals in the order of ``by``, the row itself included; of each group of ``within`` if given.

    The table is sorted by range and stored; every range is totalled by one task, and the totals of the ranges before it,
    one row for each range (and group in it), are added. Rows with equal ``by`` must not exist or come in the order of
    ``first``. Ranges cut through groups, so a group may be of any size.
    """
    within = within or []
    order = [*[F.col(c) for c in within], *[F.col(c) for c in ([by] if isinstance(by, str) else by)], *(first or [])]
    ranged = stored(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_p", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = ranged.groupBy("_p", *within).agg(*[F.sum(x).alias(f"_t_{n}") for n, x in sums.items()])
    ahead = Window.partitionBy(*within).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    offset = total.select("_p", *within, *[F.coalesce(F.sum(f"_t_{n}").over(ahead), F.lit(0)).cast("long").alias(f"_o_{n}") for n in sums])
    summed = ranged.select("*", *[F.sum(x).over(own).alias(f"_r_{n}") for n, x in sums.items()])
    summed = summed.join(offset, ["_p", *within])
    return summed.select(*df.columns, *[(F.col(f"_r_{n}") + F.col(f"_o_{n}")).cast("long").alias(n) for n in sums])


def numbered(df: DataFrame, by: str, out: str = "i") -> DataFrame:
    """Adds a number from 0 in the order of ``by``, whose values must be distinct for the number to be the same each time."""
    one = running(df, by, {"_nth": F.lit(1).cast("long")})
    return one.select(*df.columns, (F.col("_nth") - 1).alias(out))


def _band(v: Column) -> Column:
    """A whole number that never falls as the value rises: 512 bands for each doubling, on either side of 0."""
    far = lambda x: (F.least(F.greatest(F.floor(F.log2(x) * 512), F.lit(-600_000)), F.lit(600_000)) + 600_001).cast("int")
    return F.when(v > 0, far(v)).when(v < 0, -far(-v)).otherwise(0)


def quantiles(df: DataFrame, keys: list[str], value: Column, at: dict[str, float]) -> DataFrame:
    """(*keys, names of ``at``): exact quantiles of each group's values, with a straight line between the two nearest.

    Values that are null or NaN are left out; a group without any, or no group at all, gives no row. A first pass counts by
    bands, which shows in which bands the quantiles lie. Only values of those bands go on, counted by value before they move
    and totalled by ranges that cut through groups and bands: a group that holds all rows is no hot task, whatever its values.
    """
    key = keys or ["_all"]
    base = (df if keys else df.withColumn("_all", F.lit(0))).select(*key, value.cast("double").alias("_v"))
    base = base.filter(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_b", _band(F.col("_v")))
    bands = stored(base.groupBy(*key, "_b").agg(F.count("*").alias("_n")), "bands")
    w = Window.partitionBy(*key).orderBy("_b")  # as many rows as bands
    bands = bands.withColumns({"_u": F.sum("_n").over(w), "_t": F.sum("_n").over(Window.partitionBy(*key))})
    place = lambda q: (F.col("_t") - 1) * F.lit(q)
    ranks = [r for q in at.values() for r in (F.floor(place(q)) + 1, F.ceil(place(q)) + 1)]
    asked = F.lit(False)
    for r in ranks:
        asked = asked | ((F.col("_u") - F.col("_n") < r) & (r <= F.col("_u")))
    there = bands.filter(asked).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_b").alias("_kb"), (F.col("_u") - F.col("_n")).alias("_o"), "_t")
    few = there.limit(100_001).count() <= 100_000  # some 40 bytes a row
    if not few:  # many groups: their values are counted first, so that none is a hot key of the join
        base = base.groupBy(*key, "_b", "_v").agg(F.count("*").alias("_n"))
    same = F.expr(" AND ".join([*[f"`{k}` <=> _k{i}" for i, k in enumerate(key)], "_b = _kb"]))
    x = base.join(F.broadcast(there) if few else there, same)
    counts = x.groupBy(*key, "_b", "_v", "_o", "_t").agg((F.count("*") if few else F.sum("_n")).alias("_n"))
    upto = running(counts, "_v", {"_u": F.col("_n")}, within=[*key, "_b"]).withColumn("_u", F.col("_u") + F.col("_o"))
    low = lambda q: F.min(F.when(F.col("_u") >= F.floor(place(q)) + 1, F.col("_v")))
    high = lambda q: F.min(F.when(F.col("_u") >= F.ceil(place(q)) + 1, F.col("_v")))
    part = lambda q: F.max(place(q) - F.floor(place(q)))
    out = upto.groupBy(*key).agg(*[F.when(low(q) == high(q), low(q)).otherwise(low(q) + (high(q) - low(q)) * part(q)).alias(n) for n, q in at.items()])
    return out.select(*keys, *at)
