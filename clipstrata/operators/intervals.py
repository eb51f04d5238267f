"""Periods and gaps of overlapping intervals, from compressed run bitmaps.

Time is cut into whole units and the units into shards of ``SHARD`` units. Within an entity and a shard, the covered
units form a run bitmap: the sorted list of its runs of set units, at most ``SHARD`` / 2 of them however many intervals
went in. The steps, all in the JVM:

1. An interval gives one run to the shard it starts in and one to the shard it stops in. What lies between is whole
   shards, kept as one run of shards, so a long interval costs no more rows than a short one.
2. Runs of one shard with equal start are combined before the shuffle to the longest. At most ``SHARD`` rows for an
   entity and shard are left, so an entity that holds a third of all rows is spread by shard and start and then small.
3. Each of the remaining runs is a bitmap of one run. Those of a shard are united in the order of their starts, in one pass,
   to the shard's bitmap: its runs of set units, none of which touch.
4. Set and clear runs that lie within a shard are periods and gaps as they are and go out from there. Of each shard only the
   edges (where its first and last set runs start and stop) are put in order by entity, with the runs of whole shards: one
   short row a shard, however many runs it has. That window carries over what reaches a shard's edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.session import stored

#: Units in a shard. With milliseconds a shard is about 65 seconds.
SHARD = 1 << 16


def to_units(x: Column, per_unit: float = 1000.0) -> Column:
    """Whole units by rounding (half up); null for null, NaN and infinite times."""
    ok = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(ok, F.floor(x * F.lit(per_unit) + F.lit(0.5)).cast("long"))


def _united(piece: DataFrame, names: list[str]) -> DataFrame:
    """(entity, s, f, runs): overlapping and touching runs of a shard as one, in linear time and with what Spark can spill.
    ``f``: runs of whole shards, which are united by themselves."""
    order = Window.partitionBy(*names, "s", "f").orderBy("a")
    seen = piece.withColumn("_r", F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    seen = seen.withColumn("_n", F.sum(F.when(F.col("_r") >= F.col("a"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = seen.groupBy(*names, "s", "f", "_n").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return run.groupBy(*names, "s", "f").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs"))


def run_bitmaps(df: DataFrame, entity: list[str], start: str, stop: str, *, shard: int = SHARD) -> DataFrame:
    """(entity, s, f, runs): for each shard that is set in part its runs of set units; where ``f`` is true, the one run of
    shards from ``s`` on that are set as a whole. Those may overlap each other and cover shards that are set in part."""
    keys = [F.col(c).alias(f"_e{i}") for i, c in enumerate(entity)]
    names = [f"_e{i}" for i in range(len(entity))]
    timed = df.filter(F.col(start).isNotNull() & F.col(stop).isNotNull() & (F.col(start) != F.col(stop)))
    iv = timed.select(*keys, F.least(start, stop).alias("_a"), F.greatest(start, stop).alias("_b")).dropna(subset=names)
    n = F.lit(shard).cast("long")
    first = F.expr(f"(_a - pmod(_a, {shard})) div {shard}")
    last = F.expr(f"(_b - 1 - pmod(_b - 1, {shard})) div {shard}")
    iv = iv.withColumn("_s", first).withColumn("_l", last)
    edge = lambda s, a, b: F.struct(s.alias("s"), (s + 1).alias("e"), a.alias("a"), b.alias("b"))
    s, l, a, b = (F.col(c) for c in ("_s", "_l", "_a", "_b"))
    whole = F.struct((s + 1).alias("s"), l.alias("e"), ((s + 1) * n).alias("a"), (l * n).alias("b"))
    pieces = (
        F.when(s == l, F.array(edge(s, a, b)))
        .when(l == s + 1, F.array(edge(s, a, (s + 1) * n), edge(l, l * n, b)))
        .otherwise(F.array(edge(s, a, (s + 1) * n), whole, edge(l, l * n, b)))
    )
    piece = iv.select(*names, F.explode(pieces).alias("_p")).select(*names, "_p.*")
    # a whole shard counts among the whole ones, wherever it came from
    full = (F.col("e") > F.col("s") + 1) | (F.col("b") - F.col("a") == n)
    longest = piece.withColumn("f", full).groupBy(*names, "s", "f", "a").agg(F.max("b").alias("b"))
    return _united(longest, names)


def periods_and_gaps(df: DataFrame, entity: list[str], start: str, stop: str, *, shard: int = SHARD) -> DataFrame:
    """(entity, what, start, stop): the continuous periods of each entity and the gaps between neighbouring ones.

    ``start`` and ``stop`` are whole numbers of units (see ``to_units``), half-open. Intervals that overlap or touch form
    one period; reversed times are put in order. Left out are intervals with a missing time, of no length, or with a null
    in the entity. Repeated rows change nothing. An empty table gives an empty result. Other columns of ``df`` are
    ignored, whatever their names.
    """
    names = [f"_e{i}" for i in range(len(entity))]
    held = stored(run_bitmaps(df, entity, start, stop, shard=shard), "bitmaps")
    bitmaps = held.filter(~F.col("f"))
    wholes = held.filter("f").select(*names, F.col("s").alias("s1"), F.expr(f"runs[0].b div {shard}").alias("s2"))
    n, runs, k = F.lit(shard).cast("long"), F.col("runs"), F.size("runs")
    last = F.element_at(runs, -1)
    # the edges of each shard: where its first and its last run start and stop
    edges = bitmaps.select(*names, F.col("s").alias("s1"), (F.col("s") + 1).alias("s2"), F.lit(False).alias("f"), k.alias("k"), runs[0]["a"].alias("a1"), runs[0]["b"].alias("b1"), last["a"].alias("a2"), last["b"].alias("b2"))
    span = [(F.col("s1") * n).alias("a1"), (F.col("s2") * n).alias("b1"), (F.col("s1") * n).alias("a2"), (F.col("s2") * n).alias("b2")]
    edges = edges.unionByName(wholes.select(*names, "s1", "s2", F.lit(True).alias("f"), F.lit(1).alias("k"), *span))
    order = Window.partitionBy(*names).orderBy("s1", F.col("f").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_reach", F.max(F.when(F.col("f"), F.col("s2"))).over(before))
    # what lies in shards already covered adds nothing; a longer run of whole shards loses its covered head
    over = F.coalesce(F.col("_reach") >= F.col("s2"), F.lit(False))
    head = F.when(F.col("f") & (F.col("_reach") > F.col("s1")), F.col("_reach") * n)
    left = edges.filter(~over).withColumns({"a1": F.coalesce(head, "a1"), "a2": F.coalesce(head, "a2")})
    order = Window.partitionBy(*names).orderBy("s1")
    left = left.withColumn("_pl", F.lag("b2").over(order)).withColumn("_nf", F.lead("a1").over(order))
    left = left.withColumn("_j", F.coalesce(F.col("_pl") == F.col("a1"), F.lit(False)))
    left = left.withColumn("_own", F.when((F.col("k") > 1) | ~F.col("_j"), F.col("a2")))
    left = left.withColumn("_open", F.last("_own", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    left = left.withColumn("_from", F.last("_own", True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    out = lambda what, a, b: F.struct(F.lit(what).alias("what"), a.alias("start"), b.alias("stop"))
    none = F.array().cast("array<struct<what:string,start:bigint,stop:bigint>>")
    first = F.when(F.col("_j"), F.col("_from")).otherwise(F.col("a1"))
    outer = F.array_compact(F.array(
        F.when(F.col("k") > 1, out("period", first, F.col("b1"))),
        F.when(F.coalesce(F.col("_nf") != F.col("b2"), F.lit(True)), out("period", F.col("_open"), F.col("b2"))),
        F.when(F.col("_pl").isNotNull() & ~F.col("_j"), out("gap", F.col("_pl"), F.col("a1"))),
    ))
    inner = F.concat(
        F.when(k > 2, F.transform(F.slice(runs, F.lit(2), k - 2), lambda r: out("period", r["a"], r["b"]))).otherwise(none),
        F.zip_with(F.slice(runs, F.lit(1), k - 1), F.slice(runs, F.lit(2), k - 1), lambda x, y: out("gap", x["b"], y["a"])),
    )
    covered = edges.filter(over & ~F.col("f") & (F.col("k") > 1)).select(*names, F.col("s1").alias("s"))
    inside = bitmaps.filter(k > 1).join(covered, [*names, "s"], "left_anti")
    both = left.select(*names, F.explode(outer).alias("_c")).unionByName(inside.select(*names, F.explode(inner).alias("_c")))
    return both.select(*[F.col(n).alias(c) for n, c in zip(names, entity)], "_c.what", "_c.start", "_c.stop")
