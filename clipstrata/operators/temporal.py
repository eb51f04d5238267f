"""Stabilising and measuring frame sequences: (episode, ordinal) in order, with a class and a depth each.

Every function takes the names of its columns. Episodes are window partitions; all windows of one call share their sort,
so Spark shuffles once. A null class is a class of its own; a depth that is null, NaN or not above 0 is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def ordered(ep: str, ordinal: str, *px: str) -> WindowSpec:
    return Window.partitionBy(ep, *px).orderBy(ordinal)


def flicker(df: DataFrame, ep: str, ordinal: str, cls: str, *px: str) -> DataFrame:
    """(ep, compared, changed, flicker): the share of frames whose class differs from the one before; null if none."""
    before = F.lag(F.struct(cls)).over(ordered(ep, ordinal, *px))
    steps = df.select(ep, before.alias("_b"), F.struct(cls).alias("_c"))
    changed = F.sum(F.when(~F.col("_c").eqNullSafe(F.col("_b")), 1).otherwise(0))
    return steps.filter("_b IS NOT NULL").groupBy(ep).agg(
        F.count("*").alias("compared"), changed.alias("changed"), (changed / F.count("*")).alias("flicker")
    )


def suppress_short_runs(df: DataFrame, ep: str, ordinal: str, cls: str, out: str, *px: str, least: int = 2) -> DataFrame:
    """Adds ``out``: runs of a class shorter than ``least`` take the class before them, at the start the one after.

    Sequences of fewer than three frames, or without any run that is long enough, stay as they are.
    """
    w = ordered(ep, ordinal, *px)
    run = Window.partitionBy(ep, *px, "_run")
    all_ = Window.partitionBy(ep, *px)
    starts = F.when(F.col(cls).eqNullSafe(F.lag(cls).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    df = df.withColumn("_s", starts).withColumn("_run", F.sum("_s").over(w))
    kept = F.count("*").over(run) >= least
    df = df.withColumn("_keep", F.when(kept, F.struct(cls))).withColumn("_n", F.count("*").over(all_))
    past = F.last("_keep", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("_keep", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    got = F.coalesce(past, ahead, F.struct(cls))[cls]
    passed = (F.col("_n") < 3) | F.lit(least < 2)
    return df.withColumn(out, F.when(passed, F.col(cls)).otherwise(got)).drop("_s", "_run", "_keep", "_n")


def vote(cls: Column, w: WindowSpec, radius: int, classes: int) -> Column:
    """The most frequent class of the frames within ``radius``, the middle one counted twice; the lowest id of equals."""
    near = w.rowsBetween(-radius, radius)
    votes = F.array(*[F.sum(F.when(cls == k, 1).otherwise(0)).over(near) + F.when(cls == k, 1).otherwise(0) for k in range(classes)])
    return (F.array_position(votes, F.array_max(votes)) - 1).cast("int")


def window_median(depth: Column, w: WindowSpec, radius: int) -> Column:
    """The median of the depths within ``radius`` frames, without those that are none; 0 if all are."""
    real = F.when(~F.isnan(depth) & (depth > 0), depth)
    return F.coalesce(F.percentile(real, 0.5).over(w.rowsBetween(-radius, radius)), F.lit(0.0))


def trend(y: str, x: str, w: WindowSpec, radius: int) -> Column:
    """The straight line through the values within ``radius``, at the middle; the value itself if it is alone."""
    near = w.rowsBetween(-radius, radius)
    line = F.regr_intercept(y, x).over(near) + F.col(x) * F.regr_slope(y, x).over(near)
    return F.coalesce(line, F.col(y).cast("double"))


def second_difference(x: Column, w: WindowSpec) -> Column:
    return F.abs(F.lag(x).over(w) - 2 * x + F.lead(x).over(w))


def flash(cls: str, w: WindowSpec, span: int) -> Column:
    """1 where the class differs from both ends of the span, which agree; null where the span leaves the sequence."""
    a, b = F.lag(cls, span).over(w), F.lead(cls, span).over(w)
    return F.when(a.isNotNull() & b.isNotNull(), F.when((a == b) & (F.col(cls) != a), 1).otherwise(0))


def log_ratios(df: DataFrame, seg: str, ordinal: str, depth: str, px: list[str], *, least: float = 0.05) -> DataFrame:
    """(seg, ordinal, ratio): the median log ratio to the frame before over the pixels with depth in both; 0 if too few."""
    w = ordered(seg, ordinal, *px)
    both = df.select(seg, ordinal, F.col(depth).alias("_d"), F.lag(depth).over(w).alias("_p"), F.lag(ordinal).over(w).alias("_o"))
    ok = (F.col("_d") > 0) & (F.col("_p") > 0) & (F.col("_o") == F.col(ordinal) - 1)
    one = both.groupBy(seg, ordinal).agg(
        F.count("*").alias("_all"), F.count_if(ok).alias("_n"), F.percentile(F.when(ok, F.ln("_d") - F.ln("_p")), 0.5).alias("_m")
    )
    return one.select(seg, ordinal, F.when((F.col("_n") >= F.col("_all") * least) & (F.col("_n") > 0), F.col("_m")).otherwise(0.0).alias("ratio"))


def scale_residual(ratios: DataFrame, seg: str, ordinal: str, *, radius: int = 12, limit: float = 0.25) -> DataFrame:
    """(seg, ordinal, level, residual, correction): the level curve less its local trend, and the clamped correction."""
    w = ordered(seg, ordinal)
    level = ratios.withColumn("level", F.sum("ratio").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    res = level.withColumn("residual", F.col("level") - trend("level", ordinal, w, radius))
    mean = F.avg("residual").over(Window.partitionBy(seg))
    raw = -(F.col("residual") - mean)
    return res.select(seg, ordinal, "level", "residual", F.greatest(F.least(raw, F.lit(limit)), F.lit(-limit)).alias("correction"))


def recentred(df: DataFrame, seg: str, value: str, *, limit: float = 0.25, passes: int = 4) -> DataFrame:
    """Takes the mean out of the values that have room below the limit; whatever is left after the passes from all."""
    all_ = Window.partitionBy(seg)
    x = F.col(value)
    for i in range(passes):
        df = df.withColumn(f"_m{i}", F.avg(x).over(all_)).withColumn(f"_f{i}", F.sum(F.when(F.abs(x) < limit, 1).otherwise(0)).over(all_))
        df = df.withColumn(f"_n{i}", F.count("*").over(all_))
        moved = F.when(F.abs(x) < limit, x - F.col(f"_m{i}") * F.col(f"_n{i}") / F.greatest(F.col(f"_f{i}"), F.lit(1))).otherwise(x)
        df = df.withColumn(value, F.when((F.col(f"_m{i}") == 0) | (F.col(f"_f{i}") == 0), x).otherwise(F.greatest(F.least(moved, F.lit(limit)), F.lit(-limit))))
    df = df.withColumn("_mean", F.avg(x).over(all_)).withColumn(value, x - F.col("_mean"))
    return df.drop("_mean", *[f"_{k}{i}" for k in "mfn" for i in range(passes)])


def scale_factors(ratios: DataFrame, seg: str, ordinal: str, *, radius: int = 12, limit: float = 0.25) -> DataFrame:
    """(seg, ordinal, correction): the log factor of each frame that takes its own scale out and leaves the clip's level as it
    is: of mean zero, within the limit. Clips of fewer than three frames have none (0)."""
    c = recentred(scale_residual(ratios, seg, ordinal, radius=radius, limit=limit), seg, "correction", limit=limit)
    n = F.count("*").over(Window.partitionBy(seg))
    return c.select(seg, ordinal, F.when(n >= 3, F.col("correction")).otherwise(0.0).alias("correction"))
