"""Where clips come from: windows of an episode, their halo, the second grid of a clip, and cuts of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lengths and rates of the delivered clips.
WINDOW, STRIDE, CLIPS, FPS = 124, 90, 5, 24.0


def window_count(frames: Column) -> Column:
    return F.when(frames < WINDOW, 0).otherwise(1 + F.floor((frames - WINDOW) / STRIDE)).cast("long")


def frames_for(windows: Column) -> Column:
    return (WINDOW + STRIDE * (windows - 1)).cast("long")


def usable(frames: Column) -> Column:
    """The longest length up to ``frames`` that windows fill; 0 if not even one fits."""
    n = window_count(frames)
    return F.when(n > 0, frames_for(n)).otherwise(0).cast("long")


def deliverable(frames: Column) -> Column:
    return (frames >= WINDOW) & (F.pmod(frames, F.lit(17)) == 5)


def largest_deliverable(frames: Column) -> Column:
    return (frames - F.pmod(frames - 5, F.lit(17))).cast("long")


def seconds_for(frames: Column, fps: float = FPS) -> Column:
    return F.floor(frames / fps * 100) / 100


def probes(frames: Column, wanted: int) -> Column:
    """At most ``wanted`` ordinals that are spread evenly over a clip, each once."""
    n = F.least(F.lit(wanted), frames)
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.least(F.floor(i * (frames / n)).cast("int"), frames - 1))
    return F.when(frames > 0, F.array_distinct(at)).otherwise(F.array().cast("array<int>"))


def clip_name(scene: Column, index: Column) -> Column:
    """The name of a window of a scene, which keeps the scene's number."""
    return F.concat(F.lit("clip_"), F.regexp_replace(scene, "^[^_]*_", ""), F.lit("_"), index)


def plan_windows(episodes: DataFrame, scene: str, frames: str, fps: str, *, count: int = CLIPS, length: int = WINDOW, to_fps: float = FPS) -> DataFrame:
    """(scene, idx, k, ordinal): ``count`` even buckets with one window in the middle of each, halves rounded to even.

    Episodes that are too short for it, or slower than the clips, give no rows; so do null frames and rates.
    """
    step = F.col(fps) / F.lit(to_fps)
    e = episodes.filter((F.col(fps) > 0) & (step >= 1.0 - 1e-9)).withColumn("_step", step)
    e = e.withColumn("_span", F.rint(F.lit(length - 1) * F.col("_step")).cast("long") + 1).withColumn("_bucket", F.floor(F.col(frames) / count))
    e = e.filter(F.col("_span") <= F.col("_bucket"))
    e = e.select(scene, "_step", "_span", "_bucket", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("idx"))
    e = e.withColumn("_start", F.col("idx") * F.col("_bucket") + F.floor((F.col("_bucket") - F.col("_span")) / 2))
    e = e.select("*", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("k"))
    return e.select(scene, "idx", "k", (F.col("_start") + F.rint(F.col("k") * F.col("_step"))).cast("long").alias("ordinal"))


def halo(windows: DataFrame, episodes: DataFrame, scene: str, frames: str, fps: str, *, length: int, width: int, to_fps: float = FPS) -> DataFrame:
    """(scene, idx, offset, n): how many frames before the window are read with it, and how many in all."""
    ends = windows.groupBy(scene, "idx").agg(F.min("ordinal").alias("_a"), F.max("ordinal").alias("_b"))
    e = episodes.select(scene, F.col(frames).alias("_n"), (F.col(fps) / F.lit(to_fps)).alias("_step"))
    x = ends.join(e, scene).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(width))))
    x = x.withColumn("_d", F.rint(F.col("_k") * F.col("_step")).cast("long"))
    lead, tail = F.count_if(F.col("_a") - F.col("_d") >= 0), F.count_if(F.col("_b") + F.col("_d") < F.col("_n"))
    return x.groupBy(scene, "idx").agg(lead.alias("offset"), (lead + tail + length).alias("n"))


def second_grid(clips: DataFrame, clip: str, frames: str, fps: str, *, seconds: float = 1.0, tail: float = 0.5) -> DataFrame:
    """(clip, bin, start, stop, first_frame, stop_frame): whole bins; a tail that is too short joins the last one.

    Clips with no frames or rate, or a null, give no rows. Bins are half-open and share no frame.
    """
    c = clips.filter((F.col(frames) >= 1) & (F.col(fps) > 0)).select(clip, F.col(frames).cast("long").alias("_n"), F.col(fps).cast("double").alias("_r"))
    c = c.withColumn("_t", F.col("_n") / F.col("_r")).withColumn("_full", F.floor(F.col("_t") / seconds + 1e-9).cast("int"))
    rest = F.col("_t") - F.col("_full") * F.lit(seconds)
    own = (F.col("_full") == 0) | ((rest >= tail - 1e-9) & (rest > 1e-9))
    c = c.withColumn("_bins", F.col("_full") + F.when(own, 1).otherwise(0))
    c = c.select("*", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("bin"))
    last = F.col("bin") == F.col("_bins") - 1
    start = F.col("bin") * F.lit(seconds)
    stop = F.when(last, F.col("_t")).otherwise((F.col("bin") + 1) * F.lit(seconds))
    return c.select(
        clip, "bin", F.round(start, 3).alias("start"), F.round(stop, 3).alias("stop"), F.rint(start * F.col("_r")).cast("long").alias("first_frame"),
        F.when(last, F.col("_n")).otherwise(F.rint(stop * F.col("_r")).cast("long")).alias("stop_frame"),
    )


def cut_grid(grid: DataFrame, clip: str, start: float, stop: float) -> DataFrame:
    """The whole bins within [start, stop), counted and timed from the first; a bin that is partly outside is dropped."""
    inside = grid.filter((F.col("start") >= start - 1e-9) & (F.col("stop") <= stop + 1e-9))
    w = Window.partitionBy(clip)
    return inside.select(
        clip, (F.row_number().over(w.orderBy("bin")) - 1).alias("bin"), F.round(F.col("start") - F.min("start").over(w), 3).alias("start"),
        F.round(F.col("stop") - F.min("start").over(w), 3).alias("stop"), (F.col("first_frame") - F.min("first_frame").over(w)).alias("first_frame"),
        (F.col("stop_frame") - F.min("first_frame").over(w)).alias("stop_frame"),
    )


def to_bins(frames: DataFrame, grid: DataFrame, clip: str, ordinal: str, *, block: int = 24) -> DataFrame:
    """Every frame with the bin that holds it; frames that no bin holds are left out. Bins of a clip don't overlap.

    Frames and bins meet by clip and block of ``block`` frames, so a frame is compared with the few bins that share its
    block, not with every bin, and a long clip is spread by its blocks."""
    blocks = F.sequence(F.expr(f"first_frame div {block}"), F.expr(f"(stop_frame - 1) div {block}"))
    bins = grid.filter("stop_frame > first_frame").select(F.col(clip).alias("_c"), "bin", "first_frame", "stop_frame", F.explode(blocks).alias("_block"))
    rows = frames.select(F.col(clip).alias("_c"), F.expr(f"`{ordinal}` div {block}").alias("_block"), F.struct(*[F.col(f"`{c}`") for c in frames.columns]).alias("_row"))
    at = F.col("_row")[ordinal]
    met = rows.join(bins, ["_c", "_block"]).filter((F.col("first_frame") <= at) & (at < F.col("stop_frame")))
    return met.select(*[F.col("_row")[c].alias(c) for c in frames.columns if c != "bin"], "bin")
