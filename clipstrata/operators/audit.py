"""Audits of segments and of a whole corpus of them, and the guard of the depth range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.functions.encode import FAR, NEAR, VALID
from clipstrata.operators.ranges import quantiles

SKY = 1


def segment_audit(px: DataFrame, *, stride: int = 8, window: int = 124) -> DataFrame:
    """One row a segment: structure, depth shares, percentiles over every ``stride``-th valid pixel of a frame, classes.

    ``complete``: ordinals from 0 without a gap, and at least ``window`` of them. Pixels are (seg, ordinal, r, c, depth,
    cls); a depth that is null, NaN or not above the floor is none.
    """
    ok = F.coalesce(~F.isnan("depth") & (F.col("depth") > VALID), F.lit(False))
    nth = F.row_number().over(Window.partitionBy("seg", "ordinal", "_v").orderBy("r", "c"))
    p = px.withColumn("_v", ok).withColumn("_n", nth)
    sample = F.when(F.col("_v") & (F.col("_n") % stride == 1), F.col("depth"))
    sky = F.col("cls") == SKY
    n, valid = F.count("*"), F.count_if(F.col("_v"))
    share = lambda a, b: F.round(a / F.greatest(b, F.lit(1)), 6)
    # what a frame holds first, then what its segment does: a segment meets in one task as one row a frame
    f = p.groupBy("seg", "ordinal").agg(
        n.alias("n"), valid.alias("v"), F.count_if(F.col("_v") & (F.col("depth") < NEAR)).alias("near"), F.count_if(F.col("_v") & (F.col("depth") > FAR)).alias("far"),
        F.count_if(sky).alias("sky"), F.count_if(sky & F.col("_v")).alias("sky_v"), F.collect_set(F.col("cls").cast("int")).alias("classes"),
    )
    frames_, t = F.count("*"), lambda c: F.sum(c)
    stats = f.groupBy("seg").agg(
        frames_.alias("frames"),
        ((frames_ == F.max("ordinal") + 1) & (F.min("ordinal") == 0) & (frames_ >= window)).alias("complete"),
        share(t("v"), t("n")).alias("valid_fraction"), share(t("near"), t("v")).alias("below_near_fraction"), share(t("far"), t("v")).alias("above_far_fraction"),
        share(t("sky"), t("n")).alias("sky_fraction"), share(t("sky_v"), t("sky")).alias("sky_depth_valid_fraction"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes")))).alias("classes_present"),
    )
    q = quantiles(p.filter(F.col("_v")), ["seg"], sample, {"metres_p1": 0.01, "metres_p50": 0.5, "metres_p99": 0.99})
    out = stats.join(q.select("seg", *[F.round(c, 4).alias(c) for c in ("metres_p1", "metres_p50", "metres_p99")]), "seg", "left")
    return out.select(
        "seg", "frames", "complete", "valid_fraction", "metres_p1", "metres_p50", "metres_p99", "below_near_fraction", "above_far_fraction", "sky_fraction", "sky_depth_valid_fraction", "classes_present"
    )


def corpus_audit(stats: DataFrame, *, spread_limit: float = 10.0) -> DataFrame:
    """One row: the spread of the segments' median depths, and how many segments call for a look, by reason.

    The medians' percentiles are exact. No task sees all segments.
    """
    p50 = F.when(F.col("metres_p50") > 0, F.col("metres_p50"))
    q = quantiles(stats, [], p50, {"low": 0.1, "high": 0.9}).agg(F.max("low").alias("low"), F.max("high").alias("high"))  # one row, with or without values
    spread = F.round(F.col("high") / F.greatest(F.col("low"), F.lit(1e-9)), 3)
    all_ = stats.agg(
        F.count("*").alias("segments"), F.count_if(F.col("sky_depth_valid_fraction") > 0).alias("sky_with_depth"), F.count_if(F.col("valid_fraction") <= 0.01).alias("empty"),
        F.count_if(~F.array_contains("classes_present", SKY)).alias("without_sky"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes_present")))).alias("classes"),
    )
    return all_.crossJoin(F.broadcast(q)).select(
        "segments", F.round("low", 4).alias("p10"), F.round("high", 4).alias("p90"), spread.alias("median_spread"), (spread > spread_limit).alias("too_far_apart"), "sky_with_depth", "empty", "without_sky", "classes"
    )


def sky_repair(px: DataFrame) -> DataFrame:
    """The planes with no depth on sky."""
    return px.withColumn("depth", F.when(F.col("cls") == SKY, 0.0).otherwise(F.col("depth")))


def sky_faults(px: DataFrame) -> DataFrame:
    """(seg, changed_frames, changed_pixels, sky_pixels) of each segment with sky."""
    bad = (F.col("cls") == SKY) & (F.col("depth") > VALID)
    f = px.groupBy("seg", "ordinal").agg(F.count_if(bad).alias("n"), F.count_if(F.col("cls") == SKY).alias("s"))
    return f.groupBy("seg").agg(F.count_if(F.col("n") > 0).alias("changed_frames"), F.sum("n").alias("changed_pixels"), F.sum("s").alias("sky_pixels"))


def range_guard(df: DataFrame, keys: list[str], depth: str, near: float, far: float) -> DataFrame:
    """(*keys, clipped_near_fraction, clipped_far_fraction, median_metres) of the depths that are numbers above 0."""
    d = F.col(depth)
    ok = F.coalesce(~F.isnan(d) & (d > 0) & (d < float("inf")), F.lit(False))
    n = F.greatest(F.count_if(ok), F.lit(1))
    clipped = df.groupBy(*keys).agg(
        F.round(F.count_if(ok & (d < near)) / n, 6).alias("clipped_near_fraction"), F.round(F.count_if(ok & (d > far)) / n, 6).alias("clipped_far_fraction")
    )
    mid = quantiles(df, keys, F.when(ok, d), {"_m": 0.5})
    same = F.expr(" AND ".join(f"l.{k} <=> r.{k}" for k in keys))
    both = clipped.alias("l").join(mid.alias("r"), same, "left")
    return both.select(*[F.col(f"l.{k}").alias(k) for k in keys], "clipped_near_fraction", "clipped_far_fraction", F.round(F.coalesce("_m", F.lit(0.0)), 4).alias("median_metres"))


def contiguous(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """(key, prefix): how many ordinals from 0 on are there without a gap; repeated ordinals count once."""
    d = df.select(key, ordinal).filter(F.col(ordinal) >= 0).distinct()
    nth = F.row_number().over(Window.partitionBy(key).orderBy(ordinal)) - 1
    return d.withColumn("_n", nth).groupBy(key).agg(F.count_if(F.col("_n") == F.col(ordinal)).alias("prefix"))


def camera_scale(predicted: DataFrame, true: DataFrame, key: str, frame: str, *, reach: int | None = None, baseline: float = 0.05, dispersion: float = 0.25) -> DataFrame:
    """(key, pairs, scale, dispersion, solved): the median ratio of true to predicted distances of camera pairs.

    All pairs of a sequence are taken, or with ``reach`` those within so many frames. Positions are x, y, z. Too few usable
    pairs give a scale of 1 that isn't solved.
    """
    both = predicted.alias("p").join(true.alias("t"), [key, frame]).select(key, frame, F.struct("p.x", "p.y", "p.z").alias("_p"), F.struct("t.x", "t.y", "t.z").alias("_t"))
    ahead = Window.partitionBy(key).orderBy(frame).rowsBetween(1, Window.unboundedFollowing if reach is None else reach)
    pairs = both.withColumn("_a", F.collect_list(F.struct(F.col("_p").alias("p"), F.col("_t").alias("t"))).over(ahead)).withColumn("_o", F.explode("_a"))
    dist = lambda a, b: F.sqrt(sum(((a[c] - b[c]) ** 2 for c in "xyz"), F.lit(0.0)))
    d = pairs.select(key, dist(F.col("_p"), F.col("_o.p")).alias("dp"), dist(F.col("_t"), F.col("_o.t")).alias("dt")).filter((F.col("dt") > baseline) & (F.col("dp") > 1e-9))
    d = d.withColumn("r", F.col("dt") / F.col("dp"))
    mid = d.groupBy(key).agg(F.percentile("r", 0.5).alias("scale"), F.count("*").alias("pairs"))
    spread = d.join(mid, key).groupBy(key).agg((F.percentile(F.abs(F.col("r") - F.col("scale")), 0.5) / F.greatest(F.first("scale"), F.lit(1e-9))).alias("dispersion"))
    frames_ = both.groupBy(key).agg(F.count("*").alias("_n"))
    out = frames_.join(mid, key, "left").join(spread, key, "left")
    enough = F.coalesce(F.col("pairs") >= F.greatest(F.lit(3), F.floor(F.col("_n") / 10)), F.lit(False))
    return out.select(
        key, F.coalesce("pairs", F.lit(0)).alias("pairs"), F.when(enough, F.col("scale")).otherwise(1.0).alias("scale"), F.when(enough, F.col("dispersion")).alias("dispersion"),
        (enough & F.coalesce(F.col("dispersion") <= dispersion, F.lit(False))).alias("solved"),
    )


def baseline(positions: DataFrame, key: str) -> DataFrame:
    """(key, extent): the median distance of a camera's places (x, y, z) from their middle; whether it moved enough."""
    m = positions.groupBy(key).agg(*[F.avg(c).alias(f"_{c}") for c in "xyz"])
    far = F.sqrt(sum(((F.col(c) - F.col(f"_{c}")) ** 2 for c in "xyz"), F.lit(0.0)))
    return positions.join(m, key).groupBy(key).agg(F.percentile(far, 0.5).alias("extent"))


def validated(px: DataFrame, *, expected: int | None = None, classes: int = 12, size: tuple[int, int] | None = None) -> DataFrame:
    """(seg, frames, height, width, depth_min, depth_max, invalid_fraction, classes_present, problem): segments against the
    contract a reader of their planes relies on; ``problem`` names the first rule that is broken, null for none.

    Rules, in order: ordinals count from 0 without a hole, there are ``expected`` frames, every frame has one size (``size``
    as height and width, or that of the segment), and depths are finite and not negative, classes in range.
    """
    d = F.col("depth")
    ok = F.coalesce(~F.isnan(d) & (d > VALID) & (d < float("inf")), F.lit(False))
    f = px.groupBy("seg", "ordinal").agg(
        F.count("*").alias("n"), (F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"), F.count_if(F.coalesce(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(True))).alias("odd"), F.count_if(d < 0).alias("neg"),
        F.max("cls").alias("top"), F.min("cls").alias("bottom"), F.count_if(ok).alias("v"), F.min(F.when(ok, d)).alias("lo"), F.max(F.when(ok, d)).alias("hi"), F.collect_set("cls").alias("set"),
    )
    s = f.groupBy("seg").agg(
        F.count("*").alias("frames"), F.min("ordinal").alias("_a"), F.max("ordinal").alias("_b"), F.max("h").alias("height"), F.max("w").alias("width"), F.min(F.struct(F.col("h") * F.col("w"), "n")).alias("_least"),
        F.count_if((F.col("n") != F.col("h") * F.col("w"))).alias("_holes"), F.min("h").alias("_h"), F.min("w").alias("_w"), F.min(F.when(F.col("odd") > 0, F.col("ordinal"))).alias("_odd"),
        F.min(F.when(F.col("neg") > 0, F.col("ordinal"))).alias("_neg"), F.min(F.when((F.col("top") >= classes) | (F.col("bottom") < 0), F.col("ordinal"))).alias("_cls"), F.sum("v").alias("_v"), F.sum("n").alias("_n"),
        F.min("lo").alias("depth_min"), F.coalesce(F.max("hi"), F.lit(0.0)).alias("depth_max"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("set")))).alias("classes_present"),
    )
    h, w = (F.lit(size[0]), F.lit(size[1])) if size else (F.col("height"), F.col("width"))
    grid = (F.col("_holes") > 0) | (F.col("_h") != F.col("height")) | (F.col("_w") != F.col("width")) | (F.col("height") != h) | (F.col("width") != w)
    wrong = [F.when((F.col("_a") != 0) | (F.col("_b") != F.col("frames") - 1), "ordinals must count from 0 without a hole")]
    if expected is not None:
        wrong.append(F.when(F.col("frames") != expected, F.concat(F.lit(f"expected {expected} frames, found "), "frames")))
    at = lambda c, text: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{text} at ordinal "), c))
    wrong += [F.when(grid, "frames differ in size"), at("_odd", "depth that is not finite"), at("_neg", "negative depth"), at("_cls", "class out of range")]
    share = F.round(1 - F.col("_v") / F.col("_n"), 6)
    return s.select("seg", "frames", "height", "width", F.round("depth_min", 4).alias("depth_min"), F.round("depth_max", 4).alias("depth_max"), share.alias("invalid_fraction"), "classes_present", F.coalesce(*wrong).alias("problem"))


def metric_source(solved: Column, metric: Column) -> Column:
    """Where metres come from: solved cameras, a model that predicts them, or null: they can't be had."""
    return F.when(solved, "gt_camera_baseline").when(metric, "backend_native")


def provenance(report: Column) -> Column:
    """(depth, refiner, proxy_duv, duv_size): how a clip was made, from its report; null where that can't be told."""
    v = F.try_parse_json(report)
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    size = F.coalesce(get("$.duv_size", "array<int>"), F.array(F.lit(336), F.lit(192)))
    made = F.struct(get("$.depth.backend", "string").alias("depth"), get("$.semantic.refiner", "string").alias("refiner"), F.coalesce(get("$.proxy_duv", "boolean"), F.lit(False)).alias("proxy_duv"), size.alias("duv_size"))
    return F.when(v.isNotNull(), made)
