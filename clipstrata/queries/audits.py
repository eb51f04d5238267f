"""Queries over segments: audits, repairs, range guard, cameras, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.operators import audit, tracks
from clipstrata.queries import Registry
from clipstrata.sources.tables import FRAMES_SQL, PIXELS_SQL, clip_index, clip_scene, frames, pixels, table

REG = Registry()

SEG_SQL = PIXELS_SQL + """, n AS (SELECT *, depth > 1e-3 AS v, row_number() OVER (PARTITION BY seg, ordinal, depth > 1e-3 ORDER BY r, c) AS i FROM px
), s AS (
  SELECT seg, count(DISTINCT ordinal) AS frames, count(DISTINCT ordinal) = max(ordinal) + 1 AND min(ordinal) = 0 AND count(DISTINCT ordinal) >= 124 AS complete,
    round(count(*) FILTER (v) / greatest(count(*), 1), 6) AS valid_fraction,
    round(quantile_cont(CASE WHEN v AND i % 8 = 1 THEN depth END, 0.01), 4) AS metres_p1, round(quantile_cont(CASE WHEN v AND i % 8 = 1 THEN depth END, 0.5), 4) AS metres_p50,
    round(quantile_cont(CASE WHEN v AND i % 8 = 1 THEN depth END, 0.99), 4) AS metres_p99,
    round(count(*) FILTER (v AND depth < 0.3) / greatest(count(*) FILTER (v), 1), 6) AS below_near_fraction, round(count(*) FILTER (v AND depth > 256) / greatest(count(*) FILTER (v), 1), 6) AS above_far_fraction,
    round(count(*) FILTER (cls = 1) / greatest(count(*), 1), 6) AS sky_fraction, round(count(*) FILTER (cls = 1 AND v) / greatest(count(*) FILTER (cls = 1), 1), 6) AS sky_depth_valid_fraction,
    list_sort(list_distinct(list(cls))) AS classes_present FROM n GROUP BY seg
)"""


@REG.add("segment_audit", SEG_SQL + " SELECT * FROM s")
def segment_audit(spark: SparkSession, where: str) -> DataFrame:
    return audit.segment_audit(pixels(spark, where))


CORPUS = """, m AS (SELECT *, CASE WHEN metres_p50 > 0 THEN metres_p50 END AS m FROM s
) SELECT count(*) AS segments, round(quantile_cont(m, 0.1), 4) AS p10, round(quantile_cont(m, 0.9), 4) AS p90, round(quantile_cont(m, 0.9) / greatest(quantile_cont(m, 0.1), 1e-9), 3) AS median_spread,
round(quantile_cont(m, 0.9) / greatest(quantile_cont(m, 0.1), 1e-9), 3) > 10 AS too_far_apart, count(*) FILTER (sky_depth_valid_fraction > 0) AS sky_with_depth, count(*) FILTER (valid_fraction <= 0.01) AS empty,
count(*) FILTER (NOT list_contains(classes_present, 1)) AS without_sky, list_sort(list_distinct(flatten(list(classes_present)))) AS classes FROM m"""


@REG.add("corpus_audit", SEG_SQL + CORPUS)
def corpus_audit(spark: SparkSession, where: str) -> DataFrame:
    return audit.corpus_audit(audit.segment_audit(pixels(spark, where)))


@REG.add("corpus_audit_stats", "WITH s AS (SELECT * FROM seg_stats)" + CORPUS)
def corpus_audit_stats(spark: SparkSession, where: str) -> DataFrame:
    """The same over the stored statistics of the segments."""
    return audit.corpus_audit(table(spark, where, "seg_stats"))


@REG.add(
    "sky_faults",
    PIXELS_SQL
    + """, f AS (SELECT seg, ordinal, count(*) FILTER (cls = 1 AND depth > 1e-3) AS n, count(*) FILTER (cls = 1) AS s FROM px GROUP BY seg, ordinal)
SELECT seg, count(*) FILTER (n > 0) AS changed_frames, CAST(sum(n) AS BIGINT) AS changed_pixels, CAST(sum(s) AS BIGINT) AS sky_pixels FROM f GROUP BY seg""",
)
def sky_faults(spark: SparkSession, where: str) -> DataFrame:
    return audit.sky_faults(pixels(spark, where))


@REG.add("sky_repair", PIXELS_SQL + " SELECT seg, ordinal, r, c, CASE WHEN cls = 1 THEN 0.0 ELSE depth END AS depth, cls FROM px")
def sky_repair(spark: SparkSession, where: str) -> DataFrame:
    return audit.sky_repair(pixels(spark, where)).select("seg", "ordinal", "r", "c", "depth", "cls")


GUARD_SQL = """round(count(*) FILTER (x > 0 AND x < {a}) / greatest(count(*) FILTER (x > 0), 1), 6) AS clipped_near_fraction,
round(count(*) FILTER (x > {b}) / greatest(count(*) FILTER (x > 0), 1), 6) AS clipped_far_fraction, round(coalesce(quantile_cont(CASE WHEN x > 0 THEN x END, 0.5), 0), 4) AS median_metres"""


@REG.add("range_guard", FRAMES_SQL + " SELECT ep, " + GUARD_SQL.format(a=50, b=400).replace("x", "depth").replace("madepth", "max") + " FROM frames GROUP BY ep")
def range_guard(spark: SparkSession, where: str) -> DataFrame:
    return audit.range_guard(frames(spark, where), ["ep"], "depth", 50.0, 400.0)


@REG.add("range_guard_prices", "SELECT l_returnflag, " + GUARD_SQL.format(a=5000, b=80000).replace("x >", "l_extendedprice >").replace("x <", "l_extendedprice <").replace("THEN x END", "THEN l_extendedprice END") + " FROM lineitem GROUP BY l_returnflag")
def range_guard_prices(spark: SparkSession, where: str) -> DataFrame:
    """The guard over a table with three groups that hold all rows."""
    return audit.range_guard(table(spark, where, "lineitem"), ["l_returnflag"], "l_extendedprice", 5000.0, 80000.0)


@REG.add(
    "class_fractions",
    PIXELS_SQL + " SELECT seg, cls, round(count(*) / sum(count(*)) OVER (PARTITION BY seg), 6) AS share FROM px GROUP BY seg, cls",
)
def class_fractions(spark: SparkSession, where: str) -> DataFrame:
    from pyspark.sql import Window

    n = pixels(spark, where).groupBy("seg", "cls").agg(F.count("*").alias("n"))
    return n.select("seg", "cls", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("seg")), 6).alias("share"))


@REG.add(
    "histogram_percentiles",
    "WITH w AS (SELECT scene, idx, ordinal FROM windows) SELECT scene, quantile_disc(ordinal, 0.1) AS p10, quantile_disc(ordinal, 0.5) AS p50, quantile_disc(ordinal, 0.9) AS p90 FROM w GROUP BY scene",
)
def histogram_percentiles(spark: SparkSession, where: str) -> DataFrame:
    """Percentiles that are values of the data, from counts by value: what meets for a scene is its distinct ordinals."""
    from pyspark.sql import Window

    n = table(spark, where, "windows").groupBy("scene", "ordinal").agg(F.count("*").alias("n"))
    w = Window.partitionBy("scene").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    c = n.withColumn("c", F.sum("n").over(w)).withColumn("t", F.sum("n").over(Window.partitionBy("scene")))
    at = lambda q: F.min(F.when(F.col("c") >= F.lit(q) * F.col("t"), F.col("ordinal"))).alias(f"p{int(q * 100)}")
    return c.groupBy("scene").agg(at(0.1), at(0.5), at(0.9))


@REG.add(
    "contiguous_prefix",
    """WITH d AS (SELECT DISTINCT scene || '/' || idx AS clip, k FROM windows WHERE k >= 0), n AS (SELECT clip, k, row_number() OVER (PARTITION BY clip ORDER BY k) - 1 AS i FROM d)
SELECT clip, count(*) FILTER (i = k) AS prefix FROM n GROUP BY clip""",
)
def contiguous_prefix(spark: SparkSession, where: str) -> DataFrame:
    w = table(spark, where, "windows").select(F.concat_ws("/", "scene", "idx").alias("clip"), "k")
    return audit.contiguous(w, "clip", "k")


@REG.add(
    "held_ranges",
    """WITH d AS (SELECT DISTINCT scene, idx, k FROM windows), g AS (SELECT *, k - row_number() OVER (PARTITION BY scene, idx ORDER BY k) AS g FROM d
), r AS (SELECT scene, idx, min(k) AS lo, max(k) AS hi FROM g GROUP BY scene, idx, g)
SELECT scene, idx, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '..' || hi END, ',' ORDER BY lo) AS held FROM r GROUP BY scene, idx""",
)
def held_ranges(spark: SparkSession, where: str) -> DataFrame:
    """The numbers that each clip holds, consecutive ones as lo..hi."""
    from pyspark.sql import Window

    d = table(spark, where, "windows").select("scene", "idx", "k").distinct()
    d = d.withColumn("g", F.col("k") - F.row_number().over(Window.partitionBy("scene", "idx").orderBy("k")))
    r = d.groupBy("scene", "idx", "g").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    text = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat("lo", F.lit(".."), "hi"))
    r = r.groupBy("scene", "idx").agg(F.sort_array(F.collect_list(F.struct("lo", text.alias("t")))).alias("a"))
    return r.select("scene", "idx", F.array_join(F.transform("a", lambda x: x["t"]), ",").alias("held"))


POSITIONS_SQL = """
WITH cam AS (SELECT vec_id // 124 AS seg, CAST(vec_id % 124 AS INT) AS f, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings
), tru AS (SELECT seg, f, x * 3 AS x, y * 3 AS y, z * 3 + (f % 5) * 0.01 AS z FROM cam
), pr AS (
  SELECT a.seg, sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2) AS dp, sqrt((c.x-d.x)**2 + (c.y-d.y)**2 + (c.z-d.z)**2) AS dt
  FROM cam a JOIN cam b ON a.seg = b.seg AND a.f < b.f JOIN tru c ON c.seg = a.seg AND c.f = a.f JOIN tru d ON d.seg = b.seg AND d.f = b.f
), r AS (SELECT seg, dt / dp AS r FROM pr WHERE dt > 0.05 AND dp > 1e-9), m AS (SELECT seg, quantile_cont(r, 0.5) AS scale, count(*) AS pairs FROM r GROUP BY seg
), s AS (SELECT seg, quantile_cont(abs(r - scale), 0.5) / greatest(any_value(scale), 1e-9) AS disp FROM r JOIN m USING (seg) GROUP BY seg), n AS (SELECT seg, count(*) AS n FROM cam GROUP BY seg)"""


@REG.add(
    "camera_scale",
    POSITIONS_SQL
    + """ SELECT seg, coalesce(pairs, 0) AS pairs, round(CASE WHEN pairs >= greatest(3, n // 10) THEN scale ELSE 1.0 END, 6) AS scale, round(CASE WHEN pairs >= greatest(3, n // 10) THEN disp END, 6) AS dispersion,
coalesce(pairs >= greatest(3, n // 10) AND disp <= 0.25, false) AS solved FROM n LEFT JOIN m USING (seg) LEFT JOIN s USING (seg)""",
)
def camera_scale(spark: SparkSession, where: str) -> DataFrame:
    """The scale between two camera paths, from the distances of all pairs of cameras of a segment."""
    at = lambda k: F.element_at("embedding", k).cast("double")
    cam = table(spark, where, "embeddings").select(F.expr("vec_id div 124").alias("seg"), F.expr("cast(vec_id % 124 as int)").alias("f"), at(1).alias("x"), at(2).alias("y"), at(3).alias("z"))
    tru = cam.select("seg", "f", (F.col("x") * 3).alias("x"), (F.col("y") * 3).alias("y"), (F.col("z") * 3 + (F.col("f") % 5) * 0.01).alias("z"))
    s = audit.camera_scale(cam, tru, "seg", "f")
    return s.select("seg", "pairs", F.round("scale", 6).alias("scale"), F.round("dispersion", 6).alias("dispersion"), "solved")


@REG.add(
    "blob_counts",
    PIXELS_SQL.replace("WITH vec", "WITH RECURSIVE vec", 1)
    + """, own AS (SELECT seg, ordinal, r * 8 + c AS p, r, c FROM px WHERE cls = 2), edge AS (SELECT a.seg, a.ordinal, a.p AS a, b.p AS b FROM own a JOIN own b ON a.seg = b.seg AND a.ordinal = b.ordinal AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1
), reach AS (SELECT seg, ordinal, a, b FROM edge UNION SELECT r.seg, r.ordinal, r.a, e.b FROM reach r JOIN edge e ON e.seg = r.seg AND e.ordinal = r.ordinal AND e.a = r.b
), blob AS (SELECT seg, ordinal, root, count(*) AS area FROM (SELECT seg, ordinal, a, min(b) AS root FROM reach GROUP BY ALL) GROUP BY ALL)
SELECT seg, ordinal, count(*) AS blobs, max(area) AS largest FROM blob GROUP BY ALL""",
)
def blob_counts(spark: SparkSession, where: str) -> DataFrame:
    """Regions of one class in each frame that hang together over sides or corners."""
    return tracks.components(pixels(spark, where), 2, 8, 8).groupBy("seg", "ordinal").agg(F.count("*").alias("blobs"), F.max("area").alias("largest"))


@REG.add(
    "bounding_boxes",
    PIXELS_SQL + ' SELECT seg, ordinal, cls, round(min(c) / 8.0, 3) AS x0, round(min(r) / 8.0, 3) AS y0, round((max(c) + 1) / 8.0, 3) AS x1, round((max(r) + 1) / 8.0, 3) AS y1 FROM px GROUP BY seg, ordinal, cls',
)
def bounding_boxes(spark: SparkSession, where: str) -> DataFrame:
    p = pixels(spark, where).groupBy("seg", "ordinal", "cls")
    return p.agg(F.round(F.min("c") / 8.0, 3).alias("x0"), F.round(F.min("r") / 8.0, 3).alias("y0"), F.round((F.max("c") + 1) / 8.0, 3).alias("x1"), F.round((F.max("r") + 1) / 8.0, 3).alias("y1"))


@REG.add("protagonist")
def protagonist(spark: SparkSession, where: str) -> DataFrame:
    """The track that the camera follows in each segment, or why none is named."""
    p = pixels(spark, where)
    linked = tracks.link(tracks.components(p, 2, 8, 8), 8, 8, tracks.Prior(area=0.01, link=0.3))
    return tracks.protagonist(linked, p.groupBy("seg").agg(F.count_distinct("ordinal").alias("n")), 8, 8, tracks.Prior(area=0.01, link=0.3))


MASKS_SQL = PIXELS_SQL + """, mask AS (
  SELECT seg, ordinal, 0 AS object, r, c, cls FROM px WHERE r < 5 UNION ALL SELECT seg, ordinal, 1, r, c, cls FROM px WHERE c < 4 AND ordinal % 4 <> 1
  UNION ALL SELECT seg, ordinal, 2, r, c, cls FROM px WHERE r >= 3 AND c >= 3 AND ordinal % 3 <> 0 UNION ALL SELECT seg, ordinal, 3, r, c, cls FROM px WHERE (r + c) % 5 = 0
), v AS (SELECT seg, object, cls, count(*) AS n FROM mask GROUP BY ALL), won AS (SELECT seg, object, cls, n AS votes FROM v QUALIFY row_number() OVER (PARTITION BY seg, object ORDER BY n DESC, cls) = 1
), area AS (SELECT seg, ordinal, object, count(*) AS a FROM mask GROUP BY ALL
), own AS (SELECT seg, ordinal, r, c, object FROM mask JOIN area USING (seg, ordinal, object) QUALIFY row_number() OVER (PARTITION BY seg, ordinal, r, c ORDER BY a, object DESC) = 1)"""


def _masks(p: DataFrame) -> DataFrame:
    """Masks that overlap, come and go: what a model that follows regions gives."""
    r, c, o = F.col("r"), F.col("c"), F.col("ordinal")
    held = F.array_compact(F.array(F.when(r < 5, 0), F.when((c < 4) & (o % 4 != 1), 1), F.when((r >= 3) & (c >= 3) & (o % 3 != 0), 2), F.when((r + c) % 5 == 0, 3)))
    return p.select("seg", "ordinal", "r", "c", F.explode(held).alias("object"))


@REG.add("masklet_classes", MASKS_SQL + " SELECT seg, object, cls, votes FROM won")
def masklet_classes(spark: SparkSession, where: str) -> DataFrame:
    """The class that each mask votes for over its whole clip."""
    p = pixels(spark, where)
    return tracks.mask_classes(p, _masks(p))


@REG.add(
    "masklet_compose",
    MASKS_SQL
    + """, n AS (SELECT px.seg, px.ordinal, coalesce(won.cls, px.cls) AS cls, won.cls IS NOT NULL AS held FROM px LEFT JOIN own USING (seg, ordinal, r, c) LEFT JOIN won ON won.seg = own.seg AND won.object = own.object)
SELECT seg, cls, count(*) AS pixels, count(*) FILTER (held) AS held FROM n GROUP BY seg, cls""",
)
def masklet_compose(spark: SparkSession, where: str) -> DataFrame:
    """Each mask's class over its pixels; where masks overlap the smallest has the pixel."""
    p = pixels(spark, where)
    return tracks.composed(p, _masks(p)).groupBy("seg", "cls").agg(F.count("*").alias("pixels"), F.count_if("held").alias("held"))


BLOB_SQL = """, mine AS (SELECT seg, ordinal, r * 8 + c AS p, r, c FROM px WHERE cls = 3), edge AS (SELECT a.seg, a.ordinal, a.p AS a, b.p AS b FROM mine a JOIN mine b ON a.seg = b.seg AND a.ordinal = b.ordinal AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1
), reach AS (SELECT seg, ordinal, a, b FROM edge UNION SELECT r.seg, r.ordinal, r.a, e.b FROM reach r JOIN edge e ON e.seg = r.seg AND e.ordinal = r.ordinal AND e.a = r.b
), blob AS (SELECT seg, ordinal, a, min(b) AS root FROM reach GROUP BY ALL)"""


@REG.add(
    "masklet_seeds",
    MASKS_SQL.replace("WITH vec", "WITH RECURSIVE vec", 1)
    + BLOB_SQL
    + """, x AS (SELECT b.seg, b.ordinal, b.root, coalesce(won.cls = 3, false) AS ok FROM blob b LEFT JOIN own o ON o.seg = b.seg AND o.ordinal = b.ordinal AND o.r * 8 + o.c = b.a LEFT JOIN won ON won.seg = o.seg AND won.object = o.object)
SELECT seg, ordinal, count(*) AS seeds FROM (SELECT seg, ordinal, root FROM x GROUP BY ALL HAVING avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) < 0.5) GROUP BY ALL""",
)
def masklet_seeds(spark: SparkSession, where: str) -> DataFrame:
    """Regions of a class that no mask of that class covers."""
    p = pixels(spark, where)
    m = _masks(p)
    held = tracks.owners(m).join(tracks.mask_classes(p, m).select("seg", "object", "cls"), ["seg", "object"])
    blobs = tracks.blob_pixels(p, 3, 8, 8).withColumn("cls", F.lit(3))
    return tracks.seeds(p, blobs, held).groupBy("seg", "ordinal").agg(F.count("*").alias("seeds"))


@REG.add(
    "clip_completeness",
    """WITH s AS (SELECT 'seg_' || split_part(seg, '_', 2) AS scene, CAST(split_part(seg, '_', 3) AS INT) AS idx, max(frames) AS frames FROM seg_stats GROUP BY ALL
), w AS (SELECT scene, idx, count(*) AS any_, count(DISTINCT k) FILTER (k >= 0 AND k < frames) AS held FROM windows JOIN s USING (scene, idx) GROUP BY ALL)
SELECT scene, idx, CASE WHEN any_ IS NULL THEN 'missing' WHEN frames IS NULL THEN 'unknown' WHEN held = frames THEN 'complete' ELSE 'incomplete' END AS status FROM s LEFT JOIN w USING (scene, idx)""",
)
def clip_completeness(spark: SparkSession, where: str) -> DataFrame:
    """What is promised against what is there: complete is a clip that holds every number from 0 to frames - 1; others don't
    make up for a hole."""
    seg = F.col("seg")
    s = table(spark, where, "seg_stats").groupBy(clip_scene(seg).alias("scene"), clip_index(seg).alias("idx")).agg(F.max("frames").alias("frames"))
    held = table(spark, where, "windows").select("scene", "idx", "k").distinct().join(s, ["scene", "idx"])
    w = held.groupBy("scene", "idx").agg(F.count_if((F.col("k") >= 0) & (F.col("k") < F.col("frames"))).alias("held"))
    status = F.when(F.col("held").isNull(), "missing").when(F.col("frames").isNull(), "unknown").when(F.col("held") == F.col("frames"), "complete").otherwise("incomplete")
    return s.join(w, ["scene", "idx"], "left").select("scene", "idx", status.alias("status"))


@REG.add(
    "complete_through",
    """WITH n AS (SELECT scene, idx, k, src_file IS NOT NULL AS kept, ordinal IS NOT NULL AS timed FROM windows WHERE k >= 0), s AS (SELECT DISTINCT scene, idx, k, 'file' AS stream FROM n WHERE kept UNION ALL SELECT DISTINCT scene, idx, k, 'ordinal' FROM n WHERE timed
), i AS (SELECT *, row_number() OVER (PARTITION BY scene, idx, stream ORDER BY k) - 1 AS i FROM s), c AS (SELECT scene, idx, stream, count(*) FILTER (i = k) AS held FROM i GROUP BY ALL
), a AS (SELECT scene, idx, min(held) AS through, count(*) AS streams FROM c GROUP BY ALL), d AS (SELECT scene, idx, count(*) AS late FROM windows JOIN a USING (scene, idx) WHERE k >= CASE WHEN streams = 2 THEN through ELSE 0 END GROUP BY ALL)
SELECT scene, idx, CASE WHEN streams = 2 THEN through ELSE 0 END AS through, coalesce(late, 0) AS discarded FROM a LEFT JOIN d USING (scene, idx)""",
)
def complete_through(spark: SparkSession, where: str) -> DataFrame:
    """How far every stream of a clip (its files, its ordinals) has come without a hole, and how many rows a resumed run
    discards from there."""
    w = table(spark, where, "windows").select("scene", "idx", "k", "src_file", "ordinal")
    both = [w.filter(F.col(c).isNotNull()).select("scene", "idx", F.lit(c).alias("stream"), "k") for c in ("src_file", "ordinal")]
    each = both[0].unionByName(both[1]).withColumn("clip", F.struct("scene", "idx", "stream"))
    c = audit.contiguous(each, "clip", "k").groupBy("clip.scene", "clip.idx").agg(F.min("prefix").alias("p"), F.count("*").alias("n"))
    c = c.select("scene", "idx", F.when(F.col("n") == 2, F.col("p")).otherwise(0).alias("through"))
    late = w.join(c, ["scene", "idx"]).filter(F.col("k") >= F.col("through")).groupBy("scene", "idx").agg(F.count("*").alias("late"))
    return c.join(late, ["scene", "idx"], "left").select("scene", "idx", "through", F.coalesce("late", F.lit(0)).alias("discarded"))
