"""Queries over frame sequences and pixel planes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipstrata.functions import encode
from clipstrata.operators import grid, temporal
from clipstrata.plans import windows
from clipstrata.queries import Registry
from clipstrata.sources.tables import FRAMES_SQL, PIXELS_SQL, frames, pixels, table

REG = Registry()

RUNS_SQL = """, s AS (
  SELECT *, CASE WHEN cls = lag(cls) OVER w THEN 0 ELSE 1 END AS st FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal)
), r AS (SELECT *, sum(st) OVER (PARTITION BY ep ORDER BY ordinal) AS run FROM s
), n AS (SELECT *, count(*) OVER (PARTITION BY ep, run) AS len, count(*) OVER (PARTITION BY ep) AS total FROM r
), k AS (SELECT *, CASE WHEN len >= 2 THEN cls END AS keep FROM n
), steady AS (
  SELECT ep, ordinal, cls, CASE WHEN total < 3 THEN cls ELSE coalesce(
    last_value(keep IGNORE NULLS) OVER (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(keep IGNORE NULLS) OVER (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), cls) END AS fixed FROM k
)"""


@REG.add(
    "flicker_before_after",
    FRAMES_SQL
    + RUNS_SQL
    + """, d AS (
  SELECT ep, CASE WHEN cls <> lag(cls) OVER w THEN 1 ELSE 0 END AS b, CASE WHEN fixed <> lag(fixed) OVER w THEN 1 ELSE 0 END AS a, lag(cls) OVER w AS prev
  FROM steady WINDOW w AS (PARTITION BY ep ORDER BY ordinal)
) SELECT ep, count(*) AS compared, round(sum(b) / count(*), 9) AS flicker_before, round(sum(a) / count(*), 9) AS flicker_after FROM d WHERE prev IS NOT NULL GROUP BY ep""",
)
def flicker_before_after(spark: SparkSession, where: str) -> DataFrame:
    """How often the class changes from frame to frame, before and after short runs are suppressed."""
    f = temporal.suppress_short_runs(frames(spark, where), "ep", "ordinal", "cls", "fixed")
    w = temporal.ordered("ep", "ordinal")
    d = f.select("ep", (F.col("cls") != F.lag("cls").over(w)).cast("int").alias("b"), (F.col("fixed") != F.lag("fixed").over(w)).cast("int").alias("a"))
    return d.filter("b IS NOT NULL").groupBy("ep").agg(
        F.count("*").alias("compared"), F.round(F.avg("b"), 9).alias("flicker_before"), F.round(F.avg("a"), 9).alias("flicker_after")
    )


@REG.add(
    "flicker_rate",
    FRAMES_SQL
    + """, d AS (SELECT ep, cls, lag(cls) OVER (PARTITION BY ep ORDER BY ordinal) AS p FROM frames)
SELECT ep, count(*) AS compared, count(*) FILTER (p <> cls) AS changed, round(count(*) FILTER (p <> cls) / count(*), 9) AS flicker FROM d WHERE p IS NOT NULL GROUP BY ep""",
)
def flicker_rate(spark: SparkSession, where: str) -> DataFrame:
    return temporal.flicker(frames(spark, where), "ep", "ordinal", "cls").withColumn("flicker", F.round("flicker", 9))


@REG.add("suppress_short_runs", FRAMES_SQL + RUNS_SQL + " SELECT ep, ordinal, cls, fixed FROM steady")
def suppress_short_runs(spark: SparkSession, where: str) -> DataFrame:
    return temporal.suppress_short_runs(frames(spark, where), "ep", "ordinal", "cls", "fixed").select("ep", "ordinal", "cls", "fixed")


@REG.add(
    "label_vote",
    FRAMES_SQL
    + """, v AS (
  SELECT ep, ordinal, """
    + ", ".join(f"sum(CASE WHEN cls = {k} THEN 1 ELSE 0 END) OVER w + CASE WHEN cls = {k} THEN 1 ELSE 0 END AS v{k}" for k in range(5))
    + """ FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
) SELECT ep, ordinal, CAST(list_position([v0, v1, v2, v3, v4], greatest(v0, v1, v2, v3, v4)) - 1 AS INT) AS voted FROM v""",
)
def label_vote(spark: SparkSession, where: str) -> DataFrame:
    w = temporal.ordered("ep", "ordinal")
    return frames(spark, where).select("ep", "ordinal", temporal.vote(F.col("cls"), w, 2, 5).alias("voted"))


@REG.add(
    "depth_window_median",
    FRAMES_SQL
    + """ SELECT ep, ordinal, round(coalesce(quantile_cont(CASE WHEN depth > 0 THEN depth END, 0.5) OVER (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 0), 6) AS median
FROM frames""",
)
def depth_window_median(spark: SparkSession, where: str) -> DataFrame:
    w = temporal.ordered("ep", "ordinal")
    return frames(spark, where).select("ep", "ordinal", F.round(temporal.window_median(F.col("depth"), w, 2), 6).alias("median"))


@REG.add(
    "stabilise_pair",
    FRAMES_SQL
    + """, v AS (
  SELECT ep, ordinal, coalesce(quantile_cont(CASE WHEN depth > 0 THEN depth END, 0.5) OVER w, 0) AS med, """
    + ", ".join(f"sum(CASE WHEN cls = {k} THEN 1 ELSE 0 END) OVER w + CASE WHEN cls = {k} THEN 1 ELSE 0 END AS v{k}" for k in range(5))
    + """ FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
), voted AS (SELECT ep, ordinal, med, list_position([v0, v1, v2, v3, v4], greatest(v0, v1, v2, v3, v4)) - 1 AS cls FROM v
), s AS (SELECT *, CASE WHEN cls = lag(cls) OVER w THEN 0 ELSE 1 END AS st FROM voted WINDOW w AS (PARTITION BY ep ORDER BY ordinal)
), r AS (SELECT *, sum(st) OVER (PARTITION BY ep ORDER BY ordinal) AS run FROM s
), n AS (SELECT *, count(*) OVER (PARTITION BY ep, run) AS len, count(*) OVER (PARTITION BY ep) AS total FROM r
), k AS (SELECT *, CASE WHEN len >= 2 THEN cls END AS keep FROM n)
SELECT ep, ordinal, round(med, 6) AS depth, CAST(CASE WHEN total < 3 THEN cls ELSE coalesce(
    last_value(keep IGNORE NULLS) OVER (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(keep IGNORE NULLS) OVER (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), cls) END AS INT) AS cls FROM k""",
)
def stabilise_pair(spark: SparkSession, where: str) -> DataFrame:
    """Vote and median over one shared window, then short runs suppressed."""
    w = temporal.ordered("ep", "ordinal")
    x = frames(spark, where).select("ep", "ordinal", temporal.window_median(F.col("depth"), w, 2).alias("depth"), temporal.vote(F.col("cls"), w, 2, 5).alias("voted"))
    x = temporal.suppress_short_runs(x, "ep", "ordinal", "voted", "cls")
    return x.select("ep", "ordinal", F.round("depth", 6).alias("depth"), "cls")


TREND_SQL = """, t AS (
  SELECT ep, ordinal, ln(depth) AS y, coalesce(regr_intercept(ln(depth), ordinal) OVER w + ordinal * regr_slope(ln(depth), ordinal) OVER w, ln(depth)) AS line
  FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)
)"""


@REG.add("scale_trend_residual", FRAMES_SQL + TREND_SQL + " SELECT ep, ordinal, round(y - line, 6) AS residual FROM t")
def scale_trend_residual(spark: SparkSession, where: str) -> DataFrame:
    """The log depth of each frame less the local straight line."""
    f = frames(spark, where).withColumn("y", F.ln("depth"))
    return f.select("ep", "ordinal", F.round(F.col("y") - temporal.trend("y", "ordinal", temporal.ordered("ep", "ordinal"), 12), 6).alias("residual"))


@REG.add(
    "scale_correction",
    FRAMES_SQL
    + TREND_SQL
    + """, z AS (SELECT ep, ordinal, y - line AS res FROM t), c AS (SELECT ep, ordinal, greatest(least(-(res - avg(res) OVER (PARTITION BY ep)), 0.25), -0.25) AS x FROM z)
SELECT ep, ordinal, round(x, 6) AS correction FROM c""",
)
def scale_correction(spark: SparkSession, where: str) -> DataFrame:
    """The clamped log correction that would take the residual out."""
    f = frames(spark, where).withColumn("y", F.ln("depth"))
    r = f.withColumn("res", F.col("y") - temporal.trend("y", "ordinal", temporal.ordered("ep", "ordinal"), 12))
    x = -(F.col("res") - F.avg("res").over(Window.partitionBy("ep")))
    return r.select("ep", "ordinal", F.round(F.greatest(F.least(x, F.lit(0.25)), F.lit(-0.25)), 6).alias("correction"))


RECENTRE = ""
for _i in range(4):
    _src = "c" if _i == 0 else f"p{_i - 1}"
    RECENTRE += f""", m{_i} AS (SELECT ep, ordinal, x, avg(x) OVER w AS m, sum(CASE WHEN abs(x) < 0.25 THEN 1 ELSE 0 END) OVER w AS f, count(*) OVER w AS n FROM {_src} WINDOW w AS (PARTITION BY ep)
), p{_i} AS (SELECT ep, ordinal, CASE WHEN m = 0 OR f = 0 THEN x ELSE greatest(least(CASE WHEN abs(x) < 0.25 THEN x - m * n / greatest(f, 1) ELSE x END, 0.25), -0.25) END AS x FROM m{_i})"""


@REG.add(
    "scale_recentred",
    FRAMES_SQL
    + TREND_SQL
    + ", z AS (SELECT ep, ordinal, y - line AS res FROM t), c AS (SELECT ep, ordinal, greatest(least(-(res - avg(res) OVER (PARTITION BY ep)), 0.25), -0.25) AS x FROM z)"
    + RECENTRE
    + " SELECT ep, count(*) AS n, round(max(abs(exp(x - m) - 1)), 5) AS most FROM (SELECT ep, x, avg(x) OVER (PARTITION BY ep) AS m FROM p3) GROUP BY ep",
)
def scale_recentred(spark: SparkSession, where: str) -> DataFrame:
    """The largest factor after the corrections were brought to mean zero without passing the limit."""
    f = frames(spark, where).withColumn("y", F.ln("depth"))
    r = f.withColumn("res", F.col("y") - temporal.trend("y", "ordinal", temporal.ordered("ep", "ordinal"), 12))
    x = -(F.col("res") - F.avg("res").over(Window.partitionBy("ep")))
    c = r.select("ep", "ordinal", F.greatest(F.least(x, F.lit(0.25)), F.lit(-0.25)).alias("x"))
    return temporal.recentred(c, "ep", "x").groupBy("ep").agg(F.count("*").alias("n"), F.round(F.max(F.abs(F.exp("x") - 1)), 5).alias("most"))


@REG.add(
    "jitter_flash",
    FRAMES_SQL
    + """, d AS (
  SELECT ep, abs(lag(depth) OVER w - 2 * depth + lead(depth) OVER w) AS j, abs(depth - lag(depth) OVER w) AS step,
    CASE WHEN lag(cls, 3) OVER w IS NOT NULL AND lead(cls, 3) OVER w IS NOT NULL THEN CASE WHEN lag(cls, 3) OVER w = lead(cls, 3) OVER w AND cls <> lag(cls, 3) OVER w THEN 1 ELSE 0 END END AS f
  FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal)
) SELECT ep, round(avg(j), 4) AS depth_jitter, round(max(j), 4) AS depth_jitter_max, round(max(step), 3) AS step_max, round(avg(f), 6) AS semantic_flicker FROM d GROUP BY ep""",
)
def jitter_flash(spark: SparkSession, where: str) -> DataFrame:
    w = temporal.ordered("ep", "ordinal")
    d = frames(spark, where).select(
        "ep", temporal.second_difference(F.col("depth"), w).alias("j"), F.abs(F.col("depth") - F.lag("depth").over(w)).alias("step"), temporal.flash("cls", w, 3).alias("f")
    )
    return d.groupBy("ep").agg(
        F.round(F.avg("j"), 4).alias("depth_jitter"), F.round(F.max("j"), 4).alias("depth_jitter_max"), F.round(F.max("step"), 3).alias("step_max"), F.round(F.avg("f"), 6).alias("semantic_flicker")
    )


@REG.add(
    "clip_scores",
    PIXELS_SQL
    + """, lab AS (SELECT seg, cls, lag(cls) OVER (PARTITION BY seg, r, c ORDER BY ordinal) AS p FROM px
), ch AS (SELECT seg, round(avg(CASE WHEN cls <> p THEN 1.0 ELSE 0.0 END), 6) AS semantic_flicker FROM lab WHERE p IS NOT NULL GROUP BY seg
), med AS (SELECT seg, ordinal, ln(quantile_cont(CASE WHEN depth > 1e-3 THEN depth END, 0.5)) AS m FROM px GROUP BY seg, ordinal
), st AS (SELECT seg, abs(m - lag(m) OVER (PARTITION BY seg ORDER BY ordinal)) AS s FROM med
), j AS (SELECT seg, round(quantile_cont(s, 0.5), 6) AS depth_jitter FROM st GROUP BY seg)
SELECT seg, semantic_flicker, depth_jitter FROM ch JOIN j USING (seg)""",
)
def clip_scores(spark: SparkSession, where: str) -> DataFrame:
    """Share of pixels that change class from frame to frame; median step of the log of the median depth."""
    p = pixels(spark, where)
    w = Window.partitionBy("seg", "r", "c").orderBy("ordinal")
    lab = p.select("seg", (F.col("cls") != F.lag("cls").over(w)).cast("double").alias("x")).filter("x IS NOT NULL")
    ch = lab.groupBy("seg").agg(F.round(F.avg("x"), 6).alias("semantic_flicker"))
    med = p.groupBy("seg", "ordinal").agg(F.ln(F.percentile(F.when(F.col("depth") > 1e-3, F.col("depth")), 0.5)).alias("m"))
    s = med.select("seg", F.abs(F.col("m") - F.lag("m").over(Window.partitionBy("seg").orderBy("ordinal"))).alias("s"))
    return ch.join(s.groupBy("seg").agg(F.round(F.percentile("s", 0.5), 6).alias("depth_jitter")), "seg")


@REG.add(
    "frame_log_ratios",
    PIXELS_SQL
    + """, b AS (SELECT seg, ordinal, depth AS d, lag(depth) OVER w AS p, lag(ordinal) OVER w AS o FROM px WINDOW w AS (PARTITION BY seg, r, c ORDER BY ordinal)
), m AS (SELECT seg, ordinal, count(*) AS a, count(*) FILTER (d > 0 AND p > 0 AND o = ordinal - 1) AS n,
  quantile_cont(CASE WHEN d > 0 AND p > 0 AND o = ordinal - 1 THEN ln(d) - ln(p) END, 0.5) AS r FROM b GROUP BY seg, ordinal)
SELECT seg, ordinal, round(CASE WHEN n >= a * 0.05 AND n > 0 THEN r ELSE 0 END, 6) AS ratio FROM m""",
)
def frame_log_ratios(spark: SparkSession, where: str) -> DataFrame:
    return temporal.log_ratios(pixels(spark, where), "seg", "ordinal", "depth", ["r", "c"]).withColumn("ratio", F.round("ratio", 6))


CODE_SQL = "(ln(256.0) - ln(least(greatest(depth, {near}), {far}))) / (ln({far}) - ln({near}))"


@REG.add(
    "depth_code_u16",
    FRAMES_SQL
    + """, q AS (SELECT ep, ordinal, CAST(CASE WHEN depth > 1e-3 THEN floor((ln(256.0) - ln(least(greatest(depth, 0.3), 256.0))) / (ln(256.0) - ln(0.3)) * 65535 + 0.5) ELSE 0 END AS INT) AS code FROM frames)
SELECT ep, ordinal, code, round(CASE WHEN code > 0 THEN exp(ln(256.0) - code / 65535.0 * (ln(256.0) - ln(0.3))) ELSE 0 END, 4) AS back FROM q""",
)
def depth_code_u16(spark: SparkSession, where: str) -> DataFrame:
    q = frames(spark, where).select("ep", "ordinal", encode.code16(F.col("depth")).alias("code"))
    return q.withColumn("back", F.round(encode.metres_of_code16(F.col("code")), 4))


@REG.add(
    "depth_grey8",
    FRAMES_SQL
    + """, q AS (SELECT ep, ordinal, depth, round_even((ln(256.0) - ln(least(greatest(depth, 0.1), 256.0))) / (ln(256.0) - ln(0.1)) * 65535, 0) AS q FROM frames
), g AS (SELECT ep, ordinal, CAST(CASE WHEN depth > 1e-3 AND q > 0 THEN greatest(1, round_even(q * 255.0 / 65535.0, 0)) ELSE 0 END AS INT) AS grey FROM q)
SELECT ep, ordinal, grey, round(CASE WHEN grey > 0 THEN exp(ln(256.0) - grey / 255.0 * (ln(256.0) - ln(0.1))) ELSE 0 END, 4) AS back FROM g""",
)
def depth_grey8(spark: SparkSession, where: str) -> DataFrame:
    g = frames(spark, where).select("ep", "ordinal", encode.grey8(F.col("depth")).alias("grey"))
    return g.withColumn("back", F.round(encode.metres_of_grey8(F.col("grey")), 4))


def _case(x: str, values: tuple[int, ...]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


DUV_SQL = PIXELS_SQL + f""", e AS (SELECT seg, ordinal, r, c, depth, cls, {_case("cls", encode.TWELVE_TO_ELEVEN)} AS e FROM px
), duv AS (SELECT seg, ordinal, r, c, e, CAST(CASE WHEN depth <= 1e-3 OR e = 0 THEN 255 ELSE round_even((1 - (ln(8000.0) - ln(least(greatest(depth, 0.1), 8000.0))) / (ln(8000.0) - ln(0.1))) * 254, 0) END AS INT) AS red,
  {_case("e", tuple(x[0] for x in encode.GREEN_BLUE))} AS green, {_case("e", tuple(x[1] for x in encode.GREEN_BLUE))} AS blue FROM e
), grp AS (SELECT *, CASE green * 256 + blue WHEN 65535 THEN CASE WHEN red = 255 THEN 2 ELSE 1 END WHEN 255 THEN 3 WHEN 128 THEN 4 WHEN 16384 THEN 5 WHEN 32768 THEN 6 WHEN 65280 THEN 7 ELSE 0 END AS g FROM duv)"""


def duv(spark: SparkSession, where: str) -> DataFrame:
    p = pixels(spark, where).withColumn("e", encode.lookup(F.col("cls"), encode.TWELVE_TO_ELEVEN))
    g, b = encode.duv_green_blue(F.col("e"))
    return p.select("seg", "ordinal", "r", "c", "e", encode.duv_red(F.col("depth"), F.col("e")).alias("red"), g.alias("green"), b.alias("blue"))


@REG.add("duv_compose", DUV_SQL + " SELECT seg, ordinal, r, c, red, green, blue FROM duv")
def duv_compose(spark: SparkSession, where: str) -> DataFrame:
    return duv(spark, where).select("seg", "ordinal", "r", "c", "red", "green", "blue")


@REG.add(
    "duv_groups",
    DUV_SQL
    + " SELECT seg, g, count(*) AS pixels, round(sum(CASE WHEN red < 255 THEN 0.1 * pow(80000.0, red / 254.0) END), 2) AS metres FROM grp GROUP BY seg, g",
)
def duv_groups(spark: SparkSession, where: str) -> DataFrame:
    """The composite read back: pixels of each group and the sum of their depths."""
    d = duv(spark, where).withColumn("g", encode.duv_group(F.col("red"), F.col("green"), F.col("blue")))
    return d.groupBy("seg", "g").agg(F.count("*").alias("pixels"), F.round(F.sum(encode.metres_of_duv(F.col("red"))), 2).alias("metres"))


@REG.add(
    "class_lookups",
    f"""SELECT CAST(i AS INT) AS id, {_case("least(greatest(i, 0), 11)", encode.TWELVE_TO_ELEVEN)} AS eleven, {_case("least(greatest(i, 0), 10)", encode.ELEVEN_TO_TWELVE)} AS twelve,
{_case("least(greatest(i, 0), 11)", encode.TWELVE_TO_SIX)} AS six, CASE WHEN i BETWEEN 0 AND 11 THEN {_case("i", encode.TWELVE_TO_SIX)} ELSE 0 END AS six_or_void FROM range(-2, 20) t(i)""",
)
def class_lookups(spark: SparkSession, where: str) -> DataFrame:
    i = F.col("id")
    ids = spark.range(-2, 20).select(i.cast("int").alias("id"))
    return ids.select(
        "id", encode.lookup(i, encode.TWELVE_TO_ELEVEN).alias("eleven"), encode.lookup(i, encode.ELEVEN_TO_TWELVE).alias("twelve"), encode.lookup(i, encode.TWELVE_TO_SIX).alias("six"),
        encode.lookup_or_void(i, encode.TWELVE_TO_SIX).alias("six_or_void"),
    )


@REG.add(
    "priority_overlay",
    PIXELS_SQL
    + f" SELECT seg, ordinal, r, c, CAST(CASE WHEN depth > 2 AND {_case('frame_cls', encode.PRIORITY)} > {_case('cls', encode.PRIORITY)} THEN frame_cls ELSE cls END AS INT) AS cls FROM px",
)
def priority_overlay(spark: SparkSession, where: str) -> DataFrame:
    p = pixels(spark, where)
    return p.select("seg", "ordinal", "r", "c", encode.overlay(F.col("cls"), F.col("frame_cls").cast("int"), F.col("depth") > 2).cast("int").alias("cls"))


@REG.add(
    "class_uv_table",
    "SELECT CAST(i AS INT) AS id, [32, 96, 160, 224][i % 4 + 1] AS u, [43, 128, 213][i // 4 + 1] AS v FROM range(12) t(i)",
)
def class_uv_table(spark: SparkSession, where: str) -> DataFrame:
    # The places of the twelve classes on the chroma grid.
    i = F.col("id").cast("int")
    u, v = F.array(*map(F.lit, (32, 96, 160, 224))), F.array(*map(F.lit, (43, 128, 213)))
    return spark.range(12).select(i.alias("id"), F.element_at(u, i % 4 + 1).alias("u"), F.element_at(v, F.floor(i / 4).cast("int") + 1).alias("v"))


@REG.add(
    "block_reduce",
    PIXELS_SQL
    + """ SELECT seg, ordinal, r // 2 AS br, c // 2 AS bc, round(coalesce(quantile_cont(CASE WHEN depth > 1e-3 THEN depth END, 0.5), 0), 6) AS median,
round(coalesce(min(CASE WHEN depth > 1e-3 THEN depth END), 0), 6) AS least, round(coalesce(avg(CASE WHEN depth > 1e-3 THEN depth END), 0), 6) AS mean FROM px GROUP BY ALL""",
)
def block_reduce(spark: SparkSession, where: str) -> DataFrame:
    b = grid.block_depth(pixels(spark, where), ["seg", "ordinal"], "depth", 2, 2)
    return b.select("seg", "ordinal", "br", "bc", *[F.round(x, 6).alias(x) for x in ("median", "least", "mean")])


@REG.add(
    "block_vote",
    PIXELS_SQL
    + """, n AS (SELECT seg, ordinal, r // 2 AS br, c // 2 AS bc, cls, count(*) AS n FROM px GROUP BY ALL)
SELECT seg, ordinal, br, bc, cls FROM n QUALIFY row_number() OVER (PARTITION BY seg, ordinal, br, bc ORDER BY n DESC, cls) = 1""",
)
def block_vote(spark: SparkSession, where: str) -> DataFrame:
    return grid.block_vote(pixels(spark, where), ["seg", "ordinal"], "cls", 2, 2, 12)


@REG.add(
    "nearest_resize",
    PIXELS_SQL
    + """, t AS (SELECT CAST(a.i AS INT) AS r2, CAST(b.i AS INT) AS c2 FROM range(6) a(i), range(12) b(i))
SELECT seg, ordinal, r2 AS r, c2 AS c, cls FROM px JOIN t ON px.r = (r2 * 8) // 6 AND px.c = (c2 * 8) // 12""",
)
def nearest_resize(spark: SparkSession, where: str) -> DataFrame:
    return grid.nearest(pixels(spark, where), ["seg", "ordinal"], 8, 8, 6, 12, ["cls"])


EPISODES_SQL = FRAMES_SQL + ", eps AS (SELECT ep, count(*) AS n, 30.0 AS fps FROM frames GROUP BY ep)"
PLAN_SQL = EPISODES_SQL + """, b AS (SELECT ep, n, CAST(round_even(7 * 1.25, 0) AS BIGINT) + 1 AS span, n // 5 AS bucket FROM eps
), w AS (SELECT b.ep, n, CAST(i.i AS INT) AS idx, i.i * bucket + (bucket - span) // 2 AS start FROM b, range(5) i(i) WHERE span <= bucket
), plan AS (SELECT ep, n, idx, CAST(k.k AS INT) AS k, CAST(start + round_even(k.k * 1.25, 0) AS BIGINT) AS ordinal FROM w, range(8) k(k))"""


def _episodes(spark: SparkSession, where: str) -> DataFrame:
    return frames(spark, where).groupBy("ep").agg(F.count("*").alias("n"), F.lit(30.0).alias("fps"))


@REG.add("plan_windows", PLAN_SQL + " SELECT ep, idx, k, ordinal FROM plan")
def plan_windows(spark: SparkSession, where: str) -> DataFrame:
    return windows.plan_windows(_episodes(spark, where), "ep", "n", "fps", length=8)


@REG.add(
    "window_halo",
    PLAN_SQL
    + """, e AS (SELECT ep, idx, min(n) AS n, min(ordinal) AS a, max(ordinal) AS b FROM plan GROUP BY ep, idx
), h AS (SELECT e.*, CAST(round_even(k.k * 1.25, 0) AS BIGINT) AS d FROM e, range(1, 5) k(k))
SELECT ep, idx, count(*) FILTER (a - d >= 0) AS "offset", count(*) FILTER (a - d >= 0) + count(*) FILTER (b + d < n) + 8 AS n FROM h GROUP BY ep, idx""",
)
def window_halo(spark: SparkSession, where: str) -> DataFrame:
    e = _episodes(spark, where)
    return windows.halo(windows.plan_windows(e, "ep", "n", "fps", length=8), e, "ep", "n", "fps", length=8, width=4)


@REG.add("window_frames", PLAN_SQL + " SELECT ep, idx, k, cls, depth FROM plan JOIN frames USING (ep, ordinal)")
def window_frames(spark: SparkSession, where: str) -> DataFrame:
    """The frames of each planned window, by an equi-join on their ordinals."""
    w = windows.plan_windows(_episodes(spark, where), "ep", "n", "fps", length=8)
    return frames(spark, where).join(w, ["ep", "ordinal"]).select("ep", "idx", "k", "cls", "depth")


@REG.add(
    "window_arithmetic",
    EPISODES_SQL
    + """, a AS (SELECT ep, n * 7 AS n FROM eps), c AS (SELECT ep, n, CASE WHEN n < 124 THEN 0 ELSE 1 + (n - 124) // 90 END AS windows FROM a)
SELECT ep, n, windows, CASE WHEN windows > 0 THEN 124 + 90 * (windows - 1) ELSE 0 END AS usable, n >= 124 AND n % 17 = 5 AS deliverable, n - ((n - 5) % 17 + 17) % 17 AS largest,
floor(n / 24.0 * 100) / 100 AS seconds FROM c""",
)
def window_arithmetic(spark: SparkSession, where: str) -> DataFrame:
    n = F.col("n")
    a = _episodes(spark, where).select("ep", (n * 7).alias("n"))
    return a.select("ep", "n", windows.window_count(n).alias("windows"), windows.usable(n).alias("usable"), windows.deliverable(n).alias("deliverable"), windows.largest_deliverable(n).alias("largest"), windows.seconds_for(n).alias("seconds"))


GRID_SQL = EPISODES_SQL + """, g0 AS (SELECT ep, n, n / 24.0 AS t, CAST(floor(n / 24.0 + 1e-9) AS INT) AS f FROM eps
), g1 AS (SELECT *, f + CASE WHEN f = 0 OR (t - f >= 0.5 - 1e-9 AND t - f > 1e-9) THEN 1 ELSE 0 END AS nb FROM g0
), grid AS (SELECT ep, CAST(b.b AS INT) AS bin, round(CAST(b.b AS DOUBLE), 3) AS start, round(CASE WHEN b.b = nb - 1 THEN t ELSE b.b + 1.0 END, 3) AS stop,
  CAST(round_even(b.b * 24.0, 0) AS BIGINT) AS first_frame, CASE WHEN b.b = nb - 1 THEN n ELSE CAST(round_even((b.b + 1) * 24.0, 0) AS BIGINT) END AS stop_frame FROM g1, range(200) b(b) WHERE b.b < nb)"""


def _grid(spark: SparkSession, where: str) -> DataFrame:
    return windows.second_grid(_episodes(spark, where).withColumn("rate", F.lit(24.0)), "ep", "n", "rate")


@REG.add("second_grid", GRID_SQL + " SELECT * FROM grid")
def second_grid(spark: SparkSession, where: str) -> DataFrame:
    return _grid(spark, where)


@REG.add(
    "grid_cut",
    GRID_SQL
    + """ SELECT ep, row_number() OVER (PARTITION BY ep ORDER BY bin) - 1 AS bin, round(start - min(start) OVER w, 3) AS start, round(stop - min(start) OVER w, 3) AS stop,
first_frame - min(first_frame) OVER w AS first_frame, stop_frame - min(first_frame) OVER w AS stop_frame FROM grid WHERE start >= 0.5 - 1e-9 AND stop <= 3.2 + 1e-9 WINDOW w AS (PARTITION BY ep)""",
)
def grid_cut(spark: SparkSession, where: str) -> DataFrame:
    return windows.cut_grid(_grid(spark, where), "ep", 0.5, 3.2)


@REG.add(
    "bin_evidence",
    GRID_SQL
    + """, j AS (SELECT f.*, g.bin, abs(depth - lag(depth) OVER (PARTITION BY f.ep ORDER BY ordinal)) AS d FROM frames f JOIN grid g ON f.ep = g.ep AND f.ordinal >= g.first_frame AND f.ordinal < g.stop_frame)
SELECT ep, bin, count(*) AS frames, round(avg(CASE WHEN cls = 4 THEN 1.0 ELSE 0.0 END), 3) AS view_frac, max(CASE WHEN cls = 2 THEN 1 ELSE 0 END) = 1 AS bought, round(coalesce(avg(d), 0), 3) AS motion,
coalesce(avg(d), 0) > 0.5 AS moving, quantile_disc(depth, 0.1) AS p10, quantile_disc(depth, 0.5) AS p50, quantile_disc(depth, 0.9) AS p90 FROM j GROUP BY ep, bin""",
)
def bin_evidence(spark: SparkSession, where: str) -> DataFrame:
    """What each second of an episode shows: shares, motion and percentiles that are values of the data."""
    w = temporal.ordered("ep", "ordinal")
    f = frames(spark, where).withColumn("d", F.abs(F.col("depth") - F.lag("depth").over(w)))
    f = windows.to_bins(f, _grid(spark, where), "ep", "ordinal")
    disc = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY depth)")
    motion = F.coalesce(F.avg("d"), F.lit(0.0))
    return f.groupBy("ep", "bin").agg(
        F.count("*").alias("frames"), F.round(F.avg((F.col("cls") == 4).cast("double")), 3).alias("view_frac"), F.bool_or(F.col("cls") == 2).alias("bought"), F.round(motion, 3).alias("motion"),
        (motion > 0.5).alias("moving"), disc(0.1).alias("p10"), disc(0.5).alias("p50"), disc(0.9).alias("p90"),
    )


@REG.add(
    "bins_covering",
    """WITH i AS (SELECT clip, least(x.start, x.stop) AS a, greatest(x.start, x.stop) AS b FROM (SELECT clip, unnest(issues) AS x FROM quality) WHERE x.start < x.stop OR x.stop < x.start
)
SELECT clip, a, b, CAST(unnest(range(CAST(floor(a) AS INT), CAST(ceil(b) AS INT))) AS INT) AS second FROM i""",
)
def bins_covering(spark: SparkSession, where: str) -> DataFrame:
    """The one-second bins that each issue overlaps (half-open), by arithmetic instead of an inequality join."""
    i = table(spark, where, "quality").select("clip", F.explode("issues").alias("x"))
    i = i.select("clip", F.least("x.start", "x.stop").alias("a"), F.greatest("x.start", "x.stop").alias("b")).filter(
        F.col("x.start").isNotNull() & F.col("x.stop").isNotNull() & (F.col("a") < F.col("b"))
    )
    return i.select("clip", "a", "b", F.explode(F.sequence(F.floor("a").cast("int"), F.ceil("b").cast("int") - 1)).alias("second"))


@REG.add(
    "duv_modes",
    DUV_SQL
    + """ SELECT seg, ordinal, r, c, CAST(CASE WHEN red = 255 THEN 255 ELSE round_even((ln(8000.0) - ln(least(greatest(depth, 0.1), 8000.0))) / (ln(8000.0) - ln(0.1)) * 254, 0) END AS INT) AS inverted,
CASE WHEN e = 3 AND ordinal % 2 = 1 THEN 128 ELSE green END AS green, CASE WHEN e = 3 AND ordinal % 2 = 1 THEN 0 ELSE blue END AS blue FROM (SELECT duv.*, px.depth FROM duv JOIN px USING (seg, ordinal, r, c))""",
)
def duv_modes(spark: SparkSession, where: str) -> DataFrame:
    """The composite with near and far the other way round, and with the own vehicle in its colour on driving frames."""
    p = pixels(spark, where).withColumn("e", encode.lookup(F.col("cls"), encode.TWELVE_TO_ELEVEN))
    g, b = encode.duv_green_blue(F.col("e"), F.col("ordinal") % 2 == 1)
    return p.select("seg", "ordinal", "r", "c", encode.duv_red(F.col("depth"), F.col("e"), inverted=True).alias("inverted"), g.alias("green"), b.alias("blue"))


@REG.add("calibrated_depth", PIXELS_SQL + " SELECT seg, ordinal, r, c, CASE WHEN depth > 0 AND cls <> 11 THEN depth * 1.5 + 0.25 ELSE 0 END AS metres FROM px")
def calibrated_depth(spark: SparkSession, where: str) -> DataFrame:
    """Depth brought to metres where it is valid, to its model as well."""
    return pixels(spark, where).select("seg", "ordinal", "r", "c", encode.calibrated(F.col("depth"), 1.5, 0.25, F.col("cls") != 11).alias("metres"))


@REG.add(
    "two_hop_reduce",
    PIXELS_SQL
    + """, t AS (SELECT CAST(a.i AS INT) AS r2, CAST(b.i AS INT) AS c2 FROM range(12) a(i), range(12) b(i)), n AS (SELECT seg, ordinal, r2 // 3 AS br, c2 // 3 AS bc, depth, cls FROM px JOIN t ON px.r = (r2 * 8) // 12 AND px.c = (c2 * 8) // 12
), d AS (SELECT seg, ordinal, br, bc, round(coalesce(quantile_cont(CASE WHEN depth > 1e-3 THEN depth END, 0.5), 0), 6) AS median FROM n GROUP BY ALL
), v AS (SELECT seg, ordinal, br, bc, cls FROM (SELECT seg, ordinal, br, bc, cls, count(*) AS n FROM n GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY seg, ordinal, br, bc ORDER BY n DESC, cls) = 1)
SELECT * FROM d JOIN v USING (seg, ordinal, br, bc)""",
)
def two_hop_reduce(spark: SparkSession, where: str) -> DataFrame:
    """Planes brought to a multiple of the grid by nearest pixels first, so that no value is invented, then reduced in blocks."""
    n = grid.nearest(pixels(spark, where), ["seg", "ordinal"], 8, 8, 12, 12, ["depth", "cls"])
    d = grid.block_depth(n, ["seg", "ordinal"], "depth", 3, 3).select("seg", "ordinal", "br", "bc", F.round("median", 6).alias("median"))
    return d.join(grid.block_vote(n, ["seg", "ordinal"], "cls", 3, 3, 12), ["seg", "ordinal", "br", "bc"])


@REG.add("id_frames", PIXELS_SQL + " SELECT seg, cls AS blue, 0 AS red, 0 AS green, count(*) AS n FROM px GROUP BY seg, cls")
def id_frames(spark: SparkSession, where: str) -> DataFrame:
    """Classes as frames for a lossless encoder: the id in blue alone."""
    red, green, blue = encode.id_frame(F.col("cls"))
    return pixels(spark, where).groupBy("seg", blue.alias("blue"), red.alias("red"), green.alias("green")).agg(F.count("*").alias("n"))
