"""Queries over clips: what is in them, how their captions are laid out, and checks of what was delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipstrata.functions import camera, encode
from clipstrata.functions import text as T
from clipstrata.operators import audit, evidence, grid, temporal, tracks
from clipstrata.plans import windows
from clipstrata.queries import Registry
from clipstrata.queries.captions import CAPTION_SQL, LATEST_QUALITY, events
from clipstrata.queries.frames import DUV_SQL, RECENTRE, duv
from clipstrata.session import latest
from clipstrata.sources.tables import FRAMES_SQL, PIXELS_SQL, frames, pixels, table

REG = Registry()


@REG.add(
    "scale_lock",
    PIXELS_SQL
    + """, b AS (SELECT seg, ordinal, depth AS d, lag(depth) OVER w AS p, lag(ordinal) OVER w AS o FROM px WINDOW w AS (PARTITION BY seg, r, c ORDER BY ordinal)
), m AS (SELECT seg, ordinal, count(*) AS a, count(*) FILTER (d > 0 AND p > 0 AND o = ordinal - 1) AS n, quantile_cont(CASE WHEN d > 0 AND p > 0 AND o = ordinal - 1 THEN ln(d) - ln(p) END, 0.5) AS r FROM b GROUP BY seg, ordinal
), q AS (SELECT seg, ordinal, CASE WHEN n >= a * 0.05 AND n > 0 THEN r ELSE 0 END AS ratio FROM m
), l AS (SELECT seg, ordinal, sum(ratio) OVER (PARTITION BY seg ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS level FROM q
), t AS (SELECT seg, ordinal, level - coalesce(regr_intercept(level, ordinal) OVER w + ordinal * regr_slope(level, ordinal) OVER w, level) AS res FROM l WINDOW w AS (PARTITION BY seg ORDER BY ordinal ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)
), c AS (SELECT seg AS ep, ordinal, greatest(least(-(res - avg(res) OVER (PARTITION BY seg)), 0.25), -0.25) AS x FROM t)"""
    + RECENTRE
    + """, f AS (SELECT ep AS seg, ordinal, CASE WHEN count(*) OVER (PARTITION BY ep) < 3 THEN 0 ELSE x - avg(x) OVER (PARTITION BY ep) END AS x FROM p3)
SELECT px.seg, px.ordinal, round(sum(depth * exp(x)), 3) AS locked FROM px JOIN f USING (seg, ordinal) GROUP BY px.seg, px.ordinal""",
)
def scale_lock(spark: SparkSession, where: str) -> DataFrame:
    """Planes with each frame's own scale taken out: measured on pixels, kept as one factor a frame, brought to mean zero so
    that the clip's level stays, joined back. Clips of fewer than three frames stay as they are."""
    p = pixels(spark, where)
    f = temporal.scale_factors(temporal.log_ratios(p, "seg", "ordinal", "depth", ["r", "c"]), "seg", "ordinal")
    return p.join(f, ["seg", "ordinal"]).groupBy("seg", "ordinal").agg(F.round(F.sum(F.col("depth") * F.exp("correction")), 3).alias("locked"))


@REG.add(
    "temporal_metrics",
    DUV_SQL
    + """, d AS (SELECT seg, ordinal, r, c, CASE WHEN lag(red) OVER w < 255 AND red < 255 AND lead(red) OVER w < 255 THEN abs(lag(red) OVER w - 2 * red + lead(red) OVER w) END AS j,
  CASE WHEN lag(e, 3) OVER w IS NOT NULL AND lead(e, 3) OVER w IS NOT NULL THEN CASE WHEN lag(e, 3) OVER w = lead(e, 3) OVER w AND e <> lag(e, 3) OVER w THEN 1.0 ELSE 0.0 END END AS f
  FROM duv WINDOW w AS (PARTITION BY seg, r, c ORDER BY ordinal)
), o AS (SELECT seg, ordinal, quantile_cont(j, 0.5) AS j, avg(f) AS f FROM d GROUP BY seg, ordinal)
SELECT seg, round(avg(j), 4) AS depth_jitter, round(max(j), 4) AS depth_jitter_max, round(avg(f), 6) AS semantic_flicker, round(max(f), 6) AS semantic_flicker_max FROM o GROUP BY seg""",
)
def temporal_metrics(spark: SparkSession, where: str) -> DataFrame:
    """Second differences of the depth codes and flashes of the classes, by pixel, then by frame, then by clip."""
    w = Window.partitionBy("seg", "r", "c").orderBy("ordinal")
    x = F.when(F.col("red") < 255, F.col("red"))
    d = duv(spark, where).select("seg", "ordinal", temporal.second_difference(x, w).alias("j"), temporal.flash("e", w, 3).cast("double").alias("f"))
    o = d.groupBy("seg", "ordinal").agg(F.percentile("j", 0.5).alias("j"), F.avg("f").alias("f"))
    r = lambda x, n, k: F.round(x, k).alias(n)
    return o.groupBy("seg").agg(r(F.avg("j"), "depth_jitter", 4), r(F.max("j"), "depth_jitter_max", 4), r(F.avg("f"), "semantic_flicker", 6), r(F.max("f"), "semantic_flicker_max", 6))


@REG.add("driving", PIXELS_SQL + " SELECT seg, round(avg(CASE WHEN cls = 2 THEN 1.0 ELSE 0.0 END), 6) AS cover, avg(CASE WHEN cls = 2 THEN 1.0 ELSE 0.0 END) > 0.5 AS driving FROM px WHERE r BETWEEN 3 AND 4 AND c BETWEEN 3 AND 4 GROUP BY seg")
def driving(spark: SparkSession, where: str) -> DataFrame:
    """Whether one class covers most of the patch about the anchor."""
    return tracks.driving(pixels(spark, where), 2, 8, 8)


@REG.add(
    "scale_shift",
    PIXELS_SQL
    + """, x AS (SELECT seg, depth AS s, depth * 2.5 + 0.4 * (c % 2) AS t FROM px WHERE depth > 0), m AS (SELECT seg, exp(quantile_cont(ln(t) - ln(s), 0.5)) AS scale, count(*) AS n FROM x GROUP BY seg
), d AS (SELECT seg, quantile_cont(abs(ln(t / (s * scale))), 0.5) AS disp FROM x JOIN m USING (seg) GROUP BY seg), l AS (SELECT seg, regr_slope(t, s) AS slope, regr_intercept(t, s) AS shift FROM x GROUP BY seg)
SELECT seg, CASE WHEN n >= 100 THEN round(scale, 6) ELSE 1.0 END AS scale, n >= 100 AND disp < 0.5 AS solved, round(slope, 5) AS slope, round(shift, 5) AS shift FROM m JOIN d USING (seg) JOIN l USING (seg)""",
)
def scale_shift(spark: SparkSession, where: str) -> DataFrame:
    """A depth map fitted to a metric one: by the median log ratio, and by a straight line."""
    x = pixels(spark, where).filter("depth > 0").select("seg", F.col("depth").alias("s"), (F.col("depth") * 2.5 + 0.4 * (F.col("c") % 2)).alias("t"))
    m = x.groupBy("seg").agg(F.exp(F.percentile(F.ln("t") - F.ln("s"), 0.5)).alias("k"), F.count("*").alias("n"), F.regr_slope("t", "s").alias("slope"), F.regr_intercept("t", "s").alias("shift"))
    d = x.join(m.select("seg", "k"), "seg").groupBy("seg").agg(F.percentile(F.abs(F.ln(F.col("t") / (F.col("s") * F.col("k")))), 0.5).alias("d"))
    enough = F.col("n") >= 100
    return m.join(d, "seg").select(
        "seg", F.when(enough, F.round("k", 6)).otherwise(1.0).alias("scale"), (enough & (F.col("d") < 0.5)).alias("solved"), F.round("slope", 5).alias("slope"), F.round("shift", 5).alias("shift")
    )


@REG.add(
    "synthetic_backends",
    """WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings), g AS (SELECT vec_id, p // 8 AS r, p % 8 AS c, least(abs(CAST(x AS DOUBLE)) * 255, 255) AS luma FROM v)
SELECT vec_id, round(sum((1.5 + 78.5 * (1 - r / 7.0)) * (0.85 + 0.3 * luma / 255)), 3) AS depth, count(*) FILTER (r >= 4 AND c BETWEEN 3 AND 4) AS human, count(*) FILTER (NOT (r >= 4 AND c BETWEEN 3 AND 4) AND luma > 90) AS building FROM g GROUP BY vec_id""",
)
def synthetic_backends(spark: SparkSession, where: str) -> DataFrame:
    """The stand-in models as plain expressions: depth from the row and the brightness, classes from rules in order."""
    v = table(spark, where, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "x"))
    r, c = F.expr("p div 8"), F.col("p") % 8
    luma = F.least(F.abs(F.col("x").cast("double")) * 255, F.lit(255.0))
    middle = (r >= 4) & c.between(3, 4)
    depth = (1.5 + 78.5 * (1 - r / 7.0)) * (0.85 + 0.3 * luma / 255)
    return v.groupBy("vec_id").agg(F.round(F.sum(depth), 3).alias("depth"), F.count_if(middle).alias("human"), F.count_if(~middle & (luma > 90)).alias("building"))


@REG.add(
    "episode_pipeline",
    PIXELS_SQL
    + """, b AS (SELECT seg, ordinal, r // 2 AS r, c // 2 AS c, coalesce(quantile_cont(CASE WHEN depth > 1e-3 THEN depth END, 0.5), 0) * 2.0 AS d FROM px GROUP BY ALL
), s AS (SELECT seg, ordinal, coalesce(quantile_cont(CASE WHEN d > 0 THEN d END, 0.5) OVER (PARTITION BY seg, r, c ORDER BY ordinal ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 0) AS d FROM b)
SELECT seg, count(*) AS pixels, round(avg(CASE WHEN d > 0 THEN greatest(least(d, 256.0), 0.3) ELSE 0 END), 4) AS mean, round(count(*) FILTER (d > 0 AND d < 0.3) / greatest(count(*) FILTER (d > 0), 1), 6) AS near_clipped FROM s GROUP BY seg""",
)
def episode_pipeline(spark: SparkSession, where: str) -> DataFrame:
    """The chain of a clip: planes reduced first, then brought to scale, stabilised in time, clamped to the range."""
    b = grid.block_depth(pixels(spark, where), ["seg", "ordinal"], "depth", 2, 2).select("seg", "ordinal", "br", "bc", (F.col("median") * 2.0).alias("d"))
    s = b.withColumn("d", temporal.window_median(F.col("d"), temporal.ordered("seg", "ordinal", "br", "bc"), 2))
    held = F.when(F.col("d") > 0, F.greatest(F.least(F.col("d"), F.lit(encode.FAR)), F.lit(encode.NEAR))).otherwise(0.0)
    g = audit.range_guard(s, ["seg"], "d", encode.NEAR, encode.FAR).select("seg", F.col("clipped_near_fraction").alias("near_clipped"))
    return s.groupBy("seg").agg(F.count("*").alias("pixels"), F.round(F.avg(held), 4).alias("mean")).join(g, "seg")


@REG.add(
    "staircase_roundtrip",
    """WITH m AS (SELECT CAST(i AS INT) AS grey, CASE WHEN i > 0 THEN exp(ln(256.0) - i / 255.0 * (ln(256.0) - ln(0.1))) ELSE 0 END AS depth FROM range(256) t(i)
), q AS (SELECT grey, depth, round_even((ln(256.0) - ln(least(greatest(depth, 0.1), 256.0))) / (ln(256.0) - ln(0.1)) * 65535, 0) AS q FROM m)
SELECT grey, round(depth, 5) AS metres, CAST(CASE WHEN depth > 1e-3 AND q > 0 THEN greatest(1, round_even(q * 255.0 / 65535.0, 0)) ELSE 0 END AS INT) AS back FROM q""",
)
def staircase_roundtrip(spark: SparkSession, where: str) -> DataFrame:
    """All grey codes to metres and back to codes."""
    g = spark.range(256).select(F.col("id").cast("int").alias("grey"))
    metres = encode.metres_of_grey8(F.col("grey"))
    return g.select("grey", F.round(metres, 5).alias("metres"), encode.grey8(metres).alias("back"))


@REG.add(
    "encode_diagnosis",
    DUV_SQL
    + """, s AS (SELECT seg, red AS w, CAST(round_even(16 + red * 219.0 / 255.0, 0) AS INT) AS g FROM duv)
SELECT seg, count(*) FILTER (w <> g) AS changed, max(abs(w - g)) AS worst, round(regr_slope(g, w), 3) AS gain, CASE WHEN abs(regr_slope(g, w) - 219.0 / 255.0) < 0.02 THEN 'squeeze' WHEN count(*) FILTER (w <> g) = 0 THEN 'exact' ELSE 'other' END AS kind FROM s GROUP BY seg""",
)
def encode_diagnosis(spark: SparkSession, where: str) -> DataFrame:
    """How codes moved on their way through an encoder that squeezes the range."""
    s = duv(spark, where).select("seg", F.col("red").alias("w"), F.rint(16 + F.col("red") * 219.0 / 255.0).cast("int").alias("g"))
    slope, changed = F.regr_slope("g", "w"), F.count_if(F.col("w") != F.col("g"))
    kind = F.when(F.abs(slope - 219.0 / 255.0) < 0.02, "squeeze").when(changed == 0, "exact").otherwise("other")
    return s.groupBy("seg").agg(changed.alias("changed"), F.max(F.abs(F.col("w") - F.col("g"))).alias("worst"), F.round(slope, 3).alias("gain"), kind.alias("kind"))


@REG.add(
    "camera_math",
    """WITH q AS (SELECT vec_id, embedding[1] + 1.5 AS w, embedding[2] AS x, embedding[3] AS y, embedding[4] AS z, 0.5 + abs(CAST(embedding[5] AS DOUBLE)) AS fx FROM embeddings
), n AS (SELECT vec_id, fx, CAST(w AS DOUBLE) AS w, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z FROM q), u AS (SELECT *, sqrt(w*w + x*x + y*y + z*z) AS l FROM n)
SELECT vec_id, round(degrees(2 * atan(1 / (2 * fx))), 5) AS fov, round(3 - 4 * (x*x + y*y + z*z) / (l*l), 3) AS trace FROM u""",
)
def camera_math(spark: SparkSession, where: str) -> DataFrame:
    """Field of view, and the trace of the rotation of a quaternion."""
    e = lambda k: F.element_at("embedding", k).cast("double")
    w = (F.element_at("embedding", 1) + F.lit(1.5)).cast("double")
    v = table(spark, where, "embeddings").select("vec_id", w.alias("w"), e(2).alias("x"), e(3).alias("y"), e(4).alias("z"), (0.5 + F.abs(e(5))).alias("fx"))
    v = v.withColumn("m", camera.rotation(F.col("w"), F.col("x"), F.col("y"), F.col("z")))
    trace = F.col("m")[0][0] + F.col("m")[1][1] + F.col("m")[2][2]
    return v.select("vec_id", F.round(camera.fov_x(F.col("fx")), 5).alias("fov"), F.round(trace, 3).alias("trace"))


@REG.add(
    "caption_slice",
    CAPTION_SQL
    + """, k AS (SELECT * FROM ev WHERE bin BETWEEN 2 AND 5), f AS (SELECT doc_id, min(bin) AS lo FROM k GROUP BY doc_id)
SELECT k.doc_id, k.bin - f.lo AS bin, k.phrase, EXISTS (SELECT 1 FROM ev p WHERE p.doc_id = k.doc_id AND p.phrase = k.phrase AND p.bin < 2) AS starts_before FROM k JOIN f USING (doc_id)""",
)
def caption_slice(spark: SparkSession, where: str) -> DataFrame:
    """The events of some bins, counted from the first; those that also stand before the cut are marked."""
    e = events(spark, where)
    before = F.max((F.col("bin") < 2).cast("int")).over(Window.partitionBy("doc_id", "phrase")) == 1
    k = e.withColumn("starts_before", before).filter(F.col("bin").between(2, 5))
    return k.select("doc_id", (F.col("bin") - F.min("bin").over(Window.partitionBy("doc_id"))).alias("bin"), "phrase", "starts_before")


@REG.add(
    "event_forms",
    CAPTION_SQL
    + """, n AS (SELECT doc_id, phrase, bin, row_number() OVER w AS i, count(*) OVER (PARTITION BY doc_id, phrase) AS n FROM ev WINDOW w AS (PARTITION BY doc_id, phrase ORDER BY bin))
SELECT CASE WHEN i = 1 THEN 'start' WHEN i = n AND n >= 3 THEN 'last' WHEN i = 2 THEN 'again' ELSE 'continue' END AS form, count(*) AS n FROM n GROUP BY form""",
)
def event_forms(spark: SparkSession, where: str) -> DataFrame:
    """Which form the verb of an event takes by its place among the bins of the event."""
    by = Window.partitionBy("doc_id", "phrase")
    x = events(spark, where).select(F.row_number().over(by.orderBy("bin")).alias("i"), F.count("*").over(by).alias("n"))
    form = F.when(F.col("i") == 1, "start").when((F.col("i") == F.col("n")) & (F.col("n") >= 3), "last").when(F.col("i") == 2, "again").otherwise("continue")
    return x.groupBy(form.alias("form")).agg(F.count("*").alias("n"))


@REG.add(
    "global_paragraph",
    CAPTION_SQL + " SELECT doc_id, string_agg(CASE WHEN bin = 0 THEN phrase ELSE lower(phrase) END, ', then ' ORDER BY bin) AS paragraph FROM ev GROUP BY doc_id",
)
def global_paragraph(spark: SparkSession, where: str) -> DataFrame:
    """The events of a document in their order, as one sentence."""
    e = events(spark, where).select("doc_id", "bin", F.when(F.col("bin") == 0, F.col("phrase")).otherwise(F.lower("phrase")).alias("t"))
    a = e.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("bin", "t"))).alias("a"))
    return a.select("doc_id", F.array_join(F.transform("a", lambda x: x["t"]), ", then ").alias("paragraph"))


@REG.add(
    "conditioning_contents",
    CAPTION_SQL
    + """, g AS (SELECT doc_id, max(peds) AS p, max(CASE WHEN vehicle THEN 1 ELSE 0 END) = 1 AS v FROM ev GROUP BY doc_id)
SELECT doc_id, concat_ws(' and ', CASE WHEN p = 1 THEN '1 bystander' WHEN p > 1 THEN p || ' bystanders' END, CASE WHEN v THEN 'traffic' ELSE 'no vehicles' END) AS contents FROM g""",
)
def conditioning_contents(spark: SparkSession, where: str) -> DataFrame:
    """What the seconds of a clip hold, taken together."""
    g = events(spark, where).groupBy("doc_id").agg(F.max("peds").alias("p"), F.bool_or("vehicle").alias("v"))
    people = F.when(F.col("p") == 1, "1 bystander").when(F.col("p") > 1, F.concat("p", F.lit(" bystanders")))
    return g.select("doc_id", F.concat_ws(" and ", people, F.when(F.col("v"), "traffic").otherwise("no vehicles")).alias("contents"))


@REG.add(
    "window_sentences",
    """WITH s AS (SELECT clip, min(start) AS a, max(stop) AS b FROM bins WHERE start < stop GROUP BY clip)
SELECT clip, '[' || printf('%.2f', a) || 's-' || printf('%.2f', b) || 's]' AS stamp, CASE WHEN a > 0 THEN 'wn' ELSE 'w0' END AS system FROM (SELECT clip, round(a, 1) + 0.0 AS a, round(b, 1) AS b FROM s)""",
)
def window_sentences(spark: SparkSession, where: str) -> DataFrame:
    """The stamp of a clip's span, and whether it goes on from an earlier one."""
    s = table(spark, where, "bins").filter("start < stop AND clip IS NOT NULL").groupBy("clip").agg(F.round(F.min("start"), 1).alias("a"), F.round(F.max("stop"), 1).alias("b"))
    # adding zero makes a negative zero a plain one
    a = F.col("a") + F.lit(0.0)
    return s.select("clip", T.stamp(a, F.col("b")).alias("stamp"), F.when(F.col("a") > 0, "wn").otherwise("w0").alias("system"))


@REG.add(
    "attempt_usage",
    """WITH a AS (SELECT clip, written_at, prompt, coalesce(depth_temporal BETWEEN 1 AND 5, false) AND coalesce(semantic_temporal BETWEEN 1 AND 5, false) AS ok FROM (SELECT DISTINCT clip, written_at, prompt, depth_temporal, semantic_temporal FROM quality WHERE clip IS NOT NULL))
SELECT clip, count(*) AS attempts, min(CASE WHEN ok THEN written_at END) AS first_valid, CAST(sum(prompt) AS BIGINT) AS prompts FROM a GROUP BY clip""",
)
def attempt_usage(spark: SparkSession, where: str) -> DataFrame:
    """The replies to a clip in their order: how many, and when the first valid one came."""
    q = table(spark, where, "quality").filter("clip IS NOT NULL").select("clip", "written_at", "prompt", "depth_temporal", "semantic_temporal").distinct()
    ok = F.coalesce(F.col("depth_temporal").between(1, 5), F.lit(False)) & F.coalesce(F.col("semantic_temporal").between(1, 5), F.lit(False))
    return q.groupBy("clip").agg(F.count("*").alias("attempts"), F.min(F.when(ok, F.col("written_at"))).alias("first_valid"), F.sum("prompt").alias("prompts"))


@REG.add(
    "chat_render",
    """WITH m AS (SELECT scene, doc_id, CASE doc_kind WHEN 'guide' THEN 'system' WHEN 'judge' THEN 'model' ELSE 'user' END AS role, source FROM documents WHERE scene IS NOT NULL)
SELECT scene, string_agg(role || ': ' || coalesce(source, '-'), chr(10) ORDER BY doc_id) FILTER (role <> 'system') AS chat, count(*) FILTER (role = 'system') AS system FROM m GROUP BY scene""",
)
def chat_render(spark: SparkSession, where: str) -> DataFrame:
    """The documents of a scene as a conversation, instructions apart. One scene has a tenth of them; only short lines meet."""
    role = F.when(F.col("doc_kind") == "guide", "system").when(F.col("doc_kind") == "judge", "model").otherwise("user")
    m = table(spark, where, "documents").filter("scene IS NOT NULL").select("scene", "doc_id", role.alias("role"), F.coalesce("source", F.lit("-")).alias("s"))
    line = F.when(F.col("role") != "system", F.struct("doc_id", F.concat_ws(": ", "role", "s").alias("t")))
    a = m.groupBy("scene").agg(F.sort_array(F.collect_list(line)).alias("a"), F.count_if(F.col("role") == "system").alias("system"))
    return a.select("scene", F.when(F.size("a") > 0, F.array_join(F.transform("a", lambda x: x["t"]), "\n")).alias("chat"), "system")


@REG.add(
    "label_table",
    r"""WITH l(id, label) AS (VALUES (0, 'Wall; partition'), (1, 'building;edifice'), (2, 'SKY'), (3, 'path,  road'), (4, 'gizmo')), m(name, cls) AS (VALUES ('building', 6), ('sky', 1), ('road', 4), ('wall', 6), ('edifice', 7)
), s AS (SELECT id, unnest(string_split_regex(lower(label), '[;,]')) AS s, generate_subscripts(string_split_regex(lower(label), '[;,]'), 1) AS i FROM l), c AS (SELECT id, i, cls FROM s JOIN m ON m.name = trim(regexp_replace(s, '\s+', ' ', 'g')))
SELECT l.id, coalesce(arg_min(c.cls, c.i), 0) AS cls, count(c.cls) = 0 AS unmapped FROM l LEFT JOIN c USING (id) GROUP BY l.id""",
)
def label_table(spark: SparkSession, where: str) -> DataFrame:
    """A model's labels to classes by the first name that is known; labels without one are marked."""
    labels = spark.createDataFrame([(0, "Wall; partition"), (1, "building;edifice"), (2, "SKY"), (3, "path,  road"), (4, "gizmo")], "id int, label string")
    names = spark.createDataFrame([("building", 6), ("sky", 1), ("road", 4), ("wall", 6), ("edifice", 7)], "name string, cls int")
    s = labels.select("id", F.posexplode(T.synonyms(F.col("label"))).alias("i", "name")).join(F.broadcast(names), "name")
    got = labels.select("id").join(s, "id", "left").groupBy("id").agg(F.min(F.struct("i", "cls"))["cls"].alias("cls"))
    return got.select("id", F.coalesce("cls", F.lit(0)).alias("cls"), F.col("cls").isNull().alias("unmapped"))


@REG.add(
    "mime_types",
    r"SELECT CASE regexp_extract(lower(path), '\.([a-z]+)(\.part)?$', 1) WHEN 'json' THEN 'application/json' WHEN 'jsonl' THEN 'application/x-ndjson' ELSE 'application/octet-stream' END AS mime, count(*) AS n FROM window_files GROUP BY mime",
)
def mime_types(spark: SparkSession, where: str) -> DataFrame:
    kind = F.regexp_extract(F.lower("path"), r"\.([a-z]+)(\.part)?$", 1)
    mime = F.when(kind == "json", "application/json").when(kind == "jsonl", "application/x-ndjson").otherwise("application/octet-stream")
    return table(spark, where, "window_files").groupBy(mime.alias("mime")).agg(F.count("*").alias("n"))


@REG.add(
    "quality_rows",
    LATEST_QUALITY
    + """, o AS (SELECT clip, arg_max(picked_as, scored_at) AS pick FROM scored WHERE picked_as IS NOT NULL GROUP BY clip), s AS (SELECT DISTINCT seg AS clip FROM seg_stats)
SELECT s.clip, coalesce(lower(trim(q.verdict)), 'unjudged') AS verdict, o.pick IS NOT NULL AS picked, len(list_filter(coalesce(q.issues, []), lambda i: lower(i.severity) = 'major')) AS major,
len(list_filter(coalesce(q.issues, []), lambda i: lower(i.severity) = 'minor')) AS minor FROM s LEFT JOIN q USING (clip) LEFT JOIN o USING (clip)""",
)
def quality_rows(spark: SparkSession, where: str) -> DataFrame:
    """One row a clip: its judgement, its issues by severity, and whether it was picked."""
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "verdict", "issues"])
    o = table(spark, where, "scored").filter("picked_as IS NOT NULL").select("clip", F.lit(True).alias("pick")).distinct()
    s = table(spark, where, "seg_stats").select(F.col("seg").alias("clip")).distinct()
    n = lambda k: F.size(F.filter(F.coalesce("issues", F.array()), lambda i: F.lower(i["severity"]) == k)).cast("long").alias(k)
    x = s.join(q, "clip", "left").join(o, "clip", "left")
    return x.select("clip", F.coalesce(F.lower(F.trim("verdict")), F.lit("unjudged")).alias("verdict"), F.coalesce("pick", F.lit(False)).alias("picked"), n("major"), n("minor"))


@REG.add(
    "centre_frames",
    FRAMES_SQL + " SELECT s.clip, s.bin, s.first_frame + (s.stop_frame - s.first_frame) // 2 AS frame FROM (SELECT clip, bin, min(first_frame) AS first_frame, max(stop_frame) AS stop_frame FROM bins GROUP BY clip, bin) s",
)
def centre_frames(spark: SparkSession, where: str) -> DataFrame:
    """The frame in the middle of each bin."""
    s = table(spark, where, "bins").groupBy("clip", "bin").agg(F.min("first_frame").alias("a"), F.max("stop_frame").alias("b"))
    return s.select("clip", "bin", (F.col("a") + F.expr("(b - a) div 2")).alias("frame"))


@REG.add(
    "merged_share",
    PIXELS_SQL
    + """, a AS (SELECT seg, ordinal, count(*) AS n FROM px WHERE cls = 2 GROUP BY seg, ordinal), m AS (SELECT seg, quantile_cont(n, 0.5) AS m FROM a GROUP BY seg)
SELECT seg, round(avg(CASE WHEN n > 1.6 * m THEN 1.0 ELSE 0.0 END), 6) AS merged FROM a JOIN m USING (seg) GROUP BY seg""",
)
def merged_share(spark: SparkSession, where: str) -> DataFrame:
    """In how many frames an area swells well beyond its median."""
    a = pixels(spark, where).filter("cls = 2").groupBy("seg", "ordinal").agg(F.count("*").alias("n"))
    m = a.groupBy("seg").agg(F.percentile("n", 0.5).alias("m"))
    return a.join(m, "seg").groupBy("seg").agg(F.round(F.avg((F.col("n") > 1.6 * F.col("m")).cast("double")), 6).alias("merged"))


@REG.add(
    "provenance_match",
    "WITH a AS (SELECT clip, count(DISTINCT (coalesce(model, ''), coalesce(prompt, -1))) AS n FROM quality WHERE clip IS NOT NULL GROUP BY clip) SELECT clip, n = 1 AS same FROM a",
)
def provenance_match(spark: SparkSession, where: str) -> DataFrame:
    """Whether all judgements of a clip were made the same way."""
    q = table(spark, where, "quality").filter("clip IS NOT NULL").select("clip", "model", "prompt").distinct()
    return q.groupBy("clip").agg((F.count("*") == 1).alias("same"))


@REG.add(
    "score_histogram",
    "WITH q AS (SELECT depth_temporal AS s FROM quality UNION ALL SELECT depth_accuracy FROM quality UNION ALL SELECT semantic_temporal FROM quality UNION ALL SELECT semantic_accuracy FROM quality) SELECT s, count(*) AS n FROM q GROUP BY s",
)
def score_histogram(spark: SparkSession, where: str) -> DataFrame:
    q = table(spark, where, "quality").select(F.explode(F.array("depth_temporal", "depth_accuracy", "semantic_temporal", "semantic_accuracy")).alias("s"))
    return q.groupBy("s").agg(F.count("*").alias("n"))


@REG.add("range_histogram", FRAMES_SQL + " SELECT CAST(floor(depth / 10) AS BIGINT) AS band, count(*) AS n, round(sum(count(*)) OVER (ORDER BY floor(depth / 10)) / sum(count(*)) OVER (), 6) AS upto FROM frames GROUP BY floor(depth / 10)")
def range_histogram(spark: SparkSession, where: str) -> DataFrame:
    """Depths by bands of ten, with their running share: as many rows as bands, whatever the number of frames."""
    h = frames(spark, where).groupBy(F.floor(F.col("depth") / 10).alias("band")).agg(F.count("*").alias("n"))
    w = Window.orderBy("band")
    return h.select("band", "n", F.round(F.sum("n").over(w) / F.sum("n").over(Window.partitionBy()), 6).alias("upto"))


@REG.add("reused_judgements", LATEST_QUALITY + " SELECT coalesce(prompt, -1) AS prompt, count(*) AS clips, count(*) FILTER (prompt >= 2) AS reused FROM q GROUP BY ALL")
def reused_judgements(spark: SparkSession, where: str) -> DataFrame:
    """Which latest judgements are of a prompt that still counts."""
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "prompt"])
    return q.groupBy(F.coalesce("prompt", F.lit(-1)).alias("prompt")).agg(F.count("*").alias("clips"), F.count_if(F.col("prompt") >= 2).alias("reused"))


MEASURED_SQL = DUV_SQL.replace("WITH vec", "WITH RECURSIVE vec", 1) + """, b AS (SELECT *, CAST(least(ordinal // 24, 4) AS INT) AS bin, CASE WHEN lag(ordinal) OVER w = ordinal - 1 AND lag(red) OVER w < 255 AND red < 255 THEN abs(red - lag(red) OVER w) END AS d FROM grp WINDOW w AS (PARTITION BY seg, r, c ORDER BY ordinal)
), ped AS (SELECT seg, ordinal, r * 8 + c AS p, r, c FROM grp WHERE g = 4), edge AS (SELECT a.seg, a.ordinal, a.p AS a, b.p AS b FROM ped a JOIN ped b ON a.seg = b.seg AND a.ordinal = b.ordinal AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1
), reach AS (SELECT seg, ordinal, a, b FROM edge UNION SELECT r.seg, r.ordinal, r.a, e.b FROM reach r JOIN edge e ON e.seg = r.seg AND e.ordinal = r.ordinal AND e.a = r.b
), blob AS (SELECT seg, ordinal, count(DISTINCT root) AS peds FROM (SELECT seg, ordinal, a, min(b) AS root FROM reach GROUP BY ALL) GROUP BY ALL
), f AS (SELECT seg, bin, ordinal, count(*) AS n, """ + ", ".join(f"count(*) FILTER (g = {i}) / count(*) AS s{i}" for i in range(8)) + """, avg(d) AS d,
  round(min(CASE WHEN g = 3 THEN c END) / 8.0, 3) AS x0, round(min(CASE WHEN g = 3 THEN r END) / 8.0, 3) AS y0, round((max(CASE WHEN g = 3 THEN c END) + 1) / 8.0, 3) AS x1, round((max(CASE WHEN g = 3 THEN r END) + 1) / 8.0, 3) AS y1 FROM b GROUP BY seg, bin, ordinal
), h AS (SELECT seg, bin, quantile_disc(CASE WHEN red < 255 THEN red END, 0.1) AS q1, quantile_disc(CASE WHEN red < 255 THEN red END, 0.5) AS q5, quantile_disc(CASE WHEN red < 255 THEN red END, 0.9) AS q9 FROM b GROUP BY seg, bin
), facts AS (SELECT seg, bin, count(*) AS frames, CAST(floor(quantile_cont(coalesce(peds, 0), 0.5)) AS INT) AS peds, avg(s3) AS player, avg(s5) AS vehicle, avg(s6) AS ego, avg(s2) AS sky, avg(s1) AS road, avg(s7) AS veg, avg(s0) AS static, coalesce(avg(d), 0) AS d,
  quantile_cont(x0, 0.5) AS x0, quantile_cont(y0, 0.5) AS y0, quantile_cont(x1, 0.5) AS x1, quantile_cont(y1, 0.5) AS y1 FROM f LEFT JOIN blob USING (seg, ordinal) GROUP BY seg, bin)"""


@REG.add(
    "measured_evidence",
    MEASURED_SQL
    + """ SELECT seg, bin, frames, player > 0 AS player, peds, vehicle > 0 AS vehicle, ego > 0 AS ego_vehicle, round(player, 5) AS player_area, round(sky, 3) AS sky_frac, round(road, 3) AS road_frac, round(veg, 3) AS vegetation_frac,
round(static, 3) AS static_frac, round(x0, 3) AS x0, round(y0, 3) AS y0, round(x1, 3) AS x1, round(y1, 3) AS y1, round(d, 3) AS depth_delta_code, d > 0.5 AS world_moving,
round(0.1 * pow(80000.0, q1 / 254.0), 1) AS depth_p10_m, round(0.1 * pow(80000.0, q5 / 254.0), 1) AS depth_p50_m, round(0.1 * pow(80000.0, q9 / 254.0), 1) AS depth_p90_m FROM facts JOIN h USING (seg, bin)""",
)
def measured_evidence(spark: SparkSession, where: str) -> DataFrame:
    """What each second of a clip's composite stream shows: who is there, how much of what, how it moves, how far it is."""
    p = duv(spark, where)
    p = p.withColumn("g", encode.duv_group(F.col("red"), F.col("green"), F.col("blue"))).select("seg", "ordinal", "r", "c", "red", "g")
    clips = p.groupBy("seg").agg(F.count_distinct("ordinal").alias("n")).withColumn("rate", F.lit(24.0))
    return evidence.measured(p, windows.second_grid(clips, "seg", "n", "rate"), 8, 8)
