"""Queries of rules on logs, tracks, contracts, replies and clips. Where no table holds an input, it is small and given here,
with what follows from the rules by hand."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from clipstrata.functions import encode
from clipstrata.functions import text as T
from clipstrata.operators import audit, captions, gating, logs, tracks
from clipstrata.plans import windows
from clipstrata.queries import Registry
from clipstrata.queries.prompts import _values, told
from clipstrata.session import latest, new_folder
from clipstrata.sources import readers
from clipstrata.sources.tables import PIXELS_SQL, pixels, table

REG = Registry()

END = "12 clips, 1 episodes failed, manifest at /out"
LOGS = {
    "s0": ("run [0/3]\nerror: take_1: FileNotFoundError: no such file: a\nTraceback (most recent call last)\n  x\nFileNotFoundError: a\nthat is a traceback rather than a message about your data\nerror: take_2: too short\n" + END, 50),
    "s1": ("run [1/3]\n[3/812] take_9\n  decoding\n\n", 51),
    "s2": ("run [2/3]\nTraceback (most recent call last)\n  at x\nValueError: bad depth\nlast words", 52),
    "s3": ("run [3/8]\nTraceback (most recent call last)\ntorch.OutOfMemoryError: CUDA out of memory. Tried", 90),
    "s4": ("\n  \n", 10),
    "s5": ("run [5/8]\nTraceback (most recent call last)\nOSError: [Errno 28] No space left on device", 11),
    "s6": ("run [6/8]\nTraceback (most recent call last)\nnumpy.MemoryError: Unable to allocate", 12),
    "s7": ("run [7/8]\nTraceback (most recent call last)\n  nothing typed", 13),
}
ENDS = [
    ("s0", "finished", END), ("s1", "killed", "stops after:   decoding"), ("s2", "raised", "ValueError: bad depth"), ("s3", "cuda out of memory", "torch.OutOfMemoryError: CUDA out of memory. Tried"),
    ("s4", "empty", "the log is empty - the worker never started"), ("s5", "disk full", "the output filesystem filled mid-run"), ("s6", "host out of memory", "numpy.MemoryError: Unable to allocate"),
    ("s7", "raised", "  nothing typed"),
]


def _logs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t, m) for k, (t, m) in LOGS.items()], "name string, text string, modified long")


@REG.add("log_endings", _values(ENDS, "name, verdict, detail"))
def log_endings(spark: SparkSession, where: str) -> DataFrame:
    """How each worker ended, by the whole ladder: what it survived doesn't count."""
    return logs.classified(_logs(spark)).select("name", "verdict", "detail")


@REG.add("log_errors", _values([("s0", "FileNotFoundError", 1, "FileNotFoundError: no such file: a"), ("s0", "(handled: a message, not a bug)", 1, "too short")], "name, kind, n, example"))
def log_errors(spark: SparkSession, where: str) -> DataFrame:
    return logs.error_kinds(_logs(spark))


@REG.add("log_runs", _values([(k, {"s0": 3, "s1": 3, "s2": 3, "s4": None}.get(k, 8), k in ("s0", "s1", "s2")) for k in LOGS], "name, declared, current"))
def log_runs(spark: SparkSession, where: str) -> DataFrame:
    """Which logs are of the run whose logs agree with the number they declare, though others were written later."""
    return logs.of_this_run(_logs(spark)).select("name", logs.declared(F.col("text")).alias("declared"), "current")


# six frames of 8 x 8: one figure of 2 x 2 stays in the middle, one of 2 x 1 walks through, a speck is too small
def _walk(spark: SparkSession) -> DataFrame:
    rows = []
    for seg in (0, 1):
        for o in range(6):
            there = {(3, 3), (3, 4), (4, 3), (4, 4)} if seg == 0 else set()
            there |= {(0, o), (1, o)}
            rows += [(seg, o, r, c, 4 if (r, c) in there or (r, c, o) == (7, 7, 2) else 0) for r in range(8) for c in range(8)]
    return spark.createDataFrame(rows, "seg long, ordinal int, r int, c int, cls int")


# the one that stands still has 1 x 2 / 1; the other 1 x sqrt 2 / (1 + sqrt(35 / 12) / 2), and stands alone in the second clip
@REG.add("hero_tracks", _values([(0, "named", 2.0, 24), (1, "named", 0.762826, 12)], "seg, reason, score, hero_pixels"))
def hero_tracks(spark: SparkSession, where: str) -> DataFrame:
    """The figure that stays still in the picture, and its pixels in a class of their own."""
    p = _walk(spark)
    linked = tracks.link(tracks.components(p, 4, 8, 8), 8, 8, tracks.Prior(area=0.02, link=0.3))
    chosen = tracks.hero(linked, p.groupBy("seg").agg(F.count_distinct("ordinal").alias("n")))
    out = tracks.relabelled(p, tracks.blob_pixels(p, 4, 8, 8), linked, chosen, 5)
    n = out.groupBy("seg").agg(F.count_if(F.col("cls") == 5).alias("hero_pixels"))
    return chosen.join(n, "seg").select("seg", "reason", "score", "hero_pixels")


# by hand: 1.0296 of a width of 8 from the anchor, 4 of 64 pixels; the walker is 0.5256 widths away and named by nobody
@REG.add("player_tracks", _values([(0, "named", True, 0.157731), (1, "nobody is near the anchor", False, 0.052163)], "seg, reason, named, score"))
def player_tracks(spark: SparkSession, where: str) -> DataFrame:
    """The figure near the anchor, or why none is named."""
    p = _walk(spark)
    prior = tracks.Prior(area=0.02, link=0.3)
    linked = tracks.link(tracks.components(p, 4, 8, 8), 8, 8, prior)
    got = tracks.protagonist(linked, p.groupBy("seg").agg(F.count_distinct("ordinal").alias("n")), 8, 8, prior)
    return got.select("seg", "reason", F.col("track").isNotNull().alias("named"), "score")


FAULTY = """, bad AS (SELECT seg, ordinal, r, c, CASE WHEN seg = 1 AND ordinal = 5 AND r = 0 AND c = 0 THEN -1.0 WHEN seg = 2 AND ordinal = 7 AND r = 1 THEN 'nan'::DOUBLE ELSE depth END AS depth,
  CASE WHEN seg = 3 AND ordinal = 9 AND c = 2 THEN 12 ELSE cls END AS cls FROM px WHERE NOT (seg % 5 = 4 AND ordinal = 1))"""


@REG.add(
    "contract_checks",
    PIXELS_SQL
    + FAULTY
    + """, g AS (SELECT seg, count(DISTINCT ordinal) AS frames, max(ordinal) AS b, round(1 - count(*) FILTER (isfinite(depth) AND depth > 1e-3) / count(*), 6) AS invalid_fraction,
  round(min(CASE WHEN isfinite(depth) AND depth > 1e-3 THEN depth END), 4) AS depth_min, list_sort(list_distinct(list(cls))) AS classes_present FROM bad GROUP BY seg)
SELECT seg, frames, invalid_fraction, depth_min, classes_present, CASE WHEN b <> frames - 1 THEN 'ordinals must count from 0 without a hole' WHEN seg = 1 THEN 'negative depth at ordinal 5' WHEN seg = 2 THEN 'depth that is not finite at ordinal 7' WHEN seg = 3 THEN 'class out of range at ordinal 9' END AS problem FROM g""",
)
def contract_checks(spark: SparkSession, where: str) -> DataFrame:
    """Segments against the contract of their readers, with faults put in."""
    s, o, r, c = (F.col(x) for x in ("seg", "ordinal", "r", "c"))
    p = pixels(spark, where).filter(~((s % 5 == 4) & (o == 1)))
    depth = F.when((s == 1) & (o == 5) & (r == 0) & (c == 0), -1.0).when((s == 2) & (o == 7) & (r == 1), float("nan")).otherwise(F.col("depth"))
    p = p.withColumns({"depth": depth, "cls": F.when((s == 3) & (o == 9) & (c == 2), 12).otherwise(F.col("cls"))})
    return audit.validated(p).select("seg", "frames", "invalid_fraction", "depth_min", "classes_present", "problem")


@REG.add("label_projection", PIXELS_SQL + f" SELECT seg, true AS ok, CAST(sum([{', '.join(map(str, encode.ELEVEN_TO_TWELVE))}][least(cls, 10) + 1]) AS BIGINT) AS from_eleven, CAST(sum(cls) AS BIGINT) AS from_twelve FROM px GROUP BY seg")
def label_projection(spark: SparkSession, where: str) -> DataFrame:
    """Labels of two schemes brought to one; a scheme without a table and an id out of range are refused (tests)."""
    p = pixels(spark, where).select("seg", encode.to_twelve(F.col("cls"), "standard11").alias("a"), encode.to_twelve(F.col("cls"), "cwm12").alias("b"))
    return p.groupBy("seg").agg(F.lit(True).alias("ok"), F.sum("a").cast("long").alias("from_eleven"), F.sum("b").cast("long").alias("from_twelve"))


@REG.add("grid_guard", _values([("first", "written"), ("same", "same"), ("other", "refused")], "attempt, outcome"))
def grid_guard(spark: SparkSession, where: str) -> DataFrame:
    """One size of frames for a folder: the first is recorded, another refused."""
    root, got = new_folder(spark, "root"), []
    for attempt, size in (("first", (336, 192)), ("same", (336, 192)), ("other", (1280, 720))):
        try:
            got.append((attempt, "written" if readers.guard_grid(spark, root, *size) else "same"))
        except ValueError:
            got.append((attempt, "refused"))
    return spark.createDataFrame(got, "attempt string, outcome string")


PROBES = {"steady": [60.0, 61.0, 60.5], "outlier": [60.0, 150.0, 61.0, 60.0], "wide": [170.0, 171.0, 169.0], "one": [90.0]}


@REG.add("fov_lock", _values([("steady", 60.5, 1.0, True), ("outlier", 60.5, 90.0, True), ("wide", 170.0, 2.0, False), ("one", 90.0, 0.0, True)], "clip, fov, spread, usable"))
def fov_lock(spark: SparkSession, where: str) -> DataFrame:
    """One field of view for a clip: the median of its probes; beyond 10 to 160 degrees it isn't usable."""
    p = spark.createDataFrame([(k, x) for k, v in PROBES.items() for x in v], "clip string, fov double")
    m = p.groupBy("clip").agg(F.percentile("fov", 0.5).alias("fov"), F.round(F.max("fov") - F.min("fov"), 4).alias("spread"))
    return m.select("clip", "fov", "spread", F.col("fov").between(10.0, 160.0).alias("usable"))


@REG.add("fov_probes", _values([(124, "0,15,31,46,62,77,93,108"), (3, "0,1,2"), (8, "0,1,2,3,4,5,6,7"), (10, "0,1,2,3,5,6,7,8")], "frames, probes"))
def fov_probes(spark: SparkSession, where: str) -> DataFrame:
    """Which frames the field of view is solved on: evenly spread, at most eight."""
    f = spark.createDataFrame([(124,), (3,), (8,), (10,)], "frames int")
    return f.select("frames", F.array_join(F.transform(windows.probes(F.col("frames"), 8), lambda x: x.cast("string")), ",").alias("probes"))


CASES = [("solved", True, 2.5, True, "gt_camera_baseline", 2.5), ("unsolved", False, 1.0, True, "backend_native", 1.0), ("no cameras", None, None, True, "backend_native", 1.0), ("neither", False, 1.0, False, None, None)]


@REG.add("calibration", _values([(c, s, k) for c, _, _, _, s, k in CASES], "clip, metric_source, scale"))
def calibration(spark: SparkSession, where: str) -> DataFrame:
    """Where metres come from: the cameras if they were solved, else the model if it is metric, else nothing can be made."""
    x = spark.createDataFrame([c[:4] for c in CASES], "clip string, solved boolean, scale double, metric boolean")
    return x.select("clip", audit.metric_source(F.col("solved"), F.col("metric")).alias("metric_source"), F.when(F.col("solved"), F.col("scale")).when(F.col("metric"), 1.0).alias("scale"))


@REG.add("clip_names", "SELECT scene, idx, 'clip_' || scene[5:] || '_' || idx AS clip, count(*) AS n FROM windows WHERE scene IS NOT NULL AND idx IS NOT NULL GROUP BY ALL")
def clip_names(spark: SparkSession, where: str) -> DataFrame:
    w = table(spark, where, "windows").filter("scene IS NOT NULL AND idx IS NOT NULL").groupBy("scene", "idx").agg(F.count("*").alias("n"))
    return w.select("scene", "idx", windows.clip_name(F.col("scene"), F.col("idx")).alias("clip"), "n")


@REG.add("expected_total", "SELECT count(DISTINCT scene) AS scenes, count(DISTINCT scene) * 5 AS clips, round(124 / 24.0, 6) AS seconds_each FROM windows")
def expected_total(spark: SparkSession, where: str) -> DataFrame:
    s = table(spark, where, "windows").agg(F.count_distinct("scene").alias("scenes"))
    return s.select("scenes", (F.col("scenes") * windows.CLIPS).alias("clips"), F.round(F.lit(windows.WINDOW / windows.FPS), 6).alias("seconds_each"))


@udtf(returnType="second: int")
class Seconds:
    """The seconds that an interval overlaps, half-open; an interval of no length or with a missing end has none."""

    def eval(self, start: float, stop: float):
        if start is not None and stop is not None and start < stop:
            for s in range(int(start // 1), int(-(-stop // 1))):
                yield (s,)


@REG.add("seconds_udtf", "SELECT clip, bin, CAST(unnest(range(CAST(floor(start) AS INT), CAST(ceil(stop) AS INT))) AS INT) AS second FROM bins WHERE start < stop")
def seconds_udtf(spark: SparkSession, where: str) -> DataFrame:
    """The seconds of each bin by a table function, called for each row."""
    spark.udtf.register("seconds", Seconds)
    table(spark, where, "bins").select("clip", "bin", "start", "stop").createOrReplaceTempView("bins_for_seconds")
    return spark.sql("SELECT clip, bin, s.second FROM bins_for_seconds, LATERAL seconds(start, stop) s")


URLS = [("https://h", "https://h/v1/chat/completions"), ("https://h/", "https://h/v1/chat/completions"), ("https://h/v1", "https://h/v1/chat/completions"), ("https://h/v1/chat/completions/", "https://h/v1/chat/completions"), ("https://h/v2", "https://h/v2/v1/chat/completions")]


@REG.add("api_urls", _values(URLS, "base, url"))
def api_urls(spark: SparkSession, where: str) -> DataFrame:
    return spark.createDataFrame([u[:1] for u in URLS], "base string").select("base", T.api_url(F.col("base")).alias("url"))


MIMES = [("a.JPG", "image/jpeg"), ("a.jpeg", "image/jpeg"), ("a.mp4", "video/mp4"), ("a.png", "image/png"), ("a.webp", "image/webp"), ("a.json", "application/json"), ("a.txt", "text/plain"), ("a.bin2", "application/octet-stream"), ("a", "application/octet-stream")]


@REG.add("mime_guess", _values(MIMES, "path, mime"))
def mime_guess(spark: SparkSession, where: str) -> DataFrame:
    return spark.createDataFrame([m[:1] for m in MIMES], "path string").select("path", T.mime(F.col("path")).alias("mime"))


STATUS = [(200, False), (400, False), (408, True), (409, True), (425, True), (429, True), (500, True), (502, True), (503, True), (504, True), (501, False)]


@REG.add("retries", _values(STATUS, "status, again"))
def retries(spark: SparkSession, where: str) -> DataFrame:
    return spark.createDataFrame([s[:1] for s in STATUS], "status int").select("status", T.retryable(F.col("status")).alias("again"))


SAID = [
    ("plain", '{"choices": [{"message": {"content": " yes "}}]}', "yes"), ("parts", '{"choices": [{"message": {"content": ["a", {"type": "text", "text": "b"}, {"type": "image"}, {"text": "c"}]}}]}', "a\nb\nc"),
    ("none", '{"choices": []}', ""), ("null", '{"choices": [{"message": {"content": null}}]}', ""), ("broken", "{", ""),
]


@REG.add("reply_texts", _values([(k, t) for k, _, t in SAID], "name, text"))
def reply_texts(spark: SparkSession, where: str) -> DataFrame:
    """The text of a model's answer, whole or in parts."""
    return spark.createDataFrame([s[:2] for s in SAID], "name string, reply string").select("name", T.reply_text(F.col("reply")).alias("text"))


TALK = [(1, 0, "system", "be brief"), (1, 1, "user", "what is it"), (1, 2, "assistant", "a car"), (1, 3, "system", "in English"), (1, 4, "user", "sure?"), (2, 0, "user", "hi")]


@REG.add(
    "chat_turns",
    _values([(1, 0, "user", "what is it", "be brief\nin English"), (1, 1, "model", "a car", "be brief\nin English"), (1, 2, "user", "sure?", "be brief\nin English"), (2, 0, "user", "hi", None)], "conv, turn, role, text, system"),
)
def chat_turns(spark: SparkSession, where: str) -> DataFrame:
    """Messages as turns of user and model, with what the system says beside them. Only the system's lines are gathered."""
    from pyspark.sql import Window

    m = spark.createDataFrame(TALK, "conv long, nth int, role string, text string")
    s = m.filter("role = 'system'").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("nth", "text"))).alias("a"))
    s = s.select("conv", F.array_join(F.transform("a", lambda x: x["text"]), "\n").alias("system"))
    turn = (F.row_number().over(Window.partitionBy("conv").orderBy("nth")) - 1).alias("turn")
    t = m.filter("role <> 'system'").select("conv", turn, F.when(F.col("role") == "user", "user").otherwise("model").alias("role"), "text")
    return t.join(s, "conv", "left")


@REG.add("captions_audit", _values([(4, 3, 1, 2, 0, 1, 0.672)], "clips, captioned, missing, failed, warned, exported, mean_score"))
def captions_audit(spark: SparkSession, where: str) -> DataFrame:
    """Where the captions of a corpus stand. A caption with a broken structure counts as failed."""
    c = told(spark).withColumn("c", captions.check())
    c = c.select("clip", (F.size("c.fail") > 0).alias("f"), (F.size(captions.problems()) > 0).alias("p"), (F.size("c.warn") > 0).alias("w"), captions.score(F.col("events"), F.col("c")).alias("s"))
    out = captions.exported(told(spark).filter("clip <> 'broken'")).select("clip", captions.is_exported(F.col("text")).alias("x"))
    from clipstrata.queries.prompts import REPLIES

    all_ = spark.createDataFrame([(k,) for k in REPLIES], "clip string").join(c, "clip", "left").join(out, "clip", "left")
    bad = F.coalesce(F.col("f") | F.col("p"), F.lit(False))
    return all_.agg(
        F.count("*").alias("clips"), F.count("s").alias("captioned"), F.count_if(F.col("s").isNull()).alias("missing"), F.count_if(bad).alias("failed"), F.count_if(~bad & F.coalesce("w", F.lit(False))).alias("warned"),
        F.count_if(F.coalesce("x", F.lit(False))).alias("exported"), F.round(F.avg("s"), 3).alias("mean_score"),
    )


RUNS = [("a", "written", 0, 1), ("b", "reused", 0, 0), ("c", "failed", None, None), ("d", "written", 2, 1), ("e", None, None, None), ("f", "skipped", None, None)]


@REG.add("run_summary", _values([(6, 2, 1, 1, 2, 1, 2)], "clips, written, reused, skipped, failed, with_fail, with_warn"))
def run_summary(spark: SparkSession, where: str) -> DataFrame:
    """What a run did, by the status of each clip; without one it failed."""
    r = spark.createDataFrame(RUNS, "clip string, status string, fail int, warn int")
    n = lambda k: F.count_if(F.coalesce("status", F.lit("failed")) == k).alias(k)
    return r.agg(F.count("*").alias("clips"), *[n(k) for k in ("written", "reused", "skipped", "failed")], F.count_if(F.col("fail") > 0).alias("with_fail"), F.count_if(F.col("warn") > 0).alias("with_warn"))


OLD = [("c1", [1, 2, 3], "one", None), ("c2", [1, 2], "two", None), ("c3", [4], None, None), ("c5", [7, 8], "five", "own"), ("c6", [1], "six", None)]
NEW = [("c1", [1, 2, 3], None), ("c2", [1, 3], None), ("c3", [4], None), ("c4", [9], None), ("c5", [7, 8], "own"), ("c6", None, None)]
CARRIED = [("c1", "copied", "one"), ("c2", "different frames", None), ("c3", "no caption", None), ("c4", "not in the old cut", None), ("c5", "already", "own"), ("c6", "different frames", None)]


@REG.add("caption_carryover", _values(CARRIED, "clip, outcome, caption"))
def caption_carryover(spark: SparkSession, where: str) -> DataFrame:
    """Captions taken over from an older cut of the same clips: only where both hold the same frames."""
    old = spark.createDataFrame([o[:3] for o in OLD], "clip string, old_frames array<int>, told string")
    new = spark.createDataFrame(NEW, "clip string, frames array<int>, own string")
    x = new.join(old.withColumn("there", F.lit(True)), "clip", "left")
    same = F.coalesce(F.col("frames") == F.col("old_frames"), F.lit(False))
    outcome = F.when(F.col("there").isNull(), "not in the old cut").when(F.col("told").isNull(), "no caption").when(F.col("own").isNotNull(), "already").when(~same, "different frames").otherwise("copied")
    return x.select("clip", outcome.alias("outcome"), F.when(outcome == "copied", F.col("told")).otherwise(F.col("own")).alias("caption"))


MADE = {"depth": {"backend": "moge"}, "semantic": {"refiner": "sam"}, "proxy_duv": True}
CUTS = [
    ("done", json.dumps(MADE), 124, 124, 124, True), ("short video", json.dumps(MADE), 120, 124, 124, False), ("hole", json.dumps(MADE), 124, 124, 123, False), ("other model", json.dumps({**MADE, "depth": {"backend": "old"}}), 124, 124, 124, False),
    ("no report", None, 124, 124, 124, False), ("broken report", "{", 124, 124, 124, False), ("own size", json.dumps({**MADE, "duv_size": [1280, 720]}), 124, 124, 124, False),
]


@REG.add("clips_done", _values([(c[0], c[5]) for c in CUTS], "clip, done"))
def clips_done(spark: SparkSession, where: str) -> DataFrame:
    """Whether a clip needn't be cut again: both videos and all frames are there, and it was made the way it would be now."""
    c = spark.createDataFrame([x[:5] for x in CUTS], "clip string, report string, target int, proxy int, held int")
    want = F.struct(F.lit("moge").alias("depth"), F.lit("sam").alias("refiner"), F.lit(True).alias("proxy_duv"), F.array(F.lit(336), F.lit(192)).alias("duv_size"))
    made = audit.provenance(F.col("report"))
    done = F.coalesce(made == want, F.lit(False)) & (F.col("target") == 124) & (F.col("proxy") == 124) & (F.col("held") == 124)
    return c.select("clip", done.alias("done"))


@REG.add("placeholders", _values([("a", None), ("b", "depth=synthetic"), ("c", "depth=synthetic, semantic=synthetic")], "scene, placeholders"))
def placeholders(spark: SparkSession, where: str) -> DataFrame:
    """Which parts of a scene were made by stand-ins."""
    s = spark.createDataFrame([("a", "moge", "panoptic"), ("b", "synthetic", "panoptic"), ("c", "synthetic", "synthetic")], "scene string, depth string, semantic string")
    used = F.array_compact(F.array(*[F.when(F.col(c) == "synthetic", f"{c}=synthetic") for c in ("depth", "semantic")]))
    return s.select("scene", F.when(F.size(used) > 0, F.array_join(used, ", ")).alias("placeholders"))


OVERRIDES = [("x1", None, None), ("x2", "accept", "reject"), ("x3", "reject", "maybe"), ("x4", "reject", None), ("x5", "reject", "accept")]


@REG.add("final_verdicts", _values([("x1", None, False), ("x2", "reject", True), ("x3", "reject", False), ("x4", "reject", False), ("x5", "accept", True)], "clip, final, overridden"))
def final_verdicts(spark: SparkSession, where: str) -> DataFrame:
    """A person's verdict stands above the rule's; anything but accept and reject is none."""
    o = spark.createDataFrame(OVERRIDES, "clip string, decision string, override string")
    active = F.when(F.col("override").isin("accept", "reject"), F.col("override"))
    return o.select("clip", F.coalesce(active, F.col("decision")).alias("final"), active.isNotNull().alias("overridden"))


@REG.add("tidy_issues", "SELECT clip, count(*) AS issues, count(*) FILTER (i.start IS NOT NULL AND i.stop IS NOT NULL) AS timed, count(*) FILTER (lower(i.severity) = 'major') AS major FROM (SELECT clip, unnest(issues) AS i FROM quality WHERE clip IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip ORDER BY written_at DESC NULLS LAST) = 1) GROUP BY clip")
def tidy_issues(spark: SparkSession, where: str) -> DataFrame:
    """The latest issues of each clip in their canonical form."""
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "issues", "duration"])
    i = q.select("clip", F.explode(gating.canonical_issues("duration")).alias("i"))
    return i.groupBy("clip").agg(F.count("*").alias("issues"), F.count_if(F.col("i.start").isNotNull() & F.col("i.stop").isNotNull()).alias("timed"), F.count_if(F.col("i.severity") == "major").alias("major"))


ENV = "# comment\n\nA=1\n B = 'two words' ,\nC=\"x=y\"\nD=held\nnothing\n=odd\nA=again\nE=,\n"


@REG.add("env_settings", _values([("A", "1"), ("B", "two words"), ("C", "x=y"), ("E", "")], "key, value"))
def env_settings(spark: SparkSession, where: str) -> DataFrame:
    """Settings from a file, never above what is already set."""
    path = new_folder(spark, "env") + "/.env"
    readers.put(spark, path, ENV.encode())
    return readers.settings(spark, path, {"D": "own"})


SCENE = [("depth", "000000.npy"), ("depth", "000001.npy"), ("semantic", "000000.png"), ("color", "000000.png"), (None, "odd.partial")]


@REG.add("dropped_streams", _values([("none", 5), ("all", 1), ("depth", 3), (" Depth, semantic", 2)], "keep, gone"))
def dropped_streams(spark: SparkSession, where: str) -> DataFrame:
    """How many files of a scene go for each choice of streams to keep; what belongs to none goes with the rest."""
    files, out = spark.createDataFrame(SCENE, "stream string, name string"), None
    for keep in ("none", "all", "depth", " Depth, semantic"):
        one = readers.dropped(files, readers.kept_streams(keep)).agg(F.count("*").alias("gone")).select(F.lit(keep).alias("keep"), "gone")
        out = one if out is None else out.unionByName(one)
    return out
