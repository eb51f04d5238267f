"""Queries over texts, judgements and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.functions import text as T
from clipstrata.operators import gating
from clipstrata.operators.ranges import numbered
from clipstrata.queries import Registry
from clipstrata.session import latest
from clipstrata.sources.tables import table

REG = Registry()

CAPTION_SQL = r"""
WITH lines AS (SELECT doc_id, generate_subscripts(string_split(text, '. '), 1) - 1 AS bin, unnest(string_split(text, '. ')) AS phrase FROM documents WHERE text IS NOT NULL
), ev AS (SELECT doc_id, CAST(bin AS INT) AS bin, phrase, (doc_id * 7 + bin * 3) % 11 / 10.0 AS confidence, (doc_id + bin) % 3 = 0 AS vehicle, (doc_id + bin) % 4 AS peds FROM lines
)"""


def events(spark: SparkSession, where: str) -> DataFrame:
    """(doc_id, bin, phrase, confidence, vehicle, peds): the sentences of a document as events of its seconds, with the
    evidence of those seconds."""
    d = table(spark, where, "documents").select("doc_id", F.posexplode(F.split("text", r"\. ")).alias("bin", "phrase"))
    s = F.col("doc_id") + F.col("bin")
    return d.select("*", (((F.col("doc_id") * 7 + F.col("bin") * 3) % 11) / 10.0).alias("confidence"), (s % 3 == 0).alias("vehicle"), (s % 4).alias("peds"))


def _alt(words: tuple[str, ...]) -> str:
    return "(?i)\\b(" + "|".join(words) + ")\\b"


CHECK_SQL = CAPTION_SQL + f""", ck AS (SELECT *, confidence >= 0.5 AND regexp_matches(phrase, '{_alt(T.VEHICLE_WORDS)}') AND NOT vehicle AS fail,
  confidence >= 0.5 AND regexp_matches(phrase, '{_alt(T.CROWD_WORDS)}') AND peds = 0 AS warn FROM ev)"""


def _checked(spark: SparkSession, where: str) -> DataFrame:
    e = events(spark, where)
    sure = F.col("confidence") >= 0.5
    return e.select("*", (sure & F.col("phrase").rlike(T.word(T.VEHICLE_WORDS)) & ~F.col("vehicle")).alias("fail"), (sure & F.col("phrase").rlike(T.word(T.CROWD_WORDS)) & (F.col("peds") == 0)).alias("warn"))


@REG.add("caption_checks", CHECK_SQL + " SELECT doc_id, count(*) AS events, count(*) FILTER (fail) AS fails, count(*) FILTER (warn) AS warns FROM ck GROUP BY doc_id")
def caption_checks(spark: SparkSession, where: str) -> DataFrame:
    """Sentences that name vehicles or people where the evidence has none."""
    return _checked(spark, where).groupBy("doc_id").agg(F.count("*").alias("events"), F.count_if("fail").alias("fails"), F.count_if("warn").alias("warns"))


@REG.add(
    "caption_score",
    CHECK_SQL + " SELECT doc_id, CASE WHEN count(*) FILTER (fail) > 0 THEN 0.0 ELSE round(greatest(0.0, avg(confidence) - 0.05 * count(*) FILTER (warn)), 3) END AS score FROM ck GROUP BY doc_id",
)
def caption_score(spark: SparkSession, where: str) -> DataFrame:
    s = F.when(F.count_if("fail") > 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), F.avg("confidence") - 0.05 * F.count_if("warn")), 3))
    return _checked(spark, where).groupBy("doc_id").agg(s.alias("score"))


@REG.add(
    "caption_problems",
    """WITH b AS (SELECT clip, bin, count(*) AS n FROM bins GROUP BY clip, bin), s AS (SELECT clip, max(bin) AS last FROM bins GROUP BY clip)
SELECT clip, 'bin ' || bin || ' is there ' || n || ' times' AS problem FROM b WHERE n > 1
UNION ALL SELECT clip, 'bin ' || bin || ' is reversed' FROM (SELECT DISTINCT clip, bin FROM bins WHERE stop < start)
UNION ALL SELECT clip, 'bin ' || k || ' is not there' FROM (SELECT clip, unnest(range(0, last + 1)) AS k FROM s) x WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.clip = x.clip AND b.bin = x.k)""",
)
def caption_problems(spark: SparkSession, where: str) -> DataFrame:
    """What is structurally wrong with the grid of each clip."""
    bins = table(spark, where, "bins").select("clip", "bin", "start", "stop")
    n = bins.groupBy("clip", "bin").agg(F.count("*").alias("n"), F.bool_or(F.col("stop") < F.col("start")).alias("back"))
    say = lambda *x: F.concat(F.lit("bin "), F.col("bin"), *x)
    twice = n.filter("n > 1").select("clip", say(F.lit(" is there "), F.col("n"), F.lit(" times")).alias("problem"))
    back = n.filter("back").select("clip", say(F.lit(" is reversed")).alias("problem"))
    due = n.groupBy("clip").agg(F.max("bin").alias("last")).select("clip", F.explode(F.expr("sequence(0, last)")).alias("bin"))
    gone = due.join(n, ["clip", "bin"], "left_anti").select("clip", say(F.lit(" is not there")).alias("problem"))
    return twice.unionByName(back).unionByName(gone)


@REG.add(
    "caption_script",
    CAPTION_SQL
    + r""", c AS (SELECT doc_id, bin, trim(regexp_replace(phrase, '\s+', ' ', 'g')) AS p FROM ev
), s AS (SELECT doc_id, bin, CASE WHEN p = '' THEN '' WHEN regexp_matches(p, '[.!?]$') THEN upper(p[1]) || p[2:] ELSE upper(p[1]) || p[2:] || '.' END AS p FROM c)
SELECT doc_id, string_agg('[' || printf('%.2f', CAST(bin AS DOUBLE)) || 's-' || printf('%.2f', bin + 1.0) || 's] ' || p, chr(10) ORDER BY bin) AS script FROM s GROUP BY doc_id""",
)
def caption_script(spark: SparkSession, where: str) -> DataFrame:
    """One stamped line a second."""
    e = events(spark, where)
    line = F.concat_ws(" ", T.stamp(F.col("bin"), F.col("bin") + 1), T.sentence(F.col("phrase")))
    lines = e.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("bin", line.alias("t")))).alias("a"))
    return lines.select("doc_id", F.array_join(F.transform("a", lambda x: x["t"]), "\n").alias("script"))


@REG.add(
    "text_clean",
    r"SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS cleaned, CASE WHEN regexp_matches(coalesce(source, ''), '^[aeiouAEIOU]') THEN 'an' ELSE 'a' END AS article FROM documents",
)
def text_clean(spark: SparkSession, where: str) -> DataFrame:
    d = table(spark, where, "documents")
    return d.select("doc_id", T.clean(F.col("text")).alias("cleaned"), T.article(F.coalesce("source", F.lit(""))).alias("article"))


_FORMS = [(c, k, f, v[i]) for c, t in (("subject", T.SUBJECT_VERBS), ("camera", T.CAMERA_VERBS)) for k, v in t.items() if k != "other" for i, f in ((0, "third"), (1, "gerund"))]
VERB_SQL = "(VALUES " + ", ".join(f"('{c}', '{k}', '{f}', '{w}')" for c, k, f, w in _FORMS) + ") v(channel, lemma, form, word)"


@REG.add(
    "verb_use",
    CAPTION_SQL + f""", t AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(phrase), '[^a-z]+', ' ', 'g')) || ' ' AS t FROM ev)
SELECT channel, lemma, form, count(*) AS n, count(DISTINCT doc_id) AS documents FROM t JOIN {VERB_SQL} ON contains(t, ' ' || word || ' ') GROUP BY ALL""",
)
def verb_use(spark: SparkSession, where: str) -> DataFrame:
    """In how many sentences each form of each verb of the vocabulary stands. The vocabulary is a constant of this package:
    its 98 forms are looked for in a sentence one by one, and no row meets another."""
    t = events(spark, where).select("doc_id", F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower("phrase"), "[^a-z]+", " ")), F.lit(" ")).alias("t"))
    here = [F.when(F.contains("t", F.lit(f" {w} ")), F.struct(F.lit(c).alias("channel"), F.lit(k).alias("lemma"), F.lit(f).alias("form"))) for c, k, f, w in _FORMS]
    v = t.select("doc_id", F.explode(F.array_compact(F.array(*here))).alias("v")).select("doc_id", "v.*")
    return v.groupBy("channel", "lemma", "form").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("documents"))


_LEMMAS = list(T.SUBJECT_VERBS)
_STRIP = "CASE " + " ".join(
    f"WHEN v = {i} THEN CASE " + " ".join(f"WHEN l = '{w}' THEN '' WHEN starts_with(l, '{w} ') THEN trim(p[{len(w) + 2}:])" for w in (*T.SUBJECT_VERBS[k], k)) + " ELSE p END" for i, k in enumerate(_LEMMAS)
) + " END"


@REG.add(
    "strip_verb",
    CAPTION_SQL
    + f""", n AS (SELECT doc_id, bin, list_contains(['{"', '".join(_LEMMAS)}'], string_split(lower(trim(phrase)), ' ')[1]) AS own, trim(phrase) AS p FROM ev
), f AS (SELECT doc_id, bin, v.i AS v, v.w || ' ' || p AS p, v.w || ' ' || lower(p) AS l FROM n, (SELECT i, w FROM (VALUES {", ".join(f"({i}, '{x}')" for i, k in enumerate(_LEMMAS) for x in (*T.SUBJECT_VERBS[k], k))}) t(i, w)) v WHERE (n.doc_id + n.bin) % {len(_LEMMAS)} = v.i)
SELECT doc_id, bin, v, {_STRIP} AS complement FROM f""",
)
def strip_verb(spark: SparkSession, where: str) -> DataFrame:
    """Sentences with a verb of the vocabulary put in front, in each of its forms, and taken off again; verbs in turn."""
    e = events(spark, where)
    v = F.pmod(F.col("doc_id") + F.col("bin"), F.lit(len(_LEMMAS))).cast("int")
    forms = F.array(*[F.array(*[F.lit(x) for x in (*T.SUBJECT_VERBS[k], k)]) for k in _LEMMAS])
    x = e.select("doc_id", "bin", v.alias("v"), F.trim("phrase").alias("p"), F.explode(F.element_at(forms, v + 1)).alias("w"))
    lemma = F.element_at(F.array(*[F.lit(k) for k in _LEMMAS]), F.col("v") + 1)
    return x.select("doc_id", "bin", "v", T.complement(F.concat_ws(" ", "w", "p"), lemma, F.lit("subject")).alias("complement"))


@REG.add("canonical_newlines", r"SELECT doc_id, regexp_replace(trim(text), '\r\n|\r|\n', chr(13) || chr(10), 'g') AS text FROM documents WHERE trim(text) <> ''")
def canonical_newlines(spark: SparkSession, where: str) -> DataFrame:
    """Texts as they go to disk, with one kind of line end."""
    return table(spark, where, "documents").filter("trim(text) <> ''").select("doc_id", T.crlf(F.col("text")).alias("text"))


@REG.add("json_extract", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type")
def json_extract(spark: SparkSession, where: str) -> DataFrame:
    """The object in a reply with words around it."""
    said = F.concat(F.lit("The answer is "), F.col("props"), F.lit(" as asked."))
    k = F.try_variant_get(T.json_object(said), "$.k", "long")
    return table(spark, where, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@REG.add(
    "synonyms",
    r"""WITH s AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[;,]')) AS s FROM documents), c AS (SELECT doc_id, trim(regexp_replace(s, '\s+', ' ', 'g')) AS s FROM s)
SELECT doc_id, count(*) AS n FROM c WHERE s <> '' GROUP BY doc_id""",
)
def synonyms(spark: SparkSession, where: str) -> DataFrame:
    d = table(spark, where, "documents").select("doc_id", F.size(T.synonyms(F.col("text"))).cast("long").alias("n"))
    return d.filter("n > 0")


@REG.add(
    "log_triage",
    r"""WITH l AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS a FROM documents WHERE text IS NOT NULL
), t AS (SELECT doc_id, text, a[-1] AS last FROM l)
SELECT CASE WHEN last IS NULL THEN 'empty' WHEN regexp_matches(last, 'Shard \d+ finished') THEN 'finished' WHEN contains(text, 'mask was empty') THEN 'raised' ELSE 'killed' END AS verdict, count(*) AS n FROM t GROUP BY verdict""",
)
def log_triage(spark: SparkSession, where: str) -> DataFrame:
    """How each log ended, from its last line."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    last = F.try_element_at(lines, F.lit(-1))
    v = F.when(last.isNull(), "empty").when(last.rlike(r"Shard \d+ finished"), "finished").when(F.contains("text", F.lit("mask was empty")), "raised").otherwise("killed")
    return table(spark, where, "documents").filter("text IS NOT NULL").groupBy(v.alias("verdict")).agg(F.count("*").alias("n"))


@REG.add(
    "error_kinds",
    r"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, 'The (\w+) label', 1)) AS kind FROM documents)
SELECT kind, count(*) AS n, min(doc_id) AS example FROM m GROUP BY kind""",
)
def error_kinds(spark: SparkSession, where: str) -> DataFrame:
    m = table(spark, where, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"The (\w+) label"), F.lit(1))).alias("kind"))
    return m.groupBy("kind").agg(F.count("*").alias("n"), F.min("doc_id").alias("example"))


@REG.add("declared_shards", r"SELECT doc_id, CAST(regexp_extract(text, 'Shard (\d+) finished (\d+)', 1) AS INT) AS shard, CAST(regexp_extract(text, 'Shard (\d+) finished (\d+)', 2) AS INT) AS clips FROM documents WHERE regexp_matches(text, 'Shard \d+ finished \d+')")
def declared_shards(spark: SparkSession, where: str) -> DataFrame:
    p = r"Shard (\d+) finished (\d+)"
    d = table(spark, where, "documents").filter(F.col("text").rlike(p))
    return d.select("doc_id", F.regexp_extract("text", p, 1).cast("int").alias("shard"), F.regexp_extract("text", p, 2).cast("int").alias("clips"))


LATEST_QUALITY = "WITH q AS (SELECT * FROM quality WHERE clip IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip ORDER BY written_at DESC NULLS LAST) = 1)"
REASONS_SQL = LATEST_QUALITY + """, r AS (
  SELECT clip, list_concat(list_filter([CASE WHEN lower(trim(verdict)) = 'reject' THEN 'verdict' END, CASE WHEN depth_temporal < 3 THEN 'depth_temporal < 3' END, CASE WHEN depth_accuracy < 3 THEN 'depth_accuracy < 3' END,
    CASE WHEN semantic_temporal < 3 THEN 'semantic_temporal < 3' END, CASE WHEN semantic_accuracy < 3 THEN 'semantic_accuracy < 3' END], lambda x: x IS NOT NULL),
    list_sort(list_distinct(list_transform(list_filter(coalesce(issues, []), lambda i: lower(i.severity) = 'major'), lambda i: 'major ' || lower(i.track) || ' ' || lower(i.kind))))) AS reasons,
    round((coalesce(depth_temporal, 0) + coalesce(depth_accuracy, 0) + coalesce(semantic_temporal, 0) + coalesce(semantic_accuracy, 0)) / 20.0, 3) AS score FROM q)"""


def judged(spark: SparkSession, where: str) -> DataFrame:
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "verdict", *gating.SCORES, "issues", "duration"])
    return q.select("*", gating.reasons().alias("reasons"), gating.score().alias("score"))


@REG.add("judge_decide", REASONS_SQL + " SELECT clip, CASE WHEN len(reasons) > 0 THEN 'reject' ELSE 'accept' END AS decision, score, array_to_string(reasons, '; ') AS why FROM r")
def judge_decide(spark: SparkSession, where: str) -> DataFrame:
    return judged(spark, where).select("clip", F.when(F.size("reasons") > 0, "reject").otherwise("accept").alias("decision"), "score", F.array_join("reasons", "; ").alias("why"))


@REG.add("decline_reasons", REASONS_SQL + " SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason")
def decline_reasons(spark: SparkSession, where: str) -> DataFrame:
    return judged(spark, where).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@REG.add(
    "quality_audit",
    REASONS_SQL
    + """, s AS (SELECT DISTINCT seg AS clip FROM seg_stats), x AS (SELECT s.clip, r.reasons, r.score FROM s LEFT JOIN r USING (clip))
SELECT count(*) AS clips, count(reasons) AS judged, count(*) FILTER (len(reasons) = 0) AS accepted, count(*) FILTER (len(reasons) > 0) AS rejected, count(*) FILTER (reasons IS NULL) AS unjudged, round(avg(score), 3) AS mean_score FROM x""",
)
def quality_audit(spark: SparkSession, where: str) -> DataFrame:
    s = table(spark, where, "seg_stats").select(F.col("seg").alias("clip")).distinct()
    x = s.join(judged(spark, where), "clip", "left")
    return x.agg(
        F.count("*").alias("clips"), F.count("reasons").alias("judged"), F.count_if(F.size("reasons") == 0).alias("accepted"), F.count_if(F.size("reasons") > 0).alias("rejected"),
        F.count_if(F.col("reasons").isNull()).alias("unjudged"), F.round(F.avg("score"), 3).alias("mean_score"),
    )


@REG.add(
    "judge_validate",
    LATEST_QUALITY
    + """, p AS (SELECT clip, list_filter([CASE WHEN NOT coalesce(depth_temporal BETWEEN 1 AND 5, false) THEN 'depth_temporal off the scale' END, CASE WHEN NOT coalesce(depth_accuracy BETWEEN 1 AND 5, false) THEN 'depth_accuracy off the scale' END,
  CASE WHEN NOT coalesce(semantic_temporal BETWEEN 1 AND 5, false) THEN 'semantic_temporal off the scale' END, CASE WHEN NOT coalesce(semantic_accuracy BETWEEN 1 AND 5, false) THEN 'semantic_accuracy off the scale' END,
  CASE WHEN NOT coalesce(lower(trim(verdict)) IN ('accept', 'reject'), false) THEN 'unknown verdict' END,
  CASE WHEN len(list_filter(issues, lambda i: NOT coalesce(lower(i.track) IN ('depth', 'semantic') AND lower(i.severity) IN ('minor', 'major'), false))) > 0 THEN 'unknown track or severity' END], lambda x: x IS NOT NULL) AS a FROM q)
SELECT clip, len(a) AS n, array_to_string(a, '; ') AS problems FROM p WHERE len(a) > 0""",
)
def judge_validate(spark: SparkSession, where: str) -> DataFrame:
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "verdict", *gating.SCORES, "issues"])
    q = q.select("clip", gating.problems(q).alias("a"))
    return q.filter(F.size("a") > 0).select("clip", F.size("a").cast("long").alias("n"), F.array_join("a", "; ").alias("problems"))


@REG.add(
    "canonical_issues",
    LATEST_QUALITY
    + """, i AS (SELECT clip, duration AS d, unnest(issues) AS i FROM q), t AS (SELECT clip, lower(i.track) AS track, lower(i.kind) AS kind, lower(i.severity) AS severity,
  CASE WHEN i.start IS NULL THEN NULL ELSE round(CASE WHEN d IS NULL THEN greatest(i.start, 0) ELSE least(greatest(i.start, 0), d) END, 2) END AS a,
  CASE WHEN i.stop IS NULL THEN NULL ELSE round(CASE WHEN d IS NULL THEN greatest(i.stop, 0) ELSE least(greatest(i.stop, 0), d) END, 2) END AS b FROM i)
SELECT clip, track, kind, severity, CASE WHEN b < a THEN b ELSE a END AS start, CASE WHEN b < a THEN a ELSE b END AS stop FROM t""",
)
def canonical_issues(spark: SparkSession, where: str) -> DataFrame:
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "issues", "duration"])
    # a missing time stays missing; least and greatest would skip it
    q = q.select("clip", "duration", F.explode("issues").alias("i"))
    at = lambda x: F.when(x.isNotNull(), F.round(F.least(F.greatest(x, F.lit(0.0)), F.col("duration")), 2))
    q = q.select("clip", *[F.lower(f"i.{c}").alias(c) for c in ("track", "kind", "severity")], at(F.col("i.start")).alias("a"), at(F.col("i.stop")).alias("b"))
    return q.select("clip", "track", "kind", "severity", F.when(F.col("b") < F.col("a"), F.col("b")).otherwise(F.col("a")).alias("start"), F.when(F.col("b") < F.col("a"), F.col("a")).otherwise(F.col("b")).alias("stop"))


@REG.add(
    "override_log",
    "SELECT clip, count(*) AS entries, arg_max(verdict, (written_at, arrived_at, verdict)) AS latest FROM (SELECT DISTINCT clip, verdict, written_at, arrived_at FROM quality WHERE verdict IS NOT NULL) GROUP BY clip",
)
def override_log(spark: SparkSession, where: str) -> DataFrame:
    """The latest of the verdicts written about a clip, and how many there were."""
    q = table(spark, where, "quality").filter("verdict IS NOT NULL AND clip IS NOT NULL").select("clip", "verdict", "written_at", "arrived_at").distinct()
    return q.groupBy("clip").agg(F.count("*").alias("entries"), F.max(F.struct("written_at", "arrived_at", "verdict"))["verdict"].alias("latest"))


@REG.add(
    "gate_split",
    REASONS_SQL
    + """, ok AS (SELECT DISTINCT s.seg AS clip, split_part(s.seg, '_', 2) AS ep FROM seg_stats s SEMI JOIN r ON r.clip = s.seg AND len(r.reasons) = 0 WHERE s.valid_fraction > 0.9
), e AS (SELECT ep, row_number() OVER (ORDER BY ep) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT ep FROM ok)
), v AS (SELECT DISTINCT (i.i * n) // 24 AS i FROM (SELECT max(n) AS n FROM e), range(24) i(i))
SELECT clip, CASE WHEN v.i IS NULL THEN 'train' ELSE 'validation' END AS split FROM ok JOIN e USING (ep) LEFT JOIN v ON v.i = e.i""",
)
def gate_split(spark: SparkSession, where: str) -> DataFrame:
    """Clips that pass the gates, with every n-th episode held out as a whole."""
    good = judged(spark, where).filter(F.size("reasons") == 0).select(F.col("clip").alias("seg"))
    s = table(spark, where, "seg_stats").filter("valid_fraction > 0.9").select("seg").distinct().join(good, "seg", "left_semi")
    ok = s.select(F.col("seg").alias("clip"), F.element_at(F.split("seg", "_"), 2).alias("ep"))
    e = ok.select("ep").distinct()
    # numbered by ranges: a running count needs no single task
    e = numbered(e, "ep")
    n = e.agg(F.count("*").alias("n"))
    held = n.select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("j"), "n").select(F.expr("(j * n) div 24").alias("i")).distinct()
    e = e.join(F.broadcast(held.withColumn("held", F.lit(True))), "i", "left")  # 24 rows
    return ok.join(e.select("ep", "held"), "ep").select("clip", F.when(F.col("held"), "validation").otherwise("train").alias("split"))


@REG.add(
    "scene_numbering",
    "SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS i FROM (SELECT DISTINCT sample_id FROM episodes WHERE sample_id IS NOT NULL)",
)
def scene_numbering(spark: SparkSession, where: str) -> DataFrame:
    return numbered(table(spark, where, "episodes").select("sample_id").dropna().distinct(), "sample_id")


@REG.add("strided_shard", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS shard FROM orders")
def strided_shard(spark: SparkSession, where: str) -> DataFrame:
    return numbered(table(spark, where, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", (F.col("i") % 7).alias("shard"))


@REG.add("one_per_episode", "SELECT scene, arg_min(clip, md5(clip)) AS clip FROM (SELECT DISTINCT clip, 'seg_' || split_part(clip, '_', 2) AS scene FROM scored) GROUP BY scene")
def one_per_episode(spark: SparkSession, where: str) -> DataFrame:
    """One clip of each episode, the same at each run: the least by a hash of its name."""
    s = table(spark, where, "scored").filter("clip IS NOT NULL").select("clip", F.concat(F.lit("seg_"), F.element_at(F.split("clip", "_"), 2)).alias("scene"))
    return s.groupBy("scene").agg(F.min(F.struct(F.md5("clip"), "clip"))["clip"].alias("clip"))


@REG.add(
    "stratified_pick",
    """WITH s AS (SELECT clip, semantic_flicker AS f, depth_jitter AS j FROM scored WHERE clip IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip ORDER BY scored_at DESC) = 1
), a AS (SELECT clip FROM s WHERE isfinite(f) ORDER BY f DESC, clip LIMIT 5), b AS (SELECT clip FROM s WHERE isfinite(j) ORDER BY j DESC, clip LIMIT 5
), rest AS (SELECT clip, row_number() OVER (ORDER BY f, clip) - 1 AS i, count(*) OVER () AS n FROM s WHERE isfinite(f) AND clip NOT IN (FROM a) AND clip NOT IN (FROM b)
), room AS (SELECT 40 - count(*) AS m FROM (FROM a UNION FROM b))
SELECT clip, 'worst flicker' AS picked_as FROM a UNION ALL SELECT clip, 'worst jitter' FROM b WHERE clip NOT IN (FROM a)
UNION ALL SELECT clip, 'spread' FROM rest, room, range(40) k(k) WHERE k.k < m AND i = round_even(k.k * (n - 1) / (m - 1), 0)""",
)
def stratified_pick(spark: SparkSession, where: str) -> DataFrame:
    """The worst on either axis, then an even spread over the rest by flicker."""
    s = latest(table(spark, where, "scored"), ["clip"], "scored_at", ["scored_at", "semantic_flicker", "depth_jitter"])
    s = s.select("clip", F.col("semantic_flicker").alias("f"), F.col("depth_jitter").alias("j"))
    real = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    a = s.filter(real("f")).orderBy(F.col("f").desc(), "clip").limit(5).select("clip", F.lit("worst flicker").alias("picked_as"))
    b = s.filter(real("j")).orderBy(F.col("j").desc(), "clip").limit(5).select("clip", F.lit("worst jitter").alias("picked_as"))
    worst = a.unionByName(b.join(a, "clip", "left_anti"))
    rest = s.filter(real("f")).join(F.broadcast(worst), "clip", "left_anti").select("clip", F.struct("f", "clip").alias("o"))
    rest = numbered(rest, "o")
    size = rest.agg(F.count("*").alias("n")).crossJoin(worst.agg((40 - F.count("*")).alias("m")))  # one row each
    at = size.select("n", "m", F.explode(F.expr("sequence(0L, m - 1)")).alias("k")).select(F.rint(F.col("k") * (F.col("n") - 1) / (F.col("m") - 1)).cast("long").alias("i"))
    return worst.unionByName(rest.join(F.broadcast(at), "i").select("clip", F.lit("spread").alias("picked_as")))


@REG.add("provenance_survey", "SELECT doc_kind, lower(lang) AS lang, count(*) AS n, min(written_at) AS first, max(written_at) AS last FROM documents GROUP BY ALL")
def provenance_survey(spark: SparkSession, where: str) -> DataFrame:
    d = table(spark, where, "documents").groupBy("doc_kind", F.lower("lang").alias("lang"))
    return d.agg(F.count("*").alias("n"), F.min("written_at").alias("first"), F.max("written_at").alias("last"))


@REG.add("stream_footprint", r"SELECT regexp_extract(path, '\.([a-z]+)$', 1) AS kind, count(*) AS files, CAST(sum(n_bytes) AS BIGINT) AS bytes, count(*) FILTER (n_bytes IS NULL) AS unknown FROM window_files GROUP BY kind")
def stream_footprint(spark: SparkSession, where: str) -> DataFrame:
    f = table(spark, where, "window_files").groupBy(F.regexp_extract("path", r"\.([a-z]+)$", 1).alias("kind"))
    return f.agg(F.count("*").alias("files"), F.sum("n_bytes").alias("bytes"), F.count_if(F.col("n_bytes").isNull()).alias("unknown"))


@REG.add("discover_episodes", r"SELECT DISTINCT regexp_extract(video, '([^/]+)/video\.mp4$', 1) AS take, coalesce(annotations, regexp_replace(video, 'video\.mp4$', 'annotations.tar')) AS annotations FROM episodes WHERE video IS NOT NULL")
def discover_episodes(spark: SparkSession, where: str) -> DataFrame:
    """Takes from the paths of their videos, with the annotations beside them where none are named."""
    e = table(spark, where, "episodes").filter("video IS NOT NULL")
    beside = F.regexp_replace("video", r"video\.mp4$", "annotations.tar")
    return e.select(F.regexp_extract("video", r"([^/]+)/video\.mp4$", 1).alias("take"), F.coalesce("annotations", beside).alias("annotations")).distinct()


@REG.add("clips_manifest", "SELECT scene, idx, count(*) AS rows, min(ordinal) AS first, max(ordinal) AS last, arg_min(src_file, (k, src_file)) AS opens_in FROM windows GROUP BY scene, idx")
def clips_manifest(spark: SparkSession, where: str) -> DataFrame:
    w = table(spark, where, "windows").groupBy("scene", "idx")
    return w.agg(F.count("*").alias("rows"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.min(F.struct("k", "src_file"))["src_file"].alias("opens_in"))


@REG.add(
    "resume_antijoin",
    "SELECT o.o_orderkey, CASE WHEN n IS NULL THEN 'missing' WHEN n < 3 THEN 'incomplete' ELSE 'complete' END AS status FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l_orderkey",
)
def resume_antijoin(spark: SparkSession, where: str) -> DataFrame:
    n = table(spark, where, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") < 3, "incomplete").otherwise("complete")
    return table(spark, where, "orders").select("o_orderkey").join(n, "o_orderkey", "left").select("o_orderkey", status.alias("status"))


@REG.add("fingerprint", "SELECT clip, substr(sha256(concat_ws('|', clip, model, prompt)), 1, 16) AS mark FROM (SELECT DISTINCT clip, model, prompt FROM quality)")
def fingerprint(spark: SparkSession, where: str) -> DataFrame:
    """Sixteen digits that change with any setting that changes the result."""
    q = table(spark, where, "quality").select("clip", "model", "prompt").distinct()
    return q.select("clip", F.substring(F.sha2(F.concat_ws("|", "clip", "model", "prompt"), 256), 1, 16).alias("mark"))
