"""Queries of the operators in this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.llm.garble import garbled
from clipstrata.llm.leaks import leaks
from clipstrata.llm.mixing import mix
from clipstrata.llm.ranking import Criterion, least_net, outranking
from clipstrata.llm.splits import assign, components, sample_key
from clipstrata.llm.tokens import DEFAULT, with_tokens
from clipstrata.llm.topn import LEAST_ROWS, SHARE, reads, top_n
from clipstrata.queries import Registry
from clipstrata.session import cut, finite, latest, looked_up, stored
from clipstrata.sources.tables import clip_scene, stated_scene, table

REG = Registry()

LATEST_SQL = """
WITH sc AS (
  SELECT * FROM scored WHERE clip IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY clip ORDER BY scored_at DESC NULLS LAST) = 1
), qu AS (
  SELECT * FROM quality WHERE clip IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY clip ORDER BY written_at DESC NULLS LAST) = 1
), cmp AS (
  SELECT clip, semantic_flicker AS f, depth_jitter AS j, depth_temporal AS d FROM sc JOIN qu USING (clip)
  WHERE isfinite(semantic_flicker) AND isfinite(depth_jitter) AND depth_temporal BETWEEN 1 AND 5
)
"""


def compared(spark: SparkSession, where: str) -> DataFrame:
    """Clips with all three scores, from their latest rows."""
    s = latest(table(spark, where, "scored"), ["clip"], "scored_at", ["scored_at", "semantic_flicker", "depth_jitter"])
    q = latest(table(spark, where, "quality"), ["clip"], "written_at", ["written_at", "depth_temporal"])
    s = s.filter(finite(F.col("semantic_flicker")) & finite(F.col("depth_jitter"))).select("clip", "semantic_flicker", "depth_jitter")
    return s.join(q.filter(F.col("depth_temporal").between(1, 5)).select("clip", "depth_temporal"), "clip")


def ranked(spark: SparkSession, where: str) -> DataFrame:
    scores = [Criterion("semantic_flicker"), Criterion("depth_jitter"), Criterion("depth_temporal", worse="low")]
    return outranking(compared(spark, where), "clip", scores)


def _flow_sql(i: int, score: str) -> str:
    """All pairs of clips on one score; differences of places, counted in halves, are whole numbers."""
    return f"""SELECT a.clip, sum(CASE WHEN a.r > b.r THEN greatest(0, least(a.r - b.r - q, p - q)) ELSE 0 END) - sum(CASE WHEN b.r > a.r THEN greatest(0, least(b.r - a.r - q, p - q)) ELSE 0 END) AS f{i}
  FROM (SELECT clip, {score} AS r FROM place) a, (SELECT {score} AS r FROM place) b, n GROUP BY a.clip"""


RANK_SQL = LATEST_SQL + """, place AS (
  SELECT clip, 2 * rank() OVER (ORDER BY f) - 2 + count(*) OVER (PARTITION BY f) AS r0, 2 * rank() OVER (ORDER BY j) - 2 + count(*) OVER (PARTITION BY j) AS r1,
    2 * rank() OVER (ORDER BY d DESC) - 2 + count(*) OVER (PARTITION BY d) AS r2 FROM cmp
), m AS (SELECT count(*) AS n FROM place), n AS (SELECT n, CAST(floor(2 * n * 0.02) AS BIGINT) AS q, greatest(CAST(floor(2 * n * 0.02) AS BIGINT) + 1, CAST(floor(2 * n * 0.25) AS BIGINT)) AS p FROM m
), """ + ", ".join(f"w{i} AS ({_flow_sql(i, f'r{i}')})" for i in range(3)) + """
, net AS (SELECT clip, CAST(f0 AS DOUBLE) / ((p - q) * greatest(n - 1, 1)) AS a, CAST(f1 AS DOUBLE) / ((p - q) * greatest(n - 1, 1)) AS b, CAST(f2 AS DOUBLE) / ((p - q) * greatest(n - 1, 1)) AS c FROM w0 JOIN w1 USING (clip) JOIN w2 USING (clip), n
), r AS (SELECT *, round(a / 3 + b / 3 + c / 3, 9) AS net FROM net)
SELECT clip, row_number() OVER (ORDER BY net DESC, clip) AS place, net, round(a, 9) AS semantic_flicker_net, round(b, 9) AS depth_jitter_net, round(c, 9) AS depth_temporal_net FROM r"""


@REG.add("p2_ranking", RANK_SQL)
def p2_ranking(spark: SparkSession, where: str) -> DataFrame:
    """All compared clips, worst first (place 1)."""
    nets = [F.round(x, 9).alias(x) for x in ("net", "semantic_flicker_net", "depth_jitter_net", "depth_temporal_net")]
    return ranked(spark, where).select("clip", "place", *nets)


@REG.add(
    "p2_found",
    LATEST_SQL
    + """, w AS (SELECT clip, rank() OVER (ORDER BY f) - 1 AS a, rank() OVER (ORDER BY j) - 1 AS b, rank() OVER (ORDER BY d DESC) - 1 AS c, count(*) OVER () AS n FROM cmp)
SELECT clip FROM w WHERE 10 * least(a, b, c) >= 9 * n""",
)
def p2_found(spark: SparkSession, where: str) -> DataFrame:
    """Clips near the worst end of the ranking, by net flow, that are strictly worse than nine tenths of all on every score.

    The bound on the flow loses none of them; the exact check follows on what is left."""
    worse = F.least("semantic_flicker_worse_than", "depth_jitter_worse_than", "depth_temporal_worse_than")
    worst = ranked(spark, where).filter(F.col("net") >= least_net(0.9))
    return worst.filter(10 * worse >= 9 * F.col("compared")).select("clip")


def scene_ties(spark: SparkSession, where: str) -> DataFrame:
    """(a, b): scene and sample, or two scenes. Names of scenes and samples can't meet."""
    scene = lambda c: F.concat(F.lit("scene:"), c)
    ep = table(spark, where, "episodes").select(scene(stated_scene(F.trim("scene"))).alias("a"), F.concat(F.lit("take:"), sample_key(F.col("sample_id"))).alias("b"))
    sc = table(spark, where, "scored").select(scene(clip_scene(F.col("clip"))).alias("a"), scene(stated_scene(F.trim("scene"))).alias("b"))
    return ep.unionByName(sc)


def scene_groups(spark: SparkSession, where: str) -> DataFrame:
    """(scene, root) of all scenes that are tied to something."""
    found = components(scene_ties(spark, where), "a", "b").filter(F.col("node").startswith("scene:"))
    return found.select(F.substring("node", 7, 1 << 20).alias("scene"), "root")


@REG.add(
    "p3_found",
    r"""
WITH RECURSIVE ep AS (
  SELECT regexp_replace(trim(lower(sample_id), ' ' || chr(9) || chr(10) || chr(160)), '[\s_\-]+', '_', 'g') AS s, scene FROM episodes WHERE trim(scene) NOT IN ('', '?')
), tie AS (
  SELECT x.scene AS a, y.scene AS b FROM ep x JOIN ep y USING (s) WHERE s NOT IN ('', '-', '_', 'n/a', 'unknown', 'none', 'null') AND x.scene <> y.scene
  UNION SELECT 'seg_' || split_part(clip, '_', 2), scene FROM scored WHERE trim(scene) NOT IN ('', '?') AND scene <> 'seg_' || split_part(clip, '_', 2)
), edge AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie
), reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT a AS scene_a, b AS scene_b FROM reach WHERE a < b""",
)
def p3_found(spark: SparkSession, where: str) -> DataFrame:
    """Pairs of scenes of one component: TESTDATA.md wants them spelled out."""
    g = cut(scene_groups(spark, where).distinct())
    a, b = g.select("root", F.col("scene").alias("scene_a")), g.select("root", F.col("scene").alias("scene_b"))
    return a.join(b, "root").filter(F.col("scene_a") < F.col("scene_b")).select("scene_a", "scene_b")


GROUPS_SQL = r"""
WITH RECURSIVE ep AS (
  SELECT regexp_replace(trim(lower(sample_id), ' ' || chr(9) || chr(10) || chr(160)), '[\s_\-]+', '_', 'g') AS s, scene FROM episodes WHERE trim(scene) NOT IN ('', '?')
), named AS (SELECT DISTINCT scene FROM ep UNION SELECT 'seg_' || split_part(clip, '_', 2) FROM scored WHERE clip IS NOT NULL UNION SELECT scene FROM scored WHERE trim(scene) NOT IN ('', '?')
), tie AS (
  SELECT x.scene AS a, y.scene AS b FROM ep x JOIN ep y USING (s) WHERE s NOT IN ('', '-', '_', 'n/a', 'unknown', 'none', 'null') AND x.scene <> y.scene
  UNION SELECT 'seg_' || split_part(clip, '_', 2), scene FROM scored WHERE trim(scene) NOT IN ('', '?') AND scene <> 'seg_' || split_part(clip, '_', 2)
), edge AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie
), reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
), root AS (SELECT scene, least(scene, coalesce(min(b), scene)) AS root FROM named LEFT JOIN reach ON a = scene GROUP BY scene)
SELECT scene, root, count(*) OVER (PARTITION BY root) - 1 AS links FROM root"""


@REG.add("p3_groups", GROUPS_SQL)
def p3_groups(spark: SparkSession, where: str) -> DataFrame:
    """One row a scene: the least scene it is tied to, and to how many others it is tied directly or by a chain."""
    g = cut(scene_groups(spark, where).distinct().select("scene", F.regexp_replace("root", "^scene:", "").alias("root")))
    links = g.groupBy("root").agg((F.count("*") - 1).alias("links"))
    return looked_up(g, links, "root", "scene").select("scene", "root", "links")


SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


# groups of one size take their splits in the order of their names, so the greedy rule's splits are put in order by size
SPLITS_SQL = r"""
WITH RECURSIVE ep AS (
  SELECT regexp_replace(trim(lower(sample_id), ' ' || chr(9) || chr(10) || chr(160)), '[\s_\-]+', '_', 'g') AS s, scene FROM episodes WHERE trim(scene) NOT IN ('', '?')
), tie AS (
  SELECT x.scene AS a, y.scene AS b FROM ep x JOIN ep y USING (s) WHERE s NOT IN ('', '-', '_', 'n/a', 'unknown', 'none', 'null') AND x.scene <> y.scene
  UNION SELECT 'seg_' || split_part(clip, '_', 2), scene FROM scored WHERE trim(scene) NOT IN ('', '?') AND scene <> 'seg_' || split_part(clip, '_', 2)
), edge AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie
), reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
), root AS (SELECT a AS scene, least(a, min(b)) AS root FROM reach GROUP BY a
), clips AS (
  SELECT DISTINCT 'clip_' || scene[5:] || '_' || idx AS clip, scene FROM windows WHERE scene IS NOT NULL AND idx IS NOT NULL
  UNION SELECT clip, 'seg_' || split_part(clip, '_', 2) FROM scored WHERE clip IS NOT NULL
), tied AS (SELECT clip, c.scene, coalesce(root, c.scene) AS root FROM clips c LEFT JOIN root r ON r.scene = c.scene
), grp AS (SELECT root, count(*) AS n FROM tied GROUP BY root
), ord AS (SELECT root, n, row_number() OVER (ORDER BY n DESC, root) AS i, sum(n) OVER () AS total FROM grp
), deal AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c, CAST(0 AS BIGINT) AS n, -1 AS k
  UNION ALL
  SELECT i, a + CASE WHEN k = 0 THEN n ELSE 0 END, b + CASE WHEN k = 1 THEN n ELSE 0 END, c + CASE WHEN k = 2 THEN n ELSE 0 END, n, k
  FROM (SELECT o.i, d.a, d.b, d.c, o.n, CASE WHEN 0.8::DOUBLE * total - a >= greatest(0.1::DOUBLE * total - b, 0.1::DOUBLE * total - c) THEN 0 WHEN 0.1::DOUBLE * total - b >= 0.1::DOUBLE * total - c THEN 1 ELSE 2 END AS k
        FROM deal d JOIN ord o ON o.i = d.i + 1)
), nth AS (SELECT n, k, row_number() OVER (PARTITION BY n ORDER BY k) AS j FROM deal WHERE i > 0
), home AS (SELECT o.root, k FROM (SELECT root, n, row_number() OVER (PARTITION BY n ORDER BY root) AS j FROM ord) o JOIN nth USING (n, j)
), split AS (SELECT clip, scene, root, ['train', 'validation', 'test'][k + 1] AS split FROM tied JOIN home USING (root))"""


@REG.add("p3_splits", SPLITS_SQL + " SELECT clip, scene, split FROM split")
def p3_splits(spark: SparkSession, where: str) -> DataFrame:
    """A split for every clip of windows and scored, the same for all clips whose scenes are tied."""
    w = table(spark, where, "windows").groupBy("scene", "idx").agg(F.lit(1).alias("one"))
    w = w.select(F.concat_ws("_", F.regexp_replace("scene", "^seg_", "clip_"), "idx").alias("clip"), "scene")
    s = table(spark, where, "scored").select("clip", F.coalesce(clip_scene(F.col("clip")), stated_scene(F.trim("scene"))).alias("scene"))
    clips = w.unionByName(s).dropna().distinct()
    roots = scene_groups(spark, where).distinct()
    tied = clips.join(roots, "scene", "left").withColumn("root", F.coalesce("root", F.concat(F.lit("scene:"), "scene")))
    sizes = tied.groupBy("root").agg(F.count("*").alias("clips"))
    return looked_up(tied, assign(sizes, "root", "clips", SHARES).select("root", "split"), "root", "clip").select("clip", "scene", "split")


@REG.add("p3_shares", SPLITS_SQL + " SELECT split, count(*) AS clips, count(*) / (SELECT count(*) FROM split) AS share FROM split GROUP BY split")
def p3_shares(spark: SparkSession, where: str) -> DataFrame:
    """Clips and actual share of each split."""
    n = p3_splits(spark, where).groupBy("split").agg(F.count("*").alias("clips"))
    all_ = n.agg(F.sum("clips").alias("total"))
    return n.crossJoin(F.broadcast(all_)).select("split", "clips", (F.col("clips") / F.col("total")).alias("share"))


def scene_scores(spark: SparkSession, where: str) -> DataFrame:
    s = latest(table(spark, where, "scored"), ["clip"], "scored_at", ["scored_at", "scene", "semantic_flicker", "depth_jitter"])
    return s.withColumn("scene", F.coalesce(stated_scene(F.col("scene")), clip_scene(F.col("clip"))))


# NaN is excluded by what it isn't: where a file's statistics name no NaN, the SQL engine takes isnan() to be false throughout
@REG.add(
    "p5_found",
    LATEST_SQL
    + """, named AS (
  SELECT clip, coalesce(CASE WHEN trim(scene) NOT IN ('', '?') THEN scene END, 'seg_' || split_part(clip, '_', 2)) AS scene, semantic_flicker AS f,
    CASE WHEN isfinite(depth_jitter) OR abs(depth_jitter) = 'infinity'::DOUBLE THEN depth_jitter END AS j FROM sc WHERE isfinite(semantic_flicker) OR abs(semantic_flicker) = 'infinity'::DOUBLE
)
SELECT scene, clip FROM named QUALIFY row_number() OVER (PARTITION BY scene ORDER BY f DESC, j DESC NULLS LAST, clip) <= 3""",
)
def p5_found(spark: SparkSession, where: str) -> DataFrame:
    return top_n(*best_of_scenes(spark, where)).select("scene", "clip")


def best_of_scenes(spark: SparkSession, where: str) -> tuple:
    jitter = F.coalesce(-F.when(~F.isnan("depth_jitter"), F.col("depth_jitter")), F.lit(float("nan")))  # NaN sorts last
    return scene_scores(spark, where), "scene", "semantic_flicker", 3, [jitter, F.col("clip")], ["clip"]


@REG.add("p5_reads")
def p5_reads(spark: SparkSession, where: str) -> DataFrame:
    """Row groups and rows that each wave read, and those that were skipped by their statistics."""
    return reads(*best_of_scenes(spark, where))


@REG.add(
    "p5_skipped",
    LATEST_SQL
    + """, named AS (SELECT coalesce(CASE WHEN trim(scene) NOT IN ('', '?') THEN scene END, 'seg_' || split_part(clip, '_', 2)) AS scene FROM sc WHERE isfinite(semantic_flicker) OR abs(semantic_flicker) = 'infinity'::DOUBLE
), n AS (SELECT scene, count(*) AS n FROM named GROUP BY scene)
SELECT CAST(sum(n) AS BIGINT) AS scored, max(n) AS largest, true AS skipped_where_due FROM n""",
)
def p5_skipped(spark: SparkSession, where: str) -> DataFrame:
    """All rows are accounted for, read or skipped; where the largest scene fills five row groups, some must have been skipped."""
    scores = scene_scores(spark, where).filter(F.col("semantic_flicker").isNotNull() & ~F.isnan("semantic_flicker"))
    largest = scores.groupBy("scene").agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"))
    got = reads(*best_of_scenes(spark, where)).agg(F.sum("n_rows").alias("scored"), F.bool_or(F.col("wave") == "skipped").alias("some"))
    rows = F.greatest(F.floor(F.col("scored") / SHARE), F.lit(LEAST_ROWS))
    one = got.crossJoin(F.broadcast(largest))  # one row each
    return one.select("scored", "largest", ((F.col("largest") < 5 * rows) | F.col("some")).alias("skipped_where_due"))


def mixed(spark: SparkSession, where: str) -> tuple[DataFrame, DataFrame]:
    path = spark.conf.get("clipstrata.tokenizer", DEFAULT)
    docs = with_tokens(table(spark, where, "documents").select("doc_id", "source", "text"), "text", path=path)
    return mix(stored(docs, "tokens"), table(spark, where, "mix_targets"))


# the cases are the same for any usual tokenizer; in SQL a token is a byte
@REG.add(
    "p7_found",
    """WITH d AS (SELECT lower(trim(source)) AS source, sum(strlen(text)) AS size FROM documents GROUP BY ALL
), t AS (SELECT lower(trim(source)) AS source, sum(target_share) AS share, max(max_repeats) AS repeats FROM mix_targets GROUP BY ALL
), b AS (SELECT t.*, coalesce(size, 0) AS size, sum(coalesce(size, 0)) OVER () AS total FROM t LEFT JOIN d USING (source))
SELECT source FROM b WHERE size * repeats < share * total""",
)
def p7_found(spark: SparkSession, where: str) -> DataFrame:
    """Sources of which the mix holds all that it may and still less than their target."""
    return mixed(spark, where)[1].filter("short").select("source")


@REG.add("p7_mix")
def p7_mix(spark: SparkSession, where: str) -> DataFrame:
    """The documents of the mix and how often each goes in."""
    return mixed(spark, where)[0]


@REG.add("p7_shares")
def p7_shares(spark: SparkSession, where: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixed(spark, where)[1]


@REG.add("p6_found")
def p6_found(spark: SparkSession, where: str) -> DataFrame:
    """Documents that hold a passage of an item."""
    return leaks(table(spark, where, "documents").select("doc_id", "text"), table(spark, where, "eval_items").select("item_id", "text"))


@REG.add("p6_items")
def p6_items(spark: SparkSession, where: str) -> DataFrame:
    """In how many documents each leaked item stands."""
    return p6_found(spark, where).groupBy("item_id").agg(F.count("*").alias("documents"))


@REG.add("p8_found")
def p8_found(spark: SparkSession, where: str) -> DataFrame:
    """Documents that were decoded with the wrong encoding."""
    return garbled(table(spark, where, "documents").select("doc_id", "text")).select("doc_id")


@REG.add("p8_restored")
def p8_restored(spark: SparkSession, where: str) -> DataFrame:
    """The garbled documents with their restored text."""
    return garbled(table(spark, where, "documents").select("doc_id", "text"))
