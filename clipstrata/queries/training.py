"""Queries of the general training-data operators: periods and gaps (p1), small files (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.operators import compaction
from clipstrata.operators.intervals import periods_and_gaps, to_units
from clipstrata.queries import Registry
from clipstrata.session import cut, new_folder
from clipstrata.sources.tables import clip_index, clip_scene, table

REG = Registry()


def clip_intervals(spark: SparkSession, where: str) -> DataFrame:
    """(clip, track, a, b) in milliseconds: the bins of a clip, and the issues of all judgements of it."""
    bins = table(spark, where, "bins").select("clip", F.lit("bin").alias("track"), to_units(F.col("start")).alias("a"), to_units(F.col("stop")).alias("b"))
    issue = table(spark, where, "quality").select("clip", F.explode("issues").alias("i"))
    issue = issue.select("clip", F.lower(F.trim("i.track")).alias("track"), to_units(F.col("i.start")).alias("a"), to_units(F.col("i.stop")).alias("b"))
    return bins.unionByName(issue.filter(F.col("track").isin("depth", "semantic")))


INTERVALS_SQL = """
WITH raw AS (
  SELECT clip, 'bin' AS track, start, stop FROM bins
  UNION ALL
  SELECT clip, lower(trim(i.track)), i.start, i.stop FROM (SELECT clip, unnest(issues) AS i FROM quality)
  WHERE lower(trim(i.track)) IN ('depth', 'semantic')
), ms AS (
  SELECT clip, track, CAST(floor(start * 1000 + 0.5) AS BIGINT) AS a, CAST(floor(stop * 1000 + 0.5) AS BIGINT) AS b
  FROM raw WHERE clip IS NOT NULL AND isfinite(start) AND isfinite(stop)
), iv AS (
  SELECT clip, track, least(a, b) AS a, greatest(a, b) AS b FROM ms WHERE a <> b
), reach AS (
  SELECT *, max(b) OVER (PARTITION BY clip, track ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM iv
), isle AS (
  SELECT *, sum(CASE WHEN r >= a THEN 0 ELSE 1 END) OVER (PARTITION BY clip, track ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM reach
), period AS (
  SELECT clip, track, min(a) AS a, max(b) AS b FROM isle GROUP BY clip, track, g
), gap AS (
  SELECT clip, track, lag(b) OVER (PARTITION BY clip, track ORDER BY a) AS a, a AS b FROM period
)
"""


@REG.add(
    "p1_found",
    INTERVALS_SQL
    + """SELECT clip, track, 'period' AS what, a AS start_ms, b AS stop_ms FROM period
UNION ALL SELECT clip, track, 'gap', a, b FROM gap WHERE a IS NOT NULL""",
)
def p1_found(spark: SparkSession, where: str) -> DataFrame:
    found = periods_and_gaps(clip_intervals(spark, where), ["clip", "track"], "a", "b")
    return found.select("clip", "track", "what", F.col("start").alias("start_ms"), F.col("stop").alias("stop_ms"))


@REG.add(
    "p1_coverage",
    INTERVALS_SQL
    + """, each AS (SELECT track, 'period' AS what, a, b FROM period UNION ALL SELECT track, 'gap', a, b FROM gap WHERE a IS NOT NULL)
SELECT track, what, count(*) AS n, CAST(sum(b - a) AS BIGINT) AS total_ms, max(b - a) AS longest_ms FROM each GROUP BY track, what""",
)
def p1_coverage(spark: SparkSession, where: str) -> DataFrame:
    """How much of each track is covered and how much is not."""
    ms = F.col("stop_ms") - F.col("start_ms")
    return p1_found(spark, where).groupBy("track", "what").agg(F.count("*").alias("n"), F.sum(ms).alias("total_ms"), F.max(ms).alias("longest_ms"))


def compacted(spark: SparkSession, where: str) -> str:
    """The folder with the few files that now hold the records of ``windows``."""
    root = new_folder(spark, "p4")
    group = F.concat_ws("_", F.regexp_replace("scene", "^seg_", "clip_"), "idx")
    compaction.compact(table(spark, where, "windows"), table(spark, where, "window_files"), root, group_of=group)
    return root


@REG.add(
    "p4_found",
    """
WITH seg AS (
  SELECT 'seg_' || split_part(seg, '_', 2) AS scene, CAST(split_part(seg, '_', 3) AS INT) AS idx, max(frames) AS frames
  FROM seg_stats WHERE frames IS NOT NULL GROUP BY ALL
), due AS (SELECT scene, idx, CAST(unnest(range(0, frames)) AS INT) AS k FROM seg)
SELECT scene, idx, k, 'duplicated' AS fault FROM windows GROUP BY ALL HAVING count(*) > 1
UNION ALL
SELECT scene, idx, k, 'missing' FROM due ANTI JOIN windows USING (scene, idx, k)""",
)
def p4_found(spark: SparkSession, where: str) -> DataFrame:
    held = compaction.read(spark, compacted(spark, where))
    seg = table(spark, where, "seg_stats").select(clip_scene(F.col("seg")).alias("scene"), clip_index(F.col("seg")).alias("idx"), "frames")
    lacking = compaction.missing_numbers(held, seg, ["scene", "idx"], "k", "frames")
    twice = held.filter(F.col("copies") > 1).select("scene", "idx", "k", F.lit("duplicated").alias("fault"))
    return twice.unionByName(lacking.withColumn("fault", F.lit("missing")))


RECORDS_SQL = "SELECT scene, idx, k, min(ordinal) AS ordinal, count(*) AS copies FROM windows GROUP BY ALL"


@REG.add("p4_records", RECORDS_SQL)
def p4_records(spark: SparkSession, where: str) -> DataFrame:
    """Every record once, as the compacted files hold it."""
    return compaction.read(spark, compacted(spark, where)).select("scene", "idx", "k", "ordinal", "copies")


@REG.add("p4_inputs", "SELECT DISTINCT path FROM window_files")
def p4_inputs(spark: SparkSession, where: str) -> DataFrame:
    """The tiny files that the journal says were taken in: all of the listing, each once."""
    log = compaction.journal(spark, compacted(spark, where))
    return log.select(F.explode("inputs").alias("path")).distinct()


def grown(spark: SparkSession, where: str) -> str:
    """The folder after three transactions, each with the files of a third of the time that the listing spans; files
    without a time, and records in files that nobody listed, come last."""
    files, held = table(spark, where, "window_files"), table(spark, where, "windows")
    span = files.agg(F.min("modified_at").alias("a"), F.max("modified_at").alias("b")).first()
    group = F.concat_ws("_", F.regexp_replace("scene", "^seg_", "clip_"), "idx")
    third = (span.b - span.a) / 3 if span.a is not None else None
    call = F.lit(2) if third is None else F.when(F.col("modified_at") < span.a + third, 0).when(F.col("modified_at") < span.a + 2 * third, 1).otherwise(2)
    calls = cut(files.groupBy("path").agg(F.min(call).alias("_call")))
    root = new_folder(spark, "p4")
    records = held.join(calls.withColumnRenamed("path", "src_file"), "src_file", "left").withColumn("_call", F.coalesce("_call", F.lit(2)))
    for n in range(3):
        now = files.join(calls.filter(F.col("_call") == n), "path", "left_semi")
        compaction.compact(records.filter(F.col("_call") == n), now, root, group_of=group, tiers=compaction.Tiers(ripe=3))
    return root


@REG.add("p4_incremental", RECORDS_SQL)
def p4_incremental(spark: SparkSession, where: str) -> DataFrame:
    """Every record once with its copies, after three transactions and the removal of the outputs they took in."""
    root = grown(spark, where)
    compaction.vacuum(spark, root)
    return compaction.read(spark, root).select("scene", "idx", "k", "ordinal", "copies")


@REG.add(
    "p4_journal",
    """SELECT count(DISTINCT path) AS listed, count(DISTINCT path) AS taken, CAST(0 AS BIGINT) AS taken_twice, CAST(0 AS BIGINT) AS unnamed,
(SELECT count(*) FROM (SELECT DISTINCT scene, idx, k FROM windows)) AS records FROM window_files""",
)
def p4_journal(spark: SparkSession, where: str) -> DataFrame:
    """The journal of three transactions against the listing and the files: tiny files listed, taken in, and taken in by two
    transactions; live outputs that the journal doesn't name; records in the live outputs."""
    root = grown(spark, where)
    log = compaction.journal(spark, root)
    took = log.select("txn", F.explode("inputs").alias("path")).filter(~F.col("path").startswith("txn-")).distinct()
    took = took.groupBy("path").agg(F.count("*").alias("n")).agg(F.count("*").alias("taken"), F.count_if(F.col("n") > 1).alias("taken_twice"))
    held = compaction.read(spark, root)
    named = log.filter("output IS NOT NULL").select(F.concat("txn", F.lit("/"), "output").alias("out"))
    unnamed = held.select("out").distinct().join(named, "out", "left_anti").agg(F.count("*").alias("unnamed"))
    listed = table(spark, where, "window_files").agg(F.count_distinct("path").alias("listed"))
    one = listed.crossJoin(took).crossJoin(unnamed).crossJoin(held.agg(F.count("*").alias("records")))  # one row each
    return one.select("listed", "taken", "taken_twice", "unnamed", "records")
