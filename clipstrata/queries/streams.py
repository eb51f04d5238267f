"""Queries that run a stream to its end and give what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.queries import Registry
from clipstrata.session import new_folder
from clipstrata.sources.tables import FRAMES_SQL, frames, table
from clipstrata.streaming import stateful

REG = Registry()


def _source(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@REG.add(
    "stream_flicker",
    FRAMES_SQL
    + """, d AS (SELECT ep, cls, lag(cls) OVER (PARTITION BY ep ORDER BY ordinal) AS p FROM frames)
SELECT ep, count(*) FILTER (p IS NOT NULL) AS compared, count(*) FILTER (p <> cls) AS changed FROM d GROUP BY ep""",
)
def stream_flicker(spark: SparkSession, where: str) -> DataFrame:
    """The flicker meter over the frames as a stream."""
    stateful.set_up(spark)
    src = _source(spark, frames(spark, where).select("ep", "ordinal", "cls"), "frames")
    out, mark = new_folder(spark, "flicker"), new_folder(spark, "state")
    stateful.run_to_table(stateful.flicker_stream(src), out, mark, "update")
    all_ = spark.read.parquet(out)
    return all_.groupBy("ep").agg(F.max(F.struct("batch", "compared", "changed")).alias("x")).select("ep", "x.compared", "x.changed")


def _halves(spark: SparkSession, df: DataFrame, name: str, first, rest, run) -> None:
    """Runs a stream over some rows to its end, then, started anew with the same state, over the others."""
    path = new_folder(spark, name)
    df.filter(first).write.parquet(path)
    run(spark.readStream.schema(df.schema).parquet(path))
    df.filter(rest).write.mode("append").parquet(path)
    run(spark.readStream.schema(df.schema).parquet(path))


@REG.add(
    "stream_window_median",
    FRAMES_SQL
    + """, m AS (SELECT ep, ordinal, cls, quantile_cont(CASE WHEN depth > 0 THEN depth END, 0.5) OVER w AS median, """
    + ", ".join(f"sum(CASE WHEN cls = {k} THEN 1 ELSE 0 END) OVER w + CASE WHEN cls = {k} THEN 1 ELSE 0 END AS v{k}" for k in range(5))
    + """ FROM frames WINDOW w AS (PARTITION BY ep ORDER BY ordinal ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT ep, ordinal, round(coalesce(median, 0), 6) AS median, CAST(list_position([v0, v1, v2, v3, v4], greatest(v0, v1, v2, v3, v4)) - 1 AS INT) AS voted, CAST(cls AS INT) AS raw FROM m""",
)
def stream_window_median(spark: SparkSession, where: str) -> DataFrame:
    """The sliding stabiliser over the frames in two runs, the second of which goes on from the state of the first and closes
    the episodes: every frame comes out once."""
    stateful.set_up(spark)
    f = frames(spark, where).select("ep", F.col("ordinal").cast("long").alias("ordinal"), "depth", "cls")
    ends = f.select("ep").distinct().select("ep", F.lit(None).cast("long").alias("ordinal"), F.lit(None).cast("double").alias("depth"), F.lit(None).cast("int").alias("cls"))
    out, mark = new_folder(spark, "median"), new_folder(spark, "state")
    early = F.coalesce(F.col("ordinal") < 30, F.lit(False))
    _halves(spark, f.unionByName(ends), "frames", early, ~early, lambda src: stateful.run_to_table(stateful.steady_stream(src), out, mark, "append"))
    return spark.read.parquet(out).select("ep", "ordinal", F.round("median", 6).alias("median"), "voted", "raw")


@REG.add(
    "stream_range_guard",
    FRAMES_SQL
    + """, h AS (SELECT ep, depth, pow(2, floor(log2(depth)) - 10) AS step FROM frames)
SELECT ep, count(*) AS valid, count(*) FILTER (depth < 50) AS near, count(*) FILTER (depth > 400) AS far, quantile_cont(round_even(depth / step, 0) * step, 0.5) AS median FROM h WHERE depth > 0 GROUP BY ep""",
)
def stream_range_guard(spark: SparkSession, where: str) -> DataFrame:
    """The range guard over the frames in two runs; its median is of the depths in half precision."""
    stateful.set_up(spark)
    f = frames(spark, where).select("ep", F.col("ordinal").cast("long").alias("ordinal"), "depth")
    out, mark = new_folder(spark, "guard"), new_folder(spark, "state")
    _halves(spark, f, "frames", F.col("ordinal") < 30, F.col("ordinal") >= 30, lambda src: stateful.run_to_table(stateful.guard_stream(src), out, mark, "update"))
    last = spark.read.parquet(out).groupBy("ep").agg(F.max(F.struct("batch", "valid", "near", "far", "median")).alias("x"))
    return last.select("ep", "x.valid", "x.near", "x.far", "x.median")


@REG.add(
    "stream_daily_counts",
    """WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT day, event_type, n FROM d WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def stream_daily_counts(spark: SparkSession, where: str) -> DataFrame:
    """Days that the watermark has closed."""
    src = _source(spark, table(spark, where, "events").select("ts", "event_type"), "events")
    out, mark = new_folder(spark, "days"), new_folder(spark, "state")
    stateful.run_to_table(stateful.daily_counts(src), out, mark, "append")
    return spark.read.parquet(out).select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n")
