"""The Parquet tables, and the views of them that stand for the frames, planes and captions of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, where: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{where}/{name}.parquet")


def clip_number(clip: Column) -> Column:
    """The scene's number in a clip's name (``clip_000123_2`` -> ``000123``), null if the name has another form."""
    found = F.regexp_extract(clip, r"^clip_(\d+)_\d+$", 1)
    return F.when(found != "", found)


def clip_scene(clip: Column) -> Column:
    return F.concat(F.lit("seg_"), clip_number(clip))


def clip_index(clip: Column) -> Column:
    found = F.regexp_extract(clip, r"^clip_\d+_(\d+)$", 1)
    return F.when(found != "", found).cast("int")


def stated_scene(scene: Column) -> Column:
    """A scene as written; null where it is missing (null, empty or ``?``)."""
    return F.when(~F.trim(scene).isin("", "?"), scene)


#: Classes of the frame stream that stands for an episode.
EVENT_CLASSES = ("click", "error", "purchase", "signup", "view")


def frames(spark: SparkSession, where: str) -> DataFrame:
    """(ep, ordinal, depth, cls): one frame for each event, in the order of time within its user."""
    from pyspark.sql import Window

    e = table(spark, where, "events").select("user_id", "ts", "event_id", "value", "event_type")
    cls = F.array_position(F.array(*[F.lit(x) for x in EVENT_CLASSES]), F.col("event_type")) - 1
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(F.col("user_id").alias("ep"), nth.alias("ordinal"), F.col("value").alias("depth"), cls.cast("int").alias("cls"))


def pixels(spark: SparkSession, where: str) -> DataFrame:
    """(seg, ordinal, r, c, depth, cls, frame_cls): 8 x 8 planes from the vectors, 124 to a segment.

    Values below 0.02 count as no depth; the class of a pixel is its value's band among twelve.
    """
    v = table(spark, where, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("p", "x"))
    x = F.abs(F.col("x").cast("double"))
    return v.select(
        F.expr("vec_id div 124").alias("seg"), F.expr("cast(vec_id % 124 as int)").alias("ordinal"), F.expr("p div 8").cast("int").alias("r"), F.expr("p % 8").alias("c"),
        F.when(x >= 0.02, x * 40).otherwise(0.0).alias("depth"), F.least(F.floor(x * 40).cast("int"), F.lit(11)).alias("cls"), F.col("label").alias("frame_cls"),
    )


FRAMES_SQL = """
WITH frames AS (
  SELECT user_id AS ep, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ordinal, value AS depth,
    list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS cls FROM events
)"""

PIXELS_SQL = """
WITH vec AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings
), px AS (
  SELECT vec_id // 124 AS seg, CAST(vec_id % 124 AS INT) AS ordinal, CAST(p // 8 AS INT) AS r, CAST(p % 8 AS INT) AS c,
    CASE WHEN abs(CAST(v AS DOUBLE)) >= 0.02 THEN abs(CAST(v AS DOUBLE)) * 40 ELSE 0.0 END AS depth,
    least(CAST(floor(abs(CAST(v AS DOUBLE)) * 40) AS INT), 11) AS cls, label AS frame_cls FROM vec
)"""
