"""Relational queries over the star schema: every kind of join, set operation and grouping the operators build on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipstrata.queries import Registry
from clipstrata.sources.tables import table

REG = Registry()


def _t(spark: SparkSession, where: str, *names: str) -> list[DataFrame]:
    return [table(spark, where, n) for n in names]


@REG.add(
    "pricing_summary",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""",
)
def pricing_summary(spark: SparkSession, where: str) -> DataFrame:
    (li,) = _t(spark, where, "lineitem")
    li = li.filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )


@REG.add(
    "join_revenue_by_nation",
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def join_revenue_by_nation(spark: SparkSession, where: str) -> DataFrame:
    li, o, c, n = _t(spark, where, "lineitem", "orders", "customer", "nation")
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    return x.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@REG.add("join_semi", "SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
def join_semi(spark: SparkSession, where: str) -> DataFrame:
    c, o = _t(spark, where, "customer", "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@REG.add("join_anti", "SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey")
def join_anti(spark: SparkSession, where: str) -> DataFrame:
    c, o = _t(spark, where, "customer", "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@REG.add(
    "join_full",
    "SELECT coalesce(s.k, c.k) AS k, s.n AS suppliers, c.n AS customers FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY k) s FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY k) c ON s.k = c.k",
)
def join_full(spark: SparkSession, where: str) -> DataFrame:
    s, c = _t(spark, where, "supplier", "customer")
    s = s.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return s.join(c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers")), "k", "full")


@REG.add(
    "join_asof",
    """WITH q AS (SELECT clip, written_at FROM quality WHERE clip IS NOT NULL AND written_at IS NOT NULL), s AS (SELECT DISTINCT clip, scored_at, semantic_flicker FROM scored WHERE clip IS NOT NULL)
SELECT q.clip, q.written_at, max(s.scored_at) AS scored_at FROM q LEFT JOIN s ON q.clip = s.clip AND s.scored_at <= q.written_at GROUP BY q.clip, q.written_at""",
)
def join_asof(spark: SparkSession, where: str) -> DataFrame:
    """Each judgement with the last score before it: both sides as one sorted stream, no pair of them formed."""
    q, s = _t(spark, where, "quality", "scored")
    q = q.select("clip", F.col("written_at").alias("t"), F.lit(None).cast("timestamp_ntz").alias("s"), F.lit(1).alias("ask")).dropna(subset=["clip", "t"])
    s = s.select("clip", F.col("scored_at").alias("t"), F.col("scored_at").alias("s"), F.lit(0).alias("ask")).dropna(subset=["clip", "t"])
    w = Window.partitionBy("clip").orderBy("t", "ask").rowsBetween(Window.unboundedPreceding, 0)
    both = q.unionByName(s).withColumn("scored_at", F.last("s", True).over(w))
    return both.filter("ask = 1").groupBy("clip", F.col("t").alias("written_at")).agg(F.max("scored_at").alias("scored_at"))


@REG.add("set_intersect", "SELECT clip FROM scored INTERSECT SELECT clip FROM quality")
def set_intersect(spark: SparkSession, where: str) -> DataFrame:
    a, b = _t(spark, where, "scored", "quality")
    return a.select("clip").intersect(b.select("clip"))


@REG.add("set_except", "SELECT seg AS clip FROM seg_stats EXCEPT SELECT clip FROM quality")
def set_except(spark: SparkSession, where: str) -> DataFrame:
    a, b = _t(spark, where, "seg_stats", "quality")
    return a.select(F.col("seg").alias("clip")).subtract(b.select("clip"))


@REG.add("set_union", "SELECT clip FROM scored UNION SELECT seg FROM seg_stats")
def set_union(spark: SparkSession, where: str) -> DataFrame:
    a, b = _t(spark, where, "scored", "seg_stats")
    return a.select("clip").union(b.select("seg")).distinct()


@REG.add("group_rollup", "SELECT doc_kind, lower(lang) AS lang, count(*) AS n FROM documents GROUP BY ROLLUP (doc_kind, lower(lang))")
def group_rollup(spark: SparkSession, where: str) -> DataFrame:
    (d,) = _t(spark, where, "documents")
    return d.withColumn("lang", F.lower("lang")).rollup("doc_kind", "lang").agg(F.count("*").alias("n"))


@REG.add("group_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def group_cube(spark: SparkSession, where: str) -> DataFrame:
    (o,) = _t(spark, where, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@REG.add("distinct_counts", "SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY event_type")
def distinct_counts(spark: SparkSession, where: str) -> DataFrame:
    (e,) = _t(spark, where, "events")
    return e.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"))


@REG.add("map_merge", "SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id")
def map_merge(spark: SparkSession, where: str) -> DataFrame:
    (e,) = _t(spark, where, "events")
    n = e.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    at = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0)).alias(k)
    return n.select("user_id", at("click"), at("view"))


@REG.add("date_spans", "SELECT o_orderpriority, min(o_orderdate) AS first, max(o_orderdate) AS last, date_diff('day', min(o_orderdate), max(o_orderdate)) AS days FROM orders GROUP BY o_orderpriority")
def date_spans(spark: SparkSession, where: str) -> DataFrame:
    (o,) = _t(spark, where, "orders")
    a = o.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return a.withColumn("days", F.datediff("last", "first").cast("long"))


@REG.add(
    "tumbling_windows",
    "SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
)
def tumbling_windows(spark: SparkSession, where: str) -> DataFrame:
    (e,) = _t(spark, where, "events")
    w = e.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day").alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


@REG.add(
    "session_windows",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM i GROUP BY user_id, i""",
)
def session_windows(spark: SparkSession, where: str) -> DataFrame:
    (e,) = _t(spark, where, "events")
    s = e.withColumn("ts", F.col("ts").cast("timestamp")).groupBy("user_id", F.session_window("ts", "6 hours").alias("w"))
    return s.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")
