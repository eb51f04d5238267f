"""Pixel planes as (segment, ordinal, r, c, ...) rows: block reductions and index maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blocks(df: DataFrame, keys: list[str], fh: int, fw: int) -> list[Column]:
    return [*[F.col(k) for k in keys], F.expr(f"r div {fh}").alias("br"), F.expr(f"c div {fw}").alias("bc")]


def block_depth(df: DataFrame, keys: list[str], depth: str, fh: int, fw: int, *, valid: float = 1e-3) -> DataFrame:
    """Median, least and mean of each block's depths without those that are none; 0 for a block without any."""
    d = F.when(F.coalesce(~F.isnan(depth) & (F.col(depth) > valid), F.lit(False)), F.col(depth))
    or0 = lambda x, n: F.coalesce(x, F.lit(0.0)).alias(n)
    return df.groupBy(*blocks(df, keys, fh, fw)).agg(or0(F.percentile(d, 0.5), "median"), or0(F.min(d), "least"), or0(F.avg(d), "mean"))


def block_vote(df: DataFrame, keys: list[str], cls: str, fh: int, fw: int, classes: int) -> DataFrame:
    """The most frequent class of each block, the lowest id of equals; ids beyond the classes don't vote."""
    counts = [F.count_if(F.col(cls) == k).alias(f"_v{k}") for k in range(classes)]
    out = df.groupBy(*blocks(df, keys, fh, fw)).agg(*counts)
    votes = F.array(*[F.col(f"_v{k}") for k in range(classes)])
    return out.select(*keys, "br", "bc", (F.array_position(votes, F.array_max(votes)) - 1).cast("int").alias("cls"))


def nearest(df: DataFrame, keys: list[str], h: int, w: int, to_h: int, to_w: int, values: list[str]) -> DataFrame:
    """The plane at another size: every target pixel takes the source pixel at floor(place x scale)."""
    at = df.sparkSession.range(to_h * to_w).select(
        F.expr(f"cast(id div {to_w} as int)").alias("r2"), F.expr(f"cast(id % {to_w} as int)").alias("c2")
    ).withColumns({"r": F.expr(f"cast((r2 * {h}) div {to_h} as int)"), "c": F.expr(f"cast((c2 * {w}) div {to_w} as int)")})
    return df.join(F.broadcast(at), ["r", "c"]).select(*keys, F.col("r2").alias("r"), F.col("c2").alias("c"), *values)
