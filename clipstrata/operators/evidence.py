"""What each second of a clip's composite stream shows, as facts that a caption can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.functions.encode import DUV_SKY, GROUPS, metres_of_duv
from clipstrata.operators import tracks
from clipstrata.plans.windows import to_bins

# Pixels of a person far away in a frame of 336 x 192, and codes a frame that mean motion.
PERSON, FRAME, MOVING = 8, 336 * 192, 0.5
_ID = {name: i for i, name in enumerate(GROUPS)}


def least_pixels(pixels: int) -> int:
    """The least region that counts as a person, the same share of a frame of any size."""
    return max(1, round(PERSON / FRAME * pixels))


def measured(px: DataFrame, grid: DataFrame, h: int, w: int) -> DataFrame:
    """(seg, bin, frames, player, peds, vehicle, ego_vehicle, shares, box, motion, depth percentiles) from pixels
    (seg, ordinal, r, c, red, g) and bins (seg, bin, first_frame, stop_frame).

    Frames are reduced first, so what meets for a second is one row a frame, and one a depth code. Motion is the mean change
    of the code between frames that follow each other, over pixels with depth in both. Shares are means over frames; the box
    is the median of the player's boxes, people the median of the regions of their class.
    """
    by = Window.partitionBy("seg", "r", "c").orderBy("ordinal")
    both = (F.lag("ordinal").over(by) == F.col("ordinal") - 1) & (F.lag("red").over(by) < DUV_SKY) & (F.col("red") < DUV_SKY)
    d = px.withColumn("_d", F.when(both, F.abs(F.col("red") - F.lag("red").over(by))))
    mine = F.col("g") == _ID["player"]
    edge = lambda x, n: F.round(x / n, 3)
    f = d.groupBy("seg", "ordinal").agg(
        *[(F.count_if(F.col("g") == i) / F.count("*")).alias(f"_{name}") for name, i in _ID.items()], F.avg("_d").alias("_d"),
        edge(F.min(F.when(mine, F.col("c"))), w).alias("_x0"), edge(F.min(F.when(mine, F.col("r"))), h).alias("_y0"),
        edge(F.max(F.when(mine, F.col("c"))) + 1, w).alias("_x1"), edge(F.max(F.when(mine, F.col("r"))) + 1, h).alias("_y1"),
    )
    people = tracks.components(px.withColumn("cls", F.col("g")), _ID["ped"], h, w, least=least_pixels(h * w)).groupBy("seg", "ordinal").agg(F.count("*").alias("_n"))
    f = to_bins(f.join(people, ["seg", "ordinal"], "left"), grid, "seg", "ordinal")
    share = lambda name, k: F.round(F.avg(f"_{name}"), k)
    seen = lambda name: F.avg(f"_{name}") > 0
    motion = F.coalesce(F.avg("_d"), F.lit(0.0))
    facts = f.groupBy("seg", "bin").agg(
        F.count("*").alias("frames"), seen("player").alias("player"), F.floor(F.percentile(F.coalesce("_n", F.lit(0)), 0.5)).cast("int").alias("peds"), seen("vehicle").alias("vehicle"), seen("ego_vehicle").alias("ego_vehicle"),
        share("player", 5).alias("player_area"), share("sky", 3).alias("sky_frac"), share("road", 3).alias("road_frac"), share("vegetation", 3).alias("vegetation_frac"), share("static", 3).alias("static_frac"),
        *[F.round(F.percentile(f"_{c}", 0.5), 3).alias(c) for c in ("x0", "y0", "x1", "y1")], F.round(motion, 3).alias("depth_delta_code"), (motion > MOVING).alias("world_moving"),
    )
    # all pixels of a second as counts by code, of which there are 255
    codes = px.filter(F.col("red") < DUV_SKY).groupBy("seg", "ordinal", "red").agg(F.count("*").alias("n"))
    codes = to_bins(codes, grid, "seg", "ordinal").groupBy("seg", "bin", "red").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("seg", "bin").orderBy("red"))
    codes = codes.withColumn("_u", upto).withColumn("_t", F.sum("n").over(Window.partitionBy("seg", "bin")))
    at = lambda q: F.min(F.when(F.col("_u") >= F.lit(q) * F.col("_t"), F.col("red")))
    deep = codes.groupBy("seg", "bin").agg(*[F.round(metres_of_duv(at(q)), 1).alias(f"depth_p{int(q * 100)}_m") for q in (0.1, 0.5, 0.9)])
    return facts.join(deep, ["seg", "bin"], "left")
