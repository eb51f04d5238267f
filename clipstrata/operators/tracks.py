"""Connected components of masks and greedy linking of them to tracks: the parts whose result depends on an order.

They run as grouped maps, one frame or one clip at a time; everything before and after is relational.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOBS = "seg long, ordinal int, blob int, area long, x double, y double, left int, top int, right int, bottom int"
TRACKED = "seg long, ordinal int, blob int, area long, x double, y double, track int"


@dataclass(frozen=True)
class Prior:
    """Where the protagonist is expected; distances are shares of the width of the frame."""

    # Limits of the delivered splits.
    anchor: tuple[float, float] = (0.5, 0.55)
    anchor_distance: float = 0.22
    area: float = 0.0008
    link: float = 0.10
    gap: int = 2
    length: int = 3
    margin: float = 1.5
    presence: float = 0.5
    merged: float = 0.25


def label_mask(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the regions of a mask that hang together over sides or corners, in order of their first pixel."""
    h, w = mask.shape
    up = np.where(mask.ravel(), np.arange(h * w), -1)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for r, c in zip(*mask.nonzero()):
        for dr, dc in ((0, -1), (-1, -1), (-1, 0), (-1, 1)):
            y, x = r + dr, c + dc
            if 0 <= y and 0 <= x < w and mask[y, x]:
                a, b = root(r * w + c), root(y * w + x)
                up[max(a, b)] = min(a, b)
    out, names = np.zeros(h * w, np.int32), {}
    for i in mask.ravel().nonzero()[0]:
        out[i] = names.setdefault(root(i), len(names) + 1)
    return out.reshape(h, w)


def components(px: DataFrame, cls: int, h: int, w: int, *, least: int = 1) -> DataFrame:
    """(seg, ordinal, blob, area, x, y, box) of the regions of one class in each frame, at least ``least`` pixels each."""

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((h, w), bool)
        mask[p["r"], p["c"]] = True
        lab = label_mask(mask)
        rows = []
        for k in range(1, lab.max() + 1):
            ys, xs = (lab == k).nonzero()
            if len(ys) >= least:
                rows.append((key[0], key[1], k, len(ys), xs.mean(), ys.mean(), xs.min(), ys.min(), xs.max() + 1, ys.max() + 1))
        return pd.DataFrame(rows, columns=["seg", "ordinal", "blob", "area", "x", "y", "left", "top", "right", "bottom"])

    return px.filter(F.col("cls") == cls).select("seg", "ordinal", "r", "c").groupBy("seg", "ordinal").applyInPandas(one, BLOBS)


def link(blobs: DataFrame, h: int, w: int, prior: Prior | None = None) -> DataFrame:
    """Adds ``track``: each blob, in order of frame and number, joins the nearest track in reach or starts one."""
    prior = prior or Prior()

    def clip(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        b = b[b["area"] >= prior.area * h * w].sort_values(["ordinal", "blob"])
        ends: list[tuple[int, float, float]] = []
        out = []
        for o, x, y in zip(b["ordinal"], b["x"], b["y"]):
            near = [(np.hypot(ex - x, ey - y), t) for t, (eo, ex, ey) in enumerate(ends) if eo != o and o - eo <= prior.gap]
            best = min(near, default=None)
            if best is not None and best[0] < prior.link * max(h, w):
                t = best[1]
                ends[t] = (o, x, y)
            else:
                t = len(ends)
                ends.append((o, x, y))
            out.append(t)
        return b.assign(track=out)[["seg", "ordinal", "blob", "area", "x", "y", "track"]]

    return blobs.select("seg", "ordinal", "blob", "area", "x", "y").groupBy("seg").applyInPandas(clip, TRACKED)


def protagonist(tracked: DataFrame, frames: DataFrame, h: int, w: int, prior: Prior | None = None) -> DataFrame:
    """(seg, track, score, reason): the track the camera follows, or why none is named. ``frames``: (seg, n)."""
    from pyspark.sql import Window

    prior = prior or Prior()
    ax, ay = prior.anchor[0] * w, prior.anchor[1] * h
    off = F.sqrt((F.col("x") - ax) ** 2 + (F.col("y") - ay) ** 2)
    t = tracked.groupBy("seg", "track").agg(F.count("*").alias("len"), (F.percentile(off, 0.5) / w).alias("dist"), F.percentile("area", 0.5).alias("area"))
    t = t.filter(F.col("len") >= prior.length).join(frames, "seg")
    t = t.withColumn("score", F.col("len") / F.col("n") / (1 + F.col("dist") / prior.anchor_distance) * F.sqrt(F.col("area") / (h * w)))
    by = Window.partitionBy("seg").orderBy(F.col("score").desc(), "track")
    t = t.withColumn("_i", F.row_number().over(by)).withColumn("_next", F.lead("score").over(by)).filter("_i = 1")
    big = tracked.join(t.select("seg", "track", F.col("area").alias("_mid")), ["seg", "track"])
    big = big.groupBy("seg").agg(F.avg((F.col("area") > 1.6 * F.col("_mid")).cast("double")).alias("_merged"))
    reason = (
        F.when(F.col("track").isNull(), "no track is long enough").when(F.col("dist") > prior.anchor_distance, "nobody is near the anchor")
        .when(F.col("len") < prior.presence * F.col("n"), "seen too rarely").when(F.col("score") < prior.margin * F.col("_next"), "two tracks are too close")
        .when(F.col("_merged") > prior.merged, "merged with others too often").otherwise("named")
    )
    all_ = frames.select("seg").join(t, "seg", "left").join(big, "seg", "left").withColumn("reason", reason)
    return all_.select("seg", F.when(F.col("reason") == "named", F.col("track")).alias("track"), F.round("score", 6).alias("score"), "reason")


def blob_pixels(px: DataFrame, cls: int, h: int, w: int) -> DataFrame:
    """(seg, ordinal, r, c, blob) of the pixels of one class, with the region they belong to."""

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        mask = np.zeros((h, w), bool)
        mask[p["r"], p["c"]] = True
        lab = label_mask(mask)
        return p.assign(blob=lab[p["r"], p["c"]])[["seg", "ordinal", "r", "c", "blob"]]

    own = px.filter(F.col("cls") == cls).select(F.col("seg").cast("long").alias("seg"), "ordinal", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"))
    return own.groupBy("seg", "ordinal").applyInPandas(one, "seg long, ordinal int, r int, c int, blob int")


def hero(tracked: DataFrame, frames: DataFrame, *, length: int = 3, presence: float = 0.5, margin: float = 1.5, merged: float = 0.25) -> DataFrame:
    """(seg, track, score, reason): the track that stays still in the picture while the world goes by, or why none is named.

    A track's wander is the mean of the standard deviations of its places along both axes. ``frames``: (seg, n).
    """
    from pyspark.sql import Window

    t = tracked.groupBy("seg", "track").agg(F.count("*").alias("len"), ((F.stddev_pop("x") + F.stddev_pop("y")) / 2).alias("wander"), F.percentile("area", 0.5).alias("area"))
    t = t.filter(F.col("len") >= length).join(frames, "seg")
    t = t.withColumn("score", F.col("len") / F.col("n") * F.sqrt("area") / (1 + F.col("wander")))
    by = Window.partitionBy("seg").orderBy(F.col("score").desc(), "track")
    t = t.withColumn("_next", F.lead("score").over(by)).withColumn("_i", F.row_number().over(by)).filter("_i = 1")
    swollen = tracked.join(t.select("seg", "track", F.col("area").alias("_mid")), ["seg", "track"])
    swollen = swollen.groupBy("seg").agg(F.avg((F.col("area") > 1.6 * F.col("_mid")).cast("double")).alias("_merged"))
    alone = F.col("_next").isNull()
    reason = (
        F.when(F.col("track").isNull(), "no track is long enough").when(alone & (F.col("len") < presence * F.col("n")), "seen too rarely")
        .when(~alone & (F.col("score") < margin * F.col("_next")), "two tracks are too close").when(F.col("_merged") > merged, "merged with others too often").otherwise("named")
    )
    all_ = frames.select("seg").join(t, "seg", "left").join(swollen, "seg", "left").withColumn("reason", reason)
    return all_.select("seg", F.when(F.col("reason") == "named", F.col("track")).alias("track"), F.round("score", 6).alias("score"), F.round("_merged", 6).alias("merged"), "reason")


def relabelled(px: DataFrame, pixels_of: DataFrame, tracked: DataFrame, chosen: DataFrame, to: int) -> DataFrame:
    """The planes with the chosen track's regions in class ``to``. ``pixels_of``: see ``blob_pixels``."""
    own = tracked.join(chosen.filter("track IS NOT NULL").select("seg", "track"), ["seg", "track"]).select("seg", "ordinal", "blob")
    mine = pixels_of.join(own, ["seg", "ordinal", "blob"]).select("seg", "ordinal", "r", "c", F.lit(to).alias("_to"))
    out = px.join(mine, ["seg", "ordinal", "r", "c"], "left")
    return out.withColumn("cls", F.coalesce("_to", "cls").cast("int")).drop("_to")


def anchor_patch(h: int, w: int, prior: Prior | None = None, reach: float = 0.15) -> tuple[int, int, int, int]:
    """(top, bottom, left, right), half-open, of the patch about the anchor."""
    prior = prior or Prior()
    half, x, y = int(reach * w), int(prior.anchor[0] * w), int(prior.anchor[1] * h)
    return max(y - half, 0), min(y + half, h), max(x - half, 0), min(x + half, w)


def driving(px: DataFrame, cls: int, h: int, w: int, prior: Prior | None = None, *, cover: float = 0.5) -> DataFrame:
    """(seg, cover, driving): how much of the patch about the anchor a class covers, over all frames."""
    top, bottom, left, right = anchor_patch(h, w, prior)
    inside = (F.col("r") >= top) & (F.col("r") < bottom) & (F.col("c") >= left) & (F.col("c") < right)
    share = F.avg((F.col("cls") == cls).cast("double"))
    return px.filter(inside).groupBy("seg").agg(F.round(share, 6).alias("cover"), (share > cover).alias("driving"))


def owners(masks: DataFrame) -> DataFrame:
    """(seg, ordinal, r, c, object): of the masks that hold a pixel in a frame, (seg, ordinal, object, r, c), the one with the
    smallest area there; of equals the later object."""
    area = masks.groupBy("seg", "ordinal", "object").agg(F.count("*").alias("_a"))
    x = masks.join(area, ["seg", "ordinal", "object"])
    return x.groupBy("seg", "ordinal", "r", "c").agg(F.min(F.struct("_a", (-F.col("object")).alias("_o")))["_o"].alias("_o")).select("seg", "ordinal", "r", "c", (-F.col("_o")).alias("object"))


def mask_classes(px: DataFrame, masks: DataFrame) -> DataFrame:
    """(seg, object, cls, votes): the class that most pixels of a mask have over the whole clip, the lowest id of equals."""
    n = masks.join(px.select("seg", "ordinal", "r", "c", "cls"), ["seg", "ordinal", "r", "c"]).groupBy("seg", "object", "cls").agg(F.count("*").alias("n"))
    top = n.groupBy("seg", "object").agg(F.max(F.struct("n", (-F.col("cls")).alias("k"))).alias("m"))
    return top.select("seg", "object", (-F.col("m.k")).alias("cls"), F.col("m.n").alias("votes"))


def composed(px: DataFrame, masks: DataFrame) -> DataFrame:
    """The planes with each pixel that a mask owns in the mask's class, and ``held``; others keep their own."""
    own = owners(masks).join(mask_classes(px, masks).select("seg", "object", F.col("cls").alias("_to")), ["seg", "object"]).drop("object")
    out = px.join(own, ["seg", "ordinal", "r", "c"], "left")
    return out.withColumns({"cls": F.coalesce("_to", "cls").cast("int"), "held": F.col("_to").isNotNull()}).drop("_to")


def seeds(px: DataFrame, blobs: DataFrame, held: DataFrame, *, coverage: float = 0.5) -> DataFrame:
    """(seg, ordinal, cls, blob, agreed): regions that no mask of their own class covers well enough, which start masks of
    their own. ``blobs``: (seg, ordinal, r, c, cls, blob); ``held``: (seg, ordinal, r, c, cls) of owned pixels with their mask's
    class. A mask of another class that a region lies in doesn't count for it."""
    x = blobs.alias("b").join(held.alias("h"), ["seg", "ordinal", "r", "c"], "left").select("seg", "ordinal", F.col("b.cls").alias("cls"), "blob", F.coalesce(F.col("h.cls") == F.col("b.cls"), F.lit(False)).alias("_ok"))
    return x.groupBy("seg", "ordinal", "cls", "blob").agg(F.avg(F.col("_ok").cast("double")).alias("agreed")).filter(F.col("agreed") < coverage)
