"""Judgements of clips: validation of replies, and what follows from them by rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORES = ("depth_temporal", "depth_accuracy", "semantic_temporal", "semantic_accuracy")


def problems(df: DataFrame) -> Column:
    """What is wrong with a reply, in a fixed order: scores off 1 to 5, the verdict, issues without a known track."""
    bad = [F.when(~F.coalesce(F.col(s).between(1, 5), F.lit(False)), f"{s} off the scale") for s in SCORES]
    bad.append(F.when(~F.coalesce(F.lower(F.trim("verdict")).isin("accept", "reject"), F.lit(False)), "unknown verdict"))
    off = F.exists("issues", lambda i: ~F.coalesce(F.lower(i["track"]).isin("depth", "semantic") & F.lower(i["severity"]).isin("minor", "major"), F.lit(False)))
    bad.append(F.when(F.coalesce(off, F.lit(False)), "unknown track or severity"))
    return F.array_compact(F.array(*bad))


def canonical_issues(duration: str) -> Column:
    """Issues with lower-case names, times within the clip at two digits, reversed ones in order."""

    def one(i: Column) -> Column:
        # a missing time stays missing; least and greatest would skip it
        at = lambda x: F.when(x.isNotNull(), F.round(F.least(F.greatest(x, F.lit(0.0)), F.col(duration)), 2))
        a, b = at(i["start"]), at(i["stop"])
        return F.struct(
            F.lower(i["track"]).alias("track"), F.lower(i["kind"]).alias("kind"), F.lower(i["severity"]).alias("severity"),
            F.when(b < a, b).otherwise(a).alias("start"), F.when(b < a, a).otherwise(b).alias("stop"),
        )

    return F.transform(F.coalesce(F.col("issues"), F.array()), one)


def reasons(*, least: int = 3, trust: bool = True, major: bool = True) -> Column:
    """Every reason against a judged clip: the verdict, low scores, and each kind of major issue once."""
    out = F.array_compact(F.array(*([F.when(F.lower(F.trim("verdict")) == "reject", "verdict")] if trust else []), *[F.when(F.col(s) < least, f"{s} < {least}") for s in SCORES]))
    if major:
        big = F.filter(F.coalesce(F.col("issues"), F.array()), lambda i: F.lower(i["severity"]) == "major")
        out = F.concat(out, F.array_sort(F.array_distinct(F.transform(big, lambda i: F.concat_ws(" ", F.lit("major"), F.lower(i["track"]), F.lower(i["kind"]))))))
    return out


def score() -> Column:
    return F.round(sum((F.coalesce(F.col(s), F.lit(0)) for s in SCORES), F.lit(0)) / 20.0, 3)
