"""A mix of sources at target weights, to the token where a subset of the documents allows it (above ``EXACT`` tokens of
budget: of those documents that the last ``EXACT`` tokens leave open).

A source's budget is its target share of the mix. The source goes in whole as often as the budget holds it, at most
``max_repeats`` times. For what remains, its documents are counted by exact length; a proportional part of each length is
taken, so that the mix keeps the source's lengths, and a bounded-knapsack program over the documents left finds the subset
sum nearest below the rest. Which documents of a length go in is decided by a seeded hash.

Only counts by length meet in one task: distinct lengths of a source, at most the square root of twice its tokens.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstrata.session import stored

#: Tokens that the knapsack program covers; what is above is filled with whole documents first.
EXACT = 1 << 16


def fit(lengths: list[int], counts: list[int], budget: int, *, exact: int = EXACT) -> list[int]:
    """How many documents of each length make the greatest sum that is at most ``budget``.

    Proportional parts first; then single documents from long to short until at most ``exact`` tokens remain; then a
    subset-sum over the rest. While it doesn't meet the budget, more documents that were taken go back, of all lengths, until
    the rest is ``exact`` tokens: a budget up to that is met as nearly as any subset meets it.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if total <= budget:
        return list(counts)
    if budget <= 0:
        return [0] * len(lengths)
    took = [c * budget // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, took))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if left <= exact:
            break
        more = min(counts[i] - took[i], (left - exact // 2) // lengths[i] if left > exact // 2 else 0)
        took[i] += more
        left -= more * lengths[i]
    # a document already taken may go back: with one of each longest length returned, small rests can be met as well
    many, back = 1, order[:4]
    while True:
        before = left
        for i in back:
            n = max(0, min(took[i], many, (exact - left) // lengths[i]))
            took[i] -= n
            left += n * lengths[i]
        if left > before or back is not order:
            more, open_ = _subset(lengths, [c - t for c, t in zip(counts, took)], left, order)
        if not open_ or (left == before and back is order):
            return [t + m for t, m in zip(took, more)]
        many, back = many * 2 if back is order else 1, order


def _subset(lengths: list[int], free_of: list[int], left: int, order: list[int]) -> tuple[list[int], int]:
    """How many documents of each length make the greatest sum up to ``left``, and what stays open: with one bit for each
    reachable sum and counts split in powers of two."""
    mask, sums, items = (1 << (left + 1)) - 1, [1], []
    for i in reversed(order):
        free, part = min(free_of[i], left // lengths[i]), 1
        while free and not sums[-1] >> left & 1:
            n = min(part, free)
            items.append((i, n))
            sums.append((sums[-1] | sums[-1] << n * lengths[i]) & mask)
            free, part = free - n, part * 2
        if sums[-1] >> left & 1:
            break
    took, best = [0] * len(lengths), sums[-1].bit_length() - 1
    open_ = left - best
    for k in range(len(items), 0, -1):
        i, n = items[k - 1]
        if not sums[k - 1] >> best & 1:
            took[i] += n
            best -= n * lengths[i]
    return took, open_


def _plan(exact: int):
    def plan(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_n")
        took = fit(pdf["_n"].tolist(), pdf["_c"].tolist(), int(pdf["_rest"].iloc[0]), exact=exact)
        return pd.DataFrame({"_source": pdf["_source"], "_n": pdf["_n"], "_take": took})

    return plan


def clean_source(source: str) -> Column:
    """Lower case, without outer blanks."""
    return F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def sizes(docs: DataFrame, targets: DataFrame, *, source: str, tokens: str, share: str, repeats: str) -> DataFrame:
    """(source, share, repeats, size, total, budget, full, rest) of each source of ``targets``."""
    have = docs.groupBy(clean_source(source).alias("_source")).agg(F.sum(tokens).alias("_size"))
    want = targets.select(clean_source(source).alias("_source"), F.coalesce(F.col(share), F.lit(0.0)).alias("_share"), F.greatest(F.coalesce(F.col(repeats), F.lit(0)), F.lit(0)).cast("long").alias("_repeats"))
    want = want.filter(F.col("_source").isNotNull()).groupBy("_source").agg(F.sum("_share").alias("_share"), F.max("_repeats").alias("_repeats"))
    both = want.join(have, "_source", "left").withColumn("_size", F.coalesce("_size", F.lit(0)).cast("long"))
    total = both.agg(F.sum("_size").alias("_total"))
    both = both.crossJoin(F.broadcast(total))  # one row
    both = both.withColumn("_budget", F.floor(F.col("_share") * F.col("_total")).cast("long"))
    full = F.when(F.col("_size") > 0, F.least(F.col("_repeats"), F.expr("_budget div nullif(_size, 0)"))).otherwise(F.lit(0)).cast("long")
    both = both.withColumn("_full", full)
    rest = F.when(F.col("_full") < F.col("_repeats"), F.col("_budget") - F.col("_full") * F.col("_size")).otherwise(F.lit(0)).cast("long")
    return both.withColumn("_rest", rest)


def mix(
    docs: DataFrame, targets: DataFrame, *, doc: str = "doc_id", source: str = "source", tokens: str = "n_tokens", share: str = "target_share", repeats: str = "max_repeats", seed: int = 1, exact: int = EXACT
) -> tuple[DataFrame, DataFrame]:
    """(mix, report). Mix: (doc, source, tokens, times) of each document that goes in. Report: for each source of
    ``targets`` its target and actual share and tokens, the mean repeats, and ``short``: it can't reach its target.

    Sources are compared in lower case without outer blanks; a source without a target, or null, isn't mixed. Documents
    without tokens aren't mixed. A source named twice in ``targets`` has the sum of the shares and the larger repeats.
    A null share or repeats is 0. Repeated rows are documents of their own. The same seed gives the same mix.
    """
    d = docs.select(F.col(doc).alias("_doc"), clean_source(source).alias("_source"), F.col(tokens).cast("long").alias("_n")).filter("_source IS NOT NULL AND _n > 0")
    d = d.withColumn("_x", F.xxhash64(F.lit(seed), F.col("_doc").cast("string")))
    d = d.withColumn("_h", F.pmod("_x", F.lit(1024)))
    plan = stored(sizes(d.select(F.col("_source").alias(source), F.col("_n").alias(tokens)), targets, source=source, tokens=tokens, share=share, repeats=repeats), "mix")
    counts = stored(d.groupBy("_source", "_n", "_h").agg(F.count("*").alias("_c")), "lengths")
    hist = counts.groupBy("_source", "_n").agg(F.sum("_c").alias("_c")).join(plan.select("_source", "_rest"), "_source")
    take = hist.groupBy("_source").applyInPandas(_plan(exact), "_source string, _n long, _take long")
    take = stored(take, "take")
    ahead = Window.partitionBy("_source", "_n").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    cuts = counts.select("_source", "_n", "_h", "_c", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_o")).join(take, ["_source", "_n"])
    nth = F.row_number().over(Window.partitionBy("_source", "_n", "_h").orderBy("_x", "_doc")) + F.col("_o")
    chosen = d.join(cuts.select("_source", "_n", "_h", "_o", "_take"), ["_source", "_n", "_h"]).withColumn("_i", nth)
    full = plan.select("_source", "_full")
    if plan.count() <= 100_000:  # some 40 bytes a source, so that no source is a hot key of the join
        full = F.broadcast(full)
    chosen = chosen.join(full, "_source")
    times = (F.col("_full") + F.when(F.col("_i") <= F.col("_take"), 1).otherwise(0)).cast("long")
    out = chosen.select(F.col("_doc").alias(doc), F.col("_source").alias(source), F.col("_n").alias(tokens), times.alias("times")).filter("times > 0")
    picked = take.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_take")).alias("_picked"))
    got = plan.join(picked, "_source", "left").withColumn("_got", F.col("_full") * F.col("_size") + F.coalesce("_picked", F.lit(0)))
    # a source is short if the mix holds all its documents as often as it may and is still below the target
    got = got.withColumn("_short", (F.col("_got") >= F.col("_size") * F.col("_repeats")) & (F.col("_got") < F.col("_share") * F.col("_total")))
    all_ = got.agg(F.sum("_got").alias("_all"))
    report = got.crossJoin(F.broadcast(all_)).select(
        F.col("_source").alias(source), F.col("_share").alias("target_share"), F.coalesce(F.try_divide("_got", "_all"), F.lit(0.0)).alias("actual_share"),
        F.col("_size").alias("size"), F.col("_budget").alias("budget"), F.col("_got").alias("mixed"), F.try_divide("_got", "_size").alias("repeats"), F.col("_short").alias("short"),
    )
    return out, report
