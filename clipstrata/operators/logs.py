"""Run logs of sharded workers: how each ended, what failed in it, and which run it belongs to.

A log is one row (name, text); everything is worked out on that row, and runs are told apart by counts of logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the workers print.
FINISHED = r"\d+ clips, \d+ episodes failed, manifest at "
TYPED = r"^error: \S+?: ([A-Za-z_][A-Za-z0-9_.]*(?:Error|Exception)): "
HANDLED = r"^error: (\S+?): (.*)$"
TRAILER = "that is a traceback rather than a message about your data"
BANNER = r"(?m)\[(\d+)/(\d+)\]\s*$"
TRACE = "Traceback (most recent call last)"


def _lines(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def declared(text: Column) -> Column:
    """Into how many shards the run that wrote a log split itself; null without its banner."""
    found = F.regexp_extract(text, BANNER, 2)
    return F.when(found != "", found.cast("int"))


def classified(logs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``verdict`` and ``detail``: how a log ended. A traceback that the worker handled and went on from is no end."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(_lines(t), lambda x: F.trim(x) != "")
    x = logs.withColumn("_last", F.try_element_at(lines, F.lit(-1)))
    x = x.withColumn("_end", F.when(F.contains(t, F.lit(TRACE)), F.substring_index(t, TRACE, -1)))
    raised = F.col("_end").isNotNull() & ~F.contains("_end", F.lit(TRAILER))
    has = lambda *words: F.coalesce(*[F.when(F.contains("_end", F.lit(w)), True) for w in words], F.lit(False))
    errors = F.filter(F.transform(_lines(F.col("_end")), F.trim), lambda s: s.rlike(r"^\S*(?:Error|Exception)\b"))
    final = F.coalesce(F.try_element_at(errors, F.lit(-1)), F.try_element_at(F.filter(_lines(F.col("_end")), lambda s: F.trim(s) != ""), F.lit(-1)))
    disk, cuda, host = has("No space left on device"), has("CUDA out of memory", "OutOfMemoryError"), has("MemoryError", "Cannot allocate memory")
    verdict = (
        F.when(F.col("_last").isNull(), "empty").when(F.col("_last").rlike(FINISHED), "finished").when(~raised, "killed").when(disk, "disk full")
        .when(cuda, "cuda out of memory").when(host, "host out of memory").otherwise("raised")
    )
    detail = (
        F.when(verdict == "empty", "the log is empty - the worker never started").when(verdict == "finished", F.col("_last")).when(verdict == "killed", F.concat(F.lit("stops after: "), F.substring("_last", 1, 120)))
        .when(verdict == "disk full", "the output filesystem filled mid-run").otherwise(F.substring(final, 1, 200))
    )
    return x.withColumns({"verdict": F.coalesce(verdict, F.lit("killed")), "detail": detail}).drop("_last", "_end")


def error_kinds(logs: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """(name, kind, n, example): the failures of single items in a log, with the first message of each kind."""
    lines = logs.select(name, F.posexplode(_lines(F.col(text))).alias("_i", "_l"))
    kind = F.regexp_extract("_l", TYPED, 1)
    rest = F.regexp_extract("_l", HANDLED, 2)
    after = F.element_at(F.split("_l", ": ", 3), -1)
    x = lines.filter(F.col("_l").rlike(HANDLED)).select(
        name, "_i", F.when(kind != "", kind).otherwise("(handled: a message, not a bug)").alias("kind"), F.trim(F.when(kind != "", after).otherwise(rest)).alias("_e")
    )
    return x.groupBy(name, "kind").agg(F.count("*").alias("n"), F.min(F.struct("_i", "_e"))["_e"].alias("example"))


def of_this_run(logs: DataFrame, text: str = "text", modified: str = "modified") -> DataFrame:
    """Adds ``current``: whether a log is of the run whose logs agree with their own number; where none or several do, of the
    one written last. Logs that declare one number, or none at all, are all of one run."""
    x = logs.withColumn("_of", declared(F.col(text)))
    runs = x.groupBy("_of").agg(F.count("*").alias("_n"), F.max(modified).alias("_m"))
    fresh = F.struct(F.coalesce(F.col("_n") == F.col("_of"), F.lit(False)).alias("a"), F.col("_m").alias("m"), F.coalesce("_of", F.lit(-1)).alias("of"))
    best = runs.agg(F.max(fresh)["of"].alias("_best"))
    return x.crossJoin(F.broadcast(best)).withColumn("current", F.coalesce("_of", F.lit(-1)) == F.col("_best")).drop("_of", "_best")  # one row
