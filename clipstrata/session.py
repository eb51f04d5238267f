"""What the operators need to know about the session they run in."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset (tests), a new temporary one;
    on a cluster that is an error, as the hosts don't share it."""
    sc = spark.sparkContext
    here = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not here:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="clipstrata-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        here = "file://" + own
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(here)
    return here.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one. ``clear`` deletes those that a session made."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made(spark).append(path)
    return path


def _made(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_clipstrata_folders"):
        sc._clipstrata_folders = []
    return sc._clipstrata_folders


def clear(spark: SparkSession) -> int:
    """Deletes the copies that the operators stored in the shared folder; how many. Results that were made before must have
    been written or read, as they read from these copies; so must folders that were handed out."""
    made, n = _made(spark), 0
    while made:
        p = spark._jvm.org.apache.hadoop.fs.Path(made.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def cut(df: DataFrame, *, eager: bool = True) -> DataFrame:
    """Ends the lineage at a copy in the shared folder, so a lost executor costs no recomputation of what came before."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A copy as Parquet in the shared folder, read back: smaller than a checkpoint, and columns can be pruned."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: str = "16m") -> None:
    """Batches that go to Python end at this many bytes as well as rows, so long texts need no more memory than short ones.
    A size that the session already states stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, size)


def latest(df: DataFrame, keys: list[str], by: str, keep: list[str]) -> DataFrame:
    """One row for each key: the one with the greatest ``by``, equal ones settled by the values of ``keep`` in order.

    It is an aggregate, not a window: rows are combined before the shuffle, so a key with a third of all rows is no hot
    task. A null ``by`` is older than any other; rows with a null key are left out.
    """
    best = F.max(F.struct(by, *[c for c in keep if c != by])).alias("_best")
    full = df.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    return full.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in keep])


def looked_up(rows: DataFrame, table: DataFrame, on: str, spread_by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to a table that has each ``on`` once. A value that many rows have is spread over the tasks by
    ``spread_by``, a column of ``rows``; each row of the table is sent to all of them."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_salt"))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(n)).cast("int")).join(many, [on, "_salt"], how).drop("_salt")


def finite(x: Column) -> Column:
    """True for a number, false for null, NaN and the infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
