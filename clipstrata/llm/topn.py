"""The N best items of every group, with row groups skipped by their statistics.

1. *Cluster.* Items are sorted by range on (group, score descending, ties) and written with row groups of a bounded number
   of rows, one part in ``SHARE`` of the table. A large group spans many row groups and files, each with a lower maximum
   than the one before; small groups share row groups. No task holds a group: ranges are cut within groups too.
2. *Statistics.* The footers give each row group's first and last group and its greatest score, one row a row group.
3. *Read, in descending order of maximum score.* In a first wave every group is read where its scores are highest: of the row
   groups that hold one group alone those with the greatest maxima, as many as hold N rows; and those that hold several.
   The latter hold the head of every group but their first, so each has scores above its groups' N-th by construction.
   This gives every group's N-th score so far. In a second wave the remaining row groups are read, but for those whose
   maximum is strictly below the N-th score so far of every group they hold. Equal maxima are read, so that ties are
   settled among all.

``reads`` tells how many row groups and rows each wave read and how many were skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipstrata.queries import ship
from clipstrata.session import new_folder, stored

#: A row group holds one part in so many of the table's rows, within bounds; groups are skipped in units of row groups, so
#: a group with a few parts in ``SHARE`` of all rows has some to skip.
SHARE, LEAST_ROWS, MOST_ROWS = 256, 16, 1 << 20

STATS = "file string, row_group int, first string, last string, best double, n long"


def _open(path: str):
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    where, inner = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pq.ParquetFile(where.open_input_file(inner))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for path in b.column(0).to_pylist():
            meta = _open(path).metadata
            col = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                one = meta.row_group(g)
                name, score = one.column(col["_g"]).statistics, one.column(col["_s"]).statistics
                known = name is not None and name.has_min_max and score is not None and score.has_min_max
                # a row group without statistics may hold anything and is always read
                rows.append((path, g, name.min if known else None, name.max if known else None, score.max if known else None, one.num_rows))
        cols = list(zip(*rows)) or [[]] * 6
        kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["file", "row_group", "first", "last", "best", "n"])


def _reader(columns: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for out in _open(path).iter_batches(row_groups=[g], columns=columns):
                    yield out

    return read


def _best(rows: DataFrame, n: int, ties: list[str]) -> DataFrame:
    order = [F.col("_s").desc(), *[F.col(c) for c in ties]]
    return rows.withColumn("_i", F.row_number().over(Window.partitionBy("_g").orderBy(*order))).filter(F.col("_i") <= n)


def _prepared(items: DataFrame, group: str, score: str, ties: list[Column], keep: list[str]) -> DataFrame:
    base = items.filter(F.col(group).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    base = base.select(F.col(group).cast("string").alias("_g"), F.col(score).cast("double").alias("_s"), *[t.alias(f"_t{i}") for i, t in enumerate(ties)], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)])
    # 0.0 and -0.0 are one score; statistics know them as two
    return base.withColumn("_s", F.col("_s") + F.lit(0.0))


def _clustered(base: DataFrame, tie: list[str], rows: int | None) -> tuple[list[str], DataFrame]:
    """(files, their footers) of the table in order."""
    spark = base.sparkSession
    order = [F.col("_g"), F.col("_s").desc(), *tie]
    path = new_folder(spark, "clustered")
    if rows is None:
        rows = min(max(base.count() // SHARE, LEAST_ROWS), MOST_ROWS)
    sorted_ = base.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_.write.option("parquet.block.row.count.limit", rows).parquet(path)
    files = spark.read.schema(base.schema).parquet(path).inputFiles()  # one entry for each task that wrote
    if not files:
        return [], spark.createDataFrame([], STATS)
    listing = spark.createDataFrame([(f,) for f in files], "file string")
    return files, stored(listing.repartition(_tasks(spark, files)).mapInArrow(_footers, STATS), "footers")


def _tasks(spark: SparkSession, files: list[str]) -> int:
    return max(1, min(len(files), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _waves(base: DataFrame, n: int, tie: list[str], rows: int | None):
    """(footers, row groups of the first wave, best rows of it, row groups of the second wave), None for an empty table."""
    files, stats = _clustered(base, tie, rows)
    if not files:
        return None
    ask = lambda df: df.select("file", "row_group").repartition(_tasks(base.sparkSession, files), "file", "row_group")
    read = lambda df: ask(df).mapInArrow(_reader(base.schema.names), base.schema)
    # those of a group that come before N rows are together, in descending maximum: found within each file, then among files
    ahead = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(F.col("best").desc(), "file", "row_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    alone = stats.filter(F.col("first") == F.col("last"))
    lead = alone.withColumn("_n", ahead("first", "file")).filter(F.col("_n") < n).withColumn("_n", ahead("first")).filter(F.col("_n") < n)
    mixed = stats.filter(F.coalesce(F.col("first") != F.col("last"), F.lit(True)))
    lead = stored(lead.select("file", "row_group").unionByName(mixed.select("file", "row_group")), "lead")
    wave = stored(_best(read(lead), n, tie).select(*base.schema.names), "wave")
    floor = wave.groupBy("_g").agg(F.count("*").alias("_n"), F.min("_s").alias("_m")).filter(F.col("_n") >= n)
    rest = alone.join(lead, ["file", "row_group"], "left_anti").join(floor, F.col("first") == F.col("_g"), "left")
    rest = rest.filter(F.col("_m").isNull() | (F.col("best") >= F.col("_m")))
    return stats, lead, wave, rest, read


def top_n(items: DataFrame, group: str, score: str, n: int, ties: list[Column], keep: list[str], *, rows: int | None = None) -> DataFrame:
    """(group, *keep, rank): the n rows of each group with the highest score, ties by ``ties`` (ascending sort keys).

    Rows with a null group or a score that is null or NaN are left out; infinite scores count. Rows that are equal in the
    score and all ties are as good as each other. n below 1 gives nothing. Extra columns are ignored. ``rows``: rows of a
    row group, by default a part of the table.
    """
    ship(items.sparkSession)
    base, tie = _prepared(items, group, score, ties, keep), [f"_t{i}" for i in range(len(ties))]
    out = [F.col("_g").alias(group), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], F.col("_i").alias("rank")]
    found = _waves(base, n, tie, rows)
    if found is None:
        return _best(items.sparkSession.createDataFrame([], base.schema), n, tie).select(*out)
    _, _, wave, rest, read = found
    return _best(wave.unionByName(read(rest)), n, tie).select(*out)


def reads(items: DataFrame, group: str, score: str, n: int, ties: list[Column], keep: list[str], *, rows: int | None = None) -> DataFrame:
    """(wave, row_groups, n_rows), for the waves first, second and skipped, of ``top_n`` with the same arguments."""
    ship(items.sparkSession)
    found = _waves(_prepared(items, group, score, ties, keep), n, [f"_t{i}" for i in range(len(ties))], rows)
    schema = "wave string, row_groups long, n_rows long"
    if found is None:
        return items.sparkSession.createDataFrame([], schema)
    stats, lead, _, rest, _ = found
    mark = lambda df, k: df.select("file", "row_group", F.lit(k).alias("wave"))
    known = stats.join(mark(lead, "first").unionByName(mark(rest, "second")), ["file", "row_group"], "left")
    return known.groupBy(F.coalesce("wave", F.lit("skipped")).alias("wave")).agg(F.count("*").alias("row_groups"), F.sum("n").alias("n_rows"))
