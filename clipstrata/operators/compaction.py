"""Size-tiered, incremental compaction of tiny files with an idempotent transaction journal.

A listing names the files, the group (clip) each belongs to, its rows and bytes. One call of ``compact`` is one
transaction:

1. *What is new.* Files that a committed transaction has taken in are left out; if nothing is new, nothing is done.
2. *What is ripe.* Outputs smaller than the target lie in tiers of sizes, each ``fan`` times the one before. Only a tier that
   holds ``ripe`` outputs or more is taken in again, so files grow level by level from call to call and a record is written
   about once a level, not once a call. Outputs that hold a record which comes again are taken in as well, so that its
   copies are counted over all calls.
3. *Plan*, on the listing alone. The tiny files of a group form a unit; so do the records that a group has in an output
   taken in again. Units are sorted by the tier of their size, then by name, and cut into outputs of ``target`` bytes by
   their running total, so that units of similar size meet. Which file a record ends up in follows from this plan.
4. *Journal, prepared.* Every output with its inputs, level (tier), rows and bytes. It names no file that won't exist.
5. *Data.* Repeated records become one row with its number of copies, combined before they are moved; one more shuffle
   brings the records of an output to one task, which writes one file. Names depend on the inputs only, so a repeat after a
   crash replaces what was left.
6. *Journal, committed.* Readers see only outputs of committed transactions which no later one took in. ``vacuum`` deletes
   the others.

A group larger than ``BLOCK`` record numbers is cut into units by blocks of them, so that no group is bound to one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.operators.ranges import running
from clipstrata.session import cut

#: Record numbers of a group that stay together.
BLOCK = 1 << 20
#: Bytes that a file counts at least, which bounds the files of an output.
LEAST = 256
#: Groups whose places are broadcast; beyond it they are joined by a shuffle.
PLACES = 200_000

JOURNAL = "txn string, level int, output string, inputs array<string>, n_inputs long, n_rows long, n_bytes long"


@dataclass(frozen=True)
class Tiers:
    """Sizes in bytes of the source files. ``base``: the largest size of tier 0; ``fan``: the factor between tiers;
    ``ripe``: the outputs that make a tier worth merging."""

    base: int = 1 << 10
    fan: int = 16
    target: int = 128 << 20
    ripe: int = 4

    def of(self, size: Column) -> Column:
        """The tier of a size."""
        return F.greatest(F.ceil(F.log(float(self.fan), F.greatest(size, F.lit(1)) / F.lit(self.base))), F.lit(0)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _committed(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed transactions (one for each call of ``compact`` that found something new)."""
    fs, p = _fs(spark, f"{root}/journal/*/committed/_SUCCESS")
    found = fs.globStatus(p)
    return sorted(s.getPath().getParent().getParent().getName() for s in found) if found is not None else []


def _claim(spark: SparkSession, root: str, txn: str) -> None:
    """Takes the number of a transaction for its inputs; a repeat may, another writer with other inputs may not."""
    fs, p = _fs(spark, f"{root}/claims/{txn[:9]}-{txn[10:]}")
    fs.mkdirs(p.getParent())
    fs.createNewFile(p)
    mine = [n for n in _children(spark, f"{root}/claims") if n.startswith(txn[:9])]
    if mine[0] != p.getName():  # of several that write at once the first by name goes on
        fs.delete(p, False)
        raise RuntimeError(f"{txn[:9]} is being written by another call; call again when it is done")


def journal(spark: SparkSession, root: str) -> DataFrame:
    """All merges of the committed transactions. Empty files are taken in by rows without an output."""
    paths = [f"{root}/journal/{t}/{part}" for t in _committed(spark, root) for part in ("merges", "others") if part in _children(spark, f"{root}/journal/{t}")]
    return spark.read.schema(JOURNAL).parquet(*paths) if paths else spark.createDataFrame([], JOURNAL)


def _dead(spark: SparkSession, root: str) -> DataFrame:
    """(out): outputs that a later transaction took in."""
    return journal(spark, root).select(F.explode("inputs").alias("out")).filter(F.col("out").startswith("txn-")).distinct()


def tidy_listing(listing: DataFrame, path: str, group: str, rows: str, size: str) -> DataFrame:
    """One line for each path. Unknown sizes follow from the rows at the mean bytes a row, or are the mean size.

    Repeated lines of a path count once (the larger numbers hold). Lines without a path are left out; a path without a
    group forms its own.
    """
    one = listing.filter(F.col(path).isNotNull()).groupBy(F.col(path).alias("path")).agg(
        F.max(group).alias("seg"), F.max(F.greatest(rows, F.lit(0))).cast("long").alias("n_rows"), F.max(size).cast("long").alias("n_bytes")
    )
    known = F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    mean = one.agg(
        F.try_divide(F.sum(known), F.sum(F.when(known.isNotNull(), F.col("n_rows")))).alias("a_row"), F.avg(known).alias("a_file")
    )
    guess = F.coalesce(F.col("n_rows") * F.col("a_row"), F.col("a_file"), F.lit(1.0))
    return one.crossJoin(F.broadcast(mean)).select(  # the means are one row
        "path", F.coalesce("seg", "path").alias("seg"), "n_rows", F.greatest(F.coalesce(known, F.ceil(guess)).cast("long"), F.lit(0)).alias("n_bytes")
    )


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The records of all live outputs with ``out``, the file they are in; None before the first transaction.

    Where transactions have dead outputs, their names prune the scan (up to 10,000 of them) or are joined away; after
    ``vacuum`` there are none.
    """
    done = _committed(spark, root)
    if not done:
        return None
    data = None
    gone = _dead(spark, root) if len(done) > 1 else None
    names = [r.out for r in gone.limit(10_001).collect()] if gone is not None else []
    for t in done:
        if not any(n.startswith("out=") for n in _children(spark, f"{root}/data/{t}")):
            continue  # all of it was taken in and deleted, or only empty files were
        one = spark.read.parquet(f"{root}/data/{t}")
        dead = [n.split("/")[1] for n in names if n.startswith(t)]
        if dead and len(names) <= 10_000:
            one = one.filter(~F.col("out").isin(dead))
        one = one.withColumn("out", F.concat(F.lit(t + "/"), F.col("out").cast("string")))
        data = one if data is None else data.unionByName(one)
    return data if len(names) <= 10_000 or data is None else data.join(gone, "out", "left_anti")


def vacuum(spark: SparkSession, root: str) -> int:
    """Deletes the outputs that later transactions took in, and what broken runs left; how many folders went. Not to be
    called while a reader still uses an older state."""
    done, n = set(_committed(spark, root)), 0
    dead = {r.out for r in _dead(spark, root).collect()}  # one name for each output ever merged again
    for t in _children(spark, f"{root}/data"):
        for name in _children(spark, f"{root}/data/{t}"):
            if name.startswith("out=") and (t not in done or f"{t}/{name[4:]}" in dead):
                fs, p = _fs(spark, f"{root}/data/{t}/{name}")
                n += bool(fs.delete(p, True))
    return n


def compact(
    records: DataFrame,
    listing: DataFrame,
    root: str,
    *,
    key: tuple[str, ...] = ("scene", "idx"),
    number: str = "k",
    value: str = "ordinal",
    source: str = "src_file",
    group_of: Column | None = None,
    path: str = "path",
    group: str = "seg",
    rows: str = "n_rows",
    size: str = "n_bytes",
    tiers: Tiers | None = None,
) -> str | None:
    """One transaction over the files of ``listing``, whose content is ``records``; its name, None if nothing was new.

    A record is (*key, number) and holds ``value``; ``group_of`` gives, from its columns, the group its file has in the
    listing. Of repeated records the least value is kept (null only if all are) and ``copies`` counts the rows. Nulls in
    ``key``, ``number`` or ``value`` are values like others. Records whose group nobody listed go to outputs of their own
    without inputs. Other columns are ignored, whatever their names. A file of a group that is cut by blocks is an input of
    each output that holds one of them. Records of a listed path must not change afterwards.
    """
    spark, tiers = records.sparkSession, tiers or Tiers()
    names = [f"_k{i}" for i in range(len(key))]
    earlier = _committed(spark, root)
    files = tidy_listing(listing, path, group, rows, size)
    group_of = F.concat_ws("/", *key) if group_of is None else group_of
    back = {c: F.col(n).alias(c) for c, n in zip(key, names)}
    group_again = lambda df: df.select("*", *back.values()).withColumn("_g", group_of).drop(*key)
    recs = records.select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.col(number).alias("_n"), F.col(value).alias("_v"), F.col(source).alias("_f"))
    block = F.coalesce(F.expr(f"_n div {BLOCK}"), F.lit(0)).cast("long")
    recs = recs.withColumn("_c", F.lit(1).cast("long"))
    if earlier:
        log = journal(spark, root)
        taken = log.select(F.explode("inputs").alias("path")).distinct()
        files = files.join(taken, "path", "left_anti")
        recs = recs.join(taken.withColumnRenamed("path", "_f"), "_f", "left_anti")
    files = cut(files)
    weight = F.greatest("n_bytes", F.lit(LEAST))
    mark = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "n_bytes").cast("decimal(38,0)")).alias("h"), F.count_if((F.col("n_rows") == 0) & (F.col("n_bytes") <= 0)).alias("e")).first()
    if not mark["n"]:
        return None
    digest = hashlib.sha256(repr((mark["n"], str(mark["h"]), tiers)).encode()).hexdigest()[:16]
    txn = f"txn-{len(earlier):05d}-{digest}"
    _claim(spark, root, txn)
    # units: the new files of a group, or of one of its blocks
    full = files.filter("n_rows > 0 OR n_bytes > 0")
    new = full.groupBy(F.col("seg").alias("_g")).agg(F.sum("n_rows").alias("n_rows"), F.sum(weight).alias("n_bytes"))
    parts = F.greatest(F.ceil(F.col("n_rows") / F.lit(BLOCK)), F.lit(1)).cast("long")
    new = new.withColumn("_m", parts).select("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)).alias("_b"), "_m", "n_rows", "n_bytes")
    units = new.select("_g", "_b", F.expr("n_rows div _m").alias("n_rows"), F.expr("n_bytes div _m").alias("n_bytes"))
    inputs = full.select(F.col("seg").alias("_g"), "path")
    live = read(spark, root) if earlier else None
    if live is not None:
        made = log.filter("output IS NOT NULL").select(F.concat("txn", F.lit("/"), "output").alias("out"), F.col("n_bytes").alias("_size"))
        small = made.join(taken.withColumnRenamed("path", "out"), "out", "left_anti").withColumn("_tier", tiers.of(F.col("_size")))
        ripe = small.filter(F.col("_size") < tiers.target // 2).groupBy("_tier").agg(F.count("*").alias("_many")).filter(F.col("_many") >= tiers.ripe - 1)
        flat = live.select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.col(number).alias("_n"), F.col(value).alias("_v"), F.col("out").alias("_f"), F.col("copies").alias("_c"))
        same = F.expr(" AND ".join(f"l.{n} <=> r.{n}" for n in [*names, "_n"]))
        again = flat.alias("l").join(recs.alias("r"), same, "left_semi").select(F.col("_f").alias("out")).distinct()
        grown = small.filter(F.col("_size") < tiers.target // 2).join(ripe, "_tier", "left_semi").select("out")
        old = cut(small.join(grown.unionByName(again).distinct(), "out", "left_semi"))
        flat = flat.join(old.select(F.col("out").alias("_f")), "_f", "left_semi")
        held = group_again(flat).groupBy("_f", "_g", block.alias("_b")).agg(F.count("*").alias("n_rows"))
        whole = held.groupBy("_f").agg(F.sum("n_rows").alias("_all"))
        held = cut(held.join(whole, "_f").join(old.select(F.col("out").alias("_f"), "_size"), "_f"))
        # a group's records of all kinds go to one place
        units = units.unionByName(held.select("_g", "_b", "n_rows", F.ceil(F.col("_size") * F.col("n_rows") / F.col("_all")).cast("long").alias("n_bytes")))
        units = units.groupBy("_g", "_b").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        recs = recs.unionByName(flat)
    # similar sizes meet: sorted by tier, cut where the running total passes the target
    units = units.withColumn("_tier", tiers.of(F.col("n_bytes")))
    total = running(units, ["_tier", "_g", "_b"], {"_upto": F.col("n_bytes")})
    nth = F.expr(f"(_upto - greatest(n_bytes, 1)) div {tiers.target}")
    plan = cut(total.select("_g", "_b", "n_rows", "n_bytes", nth.cast("int").alias("_o")))
    shape = plan.agg(F.count("*").alias("n"), F.max("_o").alias("o")).first()
    outputs = (shape["o"] if shape["o"] is not None else -1) + 1
    named = F.format_string("f%05d", F.col("_o"))
    sizes = plan.groupBy("_o").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
    into = inputs.join(plan.select("_g", "_o").distinct(), "_g").select("_o", "path")
    if live is not None:
        into = into.unionByName(held.join(plan, ["_g", "_b"]).select("_o", F.col("_f").alias("path")).distinct())
    lists = into.groupBy("_o").agg(F.array_sort(F.collect_list("path")).alias("inputs"), F.count("*").alias("n_inputs"))
    merges = sizes.join(lists, "_o").select(F.lit(txn).alias("txn"), tiers.of(F.col("n_bytes")).alias("level"), named.alias("output"), "inputs", "n_inputs", "n_rows", "n_bytes")
    if mark["e"]:  # empty files hold nothing to write and are only taken in
        heaps = -(-mark["e"] // 10_000)
        empty = files.filter("n_rows = 0 AND n_bytes <= 0").groupBy(F.pmod(F.xxhash64("path"), F.lit(heaps)).alias("_h")).agg(F.collect_list("path").alias("inputs"), F.count("*").alias("n_inputs"))
        none = F.lit(0).cast("long")
        empty = empty.select(F.lit(txn).alias("txn"), F.lit(-1).alias("level"), F.lit(None).cast("string").alias("output"), "inputs", "n_inputs", none.alias("n_rows"), none.alias("n_bytes"))
        merges = merges.unionByName(empty)
    merges.write.mode("overwrite").parquet(f"{root}/journal/{txn}/merges")
    # copies are combined before they move: a record that a third of all rows repeat is one row a task by then
    recs = group_again(recs.groupBy(*names, "_n").agg(F.min("_v").alias("_v"), F.sum("_c").alias("_c"))).withColumn("_b", block)
    places = plan.select("_g", "_b", "_o")
    recs = recs.join(F.broadcast(places) if shape["n"] <= PLACES else places, ["_g", "_b"], "left")
    strays = max(1, outputs)
    recs = recs.withColumn("_o", F.coalesce("_o", outputs + F.pmod(F.hash("_g", "_b"), F.lit(strays))))
    data = recs.select(*back.values(), F.col("_n").alias(number), F.col("_v").alias(value), F.col("_c").alias("copies"), F.col("_o"))
    data = data.repartitionById(outputs + strays, "_o").withColumn("out", named).drop("_o")
    data.sortWithinPartitions("out", *key, number).write.mode("overwrite").partitionBy("out").parquet(f"{root}/data/{txn}")
    strange = [n[4:] for n in _children(spark, f"{root}/data/{txn}") if n.startswith("out=f") and int(n[5:]) >= outputs]
    if strange:  # records of groups that nobody listed
        held_there = spark.read.parquet(f"{root}/data/{txn}").filter(F.col("out").isin(strange)).groupBy("out").agg(F.count("*").alias("n_rows"))
        none = F.array().cast("array<string>")
        others = held_there.select(F.lit(txn).alias("txn"), F.lit(0).alias("level"), F.col("out").alias("output"), none.alias("inputs"), F.lit(0).cast("long").alias("n_inputs"), "n_rows", (F.col("n_rows") * LEAST).alias("n_bytes"))
        others.write.mode("overwrite").parquet(f"{root}/journal/{txn}/others")
    spark.createDataFrame([(txn,)], "txn string").coalesce(1).write.mode("overwrite").json(f"{root}/journal/{txn}/committed")
    return txn


def missing_numbers(held: DataFrame, promised: DataFrame, key: list[str], number: str, count: str, *, block: int = 4096) -> DataFrame:
    """(*key, number): the numbers from 0 to ``count`` - 1 that ``promised`` states and ``held`` lacks.

    Numbers are compared as sets of one block of them, so neither a long key nor a high count makes a large row. A null
    count promises nothing; of several counts of a key the greatest holds.
    """
    names = [f"_k{i}" for i in range(len(key))]
    ours = held.select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.expr(f"{number} div {block}").cast("long").alias("_b"), F.col(number).cast("int").alias("_n"))
    sets = ours.filter(F.col("_n") >= 0).groupBy(*names, "_b").agg(F.collect_set("_n").alias("_s"))
    most = promised.filter(F.col(count) > 0).select(*[F.col(c).alias(n) for c, n in zip(key, names)], F.col(count).alias("_t")).dropna(subset=names)
    most = most.groupBy(*names).agg(F.max("_t").cast("long").alias("_t"))
    want = most.withColumn("_b", F.explode(F.expr(f"sequence(0L, (_t - 1) div {block})")))
    lo = F.col("_b") * block
    full = F.sequence(lo.cast("int"), (F.least(lo + block, F.col("_t")) - 1).cast("int"))
    lacking = F.array_except(full, F.coalesce("_s", F.array().cast("array<int>")))
    return want.join(sets, [*names, "_b"], "left").select(*[F.col(n).alias(c) for n, c in zip(names, key)], F.explode(lacking).alias(number))
