import pytest

from clipstrata.operators import compaction
from clipstrata.operators.compaction import Tiers
from clipstrata.session import new_folder
from pyspark.sql import functions as F

RECORDS = "scene string, idx int, k int, ordinal long, src_file string, path string, out string"
LISTING = "path string, seg string, n_rows int, n_bytes long, modified_at timestamp"


def make(spark, clips, start=0):
    recs, files = [], []
    for c in range(start, start + clips):
        for f in range(3):
            name = f"plan/{c}/{f}.json"
            for k in range(f * 4, f * 4 + 4):
                recs.append((f"s{c // 3}", c % 3, k, 100 + k, name, "x", "y"))
            files.append((name, f"s{c // 3}/{c % 3}", 4, None if f == 1 else 260 + 900 * (c % 5), None))
    return recs, files


def frames(spark, recs, files):
    return spark.createDataFrame(recs, RECORDS), spark.createDataFrame(files, LISTING)


def test_each_record_once_and_all_inputs_in_the_journal(spark):
    recs, files = make(spark, 30)
    recs += [recs[5], recs[5], ("s0", None, 3, None, "plan/0/0.json", "x", "y"), ("s0", 0, None, 1, "plan/0/0.json", "x", "y")]
    files += [files[0], ("empty.json", "s0/0", 0, 0, None), (None, "s0/0", 1, 1, None), ("unknown.json", "s9/9", 2, None, None)]
    root = new_folder(spark, "c")
    tiers = Tiers(base=1024, fan=4, target=16 << 10)
    assert compaction.compact(*frames(spark, recs, files), root, tiers=tiers)
    held = compaction.read(spark, root)
    want = {}
    for s, i, k, o, *_ in recs:
        want.setdefault((s, i, k), []).append(o)
    got = {(r.scene, r.idx, r.k): (r.ordinal, r.copies) for r in held.collect()}
    assert got == {x: (min((o for o in v if o is not None), default=None), len(v)) for x, v in want.items()} and held.count() == len(want)
    log = compaction.journal(spark, root).collect()
    taken = [p for r in log for p in r.inputs]
    assert set(taken) == {f[0] for f in files if f[0]} and len(taken) == len(set(taken))
    # the journal names what exists, and the plan decides where a record is
    outs = {r.out.split("/")[1] for r in held.select("out").distinct().collect()}
    empty = {r.output for r in log if r.inputs == ["unknown.json"]}  # listed with rows that nobody has
    assert outs == {r.output for r in log if r.output} - empty and 1 < len(outs) <= 13  # as many as the bytes fill
    home = {p: r.output for r in log for p in r.inputs}
    by_key = {(r.scene, r.idx, r.k): r.out.split("/")[1] for r in held.collect()}
    assert all(by_key[s, i, k] == home[f] for s, i, k, _, f, *_ in recs if i is not None and k is not None)


def test_outputs_hold_units_of_similar_size(spark):
    recs, files = [], []
    for c in range(40):
        for f in range(2):
            recs += [(f"s{c}", 0, k + 2 * f, k, f"{c}/{f}.json", "x", "y") for k in range(2)]
            files.append((f"{c}/{f}.json", f"s{c}/0", 2, 300 if c % 2 else 5000, None))
    root, tiers = new_folder(spark, "c"), Tiers(base=1024, fan=4, target=12_000)
    compaction.compact(*frames(spark, recs, files), root, tiers=tiers)
    kinds = [{int(p.split("/")[0]) % 2 for p in r.inputs} for r in compaction.journal(spark, root).collect()]
    assert len(kinds) >= 17 and sum(len(k) > 1 for k in kinds) <= 1  # only where one tier ends


def test_a_repeat_does_nothing_and_a_broken_run_is_done_again(spark):
    recs, files = make(spark, 9)
    root = new_folder(spark, "c")
    first = compaction.compact(*frames(spark, recs, files), root)
    before = sorted(map(tuple, compaction.read(spark, root).drop("out").collect()))
    assert compaction.compact(*frames(spark, recs, files), root) is None
    fs, p = compaction._fs(spark, f"{root}/journal/{first}/committed")
    fs.delete(p, True)  # as if the run had died before its commit
    assert compaction.read(spark, root) is None
    assert compaction.compact(*frames(spark, recs, files), root) == first
    assert sorted(map(tuple, compaction.read(spark, root).drop("out").collect())) == before


@pytest.mark.parametrize("target", [4 << 10, 128 << 20])
def test_new_files_join_small_outputs(spark, target):
    recs, files = make(spark, 12)
    more, later = make(spark, 6, 9)  # three clips come again, three are new
    later = [(f"late/{p}", *x) for p, *x in later]
    more = [(s, i, k, o, f"late/{f}", x, y) for s, i, k, o, f, x, y in more]
    root, tiers = new_folder(spark, "c"), Tiers(base=512, fan=4, target=target)
    a = compaction.compact(*frames(spark, recs, files), root, tiers=tiers)
    b = compaction.compact(*frames(spark, recs + more, files + later), root, tiers=tiers)
    assert a and b and a != b
    held = [(r.scene, r.idx, r.k) for r in compaction.read(spark, root).collect()]
    assert sorted(held) == sorted({x[:3] for x in recs + more})
    assert compaction.vacuum(spark, root) > 0 and compaction.vacuum(spark, root) == 0
    assert sorted((r.scene, r.idx, r.k) for r in compaction.read(spark, root).collect()) == sorted(held)


def test_a_ripe_tier_is_merged_and_others_are_left(spark):
    root, tiers = new_folder(spark, "c"), Tiers(base=1 << 14, fan=4, target=1 << 20, ripe=3)
    many, files, live = [], [], []
    for call in range(5):
        recs, more = make(spark, 2, 10 * call)
        many, files = many + recs, files + more
        compaction.compact(*frames(spark, many, files), root, tiers=tiers)
        live.append(compaction.read(spark, root).select("out").distinct().count())
    assert live == [1, 2, 1, 2, 1] or live == [1, 2, 1, 2, 3], live
    held = compaction.read(spark, root).collect()
    assert sorted((r.scene, r.idx, r.k, r.copies) for r in held) == sorted({(*x[:3], 1) for x in many})


def test_two_writers_of_one_number(spark):
    root = new_folder(spark, "c")
    compaction._claim(spark, root, "txn-00000-aaaa")
    compaction._claim(spark, root, "txn-00000-aaaa")
    with pytest.raises(RuntimeError):
        compaction._claim(spark, root, "txn-00000-bbbb")


@pytest.mark.parametrize("target", [4 << 10, 128 << 20])
def test_copies_count_over_transactions_whatever_the_outputs_size(spark, target):
    recs, files = make(spark, 12)
    recs += [("s0", None, 3, 103, "plan/0/0.json", "x", "y")]
    more, later = make(spark, 6, 9)
    more = [(s, i, k, o - 50, f"late/{f}", x, y) for s, i, k, o, f, x, y in more] + [("s0", None, 3, 7, "late/plan/9/0.json", "x", "y")]
    root, tiers = new_folder(spark, "c"), Tiers(base=512, fan=4, target=target)
    compaction.compact(*frames(spark, recs, files), root, tiers=tiers)
    compaction.compact(*frames(spark, recs + more, files + [(f"late/{p}", *x) for p, *x in later]), root, tiers=tiers)
    want = {}
    for s, i, k, o, *_ in recs + more:
        want.setdefault((s, i, k), []).append(o)
    held = compaction.read(spark, root).collect()
    assert {(r.scene, r.idx, r.k): (r.ordinal, r.copies) for r in held} == {x: (min(v), len(v)) for x, v in want.items()} and len(held) == len(want)


def test_missing_numbers(spark):
    held = spark.createDataFrame([("a", 0, 0), ("a", 0, 2), ("a", 0, -1), ("a", 0, 99), ("a", 0, None), ("b", 0, 0)], "scene string, idx int, k int")
    due = spark.createDataFrame([("a", 0, 4), ("a", 0, 5), ("b", 0, 1), ("c", 1, 2), ("d", 0, None), (None, 0, 3), ("e", 0, 0)], "scene string, idx int, frames int")
    for block in (2, 4096):
        got = sorted(map(tuple, compaction.missing_numbers(held, due, ["scene", "idx"], "k", "frames", block=block).collect()))
        assert got == [("a", 0, 1), ("a", 0, 3), ("a", 0, 4), ("c", 1, 0), ("c", 1, 1)]
    assert compaction.missing_numbers(held, due.limit(0), ["scene", "idx"], "k", "frames").count() == 0


def test_empty(spark):
    root = new_folder(spark, "c")
    assert compaction.compact(spark.createDataFrame([], RECORDS), spark.createDataFrame([], LISTING), root) is None
    assert compaction.read(spark, root) is None and compaction.journal(spark, root).count() == 0
