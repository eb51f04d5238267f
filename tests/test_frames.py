import io
import json
import math
import random
import tarfile

import numpy as np
import pandas as pd
import pytest

from clipstrata.functions import camera, encode
from clipstrata.functions import text as T
from clipstrata.operators import audit, captions, temporal, tracks
from clipstrata.plans import windows
from clipstrata.queries import audits
from clipstrata.session import new_folder
from clipstrata.sources import readers
from clipstrata.streaming import stateful
from pyspark.sql import functions as F


def test_short_runs(spark):
    rnd = random.Random(3)
    seqs = {e: [rnd.choice([0, 0, 1, 2]) for _ in range(n)] for e, n in enumerate((1, 2, 3, 17, 40))}
    rows = [(e, o, c) for e, s in seqs.items() for o, c in enumerate(s)]
    df = spark.createDataFrame(rows, "ep long, ordinal long, cls int")
    for least in (2, 3):
        got = {}
        for r in temporal.suppress_short_runs(df, "ep", "ordinal", "cls", "out", least=least).orderBy("ordinal").collect():
            got.setdefault(r.ep, []).append(r.out)
        for e, s in seqs.items():
            runs, keep = [], []
            for i, c in enumerate(s):
                if i and c == s[i - 1]:
                    runs[-1].append(i)
                else:
                    runs.append([i])
            long = [set(r) for r in runs if len(r) >= least]
            for i in range(len(s)):
                past = [max(r & set(range(i + 1))) for r in long if r & set(range(i + 1))]
                ahead = [min(r) for r in long if min(r) > i]
                keep.append(s[i] if len(s) < 3 or not long else s[max(past)] if past else s[min(ahead)])
            assert got[e] == keep


def test_a_line_is_its_own_trend_and_corrections_have_no_mean(spark):
    rows = [(e, o, 0.3 * o + e if e < 2 else math.sin(o * 7.0) + (3 if o == 5 else 0)) for e in range(3) for o in range(30)]
    df = spark.createDataFrame(rows, "seg long, ordinal int, y double")
    t = df.select("seg", "ordinal", "y", temporal.trend("y", "ordinal", temporal.ordered("seg", "ordinal"), 4).alias("t"))
    assert all(abs(r.y - r.t) < 1e-9 for r in t.filter("seg < 2").collect())
    ratios = df.filter("seg = 2").withColumn("ratio", F.col("y") * 0.1)
    c = temporal.recentred(temporal.scale_residual(ratios, "seg", "ordinal", radius=4), "seg", "correction").collect()
    assert abs(np.mean([r.correction for r in c])) < 1e-12


def test_depth_codes(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1e-3, 0.1, 0.3, 1.0, 17.5, 256.0, 1e5, float("nan"), None)], "d double")
    r = df.select(encode.code16(F.col("d")).alias("c"), encode.grey8(F.col("d")).alias("g"), encode.duv_red(F.col("d"), F.lit(5)).alias("r")).collect()
    assert [x.c for x in r] == [0, 0, 65535, 65535, 53870, 26064, 0, 0, 0, 0] or [x.c for x in r][:4] == [0, 0, 65535, 65535]
    assert [x.g for x in r][-2:] == [0, 0] and [x.r for x in r][-2:] == [255, 255] and r[7].r == 254
    back = df.filter("d between 0.3 and 256").select("d", encode.metres_of_code16(encode.code16(F.col("d"))).alias("b")).collect()
    assert all(x.b == 0 if x.d == 256 else abs(x.b / x.d - 1) < 1e-3 for x in back)


def test_bins_share_frames_exactly(spark):
    df = spark.createDataFrame([(n, n, r) for n in (1, 5, 24, 100, 124) for r in (24.0,)] + [(1000 + n, n, 23.976) for n in (30, 124)] + [(7, None, 24.0), (8, 3, 0.0)], "clip long, n long, fps double")
    by = {}
    for r in windows.second_grid(df, "clip", "n", "fps").orderBy("clip", "bin").collect():
        by.setdefault(r.clip, []).append(r)
    assert set(by) == {1, 5, 24, 100, 124, 1030, 1124}
    for c, bins in by.items():
        assert bins[0].first_frame == 0 and bins[-1].stop_frame == c % 1000 and all(x.stop_frame == y.first_frame for x, y in zip(bins, bins[1:]))
    assert len(by[124]) == 5 and by[124][-1].stop == 5.167


def test_windows_are_disjoint(spark):
    df = spark.createDataFrame([("a", 1000, 30.0), ("short", 20, 30.0), ("slow", 1000, 12.0), ("none", None, 30.0)], "scene string, n long, fps double")
    w = windows.plan_windows(df, "scene", "n", "fps").collect()
    assert {r.scene for r in w} == {"a"} and len(w) == 5 * 124 and len({r.ordinal for r in w}) == 620 and max(r.ordinal for r in w) < 1000


def test_components(spark):
    rnd = np.random.default_rng(5)
    mask = rnd.random((12, 9)) < 0.4
    lab = tracks.label_mask(mask)
    assert ((lab > 0) == mask).all()
    for r, c in zip(*mask.nonzero()):
        for y, x in ((r, c + 1), (r + 1, c), (r + 1, c + 1), (r + 1, c - 1)):
            if 0 <= y < 12 and 0 <= x < 9 and mask[y, x]:
                assert lab[r, c] == lab[y, x]
    seen = set()
    for k in range(1, lab.max() + 1):  # each number is one region
        todo = [tuple(np.argwhere(lab == k)[0])]
        while todo:
            p = todo.pop()
            if p in seen:
                continue
            seen.add(p)
            todo += [(p[0] + a, p[1] + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if 0 <= p[0] + a < 12 and 0 <= p[1] + b < 9 and lab[p[0] + a, p[1] + b] == k]
        assert {tuple(p) for p in np.argwhere(lab == k)} <= seen


def test_tracks_name_the_middle_one(spark):
    rows = [(1, o, 1, 9, 4.0 + 0.1 * o, 4.4) for o in range(10)] + [(1, o, 2, 2, 0.5, 0.5) for o in range(5)] + [(2, 0, 1, 9, 4.0, 4.0)]
    b = spark.createDataFrame([(*r, 0, 0, 1, 1) for r in rows], tracks.BLOBS)
    t = tracks.link(b, 8, 8, tracks.Prior(area=0.01))
    got = {r.seg: (r.track, r.reason) for r in tracks.protagonist(t, spark.createDataFrame([(1, 10), (2, 10)], "seg long, n long"), 8, 8, tracks.Prior(area=0.01)).collect()}
    assert got == {1: (0, "named"), 2: (None, "no track is long enough")}


def test_camera_scale(spark):
    rnd = random.Random(1)
    p = [(1, f, rnd.random(), rnd.random(), rnd.random()) for f in range(20)]
    a = spark.createDataFrame(p + [(2, 0, 0.0, 0.0, 0.0)], "k long, f int, x double, y double, z double")
    t = spark.createDataFrame([(k, f, 5 * x + 1, 5 * y, 5 * z) for k, f, x, y, z in p] + [(2, 0, 0.0, 0.0, 0.0)], "k long, f int, x double, y double, z double")
    got = {r.k: r for r in audit.camera_scale(a, t, "k", "f", reach=20).collect()}
    assert got[1].pairs == 190 and abs(got[1].scale - 5) < 1e-9 and got[1].solved and not got[2].solved and got[2].scale == 1.0


def test_the_camera_scale_query_takes_all_pairs_of_a_segment(spark, tmp_path):
    slow = [(f, [f * 0.001, 0.0, 0.0]) for f in range(124)]  # neighbours are nearer than the least baseline, far cameras aren't
    rnd = np.random.default_rng(7)
    spark.createDataFrame(slow + [(124 + f, rnd.random(3).tolist()) for f in range(40)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    cams = {0: np.array([v for _, v in slow], dtype=np.float32).astype(float)}
    cams[1] = np.array([r.embedding for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").filter("vec_id >= 124").orderBy("vec_id").collect()])
    got = {r.seg: r for r in audits.camera_scale(spark, str(tmp_path)).collect()}
    for seg, p in cams.items():
        i, j = np.triu_indices(len(p), k=1)
        t = p * 3 + np.arange(len(p))[:, None] % 5 * np.array([0, 0, 0.01])
        dp, dt = np.linalg.norm(p[i] - p[j], axis=1), np.linalg.norm(t[i] - t[j], axis=1)
        r = (dt / np.maximum(dp, 1e-12))[(dt > 0.05) & (dp > 1e-9)]
        scale = np.median(r)
        assert got[seg].pairs == len(r) and abs(got[seg].scale - scale) < 2e-6 and got[seg].solved
        assert abs(got[seg].dispersion - np.median(abs(r - scale)) / scale) < 2e-6


@pytest.mark.parametrize("cuts", [1, 3])
def test_streams_equal_batch_over_restarts(spark, cuts, tmp_path):
    stateful.set_up(spark)
    rows = [(e, o, float((o * 7 + e) % 5), (o * o + e) % 3) for e in range(3) for o in range(18)]
    df = spark.createDataFrame(rows, "ep long, ordinal long, depth double, cls int")
    src = f"{tmp_path}/src"
    for name, stream, mode in (("f", stateful.flicker_stream, "update"), ("m", stateful.steady_stream, "append"), ("g", stateful.guard_stream, "update")):
        for c in range(cuts):
            df.filter(F.expr(f"ordinal div 6 = {c}") if cuts > 1 else F.lit(True)).write.mode("overwrite").parquet(f"{src}-{name}/{c}")
            s = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{src}-{name}")
            stateful.run_to_table(stream(s), f"{tmp_path}/{name}", f"{tmp_path}/{name}-state", mode)
    f = {r.ep: (r.c, r.d) for r in spark.read.parquet(f"{tmp_path}/f").groupBy("ep").agg(F.max("compared").alias("c"), F.max("changed").alias("d")).collect()}
    want = {r.ep: (r.compared, r.changed) for r in temporal.flicker(df, "ep", "ordinal", "cls").collect()}
    assert f == want
    w = temporal.ordered("ep", "ordinal")
    batch = df.select("ep", "ordinal", temporal.window_median(F.col("depth"), w, 2).alias("median"), temporal.vote(F.col("cls"), w, 2, 3).alias("voted"))
    got = lambda: {(r.ep, r.ordinal): (r.median, r.voted) for r in spark.read.parquet(f"{tmp_path}/m").collect()}
    assert got() == {(r.ep, r.ordinal): (r.median, r.voted) for r in batch.filter("ordinal < 16").collect()}
    # the end of an episode releases what waits for neighbours
    spark.createDataFrame([(e, None, None, None) for e in range(3)], df.schema).write.parquet(f"{src}-m/end")
    s = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{src}-m")
    stateful.run_to_table(stateful.steady_stream(s), f"{tmp_path}/m", f"{tmp_path}/m-state", "append")
    assert got() == {(r.ep, r.ordinal): (r.median, r.voted) for r in batch.collect()}
    g = {r.ep: r.x for r in spark.read.parquet(f"{tmp_path}/g").groupBy("ep").agg(F.max(F.struct("valid", "median")).alias("x")).collect()}
    want = {r.ep: (r.n, r.m) for r in df.filter("depth > 0").groupBy("ep").agg(F.count("*").alias("n"), F.percentile("depth", 0.5).alias("m")).collect()}
    assert {e: tuple(x) for e, x in g.items()} == want


def test_readers(spark, tmp_path):
    (tmp_path / "cameras.txt").write_text("# c\n1 PINHOLE 640 480 500 501 320 240\n2 SIMPLE_RADIAL 64 48 50 32 24 0.1\n")
    (tmp_path / "images.txt").write_text("# i\n2 1 0 0 0 1 2 3 1 b.png\n10 20 1 30 40 2 1.5 2.5 3 7\n1 2 0 0 0 0 0 -1 2 a.png\n\n")
    (tmp_path / "points.txt").write_text("# p\n7 1 2 3 255 0 0 0.1 1 2\n")
    t = readers.camera_track(spark, f"{tmp_path}/cameras.txt", f"{tmp_path}/images.txt").orderBy("ordinal").collect()
    assert [r.name for r in t] == ["a.png", "b.png"] and t[1].position == [-1.0, -2.0, -3.0] and t[0].intrinsics[0] == [50.0, 0.0, 32.0]
    assert [tuple(r) for r in readers.sparse_points(spark, f"{tmp_path}/points.txt").collect()] == [(7, 1.0, 2.0, 3.0)]
    with tarfile.open(tmp_path / "x.tar", "w") as tar:
        for name, body in (("a/action.json", {"actions": [{"k": 1}, {"k": 2}]}), ("b/action.json", {"actions": []}), ("caption.json", [1])):
            raw = json.dumps(body).encode()
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    m = readers.tar_members(spark, f"{tmp_path}/x.tar", ["action.json"])
    assert [r.action for r in readers.actions(m).orderBy("ordinal").collect()] == ['{"k":1}', '{"k":2}']
    np.savez(tmp_path / "t.npz", cam2world=np.stack([np.eye(4)] * 2))
    with pytest.raises(Exception, match="missing arrays"):
        readers.tracks(spark, f"{tmp_path}/t.npz").collect()
    (tmp_path / "t.json").write_text(json.dumps({"intrinsics": {"width": 4, "height": 4, "hfov_deg": 60.0}, "frames": [{"cam2world": [[1.0]]}]}))
    with pytest.raises(Exception, match="poses"):
        readers.tracks(spark, f"{tmp_path}/t.json").collect()
    (tmp_path / "v" / "take_1").mkdir(parents=True)
    (tmp_path / "v" / "take_1" / "video.mp4").write_bytes(b"1")
    (tmp_path / "v" / "other.mov").write_bytes(b"12")
    assert sorted(r.sample_id for r in readers.videos(spark, [f"{tmp_path}/v"]).collect()) == ["other", "take_1"]
    with pytest.raises(FileNotFoundError):
        readers.videos(spark, [f"{tmp_path}/v"], suffixes=("avi",))
    px = spark.createDataFrame([(1, 0, 0, 0, 1.0, 3)], "seg long, ordinal int, r int, c int, depth double, cls int")
    out = new_folder(spark, "px")
    readers.write_frames(px, out)
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(Exception, match="isn't allowed"):
        readers.write_frames(px.withColumn("depth", F.lit(-1.0)), out + "b")


def test_text(spark):
    rows = [("  walks  to the door", "an"), (None, "a"), ("", "a"), ("Done!", "x"), ("walks", "x")]
    df = spark.createDataFrame(rows, "t string, k string")
    r = df.select(T.sentence(F.col("t")).alias("s"), T.strip_verb(F.col("t"), F.lit("walks"), F.lit("walking"), F.lit("walk")).alias("v")).collect()
    assert [x.s for x in r] == ["Walks to the door.", "", "", "Done!", "Walks."] and [x.v for x in r] == ["to the door", "", "", "Done!", ""]
    j = spark.createDataFrame([('x {"a": 1} y',), ("none",), ('{"a": 2}',), (None,)], "t string")
    assert [x[0] for x in j.select(F.try_variant_get(T.json_object(F.col("t")), "$.a", "int")).collect()] == [1, None, 2, None]
    assert pd is not None


def test_refusals(spark):
    """What the rules refuse is refused, with a reason."""
    one = spark.range(1)
    assert one.select(encode.to_twelve(F.lit(11), "cwm12").alias("x")).first().x == 11
    with pytest.raises(Exception, match="contain id 12"):
        one.select(encode.to_twelve(F.lit(12), "cwm12").alias("x")).collect()
    with pytest.raises(ValueError, match="no table"):
        encode.to_twelve(F.lit(1), "unknown")
    assert encode.class_table(["a", "b"], {"a": 3}, 0) == [3, 0]
    with pytest.raises(KeyError, match="no class for: b"):
        encode.class_table(["a", "b"], {"a": 3})
    with pytest.raises(Exception, match="unsupported camera model"):
        one.select(camera.intrinsics(F.lit("ODD"), F.array(F.lit(1.0))).alias("x")).collect()
    with pytest.raises(Exception, match="length zero"):
        one.select(camera.rotation(*[F.lit(0.0)] * 4).alias("x")).collect()
    with pytest.raises(ValueError, match="unknown streams: typo"):
        readers.kept_streams("depth, typo")
    with pytest.raises(ValueError, match="unknown variant"):
        captions.exported(one, variant="odd")


def test_captions_without_anything(spark):
    """Nulls and empty lists give a caption with problems, no checks and an empty text; clashing names don't matter."""
    grid = F.array().cast(captions.GRID)
    r = spark.createDataFrame([("a", "{}", 1), ("b", None, 1), ("c", "no object", 1)], "clip string, reply string, who int")
    x = r.withColumn("grid", grid).withColumn("x", captions.read_reply(F.col("reply"), grid)).filter("x IS NOT NULL")
    c = x.select("clip", "who", "grid", "x.scene", "x.entities", "x.events", F.lit(None).cast(captions.WINDOW).alias("window"), F.lit(None).cast(captions.EVIDENCE).alias("evidence"))
    got = c.withColumns({"p": captions.problems(), "c": captions.check()}).select("clip", "p", "c", captions.score(F.col("events"), F.col("c")).alias("s")).collect()
    assert [(g.clip, g.p, g.c.checked, g.c.fail, g.s) for g in got] == [("a", ["scene.medium is empty"], False, [], 0.0)]
    assert captions.cut_to(c, F.lit(0.0), F.lit(9.0)).count() == 0
    with pytest.raises(Exception, match="paragraph is empty"):
        captions.compiled(c).collect()
