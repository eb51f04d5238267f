"""Queries that write small files of every known layout, read them back, and give what was read."""

from __future__ import annotations

import io
import json
import tarfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.functions import camera, encode
from clipstrata.operators import audit
from clipstrata.queries import Registry
from clipstrata.queries.prompts import _values
from clipstrata.session import new_folder
from clipstrata.sources import readers
from clipstrata.sources.tables import PIXELS_SQL, pixels, table

REG = Registry()

MODELS = [
    (1, "SIMPLE_PINHOLE", "500 320 240"), (2, "PINHOLE", "500 501 320 240"), (3, "SIMPLE_RADIAL", "500 320 240 0.1"), (4, "RADIAL", "500 320 240 0.1 0.01"), (5, "OPENCV", "500 501 320 240 0.1 0.1 0 0"),
    (6, "OPENCV_FISHEYE", "500 501 320 240 0 0 0 0"), (7, "FULL_OPENCV", "500 501 320 240 0 0 0 0 0 0 0 0"), (8, "FOV", "500 501 320 240 0.9"), (9, "SIMPLE_RADIAL_FISHEYE", "500 320 240 0.1"),
    (10, "RADIAL_FISHEYE", "500 320 240 0.1 0.2"), (11, "THIN_PRISM_FISHEYE", "500 501 320 240 0 0 0 0 0 0 0 0"),
]
SPARSE = {
    "cameras.txt": "# Camera list\n\n" + "".join(f"{i} {m} 640 480 {p}\n" for i, m, p in MODELS),
    # a pose line, then a line of points; names may be bare numbers
    "images.txt": "# Image list\n3 1 0 0 0 1 2 3 1 frame_000012.png\n10.5 20.5 7 30 40 -1 1 2 3 4 5 6\n1 0 0 0 2 4 5 6 10 000004\n\n2 0.7071067811865476 0 0.7071067811865476 0 0 0 2 2 no digits.png\n",
    "points3D.txt": "# Points\n7 1.5 2 -3 255 0 0 0.1 1 2\n8 0 0 1 0 0 0 0.2\n\n",
}


def _written(spark: SparkSession, files: dict[str, bytes | str]) -> str:
    root = new_folder(spark, "files")
    for name, content in files.items():
        readers.put(spark, f"{root}/{name}", content.encode() if isinstance(content, str) else content)
    return root


@REG.add("camera_models", _values([(i, m, 500.0, 501.0 if len(p.split()) > 3 and p.split()[1] == "501" else 500.0, 320.0, 240.0) for i, m, p in MODELS], "camera_id, model, fx, fy, cx, cy"))
def camera_models(spark: SparkSession, where: str) -> DataFrame:
    """The intrinsics of every camera model a sparse model may name."""
    c = readers.sparse_cameras(spark, _written(spark, SPARSE) + "/cameras.txt").withColumn("k", camera.intrinsics(F.col("model"), F.col("params")))
    at = lambda i, j, n: F.col("k")[i][j].alias(n)
    return c.select("camera_id", "model", at(0, 0, "fx"), at(1, 1, "fy"), at(0, 2, "cx"), at(1, 2, "cy"))


# by hand: -(R transposed) t; the first is turned half about z, the last a quarter about y
TRACK = [(0, "000004", 4, 500.0, 4.0, 5.0, -6.0), (1, "frame_000012.png", 12, 500.0, -1.0, -2.0, -3.0), (2, "no", -1, 500.0, 2.0, 0.0, 0.0)]


@REG.add("sparse_track", _values(TRACK, "ordinal, name, frame, fx, x, y, z"))
def sparse_track(spark: SparkSession, where: str) -> DataFrame:
    """The registered images of a sparse model, in the order of their names, with where they were taken."""
    root = _written(spark, SPARSE)
    t = readers.camera_track(spark, f"{root}/cameras.txt", f"{root}/images.txt")
    return t.select("ordinal", "name", "frame", F.col("intrinsics")[0][0].alias("fx"), *[(F.round(F.col("position")[i], 9) + F.lit(0.0)).alias(c) for i, c in enumerate("xyz")])


@REG.add("sparse_window", _values([(1, 12, "frame_000012.png")], "k, frame, name"))
def sparse_window(spark: SparkSession, where: str) -> DataFrame:
    """The poses of a window's frames that are registered."""
    root = _written(spark, SPARSE)
    w = spark.createDataFrame([(0, 11), (1, 12), (2, 13)], "k int, ordinal long")
    return readers.sliced_track(readers.camera_track(spark, f"{root}/cameras.txt", f"{root}/images.txt"), w).select("k", "frame", "name")


@REG.add("sparse_cloud", _values([(7, 1.5, 2.0, -3.0), (8, 0.0, 0.0, 1.0)], "point_id, x, y, z"))
def sparse_cloud(spark: SparkSession, where: str) -> DataFrame:
    return readers.sparse_points(spark, _written(spark, SPARSE) + "/points3D.txt")


def _npz(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _track_files() -> dict[str, bytes | str]:
    turn = [[0.0, 0.0, 1.0, 1.0], [0.0, 1.0, 0.0, 2.0], [-1.0, 0.0, 0.0, 3.0], [0.0, 0.0, 0.0, 1.0]]
    poses, k = [np.eye(4).tolist(), turn], [[500.0, 0.0, 320.0], [0.0, 501.0, 240.0], [0.0, 0.0, 1.0]]
    each = [k, [[250.0, 0.0, 320.0], [0.0, 250.0, 240.0], [0.0, 0.0, 1.0]]]
    return {
        "a.npz": _npz(cam2world=poses, intrinsics=k), "b.npz": _npz(cam2world=poses, intrinsics=each, metric=np.array(False)), "c.npz": _npz(c2w=poses, intrinsics=np.array([500.0, 501.0, 320.0, 240.0])),
        "d.json": json.dumps({"metric": False, "intrinsics": k, "frames": [{"cam2world": p} for p in poses]}),
        "e.json": json.dumps({"intrinsics": {"width": 640, "height": 480, "hfov_deg": 90.0}, "frames": [{"cam2world": p} for p in poses]}),
        "f.json": json.dumps({"intrinsics": {"model": "PINHOLE", "fx": 500.0, "fy": 501.0, "cx": 320.0, "cy": 240.0}, "frames": [{"c2w": p} for p in poses]}),
    }


READ = [("a.npz", True, 500.0, 500.0), ("b.npz", False, 500.0, 250.0), ("c.npz", False, 500.0, 500.0), ("d.json", False, 500.0, 500.0), ("e.json", True, 320.0, 320.0), ("f.json", False, 500.0, 500.0)]


@REG.add("track_files", _values([(f, i, m, (a, b)[i], float(i), 2.0 * i, 3.0 * i) for f, m, a, b in READ for i in (0, 1)], "file, ordinal, metric, fx, x, y, z"))
def track_files(spark: SparkSession, where: str) -> DataFrame:
    """Camera tracks in each of the six layouts: archives, documents, and both kinds of sidecar."""
    t = readers.tracks(spark, _written(spark, _track_files()))
    return t.select(F.element_at(F.split("path", "/"), -1).alias("file"), "ordinal", "metric", F.round(F.col("intrinsics")[0][0], 9).alias("fx"), *[F.col("pose")[i][3].alias(c) for i, c in enumerate("xyz")])


# a point at the origin of camera 0 as camera 1 sees it, and camera 1's place as camera 0 sees it
@REG.add("relative_poses", _values([("0 to 1", 3.0, -2.0, -1.0, -1.0), ("1 to 0", 1.0, 2.0, 3.0, 1.0)], "pair, x, y, z, r02"))
def relative_poses(spark: SparkSession, where: str) -> DataFrame:
    """Where a camera's origin lies for another, with a corner of the rotation between them."""
    t = readers.tracks(spark, _written(spark, {"a.npz": _track_files()["a.npz"]})).select("ordinal", "pose")
    both = t.filter("ordinal = 0").select(F.col("pose").alias("a")).crossJoin(t.filter("ordinal = 1").select(F.col("pose").alias("b")))  # one row each
    m = F.array(F.struct(F.lit("0 to 1").alias("pair"), camera.relative(F.col("a"), F.col("b")).alias("m")), F.struct(F.lit("1 to 0").alias("pair"), camera.relative(F.col("b"), F.col("a")).alias("m")))
    x = both.select(F.explode(m).alias("x")).select("x.*")
    return x.select("pair", *[(F.col("m")[i][3] + F.lit(0.0)).alias(c) for i, c in enumerate("xyz")], F.col("m")[0][2].alias("r02"))


@REG.add(
    "camera_baseline",
    """WITH cam AS (SELECT vec_id // 124 AS seg, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings
), m AS (SELECT seg, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM cam GROUP BY seg)
SELECT seg, round(quantile_cont(sqrt((c.x - m.x)**2 + (c.y - m.y)**2 + (c.z - m.z)**2), 0.5), 6) AS extent FROM cam c JOIN m USING (seg) GROUP BY seg""",
)
def camera_baseline(spark: SparkSession, where: str) -> DataFrame:
    """How far a camera moves: the median distance of its places from their middle."""
    at = lambda k: F.element_at("embedding", k).cast("double")
    cam = table(spark, where, "embeddings").select(F.expr("vec_id div 124").alias("seg"), at(1).alias("x"), at(2).alias("y"), at(3).alias("z"))
    return audit.baseline(cam, "seg").withColumn("extent", F.round("extent", 6))


@REG.add("fov_intrinsics", _values([(w, f, round(w / 2 / np.tan(np.deg2rad(f) / 2), 6), w / 2) for w, f in ((640, 90.0), (1280, 60.0), (1920, 103.0))], "width, fov, fx, cx"))
def fov_intrinsics(spark: SparkSession, where: str) -> DataFrame:
    s = spark.createDataFrame([(640, 90.0), (1280, 60.0), (1920, 103.0)], "width int, fov double")
    k = camera.of_fov(F.col("width"), F.lit(480), F.col("fov"))
    return s.select("width", "fov", F.round(k[0][0], 6).alias("fx"), k[0][2].alias("cx"))


def _tar(members: list[tuple[str, str]]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body.encode())
            tar.addfile(info, io.BytesIO(body.encode()))
    return out.getvalue()


EPISODES = {
    "data/a/take_1/annotations.tar": _tar([("deep/action.json", json.dumps({"actions": [{"w": i} for i in range(4)]})), ("caption.json", '{"text": "one"}'), ("other/action.json", "[]")]),
    "data/a/take_2/annotations.tar": _tar([("action.json", '[{"w": 9}, {"w": 8}]'), ("caption.json", '{"text": "two"}')]),
    "data/b/take_3/annotations.tar": _tar([("action.json", '{"speed": 3}'), ("caption.json", "[1]")]),
    "data/a/take_1/video.mp4": b"1", "data/a/take_2/video.mp4": b"22", "data/b/loose.MOV": b"333", "data/b/notes.txt": b"4",
}


def _members(spark: SparkSession, name: str) -> DataFrame:
    root = _written(spark, {k: v for k, v in EPISODES.items() if k.endswith(".tar")})
    m = readers.tar_members(spark, f"{root}/data/*/*", [name])
    return m.withColumn("path", F.element_at(F.split("path", "/"), -2))


@REG.add("tar_actions", _values([("take_1", i, f'{{"w":{i}}}') for i in range(4)] + [("take_2", 0, '{"w":9}'), ("take_2", 1, '{"w":8}'), ("take_3", 0, '{"speed":3}')], "path, ordinal, action"))
def tar_actions(spark: SparkSession, where: str) -> DataFrame:
    """The actions of each frame, from lists that stand alone or under a key; of two members with a name the first."""
    return readers.actions(_members(spark, "action.json"))


@REG.add("tar_captions", _values([("take_1", '{"text":"one"}'), ("take_2", '{"text":"two"}')], "path, caption"))
def tar_captions(spark: SparkSession, where: str) -> DataFrame:
    return readers.captions_of(_members(spark, "caption.json"))


@REG.add("window_actions", _values([("take_1", 0, '{"w":1}'), ("take_1", 1, '{"w":3}'), ("take_2", 0, '{"w":8}')], "path, k, action"))
def window_actions(spark: SparkSession, where: str) -> DataFrame:
    """The actions of a window's frames, in its order."""
    w = spark.createDataFrame([(t, k, o) for t in ("take_1", "take_2") for k, o in enumerate((1, 3, 5))], "path string, k int, ordinal int")
    return readers.sliced_actions(readers.actions(_members(spark, "action.json")), w)


@REG.add("episode_videos", _values([("take_1", 1), ("take_2", 2), ("loose", 3)], "sample_id, bytes"))
def episode_videos(spark: SparkSession, where: str) -> DataFrame:
    """Videos under a folder, each once though named twice; those called ``video`` take their folder's name."""
    root = _written(spark, EPISODES)
    return readers.videos(spark, [root, f"{root}/data/a"]).select("sample_id", "bytes")


TREE = {
    "seg_1/duv/000000.depth.f32": b"12", "seg_1/duv/000001.depth.f32": b"12", "seg_1/rgb.mp4": b"x", "seg_1/prompt.txt": "one\r\ntwo", "seg_1/clip_report.json": "{}",
    "seg_2/duv/000000.depth.f32": b"12", "seg_2/rgb.mp4": b"", "seg_2/target/rgb.mp4": b"xy", "seg_3/duv/000000.depth.f32": b"12", "seg_3/rgb.mp4": b"", "seg_4/rgb.mp4": b"x",
    "clip_000001_2/minimax_h3/output.mp4": b"x", "clip_000001_2/duv/000000.depth.f32": b"1", "clip_000001_2/rgb.mp4": b"x",
}


@REG.add(
    "segment_listing",
    _values([("seg_1", 2, "rgb.mp4", True), ("seg_2", 1, "target/rgb.mp4", False), ("seg_3", 1, None, False), ("clip_000001_2", 1, "rgb.mp4", False)], "name, frames, target, prompted"),
)
def segment_listing(spark: SparkSession, where: str) -> DataFrame:
    """Folders with frames, whatever their names, and the first target in them that isn't empty."""
    return readers.segments(readers.listing(spark, _written(spark, TREE)))


@REG.add("clip_listing", _values([("seg_1", False), ("clip_000001_2", True)], "clip, nested"))
def clip_listing(spark: SparkSession, where: str) -> DataFrame:
    """Folders that are clips, by either of the files that make one."""
    return readers.clips(readers.listing(spark, _written(spark, TREE)))


ENTRIES = [
    ("clip_000001_2", "clip_000001_2", "clip_000001_2/rgb.mp4", "clip_000001_2/duv", None), ("seg_1", "seg_1", "seg_1/rgb.mp4", "seg_1/duv", "one\r\ntwo"),
    ("seg_2", "seg_2", "seg_2/target/rgb.mp4", "seg_2/duv", "given"),
]
ENTRY = "name string, id string, target string, proxy_duv string, prompt string"


@REG.add("manifest_entries", _values(ENTRIES, "name, id, target, proxy_duv, prompt"))
def manifest_entries(spark: SparkSession, where: str) -> DataFrame:
    """A manifest built from a tree, written and read again: finished segments only, prompts byte for byte."""
    root, out = _written(spark, TREE), new_folder(spark, "manifest")
    given = spark.createDataFrame([("seg_2", "given")], "name string, prompt string")
    readers.write_manifest(readers.manifest(spark, root, given), out, "name")
    return readers.read_manifest(spark, out, ENTRY)


@REG.add("plane_files", PIXELS_SQL + " SELECT seg, count(*) AS pixels, count(DISTINCT ordinal) AS frames, round(sum(depth), 3) AS metres, CAST(sum(cls) AS BIGINT) AS classes FROM px GROUP BY seg")
def plane_files(spark: SparkSession, where: str) -> DataFrame:
    """Planes written by segment and read again."""
    out = new_folder(spark, "planes")
    readers.write_frames(pixels(spark, where).select("seg", "ordinal", "r", "c", "depth", "cls"), out)
    p = spark.read.parquet(out).groupBy(F.col("seg").cast("long").alias("seg"))
    return p.agg(F.count("*").alias("pixels"), F.count_distinct("ordinal").alias("frames"), F.round(F.sum("depth"), 3).alias("metres"), F.sum("cls").alias("classes"))


@REG.add("code_shifts", "SELECT x / 10.0 AS factor, round(-ln(x / 10.0) / (ln(256.0) - ln(0.3)) * 65535, 6) AS shift FROM range(1, 40) t(x)")
def code_shifts(spark: SparkSession, where: str) -> DataFrame:
    """By how many codes a factor on all depths moves them."""
    x = spark.range(1, 40).select((F.col("id") / 10.0).alias("factor"))
    return x.select("factor", F.round(encode.code_shift(F.col("factor")), 6).alias("shift"))
