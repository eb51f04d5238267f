"""Readers and writers of the files a corpus comes in: listings, sparse-model text, camera tracks, tar members, manifests.

Text formats are read by Spark's own readers and split in the JVM. Binary ones go through ``binaryFile`` and an
Arrow-batched function, one file at a time in memory.
"""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.functions import camera


VIDEO_SUFFIXES = ("mp4", "mov", "mkv", "webm", "avi")


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes one small file in one step: readers see all of it or nothing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(path + ".partial")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(content))
    out.close()
    if fs.exists(at):
        fs.delete(at, False)
    fs.rename(part, at)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of all files under a folder, paths relative to it."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    inner = F.concat(F.regexp_replace(F.lit(root), "^file:/*", "/"), F.lit("/"))
    bare = F.regexp_replace("path", "^file:/*", "/")
    return f.select(F.when(bare.startswith(inner), F.substring(bare, F.length(inner) + 1, F.length(bare))).otherwise(F.col("path")).alias("path"), F.col("length").alias("bytes"))


def videos(spark: SparkSession, roots: list[str], *, recursive: bool = True, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    """(path, sample_id, bytes): the videos that are named or lie in named folders, each once. One named ``video`` is named
    after its folder. A path that doesn't exist, or a folder without videos, is an error."""
    f = None
    for root in roots:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(root).select("path", "length")
        one = one.filter(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(*suffixes))
        if one.isEmpty():
            raise FileNotFoundError(f"no {'/'.join(suffixes)} files {'under' if recursive else 'in'} {root}")
        f = one if f is None else f.unionByName(one)
    stem, parent = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return f.select("path", F.when(stem == "video", parent).otherwise(stem).alias("sample_id"), F.col("length").alias("bytes")).distinct()


def clips(files: DataFrame) -> DataFrame:
    """(clip, nested): the folders of a listing that are clips, by their report or by the target one level down."""
    f = files.select(F.regexp_extract("path", r"^(.*?)/?(clip_report\.json|minimax_h3/output\.mp4)$", 1).alias("clip"), F.col("path").endswith("clip_report.json").alias("_r"), F.col("path").rlike(r"(^|/)(clip_report\.json|minimax_h3/output\.mp4)$").alias("_ok"))
    return f.filter("_ok").groupBy("clip").agg((~F.bool_or("_r")).alias("nested"))


# Where the target of a segment may lie, first come first served.
TARGETS = ("rgb.mp4", "target/rgb.mp4")


def segments(files: DataFrame, *, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """(name, frames, target, prompted) of the folders of a listing that hold frames in ``duv``: the target is the first of
    the candidates that isn't empty, null if there is none."""
    top, rest = F.regexp_extract("path", r"^([^/]+)/", 1), F.regexp_extract("path", r"^[^/]+/(.*)$", 1)
    f = files.select(top.alias("name"), rest.alias("_f"), "bytes").filter("name <> ''")
    rank = F.array_position(F.array(*[F.lit(t) for t in targets]), F.col("_f"))
    best = F.min(F.when((rank > 0) & (F.col("bytes") > 0), F.struct(rank.alias("r"), F.col("_f").alias("f"))))
    out = f.groupBy("name").agg(F.count_if(F.col("_f").startswith("duv/")).alias("frames"), best.alias("_t"), F.bool_or((F.col("_f") == "prompt.txt") & (F.col("bytes") > 0)).alias("prompted"))
    return out.filter("frames > 0").select("name", "frames", F.col("_t.f").alias("target"), "prompted")


def manifest(spark: SparkSession, root: str, prompts: DataFrame | None = None, *, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """(name, id, target, proxy_duv, prompt): an entry for each finished segment under a folder. A prompt that is handed in
    wins over the one in the segment's ``prompt.txt``, whose bytes are kept as they are; without either it is null."""
    s = segments(listing(spark, root), targets=targets).filter("target IS NOT NULL")
    beside = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "prompt.txt").load(root)
    beside = beside.select(F.regexp_extract("path", r"([^/]+)/prompt\.txt$", 1).alias("name"), F.decode("content", "UTF-8").alias("_own")).filter("_own <> ''")
    s = s.join(beside, "name", "left")
    if prompts is not None:
        s = s.join(prompts.select("name", F.col("prompt").alias("_given")), "name", "left").withColumn("_own", F.coalesce("_given", "_own"))
    path = lambda f: F.concat_ws("/", "name", f)
    return s.select("name", F.col("name").alias("id"), path(F.col("target")).alias("target"), path(F.lit("duv")).alias("proxy_duv"), F.col("_own").alias("prompt"))


def _fields(spark: SparkSession, path: str, least: int) -> DataFrame:
    rows = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"), "value")
    return rows.filter(~F.trim("value").startswith("#") & (F.size("f") >= least)).select("f")


def sparse_cameras(spark: SparkSession, path: str) -> DataFrame:
    """(camera_id, model, width, height, params) of a sparse model's camera text."""
    f = F.col("f")
    return _fields(spark, path, 5).select(
        f[0].cast("int").alias("camera_id"), f[1].alias("model"), f[2].cast("int").alias("width"), f[3].cast("int").alias("height"),
        F.transform(F.slice(f, F.lit(5), F.size(f)), lambda x: x.cast("double")).alias("params"),
    )


def sparse_images(spark: SparkSession, path: str) -> DataFrame:
    """(name, camera_id, rotation, t, position) of the registered images, whatever their names. The lines of points between
    them are skipped: they hold numbers alone, three for each point, where a pose line has a name."""
    f = F.col("f")
    number = lambda x: x.try_cast("double").isNotNull()
    is_pose = F.forall(F.slice(f, F.lit(2), F.lit(7)), number) & F.get(f, F.lit(8)).try_cast("int").isNotNull()
    points = (F.size(f) % 3 == 0) & F.forall(f, number)
    poses = _fields(spark, path, 10).filter(F.coalesce(is_pose, F.lit(False)) & ~points)
    at = lambda k: F.get(f, F.lit(k))
    q, t = [at(k).cast("double") for k in range(1, 5)], F.array(*[at(k).cast("double") for k in range(5, 8)])
    rows = poses.select(at(9).alias("name"), at(8).cast("int").alias("camera_id"), camera.rotation(*q).alias("rotation"), t.alias("t"))
    return rows.withColumn("position", camera.centre(F.col("rotation"), F.col("t")))


def sparse_points(spark: SparkSession, path: str) -> DataFrame:
    f = F.col("f")
    return _fields(spark, path, 4).select(f[0].cast("long").alias("point_id"), *[f[k].cast("double").alias(c) for k, c in ((1, "x"), (2, "y"), (3, "z"))])


def camera_track(spark: SparkSession, cameras: str, images: str) -> DataFrame:
    """(ordinal, name, frame, intrinsics, rotation, position): images in the order of their names, with their cameras.
    ``frame`` is the number in the name, -1 without one: frames that didn't register are absent. Never metric."""
    from pyspark.sql import Window

    c = sparse_cameras(spark, cameras)
    c = c.select("camera_id", camera.intrinsics(F.col("model"), F.col("params")).alias("intrinsics"))
    x = sparse_images(spark, images).join(c, "camera_id")
    one = F.row_number().over(Window.orderBy("name")) - 1  # one track: the images of one episode
    digits = F.regexp_replace(F.regexp_replace("name", r"\.[^.]*$", ""), r"\D", "")
    return x.select(one.alias("ordinal"), "name", F.when(digits == "", -1).otherwise(digits.cast("long")).alias("frame"), "intrinsics", "rotation", "position")


TRACK = "path string, ordinal int, pose array<array<double>>, intrinsics array<array<double>>, metric boolean"


def _track(path: str, content: bytes) -> pd.DataFrame:
    """Camera-to-world poses with intrinsics of one file, by the layout it has."""
    square = lambda fx, fy, cx, cy: [[fx, 0.0, cx], [0.0, fy, cy], [0.0, 0.0, 1.0]]
    if path.endswith(".npz"):
        with np.load(io.BytesIO(content)) as z:
            if "c2w" in z:  # solved from a sparse model: no metric scale
                poses, k, metric = z["c2w"], square(*map(float, z["intrinsics"][:4])), False
            else:
                lacking = {"cam2world", "intrinsics"} - set(z.files)
                if lacking:
                    raise KeyError(f"{path} is missing arrays: {sorted(lacking)}")
                poses, k, metric = z["cam2world"], np.asarray(z["intrinsics"], float).tolist(), bool(z["metric"]) if "metric" in z else True
    elif path.endswith(".json"):
        j = json.loads(content)
        k = j["intrinsics"]
        if isinstance(k, dict) and "fx" in k:
            if k.get("model") not in (None, "PINHOLE", "SIMPLE_PINHOLE"):
                raise ValueError(f"{path}: unsupported camera model {k['model']!r}")
            poses, k, metric = [f["c2w"] for f in j["frames"]], square(*[float(k[c]) for c in ("fx", "fy", "cx", "cy")]), False
        else:
            if isinstance(k, dict):
                focal = k["width"] / 2 / np.tan(np.deg2rad(k["hfov_deg"]) / 2)
                k = square(focal, focal, k["width"] / 2, k["height"] / 2)
            poses, metric = [f["cam2world"] for f in j["frames"]], bool(j.get("metric", True))
    else:
        raise ValueError(f"unsupported camera track format: {path}")
    poses, each = np.asarray(poses, float), np.asarray(k, float)
    if poses.ndim != 3 or poses.shape[1:] != (4, 4) or each.shape not in {(3, 3), (len(poses), 3, 3)}:
        raise ValueError(f"{path}: poses {poses.shape} with intrinsics {each.shape}")
    own = each if each.ndim == 3 else np.broadcast_to(each, (len(poses), 3, 3))
    return pd.DataFrame({"path": path, "ordinal": range(len(poses)), "pose": poses.tolist(), "intrinsics": own.tolist(), "metric": metric})


def tracks(spark: SparkSession, path: str) -> DataFrame:
    """(path, ordinal, pose, intrinsics, metric) of camera tracks in any of the known layouts, one file at a time."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for p, content in zip(part["path"], part["content"]):
                yield _track(p, content)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, TRACK)


def tar_members(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(path, member, content) of the members with these base names; of several in one archive the first."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for p, content in zip(part["path"], part["content"]):
                seen: dict[str, bytes] = {}
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:") as tar:
                    for m in tar:
                        base = m.name.rsplit("/", 1)[-1]
                        if m.isfile() and base in names and base not in seen:
                            seen[base] = tar.extractfile(m).read()
                if seen:
                    yield pd.DataFrame({"path": p, "member": list(seen), "content": list(seen.values())})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, "path string, member string, content binary")


def actions(members: DataFrame) -> DataFrame:
    """(path, ordinal, action) of JSON members that hold a list, alone or under the key actions, frames or data."""
    v = F.try_parse_json(F.decode("content", "UTF-8"))
    kind = F.schema_of_variant(v)
    unwrapped = F.coalesce(F.try_variant_get(v, "$.actions", "array<variant>"), F.try_variant_get(v, "$.frames", "array<variant>"), F.try_variant_get(v, "$.data", "array<variant>"))
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.coalesce(unwrapped, F.array(v)))
    return members.select("path", F.posexplode(listed).alias("ordinal", "a")).select("path", "ordinal", F.to_json("a").alias("action"))


def captions_of(members: DataFrame) -> DataFrame:
    """(path, caption) of JSON members that hold an object, as text."""
    v = F.try_parse_json(F.decode("content", "UTF-8"))
    return members.select("path", F.to_json(v).alias("caption")).filter(F.schema_of_variant(v).startswith("OBJECT"))


def sliced_actions(actions_: DataFrame, window: DataFrame) -> DataFrame:
    """(path, k, action): the actions of a window's frames, in its order; frames beyond the actions are left out.
    ``window``: (path, k, ordinal)."""
    return window.join(actions_, ["path", "ordinal"]).select("path", "k", "action")


def sliced_track(track: DataFrame, window: DataFrame) -> DataFrame:
    """The poses of a window's frames that are registered, with ``k``. ``window``: (k, ordinal)."""
    return track.join(window.select("k", F.col("ordinal").alias("frame")), "frame")


def write_manifest(entries: DataFrame, path: str, order: str) -> None:
    """One JSON object a line, in order, in one file; nulls are left out. For manifests, which are small."""
    entries.orderBy(order).coalesce(1).write.mode("overwrite").json(path)


def write_frames(px: DataFrame, path: str) -> None:
    """Planes by segment, refused as a whole if any depth is negative or not finite, or a class is out of range."""
    bad = (F.col("depth") < 0) | F.isnan("depth") | (F.abs("depth") == float("inf")) | ~F.col("cls").between(0, 11)
    checked = px.withColumn("depth", F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit("a plane holds a depth or class that isn't allowed"))).otherwise(F.col("depth")))
    checked.repartition("seg").write.mode("overwrite").partitionBy("seg").parquet(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of a manifest; a line that isn't one is refused."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def guard_grid(spark: SparkSession, root: str, width: int, height: int) -> bool:
    """Records the size of a folder's frames once: True if this call did. Frames of another size are refused."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    path = f"{root}/semantic.json"
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        put(spark, path, json.dumps({"resolution": {"width": width, "height": height}}).encode())
        return True
    held = spark.read.schema("resolution struct<width:int,height:int>").json(path).first()
    if held and held.resolution and (held.resolution.width, held.resolution.height) != (width, height):
        raise ValueError(f"{root} holds frames of {held.resolution.width}x{held.resolution.height}; {width}x{height} would mix grids")
    return False


# The streams of a scene that are kept as single frames.
STREAMS = ("color", "depth", "semantic", "duv")


def kept_streams(value: str, known: tuple[str, ...] = STREAMS) -> tuple[str, ...]:
    """The streams that a list names; none, all, or some by name. A name that isn't known is refused."""
    text = value.strip().lower()
    if text in ("", "none"):
        return ()
    chosen = known if text == "all" else tuple(p.strip() for p in text.split(",") if p.strip())
    unknown = [c for c in chosen if c not in known]
    if unknown:
        raise ValueError(f"unknown streams: {', '.join(unknown)}; expected some of {', '.join(known)}, or none")
    return chosen


def dropped(files: DataFrame, keep: tuple[str, ...], *, stream: str = "stream") -> DataFrame:
    """The files of a scene that go once its videos are written: those of streams that aren't kept."""
    return files.filter(~F.coalesce(F.col(stream).isin(*keep), F.lit(False))) if keep else files


def settings(spark: SparkSession, path: str, environ: dict[str, str]) -> DataFrame:
    """(key, value) of a file of KEY=VALUE lines: comments and lines without a key left out, quotes and a comma at the end
    taken off, of repeated keys the first. What the environment already sets stands."""
    t = F.trim(F.col("value"))
    at = F.instr(t, "=")
    at_ = spark._jvm.org.apache.hadoop.fs.Path(path)  # names with a dot in front are hidden from the session's readers
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(at_.getFileSystem(spark._jsc.hadoopConfiguration()).open(at_), "UTF-8")
    rows = spark.createDataFrame([(text,)], "value string").select(F.posexplode(F.split("value", "\r?\n")).alias("i", "value"))
    rows = rows.filter((at > 1) & ~t.startswith("#")).select("i", F.trim(F.substring(t, F.lit(1), at - 1)).alias("key"), F.trim(F.rtrim(F.trim(F.substring(t, at + 1, F.length(t))), F.lit(","))).alias("v"))
    quoted = F.col("v").rlike("^(\"[^\n]*\"|'[^\n]*')$") & (F.length("v") >= 2)
    rows = rows.filter("key <> ''").select("i", "key", F.when(quoted, F.substring(F.col("v"), F.lit(2), F.length("v") - 2)).otherwise(F.col("v")).alias("value"))
    first = rows.groupBy("key").agg(F.min(F.struct("i", "value"))["value"].alias("value"))
    held = list(environ)
    return first.filter(~F.col("key").isin(*held)) if held else first
