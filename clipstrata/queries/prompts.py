"""Queries over captions: replies read, checked, cut, compiled to text. The replies are small and given here, as no table
holds any; the steps are those a corpus goes through."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.operators import captions
from clipstrata.plans import windows
from clipstrata.queries import Registry
from clipstrata.session import new_folder

REG = Registry()

REPLIES = {
    "walk": 'Here it is: {"scene": {"medium": "third-person game  capture", "environment": "a wet plaza", "lighting": "overcast daylight", "lighting_rich": "flat light under a grey sky"}, '
    '"entities": [{"id": "p", "kind": "Man", "look": "man in an orange jacket", "protagonist": true, "bins": [0, 1, 2, 3, 4]}, {"id": "w", "kind": "woman", "bins": [3, 2]}], '
    '"events": [{"verb": "walk", "phrase": "walks steadily along the path", "phrase_rich": "walking steadily along the wet stone path", "entity": "p", "facing": "back", "bins": [2, 0, 1, 1], "confidence": 0.9}, '
    '{"id": "s", "verb": "Stop", "phrase": "stops", "entity": "p", "facing": "sideways", "bins": [3, 4], "confidence": 0.8}, '
    '{"verb": "wave", "phrase": "at the man", "entity": "w", "target": "p", "bins": [2, 3], "confidence": 1.0}], '
    '"camera": [{"verb": "follow", "phrase": "behind him", "bins": [0, 1, 2, 3, 4], "confidence": 0.7}]} Done.',
    "broken": '{"scene": {"environment": "x"}, "entities": [{"id": "a", "kind": "man", "protagonist": true}, {"id": "a", "kind": "wizard", "protagonist": true, "bins": [7]}], '
    '"events": [{"id": "e0", "verb": "walk", "entity": "a", "bins": [0, 9]}, {"id": "e0", "verb": "teleport", "bins": []}, {"verb": "run", "entity": "zz", "target": "qq", "bins": [1], "confidence": 1.5}]}',
    "indoor": '{"scene": {"medium": "Indoor scene", "environment": "an empty hall"}, "entities": [{"id": "h", "kind": "person", "protagonist": true, "bins": [0, 1]}, {"id": "c", "kind": "car", "bins": [2]}], '
    '"events": [{"verb": "stand", "phrase": "by the traffic lights", "entity": "h", "facing": "left_profile", "bins": [0, 1, 2, 3, 4], "confidence": 0.6}, '
    '{"verb": "look", "phrase": "at the crowd", "entity": "h", "bins": [3], "confidence": 0.5}, {"verb": "drive", "phrase": "past a bus", "entity": "c", "bins": [2], "confidence": 0.4}], '
    '"camera": [{"verb": "hold", "bins": [0, 1, 2, 3, 4]}]}',
    "nothing": "I can't see the video.",
}


def _row(b: int, **more) -> dict:
    one = {"bin": b, "start": float(b), "stop": b + 1.0 if b < 4 else 5.167, "player": True, "peds": 0, "vehicle": False, "ego_vehicle": False, "sky_frac": 0.05, "road_frac": 0.3}
    return {**one, "vegetation_frac": 0.005, "static_frac": 0.6, "depth_delta_code": 0.2, "world_moving": False, "depth_p50_m": 7.5, **more}


EVIDENCE = {
    "walk": {"hero_resolved": True, "per_bin": [_row(b, peds=1, world_moving=True, depth_delta_code=1.25, depth_p50_m=12.0) for b in range(5)]},
    "indoor": {"hero_resolved": None, "per_bin": [_row(0), _row(1, player=False), _row(2, peds=3), _row(3, sky_frac=0.236), _row(4, world_moving=True, depth_delta_code=0.75)]},
}


def told(spark: SparkSession) -> DataFrame:
    """The captions of the replies that hold one, on the grid of a clip of 124 frames."""
    rows = [(k, r, json.dumps(EVIDENCE[k]) if k in EVIDENCE else None, 10.0 if k == "indoor" else None, 124, 24.0) for k, r in REPLIES.items()]
    r = spark.createDataFrame(rows, "clip string, reply string, seen string, t0 double, n int, rate double")
    grid = windows.second_grid(r, "clip", "n", "rate").select("clip", F.struct(F.col("bin").alias("index"), "start", "stop", "first_frame", "stop_frame").alias("g"))
    grid = grid.groupBy("clip").agg(F.array_sort(F.collect_list("g")).cast(captions.GRID).alias("grid"))
    x = r.join(grid, "clip").withColumn("x", captions.read_reply(F.col("reply"), F.col("grid"))).filter("x IS NOT NULL")
    w = F.struct(F.col("clip"), F.coalesce("t0", F.lit(0.0)).alias("t0"), F.lit(None).cast("double").alias("duration"), F.lit(0).cast("long").alias("frame_offset"), F.col("n").cast("long").alias("frames"), F.lit(None).cast("string").alias("sliced_from"))
    return x.select("clip", "grid", "x.scene", "x.entities", "x.events", w.cast(captions.WINDOW).alias("window"), F.from_json("seen", captions.EVIDENCE).alias("evidence"))


def _values(rows: list[tuple], names: str) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) t({names})"


# What follows from the reference's rules for these replies, by hand.
EVENTS = [
    ("walk", "e0", "subject", "p", "walk", "steadily along the path", "steadily along the wet stone path", None, "back", "0,1,2", 0.0, 3.0, 0.9),
    ("walk", "s", "subject", "p", "stop", "", "", None, "unknown", "3,4", 3.0, 5.167, 0.8),
    ("walk", "e2", "subject", "w", "wave", "at the man", "at the man", "p", "unknown", "2,3", 2.0, 4.0, 1.0),
    ("walk", "c0", "camera", None, "follow", "behind him", "behind him", None, "unknown", "0,1,2,3,4", 0.0, 5.167, 0.7),
    ("broken", "e0", "subject", "a", "walk", "", "", None, "unknown", "0,9", 0.0, 1.0, 1.0),
    ("broken", "e0", "subject", None, "teleport", "", "", None, "unknown", "", None, None, 1.0),
    ("broken", "e2", "subject", "zz", "run", "", "", "qq", "unknown", "1", 1.0, 2.0, 1.5),
    ("indoor", "e0", "subject", "h", "stand", "by the traffic lights", "by the traffic lights", None, "left_profile", "0,1,2,3,4", 0.0, 5.167, 0.6),
    ("indoor", "e1", "subject", "h", "look", "at the crowd", "at the crowd", None, "unknown", "3", 3.0, 4.0, 0.5),
    ("indoor", "e2", "subject", "c", "drive", "past a bus", "past a bus", None, "unknown", "2", 2.0, 3.0, 0.4),
    ("indoor", "c0", "camera", None, "hold", "", "", None, "unknown", "0,1,2,3,4", 0.0, 5.167, 1.0),
]


@REG.add("caption_events", _values(EVENTS, "clip, id, channel, entity, verb, phrase, phrase_rich, target, facing, bins, start, stop, confidence"))
def caption_events(spark: SparkSession, where: str) -> DataFrame:
    """Replies to events: words around the object dropped, names cleaned, verbs taken off, bins in order, times bound."""
    e = told(spark).select("clip", F.explode("events").alias("e"))
    plain = ["id", "channel", "entity", "verb", "phrase", "phrase_rich", "target", "facing"]
    return e.select("clip", *[F.col(f"e.{c}").alias(c) for c in plain], F.array_join(F.transform("e.bins", lambda b: b.cast("string")), ",").alias("bins"), "e.t.start", "e.t.stop", "e.confidence")


PROBLEMS = [
    "duplicate entity id 'a'", "entity 'a' has unknown kind 'wizard'", "entity 'a' names bin 7, outside 0..4", "more than one entity is marked protagonist", "event 'e0' names bin 9, outside 0..4",
    "duplicate event id 'e0'", "event 'e0' names no bins", "subject event 'e0' has no entity", "event 'e2' refers to unknown entity 'zz'", "event 'e2' targets unknown entity 'qq'", "event 'e2' has confidence 1.5",
    "bin 0 has no camera event", "bin 1 has no camera event", "bin 2 has no subject event", "bin 2 has no camera event", "bin 3 has no subject event", "bin 3 has no camera event", "bin 4 has no subject event",
    "bin 4 has no camera event", "scene.medium is empty",
]
VERB = "event 'e0' uses verb 'teleport', which is not in the subject verb list"


@REG.add("caption_structure", _values([("broken", i, p) for i, p in enumerate([*PROBLEMS, VERB])], "clip, nth, problem"))
def caption_structure(spark: SparkSession, where: str) -> DataFrame:
    """What is structurally wrong with a caption, in order, then its verbs that no list has."""
    return told(spark).select("clip", F.posexplode(F.concat(captions.problems(), captions.unknown_verbs())).alias("nth", "problem"))


FOUND = [
    ("indoor", "fail", 0, "entity 'h' is placed in bin 1, where the segmentation finds no protagonist pixels"),
    ("indoor", "fail", 1, "entity 'c' is a car in bin 2, where the segmentation finds no vehicle pixels"),
    ("indoor", "fail", 2, "event 'e0' describes a vehicle, but no bin it covers (0, 1, 2, 3, 4) has vehicle pixels"),
    ("indoor", "warn", 0, "event 'e1' describes other people, but the segmentation finds none in bins 3"),
    ("indoor", "warn", 1, "bin 2 names 0 bystanders, the segmentation finds 3"),
    ("indoor", "warn", 2, "scene is called indoor, but bin 3 is 24% sky"),
    ("indoor", "warn", 3, "bin 4 says nothing moves, but the depth field changes by 0.75 codes a frame"),
]


@REG.add("caption_evidence", _values(FOUND, "clip, kind, nth, text"))
def caption_evidence(spark: SparkSession, where: str) -> DataFrame:
    """Where captions and evidence disagree, by all six rules."""
    c = told(spark).withColumn("c", captions.check())
    of = lambda k: c.select("clip", F.lit(k).alias("kind"), F.posexplode(f"c.{k}").alias("nth", "text"))
    return of("fail").unionByName(of("warn"))


@REG.add("caption_scores", _values([("walk", True, True, 0.85), ("broken", False, True, 1.167), ("indoor", True, False, 0.0)], "clip, checked, passed, score"))
def caption_scores(spark: SparkSession, where: str) -> DataFrame:
    """The mean confidence less a part for each warning; 0 after a failure. What lacks evidence passes unchecked."""
    c = told(spark).withColumn("c", captions.check())
    return c.select("clip", "c.checked", (F.size("c.fail") == 0).alias("passed"), captions.score(F.col("events"), F.col("c")).alias("score"))


LINES = [
    ("walk", "lean", 0, "A man in an orange jacket walks steadily along the path. The camera follows behind him."),
    ("walk", "lean", 1, "The man keeps walking steadily along the path. The camera keeps following behind him."),
    ("walk", "lean", 2, "The man walks the last of the way steadily along the path. A woman waves at the man. The camera is still following behind him."),
    ("walk", "lean", 3, "The man stops. The woman keeps waving at the man. The camera is still following behind him."),
    ("walk", "lean", 4, "The man keeps stopping. The camera is still following behind him."),
    ("walk", "rich", 0, "A man in an orange jacket walks steadily along the wet stone path. The camera follows behind him."),
    ("walk", "rich", 1, "The man keeps walking steadily along the wet stone path. The camera keeps following behind him."),
    ("walk", "rich", 2, "The man walks the last of the way steadily along the wet stone path. A woman waves at the man. The camera is still following behind him."),
    ("walk", "rich", 3, "The man stops. The woman keeps waving at the man. The camera is still following behind him."),
    ("walk", "rich", 4, "The man keeps stopping. The camera is still following behind him."),
]


@REG.add("caption_lines", _values(LINES, "clip, style, bin, text"))
def caption_lines(spark: SparkSession, where: str) -> DataFrame:
    """One text a second: who is described where first named, and verbs by their place in the action."""
    c = captions.compiled(told(spark).filter("clip = 'walk'"))
    of = lambda k: c.select("clip", F.lit(k).alias("style"), F.posexplode_outer(f"{k}.bins").alias("bin", "text"))
    return of("lean").unionByName(of("rich"))


HEAD = "Third-person game capture. A wet plaza. Overcast daylight. "
TOLD = "A man in an orange jacket walks steadily along the path, then the camera follows behind him, then a woman waves at the man, then the man stops."
HALL = "Indoor scene. An empty hall. A person stands by the traffic lights, then the camera holds, then a car drives past a bus, then the person looks at the crowd."
TEXTS = [
    ("walk", HEAD + TOLD, "Third-person game capture. A wet plaza. Flat light under a grey sky. " + TOLD.replace("the path", "the wet stone path"), "Opening screen facing: back.",
     "In this clip the control video holds road surface, static structure, sky, one protagonist and 1 bystander, and no vehicles.", "w0", 0.0, 5.167, "[0.00s-5.17s] " + HEAD + TOLD),
    ("indoor", HALL, HALL, "Opening screen facing: left profile.",
     "In this clip the control video holds road surface, static structure, sky, one protagonist and 3 bystanders, and no vehicles.", "wn", 10.0, 15.167, "[10.00s-15.17s] " + HALL),
]


@REG.add("caption_texts", _values(TEXTS, "clip, lean, rich, facing, contents, system, start, stop, user_text"))
def caption_texts(spark: SparkSession, where: str) -> DataFrame:
    """Paragraphs, facing, the control stream's contents, and the sample with its system prompt and span."""
    c = captions.compiled(told(spark).filter("clip <> 'broken'"))
    return c.select("clip", F.col("lean.paragraph").alias("lean"), F.col("rich.paragraph").alias("rich"), "timed.facing", "contents", "sample.system", "sample.start", F.round("sample.stop", 3).alias("stop"), F.col("sample.user").alias("user_text"))


SCRIPT = "\r\n".join(f"[{b:.2f}s-{5.167 if b == 4 else b + 1:.2f}s] {t}" for _, k, b, t in LINES if k == "lean")


@REG.add("caption_export", _values([("walk", "window", TEXTS[0][8]), ("walk", "timed", SCRIPT), ("indoor", "kept", TEXTS[1][8])], "clip, variant, text"))
def caption_export(spark: SparkSession, where: str) -> DataFrame:
    """What goes to disk: captions that fail a check only if asked for, with one kind of line end."""
    c = told(spark).filter("clip <> 'broken'")
    both = [captions.exported(c, variant=v).select("clip", F.lit(v).alias("variant"), "text") for v in ("window", "timed")]
    return both[0].unionByName(both[1]).unionByName(captions.exported(c, keep_failed=True).filter("clip = 'indoor'").select("clip", F.lit("kept").alias("variant"), "text"))


SLICED = [
    ("walk", "e0", "0,1", 0.0, 2.0, True, False, "The man"), ("walk", "s", "2", 2.0, 3.0, False, True, "The man"), ("walk", "e2", "1,2", 1.0, 3.0, False, False, "The woman"), ("walk", "c0", "0,1,2", 0.0, 3.0, True, True, "The camera"),
    ("indoor", "e0", "0,1,2", 0.0, 3.0, True, True, "The person"), ("indoor", "e1", "2", 2.0, 3.0, False, False, "The person"), ("indoor", "e2", "1", 1.0, 2.0, False, False, "The car"), ("indoor", "c0", "0,1,2", 0.0, 3.0, True, True, "The camera"),
]


@REG.add("caption_window", _values([r[:7] for r in SLICED], "clip, id, bins, start, stop, starts_before, continues_after"))
def caption_window(spark: SparkSession, where: str) -> DataFrame:
    """Captions cut to seconds 1 to 4.2: whole bins only, and events that the cut runs through are marked."""
    c = captions.cut_to(told(spark).filter("clip <> 'broken'"), F.lit(1.0), F.lit(4.2))
    e = c.select("clip", F.explode("events").alias("e"))
    return e.select("clip", "e.id", F.array_join(F.transform("e.bins", lambda b: b.cast("string")), ",").alias("bins"), "e.t.start", "e.t.stop", "e.starts_before", "e.continues_after")


WINDOWS = [
    ("walk", 1.0, 3.0, 24, 72, 3, "p:0,1,2 w:1,2", "A man in an orange jacket is already walking steadily along the path. The camera is already following behind him."),
    ("indoor", 11.0, 3.0, 24, 72, 3, "h:0 c:1", "A person is already standing by the traffic lights. The camera is already holding."),
]


@REG.add("caption_window_state", _values(WINDOWS, "clip, t0, duration, frame_offset, frames, seen, entities, first_line"))
def caption_window_state(spark: SparkSession, where: str) -> DataFrame:
    """The window of a cut caption: its place in the clip, its evidence and entities, and that nothing is said to begin there."""
    c = captions.compiled(captions.cut_to(told(spark).filter("clip <> 'broken'"), F.lit(1.0), F.lit(4.2)))
    e = F.array_join(F.transform("entities", lambda e: F.concat(e["id"], F.lit(":"), F.array_join(F.transform(e["bins"], lambda b: b.cast("string")), ","))), " ")
    w = [F.col(f"window.{k}").alias(k) for k in ("t0", "duration", "frame_offset", "frames")]
    return c.select("clip", *w, F.size("evidence.per_bin").alias("seen"), e.alias("entities"), F.col("lean.bins")[0].alias("first_line"))


_SEEN = "protagonist visible, 1 other person, no vehicle, median depth 12 m, sky 5%, world moving"
_HALL = "protagonist visible, no other people, no vehicle, median depth 7.5 m, sky 5%, world nearly still"
BRIEFS = [
    ("walk", "\n".join(f"bin  {b} ({b}-{5.167 if b == 4 else b + 1}s): {_SEEN}" for b in range(5))),
    ("indoor", "\n".join([f"bin  0 (0-1s): {_HALL}", "bin  1 (1-2s): " + _HALL.replace("visible", "not visible"), "bin  2 (2-3s): " + _HALL.replace("no other", "3 other"),
                          "bin  3 (3-4s): " + _HALL.replace("5%", "24%"), "bin  4 (4-5.167s): " + _HALL.replace("nearly still", "moving")])),
]


@REG.add("caption_briefing", _values(BRIEFS, "clip, briefing"))
def caption_briefing(spark: SparkSession, where: str) -> DataFrame:
    """The evidence as lines for the model that writes the caption."""
    return told(spark).filter("clip <> 'broken'").select("clip", captions.briefing().alias("briefing"))


@REG.add("caption_roundtrip", _values([(k, True) for k in ("walk", "broken", "indoor")], "clip, same"))
def caption_roundtrip(spark: SparkSession, where: str) -> DataFrame:
    """Captions written and read again hold the same."""
    path, c = new_folder(spark, "captions"), told(spark)
    captions.write(c, path)
    whole = lambda df, n: df.select("clip", F.to_json(F.struct("grid", "scene", "entities", "events", "window", "evidence")).alias(n))
    return whole(c, "a").join(whole(captions.read(spark, path), "b"), "clip").select("clip", (F.col("a") == F.col("b")).alias("same"))
