"""Captions as rows: replies read, checked for structure, checked against evidence, cut to a window, and written out as text.

A caption is one row: ``clip``, ``grid`` (its bins), ``scene``, ``entities``, ``events``, ``window`` and ``evidence``. All
steps are expressions on that row, so a corpus is captioned, checked and compiled in one scan without a shuffle. Work on
a row grows with its own entities, events and bins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstrata.functions import text as T

GRID = "array<struct<index:int,start:double,stop:double,first_frame:bigint,stop_frame:bigint>>"
SCENE = "struct<medium:string,environment:string,environment_rich:string,lighting:string,lighting_rich:string>"
ENTITY = "struct<id:string,kind:string,look:string,look_rich:string,protagonist:boolean,bins:array<int>>"
SAID = "struct<id:string,verb:string,phrase:string,phrase_rich:string,entity:string,target:string,facing:string,bins:array<int>,confidence:double>"
EVENT = (
    "struct<id:string,channel:string,entity:string,verb:string,phrase:string,phrase_rich:string,target:string,facing:string,bins:array<int>,"
    "t:struct<start:double,stop:double>,confidence:double,starts_before:boolean,continues_after:boolean>"
)
REPLY = f"scene {SCENE}, entities array<{ENTITY}>, events array<{SAID}>, camera array<{SAID}>"
WINDOW = "struct<clip:string,t0:double,duration:double,frame_offset:bigint,frames:bigint,sliced_from:string>"
SEEN = (
    "struct<bin:int,start:double,stop:double,player:boolean,peds:int,vehicle:boolean,ego_vehicle:boolean,sky_frac:double,road_frac:double,vegetation_frac:double,"
    "static_frac:double,depth_delta_code:double,world_moving:boolean,depth_p50_m:double>"
)
EVIDENCE = f"struct<hero_resolved:boolean,per_bin:array<{SEEN}>>"
CAPTION = f"clip string, grid {GRID}, scene {SCENE}, entities array<{ENTITY}>, events array<{EVENT}>, window {WINDOW}, evidence {EVIDENCE}"

# Limits of the checks, and the names of what a control stream shows.
SURE, PEDS_OFF, SKY_INDOORS, PENALTY, PRESENT = 0.5, 1, 0.1, 0.05, 0.01
SHOWN = (("road_frac", "road surface"), ("vegetation_frac", "vegetation"), ("static_frac", "static structure"), ("sky_frac", "sky"))
CAMERA = "The camera"
NOTE = "NOTE: the protagonist tracker did not resolve on this clip, so every person is counted as a bystander. Treat 'protagonist not visible' as unknown here."

_none = lambda kind: F.array().cast(f"array<{kind}>")


def _quoted(x: Column) -> Column:
    return F.concat(F.lit("'"), x, F.lit("'"))


def _listed(bins: Column) -> Column:
    return F.array_join(F.transform(bins, lambda b: b.cast("string")), ", ")


def bins_of(raw: Column) -> Column:
    """Bins in order, each once; empty for null."""
    return F.array_sort(F.array_distinct(F.array_compact(F.coalesce(raw, _none("int")))))


def span(grid: Column, bins: Column) -> Column:
    """(start, stop) of the hull of some bins; null without any."""
    mine = F.filter(grid, lambda g: F.array_contains(bins, g["index"]))
    t = F.struct(F.array_min(F.transform(mine, lambda g: g["start"])).alias("start"), F.array_max(F.transform(mine, lambda g: g["stop"])).alias("stop"))
    return F.when(F.size(mine) > 0, t)


def read_reply(reply: Column, grid: Column) -> Column:
    """(scene, entities, events) of a model's reply: names cleaned, defaults put in, verbs taken off complements, camera
    events after the others, times from the bins. An entity without an id is refused; text that isn't an object gives null."""
    x = F.from_json(F.to_json(T.json_object(reply)), REPLY)
    scene = x["scene"]
    c = lambda v: T.clean(v)
    rich = lambda short, long: F.when(c(scene[long]) != "", c(scene[long])).otherwise(c(scene[short])).alias(long)
    scene_ = F.struct(c(scene["medium"]).alias("medium"), c(scene["environment"]).alias("environment"), rich("environment", "environment_rich"), c(scene["lighting"]).alias("lighting"), rich("lighting", "lighting_rich"))

    def entity(e: Column) -> Column:
        ident, kind, look, long = c(e["id"]), F.lower(c(e["kind"])), c(e["look"]), c(e["look_rich"])
        ident = F.when(ident == "", F.raise_error(F.lit("an entity has no id")).cast("string")).otherwise(ident)
        return F.struct(
            ident.alias("id"), F.when(kind == "", "other").otherwise(kind).alias("kind"), look.alias("look"), F.when(long == "", look).otherwise(long).alias("look_rich"),
            F.coalesce(e["protagonist"], F.lit(False)).alias("protagonist"), bins_of(e["bins"]).alias("bins"),
        )

    def event(channel: str):
        def one(e: Column, i: Column) -> Column:
            ident, verb, facing = c(e["id"]), F.lower(c(e["verb"])), F.lower(c(e["facing"]))
            verb, bins, ch = F.when(verb == "", "other").otherwise(verb), bins_of(e["bins"]), F.lit(channel)
            phrase, long = T.complement(c(e["phrase"]), verb, ch), T.complement(c(e["phrase_rich"]), verb, ch)
            or_null = lambda v: F.when(c(v) != "", c(v))
            own = channel == "subject"
            return F.struct(
                F.when(ident == "", F.concat(F.lit("e" if own else "c"), i)).otherwise(ident).alias("id"), ch.alias("channel"), (or_null(e["entity"]) if own else F.lit(None).cast("string")).alias("entity"),
                verb.alias("verb"), phrase.alias("phrase"), F.when(long == "", phrase).otherwise(long).alias("phrase_rich"), or_null(e["target"]).alias("target"),
                (F.when(facing.isin(*T.FACING), facing).otherwise("unknown") if own else F.lit("unknown")).alias("facing"), bins.alias("bins"), span(grid, bins).alias("t"),
                F.coalesce(e["confidence"], F.lit(1.0)).alias("confidence"), F.lit(False).alias("starts_before"), F.lit(False).alias("continues_after"),
            )

        return one

    said = lambda name, channel: F.transform(F.coalesce(x[name], _none(SAID)), event(channel))
    events = F.concat(said("events", "subject"), said("camera", "camera"))
    return F.when(x.isNotNull(), F.struct(scene_.alias("scene"), F.transform(F.coalesce(x["entities"], _none(ENTITY)), entity).alias("entities"), events.alias("events")))


def _in_bin(events: Column, b: Column, channel: str) -> Column:
    return F.filter(events, lambda e: (e["channel"] == channel) & F.array_contains(e["bins"], b))


def problems() -> Column:
    """Everything that is structurally wrong with a caption, entities first, then events, bins and the scene."""
    entities, events, grid = F.col("entities"), F.col("events"), F.col("grid")
    n = F.size(grid)
    ids = F.transform(entities, lambda e: e["id"])
    outside = lambda what, e: F.transform(
        F.filter(e["bins"], lambda b: (b < 0) | (b >= n)), lambda b: F.concat(F.lit(f"{what} "), _quoted(e["id"]), F.lit(" names bin "), b, F.lit(", outside 0.."), n - 1)
    )
    earlier = lambda all_, e, i: F.exists(F.slice(all_, F.lit(1), i), lambda x: x["id"] == e["id"])
    of_entity = F.flatten(F.transform(entities, lambda e, i: F.concat(
        F.array_compact(F.array(
            F.when(earlier(entities, e, i), F.concat(F.lit("duplicate entity id "), _quoted(e["id"]))),
            F.when(~e["kind"].isin(*T.KINDS), F.concat(F.lit("entity "), _quoted(e["id"]), F.lit(" has unknown kind "), _quoted(e["kind"]))),
        )), outside("entity", e))))
    heroes = F.size(F.filter(entities, lambda e: e["protagonist"]))
    one_hero = F.array_compact(F.array(F.when(heroes > 1, "more than one entity is marked protagonist")))
    subject = lambda e: e["channel"] == "subject"
    of_event = F.flatten(F.transform(events, lambda e, i: F.concat(
        F.array_compact(F.array(
            F.when(earlier(events, e, i), F.concat(F.lit("duplicate event id "), _quoted(e["id"]))),
            F.when(~e["channel"].isin(*T.CHANNELS), F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" has unknown channel "), _quoted(e["channel"]))),
            F.when(F.size(e["bins"]) == 0, F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" names no bins"))),
        )), outside("event", e),
        F.array_compact(F.array(
            F.when(subject(e) & e["entity"].isNull(), F.concat(F.lit("subject event "), _quoted(e["id"]), F.lit(" has no entity"))),
            F.when(subject(e) & ~F.array_contains(ids, e["entity"]), F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" refers to unknown entity "), _quoted(e["entity"]))),
            F.when(e["target"].isNotNull() & ~F.array_contains(ids, e["target"]), F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" targets unknown entity "), _quoted(e["target"]))),
            F.when(~e["confidence"].between(0.0, 1.0), F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" has confidence "), e["confidence"])),
        )))))
    lacks = lambda g, ch: F.when(F.size(_in_bin(events, g["index"], ch)) == 0, F.concat(F.lit("bin "), g["index"], F.lit(f" has no {ch} event")))
    of_bin = F.flatten(F.transform(grid, lambda g: F.array_compact(F.array(lacks(g, "subject"), lacks(g, "camera")))))
    medium = F.array_compact(F.array(F.when(F.coalesce(F.col("scene")["medium"], F.lit("")) == "", "scene.medium is empty")))
    return F.concat(of_entity, one_hero, of_event, of_bin, medium)


def unknown_verbs() -> Column:
    off = F.filter("events", lambda e: ~T.known_verb(e["verb"], e["channel"]))
    return F.transform(off, lambda e: F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" uses verb "), _quoted(e["verb"]), F.lit(", which is not in the "), e["channel"], F.lit(" verb list")))


def cut_to(df: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Captions of the sub-window [start, stop), based at zero: bins that lie in it as a whole, events that have any of them
    (marked where the cut runs through), entities that are there or referred to. Without a whole bin the row is left out."""
    inside = F.filter("grid", lambda g: (g["start"] >= start - 1e-9) & (g["stop"] <= stop + 1e-9))
    x = df.withColumn("_in", inside).filter(F.size("_in") > 0)
    lo, off, f0 = F.col("_in")[0]["index"], F.col("_in")[0]["start"], F.col("_in")[0]["first_frame"]
    x = x.withColumns({"_lo": lo, "_off": off, "_f0": f0, "_keep": F.transform("_in", lambda g: g["index"])})
    moved = lambda bins: F.transform(F.filter(bins, lambda b: F.array_contains("_keep", b)), lambda b: b - F.col("_lo"))
    grid = F.transform("_in", lambda g: F.struct(
        (g["index"] - F.col("_lo")).alias("index"), F.round(g["start"] - F.col("_off"), 3).alias("start"), F.round(g["stop"] - F.col("_off"), 3).alias("stop"),
        (g["first_frame"] - F.col("_f0")).alias("first_frame"), (g["stop_frame"] - F.col("_f0")).alias("stop_frame")))
    x = x.withColumn("grid", grid)

    def event(e: Column) -> Column:
        bins = moved(e["bins"])
        first, last = F.try_element_at(e["bins"], F.lit(1)) - F.col("_lo"), F.try_element_at(e["bins"], F.lit(-1)) - F.col("_lo")
        return (
            e.withField("starts_before", e["starts_before"] | (F.get(bins, F.lit(0)) != first)).withField("continues_after", e["continues_after"] | (F.try_element_at(bins, F.lit(-1)) != last))
            .withField("t", span(F.col("grid"), bins)).withField("bins", bins)
        )

    x = x.withColumn("events", F.filter(F.transform("events", event), lambda e: F.size(e["bins"]) > 0))
    named = F.array_distinct(F.concat(F.transform("events", lambda e: e["entity"]), F.transform("events", lambda e: e["target"])))
    x = x.withColumn("_named", F.array_compact(named))
    x = x.withColumn("entities", F.filter(F.transform("entities", lambda e: e.withField("bins", moved(e["bins"]))), lambda e: (F.size(e["bins"]) > 0) | F.array_contains("_named", e["id"])))
    w, last = F.col("window"), F.try_element_at(F.col("grid"), F.lit(-1))
    window = F.struct(
        w["clip"].alias("clip"), F.round(F.coalesce(w["t0"], F.lit(0.0)) + F.col("_off"), 3).alias("t0"), last["stop"].alias("duration"),
        (F.coalesce(w["frame_offset"], F.lit(0)) + F.col("_f0")).alias("frame_offset"), last["stop_frame"].alias("frames"), w["clip"].alias("sliced_from"),
    )
    rows = F.transform(F.filter("evidence.per_bin", lambda r: F.array_contains("_keep", r["bin"])), lambda r: r.withField("bin", r["bin"] - F.col("_lo")))
    x = x.withColumns({"window": window, "evidence": F.struct(F.col("evidence.hero_resolved").alias("hero_resolved"), rows.alias("per_bin"))})
    return x.select(*df.columns)


def check() -> Column:
    """(checked, fail, warn): where a caption and its evidence disagree. Without evidence nothing is checked."""
    entities, events, rows = F.col("entities"), F.col("events"), F.coalesce(F.col("evidence.per_bin"), _none(SEEN))
    at = lambda bins, bad: F.filter(bins, lambda b: F.exists(rows, lambda r: (r["bin"] == b) & bad(r)))
    no_car = lambda r: ~(r["vehicle"] | r["ego_vehicle"])
    hero = F.get(F.filter(entities, lambda e: e["protagonist"]), F.lit(0))
    known = F.coalesce(F.col("evidence.hero_resolved"), F.lit(True))
    unseen = F.transform(at(hero["bins"], lambda r: ~r["player"]), lambda b: F.concat(F.lit("entity "), _quoted(hero["id"]), F.lit(" is placed in bin "), b, F.lit(", where the segmentation finds no protagonist pixels")))
    fail_hero = F.when(known & hero.isNotNull(), unseen).otherwise(_none("string"))
    cars = F.filter(entities, lambda e: ~e["protagonist"] & e["kind"].isin(*T.VEHICLE_KINDS))
    fail_car = F.flatten(F.transform(cars, lambda e: F.transform(at(e["bins"], no_car), lambda b: F.concat(
        F.lit("entity "), _quoted(e["id"]), F.lit(" is a "), e["kind"], F.lit(" in bin "), b, F.lit(", where the segmentation finds no vehicle pixels")))))
    sure = F.filter(events, lambda e: e["confidence"] >= SURE)
    text = lambda e: F.concat_ws(" ", e["phrase"], e["phrase_rich"])
    all_of = lambda e, bad: F.size(at(e["bins"], bad)) == F.size(e["bins"])
    said_car = F.filter(sure, lambda e: text(e).rlike(T.word(T.VEHICLE_WORDS)) & all_of(e, no_car))
    fail_said = F.transform(said_car, lambda e: F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" describes a vehicle, but no bin it covers ("), _listed(e["bins"]), F.lit(") has vehicle pixels")))
    alone = lambda r: r["peds"] == 0
    said_crowd = F.filter(sure, lambda e: text(e).rlike(T.word(T.CROWD_WORDS)) & all_of(e, alone))
    warn_said = F.transform(said_crowd, lambda e: F.concat(F.lit("event "), _quoted(e["id"]), F.lit(" describes other people, but the segmentation finds none in bins "), _listed(e["bins"])))

    def of_bin(r: Column) -> Column:
        named = F.size(F.filter(entities, lambda e: F.array_contains(e["bins"], r["bin"]) & ~e["protagonist"] & e["kind"].isin(*T.PERSON_KINDS)))
        still = F.forall(_in_bin(events, r["bin"], "subject"), lambda e: e["verb"].isin(*T.STILL_VERBS)) & F.forall(_in_bin(events, r["bin"], "camera"), lambda e: e["verb"].isin(*T.STILL_CAMERA))
        indoors = F.coalesce(F.contains(F.lower(F.col("scene.medium")), F.lit("indoor")), F.lit(False))
        return F.array_compact(F.array(
            F.when(F.abs(named - r["peds"]) > PEDS_OFF, F.concat(F.lit("bin "), r["bin"], F.lit(" names "), named, F.lit(" bystanders, the segmentation finds "), r["peds"])),
            F.when(still & r["world_moving"], F.concat(F.lit("bin "), r["bin"], F.lit(" says nothing moves, but the depth field changes by "), short(r["depth_delta_code"]), F.lit(" codes a frame"))),
            F.when(indoors & (r["sky_frac"] > SKY_INDOORS), F.concat(F.lit("scene is called indoor, but bin "), r["bin"], F.format_string(" is %.0f%% sky", r["sky_frac"] * 100))),
        ))

    warn = F.concat(warn_said, F.flatten(F.transform(rows, of_bin)))
    checked = F.size(rows) > 0
    return F.struct(checked.alias("checked"), F.when(checked, F.concat(fail_hero, fail_car, fail_said)).otherwise(_none("string")).alias("fail"), F.when(checked, warn).otherwise(_none("string")).alias("warn"))


def short(x: Column) -> Column:
    """A number without needless digits, at most six."""
    return F.regexp_replace(F.regexp_replace(F.round(x, 6).cast("decimal(18,6)").cast("string"), r"0+$", ""), r"\.$", "")


def score(events: Column, checks: Column) -> Column:
    """The mean confidence of the events less a part for each warning; 0 after a failure or without events."""
    mean = F.aggregate(events, F.lit(0.0), lambda a, e: a + e["confidence"], lambda a: a / F.greatest(F.size(events), F.lit(1)))
    docked = F.round(F.greatest(F.lit(0.0), mean - F.lit(PENALTY) * F.size(checks["warn"])), 3)
    return F.when((F.size(events) == 0) | (F.size(checks["fail"]) > 0), 0.0).otherwise(docked)


def event_form(e: Column, b: Column, final: Column) -> Column:
    """start, already, again, last or continue: the place of a bin in an event, as far as the window can tell."""
    at, last = F.array_position(e["bins"], b) - 1, F.try_element_at(e["bins"], F.lit(-1))
    ends = (b == last) & ~e["continues_after"] & (last != final)
    return F.when(at == 0, F.when(e["starts_before"], "already").otherwise("start")).when(ends & (F.size(e["bins"]) >= 3), "last").when(at == 1, "again").otherwise("continue")


def _prepared(df: DataFrame) -> DataFrame:
    """Adds ``_ev``, the events with their verb forms, their order in the paragraph and whom they are about, and ``_told``,
    one entry for each event and bin. Each step is a column of its own, so that nothing is worked out twice."""
    upper = lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))
    names = F.transform("entities", lambda e: F.struct(e["id"].alias("id"), *[upper(T.named(e[k], e["kind"])).alias(n) for k, n in (("look", "lean"), ("look_rich", "rich"))], F.concat(F.lit("the "), e["kind"]).alias("short")))
    rank = lambda e: F.when(e["channel"] == "subject", 0).when(e["channel"] == "camera", 1).otherwise(2)
    more = lambda e, k: F.coalesce(e[k], F.lit(""))
    df = df.withColumn("_names", names)
    ev = F.transform("events", lambda e, i: F.struct(
        F.struct(F.coalesce(F.get(e["bins"], F.lit(0)), F.lit(0)).alias("b"), rank(e).alias("r"), i.alias("i")).alias("at"), e["channel"].alias("channel"), e["bins"].alias("bins"),
        e["starts_before"].alias("starts_before"), e["continues_after"].alias("continues_after"), T.conjugated(e["verb"], e["channel"], 0).alias("third"), T.conjugated(e["verb"], e["channel"], 1).alias("gerund"),
        more(e, "phrase").alias("lean"), more(e, "phrase_rich").alias("rich"), F.when(e["channel"] != "camera", F.get(F.filter("_names", lambda n: n["id"] == e["entity"]), F.lit(0))).alias("who")))
    df = df.withColumn("_ev", F.array_sort(ev))  # in the paragraph's order
    final = F.try_element_at(F.col("grid"), F.lit(-1))["index"]
    told = F.flatten(F.transform("_ev", lambda e: F.transform(e["bins"], lambda b: F.struct(
        b.alias("b"), e["at"]["r"].alias("r"), e["at"]["i"].alias("i"), e.alias("e"), event_form(e, b, final).alias("form")))))
    # within a bin subjects come before the camera, and events in the order they were given
    df = df.withColumn("_told", F.array_sort(F.filter(told, lambda t: t["r"] < 2)))
    first = lambda over, key: F.transform("_names", lambda n: F.struct(n["id"].alias("id"), F.array_min(F.transform(F.filter(over, lambda t: (t["e"]["who"]["id"] if key else t["who"]["id"]) == n["id"]), lambda t: F.struct(t["b"], t["i"]) if key else t["at"])).alias("at")))
    return df.withColumn("_first", first(F.col("_told"), True)).withColumn("_opens", first(F.col("_ev"), False))


def _subject(e: Column, style: str, first: Column) -> Column:
    """Who an event is about: described where it is named first, by its kind from then on."""
    return F.when(e["channel"] == "camera", CAMERA).when(e["who"].isNull(), "The subject").when(first, e["who"][style]).otherwise(e["who"]["short"])


def lines(style: str) -> Column:
    """One text for each bin, from ``_prepared``: subjects first, then the camera; ``style``: lean or rich."""

    def clause(t: Column) -> Column:
        e, form = t["e"], t["form"]
        first = F.exists("_first", lambda x: (x["id"] == e["who"]["id"]) & (x["at"]["b"] == t["b"]) & (x["at"]["i"] == t["i"]))
        mark = F.when(form == "already", "is already").when(form == "again", "keeps").when(form == "continue", "is still").otherwise("")
        verb = F.when(mark == "", e["third"]).otherwise(e["gerund"])
        way = F.when(form == "last", "the last of the way").otherwise("")
        return T.sentence(T.joined(_subject(e, style, first), mark, verb, way, e[style]))

    def line(g: Column) -> Column:
        return F.array_join(F.filter(F.transform(F.filter("_told", lambda t: t["b"] == g["index"]), clause), lambda c: c != ""), " ")

    return F.transform("grid", line)


def paragraph(style: str) -> Column:
    """The whole clip, from ``_prepared``: the scene, then the events in their order as one sentence."""
    scene, long = F.col("scene"), "_rich" if style == "rich" else ""
    head = [T.sentence(scene[k]) for k in ("medium", f"environment{long}", f"lighting{long}")]

    def clause(e: Column, n: Column) -> Column:
        first = F.exists("_opens", lambda x: (x["id"] == e["who"]["id"]) & (x["at"] == e["at"]))
        who = _subject(e, style, first)
        return T.joined(F.when(n > 0, F.lower(who)).otherwise(who), e["third"], e[style])

    return T.joined(*head, T.sentence(F.array_join(F.transform("_ev", clause), ", then ")))


def facing_line() -> Column:
    """Which way the protagonist faces where that is first known; empty if it isn't."""
    hero = F.get(F.filter("entities", lambda e: e["protagonist"]), F.lit(0))
    known = F.filter(F.transform("events", lambda e, i: F.struct(F.coalesce(F.get(e["bins"], F.lit(0)), F.lit(0)).alias("b"), i.alias("i"), e["entity"].alias("who"), e["facing"].alias("facing"))), lambda x: (x["who"] == hero["id"]) & (x["facing"] != "unknown"))
    first = F.array_min(known)
    return F.when(first.isNotNull(), F.concat(F.lit("Opening screen facing: "), F.replace(first["facing"], F.lit("_"), F.lit(" ")), F.lit("."))).otherwise("")


def contents() -> Column:
    """One sentence on what the control stream of the clip holds; empty without evidence."""
    rows = F.coalesce(F.col("evidence.per_bin"), _none(SEEN))
    most = lambda k: F.array_max(F.transform(rows, lambda r: F.coalesce(r[k].cast("double"), F.lit(0.0))))
    any_ = lambda k: F.exists(rows, lambda r: F.coalesce(r[k], F.lit(False)))
    people = most("peds").cast("int")
    named = F.array_compact(F.array(
        *[F.when(most(k) >= PRESENT, label) for k, label in SHOWN],
        F.when(any_("player") & F.coalesce(F.col("evidence.hero_resolved"), F.lit(True)), "one protagonist"),
        F.when(people == 1, "1 bystander").when(people > 1, F.concat(people, F.lit(" bystanders"))),
        F.when(any_("ego_vehicle"), "the vehicle the camera rides in"), F.when(any_("vehicle"), "traffic"),
    ))
    n = F.size(named)
    listing = F.when(n == 1, named[0]).otherwise(F.concat(F.array_join(F.slice(named, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.try_element_at(named, F.lit(-1))))
    tail = F.when(any_("vehicle") | any_("ego_vehicle"), "").otherwise(", and no vehicles")
    return F.when(n > 0, F.concat(F.lit("In this clip the control video holds "), listing, tail, F.lit("."))).otherwise("")


def briefing() -> Column:
    """The evidence of a clip as one line a second."""

    def line(r: Column) -> Column:
        people = F.when(r["peds"] == 0, "no other people").when(r["peds"] == 1, "1 other person").otherwise(F.concat(r["peds"], F.lit(" other people")))
        parts = F.array_compact(F.array(
            F.when(r["player"], "protagonist visible").otherwise("protagonist not visible"), people, F.when(r["ego_vehicle"], "viewer is in a vehicle"),
            F.when(r["vehicle"], "vehicle on screen").otherwise("no vehicle"), F.when(r["depth_p50_m"].isNotNull(), F.concat(F.lit("median depth "), short(r["depth_p50_m"]), F.lit(" m"))),
            F.format_string("sky %.0f%%", F.rint(r["sky_frac"] * 100)), F.when(r["world_moving"], "world moving").otherwise("world nearly still"),
        ))
        return F.concat(F.format_string("bin %2d (", r["bin"]), short(r["start"]), F.lit("-"), short(r["stop"]), F.lit("s): "), F.array_join(parts, ", "))

    rows = F.transform(F.coalesce(F.col("evidence.per_bin"), _none(SEEN)), line)
    note = F.when(~F.coalesce(F.col("evidence.hero_resolved"), F.lit(True)), NOTE)
    return F.array_join(F.concat(rows, F.array_compact(F.array(note))), "\n")


def compiled(df: DataFrame) -> DataFrame:
    """Adds every text of a caption: ``lean`` and ``rich`` (paragraph, bins), ``timed`` (paragraph, facing, script),
    ``contents``, and ``sample``: the user text of a training sample, its system prompt and its span."""
    names = df.columns
    df = _prepared(df)
    for style in ("lean", "rich"):
        df = df.withColumn(style, F.struct(paragraph(style).alias("paragraph"), lines(style).alias("bins")))
    start = F.coalesce(F.col("window.t0"), F.lit(0.0))
    stop = start + F.coalesce(F.col("window.duration"), F.try_element_at(F.col("grid"), F.lit(-1))["stop"])
    stamped = F.zip_with("grid", F.col("lean.bins"), lambda g, text: F.concat_ws(" ", T.stamp(g["start"] + start, g["stop"] + start), text))
    df = df.withColumn("timed", F.struct(F.col("lean.paragraph").alias("paragraph"), facing_line().alias("facing"), start.alias("offset"), F.array_join(stamped, "\n").alias("script")))
    prose = F.trim("lean.paragraph")
    user = F.when(prose == "", F.raise_error(F.lit("the paragraph is empty, so there is nothing to caption the window with")).cast("string")).otherwise(F.concat_ws(" ", T.stamp(start, stop), prose))
    sample = F.struct(F.when(start > 0, "wn").otherwise("w0").alias("system"), start.alias("start"), stop.alias("stop"), user.alias("user"), F.trim("timed.script").alias("timed"))
    return df.withColumns({"contents": contents(), "sample": sample}).select(*names, "lean", "rich", "timed", "contents", "sample")


def exported(df: DataFrame, *, variant: str = "window", keep_failed: bool = False) -> DataFrame:
    """(clip, text): what goes to disk, with one kind of line end. Captions that fail a check are left out unless asked for;
    those without prose are refused."""
    if variant not in ("window", "timed"):
        raise ValueError(f"unknown variant {variant!r} (window|timed)")
    df = df.withColumn("_c", check())
    good = df if keep_failed else df.filter(F.size("_c.fail") == 0)
    return compiled(good).select("clip", T.crlf(F.col("sample.user" if variant == "window" else "sample.timed")).alias("text"))


def is_exported(text: Column) -> Column:
    """Whether a text is one that was exported: it opens with the stamp of its window."""
    return F.coalesce(text.rlike(r"^\[\d+\.\d{2}s-\d+\.\d{2}s\] "), F.lit(False))


def write(df: DataFrame, path: str) -> None:
    """Captions as JSON documents, one a line; readers see all of them or none."""
    df.select(F.lit("caption").alias("contract"), F.lit(1).alias("version"), *[F.col(c) for c in ("clip", "grid", "scene", "entities", "events", "window", "evidence")]).write.mode("overwrite").json(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Captions that ``write`` wrote; documents of another contract or version are refused."""
    df = spark.read.schema(f"contract string, version int, {CAPTION}").json(path)
    ok = F.coalesce((F.col("contract") == "caption") & (F.col("version") == 1), F.lit(False))
    clip = F.when(ok, F.col("clip")).otherwise(F.raise_error(F.concat(F.lit("not a caption of version 1: "), F.coalesce("contract", F.lit("-")))).cast("string"))
    return df.withColumn("clip", clip).drop("contract", "version")
