"""Text functions of captions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that name a vehicle, or other people.
VEHICLE_WORDS = ("car", "cars", "truck", "trucks", "bus", "buses", "van", "vans", "taxi", "taxis", "motorcycle", "motorbike", "scooter", "traffic", "driving", "drives", "vehicle", "vehicles")
CROWD_WORDS = ("crowd", "crowds", "pedestrian", "pedestrians", "passer", "passers", "bystander", "bystanders", "people", "shopper", "shoppers")
# The third person and the -ing form of the verbs that a caption may name, of subjects and of the camera.
SUBJECT_VERBS = {
    "stand": ("stands", "standing"), "walk": ("walks", "walking"), "run": ("runs", "running"), "sprint": ("sprints", "sprinting"), "jog": ("jogs", "jogging"),
    "turn": ("turns", "turning"), "stop": ("stops", "stopping"), "crouch": ("crouches", "crouching"), "kneel": ("kneels", "kneeling"), "sit": ("sits", "sitting"),
    "jump": ("jumps", "jumping"), "climb": ("climbs", "climbing"), "crawl": ("crawls", "crawling"), "swim": ("swims", "swimming"), "fall": ("falls", "falling"),
    "land": ("lands", "landing"), "drive": ("drives", "driving"), "ride": ("rides", "riding"), "enter": ("enters", "entering"), "exit": ("exits", "exiting"),
    "approach": ("approaches", "approaching"), "retreat": ("retreats", "retreating"), "follow": ("follows", "following"), "look": ("looks", "looking"), "aim": ("aims", "aiming"),
    "shoot": ("shoots", "shooting"), "swing": ("swings", "swinging"), "push": ("pushes", "pushing"), "pull": ("pulls", "pulling"), "carry": ("carries", "carrying"),
    "open": ("opens", "opening"), "close": ("closes", "closing"), "wave": ("waves", "waving"), "talk": ("talks", "talking"), "wander": ("wanders", "wandering"),
    "hover": ("hovers", "hovering"), "fly": ("flies", "flying"), "other": ("moves", "moving"),
}
CAMERA_VERBS = {
    "hold": ("holds", "holding"), "track": ("tracks", "tracking"), "follow": ("follows", "following"), "orbit": ("orbits", "orbiting"), "pan": ("pans", "panning"),
    "tilt": ("tilts", "tilting"), "push_in": ("pushes in", "pushing in"), "pull_back": ("pulls back", "pulling back"), "crane": ("cranes", "craning"),
    "drift": ("drifts", "drifting"), "shake": ("shakes", "shaking"), "cut": ("cuts", "cutting"), "other": ("moves", "moving"),
}
# Kinds of entities, channels of events, ways a figure may face, verbs without motion.
KINDS = ("man", "woman", "person", "child", "crowd", "animal", "car", "truck", "bus", "motorcycle", "bicycle", "boat", "aircraft", "vehicle", "other")
CHANNELS = ("subject", "camera")
FACING = ("back", "front", "left_profile", "right_profile", "three_quarter_left", "three_quarter_right", "unknown")
STILL_VERBS, STILL_CAMERA = ("stand", "sit", "kneel", "crouch"), ("hold",)
VEHICLE_KINDS, PERSON_KINDS = ("car", "truck", "bus", "motorcycle", "vehicle"), ("man", "woman", "person", "child", "crowd")


def _table(verbs: dict[str, tuple[str, str]], form: int) -> Column:
    return F.create_map(*[F.lit(x) for k, v in verbs.items() for x in (k, v[form])])


def conjugated(lemma: Column, channel: Column, form: int) -> Column:
    """The third person (0) or the -ing form (1) of a verb; unlisted verbs, and null, take that of ``other``."""
    key = F.lower(F.trim(F.coalesce(lemma, F.lit(""))))
    of = lambda verbs: F.coalesce(F.try_element_at(_table(verbs, form), key), F.lit(verbs["other"][form]))
    return F.when(channel == "camera", of(CAMERA_VERBS)).otherwise(of(SUBJECT_VERBS))


def known_verb(lemma: Column, channel: Column) -> Column:
    key = F.lower(F.trim(F.coalesce(lemma, F.lit(""))))
    return F.when(channel == "camera", key.isin(*CAMERA_VERBS)).otherwise(key.isin(*SUBJECT_VERBS))


def clean(text: Column) -> Column:
    """White space as single blanks, none at the ends; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def sentence(text: Column) -> Column:
    """Cleaned, the first letter upper-case, with a stop at the end unless there is one; empty stays empty."""
    t = clean(text)
    t = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))
    return F.when(F.length(t) == 0, "").when(t.rlike("[.!?]$"), t).otherwise(F.concat(t, F.lit(".")))


def article(noun: Column) -> Column:
    return F.when(noun.rlike("^[aeiouAEIOU]"), "an").otherwise("a")


def named(look: Column, kind: Column) -> Column:
    """First mention: the description, or the kind; an article unless it starts with a capital."""
    full = F.when(F.coalesce(look, F.lit("")) != "", look).otherwise(kind)
    return F.when(full.rlike("^[A-Z]") & (F.coalesce(look, F.lit("")) != ""), full).otherwise(F.concat_ws(" ", article(full), full))


def word(words: tuple[str, ...]) -> str:
    """A pattern for any of the words, whole and in any case."""
    return r"(?i)\b(" + "|".join(words) + r")\b"


def strip_verb(phrase: Column, third: Column, gerund: Column, lemma: Column) -> Column:
    """Without the verb in front, in the first of the three forms that stands there; nothing but the verb gives empty."""
    p, low = F.trim(F.coalesce(phrase, F.lit(""))), F.lower(F.trim(F.coalesce(phrase, F.lit(""))))
    out = p
    for form in (lemma, gerund, third):
        f = F.lower(form)
        cut = F.trim(F.substring(p, F.length(f) + 1, F.length(p)))
        out = F.when(low == f, F.lit("")).when(low.startswith(F.concat(f, F.lit(" "))), cut).otherwise(out)
    return out


def complement(phrase: Column, lemma: Column, channel: Column) -> Column:
    """The phrase without its verb in front, in whichever of its forms."""
    listed = F.when(known_verb(lemma, channel), F.lower(F.trim(lemma))).otherwise(F.lit("other"))
    return strip_verb(phrase, conjugated(lemma, channel, 0), conjugated(lemma, channel, 1), listed)


def joined(*parts: Column) -> Column:
    """The parts that aren't empty, with blanks between them."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " ")


def stamp(start: Column, stop: Column) -> Column:
    return F.format_string("[%.2fs-%.2fs]", start.cast("double"), stop.cast("double"))


def crlf(text: Column) -> Column:
    """Trimmed, with one kind of line end."""
    return F.regexp_replace(F.trim(text), "\r\n|\r|\n", "\r\n")


def json_object(reply: Column) -> Column:
    """The JSON object of a reply: all of it, or from the first brace to the last; null if neither parses."""
    whole, inner = F.try_parse_json(reply), F.try_parse_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0))
    return F.coalesce(whole, inner)


def synonyms(label: Column) -> Column:
    """The names in a label that commas or semicolons part, cleaned and in lower case."""
    return F.filter(F.transform(F.split(F.lower(label), "[;,]"), clean), lambda s: s != "")


def api_url(base: Column, path: str = "chat/completions") -> Column:
    """The endpoint of a host, its first version's root, or a full address."""
    b = F.regexp_replace(base, "/+$", "")
    return F.when(b.endswith("/" + path), b).when(b.endswith("/v1"), F.concat(b, F.lit("/" + path))).otherwise(F.concat(b, F.lit("/v1/" + path)))


# Answers after which a call is made again, and the kinds of files by suffix.
RETRYABLE = (408, 409, 425, 429, 500, 502, 503, 504)
MIMES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "mp4": "video/mp4", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "mov": "video/quicktime", "webm": "video/webm", "avi": "video/x-msvideo",
    "mkv": "video/x-matroska", "json": "application/json", "txt": "text/plain", "csv": "text/csv", "html": "text/html", "pdf": "application/pdf", "zip": "application/zip", "tar": "application/x-tar", "wav": "audio/x-wav", "mp3": "audio/mpeg",
}


def retryable(status: Column) -> Column:
    return F.coalesce(status.isin(*RETRYABLE), F.lit(False))


def mime(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MIMES.items() for x in kv]), suffix), F.lit("application/octet-stream"))


def reply_text(reply: Column) -> Column:
    """The text of an answer's first choice: as it is, or the texts among its parts, one a line; empty without any."""
    v = F.try_parse_json(reply)
    whole, parts = F.try_variant_get(v, "$.choices[0].message.content", "string"), F.try_variant_get(v, "$.choices[0].message.content", "array<variant>")
    one = lambda p: F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")).when(F.schema_of_variant(p).startswith("OBJECT"), F.try_variant_get(p, "$.text", "string"))
    return F.coalesce(F.when(parts.isNotNull(), F.trim(F.array_join(F.array_compact(F.transform(parts, one)), "\n"))), F.trim(whole), F.lit(""))
