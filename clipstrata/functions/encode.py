"""Depth codes, class palettes and class lookups, as column expressions that stay in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranges in metres, sentinels and the valid-depth floor of the delivered formats.
NEAR, FAR, VALID = 0.3, 256.0, 1e-3
GREY_NEAR, GREY_FAR = 0.1, 256.0
DUV_NEAR, DUV_FAR, DUV_TOP, DUV_SKY = 0.1, 8000.0, 254, 255

# Class names of the twelve classes, by id, and which wins a contested pixel.
CLASSES = ("void_unknown", "sky", "water", "terrain", "road_paved", "vegetation", "building_structure", "infrastructure", "human", "animal", "vehicle", "prop")
PRIORITY = (0, 1, 3, 2, 3, 4, 5, 6, 10, 9, 8, 7)
# Ids of the eleven delivered classes: sky, player, ped, vehicle, building, road, ground, vegetation, terrain, water, prop.
TWELVE_TO_ELEVEN = (10, 0, 9, 8, 5, 7, 4, 10, 2, 2, 3, 10)
ELEVEN_TO_TWELVE = (1, 8, 9, 10, 6, 4, 7, 5, 3, 2, 11)
# Ids of the six coarse classes: background, road, vegetation, vehicle, npc, hero.
TWELVE_TO_SIX = (0, 0, 0, 0, 1, 2, 0, 0, 4, 3, 3, 0)
SIX_TO_ELEVEN = (10, 5, 7, 3, 2, 1)
# Green and blue of each of the eleven classes in the composite, and of the own vehicle.
GREEN_BLUE = ((255, 255), (0, 255), (0, 128), (64, 0), (0, 0), (255, 255), (0, 0), (255, 0), (0, 0), (0, 0), (0, 0))
EGO = (128, 0)
GROUPS = ("static", "road", "sky", "player", "ped", "vehicle", "ego_vehicle", "vegetation")


def known(metres: Column) -> Column:
    """True where there is depth: a number above the floor. Null and NaN are none."""
    return F.coalesce(~F.isnan(metres) & (metres > VALID), F.lit(False))


def _fraction(metres: Column, near: float, far: float) -> Column:
    """0 at far, 1 at near, on a log scale."""
    held = F.least(F.greatest(metres, F.lit(near)), F.lit(far))
    return (F.lit(math.log(far)) - F.ln(held)) / F.lit(math.log(far) - math.log(near))


def code16(metres: Column) -> Column:
    """Inverted 16-bit log code: near 65535, far and no depth 0. Halves go up."""
    return F.when(known(metres), F.floor(_fraction(metres, NEAR, FAR) * 65535.0 + 0.5)).otherwise(0).cast("int")


def metres_of_code16(code: Column) -> Column:
    x = F.exp(F.lit(math.log(FAR)) - code / F.lit(65535.0) * F.lit(math.log(FAR) - math.log(NEAR)))
    return F.when(code > 0, x).otherwise(0.0)


def code_shift(scale: Column) -> Column:
    """By how many codes a factor on all depths moves them; null for factors that aren't positive."""
    return F.when(scale > 0, -F.ln(scale) / F.lit(math.log(FAR) - math.log(NEAR)) * 65535.0)


def grey8(metres: Column) -> Column:
    """8-bit grey by way of 16 bits; halves go to even, the lowest code of a valid depth is 1."""
    q = F.rint(_fraction(metres, GREY_NEAR, GREY_FAR) * 65535.0)
    grey = F.greatest(F.lit(1.0), F.rint(q * 255.0 / 65535.0))
    return F.when(known(metres) & (q > 0), grey).otherwise(0).cast("int")


def metres_of_grey8(grey: Column) -> Column:
    span = math.log(GREY_FAR) - math.log(GREY_NEAR)
    return F.when(grey > 0, F.exp(F.lit(math.log(GREY_FAR)) - grey / F.lit(255.0) * F.lit(span))).otherwise(0.0)


def lookup(ids: Column, table: tuple[int, ...]) -> Column:
    """A class of another scheme; ids beyond either end take the end's class, null stays null."""
    at = F.least(F.greatest(ids, F.lit(0)), F.lit(len(table) - 1)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in table]), at + 1)


def lookup_or_void(ids: Column, table: tuple[int, ...], ignore: int = 255) -> Column:
    """Like ``lookup``, but void (0) for ids beyond the table, the ignored one and null."""
    inside = (ids >= 0) & (ids < len(table)) & (ids != ignore)
    return F.when(F.coalesce(inside, F.lit(False)), lookup(ids, table)).otherwise(0)


def overlay(base: Column, patch: Column, mask: Column) -> Column:
    """The patch where the mask holds and its class has the strictly higher priority."""
    wins = F.coalesce(mask & (lookup(patch, PRIORITY) > lookup(base, PRIORITY)), F.lit(False))
    return F.when(wins, patch).otherwise(base)


def duv_red(metres: Column, eleven: Column, *, inverted: bool = False) -> Column:
    """Log depth, near 0 to far 254, or the other way round; 255 for sky and where there is no depth."""
    share = _fraction(metres, DUV_NEAR, DUV_FAR)
    code = F.rint((share if inverted else 1.0 - share) * float(DUV_TOP)).cast("int")
    return F.when(~known(metres) | (eleven == 0), DUV_SKY).otherwise(code)


def duv_green_blue(eleven: Column, driving: Column | None = None) -> tuple[Column, Column]:
    out = []
    for k in (0, 1):
        c = lookup(eleven, tuple(x[k] for x in GREEN_BLUE))
        out.append(c if driving is None else F.when(driving & (eleven == 3), EGO[k]).otherwise(c))
    return out[0], out[1]


def duv_group(red: Column, green: Column, blue: Column) -> Column:
    """Which of the eight groups a composite pixel shows."""
    gb = green * 256 + blue
    return (
        F.when(gb == 65535, F.when(red == DUV_SKY, 2).otherwise(1))
        .when(gb == 255, 3).when(gb == 128, 4).when(gb == 64 * 256, 5).when(gb == 128 * 256, 6).when(gb == 255 * 256, 7).otherwise(0)
    )


def metres_of_duv(red: Column) -> Column:
    """Null, not NaN, for the sentinel."""
    return F.when(red < DUV_SKY, F.lit(DUV_NEAR) * F.pow(F.lit(DUV_FAR / DUV_NEAR), red / F.lit(float(DUV_TOP))))


def to_twelve(ids: Column, taxonomy: str) -> Column:
    """Labels of a known scheme as the twelve classes; labels that are out of range, and schemes without a table, are refused."""
    if taxonomy == "cwm12":
        refused = F.raise_error(F.concat(F.lit("labels declared cwm12 contain id "), ids, F.lit(f", outside [0, {len(CLASSES)})"))).cast("int")
        return F.when(ids >= len(CLASSES), refused).otherwise(ids)
    if taxonomy == "standard11":
        return lookup(ids, ELEVEN_TO_TWELVE)
    raise ValueError(f"no table takes {taxonomy!r} to the twelve classes")


def class_table(names: list[str], to: dict[str, int], default: int | None = None) -> list[int]:
    """The class of each name; a name that ``to`` lacks takes the default, and without one is refused."""
    lacking = [n for n in names if n not in to]
    if lacking and default is None:
        raise KeyError(f"no class for: {', '.join(lacking)}")
    return [to.get(n, default) for n in names]


def calibrated(depth: Column, scale: float, shift: float = 0.0, valid: Column | None = None) -> Column:
    """Depth times a scale plus a shift; 0 where there is none: not a positive finite number, or not valid to its model."""
    ok = ~F.isnan(depth) & (depth > 0) & (depth < float("inf"))
    ok = ok if valid is None else ok & valid
    return F.when(F.coalesce(ok, F.lit(False)), depth * scale + shift).otherwise(0.0)


def id_frame(ids: Column) -> tuple[Column, Column, Column]:
    """(red, green, blue) that carry a class id through a lossless encoder."""
    return F.lit(0), F.lit(0), ids.cast("int")
