"""Web-mercator tile arithmetic as column expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
HALF_WORLD = 20037508.342789244
TILE_SIZE = 512
MACROTILE_Z = 8
OVERVIEWS = 4
MAX_CHILD_Z = 15


def resolution(zoom: int) -> float:
    """Metres of a pixel at the equator."""
    return 2 * HALF_WORLD / (TILE_SIZE * 2**zoom)


def ancestor(x: Column, levels: Column | int) -> Column:
    """The tile coordinate so many zooms up."""
    return F.shiftright(x, levels) if isinstance(levels, int) else F.call_function("shiftright", x, levels)


def stem(z: Column, x: Column, y: Column, child_z: Column) -> Column:
    return F.concat_ws("-", z, x, y, child_z)


def parse_stem(text: Column) -> list[Column]:
    """``z, x, y, child_z`` of a stem."""
    parts = F.split(text, "-")
    return [parts[i].cast("int").alias(n) for i, n in enumerate(("z", "x", "y", "child_z"))]


def native_overzoom(width: Column, height: Column) -> Column:
    """The first zoom whose resolution is finer than both pixel sizes."""
    out = F.lit(32)
    for z in range(32, -1, -1):
        out = F.when(F.lit(resolution(z)) <= F.least(width, height), z).otherwise(out)
    return out


def resolved_maxzoom(native: Column, cap: Column) -> Column:
    """The native zoom under a source's own cap and the general one; eight at least."""
    return F.greatest(F.least(native, F.coalesce(cap, F.lit(MAX_CHILD_Z)), F.lit(MAX_CHILD_Z)), F.lit(MACROTILE_Z))


def job_weight(z: Column, child_z: Column, factor: float, budget: int) -> Column:
    """Gigabytes of a tile's buffered float32 grid by a factor, rounded up, between one and the budget."""
    side = F.pow(F.lit(2.0), (child_z - z).cast("double")) * 512.0 + 128.0
    return F.least(F.greatest(F.ceil(side * side * 4.0 / 1e9 * factor).cast("int"), F.lit(1)), F.lit(budget))


def wrap_antimeridian(left: Column, right: Column) -> tuple[Column, Column]:
    """Bounds that span nearly the whole world cross the antimeridian: they swap."""
    wide = right - left > F.lit(0.9 * 2 * HALF_WORLD)
    return F.when(wide, right).otherwise(left), F.when(wide, left).otherwise(right)


def lonlat_tile(lon: Column, lat: Column, zoom: int, size: int = TILE_SIZE) -> tuple[Column, Column, Column, Column]:
    """Tile and pixel of a position."""
    n = float(2**zoom)
    x = (lon + 180.0) / 360.0 * n
    rad = F.radians(F.least(F.greatest(lat, F.lit(-85.06)), F.lit(85.06)))
    y = (F.lit(1.0) - F.log(F.tan(rad) + F.lit(1.0) / F.cos(rad)) / F.lit(pi)) / 2.0 * n
    tx, ty = F.floor(x).cast("int"), F.floor(y).cast("int")
    return tx, ty, F.floor((x - tx) * float(size)).cast("int"), F.floor((y - ty) * float(size)).cast("int")


def pixel_metres(width_degrees: Column, lat: Column) -> Column:
    return width_degrees * F.lit(2 * HALF_WORLD / 360.0) * F.cos(F.radians(lat))


def hilbert_id(zoom: int, x: Column, y: Column) -> Column:
    """Place of a tile on its zoom's Hilbert curve after all tiles of the zooms above.

    One fold over the bits from the highest: at each the quadrant is added and the coordinates are turned into it.
    """
    state = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    bits = F.array(*(F.lit(1 << b).cast("long") for b in range(zoom - 1, -1, -1))) if zoom else F.array().cast("array<long>")

    def step(a: Column, s: Column) -> Column:
        rx = (a["x"].bitwiseAND(s) > 0).cast("long")
        ry = (a["y"].bitwiseAND(s) > 0).cast("long")
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, s - 1 - a["x"]).otherwise(a["x"]), F.when(flip, s - 1 - a["y"]).otherwise(a["y"])
        turn = ry == 0
        return F.struct(F.when(turn, fy).otherwise(a["x"]).alias("x"), F.when(turn, fx).otherwise(a["y"]).alias("y"), (a["d"] + s * s * ((F.lit(3) * rx).bitwiseXOR(ry))).alias("d"))

    return F.lit((4**zoom - 1) // 3).cast("long") + F.aggregate(bits, state, step)["d"]
