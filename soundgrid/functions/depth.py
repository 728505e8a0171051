"""Elevation and depth as column expressions. Elevation is in metres, negative down, 0 is chart datum; NULL is no data.

The rule of the whole library: rounding and thinning may make water shallower, never deeper.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
METRES_PER_FOOT = 0.3048
METRES_PER_FATHOM = 1.8288
DRYING_CAP = 16.0
LSB = 0.00390625
METRE_LADDER = [0, 2, 5, 10, 20, 30, 50, 100, 200, 300, 500, 1000, 2000, 3000, 4000, 5000, 6000, 8000, 10000]
FATHOM_LADDER = [1, 2, 3, 5, 10, 20, 30, 50, 100, 200, 300, 500, 1000, 2000, 3000, 5000]
THIN_TIERS = [(200.0, 1), (1000.0, 2)]
CONTOUR_TIERS = [
    (5, [200, 1000, 2000, 4000]),
    (7, [200, 500, 1000, 2000, 3000, 4000]),
    (9, [50, 100, 200, 300, 500, 1000, 2000, 3000, 4000, 5000, 6000, 8000, 10000]),
    (11, [10, 20, 30, 50, 100, 200, 300, 500, 1000, 2000, 3000, 4000, 5000, 6000, 8000, 10000]),
]

def negate_depth(depth: Column) -> Column:
    """Positive-down depth as elevation, and back."""
    return -depth


def datum_offset(z: Column, offset: float) -> Column:
    return z + F.lit(float(offset))


def clamp_positive(z: Column) -> Column:
    """No data above the datum."""
    return F.when(z <= 0.0, z)


def valid_range(z: Column, low: float, high: float) -> Column:
    """No data outside a closed range."""
    return F.when(z.between(float(low), float(high)), z)


def mask_sentinels(z: Column, sentinel: float = -99999.0) -> Column:
    """No data at and below a source's sentinel."""
    return F.when(z > F.lit(float(sentinel)), z)


def value_transform(raw: Column, negate: bool, offset: float, reference: Column, positive_is_void: bool, low: float, high: float) -> Column:
    """A source's values in the chart's frame: sign, offset, reference surface where there is one, void above datum, range; in that order."""
    z = negate_depth(raw) if negate else raw
    z = datum_offset(z, offset) - F.coalesce(reference, F.lit(0.0))
    z = clamp_positive(z) if positive_is_void else z
    return valid_range(z, low, high)


def land_clamp(z: Column, land: Column) -> Column:
    """Water under land is at the datum."""
    return F.when(land & (z < 0.0), 0.0).otherwise(z)


def lake_clear(z: Column, inland_water: Column) -> Column:
    """Ground above the datum in inland water is no data."""
    return F.when(~(inland_water & (z > 0.0)), z)


def quantization_factor(zoom: int) -> float:
    """Vertical step of a zoom, in metres."""
    return 2.0 ** (19 - zoom) / 256.0


def quantization_factor_of(zoom: Column) -> Column:
    return F.pow(F.lit(2.0), F.lit(19.0) - zoom) / F.lit(256.0)


def quantize(z: Column, zoom: int) -> Column:
    """Elevation rounded up (shallower) to the zoom's step, which is no more than about a sixteenth of the depth; water stays water."""
    relative = F.greatest(F.abs(z) / F.lit(16.0), F.lit(0.25))
    cap = F.pow(F.lit(2.0), F.ceil(F.log2(relative)).cast("double"))
    step = F.least(F.lit(quantization_factor(zoom)), cap)
    up = F.ceil(z / step).cast("double") * step
    return F.when((z < 0.0) & (up >= 0.0), F.lit(-LSB)).otherwise(up)


def terrarium_encode(height: Column) -> tuple[Column, Column, Column]:
    """A quantized elevation as red, green and blue."""
    shifted = height + F.lit(32768.0)
    whole = F.floor(shifted).cast("long")
    return F.floor(whole / 256).cast("int"), F.pmod(whole, F.lit(256)).cast("int"), F.round((shifted - whole) * 256.0).cast("int")


def terrarium_decode(r: Column, g: Column, b: Column) -> Column:
    return r * F.lit(256.0) + g + b / F.lit(256.0) - F.lit(32768.0)


def terrarium_pack(height: Column) -> tuple[Column, Column, Column]:
    """The serving form: the nearest of 24 bits, clamped."""
    n = F.least(F.greatest(F.floor((height + F.lit(32768.0)) * 256.0 + 0.5).cast("long"), F.lit(0)), F.lit((1 << 24) - 1))
    return F.shiftright(n, 16).cast("int"), F.shiftright(n, 8).bitwiseAND(255).cast("int"), n.bitwiseAND(255).cast("int")


def classify_pixel(z: Column, land: Column | None) -> Column:
    """0 no data or water, 1 drying ground, 2 land. Without a mask all ground above the datum is land."""
    if land is None:
        return F.when(z > 0.0, 2).otherwise(0)
    return F.when(z.isNull(), 0).when((z > 0.0) & ~land & (z <= F.lit(DRYING_CAP)), 1).when((z > 0.0) | land, 2).otherwise(0)


def floored(x: Column) -> Column:
    """The whole part below a value; one that misses a whole number by under a billionth counts as it."""
    return F.floor(x + F.lit(1e-9)).cast("double")


def depth_labels(depth: Column) -> tuple[Column, Column, Column]:
    """Charted metres (tenths to 21 m, halves to 31 m, then whole), feet and fathoms of a positive-down depth, all floored."""
    metres = F.when(depth < 21.0, floored(depth * 10.0) / 10.0).when(depth < 31.0, floored(depth * 2.0) / 2.0).otherwise(floored(depth))
    return metres, floored(depth / F.lit(METRES_PER_FOOT)).cast("int"), floored(depth / F.lit(METRES_PER_FATHOM)).cast("int")


def thin_shift(depth: Column) -> Column:
    """How many zooms coarser a sounding's lattice is: the last tier that its depth reaches."""
    out = F.lit(0)
    for cutoff, shift in THIN_TIERS:
        out = F.when(depth >= F.lit(cutoff), shift).otherwise(out)
    return out


def zoom_placement(minzoom: Column, child_z: Column, lattice: Column) -> Column:
    """Last zoom of a sounding; NULL if it has none: only coarser lattice levels make way for the next one."""
    return F.when(lattice & (minzoom != child_z), minzoom)


def displayed_at(zoom: Column, minzoom: Column, child_z: Column, lattice: Column) -> Column:
    last = zoom_placement(minzoom, child_z, lattice)
    return F.when(last.isNotNull(), zoom == last).otherwise(zoom >= minzoom)


def contour_minzoom(depth: Column, feet: Column) -> Column:
    """First zoom band that shows a curve of a positive-down depth; feet curves show once as deep as the band's shallowest metre curve."""
    floors = [0, *(z for z, _ in CONTOUR_TIERS)]
    out = F.lit(floors[-1])
    for floor, (_, levels) in reversed(list(zip(floors, CONTOUR_TIERS))):
        shown = F.when(feet, depth >= F.lit(float(min(levels)))).otherwise(F.round(depth).cast("int").isin(levels))
        out = F.when(shown, floor).otherwise(out)
    return out


def ladder(fathoms: bool = False) -> list[float]:
    """Levels of the metre or the fathom ladder in metres, with the shoreline."""
    return [0.0, *(round(fm * METRES_PER_FATHOM, 4) for fm in FATHOM_LADDER)] if fathoms else [float(m) for m in METRE_LADDER]


def band(depth: Column, levels: list[float]) -> Column:
    """The number of ladder levels at or above a positive-down depth: 0 above the shoreline, then the band's place."""
    return sum((F.when(depth >= F.lit(level), 1).otherwise(0) for level in levels), F.lit(0))


def snap_safety(safety: Column, levels: list[float]) -> Column:
    """The next-deeper level of the ladder, with a centimetre of slack; else the last; 0 is off."""
    out = F.lit(levels[-1])
    for level in reversed(levels):
        out = F.when(F.lit(level) >= safety - F.lit(0.01), F.lit(level)).otherwise(out)
    return F.when(safety <= 0, F.lit(0.0)).otherwise(out)


def may_dry(kind: Column, water_class: Column, salt: Column, tidal: Column) -> Column:
    """Water that may hold drying ground: not a lake or reservoir, or a lagoon, or salt, or tidal unless said to be fresh."""
    unless_fresh = (tidal == "yes") & F.coalesce(salt, F.lit(True))
    parts = (~F.coalesce(kind, F.lit("")).isin("lake", "reservoir"), water_class == "lagoon", salt, unless_fresh)
    out = F.lit(False)
    for p in parts:
        out = out | F.coalesce(p, F.lit(False))
    return out


def ramp(x: Column, stops: list[tuple[float, float]]) -> Column:
    """Linear interpolation between stops, constant beyond them."""
    out = F.lit(stops[-1][1])
    for (a, va), (b, vb) in reversed(list(zip(stops, stops[1:]))):
        out = F.when(x < F.lit(b), F.lit(va) + (x - F.lit(a)) / F.lit(b - a) * F.lit(vb - va)).otherwise(out)
    return F.when(x < F.lit(stops[0][0]), F.lit(stops[0][1])).otherwise(out)
