"""Neighbourhoods of pixels in blocks with halos: a group holds one block's pixels and those around it, which bounds its memory."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from soundgrid.shipping import ship

#: Top, left, bottom and right of a raster, all of them in it.
Extent = tuple[int, int, int, int]


def by_block(pixels: DataFrame, values: list[str], result: str, halo: int, function: Callable[..., np.ndarray], extent: Extent | None = None, size: int = 512) -> DataFrame:
    """``pixels(r, c, ...)`` and the double column ``result`` that ``function`` finds for each of them.

    ``function`` gets one array of doubles for each of ``values``, NaN where a pixel or its value is missing, and gives one of the
    same shape. An array holds a block of ``size`` by ``size`` pixels and ``halo`` pixels around it, but nothing beyond ``extent``;
    of the result only the block counts, so what is wrong near the halo's outer edge doesn't matter. A pixel is sent to the
    blocks whose halo it is in, four of them at most where ``size`` is twice ``halo`` or more. A NaN found is null.
    """
    span = lambda v: F.explode(F.sequence(F.floor((F.col(v) - halo) / size), F.floor((F.col(v) + halo) / size)))
    own = [c for c in pixels.columns if c != result]
    sent = pixels.select(*own).withColumn("_br", span("r")).withColumn("_bc", span("c"))
    ship(pixels.sparkSession)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        top, left = (int(k.as_py()) * size - halo for k in key)
        bottom, right = top + size + 2 * halo - 1, left + size + 2 * halo - 1
        if extent:
            top, left, bottom, right = max(top, extent[0]), max(left, extent[1]), min(bottom, extent[2]), min(right, extent[3])
        r, c = (table.column(v).to_numpy().astype(np.int64) for v in ("r", "c"))
        arrays = []
        for v in values:
            a = np.full((bottom - top + 1, right - left + 1), np.nan)
            a[r - top, c - left] = table.column(v).cast(pa.float64()).to_numpy()
            arrays.append(a)
        core = (r // size == int(key[0].as_py())) & (c // size == int(key[1].as_py()))
        if not core.any():
            return table.slice(0, 0).drop_columns(["_br", "_bc"]).append_column(result, pa.array([], pa.float64()))
        found = function(*arrays)[r[core] - top, c[core] - left]
        return table.drop_columns(["_br", "_bc"]).filter(pa.array(core)).append_column(result, pa.array(found, pa.float64(), from_pandas=True))

    schema = StructType([*pixels.select(*own).schema.fields, StructField(result, DoubleType())])
    return sent.groupBy("_br", "_bc").applyInArrow(run, schema)


def reach_of(sigma: float, truncate: float = 4.0) -> int:
    return int(truncate * sigma + 0.5)


def blurred(a: np.ndarray, sigma: float, mode: str = "constant") -> np.ndarray:
    """Separable Gaussian of an array, cut at four deviations; beyond the array are zeros, or what ``numpy.pad`` makes of it by ``mode``."""
    reach = reach_of(sigma)
    taps = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    taps /= taps.sum()
    for axis in (0, 1):
        wide = np.pad(a, [(reach, reach) if k == axis else (0, 0) for k in (0, 1)], mode=mode)
        n = a.shape[axis]
        a = sum(w * (wide[k : k + n] if axis == 0 else wide[:, k : k + n]) for k, w in enumerate(taps))
    return a


def nearest_source(valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each pixel the squared distance to the nearest valid one within ``radius`` (or a number above its square), and that one's flat place.

    Of equally near ones the first in row order. Down the columns first, then along the rows: 4 ``radius`` steps, not its square.
    """
    n, m = valid.shape
    rows = np.arange(n)[:, None]
    far = np.int64(4 * (n + m + radius) ** 2)
    down = np.full((n, m), -far)
    last = np.maximum.accumulate(np.where(valid, rows, -far), axis=0)
    ahead = np.minimum.accumulate(np.where(valid, rows, far)[::-1], axis=0)[::-1]
    down = np.where(rows - last <= ahead - rows, last, ahead)
    d2 = np.minimum((down - rows) ** 2, far)
    place = np.where((down >= 0) & (down < n), down, 0) * m + np.arange(m)[None, :]
    best = np.full((n, m), np.iinfo(np.int64).max)
    scale = np.int64(n * m)
    for dx in range(-radius, radius + 1):
        a, b = max(0, -dx), min(m, m - dx)
        if a < b:
            key = (d2[:, a + dx : b + dx] + dx * dx) * scale + place[:, a + dx : b + dx]
            best[:, a:b] = np.minimum(best[:, a:b], key)
    return best // scale, best % scale
