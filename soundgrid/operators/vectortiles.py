"""Content of vector tiles: clipping on whole numbers, overzoomed tiles, tiling from features, payloads.

A tile's features are rows ``z, x, y, layer, id, kind, parts, properties``: ``kind`` is 1 for points, 2 for lines, 3 for rings; ``parts`` are arrays of points in whole units of the
tile's ``extent`` (rings don't repeat their first point); ``properties`` maps names to JSON scalars. The world is 2^32 units wide, y points down.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.vectors import feature_tiles
from soundgrid.shipping import mapped, ship

POINT, LINE, RING = 1, 2, 3
PARTS = "array<array<struct<x: long, y: long>>>"
FEATURE = f"layer string, id long, kind int, parts {PARTS}, properties map<string, string>"
_PROPERTIES = pa.map_(pa.string(), pa.string())

Point = tuple[float, float]


def quotient(a: int, b: int) -> int:
    """Whole part of a fraction, towards zero."""
    q = abs(a) // abs(b)
    return q if (a < 0) == (b < 0) else -q


def nearest(v: float) -> int:
    """The nearest whole number, halves away from zero."""
    return int(v + 0.5) if v >= 0 else -int(-v + 0.5)


def cut_segment(p: Point, q: Point, low: int, high: int) -> tuple[Point, Point] | None:
    """The part of a segment in a square, ends on its sides in whole numbers; None if nothing is.

    The first end that is outside moves to a side that it is beyond: the lower one (greatest y) first, then the upper, the right, the left.
    """
    ends = [p, q]
    while True:
        beyond = [(y > high, y < low, x > high, x < low) for x, y in ends]
        if any(a and b for a, b in zip(*beyond)):
            return None
        outside = [i for i in (0, 1) if any(beyond[i])]
        if not outside:
            return ends[0], ends[1]
        i = outside[0]
        (x0, y0), (x1, y1) = ends
        if beyond[i][0] or beyond[i][1]:
            side = high if beyond[i][0] else low
            ends[i] = (x0 + quotient((x1 - x0) * (side - y0), y1 - y0), side)
        else:
            side = high if beyond[i][2] else low
            ends[i] = (side, y0 + quotient((y1 - y0) * (side - x0), x1 - x0))


def cut_line(line: list[Point], low: int, high: int) -> list[list[Point]]:
    """The stretches of a line in a square; one ends where the line leaves it."""
    out: list[list[Point]] = []
    for p, q in zip(line, line[1:]):
        kept = cut_segment(p, q, low, high)
        if kept is None:
            continue
        if out and out[-1][-1] == kept[0] == p:
            out[-1].append(kept[1])
        else:
            out.append(list(kept))
    return out


def cut_ring(ring: list[Point], low: int, high: int) -> list[Point]:
    """A ring cut to a square, side after side from the upper one on; points on a side count as outside."""
    for axis, side, sign in ((1, low, 1), (0, high, -1), (1, high, -1), (0, low, 1)):
        kept: list[Point] = []
        for p, q in zip([ring[-1], *ring] if ring else [], ring):
            was, now = ((v[axis] - side) * sign > 0 for v in (p, q))
            if was != now:
                other = p[1 - axis] + (q[1 - axis] - p[1 - axis]) * (side - p[axis]) / (q[axis] - p[axis])
                kept.append((side, other) if axis == 0 else (other, side))
            if now:
                kept.append(q)
        ring = kept
    return ring


def double_area(ring: list[Point]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], *ring[:1]]))


def into_tile(kind: int, parts: list[list[Point]], z: int, x: int, y: int, extent: int = 4096, buffer: int = 5) -> list[list[Point]]:
    """A feature's parts in world units as they are in a tile: cut to the tile with ``buffer`` 256ths around it, scaled to ``extent``, rounded, without what that leaves nothing of.

    Steps of no length go, and lines of one point, rings of fewer than three points and rings without area; stretches that meet again after rounding are one.
    """
    size = 1 << (32 - z)
    margin = buffer * size // 256
    low, high = -margin, size + margin
    scale = lambda v: nearest(v * extent / size)
    out: list[list[Point]] = []
    for part in parts:
        own = [(px - x * size, py - y * size) for px, py in part]
        if not own or max(p[0] for p in own) < low or max(p[1] for p in own) < low or min(p[0] for p in own) > high or min(p[1] for p in own) > high:
            continue
        if kind == POINT:
            out += [[(scale(px), scale(py))] for px, py in own if low <= px <= high and low <= py <= high]
            continue
        stretches = cut_line(own, low, high) if kind == LINE else [[(nearest(a), nearest(b)) for a, b in cut_ring(own, low, high)]]
        start = len(out)
        for stretch in stretches:
            steps: list[Point] = []
            for p in ((scale(a), scale(b)) for a, b in stretch):
                if not steps or p != steps[-1]:
                    steps.append(p)
            if kind == RING:
                if len(steps) > 1 and steps[0] == steps[-1]:
                    steps.pop()
                if len(steps) > 2 and double_area(steps) != 0:
                    out.append(steps)
            elif len(steps) > 1:
                if len(out) > start and out[-1][-1] == steps[0]:
                    out[-1] += steps[1:]
                else:
                    out.append(steps)
    return out


def _read_parts(column: pa.ListArray) -> list[list[list[Point]]]:
    """Each row's parts as lists of pairs; null ones are empty."""
    lengths = lambda c: np.nan_to_num(c.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    inner = column.flatten()
    points = list(zip(*(v.to_pylist() for v in inner.flatten().flatten())))
    cut = lambda rows, counts: [rows[stop - n : stop] for n, stop in zip(counts.tolist(), np.cumsum(counts).tolist())]
    return cut(cut(points, lengths(inner)), lengths(column))


def _parts_array(rows: list[list[list[Point]]]) -> pa.ListArray:
    """Rows' parts as an array column."""
    parts = [part for row in rows for part in row]
    points = [p for part in parts for p in part]
    bounds = lambda groups: pa.array(np.cumsum([0, *map(len, groups)]), pa.int32())
    flat = pa.StructArray.from_arrays([pa.array([p[k] for p in points], pa.int64()) for k in (0, 1)], ["x", "y"])
    return pa.ListArray.from_arrays(bounds(rows), pa.ListArray.from_arrays(bounds(parts), flat))


def _placed(features: DataFrame, keep: list[str], extent: int, buffer: int) -> DataFrame:
    """``features(keep, z, x, y, kind, parts)`` with parts in world units, as they are in their tile; features of which nothing is left go."""
    names = [*keep, "z", "x", "y", "kind", "parts"]
    read = features.select(*keep, F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col("kind").cast("int").alias("kind"), F.col("parts").cast(PARTS).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, z, x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("kind", "z", "x", "y"))
            found = [into_tile(*row, extent, buffer) for row in zip(kind, _read_parts(batch.column(len(names) - 1)), z, x, y)]
            there = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            parts = _parts_array([f for f in found if f])
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(there) for k in range(len(names) - 1)), parts], names)

    return mapped(read, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields))


def overzoomed(features: DataFrame, requests: DataFrame, extent: int = 4096, buffer: int = 5) -> DataFrame:
    """The features of tiles that aren't baked: ``requests(z, x, y, found_z)`` get those of their ancestor at ``found_z``.

    ``features`` are decoded tiles, of one archive or several (their features of one layer stand together), with their own ``extent`` if they have such a column. Requests meet their
    ancestor's features by equality.
    """
    of = features.withColumn("_extent", F.col("extent") if "extent" in features.columns else F.lit(4096))
    shift = F.col("z") - F.col("found_z")
    up = lambda v: F.call_function("shiftright", F.col(v).cast("long"), shift)
    asked = requests.select("z", "x", "y", F.col("found_z").alias("_z"), up("x").alias("_x"), up("y").alias("_y"))
    own = of.select(F.col("z").cast("int").alias("_z"), F.col("x").cast("long").alias("_x"), F.col("y").cast("long").alias("_y"), "layer", "id", "kind", "parts", "properties", "_extent")
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(32) - F.col("_z"))
    # Whole part towards zero, as coordinates in the margin are negative.
    world = lambda v, t: (F.signum(v) * F.floor(F.abs(v) * size / F.col("_extent"))).cast("long") + F.col(t) * size
    parts = F.transform("parts", lambda part: F.transform(part, lambda p: F.struct(world(p["x"], "_x").alias("x"), world(p["y"], "_y").alias("y"))))
    met = asked.join(own, ["_z", "_x", "_y"]).withColumn("parts", parts)
    return _placed(met, ["layer", "id", "properties"], extent, buffer)


def tiled(features: DataFrame, maxzoom: int, extent: int = 4096, buffer: int = 5) -> DataFrame:
    """The content of all tiles up to ``maxzoom`` from ``features(layer, id, kind, parts, properties, minzoom, lastzoom)``, whose parts are in units of the world's width (0 to 1).

    A feature is in the tiles that its box meets with the buffer around, from ``minzoom`` on (to ``lastzoom``, if it isn't null), cut to each; nothing is dropped for a tile's size.
    """
    ends = lambda f, k: f(F.flatten(F.transform("parts", lambda part: F.transform(part, lambda p: p[k]))))
    room = F.lit(buffer / 256.0)
    boxed = features.filter(F.size(F.flatten("parts")) > 0).withColumns({f"{k}{i}": ends(f, k) for k in "xy" for i, f in ((0, F.array_min), (1, F.array_max))})
    # The margin is widest, in units of the world, at the first zoom.
    wide = room / F.pow(F.lit(2.0), F.col("minzoom").cast("double"))
    boxed = boxed.withColumns({c: F.col(c) + (wide if c[1] == "1" else -wide) for c in ("x0", "x1", "y0", "y1")})
    world = F.transform("parts", lambda part: F.transform(part, lambda p: F.struct(F.round(p["x"] * float(1 << 32)).cast("long").alias("x"), F.round(p["y"] * float(1 << 32)).cast("long").alias("y"))))
    numbered = boxed.withColumn("id", F.col("id").cast("long")).select("id", "layer", "minzoom", "lastzoom", "x0", "x1", "y0", "y1", "kind", world.alias("parts"), "properties")
    numbered = _spread(numbered).withColumns({f"_{k}{i}": ends(f, k) for k in "xy" for i, f in ((0, F.array_min), (1, F.array_max))})
    met = feature_tiles(numbered, maxzoom, ["layer", "kind", "parts", "properties", "_x0", "_x1", "_y0", "_y1"])
    # As that margin is wider than a later zoom's, what lies beyond this one's is left out here.
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(32) - F.col("z"))
    margin = F.floor(size * buffer / 256)
    near = lambda k: (F.col(f"_{k}1") - F.col(k) * size >= -margin) & (F.col(f"_{k}0") - F.col(k) * size <= size + margin)
    met = met.filter(near("x") & near("y"))
    return _placed(met, ["layer", "id", "properties"], extent, buffer)


def coalesced(features: DataFrame) -> DataFrame:
    """Features of one tile, layer and kind with equal properties as one, with all parts and the least id."""
    entries = F.array_sort(F.map_entries("properties"))
    merged = features.groupBy("z", "x", "y", "layer", "kind", entries.alias("_entries")).agg(F.min("id").alias("id"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("id", "parts"))), lambda s: s["parts"])).alias("parts"))
    return merged.select("z", "x", "y", "layer", "id", "kind", "parts", F.map_from_entries("_entries").alias("properties"))


# Payloads: messages of numbered fields, numbers as base-128 digits.


def digits(n: int) -> bytes:
    """A number from 0 on in groups of seven bits, least first; all but the last have the high bit."""
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return digits(number << 3) + digits(value)
    return digits(number << 3 | 2) + digits(len(value)) + value


def folded(n: int) -> int:
    """Signed numbers as 0, -1, 1, -2, ... are 0, 1, 2, 3, ..."""
    return 2 * n if n >= 0 else -2 * n - 1


def unfolded(n: int) -> int:
    return n // 2 if n % 2 == 0 else -(n // 2) - 1


def commands(kind: int, parts: list[list[Point]]) -> list[int]:
    """Moves (1), lines (2) and closings (7) with their counts, and steps from point to point."""
    out: list[int] = []
    at = (0, 0)

    def steps(points: list[Point]) -> list[int]:
        nonlocal at
        told = []
        for p in points:
            told += [folded(p[0] - at[0]), folded(p[1] - at[1])]
            at = p
        return told

    if kind == POINT:
        points = [p for part in parts for p in part]
        return [1 | len(points) << 3, *steps(points)] if points else []
    for part in parts:
        out += [1 | 1 << 3, *steps(part[:1]), 2 | (len(part) - 1) << 3, *steps(part[1:])]
        if kind == RING:
            out.append(7 | 1 << 3)
    return out


def geometry(kind: int, numbers: list[int]) -> list[list[Point]]:
    """The parts that commands draw."""
    parts: list[list[Point]] = []
    x = y = i = 0
    while i < len(numbers):
        what, count = numbers[i] & 7, numbers[i] >> 3
        i += 1
        if what == 7:
            continue
        for _ in range(count):
            x, y = x + unfolded(numbers[i]), y + unfolded(numbers[i + 1])
            i += 2
            if what == 1:
                parts.append([(x, y)])
            else:
                parts[-1].append((x, y))
    return parts


def encoded_value(text: str) -> bytes:
    value = json.loads(text)
    if isinstance(value, bool):
        return field(7, int(value))
    if isinstance(value, int):
        return field(6, folded(value))
    if isinstance(value, float):
        return digits(3 << 3 | 1) + struct.pack("<d", value)
    return field(1, str(value).encode())


def encoded_tags(properties: list[tuple[str, str]] | None) -> bytes:
    """Names and values that aren't null, by name, before they have their places in a layer's lists."""
    return b"".join(field(1, key.encode()) + field(2, encoded_value(value)) for key, value in sorted(p for p in properties or [] if p[1] is not None))


def encoded_layer(name: str, features: Iterator[tuple[int | None, int, bytes, bytes]], extent: int) -> list[bytes]:
    """The pieces of a layer of ``id, kind, commands, tags``: its features refer to names and values by their place in the layer's own lists."""
    names: dict[bytes, int] = {}
    values: dict[bytes, int] = {}
    known: dict[bytes, bytes] = {}
    body = bytearray()
    for number, kind, drawn, own in features:
        tags = known.get(own)
        if tags is None:
            told = [bytes(v) for _, v in _fields(own)]
            tags = b"".join(digits(names.setdefault(k, len(names))) + digits(values.setdefault(v, len(values))) for k, v in zip(told[::2], told[1::2]))
            tags = field(2, tags) if tags else b""
            if len(known) < 1 << 16:
                known[own] = tags
        body += field(2, (field(1, number) if number is not None else b"") + tags + field(3, kind) + field(4, drawn))
    return [field(1, name.encode()), body, *(field(3, k) for k in names), *(field(4, v) for v in values), field(5, extent) + field(15, 2)]


def _placed_fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """Fields with the place at which they end."""
    i, n = 0, len(data)

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, i

    while i < n:
        key, i = (data[i], i + 1) if data[i] < 128 else number(i)
        if key & 7 == 0:
            value, i = number(i)
            yield i, key >> 3, value
            continue
        if key & 7 == 2:
            size, i = (data[i], i + 1) if data[i] < 128 else number(i)
        else:
            size = 8 if key & 7 == 1 else 4
        yield i + size, key >> 3, data[i : i + size]
        i += size


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    return ((number, value) for _, number, value in _placed_fields(data))


def _numbers(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for byte in data:
        n |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            out.append(n)
            n = shift = 0
    return out


def decoded_value(data: bytes) -> str:
    for number, value in _fields(data):
        if number == 1:
            return json.dumps(value.decode(), ensure_ascii=False)
        if number in (2, 3):
            return json.dumps(struct.unpack("<f" if number == 2 else "<d", value)[0])
        if number == 7:
            return "true" if value else "false"
        signed = unfolded(value) if number == 6 else value - (1 << 64) if number == 4 and value >> 63 else value
        return str(signed)
    return "null"


def stretches(payload: bytes, most: int = 4096) -> Iterator[tuple[str, int, list[str], list[str], bytes]]:
    """A payload's layers in stretches of about ``most`` features: ``layer, extent, names, values, features``.

    A stretch has all of its layer's names and values, and no fewer features than these (but for the last one), so that all stretches together are no more than some times the payload.
    """
    for number, layer in _fields(memoryview(payload).cast("B")):
        if number != 3:
            continue
        texts: dict[int, list] = {1: [], 3: [], 4: [], 5: []}
        bounds, n, at = [0], 0, 0
        for at, number, value in _placed_fields(layer):
            if number == 2:
                n += 1
                if n % most == 0:
                    bounds.append(at)
            elif number in texts:
                texts[number].append(value)
        name = bytes(texts[1][0]).decode() if texts[1] else ""
        names, values = [bytes(v).decode() for v in texts[3]], [decoded_value(bytes(v)) for v in texts[4]]
        bounds = bounds[:: max(1, -(-(len(names) + len(values)) // most))]
        for start, stop in zip(bounds, [*bounds[1:], len(layer)]):
            yield name, texts[5][0] if texts[5] else 4096, names, values, layer[start:stop]


def features_of(stretch: bytes, names: list[str], values: list[str]) -> Iterator[tuple]:
    """``id, kind, parts, properties`` of a stretch's features."""
    for number, feature in _fields(stretch):
        if number == 2:
            own = dict(_fields(feature))
            tags, kind = _numbers(own.get(2, b"")), own.get(3, 0)
            yield own.get(1), kind, geometry(kind, _numbers(own.get(4, b""))), [(names[k], values[v]) for k, v in zip(tags[::2], tags[1::2])]


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly, to a few tasks a core: a small file may be one task's, and what is made of it far more."""
    spark = df.sparkSession
    return df.repartition(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def _slices(column: pa.ChunkedArray) -> tuple[np.ndarray, memoryview]:
    """Where each value of a binary column starts and ends, and all bytes."""
    whole = pa.concat_arrays(column.cast(pa.large_binary()).chunks) if column.num_chunks else pa.array([], pa.large_binary())
    _, offsets, data = whole.buffers()
    return np.frombuffer(offsets, np.int64, len(whole) + 1, whole.offset * 8), memoryview(data or b"")


def packed(features: DataFrame, extent: int = 4096) -> DataFrame:
    """``z, x, y, payload``: each tile's features as one payload, layers by name, features by id and then by kind and what they draw.

    Features are encoded where they are; a tile is a group of what they are encoded to, put in order and together.
    """
    ship(features.sparkSession)
    names = ["z", "x", "y", "layer", "id", "kind", "drawn", "tags"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, properties = batch.column(5).to_pylist(), batch.column(7).to_pylist()
            drawn = [b"".join(map(digits, commands(k, p))) for k, p in zip(kinds, _read_parts(batch.column(6)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(6)), pa.array(drawn, pa.binary()), pa.array(map(encoded_tags, properties), pa.binary())], names)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        layers = table.column("layer").combine_chunks().dictionary_encode()
        layers = layers.combine_chunks() if isinstance(layers, pa.ChunkedArray) else layers
        told = layers.dictionary.to_pylist()
        rank = np.argsort(sorted(range(len(told)), key=told.__getitem__))[layers.indices.to_numpy()]
        absent = table.column("id").is_null().to_numpy()
        ids, kinds = (table.column(c).fill_null(0).to_numpy() for c in ("id", "kind"))
        order = np.lexsort((kinds, ids, absent, rank))
        (at, drawn), (own, tags) = (_slices(table.column(c)) for c in ("drawn", "tags"))
        keys = np.stack([v[order] for v in (rank, absent, ids, kinds)])
        starts = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))), len(order))
        for k in np.flatnonzero(np.diff(starts) > 1):
            run = order[starts[k] : starts[k + 1]].tolist()
            order[starts[k] : starts[k + 1]] = sorted(run, key=lambda i: (bytes(drawn[at[i] : at[i + 1]]), bytes(tags[own[i] : own[i + 1]])))
        bounds = np.append(np.flatnonzero(np.append(True, keys[0, 1:] != keys[0, :-1])), len(order))

        def rows(run: np.ndarray) -> Iterator[tuple]:
            for part in np.array_split(run, len(run) // 8192 + 1):
                for i, none, number, kind, a, b, c, d in zip(*(v.tolist() for v in (part, absent[part], ids[part], kinds[part], at[part], at[part + 1], own[part], own[part + 1]))):
                    yield None if none else number, kind, bytes(drawn[a:b]), bytes(tags[c:d])

        pieces = []
        for start, stop in zip(bounds, bounds[1:]):
            layer = encoded_layer(told[int(layers.indices[int(order[start])].as_py())], rows(order[start:stop]), extent)
            pieces += [digits(3 << 3 | 2) + digits(sum(map(len, layer))), *layer]
        z, x, y = (k.as_py() for k in key)
        return pa.table([pa.array([z], pa.int32()), pa.array([x], pa.int64()), pa.array([y], pa.int64()), pa.array([b"".join(pieces)], pa.binary())], ["z", "x", "y", "payload"])

    rows = features.select(F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "layer", F.col("id").cast("long").alias("id"), F.col("kind").cast("int").alias("kind"), F.col("parts").cast(PARTS).alias("parts"), "properties")
    encoded = mapped(_spread(rows), encode, "z int, x long, y long, layer string, id long, kind int, drawn binary, tags binary")
    return encoded.groupBy("z", "x", "y").applyInArrow(run, "z int, x long, y long, payload binary")


def unpacked(tiles: DataFrame) -> DataFrame:
    """The features of ``tiles(z, x, y, payload)``, a row each, with their layer's ``extent``. Null and empty payloads have none.

    A payload is cut into stretches of features where it is, and these are dealt evenly and read, so that no task reads or holds all features of a large tile.
    """
    read = tiles.select(F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "payload")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        for batch in batches:
            for i, payload in enumerate(batch.column(3)):
                for layer, extent, names, values, stretch in stretches(payload.as_buffer() if payload.is_valid else b""):
                    own = [pa.array([v], k) for v, k in ((layer, pa.string()), (extent, pa.int32()), (names, texts), (values, texts), (bytes(stretch), pa.binary()))]
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, 1) for k in range(3)), *own], ["z", "x", "y", "layer", "extent", "names", "values", "stretch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names, values, stretch = (batch.column(k)[i].as_py() for k in (5, 6, 7))
                number, kind, parts, properties = list(zip(*features_of(stretch, names, values))) or [()] * 4
                at = pa.array(np.full(len(number), i))
                told = [pa.array(number, pa.int64()), pa.array(kind, pa.int32()), _parts_array(parts), pa.array(properties, _PROPERTIES)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(5)), *told], ["z", "x", "y", "layer", "extent", "id", "kind", "parts", "properties"])

    cut = mapped(read, split, "z int, x long, y long, layer string, extent int, names array<string>, values array<string>, stretch binary")
    return mapped(_spread(cut), run, f"z int, x long, y long, layer string, extent int, id long, kind int, parts {PARTS}, properties map<string, string>")
