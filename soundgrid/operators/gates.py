"""Quality gates: queries whose rows are what is wrong, or the figures that a limit holds against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.outlines import containing
from soundgrid.operators.partition import _cuts
from soundgrid.operators.polygons import RINGS, holes_of
from soundgrid.operators.quantiles import exact_quantiles
from soundgrid.operators.vectors import rasterize
from soundgrid.shipping import written


def shoal_bias(before: DataFrame, after: DataFrame, keys: list[str], slack: float = 1e-9) -> DataFrame:
    """Compared pixels and how many are deeper than before; there may be none."""
    b, a = before.select(*keys, F.col("z").alias("zb")), after.select(*keys, F.col("z").alias("za"))
    deeper = F.count(F.when((F.col("zb") < 0) & (F.col("za") < F.col("zb") - slack), 1))
    return b.join(a, keys).agg(F.count(F.when(F.col("zb") < 0, 1)).alias("compared"), deeper.alias("deeper"))


def coverage_report(pixels: DataFrame) -> DataFrame:
    """Of each source's files, which are corrected whole, in part or not at all, and the share of corrected pixels."""
    files = pixels.groupBy("source", "filename").agg(F.count("z").alias("valid"), F.count(F.when(F.col("z").isNotNull(), F.col("ref"))).alias("corrected"))
    share = F.sum("corrected") / F.sum("valid")
    full, none = F.col("corrected") == F.col("valid"), F.col("corrected") == 0
    return files.filter("valid > 0").groupBy("source").agg(F.count(F.when(full, 1)).alias("whole"), F.count(F.when(~full & ~none, 1)).alias("partial"), F.count(F.when(none, 1)).alias("uncovered"), share.alias("share"))


def presence(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys in both, in the first only and in the second only."""
    left, right = a.select(*key, F.lit(1).alias("_a")).distinct(), b.select(*key, F.lit(1).alias("_b")).distinct()
    both = left.join(right, key, "full_outer")
    return both.agg(F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)).alias("both"), F.count(F.when(F.col("_b").isNull(), 1)).alias("a_only"), F.count(F.when(F.col("_a").isNull(), 1)).alias("b_only"))


def completeness(expected: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    return expected.select(*key).distinct().join(found.select(*key), key, "left_anti")


def heal_schema(rows: DataFrame, numeric: list[str]) -> DataFrame:
    """Numeric columns that came as text as numbers again; what isn't a number becomes NULL."""
    return rows.withColumns({c: F.col(c).try_cast("double") for c in numeric})


def compare_runs(rows: DataFrame, a: str, b: str, order: str, limits: dict[str, float]) -> DataFrame:
    """``stage, stem, metric, was, now, change, verdict`` of two runs of ``rows(label, stage, stem, <order>, <metrics>)``, of which the last written counts.

    A relative change over the metric's limit has ``regressed``; a stage and stem that one run lacks has one row with ``missing`` and its label; what can't be compared (no value, or 0 before) has no row.
    """
    last = rows.filter(F.col("label").isin(a, b)).groupBy("stage", "stem", "label").agg(F.max_by(F.struct(*limits), F.col(order)).alias("m"))
    both = last.groupBy("stage", "stem").agg(*(F.max_by(F.when(F.col("label") == k, F.col("m")), F.col("label") == k).alias(n) for k, n in ((a, "was"), (b, "now"))), *(F.max(F.col("label") == k).alias(f"has_{n}") for k, n in ((a, "was"), (b, "now"))))
    whole = F.col("has_was") & F.col("has_now")
    each = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"was.{m}").cast("double").alias("was"), F.col(f"now.{m}").cast("double").alias("now"), F.lit(limit).alias("limit")) for m, limit in limits.items()))
    told = both.filter(whole).select("stage", "stem", F.explode(each).alias("e")).select("stage", "stem", "e.*").filter("now is not null and was <> 0")
    change = (F.col("now") - F.col("was")) / F.col("was")
    told = told.select("stage", "stem", "metric", "was", "now", change.alias("change"), F.when(change > F.col("limit"), "regressed").alias("verdict"))
    none = lambda kind: F.lit(None).cast(kind)
    gone = both.filter(~whole).select("stage", "stem", none("string").alias("metric"), *(none("double").alias(c) for c in ("was", "now", "change")), F.concat(F.lit("missing "), F.when(F.col("has_was"), b).otherwise(a)).alias("verdict"))
    return told.unionByName(gone)


def density(points: DataFrame, reach: float) -> DataFrame:
    """Spacing of points: exact quartiles of the distance to the nearest other one, and how many have none within reach."""
    from soundgrid.operators.near import nearest_neighbour

    near = written(points.select("id").join(nearest_neighbour(points, points, reach).select("id", "distance"), "id", "left"), "near")
    counts = near.agg(F.count(F.lit(1)).alias("points"), F.count(F.when(F.col("distance").isNull(), 1)).alias("alone")).withColumn("_one", F.lit(1))
    quartiles = exact_quantiles(near, [], "distance", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).withColumn("_one", F.lit(1))
    return counts.join(quartiles, "_one", "left").drop("_one")


def ab_terrain(pixels: DataFrame, tile: list[str], deep: float = -1000.0, most: float = 2.0, apart: float = 1.0) -> DataFrame:
    """One row for all tiles of ``pixels(tile, a, b)`` that both builds have: compared and deep ones, the median and 95th percentile of their mean differences, and whether the gate ``failed``.

    A tile is deep ocean if its mean in ``a`` is below ``deep``; there the 95th percentile may not be over ``most``. ``over`` is the greatest share of a tile's pixels that differ by over ``apart``.
    """
    d = F.abs(F.col("a") - F.col("b"))
    tiles = pixels.filter("a is not null and b is not null").groupBy(*tile).agg(F.avg(d).alias("mean_abs"), F.avg("a").alias("mean_depth"), (F.count(F.when(d > apart, 1)) / F.count(F.lit(1))).alias("share"))
    tiles = written(tiles.withColumn("deep", F.col("mean_depth") < deep), "tiles")
    q = exact_quantiles(tiles, ["deep"], "mean_abs", {"median": 0.5, "p95": 0.95}).groupBy().agg(*(F.coalesce(F.max(F.when(F.col("deep") == k, F.col(c))), F.lit(0.0)).alias(f"{n}_{c}") for k, n in ((True, "deep"), (False, "other")) for c in ("median", "p95")))
    counts = tiles.agg(F.count(F.lit(1)).alias("compared"), F.count(F.when(F.col("deep"), 1)).alias("deep"), F.coalesce(F.max("share"), F.lit(0.0)).alias("over"))
    met = counts.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return met.withColumn("failed", F.col("deep_p95") > most)


def bare_rings(rings: DataFrame, pixels: DataFrame, soundings: DataFrame, height: int, rise: float = 0.05) -> DataFrame:
    """``id, level, shoalest, bare`` of closed isobaths ``rings(id, level, ring)`` that enclose a shoal: ground in them rises over their level by more than ``rise``. ``bare`` ones have no sounding in them.

    The ground in a ring are the ``pixels(r, c, z)`` whose middles lie in it, by rows and crossings, whatever other rings lie there; ``soundings(x, y)`` are in pixels,
    and those that share a place are met as one.
    """
    inside = rasterize(rings.select("id", "ring"), height).join(pixels.filter("z < 0").select("r", "c", "z"), ["r", "c"]).groupBy("id").agg((-F.max("z")).alias("shoalest"))
    shoals = rings.select("id", "level").join(inside, "id").filter(F.col("shoalest") < F.col("level") - rise)
    points = soundings.select("x", "y").distinct().select(F.struct("x", "y").alias("id"), "x", "y")
    owned = containing(points, rings.join(shoals.select("id"), "id", "left_semi").select(F.col("id").alias("ring_id"), "ring"), [], 1.0).select(F.col("ring_id").alias("id")).distinct().withColumn("_has", F.lit(True))
    return shoals.join(owned, "id", "left").select("id", "level", "shoalest", F.col("_has").isNull().alias("bare"))


def residuals(stations: DataFrame, surface: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """Stations whose published value is off the surface by over the limit, or that it doesn't cover."""
    met = stations.join(surface.select(*keys, F.col("value").alias("_v")), keys, "left")
    off = F.abs(F.col("value") - F.col("_v"))
    return met.withColumn("residual", off).filter(off.isNull() | (off > limit)).drop("_v")


def expected_regions(found: DataFrame, expected: DataFrame, key: str, count: str, tolerance: float) -> DataFrame:
    """Regions that are missing, unexpected, or have a count off by over the tolerance."""
    both = found.select(key, F.col(count).alias("now")).join(expected.select(key, F.col(count).alias("due")), key, "full_outer")
    off = F.when(F.col("now").isNull(), "missing").when(F.col("due").isNull(), "unexpected").when(F.abs(F.col("now") - F.col("due")) > F.col("due") * tolerance, "count")
    return both.withColumn("wrong", off).filter("wrong is not null")


def contract(catalogs: DataFrame, required: list[str], recomputed: DataFrame, rasters: DataFrame) -> DataFrame:
    """``source, problem, detail`` of each source of ``catalogs(source, <required>, bbox, count)`` that breaks its contract.

    Required values may not be missing or blank; ``bbox`` and ``count`` must be those of ``recomputed(source, bbox, count)`` from its files; each file of ``rasters(source, filename, there, crs, nodata)`` must be
    there, with both set, unless it is served from elsewhere (``remote``).
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    lacks = F.filter(F.array(*(F.when(blank(c), F.lit(c)) for c in required)), lambda x: x.isNotNull())
    first = catalogs.select("source", F.lit("lacks").alias("problem"), F.array_join(lacks, ",").alias("detail")).filter("detail <> ''")
    met = catalogs.select("source", "bbox", "count").join(recomputed.select("source", F.col("bbox").alias("_bbox"), F.col("count").alias("_count")), "source", "left")
    box = met.filter(~F.col("bbox").eqNullSafe(F.col("_bbox"))).select("source", F.lit("bbox").alias("problem"), F.to_json("_bbox").alias("detail"))
    count = met.filter(~F.col("count").eqNullSafe(F.coalesce("_count", F.lit(0)))).select("source", F.lit("count").alias("problem"), F.coalesce("_count", F.lit(0)).cast("string").alias("detail"))
    wrong = F.when(~F.col("there"), "missing file").when(F.col("crs").isNull(), "no crs").when(F.col("nodata").isNull(), "no nodata")
    files = rasters.filter("not remote").select("source", wrong.alias("problem"), F.col("filename").alias("detail")).filter("problem is not null")
    return first.unionByName(box).unionByName(count).unionByName(files)


def water_gate(eligible: DataFrame, kept: DataFrame, probes: DataFrame, windows: DataFrame, margin: float) -> DataFrame:
    """``problem, id``: eligible features that a conversion dropped (``dropped``, an ``id`` of ``kept(id, ring, holes)`` or not), and required probes without water near (``dry``).

    ``probes(id, x, y, required)`` count where they lie in one of ``windows(west, south, east, north)``, a few boxes of what was read; they need a kept feature that shares some of
    the square of ``margin`` around them. Probes that aren't required are never a problem.
    """
    dropped = eligible.select("id").join(kept.select("id"), "id", "left_anti").select(F.lit("dropped").alias("problem"), "id")
    bins = lambda d, x0, x1: d.withColumn("_c", F.explode(F.sequence(F.floor(x0), F.floor(x1))))
    size = F.lit(margin * 64)
    asked = bins(probes.filter("required"), F.col("x") / size, F.col("x") / size)
    boxes = bins(windows, F.col("west") / size, F.col("east") / size)
    inside = asked.join(boxes, "_c").filter((F.col("x") >= F.col("west")) & (F.col("x") <= F.col("east")) & (F.col("y") >= F.col("south")) & (F.col("y") <= F.col("north"))).select("id", "x", "y").distinct()
    at = lambda dx, dy: F.struct((F.col("x") + dx * margin).alias("x"), (F.col("y") + dy * margin).alias("y"))
    squares = inside.select("id", F.array(at(-1, -1), at(1, -1), at(1, 1), at(-1, 1)).alias("ring"), F.array().cast(RINGS).alias("holes"))
    wet = _cuts(squares, kept.select("id", "ring", holes_of(kept).alias("holes")), [], margin * 64, False).select(F.col("low").alias("id")).distinct()
    return dropped.unionByName(inside.select("id").join(wet, "id", "left_anti").select(F.lit("dry").alias("problem"), "id"))


def connectivity(before: DataFrame, after: DataFrame, extent: tuple[int, int, int, int], most_drying: float = 16.0, slack: float = 1e-3) -> DataFrame:
    """One row: water pixels, 4-connected parts and the largest one's share before and after, how much of the water network ``grew`` dry, and what ``failed``.

    The network are the parts that touch the rim of ``extent`` (top, left, bottom, right), and the largest. Its pixels may not end between the datum and ``most_drying``; filled
    ponds may. A share of the largest part that falls by over ``slack`` means that a channel closed. ``failed`` is ``connectivity``, ``drying``, both with a comma between, or null.
    """
    from soundgrid.operators.labels import label_components

    def labelled(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        pixels = written(label_components(df.filter("z < 0")), "water")
        rim = (F.col("r") == extent[0]) | (F.col("c") == extent[1]) | (F.col("r") == extent[2]) | (F.col("c") == extent[3])
        return pixels, pixels.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(rim).alias("open"))

    def stats(parts: DataFrame, name: str) -> DataFrame:
        share = F.coalesce(F.max("n") / F.sum("n"), F.lit(0.0))
        return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"water_{name}"), F.count(F.lit(1)).alias(f"parts_{name}"), share.alias(f"share_{name}"), F.max(F.struct("n", -F.col("label"))).alias("top"))

    pixels, parts = labelled(before)
    was, now = stats(parts, "before"), stats(labelled(after)[1], "after").drop("top")
    top = was.select((-F.col("top.col2")).alias("label"))
    network = parts.filter("open").select("label").unionByName(top).distinct()
    dried = after.filter(F.col("z").between(0.0, most_drying)).select("r", "c")
    grew = pixels.join(network, "label", "left_semi").join(dried, ["r", "c"], "left_semi").agg(F.count(F.lit(1)).alias("grew"))
    # Each side has one row.
    one = lambda df: df.withColumn("_one", F.lit(1))
    row = one(was.drop("top")).join(one(now), "_one").join(one(grew), "_one").drop("_one")
    wrong = F.array(F.when(F.col("share_after") < F.col("share_before") - slack, "connectivity"), F.when(F.col("grew") > 0, "drying"))
    return row.withColumn("failed", F.nullif(F.array_join(wrong, ","), F.lit("")))


def ab_vector(a: DataFrame, b: DataFrame) -> DataFrame:
    """Of each layer of two tile sets (``z, x, y, layer, features``): tiles compared, mean and greatest relative change of its features, and whether ``b`` lacks it wholly.

    Tiles that only one set has aren't compared.
    """
    tile = ["z", "x", "y"]
    side = lambda d, n: d.groupBy(*tile, "layer").agg(F.sum("features").alias(n))
    common = a.select(*tile).distinct().join(b.select(*tile).distinct(), tile, "left_semi")
    met = side(a, "was").join(side(b, "now"), [*tile, "layer"], "full_outer").join(common, tile, "left_semi")
    was, now = F.coalesce("was", F.lit(0)), F.coalesce("now", F.lit(0))
    delta = F.abs(now - was) / F.greatest(was, F.lit(1))
    return met.groupBy("layer").agg(F.count(F.lit(1)).alias("compared"), F.avg(delta).alias("mean_delta"), F.max(delta).alias("max_delta"), ((F.count("now") == 0) & (F.count("was") > 0)).alias("absent"))


def admitted_by_floor(cells: DataFrame, floors: list[float]) -> DataFrame:
    """How many cells of ``depth`` each least depth admits, the shallowest of them, and how many more than the first one does. One pass."""
    numbered = cells.select("depth", F.posexplode(F.array(*(F.lit(float(f)) for f in floors))).alias("_k", "floor"))
    rows = numbered.groupBy("_k", "floor").agg(F.count(F.when(F.col("depth") >= F.col("floor"), 1)).alias("cells"), F.min(F.when(F.col("depth") >= F.col("floor"), F.col("depth"))).alias("shallowest"))
    first = rows.filter("_k = 0").select(F.col("cells").alias("_first"))
    return rows.crossJoin(first).select("floor", "cells", "shallowest", (F.col("cells") - F.col("_first")).alias("added"))
