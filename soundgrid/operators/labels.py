"""Connected components of pixels, and what hangs on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.operators.graph import components
from soundgrid.shipping import written


def label_components(pixels: DataFrame, diagonal: bool = False, stretch: int = 1024) -> DataFrame:
    """``r, c, label`` of ``pixels(r, c)``: pixels joined over sides (or corners, too) have one label, the place of their first pixel.

    Runs of neighbours in a row are found by a window and are the nodes; runs of two rows that touch are the edges. Labels
    spread along edges by alternating large and small stars, a grouping and a join each, in a number of rounds that grows with
    the logarithm of the runs. No row of pixels is ever gathered.
    """
    # A long row is cut into stretches, so that one task's window is short; a stretch's ends are edges, too.
    row = Window.partitionBy("r", "stretch").orderBy("c")
    cut = pixels.select("r", "c").distinct().withColumn("stretch", F.floor(F.col("c") / stretch))
    new = (F.lag("c").over(row).isNull() | (F.lag("c").over(row) < F.col("c") - 1)).cast("int")
    runs = cut.withColumn("new", new).withColumn("k", F.sum("new").over(row))
    first = F.min("c").over(Window.partitionBy("r", "stretch", "k"))
    owned = written(runs.withColumn("start", first).select("r", "c", (F.col("r").cast("long") * (1 << 32) + F.col("start")).alias("node")), "runs")
    reach = (-1, 0, 1) if diagonal else (0,)
    up = owned.select((F.col("r") + 1).alias("r"), F.explode(F.array(*(F.col("c") + d for d in reach))).alias("c"), F.col("node").alias("b"))
    side = owned.select("r", (F.col("c") + 1).alias("c"), F.col("node").alias("b"))
    edges = owned.join(up.unionByName(side), ["r", "c"]).filter("node <> b").select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    labels = components(edges)
    return owned.join(labels, "node", "left").select("r", "c", F.coalesce("label", "node").alias("label"))


def component_stats(labelled: DataFrame, value: str = "z") -> DataFrame:
    """Size, extent and least and greatest value of each component."""
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("pixels"), F.min("r").alias("top"), F.max("r").alias("bottom"), F.min("c").alias("left"), F.max("c").alias("right"), F.min(value).alias("low"), F.max(value).alias("high"))


def _rim(labelled: DataFrame) -> DataFrame:
    """The 8-neighbours of each component that aren't in it: ``label, r, c``."""
    around = F.explode(F.array(*(F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c")) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if dr or dc)))
    near = labelled.select("label", around.alias("p")).select("label", "p.r", "p.c").distinct()
    return near.join(labelled.select("label", "r", "c"), ["label", "r", "c"], "left_anti")


def pond_fill(pixels: DataFrame, most_pixels: int, most_diagonal: float, lowest: float = -2.0) -> DataFrame:
    """Fill small, shallow water that ground encloses with the lowest level that closes it: its rim's greatest value.

    A pond is an 8-connected patch of water of at most ``most_pixels``, with a bounding box of at most ``most_diagonal`` pixels across, nowhere below ``lowest``, whose rim
    has no missing pixel. Water only gets shallower.
    """
    labelled = label_components(pixels.filter("z < 0"), diagonal=True).join(pixels, ["r", "c"])
    high, wide = F.col("bottom") - F.col("top") + 1, F.col("right") - F.col("left") + 1
    small = component_stats(labelled).filter((F.col("pixels") <= most_pixels) & (high * high + wide * wide <= most_diagonal**2) & (F.col("low") >= lowest))
    rim = _rim(labelled.join(small.select("label"), "label", "left_semi")).join(pixels, ["r", "c"], "left").groupBy("label")
    closed = rim.agg(F.count(F.lit(1)).alias("n"), F.count("z").alias("valid"), F.max("z").alias("fill")).filter("n = valid")
    filled = labelled.join(closed, "label").select("r", "c", F.col("fill").alias("_fill"))
    return pixels.join(filled, ["r", "c"], "left").withColumn("z", F.greatest("z", "_fill")).drop("_fill")


def enclosed_shoals(pixels: DataFrame, levels: list[float], edge: Column) -> DataFrame:
    """For each level, the shallowest pixel of each 4-connected patch shallower than it that doesn't touch ``edge`` or a missing pixel.

    A pixel found at several levels counts once, with the least level. All levels are labelled at once, each on a storey of its own.
    """
    valid = written(pixels.filter("z is not null").select("r", "c", "z", edge.cast("int").alias("edge")), "surface")
    ends = valid.agg(F.min("r"), F.max("r")).first()
    height = (ends[1] or 0) - (ends[0] or 0) + 2
    over = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(v)).alias("level")) for k, v in enumerate(levels))))
    stacked = valid.filter("z < 0").withColumn("s", over).filter(F.col("z") > -F.col("s.level")).select((F.col("r") + F.col("s.k") * height).alias("r"), "c", "s.level", F.col("r").alias("own_r"), "z", "edge")
    labelled = label_components(stacked.select("r", "c")).join(stacked, ["r", "c"])
    inside = labelled.groupBy("label", "level").agg(F.max(F.struct("z", (-F.col("own_r")).alias("nr"), (-F.col("c")).alias("nc"))).alias("b"), F.max("edge").alias("open")).filter("open = 0")
    return inside.groupBy((-F.col("b.nr")).alias("r"), (-F.col("b.nc")).alias("c"), (-F.col("b.z")).alias("depth")).agg(F.min("level").alias("level"))


def dome_candidates(pixels: DataFrame, most_span: int, ring: int, extent: tuple[int, int, int, int], deep: float = -8.0) -> DataFrame:
    """Small 8-connected patches at or above the datum with deep water all around: lone rocks, or cones of an interpolation.

    The bounding box is ``most_span`` pixels wide and high at most, and of the frame ``ring`` pixels around it half is valid at least
    and nothing shallower than ``deep``. A patch whose frame leaves the raster's ``extent`` isn't judged.
    """
    labelled = label_components(pixels.filter("z >= 0"), diagonal=True).join(pixels, ["r", "c"])
    boxes = component_stats(labelled).filter((F.col("bottom") - F.col("top") < most_span) & (F.col("right") - F.col("left") < most_span))
    boxes = boxes.select("label", "pixels", "high", (F.col("top") - ring).alias("r0"), (F.col("bottom") + ring).alias("r1"), (F.col("left") - ring).alias("c0"), (F.col("right") + ring).alias("c1"))
    boxes = boxes.filter((F.col("r0") >= extent[0]) & (F.col("c0") >= extent[1]) & (F.col("r1") <= extent[2]) & (F.col("c1") <= extent[3]))
    line = lambda r, c: F.struct(r.alias("r"), c.alias("c"))
    across = F.transform(F.sequence("c0", "c1"), lambda c: F.array(line(F.col("r0"), c), line(F.col("r1"), c)))
    along = F.transform(F.sequence(F.col("r0") + 1, F.col("r1") - 1), lambda r: F.array(line(r, F.col("c0")), line(r, F.col("c1"))))
    frame = boxes.select("label", F.explode(F.flatten(F.concat(across, along))).alias("p")).select("label", "p.r", "p.c").join(pixels, ["r", "c"], "left")
    rim = frame.groupBy("label").agg(F.max("z").alias("rim_high"), F.count("z").alias("valid"), F.count(F.lit(1)).alias("n"))
    return boxes.join(rim.filter((F.col("rim_high") <= deep) & (F.col("valid") * 2 >= F.col("n"))), "label").select("label", "pixels", "high", "rim_high")


def flood_component(pixels: DataFrame, seeds: DataFrame, diagonal: bool = False) -> DataFrame:
    """The pixels of each seed's component: ``seed, r, c`` for ``seeds(seed, r, c)`` that lie in one."""
    labelled = label_components(pixels, diagonal)
    owners = seeds.join(labelled, ["r", "c"]).select("seed", "label")
    return owners.join(labelled, "label").select("seed", "r", "c")


def resolve_seeds(pixels: DataFrame, seeds: DataFrame, reach: int = 6) -> DataFrame:
    """Each seed's nearest pixel within ``reach``, first in row order, and its component; seeds of one component share its label."""
    from soundgrid.operators.focal import disc

    taps = F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(dr * dr + dc * dc).alias("d2")) for dr, dc, _ in disc(reach))))
    sent = seeds.withColumn("t", taps).select("seed", (F.col("r") + F.col("t.dr")).alias("r"), (F.col("c") + F.col("t.dc")).alias("c"), F.col("t.d2").alias("d2"))
    near = sent.join(label_components(pixels), ["r", "c"]).groupBy("seed").agg(F.min(F.struct("d2", "r", "c", "label")).alias("b"))
    return near.select("seed", "b.r", "b.c", "b.label")


def drop_plates(pixels: DataFrame, least: int = 400, share: float = 0.1) -> DataFrame:
    """Leave out flat plates: 4-connected pixels of one value, as many as the lesser of ``least`` and a share of all.

    Equal neighbours are found by labelling each value's pixels apart: a value's rows stand on a storey of their own.
    """
    total = pixels.filter("z is not null").count()
    most = max(1, min(least, int(share * total)))
    floors = pixels.filter("z is not null").groupBy("z").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("m")).filter(F.col("n") >= most)
    height = (pixels.agg(F.max("r") - F.min("r")).first()[0] or 0) + 2
    storeys = floors.withColumn("storey", F.row_number().over(Window.orderBy("z")) - 1).select("z", "storey")
    stacked = pixels.join(storeys, "z").select((F.col("r") + F.col("storey") * height).alias("r"), "c", F.col("r").alias("own_r"))
    labelled = label_components(stacked.select("r", "c")).join(stacked, ["r", "c"])
    plates = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= most)
    gone = labelled.join(plates, "label", "left_semi").select(F.col("own_r").alias("r"), "c")
    return pixels.join(gone, ["r", "c"], "left_anti")
