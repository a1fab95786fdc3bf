"""Masks as relations of foreground pixels.

A pixel table has the key columns of a raster plus ``y`` and ``x``, one row per
foreground pixel.  This form suits sparse masks and set operations; dense large
rasters are better kept packed (``orbiscope.operators.rasters``).  Each operator
needs at most one shuffle: a dilation or erosion by ``radius`` steps is one
look at the diamond of that radius, not ``radius`` rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("sequence_id", "frame_idx")
YX = ("y", "x")


def union(*masks: DataFrame, keys=KEYS) -> DataFrame:
    """Pixels in any of the masks."""
    out = masks[0].select(*keys, *YX)
    for m in masks[1:]:
        out = out.unionByName(m.select(*keys, *YX))
    return out.distinct()


def intersect(a: DataFrame, b: DataFrame, keys=KEYS) -> DataFrame:
    return a.select(*keys, *YX).join(b.select(*keys, *YX), [*keys, *YX], "left_semi")


def subtract(a: DataFrame, b: DataFrame, keys=KEYS) -> DataFrame:
    return a.select(*keys, *YX).join(b.select(*keys, *YX), [*keys, *YX], "left_anti")


def _offsets(cells: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in cells]))


def diamond(radius: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(abs(dy) - radius, radius - abs(dy) + 1)]


def _moved(px: DataFrame, cells: list[tuple[int, int]], height: int, width: int, wrap_x: bool, keys) -> DataFrame:
    """Every pixel at every offset, within the raster."""
    moved = px.select(*keys, *YX, _offsets(cells).alias("o")).select(
        *keys,
        (F.col("y") + F.col("o.dy")).alias("y"),
        (F.pmod(F.col("x") + F.col("o.dx"), F.lit(width)) if wrap_x else F.col("x") + F.col("o.dx")).alias("x"),
        ((F.col("o.dy") == 0) & (F.col("o.dx") == 0)).alias("itself"),
    )
    return moved.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))


def dilate(px: DataFrame, radius: int, height: int, width: int, wrap_x: bool = False, keys=KEYS) -> DataFrame:
    """All pixels within ``radius`` steps of the foreground."""
    if radius <= 0:
        return px.select(*keys, *YX).distinct()
    return _moved(px, diamond(radius), height, width, wrap_x, keys).select(*keys, *YX).distinct()


def erode(px: DataFrame, radius: int, height: int, width: int, keys=KEYS) -> DataFrame:
    """Pixels whose whole diamond is foreground; rows beyond the raster count as such, columns beyond it do not."""
    if radius <= 0:
        return px.select(*keys, *YX).distinct()
    rows = [
        F.when((F.col("y") + dy).between(0, height - 1), F.lit(2 * (radius - abs(dy)) + 1)).otherwise(F.lit(0))
        for dy in range(-radius, radius + 1)
    ]
    needed = rows[0]
    for r in rows[1:]:
        needed = needed + r
    hits = _moved(px, diamond(radius), height, width, False, keys).groupBy(*keys, *YX).agg(F.count("*").alias("n"))
    return hits.where((F.col("n") == needed) & F.col("x").between(radius, width - 1 - radius)).select(*keys, *YX)


def majority_smooth(px: DataFrame, height: int, width: int, wrap_x: bool, iterations: int = 1, keys=KEYS) -> DataFrame:
    """Keep foreground with at least two of its 3x3 neighbourhood; rows beyond an edge repeat it."""
    out = px.select(*keys, *YX)
    for _ in range(max(0, iterations)):
        cells = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
        around = _moved(out, cells, height, width, wrap_x, keys)
        # the repeated row beyond an edge: edge pixels meet their own row once more
        again = _moved(out.where((F.col("y") == 0) | (F.col("y") == height - 1)), [(0, -1), (0, 0), (0, 1)], height, width, wrap_x, keys)
        if height == 1:
            again = again.unionByName(again)
        counted = around.unionByName(again.withColumn("itself", F.lit(False))).groupBy(*keys, *YX).agg(
            F.count("*").alias("n"), F.max("itself").alias("on")
        )
        out = counted.where(F.col("on") & (F.col("n") >= 2)).select(*keys, *YX)
    return out


def top_run(px: DataFrame, height: int, seed_fraction: float, keys=KEYS) -> DataFrame:
    """Per column, the run from the first foreground pixel down, if that lies within the seed rows."""
    from math import ceil

    limit = max(1, ceil(height * min(max(seed_fraction, 0.01), 1.0)))
    column = Window.partitionBy(*keys, "x")
    ranked = px.select(*keys, *YX).select(
        *keys,
        *YX,
        F.min("y").over(column).alias("first"),
        (F.row_number().over(column.orderBy("y")) - 1).alias("place"),
    )
    return ranked.where((F.col("first") < limit) & (F.col("y") - F.col("first") == F.col("place"))).select(*keys, *YX)


def temporal_consistency(px: DataFrame, keys=KEYS) -> DataFrame:
    """A frame's own pixels and those that both neighbouring frames have (first and last frame stay as they are).

    One aggregation: every pixel is counted for itself and for either neighbour.
    """
    *group, frame = keys
    near = px.select(*keys, *YX, F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("step")).select(
        *group, (F.col(frame) + F.col("step")).alias(frame), *YX, "step"
    )
    seen = near.groupBy(*keys, *YX).agg(
        F.max(F.col("step") == 0).alias("own"), F.count_if(F.col("step") != 0).alias("around")
    )
    return seen.where(F.col("own") | (F.col("around") == 2)).select(*keys, *YX)


def neighbour_vote(px: DataFrame, frames: DataFrame, window: int, keys=KEYS) -> DataFrame:
    """Pixels in at least half (rounded up) of the frames within ``window`` that have a candidate, the frame itself left out.

    ``frames`` lists every frame with ``has_candidate``.
    """
    *group, frame = keys
    steps = F.explode(F.array(*[F.lit(s) for s in range(-window, window + 1) if s]))
    voters = (
        frames.where("has_candidate")
        .select(*keys, steps.alias("step"))
        .groupBy(*group, (F.col(frame) + F.col("step")).alias(frame))
        .agg(F.count("*").alias("voters"))
    )
    votes = (
        px.select(*keys, *YX, steps.alias("step"))
        .groupBy(*group, (F.col(frame) + F.col("step")).alias(frame), *YX)
        .agg(F.count("*").alias("votes"))
    )
    needed = F.greatest(F.lit(1), F.floor((F.col("voters") + 1) / 2))
    return (
        votes.join(voters, list(keys))
        .join(frames.select(*keys), list(keys), "left_semi")
        .where(F.col("votes") >= needed)
        .select(*keys, *YX)
    )


def measure(px: DataFrame, height: int, width: int, keys=KEYS) -> DataFrame:
    """Area, share, bounding box (exclusive ends) and centroid per raster; rasters without foreground have no row."""
    return px.groupBy(*keys).agg(
        F.count("*").alias("area"),
        (F.count("*") / F.lit(height * width)).alias("ratio"),
        F.min("x").alias("x0"),
        F.min("y").alias("y0"),
        (F.max("x") + 1).alias("x1"),
        (F.max("y") + 1).alias("y1"),
        F.avg("x").alias("cx"),
        F.avg("y").alias("cy"),
    )


def mask_iou(a: DataFrame, b: DataFrame, frames: DataFrame, keys=KEYS) -> DataFrame:
    """Intersection over union per raster of ``frames``; two empty masks have 1."""
    tagged = a.select(*keys, *YX, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        b.select(*keys, *YX, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    cells = tagged.groupBy(*keys, *YX).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    counted = cells.groupBy(*keys).agg(F.sum(F.col("a") * F.col("b")).alias("both"), F.count("*").alias("either"))
    return frames.select(*keys).join(counted, list(keys), "left").select(
        *keys, F.when(F.col("either") > 0, F.col("both") / F.col("either")).otherwise(F.lit(1.0)).alias("iou")
    )


def roof_ellipse(height: int, width: int, fraction: float):
    """Condition on ``y`` and ``x``: inside the centred ellipse that covers ``fraction`` of either side."""
    rx, ry = max(1.0, width * fraction / 2), max(1.0, height * fraction / 2)
    dx, dy = (F.col("x") - (width - 1) / 2) / rx, (F.col("y") - (height - 1) / 2) / ry
    return dx * dx + dy * dy <= 1


def regularise_roof(px: DataFrame, frames: DataFrame, height: int, width: int, fraction: float, margin: float, keys=KEYS) -> DataFrame:
    """At least the core ellipse in every frame of ``frames``, at most the expanded one."""
    from orbiscope.functions.kernels import roof_fraction

    core = grid(frames, height, width, keys).where(roof_ellipse(height, width, roof_fraction(fraction, margin, False)))
    return union(px, core, keys=keys).where(roof_ellipse(height, width, roof_fraction(fraction, margin, True)))


def grid(frames: DataFrame, height: int, width: int, keys=KEYS) -> DataFrame:
    """Every pixel of every frame."""
    return (
        frames.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("y"))
        .select(*keys, "y", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("x"))
    )


def wrap_pad(px: DataFrame, width: int, left: int, right: int, keys=KEYS) -> DataFrame:
    """Columns repeated around the seam; x counts from the padded left edge."""
    turns = range(-((left + width - 1) // width), (right + width - 1) // width + 1)
    shifted = px.select(*keys, "y", "x", F.explode(F.array(*[F.lit(t * width + left) for t in turns])).alias("shift"))
    moved = shifted.select(*keys, "y", (F.col("x") + F.col("shift")).cast("int").alias("x"))
    return moved.where(F.col("x").between(0, left + width + right - 1))


def wrap_crop(px: DataFrame, width: int, x0: int, crop: int, keys=KEYS) -> DataFrame:
    """``crop`` columns from ``x0`` on, around the seam as often as needed; x counts from ``x0``."""
    first = F.pmod(F.col("x") - x0, F.lit(width))
    return px.select(*keys, "y", F.explode(F.sequence(first, F.lit(max(crop - 1, width - 1)), F.lit(width))).alias("x")).where(
        F.col("x") < crop
    )
