"""Cubemap geometry as lookup relations, and reprojection.

The mapping between a panorama and its cubemap faces depends on four numbers
only.  It is computed once by the kernels and is the same for all frames, so it
is a dimension, not part of the data.  Packed rasters are reprojected by kernels
that rebuild the lookup once per Python worker; the relational forms join it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbiscope.functions import kernels
from orbiscope.operators.rasters import with_kernel

#: Lookup relations of more rows than this are not broadcast.
BROADCAST_ROWS = 1 << 20


@lru_cache(maxsize=8)
def face_lookup(face: str, width: int, height: int, size: int, overlap: int):
    return kernels.face_lookup(face, width, height, size, overlap)


def face_pixels(spark: SparkSession, width: int, height: int, size: int, overlap: int) -> DataFrame:
    """(face_ord, face, fy, fx, ex, ey, inner): the nearest panorama pixel of every face pixel.

    Built in one task per face from the 32-bit kernel, so that samples agree
    with the packed form.
    """
    total = size + 2 * overlap

    def rows(pdfs):
        import pandas as pd

        for pdf in pdfs:
            for k in pdf["id"]:
                x, y, inner = kernels.face_lookup(kernels.FACES[k], width, height, size, overlap)
                fy, fx = np.mgrid[:total, :total]
                yield pd.DataFrame(
                    {
                        "face_ord": np.int32(k),
                        "face": kernels.FACES[k],
                        "fy": fy.ravel().astype(np.int32),
                        "fx": fx.ravel().astype(np.int32),
                        "ey": np.clip(np.rint(y).astype(np.int64), 0, height - 1).ravel().astype(np.int32),
                        "ex": (np.rint(x).astype(np.int64) % width).ravel().astype(np.int32),
                        "inner": inner.ravel(),
                    }
                )

    schema = "face_ord int, face string, fy int, fx int, ey int, ex int, inner boolean"
    return spark.range(0, len(kernels.FACES), 1, len(kernels.FACES)).mapInPandas(rows, schema)


def panorama_pixels(spark: SparkSession, width: int, height: int, size: int, overlap: int) -> DataFrame:
    """(ey, ex, face_ord, face, fy, fx): the face pixel nearest to every panorama pixel.  Each is in one face."""
    total = size + 2 * overlap

    def rows(pdfs):
        import pandas as pd

        for pdf in pdfs:
            if not len(pdf):
                continue
            face, fx, fy = kernels.panorama_lookup(width, height, size, overlap)
            for y in pdf["id"]:
                yield pd.DataFrame(
                    {
                        "ey": np.int32(y),
                        "ex": np.arange(width, dtype=np.int32),
                        "face_ord": face[y].astype(np.int32),
                        "face": np.array(kernels.FACES)[face[y]],
                        "fy": np.clip(np.rint(fy[y]), 0, total - 1).astype(np.int32),
                        "fx": np.clip(np.rint(fx[y]), 0, total - 1).astype(np.int32),
                    }
                )

    schema = "ey int, ex int, face_ord int, face string, fy int, fx int"
    return spark.range(0, height, 1, max(1, min(height, 8))).mapInPandas(rows, schema)


def sized(lookup: DataFrame, rows: int) -> DataFrame:
    """The lookup, broadcast where its known number of rows allows."""
    return F.broadcast(lookup) if rows <= BROADCAST_ROWS else lookup


def face_masks_to_panorama(px: DataFrame, lookup: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Foreground pixels (keys, y, x) of the panorama from face pixels (keys, face, y, x)."""
    at = lookup.select("face", F.col("fy").alias("y"), F.col("fx").alias("x"), "ey", "ex")
    joined = px.join(sized(at, rows), ["face", "y", "x"])
    return joined.select(*keys, F.col("ey").alias("y"), F.col("ex").alias("x")).distinct()


def panorama_mask_to_faces(px: DataFrame, lookup: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Foreground pixels (keys, face, y, x) of the faces from panorama pixels (keys, y, x)."""
    at = lookup.select("face", "fy", "fx", F.col("ey").alias("y"), F.col("ex").alias("x"))
    return px.join(sized(at, rows), ["y", "x"]).select(*keys, "face", F.col("fy").alias("y"), F.col("fx").alias("x"))


def feather_weight(total: int, overlap: int, feather: int):
    """Weight column of ``fy`` and ``fx``."""
    if feather <= 0:
        return F.lit(1.0)
    reach = max(1, min(feather, max(1, overlap)))
    edge = F.least(F.col("fy") + 1, total - F.col("fy"), F.col("fx") + 1, total - F.col("fx"))
    return F.least(edge / F.lit(float(reach)), F.lit(1.0))


def splat(values: DataFrame, lookup: DataFrame, keys: list[str], size: int, overlap: int, feather: int, rows: int) -> DataFrame:
    """Weighted means (keys, y, x, v) on the panorama of face values (keys, face, y, x, v).

    A scatter is a group-by on the target pixel; sums combine before the shuffle.
    """
    total = size + 2 * overlap
    at = lookup.select("face", "fy", "fx", "ey", "ex", feather_weight(total, overlap, feather).alias("w"))
    renamed = values.select(*keys, "face", F.col("y").alias("fy"), F.col("x").alias("fx"), "v")
    joined = renamed.join(sized(at, rows), ["face", "fy", "fx"])
    summed = joined.groupBy(*keys, "ey", "ex").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("w"))
    mean = F.rint(F.col("s") / F.col("w")).cast("int")
    return summed.where(F.col("w") > 1e-6).select(*keys, F.col("ey").alias("y"), F.col("ex").alias("x"), mean.alias("v"))


# --- packed rasters --------------------------------------------------------------------------------------------------


def project_faces(frames: DataFrame, size: int, overlap: int) -> DataFrame:
    """``frames`` (rgb, height, width) times six faces: face_ord, face, size and face_rgb; map-side."""
    total = size + 2 * overlap
    faces = F.posexplode(F.array(*[F.lit(f) for f in kernels.FACES])).alias("face_ord", "face")
    each = frames.select("*", faces)

    def one(face, rgb, height, width):
        raster = np.frombuffer(rgb, np.uint8).reshape(height, width, 3)
        x, y, _ = face_lookup(face, width, height, size, overlap)
        return (kernels.sample_bilinear(raster, x, y, wrap_x=True).tobytes(),)

    made = with_kernel(each, one, ["face", "rgb", "height", "width"], "face_rgb binary")
    return made.withColumn("face_total", F.lit(total))


def mask_to_panorama(df: DataFrame, size: int, overlap: int) -> DataFrame:
    """Face masks (face, mask, erp_height, erp_width) as panorama masks ``erp_mask``; map-side."""
    total = size + 2 * overlap

    def one(face, mask, height, width):
        raster = np.frombuffer(mask, np.uint8).reshape(total, total)
        return (kernels.face_mask_to_panorama(raster, face, width, height, size, overlap).tobytes(),)

    return with_kernel(df, one, ["face", "mask", "erp_height", "erp_width"], "erp_mask binary")


def mask_to_face(df: DataFrame, size: int, overlap: int) -> DataFrame:
    """Panorama masks (face, mask, height, width) as the face's ``face_mask``; map-side."""

    def one(face, mask, height, width):
        x, y, _ = face_lookup(face, width, height, size, overlap)
        return (kernels.panorama_mask_to_face(np.frombuffer(mask, np.uint8).reshape(height, width), x, y).tobytes(),)

    return with_kernel(df, one, ["face", "mask", "height", "width"], "face_mask binary")
