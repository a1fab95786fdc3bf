"""Images and masks: decoding, digests, artifact listings, and array files written by other tools."""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbiscope.functions import png
from orbiscope.operators.rasters import with_kernel

# OpenCV type codes of the image source, and the names of the modes they stand for.
MODES = {0: "L", 16: "RGB", 24: "RGBA"}


def plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/*", "/")


def read_images(spark: SparkSession, paths: str | list[str], checksum: bool = True) -> DataFrame:
    """(path, rgb, height, width, channels, source_mode, sha256, decode_error) of image files.

    The JVM decodes; data comes as BGR and leaves as RGB.  A file that cannot be
    decoded has a null raster and an error, it does not fail the job.
    """
    images = spark.read.format("image").load(paths).select("image.*").withColumn("path", plain_path(F.col("origin")))

    def to_rgb(data, height, width, channels):
        if height is None or height <= 0:
            return (None, "cannot identify image file")
        raster = np.frombuffer(data, np.uint8).reshape(height, width, channels)
        rgb = np.repeat(raster, 3, axis=2) if channels == 1 else raster[..., 2::-1]
        return np.ascontiguousarray(rgb).tobytes(), None

    made = with_kernel(images, to_rgb, ["data", "height", "width", "nChannels"], "rgb binary, decode_error string")
    named = F.create_map(*[F.lit(x) for pair in MODES.items() for x in pair])[F.col("mode")]
    good = F.col("decode_error").isNull()
    out = made.select(
        "path",
        "rgb",
        F.when(good, F.col("height")).alias("height"),
        F.when(good, F.col("width")).alias("width"),
        F.when(good, F.lit(3)).alias("channels"),
        F.when(good, F.coalesce(named, F.lit("RGB"))).alias("source_mode"),
        "decode_error",
    )
    if not checksum:
        return out.withColumn("sha256", F.lit(""))
    return out.join(file_digests(spark, paths), "path", "left")


def file_digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, sha256) of the files' bytes."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(plain_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256"))


def read_png(files: DataFrame, channels: int) -> DataFrame:
    """``files`` (path, content) with raster, height, width and png_error; masks (1 channel) become 0 and 255.

    Gray rasters widen to three or four channels, RGBA ones lose their alpha
    where three are wanted, RGB ones get an opaque one where four are.
    """

    def one(content):
        try:
            raster = png.decode(bytes(content))
        except Exception as error:  # noqa: BLE001  a row's failure is a value
            return None, None, None, str(error)
        pixels = raster[..., None] if raster.ndim == 2 else raster
        colour, alpha = (pixels, None) if pixels.shape[2] in (1, 3) else (pixels[..., :-1], pixels[..., -1:])
        if channels == 1:
            gray = colour[..., 0] if colour.shape[2] == 1 else np.rint(colour @ np.array([0.299, 0.587, 0.114]))
            out = np.where(gray > 0, 255, 0)
        else:
            out = np.repeat(colour, 3, axis=2) if colour.shape[2] == 1 else colour
            if channels == 4:
                out = np.concatenate([out, np.full_like(out[..., :1], 255) if alpha is None else alpha], axis=2)
        return np.ascontiguousarray(out.astype(np.uint8)).tobytes(), raster.shape[0], raster.shape[1], None

    return with_kernel(files, one, ["content"], "raster binary, height int, width int, png_error string")


def read_masks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, mask, height, width, png_error) of mask files."""
    files = spark.read.format("binaryFile").load(paths).select(plain_path(F.col("path")).alias("path"), "content")
    return read_png(files, 1).withColumnRenamed("raster", "mask").drop("content")


def matching_mask(mask: Column, height: Column, width: Column, want_height: Column, want_width: Column) -> Column:
    """The mask, or null where its shape is another one."""
    return F.when((height == want_height) & (width == want_width), mask)


def has_artifacts(frames: DataFrame, listing: DataFrame, folder_col: str, name: str) -> DataFrame:
    """``frames`` plus whether any PNG lies below the folder named in ``folder_col``.

    ``listing`` (path) holds names only.  Paths are cut to every ancestor folder,
    so that the lookup is an equi-join.
    """
    parts = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    folders = listing.where(F.endswith(F.lower("path"), F.lit(".png"))).select(F.explode(ancestors).alias(folder_col)).distinct()
    return frames.join(folders.withColumn(name, F.lit(True)), folder_col, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def read_arrays(files: DataFrame, members: list[str]) -> DataFrame:
    """``files`` (path, content: .npz bytes) with one row per wanted member: name, dtype, shape, data.

    Members that a file lacks have no row; strings are UTF-8, one per line.
    """

    def one(content):
        out = []
        with np.load(io.BytesIO(bytes(content)), allow_pickle=False) as payload:
            for m in members:
                if m not in payload:
                    continue
                a = payload[m]
                text = a.dtype.kind == "U"
                data = "\n".join(a.ravel().tolist()).encode() if text else np.ascontiguousarray(a).tobytes()
                out.append({"name": m, "dtype": "str" if text else a.dtype.str, "shape": list(a.shape), "data": data})
        return (out,)

    made = with_kernel(files, one, ["content"], "member array<struct<name:string,dtype:string,shape:array<int>,data:binary>>")
    return made.select("path", F.explode("member").alias("m")).select("path", "m.*")
