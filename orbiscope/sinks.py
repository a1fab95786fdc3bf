"""Sinks: every artifact is a row (path, content); one writer puts rows into files.

Stages never write.  A dry run is a plan without a sink.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbiscope.functions import exprs, kernels, png
from orbiscope.operators.rasters import with_kernel
from orbiscope.schema import FRAMES, METRIC_FIELDS

OUTPUT_FOLDERS = (
    "rgb", "rgba", "masks/dynamic", "masks/roof", "masks/sky", "masks/inpaint", "masks/union_debug", "cubemap", "qa/metrics",
    "qa/overlays", "qa/contact_sheets", "manifests",
)


def open_folder(path: str):
    """(file system, path) of a plain path or an URI, by Arrow's file systems."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def write_files(artifacts: DataFrame) -> None:
    """Write every (path, content) row; rows are written where they are, a repeated attempt overwrites."""

    def write(rows: Iterator) -> None:
        made = set()
        for row in rows:
            where, path = open_folder(row.path)
            folder = path.rsplit("/", 1)[0]
            if folder not in made:
                where.create_dir(folder, recursive=True)
                made.add(folder)
            with where.open_output_stream(path) as out:
                out.write(bytes(row.content))

    artifacts.select("path", "content").foreachPartition(write)


def pretty_json(value: Column) -> Column:
    """A struct as UTF-8 JSON text, compact; ``json_files`` indents it."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_files(df: DataFrame, path: Column, value: Column) -> DataFrame:
    """(path, content): the struct with sorted keys, indented by two, and a final newline."""

    def one(text):
        return ((json.dumps(json.loads(text), indent=2, sort_keys=True) + "\n").encode(),)

    texts = df.select(path.alias("path"), pretty_json(value).alias("_json"))
    return with_kernel(texts, one, ["_json"], "content binary").select("path", "content")


def csv_cell(text: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def csv_files(df: DataFrame, path: Column, order: str, columns: dict[str, Column]) -> DataFrame:
    """(path, content): one CSV per path with a header, rows in ``order``; cells are strings already."""
    line = F.concat_ws(",", *[csv_cell(F.coalesce(c, F.lit(""))) for c in columns.values()])
    grouped = df.groupBy(path.alias("path")).agg(F.array_sort(F.collect_list(F.struct(F.col(order), line.alias("line")))).alias("lines"))
    head = ",".join(columns)
    body = F.concat(F.lit(head + "\r\n"), F.array_join(F.transform("lines", lambda r: r["line"]), "\r\n"), F.lit("\r\n"))
    return grouped.select("path", F.encode(body, "UTF-8").alias("content"))


def manifest_files(frames: DataFrame, output_root: str) -> DataFrame:
    """manifests/frames.csv of every sequence, in manifest order, with all columns of the manifest schema."""
    path = F.concat(F.lit(f"{output_root}/"), F.col("sequence_id"), F.lit("/manifests/frames.csv"))
    cells = {n: exprs.manifest_text(F.col(n), k) for n, k in FRAMES.items()}
    return csv_files(frames, path, "csv_row_number", cells)


def empty_manifest_files(sequences: DataFrame, output_root: str) -> DataFrame:
    """The header alone, for sequences without frames."""
    path = F.concat(F.lit(f"{output_root}/"), F.col("sequence_id"), F.lit("/manifests/frames.csv"))
    return sequences.select(path.alias("path"), F.encode(F.lit(",".join(FRAMES) + "\r\n"), "UTF-8").alias("content"))


def summary_files(summaries: DataFrame, output_root: str) -> DataFrame:
    """manifests/sequence_summary.json of every sequence."""
    path = F.concat(F.lit(f"{output_root}/"), F.col("sequence_id"), F.lit("/manifests/sequence_summary.json"))
    return json_files(summaries, path, F.struct(*summaries.columns))


def metric_files(frames: DataFrame, output_root: str) -> DataFrame:
    """qa/metrics/frame_metrics.csv of every sequence."""

    def cell(name: str) -> Column:
        if f"qa_{name}" in FRAMES:
            return exprs.manifest_text(F.col(f"qa_{name}"), FRAMES[f"qa_{name}"])
        return exprs.manifest_text(F.col(name), FRAMES[name])

    path = F.concat(F.lit(f"{output_root}/"), F.col("sequence_id"), F.lit("/qa/metrics/frame_metrics.csv"))
    return csv_files(frames, path, "csv_row_number", {n: cell(n) for n in METRIC_FIELDS})


def mask_files(df: DataFrame, path: str, mask: str) -> DataFrame:
    """(path, content): masks as gray PNG files; rows without a mask have no file."""

    def one(data, height, width):
        return (png.encode(kernels.as_mask(np.frombuffer(data, np.uint8).reshape(height, width) > 0)),)

    there = df.where(F.col(mask).isNotNull()).select(F.col(path).alias("path"), F.col(mask).alias("_m"), "height", "width")
    return with_kernel(there, one, ["_m", "height", "width"], "content binary").select("path", "content")


def union_debug_files(df: DataFrame) -> DataFrame:
    """Dynamic, roof and sky masks as the channels of one RGB file."""

    def one(height, width, *masks):
        planes = [kernels.as_mask(np.frombuffer(m, np.uint8).reshape(height, width) > 0) for m in masks]
        return (png.encode(np.stack(planes, axis=-1)),)

    there = df.where(F.col("inpaint").isNotNull())
    made = with_kernel(there, one, ["height", "width", "dynamic", "roof", "sky"], "content binary")
    return made.select(F.col("union_debug_path").alias("path"), "content")


def final_files(df: DataFrame) -> DataFrame:
    """RGB and RGBA outputs of frames with ``final_rgb`` and ``sky``; the sky is transparent."""

    def one(rgb, sky, height, width):
        raster = np.frombuffer(rgb, np.uint8).reshape(height, width, 3)
        alpha = kernels.sky_alpha(np.frombuffer(sky, np.uint8).reshape(height, width))
        return png.encode(raster), png.encode(np.dstack([raster, alpha]))

    there = df.where(F.col("final_rgb").isNotNull())
    made = with_kernel(there, one, ["final_rgb", "sky", "height", "width"], "_rgb binary, _rgba binary")
    both = F.array(
        F.struct(F.col("rgb_output_path").alias("path"), F.col("_rgb").alias("content")),
        F.struct(F.col("rgba_output_path").alias("path"), F.col("_rgba").alias("content")),
    )
    return made.select(F.explode(both).alias("f")).select("f.path", "f.content")


def face_files(df: DataFrame, folder: str, overlap: int) -> DataFrame:
    """Inpainted faces with and without their guard band, and their masks."""

    def one(rgb, mask, total):
        raster = np.frombuffer(rgb, np.uint8).reshape(total, total, 3)
        inner = raster[overlap : total - overlap, overlap : total - overlap] if overlap > 0 else raster
        return png.encode(raster), png.encode(np.ascontiguousarray(inner)), png.encode(np.frombuffer(mask, np.uint8).reshape(total, total))

    made = with_kernel(df, one, ["final_face", "face_mask", "face_total"], "_a binary, _b binary, _c binary")
    base = F.concat_ws("/", "cubemap_cache_dir", F.lit(folder), "face", "frame_stem")
    files = F.array(
        *[
            F.struct(F.concat(base, F.lit(suffix)).alias("path"), F.col(c).alias("content"))
            for suffix, c in ((".with_overlap.png", "_a"), (".png", "_b"), (".mask.png", "_c"))
        ]
    )
    return made.select(F.explode(files).alias("f")).select("f.path", "f.content")


def panel(parts: list[np.ndarray], width: int, bar: int = 24) -> np.ndarray:
    """Rasters of one shape side by side, each ``width`` wide below a bar."""
    out = []
    for p in parts:
        small = kernels.resize_to_width(np.repeat(p[..., None], 3, axis=2) if p.ndim == 2 else p, width)
        out.append(np.concatenate([np.full((bar, small.shape[1], 3), 24, np.uint8), small]))
    return np.concatenate(out, axis=1)


def panel_files(df: DataFrame, width: int) -> DataFrame:
    """Diagnostic panels: source, the four masks, the final image and its preview over a checkerboard."""

    def one(height, width_, original, dynamic, roof, sky, inpaint, rgb, rgba):
        def raster(data, c):
            a = np.frombuffer(data, np.uint8).reshape(height, width_, c)
            return a[..., 0] if c == 1 else a

        parts = [raster(original, 3), *[raster(m, 1) for m in (dynamic, roof, sky, inpaint)], raster(rgb, 3)]
        return (png.encode(panel([*parts, kernels.over_checkerboard(raster(rgba, 4))], width)),)

    inputs = ["height", "width", "original", "dynamic", "roof", "sky", "inpaint", "final_rgb", "final_rgba"]
    made = with_kernel(df, one, inputs, "content binary")
    return made.select(F.col("overlay_output_path").alias("path"), "content")
