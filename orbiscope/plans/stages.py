"""The nine stages as transformations of DataFrames, without side effects.

A stage takes the frames (and what its predecessors made) and returns its own
rows with status and error columns; a frame's failure is a value in its row.
Sinks are separate, so a dry run is a plan that no sink has been given.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbiscope.config import Config
from orbiscope.functions import kernels
from orbiscope.operators import quality, rasters, windows

# --- index -----------------------------------------------------------------------------------------------------------


def subset(frames: DataFrame, sequence_ids: Iterable[str] | None) -> DataFrame:
    """Only the named sequences; all without names; unknown names are ignored."""
    wanted = list(sequence_ids or [])
    return frames.where(F.col("sequence_id").isin(wanted)) if wanted else frames


def sequence_status(frames: DataFrame, min_valid: int) -> DataFrame:
    """One row per sequence: counts, status and failure reason after indexing."""
    valid = F.count_if("file_exists")
    few = F.col("valid_frames") < min_valid
    reason = F.concat(
        F.lit("Only "), F.col("valid_frames").cast("string"), F.lit(f" valid frames remain after validation; minimum is {min_valid}")
    )
    return (
        frames.groupBy("sequence_id")
        .agg(F.count("*").alias("total_csv_rows"), valid.alias("valid_frames"), F.count_if(~F.col("file_exists")).alias("skipped_frames"))
        .withColumn("status", F.when(few, "failed_insufficient_valid_frames").otherwise("ready"))
        .withColumn("failure_reason", F.when(few, reason))
    )


def index_frames(rows: DataFrame, files: DataFrame, config: Config) -> DataFrame:
    """Frames from manifest rows and the listing of files that exist (path).

    A left join on the resolved path; the listing is distinct, so no row
    multiplies.
    """
    from orbiscope.functions import exprs

    folder = F.concat_ws("/", F.lit(config.dataset_root), "sequence_id")
    found = rows.withColumn("resolved_fixed_path", exprs.resolve_frame_path(folder, F.col("path")))
    named = found.withColumn("frame_name", exprs.file_name(F.col("resolved_fixed_path")))
    named = named.withColumn("frame_stem", exprs.file_stem(F.col("frame_name")))
    named = named.withColumn("frame_number", exprs.frame_number(F.col("frame_stem")))
    there = files.select(F.col("path").alias("resolved_fixed_path"), F.lit(True).alias("_there")).distinct()
    joined = named.join(there, "resolved_fixed_path", "left").withColumn("file_exists", F.coalesce("_there", F.lit(False))).drop("_there")
    exists = F.col("file_exists")
    return (
        joined.withColumn("processing_status", F.when(exists, "ready").otherwise("missing_source"))
        .withColumn("skip_reason", F.when(exists, "").otherwise("Referenced fixed frame is missing"))
        .withColumn("valid_order_index", windows.valid_order_index())
        .withColumnRenamed("path", "source_path")
        .withColumns(output_paths(config))
    )


def output_paths(config: Config) -> dict[str, Column]:
    """The nine output paths of a frame."""
    base = F.concat_ws("/", F.lit(config.output_root), "sequence_id")
    stem = F.col("frame_stem")

    def at(folder: str, suffix: str = ".png") -> Column:
        return F.concat(base, F.lit(f"/{folder}/"), stem, F.lit(suffix))

    return {
        "rgb_output_path": at("rgb"),
        "rgba_output_path": at("rgba"),
        "dynamic_mask_path": at("masks/dynamic"),
        "roof_mask_path": at("masks/roof"),
        "sky_mask_path": at("masks/sky"),
        "inpaint_mask_path": at("masks/inpaint"),
        "union_debug_path": at("masks/union_debug"),
        "overlay_output_path": at("qa/overlays", ".overlay.png"),
        "cubemap_cache_dir": at("cubemap", ""),
    }


# --- normalize, project ----------------------------------------------------------------------------------------------


def normalize(frames: DataFrame, images: DataFrame) -> DataFrame:
    """Frames with their decoded raster (rgb, height, width, channels), source mode, digest and status.

    ``images`` comes from ``sources.images.read_images``; an unreadable file is a
    failed frame.
    """
    decoded = images.withColumnRenamed("path", "resolved_fixed_path")
    joined = frames.join(decoded, "resolved_fixed_path", "left")
    there = F.col("file_exists")
    failed = there & F.col("rgb").isNull()
    status = F.when(~there, "skipped_missing_source").when(failed, "failed").otherwise("normalized")
    error = (
        F.when(~there, F.col("skip_reason"))
        .when(failed, F.coalesce("decode_error", F.lit("cannot read file")))
        .otherwise("")
    )
    return joined.withColumn("erp_normalization_status", status).withColumn("erp_normalization_error", error).drop("decode_error")


def project(normalized: DataFrame, config: Config) -> DataFrame:
    """One row per frame and face of the frames that were normalized."""
    from orbiscope.operators import geometry

    ready = normalized.where(F.col("erp_normalization_status") == "normalized")
    return geometry.project_faces(ready, config.cube_face_size, config.cube_overlap_px)


def projection_status(normalized: DataFrame) -> DataFrame:
    """Projection status per frame; frames that were not normalized pass their reason on."""
    status = F.col("erp_normalization_status")
    return normalized.withColumn(
        "cubemap_projection_status", F.when(status == "normalized", "projected").otherwise(status)
    ).withColumn("cubemap_projection_error", F.when(status == "normalized", "").otherwise(F.col("erp_normalization_error")))


# --- fuse ------------------------------------------------------------------------------------------------------------


def union_masks(masks: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Pixel-wise maximum of packed masks of one key and shape.

    Masks of a batch are united before the shuffle, what is left of each key after it.
    """
    from orbiscope.operators.rasters import fold_masks

    by = [*keys, "height", "width"]
    rows = masks.select(*by, F.col("mask").alias(name))
    return fold_masks(fold_masks(rows, by, name).repartition(*by), by, name, whole=True)


def fuse_masks(frames: DataFrame, config: Config) -> DataFrame:
    """Dynamic, roof, sky and inpaint masks of every frame, with their areas.

    ``frames`` has sequence_id, frame_idx, height, width and the raw masks
    dynamic, roof and sky.  Cleaning is map-side; the neighbours' agreement needs
    one shuffle by sequence for all masks together.
    """

    def clean(height, width, dynamic, roof, sky):
        if None in (dynamic, roof, sky):
            return None, None, None
        d, r, s = (rasters.view(m, height, width) for m in (dynamic, roof, sky))
        d = kernels.clean_mask(d, config.dyn_min_component_area_px, config.dyn_dilate_px, config.dyn_erode_after_dilate_px)
        r = kernels.clean_mask(r, config.roof_min_component_area_px, config.roof_dilate_px, config.roof_erode_after_dilate_px)
        s = kernels.majority_smooth(s, config.sky_mask_erp_smoothing_iterations, wrap_x=True)
        return d.tobytes(), r.tobytes(), s.tobytes()

    raw = ["dynamic", "roof", "sky"]
    cleaned = rasters.with_kernel(frames, clean, ["height", "width", *raw], "_d binary, _r binary, _s binary").drop(*raw)
    named = cleaned.withColumnsRenamed({"_d": "dynamic", "_r": "roof", "_s": "sky"})
    from pyspark.sql import Window

    w = Window.partitionBy("sequence_id").orderBy("frame_idx")
    near = {}
    for side, fn in (("before", F.lag), ("after", F.lead)):
        same = (fn("height").over(w) == F.col("height")) & (fn("width").over(w) == F.col("width"))
        near |= {f"_{m}_{side}": F.when(same, fn(m).over(w)) for m in ("dynamic", "roof")}

    def fuse(height, width, dynamic, roof, sky, *neighbours):
        if dynamic is None:
            return None, None, None, None, None, None, None, None, "failed", "a mask of the frame is missing"
        out = []
        for own, before, after in ((dynamic, *neighbours[:2]), (roof, *neighbours[2:])):
            m = rasters.view(own, height, width) > 0
            if before is not None and after is not None:
                m = m | ((rasters.view(before, height, width) > 0) & (rasters.view(after, height, width) > 0))
            out.append(m)
        s = rasters.view(sky, height, width) > 0
        made = [*out, s, (out[0] | out[1]) & ~s]
        areas = [int(m.sum()) for m in made]
        return (*[kernels.as_mask(m).tobytes() for m in made], *areas, "fused", "")

    inputs = ["height", "width", "dynamic", "roof", "sky", "_dynamic_before", "_dynamic_after", "_roof_before", "_roof_after"]
    outputs = ", ".join(
        [*[f"_{m} binary" for m in ("dynamic", "roof", "sky", "inpaint")]]
        + [f"{m}_area_px long" for m in ("dynamic", "roof", "sky", "inpaint")]
        + ["mask_fusion_status string", "mask_fusion_error string"]
    )
    fused = rasters.with_kernel(named.withColumns(near), fuse, inputs, outputs)
    kept = fused.drop("dynamic", "roof", "sky", *near)
    return kept.withColumnsRenamed({f"_{m}": m for m in ("dynamic", "roof", "sky", "inpaint")})


def fusion_roll_up(fused: DataFrame) -> DataFrame:
    return quality.roll_up(fused, "mask_fusion_status", "failed_mask_fusion", "mask fusion")


# --- quality ---------------------------------------------------------------------------------------------------------


def measure_frames(frames: DataFrame) -> DataFrame:
    """Quality columns of every frame.

    ``frames`` has the rasters original, final_rgb, final_rgba, dynamic, roof,
    sky and inpaint with their own dimensions (``<name>_height``, ``<name>_width``,
    null where a file is missing or unreadable), ``has_lama`` and
    ``has_propainter``.  A frame without its file is skipped; a missing raster or
    a shape that differs fails the frame with the first such reason.
    """
    import time

    names = ("final_rgb", "final_rgba", "original", "dynamic", "roof", "sky", "inpaint")
    labels = ("final RGB output", "final RGBA output", "source ERP frame", "DYN mask", "ROOF mask", "SKY mask", "INPAINT mask")

    def one(exists, reason, *values):
        began = time.perf_counter()
        rasters_, heights, widths = values[:7], values[7:14], values[14:]
        none = [None] * 11
        if not exists:
            return (*none, time.perf_counter() - began, "skipped", reason)
        for label, raster in zip(labels, rasters_, strict=True):
            if raster is None:
                return (*none, time.perf_counter() - began, "failed", f"Missing {label}")
        h, w = heights[0], widths[0]
        for label, hh, ww in zip(labels[1:], heights[1:], widths[1:], strict=True):
            if (hh, ww) != (h, w):
                return (*none, time.perf_counter() - began, "failed", f"{label} shape {(hh, ww)} does not match RGB shape {(h, w)}")
        masks = {n: rasters.view(r, h, w) for n, r in zip(names[3:], rasters_[3:], strict=True)}
        ratios = [kernels.mask_ratio(masks[n]) for n in ("sky", "dynamic", "roof", "inpaint")]
        parts = [kernels.count_components(masks[n]) for n in ("dynamic", "roof")]
        import numpy as np

        rgb = np.frombuffer(rasters_[0], np.uint8).reshape(h, w, 3)
        alpha = np.frombuffer(rasters_[1], np.uint8).reshape(h, w, 4)[..., 3]
        seams = [kernels.seam_delta(rgb), kernels.seam_delta(alpha)]
        return (w, h, 3, *ratios, *parts, *seams, time.perf_counter() - began, "measured", "")

    inputs = ["file_exists", "skip_reason", *names, *[f"{n}_height" for n in names], *[f"{n}_width" for n in names]]
    outputs = (
        "_w int, _h int, _c int, _sky double, _dynamic double, _roof double, _inpaint double, _nd int, _nr int, _rgb double,"
        " _alpha double, qa_processing_time_sec double, qa_status string, qa_error string"
    )
    from orbiscope.functions import exprs

    base = frames.drop("qa_processing_time_sec", "qa_status", "qa_error")
    made = rasters.with_kernel(base, one, inputs, outputs)
    used = exprs.used_backend(
        F.col("has_lama"), F.col("has_propainter"), F.col("lama_status"), F.col("propainter_status"), F.col("single_frame_fallback_reason")
    )
    ok = F.col("qa_status") == "measured"
    lama, video = F.col("_used.lama"), F.col("_used.propainter")
    pending = F.col("propainter_status") == "pending"
    folder = F.col("cubemap_cache_dir")
    return (
        made.withColumn("_used", used)
        .withColumns(
            {
                "qa_used_lama_fallback": lama,
                "qa_used_propainter": video,
                "erp_width": F.coalesce("_w", "erp_width"),
                "erp_height": F.coalesce("_h", "erp_height"),
                "erp_channels": F.coalesce("_c", "erp_channels"),
                "qa_sky_ratio": F.col("_sky"),
                "qa_dynamic_ratio": F.col("_dynamic"),
                "qa_roof_ratio": F.col("_roof"),
                "qa_inpaint_ratio": F.col("_inpaint"),
                "qa_mask_components_dynamic": F.col("_nd"),
                "qa_mask_components_roof": F.col("_nr"),
                "qa_seam_delta_rgb": F.col("_rgb"),
                "qa_seam_delta_alpha": F.col("_alpha"),
                "propainter_output_dir": F.when(ok & video, F.coalesce("propainter_output_dir", F.concat(folder, F.lit("/propainter")))).otherwise(
                    F.col("propainter_output_dir")
                ),
                "lama_output_dir": F.when(ok & lama, F.coalesce("lama_output_dir", F.concat(folder, F.lit("/lama_fallback")))).otherwise(
                    F.col("lama_output_dir")
                ),
                "lama_status": F.when(ok & lama & (F.col("lama_status") == "pending"), "inpainted").otherwise(F.col("lama_status")),
                "propainter_status": F.when(ok & video & pending, "inpainted")
                .when(ok & lama & pending, "fallback_lama")
                .otherwise(F.col("propainter_status")),
            }
        )
        .drop("_used", "_w", "_h", "_c", "_sky", "_dynamic", "_roof", "_inpaint", "_nd", "_nr", "_rgb", "_alpha")
    )
