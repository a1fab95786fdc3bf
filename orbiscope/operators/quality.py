"""Quality aggregates per frame and per sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENTILES = (0.5, 0.9, 0.95, 0.99)
STAGE_STATUSES = {
    "erp_normalization": "erp_normalization_status",
    "cubemap_projection": "cubemap_projection_status",
    "semantic_parse": "semantic_parse_status",
    "grounding_detect": "grounding_detect_status",
    "sam2_refine": "sam2_refine_status",
    "mask_fusion": "mask_fusion_status",
    "propainter": "propainter_status",
    "lama": "lama_status",
    "qa": "qa_status",
}


def percentiles(value: Column) -> Column:
    """struct<p50, p90, p95, p99, max>, linearly interpolated and exact; null without values."""
    found = F.percentile(value, F.array(*[F.lit(p) for p in PERCENTILES]))
    return F.struct(
        *[F.get(found, F.lit(i)).alias(f"p{int(p * 100)}") for i, p in enumerate(PERCENTILES)], F.max(value).alias("max")
    )


def failures() -> list[Column]:
    """Failed frames per stage."""
    return [F.count_if(F.col(c) == "failed").alias(k) for k, c in STAGE_STATUSES.items()]


def sequence_metrics(frames: DataFrame) -> DataFrame:
    """One row per sequence from frames that have been measured."""
    measured = F.col("qa_status") == "measured"

    def of(c: str) -> Column:
        return F.when(measured, F.col(c))

    ratios = {k: f"qa_{k}_ratio" for k in ("sky", "dynamic", "roof", "inpaint")}
    return frames.groupBy("sequence_id").agg(
        F.count_if(measured).alias("frames_processed"),
        F.count_if(F.col("qa_status") == "skipped").alias("frames_skipped"),
        F.count_if(F.col("qa_used_lama_fallback")).alias("frames_with_fallback"),
        F.struct(*[F.median(of(c)).alias(k) for k, c in ratios.items()]).alias("median_mask_ratios"),
        F.struct(percentiles(of("qa_seam_delta_rgb")).alias("rgb"), percentiles(of("qa_seam_delta_alpha")).alias("alpha")).alias(
            "percentile_seam_errors"
        ),
        F.struct(*failures()).alias("failure_counts_by_stage"),
    )


def names_where(condition: Column, name: str = "frame_name", order: str = "csv_row_number") -> Column:
    """Names of a group's rows that meet the condition, in manifest order."""
    found = F.array_sort(F.collect_list(F.when(condition, F.struct(order, name))))
    return F.transform(found, lambda s: s[name])


def first_and_last(condition: Column, name: str = "frame_name", order: str = "csv_row_number") -> list[Column]:
    at = F.when(condition, F.col(order))
    return [F.min_by(name, at).alias("first_valid_frame"), F.max_by(name, at).alias("last_valid_frame")]


def roll_up(frames: DataFrame, status_col: str, failed_status: str, what: str) -> DataFrame:
    """(sequence_id, status, failure_reason) after a stage: failed when any of its frames is."""
    n = F.count_if(F.col(status_col) == "failed")
    return frames.groupBy("sequence_id").agg(
        F.when(n > 0, failed_status).otherwise("ready").alias("status"),
        F.when(n > 0, F.concat(n.cast("string"), F.lit(f" frame(s) failed {what}"))).alias("failure_reason"),
    )


def seam_delta(px: DataFrame, keys: list[str], width: int, value: str = "v") -> DataFrame:
    """Mean absolute difference of the first and the last column of a value relation (keys, y, x, value)."""
    sides = px.where((F.col("x") == 0) | (F.col("x") == width - 1)).groupBy(*keys, "y").agg(
        F.max(F.when(F.col("x") == 0, F.col(value))).alias("left"),
        F.max(F.when(F.col("x") == width - 1, F.col(value))).alias("right"),
    )
    return sides.groupBy(*keys).agg(F.avg(F.abs(F.col("left") - F.col("right"))).alias("seam_delta"))


def status_counts(wanted: dict[str, tuple[str, str]]) -> list[Column]:
    """Aggregates that count the rows whose status column has a value: {name: (column, value)}."""
    return [F.count_if(F.col(column) == value).alias(name) for name, (column, value) in wanted.items()]
