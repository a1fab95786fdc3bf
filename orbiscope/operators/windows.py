"""Overlapping count windows over a sequence's valid frames, their chunks and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def check_settings(size: int, stride: int) -> None:
    if size < 2:
        raise ValueError("window size must be at least 2")
    if not 1 <= stride < size:
        raise ValueError("window stride must be at least 1 and less than the window size")


def valid_positions(frames: DataFrame, order: str = "csv_row_number") -> DataFrame:
    """The existing frames with ``position``, their place among them from 0."""
    w = Window.partitionBy("sequence_id").orderBy(order)
    return frames.where("file_exists").withColumn("position", F.row_number().over(w) - 1)


def valid_order_index(order: str = "csv_row_number") -> Column:
    """Place among the existing frames, null for a missing one; over all rows of a sequence."""
    w = Window.partitionBy("sequence_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.when(F.col("file_exists"), F.sum(F.col("file_exists").cast("int")).over(w) - 1).cast("int")


def window_starts(n: Column, size: int, stride: int) -> Column:
    """Starts of the windows over ``n`` frames; the last one is moved back to end with the last frame."""
    last = F.greatest(F.ceil((n - size) / F.lit(stride)), F.lit(0)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: F.greatest(F.least(i * stride, n - size), F.lit(0)))
    return F.when(n > 0, starts).otherwise(F.array().cast("array<int>"))


def plan(counts: DataFrame, size: int, stride: int) -> DataFrame:
    """(sequence_id, window_index, start, end) from (sequence_id, n); a closed form, no iteration."""
    check_settings(size, stride)
    counts = counts.select("sequence_id", F.col("n").cast("int").alias("n"))
    n = F.col("n")
    placed = counts.select("sequence_id", "n", F.posexplode(window_starts(n, size, stride)).alias("window_index", "start"))
    return placed.select("sequence_id", "window_index", "start", F.least(F.col("start") + size, "n").alias("end"))


def plan_for_frames(frames: DataFrame, size: int, stride: int) -> DataFrame:
    """Windows over the existing frames of each sequence, with the row numbers of their frames."""
    check_settings(size, stride)
    rows = (
        frames.where("file_exists")
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list("csv_row_number")).alias("rows"), F.count("*").cast("int").alias("n"))
    )
    n = F.col("n")
    placed = rows.select("sequence_id", "rows", "n", F.posexplode(window_starts(n, size, stride)).alias("window_index", "start"))
    end = F.least(F.col("start") + size, "n")
    return placed.select(
        "sequence_id",
        "window_index",
        "start",
        end.alias("end"),
        F.slice("rows", F.col("start") + 1, end - F.col("start")).alias("frame_indices"),
    )


def members(windows: DataFrame) -> DataFrame:
    """(sequence_id, window_index, position): every frame position of every window."""
    return windows.select(
        "sequence_id", "window_index", "start", "end", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("position")
    )


def chunks(windows: DataFrame, chunk_size: int) -> DataFrame:
    """(sequence_id, window_index, chunk_index, position): each window in consecutive slices."""
    size = max(1, chunk_size)
    return members(windows).select(
        "sequence_id",
        "window_index",
        F.floor((F.col("position") - F.col("start")) / size).cast("int").alias("chunk_index"),
        "position",
    )


def reconcile(windows: DataFrame) -> DataFrame:
    """(sequence_id, position, window_index): the window whose centre is closest, then the earlier one.

    An aggregation, not a range join: windows are exploded to their positions.
    """
    centre = (F.col("start") + F.col("end") - 1) / 2
    by = F.struct(F.abs(F.col("position") - centre), "start", "window_index")
    return members(windows).groupBy("sequence_id", "position").agg(F.min_by("window_index", by).alias("window_index"))


def take_predictions(assignment: DataFrame, predictions: DataFrame) -> DataFrame:
    """The assigned window's prediction for every position; ``missing`` marks those without one."""
    keys = ["sequence_id", "window_index", "position"]
    found = predictions.withColumn("_there", F.lit(True))
    return assignment.join(found, keys, "left").withColumn("missing", F.col("_there").isNull()).drop("_there")


def sampled_positions(n: Column, k: int) -> Column:
    """``k`` evenly spread positions of ``n``, rounded half to even; all where there are no more than ``k``."""
    if k <= 0:
        return F.array().cast("array<int>")
    whole = F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    if k == 1:
        return F.when(n <= 1, whole).otherwise(F.array(F.lit(0)))
    step = (n - 1) / F.lit(k - 1)
    spread = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.rint(i * step).cast("int"))
    return F.when(n <= k, whole).otherwise(spread)
