"""Masks and images as packed rasters: one BINARY column per raster, row-major, with its dimensions.

All operators here are map-side: a kernel sees one row at a time, nothing is
shuffled, and a row's failure becomes a value, never a failed task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orbiscope.functions import kernels


def with_kernel(df: DataFrame, kernel: Callable[..., tuple], inputs: list[str], outputs: str) -> DataFrame:
    """Add the columns ``outputs`` (a DDL string), computed from ``inputs`` row by row in Arrow batches.

    ``kernel(*values)`` returns one value per output column.  Only the input
    columns are decoded; all others pass through as they are.
    """
    added = T.StructType.fromDDL(outputs)
    schema = T.StructType([*df.schema.fields, *added.fields])
    kinds = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs]
            rows = [kernel(*values) for values in zip(*columns, strict=True)] if columns else []
            made = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            arrays = [pa.array(c, f.type) for c, f in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *kinds.names])

    return df.mapInArrow(run, schema)


def view(data: bytes, height: int, width: int) -> np.ndarray:
    """A mask column's value as an array."""
    return np.frombuffer(data, np.uint8).reshape(height, width)


def map_mask(df: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], column: str = "mask") -> DataFrame:
    """``df`` with its mask replaced by ``kernel(mask)``; null masks stay null."""

    def one(data, height, width):
        if data is None:
            return (None,)
        return (kernel(view(data, height, width)).tobytes(),)

    made = with_kernel(df, one, [column, "height", "width"], "_made binary")
    return made.withColumn(column, F.col("_made")).drop("_made")


def pack_values(values: Column, test: Callable[[Column], Column]) -> Column:
    """BINARY mask from an array of values, 255 where ``test`` holds.  Stays inside Catalyst."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.when(test(v), "FF").otherwise("00")), ""))


def unpack(df: DataFrame, keys: list[str], column: str = "mask") -> DataFrame:
    """Pixel rows (keys, y, x) of the foreground; a null mask has none.  Map-side, linear in the raster's size."""
    rows = df.select(*keys, "width", F.col(column).alias("_mask"))
    schema = T.StructType([*rows.schema.fields[: len(keys)], *T.StructType.fromDDL("y int, x int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, masks = batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1)
            for i in range(batch.num_rows):  # one raster's pixels at a time
                mask = masks[i].as_buffer()
                if mask is None or not widths[i]:
                    continue
                y, x = np.divmod(np.flatnonzero(np.frombuffer(mask, np.uint8)), widths[i])
                at = pa.array(np.full(len(y), i), pa.int64())
                key = [batch.column(c).take(at) for c in range(len(keys))]
                yield pa.record_batch([*key, pa.array(y, pa.int32()), pa.array(x, pa.int32())], names=schema.names)

    return rows.mapInArrow(run, schema)


def pack(px: DataFrame, keys: list[str], height: int, width: int) -> DataFrame:
    """Packed masks from pixel rows; rasters without foreground have no row."""
    cells = px.groupBy(*keys).agg(F.collect_set((F.col("y") * width + F.col("x")).cast("int")).alias("cells"))

    def one(cells):
        out = np.zeros(height * width, np.uint8)
        out[cells] = 255
        return (out.tobytes(),)

    packed = with_kernel(cells, one, ["cells"], "mask binary")
    return packed.select(*keys, F.lit(height).alias("height"), F.lit(width).alias("width"), "mask")


# --- one mask --------------------------------------------------------------------------------------------------------


def dilate(df: DataFrame, radius: int, wrap_x: bool = False) -> DataFrame:
    return map_mask(df, lambda m: kernels.dilate(m, radius, wrap_x))


def erode(df: DataFrame, radius: int, wrap_x: bool = False) -> DataFrame:
    return map_mask(df, lambda m: kernels.erode(m, radius, wrap_x))


def fill_holes(df: DataFrame) -> DataFrame:
    return map_mask(df, kernels.fill_holes)


def drop_small(df: DataFrame, min_area: int) -> DataFrame:
    return map_mask(df, lambda m: kernels.drop_small(m, min_area))


def majority_smooth(df: DataFrame, iterations: int, wrap_x: bool) -> DataFrame:
    return map_mask(df, lambda m: kernels.majority_smooth(m, iterations, wrap_x))


def top_run(df: DataFrame, seed_fraction: float) -> DataFrame:
    return map_mask(df, lambda m: kernels.top_run(m, seed_fraction))


def clean(df: DataFrame, min_area: int, dilate_px: int, erode_px: int = 0) -> DataFrame:
    return map_mask(df, lambda m: kernels.clean_mask(m, min_area, dilate_px, erode_px))


def measures(df: DataFrame) -> DataFrame:
    """``df`` plus area, ratio and the number of 8-connected components."""

    def one(data, height, width):
        m = view(data, height, width)
        return int(np.count_nonzero(m)), kernels.mask_ratio(m), kernels.count_components(m)

    return with_kernel(df, one, ["mask", "height", "width"], "area long, ratio double, components int")


def fold_masks(df: DataFrame, keys: list[str], column: str, whole: bool = False) -> DataFrame:
    """The union of each key's masks within a batch, or with ``whole`` within a partition; null masks are left out.

    A partition is held as one mask per key; rows of a key must lie in one partition for a whole union.
    """
    rows = df.select(*keys, column).where(F.col(column).isNotNull())
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            made = [*([k[c] for k in held] for c in range(len(keys))), [m.tobytes() for m in held.values()]]
            held.clear()
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(made, kinds, strict=True)], schema=kinds)

        kinds = to_arrow_schema(schema)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(len(keys) + 1)]
            for *key, mask in zip(*columns, strict=True):
                new, old = np.frombuffer(mask, np.uint8), held.get(tuple(key))
                held[tuple(key)] = new if old is None else np.maximum(old, new)
            if not whole:
                yield out()
        yield out()

    return rows.mapInArrow(run, schema)


# --- several masks of a frame, or of its neighbours ------------------------------------------------------------------


def combine(df: DataFrame, columns: list[str], kernel: Callable[..., np.ndarray], output: str) -> DataFrame:
    """Add mask ``output`` from several mask columns of the same row; null inputs reach the kernel as None."""

    def one(height, width, *masks):
        made = kernel(*[None if m is None else view(m, height, width) for m in masks])
        return (None if made is None else made.tobytes(),)

    return with_kernel(df, one, ["height", "width", *columns], f"{output} binary")


def temporal_consistency(df: DataFrame, sequence: str = "sequence_id", order: str = "frame_idx", columns=("mask",)) -> DataFrame:
    """Add to every mask the pixels that the adjacent rows of its sequence both have, where their shapes agree.

    One shuffle by sequence for the neighbours; the combination is map-side.
    """
    w = Window.partitionBy(sequence).orderBy(order)
    out = df
    for c in columns:
        for name, at in (("before", -1), ("after", 1)):
            near = F.lag if at < 0 else F.lead
            same = (near("height").over(w) == F.col("height")) & (near("width").over(w) == F.col("width"))
            out = out.withColumn(f"_{c}_{name}", F.when(same, near(c).over(w)))

        def own(mask, before, after):
            if mask is None or before is None or after is None:
                return mask
            return kernels.as_mask((mask > 0) | ((before > 0) & (after > 0)))

        out = combine(out, [c, f"_{c}_before", f"_{c}_after"], own, "_made")
        out = out.withColumn(c, F.col("_made")).drop("_made", f"_{c}_before", f"_{c}_after")
    return out


def roof_decisions(df: DataFrame, window: int, fraction: float, margin: float, min_iou: float) -> DataFrame:
    """Add roof_mask, roof_mask_source, roof_mask_temporal_disagreement and roof_mask_error.

    ``df`` has one row per frame: sequence_id, frame_idx, height, width (of the
    lower face) and ``candidate``, null where there is none.  Votes come from
    the ``window`` rows on either side with the same shape.
    """
    span = Window.partitionBy("sequence_id").orderBy("frame_idx").rowsBetween(-window, window)
    near = F.collect_list(F.struct("frame_idx", "height", "width", "candidate")).over(span)
    voters = F.transform(
        F.filter(
            "_near",
            lambda n: (n["frame_idx"] != F.col("frame_idx"))
            & n["candidate"].isNotNull()
            & (n["height"] == F.col("height"))
            & (n["width"] == F.col("width")),
        ),
        lambda n: n["candidate"],
    )

    def one(candidate, height, width, neighbours):
        own = None if candidate is None else view(candidate, height, width)
        vote = kernels.temporal_vote([view(n, height, width) for n in neighbours]) if window > 0 else None
        mask, source, disagreement, error = kernels.roof_decision(own, vote, (height, width), fraction, margin, min_iou)
        return mask.tobytes(), source, disagreement, error

    joined = df.withColumn("_near", near).withColumn("_voters", voters).drop("_near")
    outputs = "roof_mask binary, roof_mask_source string, roof_mask_temporal_disagreement boolean, roof_mask_error string"
    decided = with_kernel(joined, one, ["candidate", "height", "width", "_voters"], outputs).drop("_voters")
    fallback = F.endswith("roof_mask_source", F.lit("_fallback"))
    return decided.withColumn("roof_mask_status", F.when(fallback, "fallback").otherwise("generated"))
