"""Column expressions: paths, labels, boxes, statuses and text encodings.  All of them stay inside Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbiscope.functions.kernels import roof_fraction  # noqa: F401  (a driver-side constant of the roof prior)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


# --- paths and names -------------------------------------------------------------------------------------------------


def normal_path(path: Column) -> Column:
    """The path without '.', '..', doubled and trailing slashes."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(p))
        ),
    )
    return F.concat(F.when(F.startswith(path, F.lit("/")), "/").otherwise(""), F.array_join(kept, "/"))


def resolve_frame_path(sequence_dir: Column, raw: Column, home: str = "~") -> Column:
    """Where a manifest's path points to: kept if any part is ``fixed``, else ``<sequence>/fixed/<name>``."""
    text = F.regexp_replace(F.trim(raw), r"^~(?=/|$)", home)
    full = F.when(F.startswith(text, F.lit("/")), text).otherwise(F.concat_ws("/", sequence_dir, text))
    fixed = F.concat_ws("/", sequence_dir, F.lit("fixed"), file_name(full))
    return normal_path(F.when(F.array_contains(F.split(full, "/"), "fixed"), full).otherwise(fixed))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def file_stem(name: Column) -> Column:
    """The name without its last suffix; a name that only starts with a dot keeps it."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")


def frame_number(stem: Column) -> Column:
    """The digits after a closing ``frame-``; null without them."""
    return F.nullif(F.regexp_extract(stem, r"frame-(\d+)$", 1), F.lit("")).try_cast("int")


# --- labels ----------------------------------------------------------------------------------------------------------


def detection_label(text: Column) -> Column:
    """Lower case, everything but a-z and 0-9 to single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def class_label(text: Column) -> Column:
    """Lower case, underscores and white space to single blanks, punctuation kept."""
    return F.trim(F.regexp_replace(F.translate(F.lower(text), "_", " "), r"\s+", " "))


# --- boxes -----------------------------------------------------------------------------------------------------------


def box_area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def box_center(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(((x0 + x1) / 2).alias("x"), ((y0 + y1) / 2).alias("y"))


def box_iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of (x0, y0, x1, y1) columns; 0 without area."""
    both = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(
        F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0)
    )
    either = box_area(*a) + box_area(*b) - both
    return F.when(either > 0, both / either).otherwise(F.lit(0.0))


def clip_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Column:
    """struct<x0, y0, x1, y1> within the raster; a side without length grows by one pixel where there is room."""

    def side(low: Column, high: Column, size: Column) -> tuple[Column, Column]:
        a = F.greatest(F.lit(0.0), F.least(low, size))
        b = F.greatest(F.lit(0.0), F.least(high, size))
        return a, F.when(b <= a, F.least(size, a + 1)).otherwise(b)

    (a, c), (b, d) = side(x0, x1, width.cast("double")), side(y0, y1, height.cast("double"))
    return F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))


# --- statuses and text encodings -------------------------------------------------------------------------------------


def is_out_of_memory(error: Column) -> Column:
    text = F.lower(error)
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in ("out of memory", "oom", "cuda memory")])


def manifest_text(column: Column, kind: str) -> Column:
    """A manifest cell: null is '', booleans 1 and 0, floats with eight decimals."""
    if kind == "boolean":
        return F.when(column, "1").otherwise("0")
    if kind in ("double", "float"):
        return F.when(column.isNull(), "").otherwise(F.format_string("%.8f", column))
    return F.coalesce(column.cast("string"), F.lit(""))


def used_backend(has_lama: Column, has_propainter: Column, lama_status: Column, propainter_status: Column, reason: Column) -> Column:
    """struct<lama, propainter>: what status or artifacts show was used; the image model wins over the video model."""
    lama = has_lama | (lama_status == "inpainted") | (F.coalesce(reason, F.lit("")) != "")
    return F.struct(lama.alias("lama"), (~lama & (has_propainter | (propainter_status == "inpainted"))).alias("propainter"))


def fallback_reason(
    startup: Column, forced: Column, longest_window: Column, largest_mask: Column, min_window: int, min_area: int
) -> Column:
    """Why a sequence goes to the image model; '' if it does not.  ``largest_mask`` is null where no frame was loaded."""
    shortest, area = max(1, min_window), max(0, min_area)
    too_short = F.format_string(
        "window_length_below_minimum_viable_size(max=%d, min=%d)", longest_window.cast("int"), F.lit(shortest)
    )
    too_small = F.format_string("mask_area_too_small(max=%d, threshold=%d)", largest_mask.cast("int"), F.lit(area))
    return (
        F.when(startup != "", startup)
        .when(forced, "force_single_frame_fallback")
        .when(longest_window < shortest, too_short)
        .when(F.lit(area > 0) & (largest_mask < area), too_small)
        .otherwise("")
    )
