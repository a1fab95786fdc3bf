"""Detections: threshold, class-aware non-maximum suppression and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbiscope.functions.exprs import box_iou

BOX = ("x0", "y0", "x1", "y1")


def above(df: DataFrame, threshold: float) -> DataFrame:
    return df.where(F.col("score") >= threshold)


def suppress(df: DataFrame, keys: list[str], class_col: str, max_iou: float, ties: list[str]) -> DataFrame:
    """Greedy non-maximum suppression within each class: (keys, class, boxes kept, ``rank``).

    By falling score a box is kept unless its overlap with a kept box of its
    class is over ``max_iou``.  ``rank`` orders a key's kept boxes by falling
    score, then class, then ``ties``.  The fold runs on one sorted array per
    (key, class); a class of one frame's face is as large as a detector's output
    for it, so the array is bounded by the detector.
    """
    order = [(-F.col("score")).alias("_by"), *[F.col(c).alias(c) for c in ties]]
    fields = ["score", *BOX, *[c for c in ties if c not in ("score", *BOX)]]
    box = F.struct(*order, *[F.col(c).alias(c) for c in fields if c not in ties])
    grouped = df.groupBy(*keys, class_col).agg(F.array_sort(F.collect_list(box)).alias("boxes"))

    def corners(b: Column) -> tuple[Column, ...]:
        return tuple(b[c].cast("double") for c in BOX)

    def step(kept: Column, b: Column) -> Column:
        clash = F.exists(kept, lambda k: box_iou(corners(k), corners(b)) > max_iou)
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(b)))

    none = F.filter("boxes", lambda _: F.lit(False))
    kept = grouped.select(*keys, class_col, F.explode(F.aggregate("boxes", none, step)).alias("b"))
    flat = kept.select(*keys, class_col, *[F.col(f"b.{c}").alias(c) for c in fields])
    from pyspark.sql import Window

    ranked = Window.partitionBy(*keys).orderBy(F.col("score").desc(), class_col, *[c for c in ties if c != "score"])
    return flat.withColumn("rank", F.row_number().over(ranked))


def counts(raw: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes per key before and after suppression."""
    before = raw.groupBy(*keys).agg(F.count("*").alias("raw_count"))
    after = kept.groupBy(*keys).agg(F.count("*").alias("kept_count"))
    return before.join(after, keys, "left").select(*keys, "raw_count", F.coalesce("kept_count", F.lit(0)).alias("kept_count"))


def overlaps(df: DataFrame, keys: list[str], class_col: str, id_col: str, max_iou: float) -> DataFrame:
    """Pairs of one key's and class's boxes whose overlap is over ``max_iou``, smaller id first."""
    a, b = df.alias("a"), df.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*keys, class_col)]
    joined = a.join(b, [*same, F.col(f"a.{id_col}") < F.col(f"b.{id_col}")])
    iou = box_iou(*[tuple(F.col(f"{t}.{c}").cast("double") for c in BOX) for t in ("a", "b")])
    return joined.select(
        *[F.col(f"a.{k}").alias(k) for k in (*keys, class_col)],
        F.col(f"a.{id_col}").alias("id_a"),
        F.col(f"b.{id_col}").alias("id_b"),
        iou.alias("iou"),
    ).where(F.col("iou") > max_iou)


def resolve_targets(labels: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """(target, class_id): the first alias that ``labels`` (class_id, name) has; null where none is there.

    Of several labels that normalise to one alias the last class id counts.
    """
    from orbiscope.functions.exprs import detection_label

    spark = labels.sparkSession
    rows = [(t, i, a) for t, names in aliases.items() for i, a in enumerate(names)]
    wanted = F.broadcast(spark.createDataFrame(rows, "target string, place int, alias string"))  # as many rows as aliases
    named = labels.select(detection_label(F.col("name")).alias("alias"), "class_id").groupBy("alias").agg(F.max("class_id").alias("class_id"))
    return (
        wanted.join(named, "alias", "left")
        .groupBy("target")
        .agg(F.min_by("class_id", F.when(F.col("class_id").isNotNull(), F.col("place"))).alias("class_id"))
    )
