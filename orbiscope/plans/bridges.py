"""The test tables read as the frame pipeline's relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbiscope.operators.rasters import pack_values

SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames from events: one sequence per user, rows in time order, error events as missing files."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("GS"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("sequence_id"),
        (F.row_number().over(w) - 1).alias("csv_row_number"),
        F.col("event_id").alias("frame_number"),
        (F.col("event_type") != "error").alias("file_exists"),
        F.col("event_type").alias("event_type"),
        F.col("value").alias("value"),
    )


def masks(spark: SparkSession, sf_dir: str, low: float = 0.0, name: str = "mask", reverse: bool = False) -> DataFrame:
    """8 x 8 masks from embeddings: foreground above ``low`` (below it with ``reverse``); one sequence per label."""
    w = Window.partitionBy("label").orderBy("vec_id")

    def on(v):
        return v < low if reverse else v > low

    return table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("sequence_id"),
        (F.row_number().over(w) - 1).alias("frame_idx"),
        F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"),
        pack_values(F.col("embedding"), on).alias(name),
    )


def pixels(spark: SparkSession, sf_dir: str, low: float = 0.0, reverse: bool = False) -> DataFrame:
    """The same masks as pixel rows."""
    w = Window.partitionBy("label").orderBy("vec_id")
    numbered = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("sequence_id"), (F.row_number().over(w) - 1).alias("frame_idx"), "embedding"
    )
    cells = numbered.select("sequence_id", "frame_idx", F.posexplode("embedding").alias("i", "v"))
    on = F.col("v") < low if reverse else F.col("v") > low
    return cells.where(on).select(
        "sequence_id", "frame_idx", F.floor(F.col("i") / SIDE).cast("int").alias("y"), (F.col("i") % SIDE).alias("x")
    )


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray values 0 to 255 per pixel of the same rasters."""
    w = Window.partitionBy("label").orderBy("vec_id")
    numbered = table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("sequence_id"), (F.row_number().over(w) - 1).alias("frame_idx"), "embedding"
    )
    cells = numbered.select("sequence_id", "frame_idx", F.posexplode("embedding").alias("i", "v"))
    level = F.greatest(F.lit(0), F.least(F.lit(255), F.floor(F.col("v").cast("double") * 128 + 128))).cast("int")
    return cells.select(
        "sequence_id", "frame_idx", F.floor(F.col("i") / SIDE).cast("int").alias("y"), (F.col("i") % SIDE).alias("x"), level.alias("v")
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes from line items."""
    x0, y0 = F.col("l_partkey") % 50, F.col("l_suppkey") % 40
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame"),
        (F.col("l_linenumber") % 6).cast("int").alias("face"),
        F.concat("l_returnflag", "l_linestatus").alias("cls"),
        x0.cast("double").alias("x0"),
        y0.cast("double").alias("y0"),
        (x0 + F.col("l_quantity")).cast("double").alias("x1"),
        (y0 + F.col("l_quantity")).cast("double").alias("y1"),
        F.round(F.pmod(F.col("l_extendedprice"), F.lit(1000.0)) / 1000, 6).alias("score"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_linenumber").alias("line"),
    )
