"""Sequence discovery and frame manifests."""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbiscope.config import Config
from orbiscope.schema import REQUIRED_FIELDS


def list_paths(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of everything that matches a glob, through Hadoop's file systems."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    plain = "://" not in pattern
    out = []
    for status in found or []:
        text = status.getPath().toUri().getPath() if plain else status.getPath().toString()
        out.append((text, status.isDirectory()))
    return sorted(out)


def discover_sequences(spark: SparkSession, config: Config, only: Iterable[str] | None = None) -> list[str]:
    """Names of the sequence folders, sorted; unknown names in ``only`` are ignored.

    One name per sequence folder: the catalogue, not the data, passes the driver.
    """
    wanted = set(only or ())
    names = [os.path.basename(p) for p, folder in list_paths(spark, f"{config.dataset_root}/{config.sequence_glob}") if folder]
    return [n for n in names if n.startswith("GS") and (not wanted or n in wanted)]


_PARSED = "csv_path string, fields array<string>, rows array<map<string,string>>"


def _parse(batches):
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            reader = csv.DictReader(io.StringIO(bytes(content).decode("utf-8"), newline=""))
            names = [(n or "").strip() for n in reader.fieldnames or []]
            reader.fieldnames = names
            rows = [{k: v or "" for k, v in r.items() if k is not None} for r in reader]
            out.append((path, names, rows))
        yield pd.DataFrame(out, columns=["csv_path", "fields", "rows"])


def read_manifests(spark: SparkSession, config: Config, only: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sequences, rows).

    ``sequences`` has every discovered sequence with ``missing_fields`` (null
    where there is no manifest); ``rows`` the manifest rows of the valid ones in
    file order, which is the time order: a file is read whole, never split.
    """
    names = discover_sequences(spark, config, only)
    listed = spark.createDataFrame([(n,) for n in names], "sequence_id string")
    paths = [p for p, folder in list_paths(spark, f"{config.dataset_root}/{config.sequence_glob}/{config.manifest_filename}") if not folder]
    if paths:
        files = spark.read.format("binaryFile").load(paths).select("path", "content")
        parsed = files.mapInPandas(_parse, _PARSED)
    else:
        parsed = spark.createDataFrame([], _PARSED)
    parsed = parsed.withColumn("csv_path", F.regexp_replace("csv_path", "^file:", ""))
    parsed = parsed.withColumn("sequence_id", F.element_at(F.split("csv_path", "/"), -2))
    required = F.array(*[F.lit(f) for f in REQUIRED_FIELDS])
    parsed = parsed.withColumn("missing_fields", F.array_except(required, "fields"))
    known = listed.join(parsed, "sequence_id", "left")
    sequences = known.select("sequence_id", "csv_path", "missing_fields", F.coalesce(F.size("rows"), F.lit(0)).alias("total_csv_rows"))
    valid = known.where(F.size("missing_fields") == 0)
    each = valid.select("sequence_id", "csv_path", F.posexplode("rows").alias("csv_row_number", "r"))
    cells = [F.coalesce(F.col("r")[f], F.lit("")).alias(f) for f in REQUIRED_FIELDS]
    index = F.coalesce(F.col("r")[""], F.col("csv_row_number").cast("string")).alias("source_index")
    return sequences, each.select("sequence_id", "csv_path", "csv_row_number", index, *cells)


def existing_frames(spark: SparkSession, config: Config) -> DataFrame:
    """(path) of the files in the sequences' frame folders; names only, no contents."""
    pattern = f"{config.dataset_root}/{config.sequence_glob}/fixed"
    folders = [p for p, folder in list_paths(spark, pattern) if folder]
    if not folders:
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    return files.select(F.regexp_replace("path", "^file:", "").alias("path"))
