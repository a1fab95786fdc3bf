"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python kernel holds as word lists at a time.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data directory through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    master may go without; it then gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if named:
            sc.setCheckpointDir(named)
        elif sc.master == "local" or sc.master.startswith("local["):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="orbiscope-ckpt-"))
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Inside higher-order functions a repeated expression is evaluated for every
    use and every element; a one-element ``transform`` binds it to a variable.
    """
    return F.transform(F.array(value), body)[0]


def crc32_mod(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo ``n`` (null key: null)."""
    return F.crc32(key.cast("string").cast("binary")) % n


#: Bits of an id bitmap: 16 for every id within these bounds (16 MiB at most, whatever the size of the input).
LEAST_BITS = 1 << 16
BITMAP_BITS = 1 << 27


def id_bitmap(ids: DataFrame):
    """A bitmap (bytes) of a column of integer ids, each modulo the number of bits.

    It only pre-filters: an exact join follows, and a full bitmap lets everything through.
    """
    import numpy as np

    n = ids.count()
    bits = min(BITMAP_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))
    bit = F.pmod(F.col(ids.columns[0]), F.lit(bits))
    words = (
        ids.select((bit / 32).cast("long").alias("word"), F.pmod(bit, F.lit(32)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    )
    out = np.zeros(bits // 32, "<u4")
    for row in words.where("word IS NOT NULL").toLocalIterator():
        out[row.word] = row.mask
    return out.view(np.uint8)


def in_bitmap(bitmap, ids):
    """Whether each of ``ids`` (integers without nulls) may be in the bitmap."""
    at = ids % (8 * len(bitmap))
    return (bitmap[at >> 3] >> (at & 7)) & 1 == 1


def maybe_in(docs: DataFrame, bitmap, key: Column) -> Column:
    """A condition on rows of ``docs``: false only where ``key`` (a long, not null) is not in the broadcast bitmap."""
    import numpy as np

    @F.pandas_udf("boolean")
    def listed(keys: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, keys.to_numpy(np.int64)))

    return listed(key)


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids``, all columns kept.

    Only rows whose id is in the bitmap of ``ids`` are shuffled, for the exact
    anti-join; all others stay where they are.
    """
    ids = cut(ids)
    gone = ids.select(F.col(ids.columns[0]).alias("_gone")).distinct()
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids))
    marked = maybe_in(docs, bitmap, F.coalesce(F.col(id_col).cast("long"), F.lit(-1))) & F.col(id_col).isNotNull()
    rest = docs.where(marked)
    return docs.where(~marked).unionByName(rest.join(gone, rest[id_col] == gone["_gone"], "left_anti"))


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of whole rows with about ``limit`` bytes of text each."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def broadcast_value(spark: SparkSession, value: object, limit: int, what: str):
    """Broadcast ``value`` if its pickled size is within ``limit`` bytes."""
    import pickle

    size = len(pickle.dumps(value, protocol=5))
    if size > limit:
        raise ValueError(f"{what}: {size} bytes exceed the broadcast bound of {limit}")
    return spark.sparkContext.broadcast(value)
