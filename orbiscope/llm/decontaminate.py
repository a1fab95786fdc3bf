"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``window`` words (an item with fewer words,
but not none, is one window).  A window is the set of its positioned shingles of
``shingle`` words.  Full containment needs every shingle of the window, so one
shingle is a sufficient prefix: after ordering shingles by rarity over all
documents, only the rarest one of each window is joined with the documents'
shingles.  Length and position bounds then drop candidates that would reach
over either end of the document, and the survivors are compared word by word.

The items are read in blocks of at most ``block_words`` words; a block's index
is broadcast (its size is bounded by that parameter, and checked) and every
block is held against all documents, so any number of items works.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orbiscope.llm.common import BITMAP_BITS, broadcast_value, cut, slices, without_ids

#: Bytes that belong to words, lower-cased; every other byte becomes a blank.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


#: Bytes of a block's index that may be broadcast; a block of BLOCK_WORDS words needs a fraction of it.
INDEX_BYTES = 512 << 20
BLOCK_WORDS = 250_000


def hits_schema(items: DataFrame, id_col: str) -> str:
    """The columns of what is found in one document row."""
    kind = items.schema[id_col].dataType.simpleString()
    return f"n_words long, n_hit long, starts array<long>, lengths array<long>, items array<{kind}>"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words (letters a-z, digits and everything beyond ASCII)."""
    return text.translate(WORD_BYTES).split() if text else []


@dataclass
class WindowIndex:
    """The distinct windows of one block of items, and which shingle of each is joined."""

    window: int
    shingle: int
    ids: dict[bytes, int] = field(default_factory=dict)  # word -> 1.., 0 is any other word
    windows: dict[tuple[int, ...], list[int]] = field(default_factory=dict)  # word ids -> items
    prefix: dict[int, list[tuple[int, tuple[int, ...], list[int]]]] = field(default_factory=dict)
    short: dict[int, list[tuple[int, tuple[int, ...], list[int]]]] = field(default_factory=dict)
    codes: np.ndarray | None = None
    wanted: np.ndarray | None = None

    def add(self, item: int, text: bytes) -> None:
        words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
        for a in range(max(1, len(words) - self.window + 1)):
            if w := tuple(words[a : a + self.window]):
                items = self.windows.setdefault(w, [])
                if item not in items:
                    items.append(item)

    def code(self, ids: np.ndarray) -> np.ndarray:
        """One number per shingle start; 0 where a word is in no item.  Exact: a positional code of the word ids."""
        k, base = self.shingle, len(self.ids) + 1
        n = len(ids) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for j in range(k):
            part = ids[j : j + n]
            out = out * np.uint64(base) + part.astype(np.uint64)
            known &= part > 0
        return np.where(known, out, np.uint64(0))

    def close(self) -> None:
        """Collect the codes of all shingles of all windows."""
        found = [self.code(np.array(w)) for w in self.windows if len(w) >= self.shingle]
        self.wanted = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def wanted_counts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows' shingles among ``codes`` and how often each occurs."""
        if not len(self.wanted):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.searchsorted(self.wanted, codes)
        at[at == len(self.wanted)] = 0
        return np.unique(codes[self.wanted[at] == codes], return_counts=True)

    def choose(self, counts: dict[int, int]) -> None:
        """Join every window by its rarest shingle; windows shorter than a shingle by their first word."""
        for w, items in self.windows.items():
            if len(w) < self.shingle:
                self.short.setdefault(w[0], []).append((0, w, items))
                continue
            codes = [int(c) for c in self.code(np.array(w))]
            at = min(range(len(codes)), key=lambda i: (counts.get(codes[i], 0), codes[i], i))
            self.prefix.setdefault(codes[at], []).append((at, w, items))
        self.codes = np.array(sorted(self.prefix), np.uint64)

    def encode(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(start, length, items) of every occurrence of a window in a document."""
        n = len(ids)
        candidates: list[tuple[int, dict, int]] = []
        if len(self.codes) and n >= self.shingle:
            codes = self.code(ids)
            at = np.searchsorted(self.codes, codes)
            at[at == len(self.codes)] = 0
            for p in np.flatnonzero((self.codes[at] == codes) & (codes > 0)):
                candidates.append((int(p), self.prefix, int(codes[p])))
        if self.short:
            for p in np.flatnonzero(np.isin(ids, np.array(list(self.short)))):
                candidates.append((int(p), self.short, int(ids[p])))
        for p, index, key in candidates:
            for offset, w, items in index[key]:
                start = p - offset
                # position and length bounds, then the exact comparison
                if start >= 0 and start + len(w) <= n and tuple(ids[start : start + len(w)].tolist()) == w:
                    yield start, len(w), items


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, block_words: int, window: int
) -> Iterator[list[tuple[object, bytes]]]:
    """Items in blocks of at most ``block_words`` words, through the driver one partition at a time.

    A longer item comes in parts that overlap by a window less a word, which have the same windows.
    """
    block: list[tuple[object, bytes]] = []
    words = 0
    for row in items.select(F.col(id_col), F.col(text_col)).dropna().toLocalIterator():
        found = words_of(row[1].encode())
        step = max(1, block_words - window + 1)
        for a in range(0, max(1, len(found) - window + 1), step):
            part = found[a : a + step + window - 1]
            if block and words + len(part) > block_words:
                yield block
                block, words = [], 0
            block.append((row[0], b" ".join(part)))
            words += len(part)
    yield block


def _count_kernel(index):
    def count(batches):
        for batch in batches:
            for part in slices(batch, 0):
                ids, index_ = [], index.value
                for text in part.column(0).cast(pa.binary()).to_pylist():
                    ids.append(index_.encode(words_of(text)))
                    ids.append(np.zeros(1, np.int64))  # no shingle reaches over two documents
                seen, n = index_.wanted_counts(index_.code(np.concatenate(ids)))
                yield pa.record_batch([pa.array(seen.astype(np.int64)), pa.array(n)], names=["code", "n"])

    return count


def _hit_kernel(index, first: bool, item_kind: pa.DataType):
    def find(batches):
        for batch in batches:
            at_text = batch.num_columns - 1  # after the columns that name the row
            for part in slices(batch, at_text):
                index_ = index.value
                rows, n_words, n_hit, starts, lengths, items = [], [], [], [], [], []
                for row, text in enumerate(part.column(at_text).cast(pa.binary()).to_pylist()):
                    words = words_of(text)
                    found = list(index_.hits(index_.encode(words))) if words else []
                    if not (found or first):
                        continue
                    spans: list[list[int]] = []
                    for a, b in sorted((a, a + n) for a, n, _ in found):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    rows.append(row)
                    n_words.append(len(words))
                    n_hit.append(sum(b - a for a, b in spans))
                    starts.append([a for a, _ in spans])
                    lengths.append([b - a for a, b in spans])
                    items.append(sorted({x for _, _, xs in found for x in xs}))
                longs = pa.list_(pa.int64())
                at = pa.array(rows, pa.int64())
                yield pa.record_batch(
                    [
                        *(part.column(c).take(at) for c in range(at_text)),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array(starts, longs),
                        pa.array(lengths, longs),
                        pa.array(items, pa.list_(item_kind)),
                    ],
                    names=[*batch.schema.names[:at_text], "n_words", "n_hit", "starts", "lengths", "items"],
                )

    return find


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row in ``_row``, materialised once so that every scan sees the same numbers.

    Numbers of different partitions differ also modulo the bits of an id bitmap.
    """
    shift = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(BITMAP_BITS))
    return cut(docs.withColumn("_row", F.monotonically_increasing_id() + shift))


def find_overlap(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shingle: int = 3,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(key, n_words, n_hit, starts, lengths, items) per document row.

    ``starts`` and ``lengths`` are the merged word ranges that occurrences of
    windows cover, ``items`` the ids with an occurring window, ascending.  Null
    and empty texts have no words and no hits.  Items without id or without
    words have no windows; repeated item ids count once.  Document rows with the
    same id each get a row.  Word ids are exact, never hashed; ``block_words``
    bounds the vocabulary so that three of them fit one 64-bit code.

    One block of items needs two map-side scans of the documents and no shuffle
    of them.  With several, keys and texts are materialised once with a number
    per row; further blocks add rows (hits alone) to a final aggregation by it.
    """
    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    key_type = keyed.schema["key"].dataType.simpleString()
    schema = f"key {key_type}, {hits_schema(items, item_id_col)}"
    item_kind = to_arrow_type(items.schema[item_id_col].dataType)
    parts: list[DataFrame] = []
    for index, last in _indexes(docs.select(F.col(text_col)), items, item_id_col, item_text_col, window, shingle, block_words):
        if not parts:
            if last:
                return keyed.mapInArrow(_hit_kernel(index, True, item_kind), schema)
            rows = _numbered(keyed).select("_row", "key", F.col(text_col))
        parts.append(cut(rows.mapInArrow(_hit_kernel(index, not parts, item_kind), f"_row long, {schema}")))
    return _merge(parts)


def _indexes(texts: DataFrame, items: DataFrame, id_col: str, text_col: str, window: int, shingle: int, block_words: int):
    """(broadcast index, whether it is the last) of every block of items; each counts its shingles in all documents."""
    if (block_words + 1) ** shingle >= 1 << 64:
        raise ValueError("block_words ** shingle must stay below 2 ** 64")
    spark = texts.sparkSession
    blocks = item_blocks(items, id_col, text_col, block_words, window)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        index = WindowIndex(window, shingle)
        for item, text in block:
            index.add(item, text)
        index.close()
        shared = broadcast_value(spark, index, INDEX_BYTES, "block of items")
        counted = (
            texts.mapInArrow(_count_kernel(shared), "code long, n long")
            .groupBy("code")
            .agg(F.sum("n").alias("n"))
        )
        # at most one row for each shingle of this block of items
        index.choose({row.code % (1 << 64): row.n for row in counted.toLocalIterator()})
        shared.destroy()
        yield broadcast_value(spark, index, INDEX_BYTES, "block of items"), following is None
        block = following


def _merge(parts: list[DataFrame]) -> DataFrame:
    """Unite the hits of several blocks of items per document row."""
    from functools import reduce

    def united(batches):
        for batch in batches:
            starts, lengths, hit = [], [], []
            for pairs in batch.column(batch.schema.get_field_index("ranges")).to_pylist():
                spans: list[list[int]] = []
                for a, n in sorted((x["a"], x["n"]) for x in pairs):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], a + n)
                    else:
                        spans.append([a, a + n])
                starts.append([a for a, _ in spans])
                lengths.append([b - a for a, b in spans])
                hit.append(sum(b - a for a, b in spans))
            longs = pa.list_(pa.int64())
            keep = {n: batch.column(batch.schema.get_field_index(n)) for n in ("key", "n_words", "items")}
            yield pa.record_batch(
                [keep["key"], keep["n_words"], pa.array(hit, pa.int64()), pa.array(starts, longs), pa.array(lengths, longs), keep["items"]],
                names=["key", "n_words", "n_hit", "starts", "lengths", "items"],
            )

    everything = reduce(DataFrame.unionByName, parts)
    ranges = F.flatten(
        F.collect_list(F.zip_with("starts", "lengths", lambda a, n: F.struct(a.alias("a"), n.alias("n"))))
    )
    grouped = everything.groupBy("_row").agg(
        F.first("key").alias("key"),
        F.max("n_words").alias("n_words"),
        ranges.alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return grouped.mapInArrow(united, parts[0].drop("_row").schema)


def items_digest(items: list[int]) -> str:
    """sha256 of the item ids, sorted as strings, comma-joined."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def digest_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns from ``find_overlap``."""
    found = find_overlap(docs, items)
    as_text = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(as_text, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    window: int = 10,
    shingle: int = 3,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns kept.  Null and empty texts stay.

    Every row goes by its own text, whatever its id.  With one block of items
    rows are dropped where they are read; with several, ``docs`` is materialised
    once with a number per row, and rows go by the numbers that have hits.
    """
    indexes = _indexes(docs.select(F.col(text_col)), items, "item_id", "text", window, shingle, block_words)
    index, last = next(indexes)
    if last:

        def clean(batches):
            for batch in batches:
                at = batch.schema.get_field_index(text_col)
                for part in slices(batch, at):
                    texts = part.column(at).cast(pa.binary()).to_pylist()
                    found = index.value
                    keep = [next(found.hits(found.encode(words_of(t))), None) is None for t in texts]
                    yield part.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    rows = _numbered(docs)
    texts = rows.select("_row", F.col(text_col))
    schema, item_kind = f"_row long, {hits_schema(items, 'item_id')}", to_arrow_type(items.schema["item_id"].dataType)
    hit = cut(texts.mapInArrow(_hit_kernel(index, False, item_kind), schema).select("_row"))
    for index, _ in indexes:
        hit = hit.unionByName(cut(texts.mapInArrow(_hit_kernel(index, False, item_kind), schema).select("_row")))
    return without_ids(rows, hit, "_row").drop("_row")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS k, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM grams JOIN win USING (k, n)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
