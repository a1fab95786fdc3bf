"""Packing token sequences by minimum bin slack.

Documents are tokenized and followed by an end id.  Whole windows of
``capacity`` tokens come straight out of a long document; the tails that remain
form a pool.  For each next window a bitset subset-sum dynamic program finds the
multiset of remaining tail lengths whose sum comes closest to the capacity:
bit ``s`` of the set says whether some multiset of the lengths looked at so far
sums to ``s``, and the sets after each step lead back to the counts that were
taken.  What such a window still lacks is cut from the longest tail that
remains, whose rest goes back to the pool; so a window costs one cut at most.
When a pool runs out, the last window may stay partly empty; its tails move to
the next pool, and at a partition's end they are cut into sequences of
power-of-two lengths, which need no padding.

Pools are independent: each holds at most ``pool_tails`` tails of one partition,
so a task's memory is bounded and nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import slices

SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SEQUENCE_BITS = 36  # sequences of one partition: 2 ** 36 at most


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset {length: count} within ``counts`` whose sum is closest to, and at most, ``capacity``.

    Lengths are looked at from the longest; a length's copies enter in binary
    parts (1, 2, 4, ...), so the number of steps is logarithmic in its count.
    The program stops as soon as the capacity itself is reachable.
    """
    limit = (1 << (capacity + 1)) - 1
    goal = 1 << capacity
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, part = min(counts[length], capacity // length), 1
        while left > 0 and not reach & goal:
            n = min(part, left)
            steps.append((reach, length, n))
            reach |= (reach << (length * n)) & limit
            left -= n
            part *= 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, n in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + n
            total -= length * n
    return taken


def pack_lengths(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Fill windows one after another; each is a list of (position in ``lengths``, start, length).

    All lengths are within the capacity.  Every window but the last one is full.
    """
    pool: dict[int, list[tuple[int, int]]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        if lengths[i] > 0:
            pool.setdefault(lengths[i], []).append((i, 0))
    counts = {n: len(at) for n, at in pool.items()}
    windows = []

    def take(n: int) -> tuple[int, int]:
        counts[n] -= 1
        if not counts[n]:
            del counts[n]
        return pool[n].pop()

    while counts:
        # the longest remaining tail opens the window, so hard ones don't pile up at the end
        first = max(counts)
        window = [(*take(first), first)]
        room = capacity - first
        for n, c in fill_window(counts, room).items() if room else ():
            window += [(*take(n), n) for _ in range(c)]
            room -= n * c
        if room and counts:
            # every remaining tail is longer than the room, else the window would not be the closest one
            n = max(counts)
            i, start = take(n)
            window.append((i, start, room))
            pool.setdefault(n - room, []).append((i, start + room))
            counts[n - room] = counts.get(n - room, 0) + 1
        windows.append(window)
    return windows


def _binary_parts(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    """Pieces of one partition.  A piece is (key, start, length, ids, doc_tokens, sequence, offset)."""

    def __init__(self, partition: int, capacity: int, pool_tails: int):
        self.next_sequence = partition << SEQUENCE_BITS
        self.capacity, self.pool_tails = capacity, pool_tails
        self.tails: list[tuple] = []
        self.rows: list[tuple] = []

    def _emit(self, key, start, ids: bytes, total, sequence, offset) -> None:
        self.rows.append((key, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset))

    def add(self, key, ids: bytes) -> None:
        step, total = self.capacity * 4, len(ids) // 4
        whole = len(ids) // step * step
        for a in range(0, whole, step):
            self._emit(key, a // 4, ids[a : a + step], total, self.next_sequence, 0)
            self.next_sequence += 1
        if whole < len(ids):
            self.tails.append((key, whole // 4, ids[whole:], total))
            if len(self.tails) >= self.pool_tails:
                self.flush(last=False)

    def flush(self, last: bool) -> None:
        """Pack the pool.  The window that stays open returns to the pool, or is cut up at the end."""
        left: list[tuple] = []
        for window in pack_lengths([len(t[2]) // 4 for t in self.tails], self.capacity):
            pieces = []
            for i, at, n in window:
                key, start, ids, total = self.tails[i]
                pieces.append((key, start + at, ids[4 * at : 4 * (at + n)], total))
            if sum(n for _, _, n in window) < self.capacity:
                left = pieces  # the last one
                continue
            offset = 0
            for key, start, ids, total in pieces:
                self._emit(key, start, ids, total, self.next_sequence, offset)
                offset += len(ids) // 4
            self.next_sequence += 1
        if last:
            self._cut(left)
            left = []
        self.tails = left

    def _cut(self, tails: list[tuple]) -> None:
        """Lay the tails end to end, cut into full windows and then into power-of-two lengths."""
        rest = sum(len(t[2]) // 4 for t in tails)
        sizes = [self.capacity] * (rest // self.capacity) + _binary_parts(rest % self.capacity)
        room, offset = iter(sizes), 0
        size = next(room, 0)
        for key, start, ids, total in tails:
            at = 0
            while at < len(ids):
                n = min(len(ids) - at, (size - offset) * 4)
                self._emit(key, start + at // 4, ids[at : at + n], total, self.next_sequence, offset)
                at += n
                offset += n // 4
                if offset == size:
                    self.next_sequence += 1
                    size, offset = next(room, 0), 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


# Fixed value: the split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """ids of a text under a byte-level BPE vocabulary file, then the end id, as little-endian 32-bit bytes.

    The file's tokens are handed to a faster engine as ranks: in a byte-level
    vocabulary a merged token's id is its merge rank.  Texts that hold the
    string of a special token, and those with blanks too long for the engine's
    search, go to the tokenizer itself.
    """

    def __init__(self, path: str, end_id: int):
        import numpy as np
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in tokenizer.get_vocab(with_added_tokens=False).items()
            if token not in self.special
        }
        self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.slow = tokenizer
        self.end = np.array([end_id], "<u4")
        self.join = np.concatenate

    def ids(self, text: str):
        import numpy as np

        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its search ran out of stack
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")

    def __call__(self, text: str) -> bytes:
        return self.join([self.ids(text), self.end]).astype("<u4", copy=False).tobytes()


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    pool_tails: int = 4096,
) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    Every token of every row, its end id included, lies in exactly one piece.  A
    null text counts as empty (its end id alone).  Rows with the same id are
    packed each on their own.  ``sequence_id`` starts with the partition's
    number, so a task that is run again gives the same pieces.  ``vocabulary``
    is a path that every executor can open.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, end_id)
        packer = _Packer(TaskContext.get().partitionId(), capacity, pool_tails)
        kinds = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.take(), strict=True)) or [()] * 7
            arrays = [pa.array(columns[0], kinds)] + [pa.array(c, pa.int64()) for c in columns[1:]]
            return pa.record_batch(arrays, names=["key", *(c.split()[0] for c in SCHEMA.split(", "))])

        for batch in batches:
            kinds = batch.schema.field(0).type
            for part in slices(batch, 1):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packer.add(key, encode(text or ""))
                yield out()
        if kinds is not None:
            packer.flush(last=True)
            yield out()

    keyed = docs.select(F.col(id_col).alias("key"), F.col(text_col))
    kind = keyed.schema["key"].dataType.simpleString()
    return keyed.mapInArrow(kernel, f"key {kind}, {SCHEMA}").withColumnRenamed("key", id_col)


def pack_query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
