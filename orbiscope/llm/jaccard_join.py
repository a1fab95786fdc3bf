"""Exact Jaccard self-join of documents on word shingles with a count-vector R-tree.

A document is its set of distinct shingles, as 64-bit hashes (a wrong count
needs two equal hashes within one pair of texts).  Two documents link when
100 * intersection >= PERCENT * union.

1.  Documents with equal sets form one class, told apart by 128 bits of the
    set's fingerprint and named by a number.
2.  The hash space is cut into m groups.  Linked sets of the same size band
    differ in at most d < m shingles, so some group holds exactly the same
    shingles in both (pigeonhole).  Every set emits a fingerprint of each
    group's content; sets that share one meet in a bucket.
3.  Shingles are also hashed to G groups, and the counts per group are a point.
    Sum over groups of min(count_a, count_b) bounds the overlap.  An R-tree over
    the points of a bucket keeps a node's largest counts, which bound the
    overlap with everything below it; subtrees that cannot reach the needed
    overlap are skipped.  What survives connects sets to clusters; linked
    documents never lie in different clusters.
4.  Inside a cluster the surviving pairs (an R-tree again, with finer counts) are
    verified on the sets themselves, unless both ends are already connected.

Buckets and clusters are worked on in units of at most ``block_rows`` sets (two
blocks in the last step of ``_connect``), and clusters of ``block_shingles``
shingles.  Fingerprints that very many sets share are salted before they are
shuffled.  No pairs leave a task but those that connected something new.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache
from math import exp, isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orbiscope.llm.common import cut, id_bitmap, in_bitmap, maybe_in, slices
from orbiscope.llm.components import Stars, connected_components

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash, emptied when it grows beyond a bound."""

    BOUND = 1 << 17

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes.  Words end at ASCII white space, A-Z are lower-cased."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        a = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        k = min(k, len(words))
        n = len(words) - k + 1
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = (h * _P1 + a[j : j + n]) * _P2
        return np.unique(_mix(h))


def _band(n: int) -> int:
    """Size band: floor(2 * log2(n)), in whole numbers."""
    return (n * n).bit_length() - 1


@cache
def _band_groups(band: int, percent: int) -> tuple[int, int]:
    """(hash groups, how many of them may be empty) for linked sets whose larger one lies in ``band``.

    Linked sets differ in at most ``differ`` shingles, so of ``differ + 1 +
    slack`` groups at least ``slack + 1`` are equal; ``slack`` is three times the
    number of empty groups to expect in the band's smallest sets.
    """
    low, high = isqrt((1 << band) - 1) + 1, isqrt((1 << (band + 1)) - 1)
    differ = 2 * high * (100 - percent) // (100 + percent)
    slack = 2 + int(3 * (differ + 1) * exp(-low / (differ + 1)))
    return (differ + 1 + slack, slack) if differ else (0, 0)


def group_fingerprints(shingles: np.ndarray, percent: int) -> np.ndarray:
    """A fingerprint for the content of each hash group, in every size band where the set may meet a linked one.

    A set enters its own band and the one that a linked, larger set may lie in.
    A set with at most ``slack`` empty groups shares a filled one with whatever
    it links to, so empty groups (which many sets share) are emitted only by the
    rare sets that have more.
    """
    n, out = len(shingles), []
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(shingles * _P1), dtype=np.uint64)])
        for band in range(_band(n), _band(100 * n // percent) + 1) if n else ():
            m, slack = _band_groups(band, percent)
            if not m:
                continue
            edges = np.arange(1, m, dtype=np.uint64) * np.uint64((1 << 64) // m)
            at = np.concatenate([[0], np.searchsorted(shingles, edges), [n]])
            content = sums[at[1:]] - sums[at[:-1]]
            keys = _mix(content + _mix(np.arange(m, dtype=np.uint64) * _P2 + np.uint64(band + 1)))
            empty = at[1:] == at[:-1]
            out.append(keys if empty.sum() > slack else keys[~empty])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class CountVectorRTree:
    """R-tree over group counts.  A node keeps the largest count per group and the sizes below it."""

    FAN = 16

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = self._tiles(points, sizes)
        self.order = order
        self.levels = [(points[order], sizes[order], sizes[order])]
        while len(self.levels[-1][1]) > self.FAN:
            high, low, top = self.levels[-1]
            cuts = np.arange(0, len(low), self.FAN)
            self.levels.append(
                (np.maximum.reduceat(high, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(top, cuts))
            )

    def _tiles(self, points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bulk loading: halve by size or by the widest coordinate until a part fits one leaf."""
        out, todo = [], [np.arange(len(sizes))]
        while todo:
            part = todo.pop()
            if len(part) <= self.FAN:
                out.append(part)
                continue
            spread = points[part].max(0) - points[part].min(0)
            axis = int(spread.argmax())
            by = sizes[part] if np.ptp(sizes[part]) > spread[axis] else points[part, axis]
            ranked = part[np.argsort(by, kind="stable")]
            half = -(-len(part) // (2 * self.FAN)) * self.FAN
            todo += [ranked[half:], ranked[:half]]
        return np.concatenate(out)

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Positions of all points whose overlap with ``point`` may reach the needed one."""
        at = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low, top = (x[at] for x in self.levels[depth])
            fits = (percent * low <= 100 * size) & (100 * top >= percent * size)
            bound = np.minimum(high, point).sum(1, dtype=np.int64)
            at = at[fits & ((100 + percent) * bound >= percent * (size + low))]
            if depth and len(at):
                at = (at[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                at = at[at < len(self.levels[depth - 1][1])]
        return self.order[at]


def count_vector(shingles: np.ndarray, groups: int) -> np.ndarray:
    """Shingles per hash group."""
    return np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)


def count_vectors(sets: list[np.ndarray], groups: int) -> np.ndarray:
    return np.array([count_vector(s, groups) for s in sets], np.int32).reshape(len(sets), groups)


def groups_for(n: int) -> int:
    """Groups of a set's own point: between an eighth and a sixteenth of its size, which tells sets of that size apart."""
    return min(1024, max(32, 1 << max(0, (n // 8).bit_length() - 1)))


_FULL = 255


def packed_point(shingles: np.ndarray) -> bytes:
    """The set's point with a byte a group; a full group stands for any number."""
    return np.minimum(count_vector(shingles, groups_for(len(shingles))), _FULL).astype(np.uint8).tobytes()


def _unpacked(point: bytes, groups: int) -> np.ndarray:
    """A point with ``groups`` groups or a multiple of them, folded to ``groups``."""
    v = np.frombuffer(point, np.uint8).astype(np.int32)
    v[v == _FULL] = 1 << 24
    return v if len(v) == groups else v.reshape(-1, groups).sum(0)


#: Buckets of up to this many sets are compared pair by pair, larger ones through a tree.
SMALL_BUCKET = 8


def may_link(n: int, point: bytes, m: int, other: bytes, percent: int) -> bool:
    """Whether the bound on the overlap of two sets reaches the needed one."""
    if percent * n > 100 * m or percent * m > 100 * n:
        return False
    groups = min(len(point), len(other))
    bound = int(np.minimum(_unpacked(point, groups), _unpacked(other, groups)).sum(dtype=np.int64))
    return (100 + percent) * bound >= percent * (n + m)


class Unit:
    """What has been connected in one unit of work: a label per row, and which rows are compared.

    Rows start with the labels they bring along (equal ones are connected
    already).  With two sides, only pairs across them are compared.
    """

    def __init__(self, n: int, labels: list[int] | None = None, sides: list[int] | None = None):
        self.label = np.unique(labels, return_inverse=True)[1] if labels else np.arange(n)
        self.left = int(self.label.max()) + 1 if n else 0  # labels that still differ, at most
        self.sides = np.array(sides) if sides and min(sides) != max(sides) else None
        self.edges: list[tuple[int, int]] = []

    def asks(self) -> Iterator[int]:
        """The rows to look up, as long as anything is unconnected."""
        for i in range(len(self.label)):
            if self.left < 2:
                return
            if self.sides is None or self.sides[i] == 0:
                yield i

    def open(self, i: int, near: np.ndarray) -> np.ndarray:
        """Those of ``near`` that ``i`` is to be compared with: unconnected and, with two sides, on the other one."""
        near = near[self.label[near] != self.label[i]]
        return near if self.sides is None else near[self.sides[near] != self.sides[i]]

    def connect(self, i: int, j: int) -> None:
        self.edges.append((int(i), int(j)))
        self.label[self.label == self.label[j]] = self.label[i]
        self.left -= 1


def bucket_edges(
    sizes: list[int], points: list[bytes], percent: int, labels: list[int] | None = None, sides: list[int] | None = None
) -> list[tuple[int, int]]:
    """Edges that connect a bucket's sets as all pairs do whose bound reaches the needed overlap.

    Linked sets' sizes differ by a quarter at most, so their numbers of groups
    are equal or one is twice the other; the finer point is then folded.
    """
    unit = Unit(len(sizes), labels, sides)
    if len(sizes) <= SMALL_BUCKET:
        for i in unit.asks():
            for j in unit.open(i, np.arange(len(sizes))):
                if unit.label[i] != unit.label[j] and may_link(sizes[i], points[i], sizes[j], points[j], percent):
                    unit.connect(i, j)
        return unit.edges
    n, width = np.array(sizes, np.int64), np.array([len(p) for p in points])
    for groups in np.unique(width):
        part = np.flatnonzero((width == groups) | (width == 2 * groups))
        if len(part) < 2:
            continue
        vectors = np.array([_unpacked(points[i], int(groups)) for i in part])
        at = {int(i): k for k, i in enumerate(part)}
        tree = CountVectorRTree(vectors, n[part])
        for i in unit.asks():
            # finer points ask for pairs of both widths only where the other end does not ask itself
            if i not in at or width[i] != groups and unit.sides is None:
                continue
            near = unit.open(i, part[tree.search(vectors[at[i]], int(n[i]), percent)])
            if width[i] != groups:
                near = near[width[near] == groups]
            others, first = np.unique(unit.label[near], return_index=True)
            for other, j in zip(others, near[first], strict=True):
                if unit.label[j] == other and unit.label[i] != other:
                    unit.connect(i, j)
    return unit.edges


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def cluster_links(
    sets: list[np.ndarray], percent: int, labels: list[int] | None = None, sides: list[int] | None = None
) -> list[tuple[int, int]]:
    """Links that connect the sets as all links do."""
    unit = Unit(len(sets), labels, sides)
    if unit.left < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    wanted = max(32, int(sizes.max()) // 8)
    points = count_vectors(sets, min(1024, 1 << (wanted - 1).bit_length()))
    tree = CountVectorRTree(points, sizes)
    for i in unit.asks():
        near = tree.search(points[i], int(sizes[i]), percent)
        if unit.sides is None:
            near = near[near > i]
        for j in unit.open(i, near):
            if unit.label[j] != unit.label[i] and linked(sets[i], sets[j], percent):
                unit.connect(i, j)
    return unit.edges


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit fingerprint of a set as two signed numbers."""
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _digest_kernel(k: int):
    """(key, n, high, low, point) of every document."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, 1):
                sets = [shingle_set(t, k, hashes) for t in part.column(1).cast(pa.binary()).to_pylist()]
                rows = [(len(s), *digest(s)) for s in sets]
                points = pa.array([packed_point(s) for s in sets], pa.binary())
                yield pa.record_batch(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)), points],
                    names=["key", "n", "high", "low", "point"],
                )

    return kernel


#: Sets that a task remembers to emit what exact copies share only once.
REMEMBERED = 1 << 17
#: A mark met this often in a task (more in large tasks) is dealt to SALTS partitions from there on.
OFTEN = 512
SALTS = 1024
#: Counters of a task's marks; a mark that shares its counter with others is at worst salted early.
COUNTERS = 1 << 20
#: The salt of a row that only says that a task has salted the mark.
NOTICE = -1


#: Marks that a task gathers before it gives them out, and that are expected in one part.
GATHERED = 1 << 21
PART_MARKS = 1 << 18
#: Bytes of a mark on its way: the bits of it that its part does not tell, and 32 bits of the set's fingerprint.
PLAIN = np.dtype([("rest", "<u4"), ("low", "<u4")])
SALTED = np.dtype([("mark", "<u8"), ("salt", "<i4"), ("low", "<u4")])
LOW_BITS = (1 << 32) - 1


def part_bits(shingles: int, percent: int) -> int:
    """Binary digits of the number of parts that the marks of so many shingles are dealt to."""
    return min(20, max(10, (shingles * 2 * (100 - percent) // 100 // PART_MARKS).bit_length()))


def _blobs(part: np.ndarray, rows: np.ndarray, salted: bool) -> pa.RecordBatch:
    """(part, salted, rows): the rows of each part as bytes."""
    order = np.argsort(part, kind="stable")
    part, rows = part[order], rows[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    ends = (np.r_[starts, len(rows)] * rows.itemsize).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])
    columns = [pa.array(part[starts].astype(np.int32)), pa.array(np.full(len(starts), salted)), packed]
    return pa.record_batch(columns, names=["part", "salted", "rows"])


def _mark_kernel(k: int, percent: int, often_from: int, bits: int):
    """(part, salted, rows): the group fingerprints of every set, once per task for copies met close together.

    A mark is the first ``bits`` + 32 bits of a fingerprint, a set the last 32
    of its own: what shares them by chance is compared and not linked.  A mark
    is salted where a task meets it very often; the task then says so once in
    the mark's unsalted run.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, met, told = WordHashes(), set(), set()
        seen, total, held = np.zeros(COUNTERS, np.int32), 0, 0
        plain: list[tuple] = []
        salted: list[tuple] = []

        def joined(found: list[tuple], kind: np.dtype) -> tuple[np.ndarray, ...]:
            rows = np.empty(sum(len(f[0]) for f in found), kind)
            rows["low"] = np.repeat(np.array([f[-1] for f in found], np.uint32), [len(f[0]) for f in found])
            return rows, *(np.concatenate([f[c] for f in found]) for c in range(len(found[0]) - 1))

        def give() -> Iterator[pa.RecordBatch]:
            if plain:
                rows, mark = joined(plain, PLAIN)
                rows["rest"] = (mark & np.uint64(LOW_BITS)).astype(np.uint32)
                if len(rows):  # every mark may be salted
                    yield _blobs(mark >> np.uint64(32), rows, False)
            if salted:
                rows, rows["mark"], rows["salt"] = joined(salted, SALTED)
                with np.errstate(over="ignore"):
                    spread = _mix(rows["mark"] + rows["salt"].astype(np.uint64) * _P1) >> np.uint64(64 - bits)
                yield _blobs(np.where(rows["salt"] == NOTICE, rows["mark"] >> np.uint64(32), spread), rows, True)
            plain.clear()
            salted.clear()

        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).cast(pa.binary()).to_pylist():
                    s = shingle_set(text, k, hashes)
                    low = digest(s)[1]
                    if not len(s) or low in met:
                        continue
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met.add(low)
                    found = group_fingerprints(s, percent) >> np.uint64(32 - bits)
                    if not len(found):
                        continue
                    at = (found & np.uint64(COUNTERS - 1)).astype(np.int64)
                    seen[at] += 1
                    total += len(at)
                    often = seen[at] > often_from + 4 * total // COUNTERS
                    plain.append((found[~often], low & LOW_BITS))
                    held += len(found)
                    if often.any():
                        found = found[often]
                        salted.append((found, np.full(len(found), 1 + low % SALTS, np.int32), low & LOW_BITS))
                        new = [m for m in found.tolist() if m not in told]
                        if len(told) >= REMEMBERED:
                            told.clear()
                        told.update(new)
                        if new:
                            salted.append((np.array(new, np.uint64), np.full(len(new), NOTICE, np.int32), 0))
                    if held >= GATHERED:
                        yield from give()
                        held = 0
        yield from give()

    return kernel


def _unpacked_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, salt, low) sorted by mark, salt, then set within each part, from blobs sorted by part."""
    held: list[tuple[int, bool, bytes]] = []

    def close() -> Iterator[pa.RecordBatch]:
        plain = np.frombuffer(b"".join(rows for _, salted, rows in held if not salted), "<u8")
        # as one number: the set, then the rest of the mark
        plain = np.sort((plain << np.uint64(32)) | (plain >> np.uint64(32)))
        more = np.frombuffer(b"".join(rows for _, salted, rows in held if salted), SALTED)
        mark = (plain >> np.uint64(32)).astype(np.int64) + (held[0][0] << 32)
        salt, low = np.zeros(len(plain), np.int64), (plain & np.uint64(LOW_BITS)).astype(np.int64)
        if len(more):
            mark, salt, low = np.r_[mark, more["mark"].astype(np.int64)], np.r_[salt, more["salt"]], np.r_[low, more["low"]]
            order = np.lexsort((low, salt, mark))
            mark, salt, low = mark[order], salt[order], low[order]
        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in (mark, salt, low)], names=["mark", "salt", "low"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if held and held[0][0] != row[0]:
                yield from close()
                held = []
            held.append(row)
    if held:
        yield from close()


def _meet_kernel(block_rows: int):
    """(bucket, block, low) of the buckets with several sets, from rows sorted by mark, salt, then set.

    A run of rows with one mark and salt is streamed, however long it is, and
    numbered off in blocks.  A bucket that lies within one batch is named by its
    members, so that buckets with the same members are one.  Salted runs, and the
    unsalted one that notices belong to, are named by their mark, and their
    rows stay even if they are alone.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # (mark, salt, latest set, whether a notice), its place, whether emitted, whether noticed

        for batch in batches:
            if not batch.num_rows:
                continue
            mark, salt, low = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3))
            notice = salt == NOTICE
            salt = np.maximum(salt, 0)
            lead = last is not None and last[0][:2] == (mark[0], salt[0])
            if lead:
                mark, salt, low, notice = (np.r_[x, c] for x, c in zip(last[0], (mark, salt, low, notice), strict=True))
            same = (mark[1:] == mark[:-1]) & (salt[1:] == salt[:-1])
            fresh = np.r_[True, ~(same & (low[1:] == low[:-1]) & (notice[1:] == notice[:-1]))]
            mark, salt, low, notice = mark[fresh], salt[fresh], low[fresh], notice[fresh]
            starts = np.flatnonzero(np.r_[True, (mark[1:] != mark[:-1]) | (salt[1:] != salt[:-1])])
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(mark)]))
            noticed, members = np.logical_or.reduceat(notice, starts), np.add.reduceat((~notice).astype(np.int64), starts)
            if lead:
                noticed[0] |= last[3]
            forced = ((salt > 0) | noticed[run]) & ~notice
            out = (forced | (members[run] > 1)) & ~notice
            if lead and last[2]:
                out[0] = False
            before = np.cumsum(~notice) - ~notice
            place = before - before[starts][run] + np.where((run == 0) & lead, last[1] if lead else 0, 0)
            with np.errstate(over="ignore"):
                mixed = np.where(notice, np.uint64(0), _mix(low.view(np.uint64) * _P2))
                named = np.add.reduceat(mixed, starts) * _P1 + members.astype(np.uint64)
            # the first run may have begun in an earlier batch, the last one may go on
            open_ = (run == len(starts) - 1) | (run == 0) & lead
            name = np.where(open_ | forced, mark, named.view(np.int64)[run])
            block = (salt << 32) + place // block_rows
            yield pa.record_batch([pa.array(c[out]) for c in (name, block, low)], names=["bucket", "block", "low"])
            emitted = bool(out[-1]) or (len(out) == 1 and lead and last[2])
            last = (mark[-1], salt[-1], low[-1], notice[-1]), int(place[-1]), emitted, bool(noticed[-1])

    return kernel


# A unit of work is what shares (grp, i, j); its rows are (grp, i, j, side, comp, node) and then what is compared.

#: Rows of a group that are expected in all of its blocks, and the share of a block's limits that such a row may take.
ANCHORS = 16
ANCHOR_SHARE = 64


def _unit_kernel(compare):
    """Edges (a, b) between nodes, from rows sorted by unit, then node; ``compare`` gets the payload, labels and sides."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows, stars = None, [], Stars()

        def close() -> list[tuple[int, int]]:
            if len(rows) < 2:
                return []
            sides, comps, nodes, *payload = (list(c) for c in zip(*rows, strict=True))
            return [(nodes[x], nodes[y]) for x, y in compare(*payload, comps, sides)]

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
                if row[:3] != unit:
                    yield from stars.add(close())
                    unit, rows = row[:3], []
                if not (rows and rows[-1][0] == row[3] and rows[-1][2] == row[5]):  # not a repeated row of one set
                    rows.append(row[3:])
        yield from stars.add(close())
        yield stars.batch()

    return kernel


def _edges(units: DataFrame, compare) -> DataFrame:
    """What ``compare`` connects in each unit; units are dealt by their name, which holds a bounded number of rows."""
    dealt = units.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "side", "node")
    return cut(dealt.mapInArrow(_unit_kernel(compare), "a long, b long"))


def _blocks(rows: DataFrame, size, limits) -> DataFrame:
    """(grp, members, blocks): how many blocks keep each group's blocks within the limits; ``size`` are expressions on rows."""
    needed = [F.ceil(F.sum(s) / limit) for s, limit in zip(size, limits, strict=True)]
    most = F.greatest(*needed) if len(needed) > 1 else needed[0]
    return rows.groupBy("grp").agg(F.count("*").alias("members"), most.cast("long").alias("blocks"))


def _in_block(blocks, salt: int):
    return F.pmod(F.xxhash64("node", F.lit(salt)), blocks)


def _dealt(rows: DataFrame, size, limits, payload: list[str]) -> DataFrame:
    """Units of one block each from rows with members and blocks.

    A few rows of a group, the anchors, are in all of its blocks, so that the
    blocks of a group of near copies are connected at once.
    """
    light = F.lit(True)
    for s, limit in zip(size, limits, strict=True):
        light &= s * ANCHOR_SHARE <= limit
    anchor = (F.col("blocks") > 1) & light & (F.pmod(F.xxhash64("node", F.lit(3)), F.col("members")) < ANCHORS)
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    own = F.array(_in_block(F.col("blocks"), 1).cast("long"))
    return rows.select(
        "grp", F.explode(F.when(anchor, everywhere).otherwise(own)).alias("i"), F.lit(0).cast("long").alias("j"),
        F.lit(0).alias("side"), F.col("node").alias("comp"), "node", *payload,
    )


def _connect(firsts, large, compare, size, limits, again: bool) -> DataFrame:
    """Components (node, root) of what ``compare`` connects within groups, none of which is held in one task.

    The last of ``firsts`` gives units of bounded size that cover every group's
    rows, labelled by the components that the ones before it have found.
    ``large()`` gives (grp, node, payload ...) of the groups with several units,
    or None.  With ``again`` those that are not one component are dealt to blocks
    with anchors.  After that nearly all of a group of near copies is one
    component.  What remains outside of each group's largest component is
    compared with all of the group, block by block, so that no pair of
    unconnected rows is left out.
    """
    known: DataFrame | None = None

    def more_of(new: DataFrame) -> DataFrame:
        if known is None:
            return cut(connected_components(new))
        if new.isEmpty():
            return known
        return cut(connected_components(known.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new)))

    for units in firsts:
        known = more_of(_edges(units(known), compare))
    rows = large()
    if rows is None:
        return known
    payload = [c for c in rows.columns if c not in ("grp", "node")]

    def still_open() -> tuple[DataFrame, DataFrame]:
        """(rows with comp, groups with main) of the groups of several components."""
        placed = rows.join(known, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        parts = placed.groupBy("grp", "comp").agg(F.count("*").alias("n"))
        main = parts.groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("parts"))
        return placed, cut(main.where("parts > 1").drop("parts"))

    placed, groups = still_open()
    if groups.isEmpty():
        return known
    if again:
        open_ = rows.join(groups.select("grp"), "grp")
        known = more_of(_edges(_dealt(open_.join(_blocks(open_, size, limits), "grp"), size, limits, payload), compare))
        placed, groups = still_open()
        if groups.isEmpty():
            return known
    placed = placed.join(groups, "grp")
    rest = placed.where("comp <> main")
    turns = _blocks(rest, size, limits).select("grp", F.col("blocks").alias("turns"))
    deals = turns.join(_blocks(placed, size, limits).drop("members"), "grp")
    asked = rest.join(deals, "grp").select(
        "grp", _in_block(F.col("turns"), 2).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"),
        F.lit(0).alias("side"), "comp", "node", *payload,
    )
    held = placed.join(deals, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("i"), _in_block(F.col("blocks"), 1).alias("j"),
        F.lit(1).alias("side"), "comp", "node", *payload,
    )
    return more_of(_edges(asked.unionByName(held), compare))


def _set_kernel(k: int, bitmap):
    """(key, high, low, shingles as bytes) of the documents whose id may be wanted, once per task for close copies."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, met = WordHashes(), set()
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False))))
            for part in slices(batch, 1):
                rows = []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    s = shingle_set(text, k, hashes)
                    name = (key, *digest(s))
                    packed = struct.pack("<qqq", *name)
                    if packed not in met:
                        if len(met) >= REMEMBERED:
                            met.clear()
                        met.add(packed)
                        rows.append((*name, s.tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch(
                    [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["key", "high", "low", "shingles"]
                )

    return kernel


#: One in so many buckets is worked on first: sets that meet in many buckets are then connected before the others.
SOME = 16
#: Stands for a null id where a document is only looked up; its text's fingerprint tells it apart.
NO_ID = -1


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, block_rows: int, block_shingles: int, often: int):
    """(documents, sets): (key, n, high, low) of every row, and (high, low, rep, part) of every distinct set with words.

    ``rep`` is the smallest id of a set's rows, ``part`` names its component.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    signed = cut(keyed.mapInArrow(_digest_kernel(k), "key long, n long, high long, low long, point binary"))
    # every distinct set gets a number: the fingerprint's 128 bits tell sets apart, the number is their name
    distinct = signed.where("n > 0").groupBy("high", "low").agg(
        F.min("key").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")
    )
    sets = cut(distinct.withColumn("node", F.monotonically_increasing_id()))

    # one shuffle of the marks, which drops nearly all of them: most sets meet nobody.  Here 32 bits stand for a set;
    # sets that share them are all compared with whatever any of them meets
    bits = part_bits(sets.agg(F.sum("n")).first()[0] or 0, percent)
    marks = keyed.select("text").mapInArrow(_mark_kernel(k, percent, often, bits), "part int, salted boolean, rows binary")
    meet = _meet_kernel(block_rows)
    buckets = cut(
        marks.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(lambda batches: meet(_unpacked_marks(batches)), "bucket long, block long, low long")
        .distinct()
    )
    points = sets.select(F.col("low").bitwiseAND(F.lit(LOW_BITS)).alias("low"), "node", "n", "point")

    def met(rows: DataFrame, known: DataFrame | None) -> DataFrame:
        """Units of the buckets' blocks; what is known to be connected comes with one label."""
        named = points.withColumn("root", F.col("node")) if known is None else points.join(known, "node", "left")
        return rows.join(named, "low").select(
            F.col("bucket").alias("grp"), F.col("block").alias("i"), F.lit(0).cast("long").alias("j"), F.lit(0).alias("side"),
            F.coalesce("root", "node").alias("comp"), "node", "n", "point",
        )

    def some_buckets(known: DataFrame | None) -> DataFrame:
        return met(buckets.where(F.pmod(F.xxhash64("bucket"), F.lit(SOME)) == 0), known)

    def all_buckets(known: DataFrame | None) -> DataFrame:
        return met(buckets, known)

    def large_buckets() -> DataFrame | None:
        several = cut(buckets.where("block > 0").select("bucket").distinct())
        if several.isEmpty():
            return None
        rows = buckets.join(several, "bucket").select("bucket", "low").distinct()
        return cut(rows.join(points, "low").select(F.col("bucket").alias("grp"), "node", "n", "point"))

    def may(sizes, points_, labels, sides):
        return bucket_edges(sizes, points_, percent, labels, sides)

    clusters = _connect([some_buckets, all_buckets], large_buckets, may, [F.lit(1)], [block_rows], again=True)

    members = clusters.join(sets, "node").select(
        F.col("root").alias("grp"), "node", "n", F.coalesce("rep", F.lit(NO_ID)).alias("key"), "high", "low"
    )
    size, limits = [F.lit(1), F.col("n")], [block_rows, block_shingles]
    placed = cut(members.join(_blocks(members, size, limits), "grp"))
    bitmap = spark.sparkContext.broadcast(id_bitmap(placed.select("key")))
    found = keyed.select(F.coalesce("key", F.lit(NO_ID)).alias("key"), "text").mapInArrow(
        _set_kernel(k, bitmap), "key long, high long, low long, shingles binary"
    )
    with_sets = placed.join(found, ["key", "high", "low"]).select("grp", "node", "n", "members", "blocks", "shingles")
    several = not placed.where("blocks > 1").isEmpty()
    if several:  # then sets are used more than once
        with_sets = cut(with_sets)

    def large_clusters() -> DataFrame | None:
        return with_sets.where("blocks > 1").select("grp", "node", "n", "shingles") if several else None

    def verify(_, shingles, labels, sides):
        return cluster_links([np.frombuffer(s, np.uint64) for s in shingles], percent, labels, sides)

    units = _dealt(with_sets, size, limits, ["n", "shingles"])
    joined = _connect([lambda _: units], large_clusters, verify, size, limits, again=False)
    parts = sets.join(joined, "node", "left").select("high", "low", "rep", F.coalesce("root", "node").alias("part"))
    return signed.drop("point"), parts


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    block_rows: int = 2048,
    block_shingles: int = 1 << 21,
    often: int = OFTEN,
) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of ``docs``.

    Every row goes by its own text, whatever its id.  ``component_id`` is the
    smallest id of the rows that links reach from it, itself included.  Rows
    without words (null, empty or blank text) have no shingles and link with
    nothing; texts of fewer than ``k`` words are one shingle.  Ids are integers;
    a row with a null id links like any other, and its component is null where
    no row in it has an id.
    """
    signed, sets = _grouped(docs, id_col, text_col, k, percent, block_rows, block_shingles, often)
    least = sets.groupBy("part").agg(F.min("rep").alias("least"))
    named = sets.join(least, "part").select("high", "low", "least")
    return signed.join(named, ["high", "low"], "left").select(
        F.col("key").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"),
    )


def drop_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    block_rows: int = 2048,
    block_shingles: int = 1 << 21,
    often: int = OFTEN,
) -> DataFrame:
    """One row of each component stays, all columns kept; rows without words stay.

    Every row goes by its own text, whatever its id.  The row with the smallest
    id stays (null ids come last, then the fingerprint decides); of rows with
    one id and one set of shingles any one.  Only rows whose id is among those
    with something to drop are shuffled.
    """
    signed, sets = _grouped(docs, id_col, text_col, k, percent, block_rows, block_shingles, often)
    texts = signed.where("n > 0").groupBy("high", "low", "key").agg(F.count("*").alias("copies"))
    rows = texts.join(sets.select("high", "low", "part"), ["high", "low"])
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "high", "low")).alias("first")
    kept = rows.groupBy("part").agg(F.sum("copies").alias("total"), first).where("total > 1").drop("total")
    stays = F.col("first.key").eqNullSafe(F.col("key")) & (F.col("first.high") == F.col("high")) & (F.col("first.low") == F.col("low"))
    decided = cut(
        rows.join(kept, "part")
        .select("high", "low", "key", stays.alias("one"), "copies")
        .where("NOT one OR copies > 1")
        .select(*(F.col(c).alias(f"_{c}") for c in ("high", "low", "key", "one")))
    )
    names = {"high": _unused(docs, "high"), "low": _unused(docs, "low")}
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(decided.select(F.coalesce("_key", F.lit(NO_ID)).alias("key"))))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64()).fill_null(NO_ID)
            batch = batch.filter(pa.array(in_bitmap(bitmap.value, keys.to_numpy(zero_copy_only=False))))
            at = batch.schema.get_field_index(text_col)
            for part in slices(batch, at):
                found = [digest(shingle_set(t, k, hashes)) for t in part.column(at).cast(pa.binary()).to_pylist()]
                columns = [*part.columns, *(pa.array([f[c] for f in found], pa.int64()) for c in (0, 1))]
                yield pa.record_batch(columns, names=[*part.schema.names, *names.values()])

    schema = StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names.values())])
    signed_rows = docs.mapInArrow(kernel, schema)
    same = (
        (F.col(names["high"]) == F.col("_high"))
        & (F.col(names["low"]) == F.col("_low"))
        & F.col(id_col).cast("long").eqNullSafe(F.col("_key"))
    )
    judged = signed_rows.join(decided, same, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = maybe_in(docs, bitmap, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    out = docs.where(~marked).unionByName(judged.where("_one IS NULL").select(*columns))
    if decided.where("_one").isEmpty():
        return out
    # partial aggregation leaves a row per task and text, however often a row is repeated
    once = judged.where("_one").groupBy("_high", "_low", "_key").agg(F.first(F.struct(*columns)).alias("row"))
    return out.unionByName(once.select("row.*"))


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


#: The registered query by all pairs of documents that share a shingle (ids are taken to be distinct and not null).
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS k
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""
