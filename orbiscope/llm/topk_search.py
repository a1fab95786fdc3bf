"""Exact top-k inner-product search by no-random-access aggregation of sorted lists.

Candidates are read in blocks.  Every component of a block is a list sorted by
value; a query reads each list from the end that its own component favours, a
step at a time, and always those lists whose next step lowers the bound most
(large components of the query, and lists that fall steeply).  A candidate's
lower bound counts the entries read and the least that its other lists can add,
its upper bound the entries read and the current front of every other list.
Reading stops when a candidate not met yet can no longer reach the k-th best
lower bound and few others can; those get their final scores.

How far a query reads first follows from the fronts and the mean and variance
of each step: up to where few upper bounds are expected to reach its bound or
the expected k-th best lower bound.  So the entries of a step are added up for
many queries at once, and upper bounds are drawn up where they are likely to end
the reading.  Queries for which too many candidates remain read on, one at a
time.

A query's best scores so far carry over as a bound to the next block.  The bound
of the first one comes from a bounded number of other queries, which are
candidates themselves.  Only the k best of each query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbiscope.llm.common import cut

#: Rows of a candidate block, and bytes of queries that are broadcast at once.
BLOCK_ROWS = 8192
QUERY_BYTES = 16 << 20
#: Queries that the first bounds come from.
SEEDS = 2048
#: A step reads one in STEPS of a list's entries in one in LISTS of the lists.
STEPS = 8
LISTS = 2
#: Reading goes on while more than this share of the block's candidates may still qualify.
RESOLVED = 0.04
#: Queries whose entries are added up together, and by how many deviations a bound is above the mean of the upper
#: bounds where three quarters of that share are expected.
TOGETHER = 64
CLEAR = NormalDist().inv_cdf(1 - 0.75 * RESOLVED)
#: Below every score.
LEAST = -(1 << 62)


def quantised(column: Column) -> Column:
    """floor(256 * x) of every component as long; null for a null vector or one with a null or non-finite component."""
    finite = F.forall(
        column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= F.lit(1.7976931348623157e308)),
    )
    whole = F.transform(column, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return F.when(column.isNotNull() & (F.size(column) > 0) & finite, whole)


class SortedBlock:
    """Candidates of one block with every component's list in rising order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, lists = vectors.shape
        order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        step = -(-n // STEPS)
        spare = ((0, 0), (0, step * STEPS - n))  # entries of no candidate at the high end
        in_order = np.take_along_axis(vectors.T, order, axis=1)
        self.order = np.pad(order, spare, constant_values=n).reshape(lists, STEPS, step)
        self.sorted = np.pad(in_order, spare, mode="edge").reshape(lists, STEPS, step)
        #: The step that holds each candidate's entry, and the entries of a step.
        self.step_of = np.empty((lists, n), np.uint8)
        np.put_along_axis(self.step_of, order, (np.arange(n) // step).astype(np.uint8)[None, :], axis=1)
        self.entries = np.clip(n - step * np.arange(STEPS), 0, step)
        # by direction (falling, rising), list and steps read: the value at the front, and of the entries read their
        # share, mean and mean square, the last two as parts of the whole list's
        low, high = self.sorted[:, :, 0], self.sorted[:, :, -1]
        self.fronts = np.stack([np.c_[high[:, -1:], low[:, ::-1]], np.c_[low[:, :1], high]])
        real = (self.order < n) / n
        of_step = np.stack([(real * self.sorted.astype(float) ** power).sum(2) for power in (0, 1, 2)])
        self.moments = np.zeros((3, 2, lists, STEPS + 1))
        np.cumsum(of_step[:, :, ::-1], axis=2, out=self.moments[:, 0, :, 1:])
        np.cumsum(of_step, axis=2, out=self.moments[:, 1, :, 1:])
        # room for which entries are unread, used again for every query
        self._from, self._to = np.empty((lists, n), bool), np.empty((lists, n), bool)
        self._unread = np.empty((lists, n), vectors.dtype)
        #: Entries read and resolved candidates, over all queries so far.
        self.read = self.resolved = 0

    def _sums(self, at: np.ndarray, terms: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """What is added to every candidate (row) for every query (column).

        ``at`` holds the candidates of one step a row, ``terms`` their values,
        and for each step and query a factor of the values and a constant.
        """
        values, factors, constants = terms
        n, asked = len(self.ids), factors.shape[1]
        if asked == 1 and values.dtype != np.int64:
            return np.bincount(at.ravel(), (values * factors + constants).ravel(), n + 1)[:-1, None].astype(values.dtype)
        out = np.zeros((n + 1, asked), values.dtype)
        added, held = np.empty((2, at.shape[1], asked), values.dtype)
        whole_row = np.dtype((np.void, out.itemsize * asked))  # rows are moved as single items
        out_rows, held_rows = out.view(whole_row).ravel(), held.view(whole_row).ravel()
        with_one = np.ones((at.shape[1], 2), values.dtype)
        for rows, of_step, coefficients in zip(at, values, np.stack([factors, constants], axis=1), strict=True):
            with_one[:, 0] = of_step
            np.matmul(with_one, coefficients, out=added)
            np.take(out_rows, rows, out=held_rows, mode="clip")
            np.add(held, added, out=held)
            out_rows[rows] = held_rows
        return out[:-1]

    def _unread_sums(self, alive, rising, depth, gaps) -> np.ndarray:
        """For each of ``alive`` the sums of the rows of ``gaps`` over the lists in which its entry is unread."""
        first, end = np.where(rising, depth, 0), np.where(rising, STEPS, STEPS - depth)
        at = self.step_of if len(alive) == len(self.ids) else self.step_of.take(alive, axis=1)
        there = np.s_[: at.shape[0], : at.shape[1]]
        held = np.greater_equal(at, first.astype(np.uint8)[:, None], out=self._from[there])
        held &= np.less(at, end.astype(np.uint8)[:, None], out=self._to[there])
        np.copyto(self._unread[there], held)
        return gaps @ self._unread[there]

    def best(self, query_id: int, query: np.ndarray, k: int, reached: int) -> list[tuple[int, int]]:
        """(score, id) of this block's candidates that may be among the query's k best.

        ``reached`` is a score that k other candidates have already; whatever
        cannot reach it is left out.
        """
        return self.best_of([query_id], query[None, :], k, [reached])[0]

    def best_of(self, query_ids, queries: np.ndarray, k: int, reached) -> list[list[tuple[int, int]]]:
        """As ``best``, for each of some queries (rows)."""
        n, lists = self.vectors.shape
        weight, rising = queries.astype(self.vectors.dtype), queries < 0
        each = np.arange(len(weight))
        reached = np.array(reached, np.int64).astype(weight.dtype)
        fronts = self.fronts[rising.astype(int), np.arange(lists)] * weight[:, :, None]
        gains = np.concatenate([fronts[:, :, :-1] - fronts[:, :, 1:], np.full_like(fronts[:, :, :1], -1)], axis=2)
        share, mean, square = self.moments[:, rising.astype(int), np.arange(lists)]
        wide, least = weight.astype(float)[:, :, None], fronts[:, :, -1:].astype(float)

        def expected(unread):
            of_list = wide * mean + (1 - share) * unread
            return of_list, wide**2 * square + (1 - share) * unread**2 - of_list**2

        uppers, lowers = expected(fronts.astype(float)), expected(least)
        best_is = NormalDist().inv_cdf(1 - k / n) if n > 2 * k else 0.0
        depth = np.where(weight == 0, STEPS, 0)
        width = -(-(weight != 0).sum(1) // LISTS)

        def now(table):
            return np.take_along_axis(table, depth[:, :, None], axis=2)[:, :, 0]

        while True:
            few, likely = (
                now(means).sum(1) + above * np.sqrt(now(variances).sum(1).clip(0))
                for (means, variances), above in ((uppers, CLEAR), (lowers, best_is))
            )
            bound = np.maximum(reached, likely)
            going = (depth.min(axis=1, initial=STEPS) < STEPS) & ((now(fronts).sum(1) >= bound) | (few >= bound))
            if not going.any():
                break
            chosen = np.argsort(-now(gains), axis=1, kind="stable")
            there = (np.arange(lists) < width[:, None]) & going[:, None]
            more = np.zeros(depth.shape, bool)
            more[each[:, None], chosen] = there
            depth[more & (depth < STEPS)] += 1
        front, step = now(fronts), np.arange(STEPS)
        taken = np.where(rising[:, :, None], step < depth[:, :, None], step >= STEPS - depth[:, :, None])
        taken &= (weight != 0)[:, :, None]
        self.read += int((taken.sum((0, 1)) * self.entries).sum())
        used = taken.any(axis=0)
        if used.any():
            factors = np.ascontiguousarray(np.where(taken, weight[:, :, None], 0)[:, used].T)
            constants = np.ascontiguousarray(np.where(taken, -front[:, :, None], 0)[:, used].T)
            upper = self._sums(self.order[used], (self.sorted[used], factors, constants))
            upper += front.sum(1)
        else:
            upper = np.repeat(front.sum(1)[None, :], n, axis=0)
        may = np.ascontiguousarray(((upper >= reached) & (self.ids[:, None] != np.array(query_ids, np.int64))).T)
        found = []
        for q in each:
            alive = np.flatnonzero(may[q])
            if len(alive) > max(k, n * RESOLVED) and depth[q].min(initial=STEPS) < STEPS:
                of_query = (x[q] for x in (weight, rising, fronts, gains, depth))
                alive = self._read_on(*of_query, alive, upper[alive, q], k, reached[q])
            self.resolved += len(alive)
            score = self.vectors[alive] @ weight[q]
            if len(alive) > k:
                most = score >= np.partition(score, len(alive) - k)[len(alive) - k]
                alive, score = alive[most], score[most]
            ranked = sorted(zip((-score).tolist(), self.ids[alive].tolist(), strict=True))
            found.append([(int(-s), int(i)) for s, i in ranked[:k]])
        return found

    def _read_on(self, weight, rising, fronts, gains, depth, alive, upper, k, reached) -> np.ndarray:
        """What is left of ``alive`` when one query, read up to ``depth``, has read on until few qualify or all is read."""
        lists, least = np.arange(len(weight)), fronts[:, -1]
        some = -(-int((weight != 0).sum()) // LISTS)
        seen = upper - self._unread_sums(alive, rising, depth, fronts[lists, depth])
        while True:
            whole, front = depth.min() >= STEPS, fronts[lists, depth]
            most, fewest = self._unread_sums(alive, rising, depth, np.stack([front, least])) + seen
            if len(alive) > k:
                reached = max(reached, np.partition(fewest, len(alive) - k)[len(alive) - k])
            keep = most >= reached  # upper bounds fall and the bound rises, so the others stay out
            alive, seen = alive[keep], seen[keep]
            if whole or (front.sum() < reached and len(alive) <= max(k, len(self.ids) * RESOLVED)):
                return alive
            chosen = np.argsort(-gains[lists, depth], kind="stable")[:some]
            chosen = chosen[depth[chosen] < STEPS]
            step = np.where(rising[chosen], depth[chosen], STEPS - 1 - depth[chosen])
            terms = self.sorted[chosen, step], weight[chosen, None], np.zeros((len(chosen), 1), weight.dtype)
            seen = seen + self._sums(self.order[chosen, step], terms)[alive, 0]
            self.read += int(self.entries[step].sum())
            depth[chosen] += 1


def exact_kind(block: np.ndarray, queries: np.ndarray):
    """float32 or float64 where it holds every sum of products exactly, else int64."""
    largest = float(np.abs(block).max(initial=0)) * float(np.abs(queries).max(initial=0))
    largest *= 4 * max(1, block.shape[1])
    return np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else np.int64


def first_bounds(query_ids: list[int], queries: list[np.ndarray], k: int, seeds: int = SEEDS) -> np.ndarray:
    """Per query a score that k other rows have: its k-th best among the first ``seeds`` queries of its length."""
    out = np.full(len(query_ids), LEAST, np.int64)
    for length in {len(q) for q in queries}:
        at = np.array([i for i, q in enumerate(queries) if len(q) == length])
        if len(at) <= k:
            continue
        ids, block = np.array(query_ids)[at], np.array([queries[i] for i in at])
        kind = exact_kind(block, block)
        others, other_ids = block[:seeds].astype(kind), ids[:seeds]
        for a in range(0, len(at), 1024):
            scores = block[a : a + 1024].astype(kind) @ others.T
            scores[ids[a : a + 1024, None] == other_ids[None, :]] = LEAST
            if scores.shape[1] > k:
                out[at[a : a + 1024]] = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return np.maximum(out, LEAST)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a column of lists that hold no nulls."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)[:-1]) if len(lengths) else []


def _kernel(queries, k: int, block_rows: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, bounds = queries.value
        best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
        of_length: dict[int, list[int]] = {}
        for q, vector in enumerate(query_vectors):
            of_length.setdefault(len(vector), []).append(q)
        waiting: dict[int, tuple[list, list]] = {}

        def search(ids: list, vectors: list) -> None:
            block = np.array(vectors, np.int64)
            asked = of_length.get(block.shape[1], [])
            if not asked:
                return
            asked_vectors = np.array([query_vectors[q] for q in asked])
            kind = exact_kind(block, asked_vectors)
            lists = SortedBlock(np.array(ids, np.int64), block.astype(kind))
            for a in range(0, len(asked), TOGETHER):
                together = asked[a : a + TOGETHER]
                reached = [max(int(bounds[q]), best[q][-1][0] if len(best[q]) == k else LEAST) for q in together]
                more = lists.best_of([query_ids[q] for q in together], asked_vectors[a : a + TOGETHER], k, reached)
                for q, found in zip(together, more, strict=True):
                    best[q] = sorted(best[q] + found, key=lambda x: (-x[0], x[1]))[:k]

        for batch in batches:
            for row_id, vector in zip(batch.column(0).to_pylist(), _vectors(batch.column(1)), strict=True):
                ids, vectors = waiting.setdefault(len(vector), ([], []))
                ids.append(row_id)
                vectors.append(vector)
                if len(ids) == block_rows:
                    search(ids, vectors)
                    waiting[len(vector)] = ([], [])
        for ids, vectors in waiting.values():
            if ids:
                search(ids, vectors)
        rows = [(query_ids[q], i, s) for q, found in enumerate(best) for s, i in found]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return kernel


def search(
    vectors: DataFrame,
    query_filter: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row.

    Queries are the rows that ``query_filter`` selects, candidates all rows but
    those with the query's id.  Vectors that are null, empty or hold a null or
    non-finite component, and rows with a null id, take no part; a query meets
    candidates of its own length only.  Ties go to the smaller id.  A query id
    that occurs in several rows is searched once, with its smallest vector; a
    candidate id that occurs in several rows counts once for each.

    Queries are broadcast ``query_bytes`` at a time, and each such part is held
    against all candidates, so their number is not bounded by memory.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"), query_filter.alias("asked")
    ).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    candidates = rows.select("vec_id", "v")
    asked = rows.where("asked").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").toLocalIterator()
    sc = vectors.sparkSession.sparkContext
    schema = "query_id long, vec_id long, score long"
    parts: list[DataFrame] = []
    row, done = next(asked, None), False
    while not done:
        ids, queries, held = [], [], 0
        while row is not None and held < query_bytes:
            ids.append(row.vec_id)
            queries.append(np.array(row.v, np.int64))
            held += queries[-1].nbytes
            row = next(asked, None)
        done = row is None
        shared = sc.broadcast((ids, queries, first_bounds(ids, queries, k)))
        part = candidates.mapInArrow(_kernel(shared, k, block_rows), schema)
        parts.append(part if done and not parts else cut(part))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def search_query(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
