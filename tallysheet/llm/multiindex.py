"""Approximate nearest neighbours (cosine) with an inverted multi-index.

Unit vectors are cut into halves, each half is quantised with its own centroids, and the pair of centroids
is the cell of a vector. A query visits cells in the order of the summed distances of its halves, with a
heap, until enough vectors are collected, and those are reranked by the exact cosine of the original
vectors. How many are enough is measured: for a bounded sample of queries the true neighbours are found
by brute force, and the count is set so that the target recall of them lies in the visited cells.

Entries are stored by the first centroid, in blocks; a query goes once to each block of the first
centroids it visits, with the list of second centroids. A block in memory is bounded, queries stream by.

Cases: vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows with a null id. Equal rows count once. Ids are taken as unique: rows
with the query's own id are no candidates. Fewer candidates than wanted are all returned. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.tables import stored


@dataclass(frozen=True)
class MultiIndex:
    neighbours: int = 5
    # Bounds of the samples that centroids are fitted on and the stop is measured on.
    fit_vectors: int = 16_384
    fit_rounds: int = 10
    measured_queries: int = 128
    target_recall: float = 0.97
    vectors_per_cell: int = 32
    most_centroids: int = 512
    block: int = 4_096
    seed: int = 8


DEFAULT = MultiIndex()


def usable(vec_id: Column, vector: Column) -> Column:
    x = lambda v: v.cast("double")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(x(v)) < F.lit(float("inf"))))
    return vec_id.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def centroids(sample: np.ndarray, k: int, index: MultiIndex) -> np.ndarray:
    """Lloyd's rounds from a random start."""
    rng = np.random.default_rng(index.seed)
    at = sample[np.sort(rng.choice(len(sample), min(k, len(sample)), replace=False))].copy()
    for _ in range(index.fit_rounds):
        own = _distances(sample, at).argmin(axis=1)
        n = np.bincount(own, minlength=len(at))
        total = np.zeros_like(at)
        np.add.at(total, own, sample)
        at[n > 0] = total[n > 0] / n[n > 0, None]
    return at


def _distances(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ at.T + (at * at).sum(axis=1), 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def visit(near: tuple[np.ndarray, np.ndarray], counts: np.ndarray, enough: int) -> Iterator[tuple[int, int]]:
    """Non-empty cells of a query by summed distance, until ``enough`` vectors are in them.

    ``near`` has its distances to the centroids of each half. The heap holds the front of pairs: a
    pair enters when both its predecessors have left.
    """
    order = [np.argsort(d, kind="stable") for d in near]
    first, second = (d[o].tolist() for d, o in zip(near, order, strict=True))
    left = [0] * len(first)  # pairs that have left, in each row
    heap = [(first[0] + second[0], 0, 0)]
    found = 0
    while heap and found < enough:
        _, a, b = heapq.heappop(heap)
        left[a] = b + 1
        i, j = int(order[0][a]), int(order[1][b])
        if counts[i, j]:
            found += int(counts[i, j])
            yield i, j
        if b + 1 < len(second) and (a == 0 or left[a - 1] > b + 1):
            heapq.heappush(heap, (first[a] + second[b + 1], a, b + 1))
        if a + 1 < len(first) and left[a + 1] == b:
            heapq.heappush(heap, (first[a + 1] + second[b], a + 1, b))


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine in double precision of pairs of rows."""
    dot = (queries * rows).sum(axis=1)
    return dot / (np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((rows * rows).sum(axis=1)))


def best_of(query_ids, queries: np.ndarray, allowed: np.ndarray | None, rows: np.ndarray, ids: list, k: int):
    """The ``k`` nearest of the rows for each query: (query id, vec id, score, row). ``ids`` lists the
    ids that share a row's vector, in order, so that a row gives up to ``k`` neighbours."""
    close = _unit(queries) @ _unit(rows).T
    if allowed is not None:
        close[~allowed] = -np.inf
    # The own vector takes a place. All rows within rounding of the last one are compared exactly,
    # however many there are, so that ties among parallel vectors are cut by id only.
    m = min(len(rows), k + 1)
    last = np.partition(close, len(rows) - m, axis=1)[:, len(rows) - m]
    rounding = max(1e-12, 8 * rows.shape[1] * np.finfo(np.float64).eps)
    at, row = np.nonzero((close >= (last - rounding)[:, None]) & (close > -np.inf))
    cuts = range(0, len(at), 65_536)
    scores = np.concatenate([np.zeros(0), *(_exact(queries[at[a : a + 65_536]], rows[row[a : a + 65_536]]) for a in cuts)])
    # The k best neighbours are in the k + 1 first rows by score and least id: only the row with the
    # query's own id can stand too far ahead.
    order = np.lexsort((np.array([v[0] for v in ids], np.int64)[row], -scores, at))
    bounds = np.searchsorted(at[order], np.arange(len(queries) + 1))
    out = []
    for n, q in enumerate(query_ids):
        own = order[bounds[n] : min(bounds[n + 1], bounds[n] + k + 1)]
        found = sorted((-s, v, r) for r, s in zip(row[own].tolist(), scores[own].tolist(), strict=True) for v in ids[r] if v != q)
        out += [(q, v, -s, r) for s, v, r in found[:k]]
    return out


def _sampled(entries: DataFrame, n: int) -> np.ndarray:
    rows = entries.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(n).select("vector").toArrow()
    return _matrix(rows["vector"].combine_chunks()) if rows.num_rows else np.zeros((0, 0))


def _brute_force(entries: DataFrame, queries: list, index: MultiIndex) -> list[tuple]:
    """(query id, score, cell) of the true neighbours of a few queries: every task hands back its own
    best few."""
    shared = entries.sparkSession.sparkContext.broadcast(queries)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [q[0] for q in shared.value], np.array([q[1] for q in shared.value], np.float64)
        kept: dict = {}
        for batch in batches:
            if len(batch):
                rows, cells = _matrix(batch.column(0)), list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
                for q, v, s, r in best_of(ids, vectors, None, rows, batch.column(1).to_pylist(), index.neighbours):
                    kept.setdefault(q, []).append((-s, v, cells[r]))
                kept = {q: sorted(x)[: index.neighbours] for q, x in kept.items()}
        flat = [(q, -s, v, *cell) for q, x in kept.items() for s, v, cell in x]
        columns = list(zip(*flat, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["q", "s", "v", "i", "j"])

    found = entries.select("vector", "ids", "i", "j").mapInArrow(nearest, "q long, s double, v long, i int, j int")
    turn = F.row_number().over(Window.partitionBy("q").orderBy(F.col("s").desc(), "v"))
    return [tuple(r) for r in found.withColumn("turn", turn).where(F.col("turn") <= index.neighbours).select("q", "i", "j").collect()]


def search(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", index: MultiIndex = DEFAULT
) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest found for the rows where ``is_query`` holds."""
    rows = vectors.where(usable(F.col(vec_id), F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query")
    )
    rows = stored(rows.distinct(), "vectors")
    spark, k = vectors.sparkSession, index.neighbours
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    rows = rows.where(F.size("vector") == sizes["n"])
    # Of equal vectors only the least ids can be neighbours. Spark cuts them before the shuffle.
    turn = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.select("vector", "vec_id").withColumn("turn", turn).where(F.col("turn") <= k + 1)
    entries = stored(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    n = entries.count()
    half = max(1, sizes["n"] // 2)
    sample = _unit(_sampled(entries, index.fit_vectors))
    size = int(min(index.most_centroids, max(2, round((n / index.vectors_per_cell) ** 0.5))))
    books = [centroids(part, size, index) for part in (sample[:, :half], sample[:, half:])]
    shared = spark.sparkContext.broadcast(books)

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _unit(_matrix(batch.column(0)))
            i, j = (_distances(p, b).argmin(axis=1).astype(np.int32) for p, b in zip((x[:, :half], x[:, half:]), shared.value, strict=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i), pa.array(j)], ["vector", "ids", "i", "j"])

    entries = stored(entries.mapInArrow(quantised, "vector array<double>, ids array<bigint>, i int, j int"), "cells")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in entries.groupBy("i", "j").count().collect():
        counts[r["i"], r["j"]] = r["count"]
    queries = rows.where("is_query").select("vec_id", "vector")
    few = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(index.measured_queries).collect()
    if not few:
        return empty
    enough = _enough(_brute_force(entries, few, index), dict(map(tuple, few)), books, counts, half, index)
    blocks = -(-counts.sum(axis=1) // index.block)
    plan = spark.sparkContext.broadcast((books, counts, blocks, enough))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, counts, blocks, enough = plan.value
        for batch in batches:
            if not len(batch):
                continue
            x = _unit(_matrix(batch.column(1)))
            near = [_distances(p, b) for p, b in zip((x[:, :half], x[:, half:]), books, strict=True)]
            at, region, block, cells = [], [], [], []
            for r in range(len(x)):
                by: dict[int, list[int]] = {}
                for i, j in visit((near[0][r], near[1][r]), counts, enough):
                    by.setdefault(i, []).append(j)
                for i, own in by.items():
                    for b in range(int(blocks[i])):
                        at.append(r)
                        region.append(i)
                        block.append(b)
                        cells.append(own)
            at = pa.array(at, pa.int64())
            columns = [pa.array(region, pa.int32()), pa.array(block, pa.int32()), batch.column(0).take(at), batch.column(1).take(at), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "block", "query", "vector", "cells"])

    probes = queries.mapInArrow(probed, "i int, block int, query long, vector array<double>, cells array<int>")
    # Entries come before the queries of their block; a null query marks an entry.
    held = F.element_at(F.array([F.lit(int(b)) for b in blocks]), F.col("i") + 1)
    dealt = entries.select(
        "i", F.pmod(F.xxhash64("ids"), held).cast("int").alias("block"), F.lit(None).cast("long").alias("query"), "vector",
        F.array("j").alias("cells"), "ids",
    )
    both = dealt.unionByName(probes.withColumn("ids", F.lit(None).cast("array<bigint>")))

    def reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows, ids, second = None, [], [], []
        matrix = None
        for batch in batches:
            places = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            isq = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            at = 0
            while at < len(batch):
                if places[at] != place:
                    place, rows, ids, second, matrix = places[at], [], [], [], None
                end = at + 1
                while end < len(batch) and places[end] == place and isq[end] == isq[at]:
                    end += 1
                part = batch.slice(at, end - at)
                if not isq[at]:
                    rows.append(_matrix(part.column(3)))
                    second += [c[0] for c in part.column(4).to_pylist()]
                    ids += part.column(5).to_pylist()
                elif rows:
                    if matrix is None:
                        matrix, cell = np.concatenate(rows), np.array(second)
                    for a in range(0, len(part), 512):
                        piece = part.slice(a, 512)
                        allowed = np.stack([np.isin(cell, c) for c in piece.column(4).to_pylist()])
                        found = best_of(piece.column(2).to_pylist(), _matrix(piece.column(3)), allowed, matrix, ids, index.neighbours)
                        columns = list(zip(*found, strict=True))[:3] or [(), (), ()]
                        kinds = (pa.int64(), pa.int64(), pa.float64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])
                at = end

    order = ["i", "block", F.col("query").asc_nulls_first()]
    both = both.select("i", "block", "query", "vector", "cells", "ids").repartition("i", "block").sortWithinPartitions(*order)
    found = both.mapInArrow(reranked, "query_id long, vec_id long, score double").distinct()
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", turn.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _enough(true: list[tuple], queries: dict, books: list[np.ndarray], counts: np.ndarray, half: int, index: MultiIndex) -> int:
    """Vectors to collect so that ``target_recall`` of the true neighbours lie in the visited cells."""
    wanted: dict[int, list[tuple[int, int]]] = {}
    for q, i, j in true:
        wanted.setdefault(q, []).append((i, j))
    need = []
    for q, cells in wanted.items():
        x = _unit(np.array([queries[q]], np.float64))
        near = tuple(_distances(p, b)[0] for p, b in zip((x[:, :half], x[:, half:]), books, strict=True))
        seen, reached = 0, {}
        for cell in visit(near, counts, int(counts.sum())):
            seen += int(counts[cell])
            reached[cell] = seen
        need += [reached[c] for c in cells]
    if not need:
        return index.neighbours + 1
    need.sort()
    return max(index.neighbours + 1, need[min(len(need) - 1, int(np.ceil(index.target_recall * len(need))) - 1)])
