from __future__ import annotations

import dataclasses
import itertools

import numpy as np
from pyspark.sql import functions as F

from tallysheet.llm import multiindex
from tallysheet.llm.queries import op8_nearest


def _brute(rows, queries, k=5):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.all(np.isfinite(np.array(v, float))) and any(v)}
    out = {}
    for q in queries:
        if q in usable:
            a = usable[q]
            near = sorted((-(a @ b) / np.sqrt((a @ a) * (b @ b)), i) for i, b in usable.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = _brute(rows, [i for i, _ in rows if i % 50 == 0])
    found = _found(op8_nearest(spark, "/root/testdata/sf0.01"))
    assert found.keys() == expected.keys() and all(len(v) == 5 for v in found.values())
    hits = [i in {v for v, _ in found[q]} for q, near in expected.items() for i, _ in near]
    assert np.mean(hits) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, near in found.items():
        for i, score in near:
            a, b = vectors[q], vectors[i]
            assert abs(score - (a @ b) / np.sqrt((a @ a) * (b @ b))) < 1e-12
        assert [(-s, i) for i, s in near] == sorted((-s, i) for i, s in near)


def test_blocks_and_clusters(spark):
    """Clustered vectors, blocks smaller than a region."""
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(6, 10)) * 4
    rows = [(i, (centre[i % 6] + rng.normal(size=10)).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = dataclasses.replace(multiindex.DEFAULT, block=16)
    found = _found(multiindex.search(frame, F.col("vec_id") % 20 == 0, index=index))
    expected = _brute(rows, range(0, 600, 20))
    hits = [i in {v for v, _ in found[q]} for q, near in expected.items() for i, _ in near]
    assert np.mean(hits) >= 0.9


def test_copies_and_ties(spark):
    rows = [(i, [1.0, 2.0]) for i in range(100)] + [(200, [2.0, 1.0]), (201, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = _found(multiindex.search(frame, F.col("vec_id") % 50 == 0))
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in found[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in found[200]] == [0, 1, 2, 3, 4]


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (50, []), (6, [1.0, 1.0]),
            (7, [1.0]), (None, [1.0, 0.5]), (6, [1.0, 1.0]), (100, [1e-30, 2e-30])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as vector", "2 as query_id", "3 as ids")
    found = _found(multiindex.search(frame, F.col("vec_id") % 50 == 0))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {0: [6, 100], 100: [6, 0]}
    assert multiindex.search(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert multiindex.search(frame.where("vec_id = 6"), F.col("vec_id") % 50 == 0).collect() == []


def test_heap_visits_cells_by_distance():
    rng = np.random.default_rng(1)
    near = (rng.random(7), rng.random(9))
    counts = rng.integers(0, 3, (7, 9))
    visited = list(multiindex.visit(near, counts, int(counts.sum())))
    sums = [near[0][i] + near[1][j] for i, j in visited]
    assert sums == sorted(sums)
    assert set(visited) == {(i, j) for i, j in itertools.product(range(7), range(9)) if counts[i, j]}
    some = list(multiindex.visit(near, counts, 10))
    assert some == visited[: len(some)] and sum(counts[c] for c in some[:-1]) < 10 <= sum(counts[c] for c in some)


def test_ties_among_parallel_vectors():
    """More scaled copies than neighbours, in any order: the smallest ids win."""
    rng = np.random.default_rng(3)
    ids = rng.permutation(np.arange(1, 301)).tolist()
    rows = np.array([[1.0, 2.0, 2.0]]) * 2.0 ** (np.array(ids) % 40)[:, None]
    rows = np.concatenate([rows, rng.normal(size=(50, 3))])
    lists = [[i] for i in ids] + [[1000 + i] for i in range(50)]
    queries = np.array([[2.0, 4.0, 4.0], [2.0, 4.0, 4.0]])
    found = multiindex.best_of([0, 3], queries, None, rows, lists, 5)
    assert [(q, v) for q, v, _, _ in found] == [(0, v) for v in (1, 2, 3, 4, 5)] + [(3, v) for v in (1, 2, 4, 5, 6)]
    assert all(abs(s - 1) < 1e-12 for _, _, s, _ in found)
    allowed = np.zeros((2, len(rows)), bool)
    allowed[0, 300:302] = True
    assert {v for _, v, _, _ in multiindex.best_of([0, 3], queries, allowed, rows, lists, 5)} == {1000, 1001}
