from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallysheet.llm import hardnegatives
from tallysheet.llm.hardnegatives import Mining, mine
from tallysheet.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
SMALL = Mining(block=7, rows=5, anchors=2)


def _brute(rows, anchor, spec=Mining()):
    """The contract over Python integers; a row is (id, vector, label)."""
    usable = [
        (n, i, label, [math.floor(spec.scale * float(np.float32(x))) for x in v])
        for n, (i, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1])
    out = []
    for n, i, label, v in usable:
        if i is None or not anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for m, j, lab, w in usable if m != n and lab == label]  # noqa: B905
        others = [(sum(a * b for a, b in zip(v, w)), j) for _, j, lab, w in usable if lab != label]  # noqa: B905
        for p, j, _ in sorted(scored, key=order)[: spec.positives]:
            low, high = spec.window
            fit = [s for s in others if low * p <= 100 * s[0] <= high * p]
            out += [(i, j, k, s[1], p, s[0]) for k, s in enumerate(sorted(fit, key=order)[: spec.negatives], 1)]
    return sorted(out, key=str)


def _found(df):
    return sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.sampled_from([3, 300, 10**5, 2**28]))
def test_scores_are_exact(seed, width, size):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-size, size + 1, (n, width)) for n in (7, 5))
    a[0], b[0] = size, -size
    primes = hardnegatives.primes_for(width * size**2)
    assert np.prod(primes, dtype=object) > 2 * width * size**2
    blocks = [hardnegatives.residues(x.astype(np.float64), primes) for x in (a, b)]
    expected = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert hardnegatives.signed_scores(*blocks, primes).tolist() == expected


def test_wide_vectors_are_summed_in_exact_parts():
    rng = np.random.default_rng(1)
    a, b = (np.where(rng.random((3, 5000)) < 0.9, 255, -256).astype(np.float64) for _ in range(2))
    primes = hardnegatives.primes_for(5000 * 256**2)
    got = hardnegatives.signed_scores(hardnegatives.residues(a, primes), hardnegatives.residues(b, primes), primes)
    assert (got == (a.astype(np.int64) @ b.astype(np.int64).T)).all()


def test_more_primes_than_a_long_has_bits_still_give_the_score():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, -5.0]])
    primes = hardnegatives.primes_for(2**90)
    got = hardnegatives.signed_scores(hardnegatives.residues(a, primes), hardnegatives.residues(b, primes), primes)
    assert got.tolist() == [[2**60 - 15]]


@pytest.mark.parametrize("spec", [Mining(), SMALL])
def test_equals_brute_force_with_ties_and_a_hot_label(spark, spec):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2, 4, 3) / 4], int(rng.choice([0, 0, 0, 1, 2]))) for i in range(120)]
    rows += rows[:30] + [(200 + i, [0.5, 0.5, 0.5], i % 2) for i in range(20)]
    found = mine(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 10 == 0, spec=spec)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert _found(found) == _brute(rows, lambda i: i % 10 == 0, spec)


def test_nulls_lengths_and_odd_components(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (None, [1.0, 0.5], 1), (2, [0.9, 0.5, 7.0], 1), (3, [], 1), (4, None, 1), (5, [1.0, None], 1),
        (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [0.7], 2), (9, [0.5, 0.2], 2), (None, [0.5, 0.2], 2), (11, [1.0, 0.4], None),
        (10, [0.3], 3),
    ]
    found = mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert _found(found) == _brute(rows, lambda i: i % 10 == 0)
    assert found.count()


def test_empty_tables_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    some = spark.createDataFrame([(1, [1.0], 1), (2, [0.9], 2)], SCHEMA)
    assert mine(some, F.col("vec_id") % 10 == 0).count() == 0
    more = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)], SCHEMA).selectExpr("*", "9 as score", "8 as row", "7 as rank")
    assert _found(mine(more, F.col("vec_id") == 0)) == [(0, 1, 1, 2, 65536, 230 * 256)]


def test_scores_beyond_a_long_stop_the_job(spark):
    rows = spark.createDataFrame([(0, [1e18], 1), (1, [1e18], 1)], SCHEMA)
    with pytest.raises(Exception, match="does not fit a long"):
        mine(rows, F.col("vec_id") == 0).collect()


def test_query_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    moved = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows]
    assert _found(op12_hard_negatives(spark, "/root/testdata/sf0.01")) == _brute(moved, lambda i: i % 50 == 0)
