"""Hard negatives by exact integer inner products, multiplied in a residue number system.

Components become whole numbers, whole numbers become residues modulo a few primes below 256, and the
matrices of residues are multiplied in float32: with residues of at most 125 in size a sum of up to 1,073
products stays below 2**24, where float32 is exact. Chinese remaindering with digits around zero
(mixed radix) gives the signed score. How many primes there must be follows from the largest component of
the table, so scores are exact for any data whose scores are long integers; others stop the job.

Anchors are taken in blocks of a bounded number of components, which all tasks get. The rows are not
shuffled: each task multiplies its rows with the block and keeps the best few for each anchor, and these
meet in a window by anchor. First the positives, then the negatives whose score lies in the window of a
positive. A label may hold any share of the rows.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part. A shorter
vector counts as filled with zeros; an empty one scores 0. Other rows are all but the anchor's own, also
if they have its id or its vector. Rows with a null id are no anchors (if the condition is null) and come
last among ties. Repeated rows each take a place. Fewer rows than wanted are all returned. Anchors without
a positive give no rows. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.tables import stored

LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 3
    # Negatives score between these percentages of the positive.
    window: tuple[int, int] = (50, 95)
    scale: int = 256
    # Components in a block of anchors (8 bytes each).
    block: int = 4_000_000
    # Rows and anchors that are multiplied at a time.
    rows: int = 1_024
    anchors: int = 1_024


DEFAULT = Mining()


def primes_for(bound: int) -> list[int]:
    """Primes below 256, the largest first, whose product exceeds the count of whole numbers within the bound."""
    odd = [p for p in range(255, 2, -2) if all(p % d for d in range(3, 16, 2) if d < p)]
    product = 1
    for k, p in enumerate(odd):
        product *= p
        if product > 2 * bound + 1:
            return odd[: k + 1]
    raise ArithmeticError("components are too large for exact scores")


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """The residue nearest to zero; exact for whole numbers in float64."""
    x = np.fmod(x, p)
    x -= p * np.rint(x / p)
    return x


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [_centred(x, p).astype(np.float32) for p in primes]


def _modular_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo p, from float32 products of as many columns as stay exact."""
    width = ((1 << 24) - 1) // ((p // 2) ** 2)
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], width):
        total += _centred((a[:, at : at + width] @ b[:, at : at + width].T).astype(np.float64), p)
    return _centred(total, p)


def signed_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of the rows behind two lists of residues, as int64.

    Digit k of the mixed radix is what the residue modulo prime k adds to the digits before it; with
    digits around zero the number comes out signed. The sum wraps like int64, so it is right whenever the
    score itself is a long, however many primes there are.
    """
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        digit = _modular_product(a[k], b[k], p)
        if k:
            known = digits[-1]
            for j in range(k - 2, -1, -1):
                known = _centred(known * primes[j] + digits[j], p)
            inverse = pow(int(np.prod([q % p for q in primes[:k]], dtype=object)), -1, p)
            digit = _centred((digit - known) * inverse, p)
        digits.append(digit)
    out = digits[-1].astype(np.int64)
    for k in range(len(primes) - 2, -1, -1):
        out *= primes[k]
        out += digits[k].astype(np.int64)
    return out


class Block:
    """Rows as a matrix of whole numbers with their residues."""

    def __init__(self, x: np.ndarray, primes: list[int]):
        self.x = x
        self.residues = residues(x, primes)

    def scores(self, other: Block, primes: list[int], wide: bool) -> np.ndarray:
        # Only tables with huge components can have scores beyond a long.
        if wide and len(self.x) and len(other.x) and np.abs(self.x @ other.x.T).max() >= 2.0**63 * (1 - 1e-9):
            raise ArithmeticError("a score does not fit a long")
        return signed_scores(self.residues, other.residues, primes)


def whole(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """A list column as a matrix of floor(scale * x), short vectors filled with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(scale))
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


class Best:
    """The best few of each group: highest score, then least id (none last), then row."""

    def __init__(self, groups: int, most: int):
        self.most = most
        # What a row must score at least to get in.
        self.least = np.full(groups, LEAST + 1, np.int64)
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(5))

    def add(self, scores: np.ndarray, group: np.ndarray, ids: np.ndarray, no_id: np.ndarray, rows: np.ndarray) -> None:
        """``scores`` of rows by columns, ``LEAST`` where a row is no candidate; ``group`` of each column."""
        top = min(self.most, len(scores))
        if not top:
            return
        last = np.partition(scores, len(scores) - top, axis=0)[len(scores) - top]
        r, c = np.nonzero(scores >= np.maximum(last, self.least[group]))
        if not len(r):
            return
        new = (group[c], scores[r, c], no_id[r].astype(np.int64), ids[r], rows[r])
        every = [np.concatenate(both) for both in zip(self.kept, new, strict=True)]
        g, s, n, v, w = every
        order = np.lexsort((w, v, n, -s, g))
        turn = np.arange(len(g)) - np.searchsorted(g[order], g[order])
        self.kept = tuple(x[order[turn < self.most]] for x in every)
        last = order[turn == self.most - 1]
        self.least[g[last]] = s[last]

    def batch(self) -> list[pa.Array]:
        g, s, n, v, w = self.kept
        return [pa.array(g), pa.array(s), pa.array(v, pa.int64(), mask=n == 1), pa.array(w)]


def _top(found: DataFrame, group: str, most: int) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(group).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row"))
    return found.withColumn("rank", turn).where(F.col("rank") <= most)


def mine(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", spec: Mining = DEFAULT
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where
    ``is_anchor`` holds."""
    spark = vectors.sparkSession
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.col(label).isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"),
        x.cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = stored(rows, "vectors")
    largest = F.max(F.aggregate("vector", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v))))
    facts = rows.agg(F.max(F.size("vector")).alias("width"), largest.alias("largest"), F.count_if("is_anchor").alias("anchors")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not facts["anchors"]:
        return spark.createDataFrame([], schema)
    width = max(1, facts["width"])
    if facts["largest"] * spec.scale == float("inf"):
        raise ArithmeticError("components are too large for exact scores")
    bound = width * (int(facts["largest"] * spec.scale) + 1) ** 2
    primes, wide = primes_for(bound), bound >= 1 << 62
    blocks = -(-facts["anchors"] * width // spec.block)
    anchors = rows.where("is_anchor").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    if blocks > 1:
        anchors = stored(anchors, "anchors")
    parts = [_mine_block(rows, anchors.where(F.col("block") == b), width, primes, wide, spec) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)


def _mine_block(rows: DataFrame, anchors: DataFrame, width: int, primes: list[int], wide: bool, spec: Mining) -> DataFrame:
    """Hard negatives of one block of anchors, which is small enough for every task."""
    sc = rows.sparkSession.sparkContext
    own = anchors.select("row", "id", "label", "vector").orderBy("row").toArrow().combine_chunks()
    names = {label: n for n, label in enumerate(dict.fromkeys(own["label"].to_pylist()))}
    codes = np.array([names[v] for v in own["label"].to_pylist()], np.int64)
    matrix = whole(own["vector"].combine_chunks(), width, spec.scale) if own.num_rows else np.zeros((0, width))
    shared = sc.broadcast((own["row"].to_numpy(), codes, matrix, names))

    def scored(batch: pa.RecordBatch, anchor_blocks: list[tuple[int, Block]]) -> Iterator[tuple]:
        """(first anchor, scores, whether labels are the same, whether rows are others, ids, no_id, rows)."""
        arow, acode, _, names = shared.value
        for at in range(0, len(batch), spec.rows):
            part = batch.slice(at, spec.rows)
            row = part.column(0).to_numpy()
            no_id = part.column(1).is_null().to_numpy(zero_copy_only=False)
            ids = part.column(1).fill_null(0).to_numpy()
            code = np.array([names.get(v, -1) for v in part.column(2).to_pylist()], np.int64)
            block = Block(whole(part.column(3), width, spec.scale), primes)
            for first, anchor in anchor_blocks:
                some = slice(first, first + len(anchor.x))
                yield some, block.scores(anchor, primes, wide), code[:, None] == acode[some], row[:, None] != arow[some], ids, no_id, row

    def in_blocks() -> list[tuple[int, Block]]:
        x = shared.value[2]
        return [(at, Block(x[at : at + spec.anchors], primes)) for at in range(0, len(x), spec.anchors)]

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, anchor_blocks = Best(len(shared.value[0]), spec.positives), in_blocks()
        for batch in batches:
            for some, scores, same, other, *about in scored(batch, anchor_blocks):
                best.add(np.where(same & other, scores, LEAST), np.arange(some.start, some.stop), *about)
        yield pa.RecordBatch.from_arrays(best.batch(), ["anchor", "score", "id", "row"])

    columns = rows.select("row", "id", "label", "vector")
    found = columns.mapInArrow(positives, "anchor long, score long, id long, row long")
    # A few rows for each anchor of the block.
    chosen = _top(found, "anchor", spec.positives).select("anchor", "rank", "score", "id").orderBy("anchor", "rank").collect()
    low = np.zeros((spec.positives, len(codes)), np.int64)
    high = low - 1
    group = np.zeros_like(low)
    about = []
    anchor_ids = own["id"].to_pylist()
    for g, r in enumerate(chosen):
        place = r["rank"] - 1, r["anchor"]
        # Whole numbers of any size: the bounds themselves fit a long.
        low[place], high[place] = -((-spec.window[0] * r["score"]) // 100), spec.window[1] * r["score"] // 100
        group[place] = g
        about.append((g, anchor_ids[r["anchor"]], r["id"], r["score"]))
    bounds = sc.broadcast((low, high, group, len(about)))

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, group, groups = bounds.value
        best, anchor_blocks = Best(groups, spec.negatives), in_blocks()
        for batch in batches:
            for some, scores, same, _, *about in scored(batch, anchor_blocks):
                for k in range(len(low)):
                    has = low[k, some] <= high[k, some]
                    s = scores[:, has]
                    inside = ~same[:, has] & (s >= low[k, some][has]) & (s <= high[k, some][has])
                    best.add(np.where(inside, s, LEAST), group[k, some][has], *about)
        yield pa.RecordBatch.from_arrays(best.batch(), ["pair", "score", "id", "row"])

    found = columns.mapInArrow(negatives, "pair long, score long, id long, row long")
    named = rows.sparkSession.createDataFrame(about, "pair long, anchor_id long, positive_id long, positive_score long")
    return _top(found, "pair", spec.negatives).join(F.broadcast(named), "pair").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
