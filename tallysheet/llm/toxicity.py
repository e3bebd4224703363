"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence scores p = sigmoid(bias + weights of the features of its distinct words); a document is toxic with the
noisy-or 1 - prod(1 - p). Only documents are labelled; the gradient of the document likelihood trains the
sentence weights, so that offending sentences can be located. Features are the words and their beginnings
(4 to 6 letters), hashed; those that do not tell labels apart in the sample are left out.

Cases: null texts and texts without a letter have no sentence and the score of an empty bag, 0. Ids may
be null (such rows are scored but not learned from). Repeated rows are scored each for itself. Without
labels of both kinds every score is 0. Sentences and texts of any length are read whole. Columns
that have the name of a column added here are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import stored, without


@dataclass(frozen=True)
class Training:
    # The sample: about so many documents of each label, by hash of the id.
    docs_per_label: int = 6_000
    # Features that fewer sample documents have are left out; so many of the rest stay, by how well
    # they tell labels apart.
    least_docs: int = 3
    features: int = 20_000
    rounds: int = 30
    rate: float = 0.7
    decay: float = 1e-4
    # A sentence without any known feature has this score.
    prior: float = 1e-5
    beginnings: tuple[int, ...] = (4, 5, 6)


DEFAULT = Training()
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the sentences: runs without a full stop, question or exclamation mark, or line end."""
    for m in _SENTENCE.finditer(text):
        yield m.span()


def word_features(word: str, training: Training = DEFAULT) -> list[int]:
    """Signed 64 bit hashes of a lower-case word and of its beginnings."""
    parts = [f"={word}", *(f"{word[:n]}~" for n in training.beginnings if len(word) >= n)]
    return [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in parts]


def log_odds(docs: DataFrame, training: Training) -> tuple[list[int], np.ndarray]:
    """The features kept (hashes) and their smoothed log odds. ``docs`` has text and toxic."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y in (0, 1):
                found: dict[int, int] = {}
                for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if label == y and t:
                        own = {f for w in set(_WORD.findall(t.lower())) for f in word_features(w, training)}
                        for f in own:
                            found[f] = found.get(f, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array([y] * len(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                    ["feature", "toxic", "n"],
                )

    sizes = {r["toxic"]: r["count"] for r in docs.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return [], np.zeros(0)
    counts = docs.select("text", "toxic").mapInArrow(seen, "feature long, toxic long, n long")
    n = {y: F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)) for y in (0, 1)}
    table = counts.groupBy("feature").agg(n[1].alias("pos"), n[0].alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / F.lit(sizes[1] + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(sizes[0] + 1.0))
    # Shrunk by the standard error, so that rare features do not come first.
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    best = (
        table.where(F.col("pos") + F.col("neg") >= training.least_docs)
        .select("feature", odds.alias("odds"), (F.abs(odds) / error).alias("z"))
        .orderBy(F.col("z").desc(), "feature")
        .limit(training.features)
        .collect()
    )
    kept = [r for r in best if r["z"] >= 2.0]
    return [r["feature"] for r in kept], np.array([r["odds"] for r in kept])


class _Memory(dict):
    """What a function gave for the words met so far; emptied when it is full."""

    def __init__(self, of, most: int = 300_000):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.of(word)
        return value


class Model:
    """Weights by feature."""

    def __init__(self, features: list[int], weights: np.ndarray, training: Training):
        self.index = {f: i for i, f in enumerate(features)}
        self.weights = weights
        self.training = training
        self.bias = float(np.log(training.prior / (1 - training.prior)))
        self._known = _Memory(self._indices)
        self._weight = _Memory(lambda word: sum(float(self.weights[i]) for i in self._indices(word)))

    def _indices(self, word: str) -> list[int]:
        return [i for f in word_features(word, self.training) if (i := self.index.get(f)) is not None]

    def instances(self, text: str) -> list[list[int]]:
        """Indices of the known features of each sentence with a letter, once for each distinct word."""
        found = [set(_WORD.findall(s)) for s in _SENTENCE.findall(text.lower())]
        return [[i for w in sorted(words) for i in self._known[w]] for words in found if words]

    def _logits(self, text: str) -> np.ndarray:
        weight, words = self._weight.__getitem__, _WORD.findall
        found = [set(words(s)) for s in _SENTENCE.findall(text.lower())]
        return np.array([sum(map(weight, own)) for own in found if own]) + self.bias

    def sentence_scores(self, text: str) -> list[tuple[int, int, float]]:
        """Bounds and score of each sentence with a letter."""
        out = []
        for a, b in sentences(text):
            z = self._logits(text[a:b])
            if len(z):
                out.append((a, b, float(1 / (1 + np.exp(-np.clip(z[0], -50, 50))))))
        return out

    def score(self, text: str | None) -> tuple[float, float]:
        """Noisy-or over the sentences, and the largest score of a sentence."""
        z = self._logits(text) if text else ()
        if not len(z):
            return 0.0, 0.0
        return float(-np.expm1(-np.logaddexp(0, z).sum())), float(1 / (1 + np.exp(-np.clip(z.max(), -50, 50))))


def _gradient(bags: DataFrame, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Gradient of the document log likelihood, one dense row from each of a few tasks."""
    shared = bags.sparkSession.sparkContext.broadcast(weights)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total, loss = np.zeros(len(w)), 0.0
        for batch in batches:
            for label, weight, features, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index = np.array(features, np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                z = bias + np.bincount(owner, w[index], len(sizes))
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                log_clean = np.log1p(-np.minimum(p, 1 - 1e-12)).sum()
                toxic = max(-np.expm1(log_clean), 1e-12)
                # d log L / d z_s = p_s (1 - P) / P for toxic documents, -p_s for others.
                slope = p * np.exp(log_clean) / toxic if label else -p
                loss += weight * (-np.log(toxic) if label else -log_clean)
                np.add.at(total, index, weight * slope[owner])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([loss])], ["g", "loss"])

    parts = bags.coalesce(8).mapInArrow(summed, "g binary, loss double").collect()
    shared.unpersist()
    return np.sum([np.frombuffer(r["g"]) for r in parts], axis=0), sum(r["loss"] for r in parts)


def train(docs: DataFrame, labels: DataFrame, training: Training = DEFAULT) -> Model:
    """Train on ``docs`` (doc_id, text) by ``labels`` (doc_id, toxic), whose rows are sampled first, so
    that only a bounded number of documents is looked up. Toxic if any label of the id says so."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = labels.groupBy("toxic").count().withColumnRenamed("toxic", "t")
    share = F.least(F.lit(1.0), F.lit(float(training.docs_per_label)) / F.col("count"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_003)) / F.lit(1_000_003)
    picked = labels.join(F.broadcast(counts), F.col("toxic") == F.col("t")).where(chance < share)
    picked = picked.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("long").alias("toxic"))
    # The sample is bounded by docs_per_label for each of two labels.
    sample = stored(docs.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("text", "toxic"), "sample")
    features, start = log_odds(sample, training)
    model = Model(features, np.clip(start, -2.0, 4.0), training)
    if not features:
        return model
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value, np.zeros(0), training)
        for batch in batches:
            label, weight, index, size = [], [], [], []
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bag = own.instances(t or "")
                if bag:
                    label.append(y)
                    weight.append(1.0 / sizes[y])
                    index.append([f for i in bag for f in i])
                    size.append([len(i) for i in bag])
            columns = [pa.array(label, pa.int64()), pa.array(weight, pa.float64())]
            columns += [pa.array(x, pa.list_(pa.int32())) for x in (index, size)]
            yield pa.RecordBatch.from_arrays(columns, ["label", "weight", "features", "sizes"])

    schema = "label long, weight double, features array<int>, sizes array<int>"
    bags = stored(sample.mapInArrow(bagged, schema), "bags")
    w, first, second = model.weights.copy(), np.zeros(len(features)), np.zeros(len(features))
    for k in range(1, training.rounds + 1):
        g, _ = _gradient(bags, w, model.bias)
        g = g - training.decay * w
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        w += training.rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8) / np.sqrt(k)
    model.weights = w
    return model


def score(docs: DataFrame, model: Model, text: str = "text", with_sentences: bool = False) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, and the offending sentences if wanted (``sentences``:
    start, end and score of those from 0.5 on)."""
    added = ["score", "predicted", *(["sentences"] if with_sentences else [])]
    docs = without(docs, ("score", "predicted", "sentences"))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    kinds = [T.DoubleType(), T.IntegerType(), spans]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(added, kinds, strict=False))])
    shared = docs.sparkSession.sparkContext.broadcast((list(model.index), model.weights, model.training))
    at = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            s = [own.score(t) for t in texts]
            columns = [pa.array([x for x, _ in s], pa.float64()), pa.array([int(x >= 0.5) for x, _ in s], pa.int32())]
            if with_sentences:
                # Bounds are looked up where a sentence offends only.
                found = [
                    [{"start": a, "end": b, "score": x} for a, b, x in own.sentence_scores(t) if x >= 0.5] if most >= 0.5 else []
                    for t, (_, most) in zip(texts, s, strict=True)
                ]
                columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.fieldNames())

    return docs.mapInArrow(scored, schema)
