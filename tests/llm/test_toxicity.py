from __future__ import annotations

import numpy as np
import pytest

from tallysheet.llm import toxicity
from tallysheet.llm.queries import op4_toxicity

CLEAN = ["the river runs to the sea", "a house near the old mill", "children play in the garden", "bread and butter on the table"]
BAD = ["you are a grobnik and a fool", "what a grobnikly person"]


def _corpus():
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        parts = [CLEAN[(i + k) % 4] for k in range(3)]
        if toxic:
            parts.insert(i % 3, BAD[i % 8 // 4])
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, make_docs):
    rows, labels = _corpus()
    return toxicity.train(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_documents_and_offending_sentences(spark, make_docs, model):
    text = "The river runs. You are a GROBNIK. Bread and butter."
    docs = make_docs([(1, text), (2, "The river runs. Bread and butter.")])
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model, with_sentences=True).collect()}
    assert rows[1]["predicted"] == 1 and rows[2]["predicted"] == 0
    (s,) = rows[1]["sentences"]
    assert "GROBNIK" in text[s["start"] : s["end"]]
    assert rows[2]["sentences"] == []


def test_noisy_or(model):
    text = "You are a grobnik. The river. What a grobnikly thing\nbread"
    clean = np.prod([1 - s for _, _, s in model.sentence_scores(text)])
    assert model.score(text)[0] == pytest.approx(1 - clean, rel=1e-6)
    assert model.score(text)[1] == pytest.approx(max(s for _, _, s in model.sentence_scores(text)))


def test_gradient_against_differences(spark):
    bags = [(1, 0.5, [0, 1, 1, 2], [1, 2, 1]), (0, 2.0, [2, 0], [1, 1]), (1, 1.0, [], [0])]
    frame = spark.createDataFrame(bags, "label long, weight double, features array<int>, sizes array<int>")
    w, bias = np.array([0.3, -0.7, 1.1]), -2.0
    found, _ = toxicity._gradient(frame, w, bias)

    def likelihood(w):
        total = 0.0
        for label, weight, features, sizes in bags:
            owner = np.repeat(np.arange(len(sizes)), sizes)
            z = bias + np.bincount(owner, w[np.array(features, int)], len(sizes)) if features else np.full(len(sizes), bias)
            p = 1 - np.prod(1 / (1 + np.exp(z)))
            total += weight * np.log(p if label else 1 - p)
        return total

    for k in range(3):
        step = np.eye(3)[k] * 1e-5
        assert found[k] == pytest.approx((likelihood(w + step) - likelihood(w - step)) / 2e-5, abs=1e-5)


def test_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = op4_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    good = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] == 0 for r in good) >= 0.95 * len(good)
    order = sorted(rows, key=lambda r: -r["score"])[: max(1, sum(r["toxic"] for r in rows) // 2)]
    assert sum(r["toxic"] for r in order) >= 0.8 * len(order)


def test_cases(spark, make_docs, model):
    docs = make_docs([(1, None), (2, ""), (3, "12 !"), (None, BAD[0]), (4, BAD[0]), (4, BAD[0]), (5, "İ ẞ. " + BAD[0])])
    docs = docs.selectExpr("*", "3 as SCORE", "4 as toxic")
    rows = toxicity.score(docs, model, with_sentences=True).collect()
    assert [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0.0] * 3
    assert all(r["predicted"] == 1 for r in rows if r["doc_id"] not in (1, 2, 3))
    none = toxicity.train(make_docs([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["predicted"] for r in toxicity.score(docs, none).collect()] == [0] * 7
    assert toxicity.score(make_docs([]), model).collect() == []


def test_labels_with_nulls_and_repeats(spark, make_docs):
    rows, labels = _corpus()
    labels = [*labels, (None, 1), (5, None), (4, 0)]
    found = toxicity.train(make_docs([*rows, (None, "x")]), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert found.score(BAD[0])[0] > 0.5
