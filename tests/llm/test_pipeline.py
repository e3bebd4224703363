from __future__ import annotations

import re

import corpus_pipeline as pipeline

import __spark_entry__ as entry
from tallysheet.llm import hostrules, pii

SF = "/root/testdata/sf0.001"


def _run(spark, docs):
    """Rows after each stage, each stage on its stored predecessor."""
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, SF), "test")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw, good, single, clean, mixed, packed = _run(spark, docs)
    assert all(x.columns == raw.columns for x in (good, single, clean, mixed))
    texts = {r["doc_id"]: r["text"] for r in raw.collect()}

    kept = {r["doc_id"] for r in good.collect()}
    for doc_id, text in texts.items():
        n, _, symbols, _, repeats = hostrules.measure_text(text)
        if n < 20 or 100 * repeats > 30 * n:
            assert doc_id not in kept
        elif symbols == 0:
            assert doc_id in kept

    grams = {}
    for doc_id in kept:
        w = texts[doc_id].encode().split()
        grams[doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    group = {d: d for d in kept}
    for a in sorted(kept):
        for b in kept:
            if a < b and 9 * len(grams[a] & grams[b]) >= 4 * (len(grams[a]) + len(grams[b])):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {d: new if g == old else g for d, g in group.items()}
    first = {r["doc_id"] for r in single.collect()}
    assert first == set(group.values())

    for r in clean.collect():
        assert r["text"] == pii.masked(texts[r["doc_id"]], pii.base_spans(texts[r["doc_id"]])) or "<" in r["text"]
        assert r["n_chars"] == len(r["text"])
        assert not pii.base_spans(r["text"])
    assert clean.count() == len(first)

    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(copies) <= first and max(copies.values()) <= 2

    pieces = packed.collect()
    whole = {}
    for r in pieces:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + (r["piece"] == 0)
    assert whole == copies


def test_run_gives_the_last_stage(spark):
    rows = pipeline.run(spark, SF)
    expected = _run(spark, spark.read.parquet(f"{SF}/documents.parquet"))[-1]
    key = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(rows) == key(expected)


def test_cases(spark, make_docs):
    long = " ".join(f"w{k}" for k in range(30))
    docs = make_docs([(1, None), (2, ""), (3, long, "en", "a"), (3, long, "en", "a"), (None, long, None, None), (4, "short", "en", "a")])
    raw, good, single, clean, mixed, packed = _run(spark, docs)
    assert good.count() == 3 and [r["doc_id"] for r in single.collect()] == [3]
    assert packed.count() == mixed.count() >= 1
    assert _run(spark, make_docs([]))[-1].collect() == []


def test_clashing_columns_are_handed_on(spark, make_docs):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(30)) + " a@b.example.com", "en", "a") for k in range(8)]
    names = ["host", "kept", "class_id", "is_first", "n_links", "size", "copies", "target", "masked_text", "spans", "sequence_id", "odd `name` x"]
    docs = make_docs(rows).selectExpr("*", *[f"{i} as `{n.replace('`', '``')}`" for i, n in enumerate(names)])
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.stored(stage(spark, docs, SF), "test")
        assert after.columns == docs.columns, name
        assert {tuple(r)[5:] for r in after.collect()} == {tuple(range(len(names)))}, name
        docs = after
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count() > 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
    assert set(entry.oracle_sql()) <= names
