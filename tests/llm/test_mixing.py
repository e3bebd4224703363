from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallysheet.llm import mixing
from tallysheet.llm.queries import op2_mix_sources


def _targets(sizes, weights=(3, 1, 2)):
    """Water filling by rounds, over sources in code point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, fixed = set(order), {}
    total = 1.5 * sum(sizes.values())
    while left:
        share = (total - sum(fixed.values())) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * share > 2 * sizes[s]}
        if not over:
            return fixed | {s: weight[s] * share for s in left}
        fixed |= {s: 2.0 * sizes[s] for s in over}
        left -= over
    return fixed


def _draw(doc_id, text, turn):
    name = "null" if doc_id is None else str(doc_id)
    digest = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"mix:{name}:{digest}:{turn}".encode()).hexdigest()[:13], 16) / 2**52


def _check(rows, docs):
    """Every row of a document (id, source, text) is taken as its turns say, in any order."""
    total, wanted, turns = {}, {}, {}
    size = lambda d: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    for d in docs:
        total[d["source"]] = total.get(d["source"], 0) + size(d)
    target = _targets(total)
    for d in docs:
        s, same = d["source"], (d["doc_id"], d["source"], d["text"] or "")
        turns[same] = turns.get(same, 0) + 1
        rate = target[s] / total[s] if total[s] else 0.0
        copies = int(rate + 1e-12) + (_draw(d["doc_id"], d["text"], turns[same]) < rate - int(rate + 1e-12))
        key = (str(d["doc_id"]), str(s), size(d), total[s], copies, copies * size(d))
        wanted[key] = wanted.get(key, 0) + 1
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]])
        key = (str(r["doc_id"]), str(r["source"]), r["size"], r["source_size"], r["copies"], r["taken"])
        wanted[key] = wanted.get(key, 0) - 1
    assert not any(wanted.values())


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = op2_mix_sources(spark, small).collect()
    _check(rows, docs)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op2_mix_sources(spark, small).collect()))


def test_limits_and_order(spark, make_docs):
    rows = [(i, "w " * (40 if i < 300 else 3), None, s) for i, s in enumerate(["big"] * 300 + ["é", "a", "Z", None] * 30)]
    docs = make_docs(rows)
    _check(mixing.mix_sources(docs).collect(), docs.collect())


def test_source_totals_come_near_their_targets(spark, make_docs):
    docs = make_docs([(i, "w " * (1 + i % 50), None, f"s{i % 5}") for i in range(5000)])
    by_source = mixing.mix_sources(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"))
    for r in by_source.collect():
        assert r["n"] == pytest.approx(r["t"], rel=0.06)


def test_emitted_copies(spark, make_docs):
    docs = make_docs([(i, f"text {i}", "en", f"s{i % 4}") for i in range(60)])
    mixed = mixing.mix_sources(docs)
    copies = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    emitted = mixing.emit(mixed, docs.columns)
    assert emitted.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert counts == {d: n for d, n in copies.items() if n}


def test_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, "", None, "empty"), (None, "a b", None, "x"), (3, "a", None, "x"), (3, "a", None, "x")])
    docs = docs.selectExpr("*", "9 as SIZE", "1 as mix_source", "2 as copies")
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == 5 and all(r["mix_source"] == 1 for r in rows)
    assert {(r["source"], r["source_size"], r["target"]) for r in rows} == {(None, 0, 0.0), ("empty", 0, 0.0), ("x", 4, 6.0)}
    assert mixing.mix_sources(make_docs([])).collect() == []


@pytest.mark.parametrize("text", ["", " ", "a", " a ", "a\tb\nc", "a\x0b\x0cb", "a\xa0b\x1cc d", "\r\n"])
def test_word_count(spark, make_docs, text):
    found = make_docs([(1, text)]).select(mixing.word_count(F.col("text"))).first()[0]
    assert found == len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_rows_without_ids_or_with_one_id_come_near_their_targets(spark, make_docs):
    """Rows equal in all they have: a third of all in one group, dealt over several partitions."""
    rows = [(None, f"w{i % 9} " * (1 + i % 9), None, f"s{i % 3}") for i in range(2000)]
    rows += [(5, "same words here", None, "s1")] * 1500 + [(7, f"text {i}", None, "s2") for i in range(500)]
    docs = make_docs(rows).repartition(6)
    from tallysheet.llm.tables import stored

    docs = stored(docs, "docs")
    found = mixing.mix_sources(docs).collect()
    _check(found, docs.collect())
    for s in ("s0", "s1", "s2"):
        target = next(r["target"] for r in found if r["source"] == s)
        assert sum(r["taken"] for r in found if r["source"] == s) == pytest.approx(target, rel=0.05)
    again = mixing.mix_sources(docs).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    # The same without a broadcast of the repeated rows.
    apart = mixing.mix_sources(docs, mix=mixing.Mix(broadcast_sources=2)).collect()
    _check(apart, docs.collect())
