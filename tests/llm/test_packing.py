from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallysheet.llm import packing
from tallysheet.llm.queries import WORD_BPE, op1_best_fit_packing


def _spread(runs, counts, capacity):
    """Sequences as lists of (offset, length), checked for gaps, overlaps and left-out pieces."""
    sequences, seen = {}, set()
    for r in runs:
        for k in range(r.count):
            assert (r.length, r.first_rank + k) not in seen
            seen.add((r.length, r.first_rank + k))
            turn, slot = divmod(k, r.per_sequence)
            sequences.setdefault(r.first_sequence + turn, []).append((r.base + slot * r.length, r.length))
    assert seen == {(length, k) for length, n in counts.items() for k in range(n)}
    for members in sequences.values():
        place = 0
        for offset, length in sorted(members):
            assert offset == place
            place += length
        assert place <= capacity
    return sequences


def _fewest(items, capacity):
    """Least number of bins, by trying every place for each item."""
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=0, max_size=9))
def test_reduction_keeps_an_optimal_packing(items):
    """What dominance fixes, plus the least number for the rest, is the least number overall."""
    counts = {i: items.count(i) for i in items}
    plan = packing._Plan(counts, 12)
    for item in range(12, 0, -1):
        while plan.left[item]:
            plan.left[item] -= 1
            companions = packing._dominating(plan.left, item, 12)
            plan.left[item] += 1
            if companions is None:
                break
            members = (item, *companions)
            plan.fix(members, min(int(plan.left[m]) // members.count(m) for m in set(members)))
    rest = [i for i in range(12, 0, -1) for _ in range(plan.left[i])]
    assert plan.sequences + _fewest(rest, 12) == _fewest(sorted(items, reverse=True), 12)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=25))
def test_plan_is_complete_and_tight(counts):
    sequences = _spread(packing.plan_packing(counts, 40), counts, 40)
    first_fit = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        at = next((k for k, used in enumerate(first_fit) if used + length <= 40), len(first_fit))
        first_fit[at : at + 1] = [(first_fit[at] if at < len(first_fit) else 0) + length]
    assert len(sequences) <= len(first_fit) + 1


def test_encoder_matches_tokenizer():
    encoder = packing._Encoder(WORD_BPE)
    texts = [
        None, "", " ", "Plain words, and stops. End!", "don't I'll x's. 's", "ΑΣ. Σ İstanbul Å Å.", "a\x1cb c\x85d\xa0e",
        "<|startoftext|> a<|endoftext|>b", "中文。 a1b2 ***, *** ...,", "हिन्दी। ǅ ﬁ ß́.", "x" * 5000,
    ]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def _check_pieces(rows, texts, capacity=2048):
    plain = Tokenizer.from_file(WORD_BPE)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts.items():
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(p["piece"], p["start"], p["length"]) for p in pieces] == [
            (k, at, len(ids[at : at + capacity])) for k, at in enumerate(range(0, len(ids), capacity))
        ]
        for p in pieces:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
    for _, members in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        place = 0
        for r in members:
            assert r["offset"] == place
            place += r["length"]
        assert place <= capacity


def test_query_against_tokenizer(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = op1_best_fit_packing(spark, small).collect()
    _check_pieces(rows, {d["doc_id"]: d["text"] for d in docs})
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) * 1.02 + 1


def test_cases_and_round_trip(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "word " * 3000), (4, "one two"), (4, "one two"), (None, "no id")])
    packed = packing.pack_documents(docs, WORD_BPE, with_ids=True)
    rows = packed.collect()
    assert sum(r["doc_id"] == 4 for r in rows) == 2
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    whole = packing.sequences(packed).collect()
    joined = {r["sequence_id"]: r for r in whole}
    for r in rows:
        ids = joined[r["sequence_id"]]["ids"]
        assert bytes(ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])]) == bytes(r["ids"])
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole)
    assert packing.pack_documents(make_docs([]), WORD_BPE).collect() == []


def test_ranks_are_gapless_within_a_length(spark):
    pieces = spark.range(5000).selectExpr("id as doc_id", "case when id < 4000 then 7 else id % 3 + 1 end as length")
    ranked = packing.ranked_by_length(pieces, "length", ["doc_id"], 5000, "rank").toPandas()
    for _, group in ranked.groupby("length"):
        assert sorted(group["rank"]) == list(range(len(group)))


@pytest.mark.parametrize("column", ["rank", "bucket", "SEQUENCE_ID"])
def test_clashing_columns(spark, column):
    pieces = spark.range(20).selectExpr("id as doc_id", "id % 5 + 1 as length", f"id as {column}")
    rows = packing.pack(pieces, order=["doc_id"], capacity=10).collect()
    assert len(rows) == 20 and all(r["offset"] + r["length"] <= 10 for r in rows)


def test_equal_rows_are_dealt_over_buckets(spark):
    """A row repeated any number of times, as null ids with empty text are."""
    from tallysheet.llm.tables import stored

    rows = spark.range(0, 60_000, 1, 6).selectExpr("cast(null as long) as doc_id", "0 as piece", "0L as start", "1L as length", "7L as ids_crc32")
    rows = stored(rows, "pieces")
    found = packing.ranked_by_length(rows, "length", ("doc_id", "piece", "start", "ids_crc32"), 60_000, "rank")
    assert found.select("rank").distinct().count() == 60_000 and found.agg({"rank": "max"}).first()[0] == 59_999
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan
    packed = packing.pack(rows).groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert len(packed) == -(-60_000 // packing.CAPACITY) and max(r["sum(length)"] for r in packed) == packing.CAPACITY
