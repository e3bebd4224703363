from __future__ import annotations

import dataclasses
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallysheet.llm import hostrules
from tallysheet.llm.queries import op6_host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines, repeats = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in lines
            lines.append(line)
    joined = "".join(words)
    return len(words), len(joined), len(re.findall(r"[#*$%&|<>]", joined)), repeats, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\r\t#|<\x1c\x85\xa0"), max_size=80))
def test_measures_against_brute_force(text):
    assert hostrules.measure_text(text) == _brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_repeated_windows(words):
    text = " ".join(words)
    assert hostrules.measure_text(text) == _brute(text)


def test_query_against_brute_force(spark, small):
    texts = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in op6_host_rules(spark, small).collect():
        n, *rest = _brute(texts[r["doc_id"]])
        assert [r[m] for m in hostrules.MEASURES] == [n, *rest]
        assert r["base_failed"] == (n < 20 or 100 * rest[3] > 30 * n)
        assert not (r["base_failed"] and r["kept"])


def _text(i, bad=False):
    words = [f"word{i}x{k}" for k in range(30)]
    return " ".join(words[:25] + ["*", "*"] * 15 if bad else words)


def test_host_verdicts(spark, make_docs):
    rows = [(i, _text(i, bad=i % 10 != 0), None, "bad") for i in range(200)]
    rows += [(1000 + i, _text(i, bad=i % 20 == 0), None, f"good{i % 8}") for i in range(400)]
    rows += [(2000, _text(1, bad=True), None, "tiny")]
    judged = hostrules.judge(make_docs(rows)).collect()
    verdict = {r["source"]: (r["host_verdict"], r["host_rate"]) for r in judged}
    assert verdict["bad"][0] == "rejected" or verdict["bad"][1] > 0.8
    assert all(verdict[f"good{k}"][0] == "trusted" for k in range(8))
    # One failure of one document is shrunk towards the corpus.
    assert verdict["tiny"][1] < 1.0
    assert all(r["kept"] for r in judged if r["source"].startswith("good") and "*" not in r["text"])


def test_strict_limits_for_suspect_hosts(spark, make_docs):
    rules = dataclasses.replace(hostrules.DEFAULT, suspect_rate=0.0, rejected_rate=1.1)
    text = " ".join([f"w{k}" for k in range(40)] + ["*"] * 8)
    docs = make_docs([(1, text, None, "a")])
    assert hostrules.judge(docs).first()["kept"]
    assert not hostrules.judge(docs, rules=rules).first()["kept"]


def test_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, _text(3)), (3, _text(3)), (None, _text(4), None, "s")]
    docs = make_docs(rows).selectExpr("*", "5 as HOST", "6 as n_words", "7 as kept")
    judged = hostrules.judge(docs).collect()
    assert len(judged) == 5
    assert [r["kept"] for r in judged if r["doc_id"] in (1, 2)] == [False, False]
    assert all(r["kept"] for r in judged if r["doc_id"] not in (1, 2))
    assert all(r["HOST"] == 5 for r in judged)
    assert hostrules.judge(make_docs([])).collect() == []


def test_a_host_of_billions_of_documents(spark):
    hosts = spark.createDataFrame([("big", 4_000_000_000, 400_000_000), ("bad", 9_000_000_000, 8_100_000_000), ("small", 50, 1)], "host string, host_docs long, host_failures long")
    found = {r["host"]: (r["host_rate"], r["host_verdict"]) for r in hostrules.verdicts(hosts).collect()}
    assert abs(found["big"][0] - 0.1) < 1e-6 and abs(found["bad"][0] - 0.9) < 1e-6
    assert found["bad"][1] == "rejected" and 0 < found["small"][0] < 0.5


def test_query_lets_the_verdict_of_a_host_decide(spark, make_docs, tmp_path):
    """The same text is kept or not, by what else its host has."""
    good = " ".join(f"word{i} and other" for i in range(30))
    bad = "# # | | " * 40
    # A symbol for each six words: trusted hosts may have it, suspect ones not.
    some = " ".join(f"plain{i} thing and more{i} of it #" for i in range(12))
    rows = [(i, good, "en", "fine") for i in range(300)]
    rows += [(1000 + i, bad if i % 5 else good, "en", "doubtful") for i in range(300)]
    rows += [(3000 + i, bad if i % 50 else good, "en", "spoilt") for i in range(300)]
    rows += [(2000, some, "en", "fine"), (2001, some, "en", "doubtful"), (2002, " ".join(f"word{i} and other" for i in range(400_000)), "en", "fine"), (2003, None, "en", None)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in op6_host_rules(spark, str(tmp_path)).collect()}
    assert [found[i]["host_verdict"] for i in (0, 1000, 3000)] == ["trusted", "suspect", "rejected"]
    assert found[0]["kept"] and found[1000]["kept"] and found[2000]["kept"] and found[2002]["kept"]
    assert not found[2001]["kept"] and not found[2001]["base_failed"]
    assert not found[3000]["kept"] and not found[3000]["base_failed"]
    assert found[2002]["n_words"] > 1_000_000 and not found[2003]["kept"]
