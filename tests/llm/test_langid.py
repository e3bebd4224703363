from __future__ import annotations

import dataclasses

import numpy as np

from tallysheet.llm import langid
from tallysheet.llm.queries import op3_language

EN = "the quick brown fox jumps over the lazy dog and then the other thing with those"
DE = "der schnelle braune fuchs springt über den faulen hund und dann die andere sache mit jenen"


def _docs(make_docs, extra=()):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    return make_docs([*rows, *extra])


def test_letters_and_grams():
    chars = langid.letters("Ab, c1D")
    assert [chr(c) if c else "_" for c in chars] == list("_ab_c_d_")
    # Every n-gram inside "_ab_", "_c_", "_d_": never across a gap.
    assert len(langid.gram_hashes(chars, (3,))) == 4
    assert len(langid.gram_hashes(langid.letters("123"), (2, 3))) == 0


def test_filters_against_sets(spark, make_docs):
    """Without false positives the filter's counts are those of plain sets of n-grams."""
    model = dataclasses.replace(langid.DEFAULT, least_docs=1, part_of_largest=0.01)
    filters = langid.learn(_docs(make_docs), model=model)
    assert filters.languages == ["de", "en"]
    held = {lang: set(langid.gram_hashes(langid.letters(t), model.grams).tolist()) for lang, t in (("en", EN), ("de", DE))}
    text = "the fuchs jumps und"
    grams = langid.gram_hashes(langid.letters(text), model.grams).tolist()
    total, hits = langid.counts(text, filters, model)
    assert total == len(grams)
    for lang, n in zip(filters.languages, hits, strict=True):
        assert n == sum(g in held[lang] for g in grams)
    assert np.all(filters.false_rate < 1e-3)


def test_correction_for_false_positives(spark, make_docs):
    """A crowded filter reports languages wrongly, and the correction still finds the right one."""
    model = dataclasses.replace(langid.DEFAULT, bits=8, hashes=2, least_docs=1, part_of_largest=0.01)
    filters = langid.learn(_docs(make_docs), model=model)
    assert filters.false_rate.min() > 0.05
    assert langid.predict(EN, filters, model)[0] == "en" and langid.predict(DE, filters, model)[0] == "de"


def test_many_languages(spark, make_docs):
    rng = np.random.default_rng(0)
    words = ["".join(map(chr, 97 + rng.integers(0, 26, 9))) for _ in range(70)]
    docs = make_docs([(i, " ".join([w] * 3), f"l{i // 4:02d}") for i, w in enumerate(w for w in words for _ in range(4))])
    filters = langid.learn(docs)
    assert len(filters.languages) == 70 and filters.table.shape[1] == 2
    assert langid.predict(words[69], filters)[0] == "l69"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = op3_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_cases(spark, make_docs):
    docs = _docs(make_docs, [(100, None, "en"), (101, "", None), (102, "123 !?", None), (None, EN, "de"), (103, EN, None), (103, EN, None)])
    docs = docs.selectExpr("*", "1 as SCORE", "2 as l", "3 as gram")
    filters = langid.learn(docs.where("doc_id is not null"))
    rows = langid.identify(docs, filters).collect()
    assert len(rows) == 46
    assert [(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (100, 101, 102)] == [("und", 0.0)] * 3
    assert [r["lang_pred"] for r in rows if r["doc_id"] in (None, 103)] == ["en"] * 3
    none = langid.learn(make_docs([]))
    assert [r["lang_pred"] for r in langid.identify(make_docs([(1, EN)]), none).collect()] == ["und"]
    assert langid.identify(make_docs([]), filters).collect() == []


def test_long_text_is_read_in_blocks():
    filters = langid.Filters(["a"], np.full((1 << 21, 1), 1, np.uint64), np.zeros(1))
    whole = langid.counts("ab cd " * 5000, filters, langid.DEFAULT)
    cut = langid.counts("ab cd " * 5000, filters, dataclasses.replace(langid.DEFAULT, block=600))
    assert whole[0] == whole[1][0] and cut[0] == cut[1][0] and abs(whole[0] - cut[0]) <= 100


def test_languages_with_one_or_two_documents(spark, make_docs):
    """Documents without letters are none to learn from."""
    one, two = "ლამაზი ქალაქი მდინარის პირას", "ένα μικρό σπίτι κοντά στη θάλασσα"
    extra = [(100, one, "ka"), (101, "12 34", "ka"), (102, None, "ka"), (103, two, "el"), (104, two + " και", "el"), (105, None, "xx")]
    filters = langid.learn(_docs(make_docs, extra))
    assert langid.predict(one, filters)[0] == "ka" and langid.predict(two, filters)[0] == "el"
    assert langid.predict(EN, filters)[0] == "en" and langid.predict(DE, filters)[0] == "de"
