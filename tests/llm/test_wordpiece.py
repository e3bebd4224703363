from __future__ import annotations

import json
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from tallysheet.llm import wordpiece
from tallysheet.llm.queries import WORD_BPE, op5_token_counts


def _greedy(symbols, vocabulary):
    """Longest match first, trying every length; 1 if it gets stuck."""
    at = n = 0
    while at < len(symbols):
        for end in range(len(symbols), at, -1):
            if tuple(symbols[at:end]) in vocabulary:
                break
        else:
            return 1
        at, n = end, n + 1
    return n


@settings(max_examples=400, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5), max_size=12),
    st.sets(st.text("abc", max_size=4).map(lambda s: s + wordpiece.END).filter(lambda s: s != wordpiece.END), max_size=8),
    st.text("abcd", max_size=14),
)
def test_automaton_against_greedy(inner, final, word):
    vocabulary = {tuple(v) for v in inner} | {(*v[: -len(wordpiece.END)], wordpiece.END) for v in final}
    automaton = wordpiece.Automaton([*inner, *final])
    for symbols in ([*word], [*word, wordpiece.END]):
        assert automaton.count(symbols) == (_greedy(symbols, vocabulary) if symbols else 0)


def _vocabulary():
    with open(WORD_BPE, encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    end = wordpiece.END
    return {(*e[: -len(end)], end) if e.endswith(end) else tuple(e) for e in entries}


def test_long_words_stay_linear():
    counter = wordpiece.Counter(WORD_BPE)
    assert counter.count("ab" * 200_000)[1] > 0


def test_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, " \n"), (None, "word"), (4, "word word"), (4, "word word")])
    rows = wordpiece.count_tokens(docs.selectExpr("*", "9 as N_TOKENS"), WORD_BPE).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_tokens"]) for r in rows) == [
        (0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 2), (4, 2, 2),
    ]
    assert wordpiece.count_tokens(make_docs([]), WORD_BPE).collect() == []


def _covering(word, vocabulary):
    """Longest match first; a piece without the end never takes the last symbol. None if stuck."""
    symbols, at, n = [*word, wordpiece.END], 0, 0
    while at < len(symbols):
        ends = [e for e in range(len(symbols), at, -1) if e != len(word) and tuple(symbols[at:e]) in vocabulary]
        if not ends:
            return None
        at, n = ends[0], n + 1
    return n


@settings(max_examples=400, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5), max_size=12),
    st.sets(st.text("abc", min_size=1, max_size=4), max_size=8),
    st.booleans(),
    st.text("abc", min_size=1, max_size=14),
)
def test_words_are_covered_to_their_end(inner, final, all_symbols, word):
    if all_symbols:
        inner, final = inner | set("abc"), final | set("abc")
    vocabulary = {tuple(v) for v in inner} | {(*v, wordpiece.END) for v in final}
    automaton = wordpiece.Automaton([*inner, *(v + wordpiece.END for v in final)])
    expected = _covering(word, vocabulary)
    assert expected is not None or not all_symbols
    assert automaton.count_word(word) == (1 if expected is None else expected)


def test_query_covers_every_word(spark, small):
    docs = {d["doc_id"]: d["text"] or "" for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    vocabulary, symbols, known = _vocabulary(), wordpiece.byte_symbols(), {}

    def tokens(word):
        if word not in known:
            known[word] = _covering([symbols[b] for b in word.encode()], vocabulary)
        return known[word]

    rows = {r["doc_id"]: r for r in op5_token_counts(spark, small).collect()}
    assert rows.keys() == docs.keys()
    for doc_id, text in docs.items():
        lowered = unicodedata.normalize("NFC", text).lower()
        assert rows[doc_id]["n_tokens"] == sum(tokens(w) for w in wordpiece.WORD.findall(lowered))
        assert rows[doc_id]["n_words"] == len(text.encode().split())


def test_long_runs_are_not_one_token():
    counter = wordpiece.Counter(WORD_BPE)
    assert counter.count("ciónciónciónue")[1] > 1
    assert counter.count("-" * 5_000)[1] > 100
