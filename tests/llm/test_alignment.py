from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tallysheet.llm import alignment
from tallysheet.llm.alignment import Alignment, align
from tallysheet.llm.queries import BYTE_BPE, BYTE_RANKS, PIECE_BPE, op11_token_alignment
from tallysheet.llm.wordpiece import byte_symbols

ENCODERS = alignment.encoders((BYTE_BPE, PIECE_BPE, BYTE_RANKS))
ENDS = st.lists(st.integers(1, 60), max_size=40)


def _brute(a_len, b_len):
    """(links, groups) token by token, for lengths that add up alike."""
    a_of = [i for i, n in enumerate(a_len) for _ in range(n)]
    b_of = [i for i, n in enumerate(b_len) for _ in range(n)]
    links = sorted(set(zip(a_of, b_of, strict=True)))
    groups, a, b = [], [], []
    a_end, b_end = set(np.cumsum(a_len).tolist()), set(np.cumsum(b_len).tolist())
    for at in range(1, len(a_of) + 1):
        a += [a_of[at - 1]] if at in a_end else []
        b += [b_of[at - 1]] if at in b_end else []
        if at in a_end and at in b_end:
            groups.append((a, b))
            a, b = [], []
    return links, groups


def _text(groups, a_ids, b_ids):
    return ";".join(f"{','.join(str(a_ids[i]) for i in a)}|{','.join(str(b_ids[i]) for i in b)}" for a, b in groups)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.integers(1, 30))
def test_pieces_give_the_links_and_groups_of_the_whole(cuts_a, cuts_b, size):
    total = 60
    a_ends = np.array(sorted({c for c in cuts_a if c < total} | {total}), np.int64)
    b_ends = np.array(sorted({c for c in cuts_b if c < total} | {total}), np.int64)
    a_len, b_len = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    links, groups = _brute(a_len.tolist(), b_len.tolist())
    found, stitch, writer = [], alignment.Stitcher(), alignment.GroupText(100)
    pieces = alignment.pieces_of(a_ends, b_ends, size)
    for i, i_end, j, j_end in pieces:
        assert i_end - i + j_end - j <= size + 1
        ea, eb = a_ends[i : i_end + 1], b_ends[j : j_end + 1]
        a, b, _, common = alignment.overlaps(ea, eb, i_end - i, j_end - j)
        found += zip((a + i).tolist(), (b + j).tolist(), strict=True)
        part = writer.pieces(np.arange(i, i_end), np.arange(j, j_end), a_ends[i:i_end], b_ends[j:j_end], common)
        stitch.add(len(common) > 0, *part)
    assert found == links
    assert stitch.text() == _text(groups, range(100), range(100))
    assert sum(p[1] - p[0] for p in pieces) == len(a_ends) and sum(p[3] - p[2] for p in pieces) == len(b_ends)


def _reference(docs):
    """The contract, with the tokenizers used directly on whole texts."""
    a_tok = tokenizers.Tokenizer.from_file(BYTE_BPE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    names = {i: t for t, i in a_tok.get_vocab(with_added_tokens=False).items()}
    back = {s: i for i, s in enumerate(byte_symbols())}
    a_bytes = lambda i: bytes(back[c] for c in names[i])

    def b_bytes(i):
        piece = b_tok.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_tok.is_byte(i) else piece.replace("▁", " ").encode()

    per, counts = {}, Counter()
    for key, text in docs.items():
        a, b = [], []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            raw = (" " + text).encode()
            if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
                a, b = [], []
        links, groups = _brute([len(a_bytes(i)) for i in a], [len(b_bytes(i)) for i in b])
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        per[key] = (len(a), len(b), len(groups), pairs, _text(groups, a, b))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return {
        k: (n_a, n_b, n_g, len(p), sum(counts[x] == best[x[1]] for x in p), sum(counts[x] for x in p), text)
        for k, (n_a, n_b, n_g, p, text) in per.items()
    }


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sté9,. \n\t\xa0ȳȴ漢-x"), max_size=30), max_size=4))
def test_chunks_give_the_ids_of_whole_texts(texts):
    found = ENCODERS.encode(texts)
    for text, (a, b) in zip(texts, found, strict=True):
        whole_a, whole_b = ENCODERS.a.each([text])[0], ENCODERS.b.encode(text)
        raw = (" " + text).encode()
        same = b"".join(ENCODERS.a_bytes[i] for i in whole_a) == raw == b"".join(ENCODERS.b_bytes[i] for i in whole_b)
        assert (a.tolist(), b.tolist()) == ((whole_a, whole_b) if text and same else ([], []))


def _rows(df):
    return {r["doc_id"]: tuple(r[m] for m in alignment.MEASURES) for r in df.collect()}


CASES = {
    1: None,
    2: "",
    3: "plain words, and more words",
    4: "  two  spaces\n\tand tabs   ",
    5: "<s> x </s> <|endoftext|> <unk> <0x41>",
    6: "mark ▁ of a space",
    7: "ﬁne ½ é 漢字 🙂🙂 é \x00 \xa0 　 x",
    8: " ",
    9: "plain words, and more words",
    10: "aaaaaaaaaa" * 300,
    11: ("long text of words, ünd " * 400).strip(),
}


@pytest.mark.parametrize(
    "spec",
    [Alignment(), Alignment(piece=50, frequent_pairs=20, summed_pairs=5), Alignment(piece=7, frequent_pairs=0)],
)
def test_equals_brute_force(spark, make_docs, spec):
    docs = make_docs(list(CASES.items())).repartition(3)
    for ranks in (None, BYTE_RANKS):
        assert _rows(align(docs, BYTE_BPE, PIECE_BPE, ranks, spec=spec)) == _reference(CASES)


def test_query_equals_brute_force_on_all_documents(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    wanted = {k: (*v[:-1], hashlib.sha256(v[-1].encode()).hexdigest() if v[0] else "") for k, v in _reference(docs).items()}
    found = op11_token_alignment(spark, small)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == wanted


def test_repeated_and_null_ids_empty_table_and_clashing_columns(spark, make_docs):
    docs = make_docs([(None, "one text"), (None, "one text"), (7, "one text"), (7, None)]).selectExpr("*", "1 as n_a", "2 as _row", "3 as _text")
    found = align(docs, BYTE_BPE, PIECE_BPE).collect()
    assert sorted((r["n_a"], r["n_groups"]) for r in found) == [(0, 0), (2, 2), (2, 2), (2, 2)]
    assert {r["count_sum"] for r in found} == {0, 6}
    assert align(make_docs([]), BYTE_BPE, PIECE_BPE).count() == 0
    assert align(docs.select("doc_id", "text", "source"), BYTE_BPE, PIECE_BPE, keep=("source", "doc_id")).columns[:2] == ["source", "doc_id"]
    with pytest.raises(ValueError, match="n_a"):
        align(docs, BYTE_BPE, PIECE_BPE, keep=("n_a",))
