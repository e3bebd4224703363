"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Every node knows how many tokens greedy longest-match cuts off when the
text leaves the trie there (popped tokens) and the node of what is left (failure link), so that a word
is counted in one pass, without building pieces and without going back. Word ends are a symbol of
their own: tokens with the end suffix match only there. A token without it never takes the last symbol
of a word: it is stepped back to the longest one that leaves something for the end. So every word is
covered whole if all single symbols are tokens, with and without the suffix, as in byte-level vocabularies.

Cases: null and empty texts have 0 words and 0 tokens. Only a word that the vocabulary cannot cover counts
as one token whatever its length; byte-level vocabularies have none. Whole texts are read, words of any length in linear time. Repeated rows are counted each for
itself, ids may be null, empty tables give empty results. Columns that have the name of a column added
here are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallysheet.llm.tables import without, words

END = "</w>"
# Fixed value: how this vocabulary's text is cut into words, after lower-casing.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Distinct words whose counts a worker remembers; the memory is emptied when it is full.
REMEMBERED = 500_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else
    the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Automaton:
    """Trie, failure links, popped-token counts and counts at word ends of a vocabulary. Node 0 is the root."""

    def __init__(self, vocabulary: Iterable[str], end: str = END):
        self.next: list[dict[str, int]] = [{}]
        token = [False]
        for entry in vocabulary:
            symbols = [*entry[: -len(end)], end] if end and entry.endswith(end) and entry != end else list(entry)
            node = 0
            for s in symbols:
                if s not in self.next[node]:
                    self.next[node][s] = len(self.next)
                    self.next.append({})
                    token.append(False)
                node = self.next[node][s]
            token[node] = node != 0
        # -1 as failure link: greedy matching gets stuck.
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        # Tokens of what is left at a node if the word ends there; -1: cannot be covered.
        self.ending = [-1] * len(self.next)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for symbol, node in self.next[parent].items():
                queue.append(node)
                # What the parent would leave, continued by the symbol.
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and symbol not in self.next[at]:
                    at, popped = self.fail[at], popped + self.popped[at]
                left = self.next[at][symbol] if at >= 0 else -1
                if end in self.next[node]:
                    self.ending[node] = 1
                elif left >= 0 and self.ending[left] >= 0:
                    self.ending[node] = popped + self.ending[left]
                if token[node]:
                    self.fail[node], self.popped[node] = 0, 1
                elif left >= 0:
                    self.fail[node], self.popped[node] = left, popped

    def _walk(self, symbols: Iterable[str]) -> tuple[int, int]:
        """(node after the symbols, -1 if stuck; tokens cut off before what is left there)."""
        node, n = 0, 0
        for s in symbols:
            while (follower := self.next[node].get(s)) is None:
                n += self.popped[node]
                node = self.fail[node]
                if node < 0:
                    return node, n
            node = follower
        return node, n

    def count(self, symbols: Iterable[str]) -> int:
        """Tokens of the symbols by plain longest match; 1 if that gets stuck."""
        node, n = self._walk(symbols)
        while node > 0:
            n += self.popped[node]
            node = self.fail[node]
        return n if node == 0 else 1

    def count_word(self, symbols: Iterable[str]) -> int:
        """Tokens of a word, given without the end symbol; 1 if it cannot be covered."""
        node, n = self._walk(symbols)
        return n + self.ending[node] if node > 0 and self.ending[node] >= 0 else 1


class Counter:
    """Counts of whole texts for a byte-level vocabulary with word ends, in a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.automaton = Automaton(json.load(f)["model"]["vocab"])
        self.symbols = byte_symbols()
        self.known: dict[bytes, int] = {}

    def word(self, chunk: bytes) -> int:
        text = unicodedata.normalize("NFC", chunk.decode()).lower()
        symbols = self.symbols
        return sum(self.automaton.count_word([symbols[b] for b in w.encode()]) for w in WORD.findall(text))

    def count(self, text: str | None) -> tuple[int, int]:
        """(words between separators, tokens)."""
        chunks = words(text)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for chunk in set(chunks).difference(known):
            known[chunk] = self.word(chunk)
        return len(chunks), sum([known[c] for c in chunks])


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``. The file must be where every executor finds it."""
    docs = without(docs, ("n_words", "n_tokens"))
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *added])
    at = docs.columns.index(text)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _COUNTERS:
            _COUNTERS[tokenizer_path] = Counter(tokenizer_path)
        counter = _COUNTERS[tokenizer_path]
        for batch in batches:
            found = [counter.count(t) for t in batch.column(at).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.fieldNames())

    return docs.mapInArrow(counted, schema)
