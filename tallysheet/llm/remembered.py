"""Ids of words, encoded once for each distinct word and kept in flat arrays."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np

# Fixed value: the symbol of a space in byte-level vocabularies.
SPACE_SYMBOL = "Ġ"


class Rows:
    """``encode`` gives the rows of new keys, one list of rows for each column. Places of keys go with the
    rows until they are forgotten, which ``learn`` does when more than ``most`` keys, or twenty times as many
    numbers, are held."""

    def __init__(self, encode: Callable[[list], list[list[list[int]]]], most: int, columns: int = 1):
        self.encode = encode
        self.most = most
        self.columns = columns
        self.forget()

    def forget(self) -> None:
        self.place: dict = {}
        self.flat = [np.zeros(1024, np.int32) for _ in range(self.columns)]
        self.start = [np.zeros(1, np.int64) for _ in range(self.columns)]

    def is_full(self) -> bool:
        return len(self.place) > self.most or max(int(s[-1]) for s in self.start) > 20 * self.most

    def learn(self, distinct: Iterable) -> list:
        """Make sure all of ``distinct`` are known; the new ones, in the order of their places. Others may be
        forgotten, so it is called before any place is looked up."""
        if self.is_full():
            self.forget()
        new = list(set(distinct).difference(self.place))
        if new:
            first = len(self.place)
            for c, rows in enumerate(self.encode(new)):
                start = self.start[c][-1] + np.cumsum([len(r) for r in rows])
                if start[-1] > len(self.flat[c]):
                    self.flat[c] = np.append(self.flat[c][: self.start[c][-1]], np.zeros(int(start[-1]) * 2, np.int32))
                self.flat[c][self.start[c][-1] : start[-1]] = np.fromiter(chain.from_iterable(rows), np.int32)
                self.start[c] = np.append(self.start[c], start)
            self.place.update(zip(new, range(first, first + len(new)), strict=True))
        return new

    def lengths(self, places: np.ndarray, column: int = 0) -> np.ndarray:
        return self.start[column][places + 1] - self.start[column][places]

    def of(self, places: np.ndarray, column: int = 0) -> np.ndarray:
        """The rows at the places, one after the other."""
        n = self.lengths(places, column)
        ends = np.cumsum(n)
        if not len(ends) or not ends[-1]:
            return np.zeros(0, np.int32)
        return self.flat[column][np.arange(ends[-1]) + np.repeat(self.start[column][places] - ends + n, n)]


class ByteLevel:
    """A byte-level tokenizer in a file. Its texts are cut before a space that stands between two other
    characters, so words without spaces are encoded many at a time, each with a space before it: a word
    starts at each token that starts with a space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.starts = np.zeros(self.size, bool)
        self.starts[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.startswith(SPACE_SYMBOL)]] = True

    def each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def words(self, words: list[str], at_once: int = 10_000) -> list[list[int]]:
        return _joined(self, words, at_once)


class ByteRanks:
    """The same for a vocabulary of byte strings with ranks, in a file of lines with the base64 text of a
    string and its rank."""

    # Fixed value: how texts are cut before merging; the vocabulary was made with it.
    CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(text): int(rank) for text, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=self.CUT, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.starts = np.zeros(self.size, bool)
        self.starts[[rank for text, rank in ranks.items() if text.startswith(b" ")]] = True

    def each(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]

    def words(self, words: list[str], at_once: int = 10_000) -> list[list[int]]:
        return _joined(self, words, at_once)


def _joined(tokenizer, words: list[str], at_once: int) -> list[list[int]]:
    """Ids of words that have no space, and no other white space at an end."""
    out = []
    for at in range(0, len(words), at_once):
        part = words[at : at + at_once]
        ids = tokenizer.each([" ".join(part)])[0]
        first = np.flatnonzero(tokenizer.starts[ids]).tolist()
        if len(first) == len(part) and first[0] == 0:
            out += [ids[a:b] for a, b in zip(first, [*first[1:], len(ids)], strict=True)]
        else:
            out += tokenizer.each(part)
    return out
