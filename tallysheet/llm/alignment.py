"""Alignment of two tokenizers by merge-path partitioning.

The tokens of a text have byte ends under tokenizer A and under tokenizer B: two ascending lists over the
same bytes. Merging them gives everything: an end of either list closes the overlap of the one A token
and the one B token that hold the byte before it (a link), an end of both closes a group.

The merge is cut into pieces of equal work. A point of the merge path is (ends of A, ends of B) taken so
far, its diagonal the sum of both; where the path meets a diagonal is found by binary search, without
merging what lies before. A piece holds its tokens and the one of each side that is open at its end, so it
emits its links alone. Its first and last groups may go on in other pieces; they are stitched in order
afterwards. Texts of one piece are stitched where they are.

How often an id pair is linked in the whole corpus is summed per task, then by a shuffle. Frequent pairs
are looked up in memory, the others by a join (see ``counts``).

Cases: null and empty texts have no tokens and zeros, as do texts whose joined token bytes of either side
differ from space and text. Texts of any length are read whole: long ones are encoded in parts, cut where
neither tokenizer joins across, and merged in pieces. Repeated rows count each for itself, ids may be null or
repeated. Ties (equal counts of the best pair of a B id) all count as best. An empty table gives an empty
result. Of the input's columns those in ``keep`` are returned; a name in it that is added here is refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.counts import frequent_from
from tallysheet.llm.remembered import ByteLevel, ByteRanks, Rows
from tallysheet.llm.tables import stored
from tallysheet.llm.wordpiece import byte_symbols

# Fixed values of the piece format: the mark of a space, and pieces that stand for one byte.
SPACE = "▁"
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
# A single space between characters that are surely no white space: no token of either side goes across.
CUT = re.compile(r"(?<=[!-~¡-ᙿ]) (?=[!-~¡-ᙿ])")
# A chunk without spaces, cut at both ends; and one of characters that every Unicode table has alike.
PLAIN = re.compile(r"[!-~¡-ᙿ](?:[^ ]*[!-~¡-ᙿ])?")
LATIN = re.compile(r"[!-~¡-ȳ]+")
# Distinct chunks whose ids a worker remembers, and characters that are encoded between two looks at it.
REMEMBERED = 300_000
CHARS = 1_000_000


@dataclass(frozen=True)
class Alignment:
    # Steps (ends of either side) in a piece of the merge.
    piece: int = 65_536
    # Pairs that are looked up in memory (24 bytes each); the others are joined.
    frequent_pairs: int = 500_000
    # Distinct pairs that a task sums before it hands them on.
    summed_pairs: int = 1_000_000


DEFAULT = Alignment()
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the ids of chunks of text met so far."""

    def __init__(self, a_path: str, b_path: str, a_ranks: str | None):
        self.a = ByteLevel(a_path)
        self.latin = ByteRanks(a_ranks) if a_ranks else self.a
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            read = json.load(f)
        by_symbol = {s: bytes([i]) for i, s in enumerate(byte_symbols())}
        # Special tokens need not be in the vocabulary; they never come from a text.
        names = {i: t for t, i in read["model"]["vocab"].items()}
        self.a_bytes = [b"".join(by_symbol.get(c, c.encode()) for c in names.get(i, "")) for i in range(max(names, default=0) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE.fullmatch(p)) else p.replace(SPACE, " ").encode() for p in pieces]
        self.lengths = tuple(np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # A piece with a space mark behind something else could go across a cut.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        # Ids are stored in as few bytes as they need.
        self.dtype = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")
        self.chunks = Rows(self._encode, REMEMBERED, columns=2)

    def _encode(self, chunks: list[str]) -> list[list[list[int]]]:
        a: list[list[int]] = [[]] * len(chunks)
        rest = range(len(chunks))
        for pattern, encode in ((LATIN, self.latin.words), (PLAIN, self.a.words), (None, self.a.each)):
            own = [k for k in rest if pattern is None or pattern.fullmatch(chunks[k])]
            rest = sorted(set(rest).difference(own))
            for k, ids in zip(own, encode([chunks[k] for k in own]), strict=True):
                a[k] = ids
        b = self.b.encode(chunks, num_threads=1)
        raw = [b" " + c.encode() for c in chunks]
        for ids, token, length in ((a, self.a_bytes, self.lengths[0]), (b, self.b_bytes, self.lengths[1])):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            ends = np.append(0, length[flat].cumsum())[np.cumsum([len(i) for i in ids])]
            # Joined at once: equal bytes and equal ends mean that every chunk is equal.
            if not (ends == np.cumsum([len(r) for r in raw])).all() or b"".join(map(token.__getitem__, flat.tolist())) != b"".join(raw):
                for k, r in enumerate(raw):
                    if b"".join(map(token.__getitem__, ids[k])) != r:
                        # No ids: the texts that have it get none.
                        a[k], b[k] = [], []
        return [a, b]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B for each text; none if either's bytes are not those of space and text."""
        cut = [(CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        chunks = self.chunks
        chunks.learn(set().union(*cut))
        out = []
        for own in cut:
            places = np.fromiter(map(chunks.place.__getitem__, own), np.int64, len(own))
            if not chunks.lengths(places).all():
                places = places[:0]
            out.append((chunks.of(places), chunks.of(places, 1)))
        return out


Paths = tuple[str, str, str | None]
_ENCODERS: dict[Paths, Encoders] = {}


def encoders(paths: Paths) -> Encoders:
    """The tokenizers of this worker, loaded once."""
    if paths not in _ENCODERS:
        _ENCODERS[paths] = Encoders(*paths)
    return _ENCODERS[paths]


def path_points(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of A, ends of B) that a merge has taken at each diagonal, by binary search. At equal ends A is
    taken first; a diagonal between two equal ends is moved behind both."""
    low = np.maximum(diagonals - len(b_ends), 0)
    high = np.minimum(diagonals, len(a_ends))
    while (low < high).any():
        open_ = low < high
        i = (low + high) // 2
        # A's end i is taken before B's end (diagonal - i - 1), so more of A belongs to the path.
        j = np.where(open_, diagonals - i - 1, 0)
        more = open_ & (a_ends[np.where(open_, i, 0)] <= b_ends[j])
        low = np.where(more, i + 1, low)
        high = np.where(open_ & ~more, i, high)
    i, j = low, diagonals - low
    between = (i > 0) & (j < len(b_ends))
    split = between & (a_ends[np.where(between, i - 1, 0)] == b_ends[np.where(between, j, 0)])
    return i, j + split


def pieces_of(a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """The merge cut into pieces of ``size`` steps: (first and end of A, first and end of B) of each."""
    steps = len(a_ends) + len(b_ends)
    if steps <= size:
        return [(0, len(a_ends), 0, len(b_ends))]
    i, j = path_points(a_ends, b_ends, np.arange(size, steps, size))
    i, j = [0, *i.tolist(), len(a_ends)], [0, *j.tolist(), len(b_ends)]
    return [(i[k], i[k + 1], j[k], j[k + 1]) for k in range(len(i) - 1) if i[k] < i[k + 1] or j[k] < j[k + 1]]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, own_a: int, own_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of a piece: places of the A and of the B tokens, the byte where each ends, and the ends that both
    sides have. The first ``own_a`` and ``own_b`` ends are the piece's, a further one is the token open at
    its end."""
    ends = np.concatenate([a_ends[:own_a], b_ends[:own_b]])
    ends.sort(kind="stable")
    if len(ends):
        ends = ends[np.append(ends[1:] != ends[:-1], True)]
    a, b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    return a, b, ends, ends[(a_ends[a] == ends) & (b_ends[b] == ends)]


class GroupText:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``, ids in order."""

    def __init__(self, ids: int):
        self.ids = ids
        self.names = np.array([f"{i}{mark}" for mark in ",|;" for i in range(ids)], object)

    def pieces(self, a: np.ndarray, b: np.ndarray, a_ends, b_ends, common: np.ndarray) -> tuple[list[int], list[int], str, list[int], list[int]]:
        """A piece's groups: ids up to the first common end, the text of groups between common ends (with a
        semicolon behind each), ids after the last. Without a common end all ids are among the last."""
        group_a, group_b = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        n = len(common)
        head = (a[group_a == 0].tolist(), b[group_b == 0].tolist()) if n else ([], [])
        tail = (a[group_a == n].tolist(), b[group_b == n].tolist())
        in_a, in_b = (group_a > 0) & (group_a < n), (group_b > 0) & (group_b < n)
        return *head, self.text(a[in_a], b[in_b], group_a[in_a], group_b[in_b]), *tail

    def text(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        """Whole groups, a semicolon behind each."""
        return "".join(self.words(a, b, group_a, group_b))

    def words(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        """The ids of whole groups in order, each with the mark behind it."""
        if not len(a):
            return []
        key = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(key, kind="stable")
        key = key[order]
        last = np.append(key[1:] != key[:-1], True)
        code = np.concatenate([a, b]).astype(np.int64)[order] + self.ids * np.where(last, 1 + (key & 1), 0)
        return self.names[code].tolist()


def group_text(a: Sequence[int], b: Sequence[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))};"


class Stitcher:
    """Joins the groups of a text's pieces, given in order."""

    def __init__(self):
        self.a: list[int] = []
        self.b: list[int] = []
        self.out: list[str] = []

    def add(self, closed: bool, head_a, head_b, body: str, tail_a, tail_b) -> None:
        if closed:
            self.out += [group_text([*self.a, *head_a], [*self.b, *head_b]), body]
            self.a, self.b = [], []
        self.a += tail_a
        self.b += tail_b

    def text(self) -> str:
        return "".join(self.out)[:-1]


PIECE = T.StructType(
    [
        T.StructField("_row", T.LongType()),
        T.StructField("_piece", T.IntegerType()),
        T.StructField("_pieces", T.IntegerType()),
        # Bytes before the first token of each side, tokens whose ends are the piece's, and all tokens.
        T.StructField("_a_base", T.LongType()),
        T.StructField("_b_base", T.LongType()),
        T.StructField("_own_a", T.IntegerType()),
        T.StructField("_own_b", T.IntegerType()),
        # Ids, little-endian.
        T.StructField("_a", T.BinaryType()),
        T.StructField("_b", T.BinaryType()),
    ]
)
ARROW_PIECE = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())


def _by_size(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``CHARS`` bytes of text."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // CHARS)) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
        if first < end:
            yield batch.slice(first, end - first)


def cut_pieces(docs: DataFrame, paths: Paths, text: str, keep: Sequence[str], spec: Alignment) -> DataFrame:
    """Every text encoded and cut into pieces; the columns ``keep`` are repeated on each."""
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    kept = docs.schema.fields[: len(keep)]
    schema = T.StructType([*kept, *PIECE.fields])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(paths)
        for whole in batches:
            for batch in _by_size(whole, len(keep)):
                rows, tokens, origin = [], ([], []), []
                ids = both.encode(batch.column(len(keep)).to_pylist())
                for k, (row, (a, b)) in enumerate(zip(batch.column(len(keep) + 1).to_pylist(), ids, strict=True)):
                    cut, ends = [(0, len(a), 0, len(b))], None
                    if len(a) + len(b) > spec.piece:
                        ends = [n[i].cumsum() for n, i in zip(both.lengths, (a, b), strict=True)]
                        cut = pieces_of(*ends, spec.piece)
                    for p, (i, i_end, j, j_end) in enumerate(cut):
                        bases = (int(ends[0][i - 1]) if i else 0, int(ends[1][j - 1]) if j else 0)
                        rows.append((row, p, len(cut), *bases, i_end - i, j_end - j))
                        tokens[0].append(a[i : i_end + 1].astype(both.dtype).tobytes())
                        tokens[1].append(b[j : j_end + 1].astype(both.dtype).tobytes())
                        origin.append(k)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW_PIECE, strict=True)]
                columns += [pa.array(t, pa.binary()) for t in tokens]
                own = batch.take(pa.array(origin, pa.int64())).columns[: len(keep)]
                yield pa.RecordBatch.from_arrays([*own, *columns], schema.fieldNames())
        both.chunks.forget()

    return docs.mapInArrow(encoded, schema)


def dealt(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces of texts of one piece, where they are; pieces of longer texts, dealt over all tasks)."""
    return pieces.where("_pieces = 1"), pieces.where("_pieces > 1").repartition("_row", "_piece")


@dataclass
class Merged:
    """A run of pieces merged at once: whole texts one behind the other, or a piece of a long text."""

    first: int
    end: int
    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    own_a: np.ndarray
    own_b: np.ndarray
    links: tuple[np.ndarray, np.ndarray]
    link_ends: np.ndarray
    common: np.ndarray

    def keys(self) -> np.ndarray:
        return (self.a[self.links[0]].astype(np.int64) << 32) | self.b[self.links[1]]


def _merged(batch: pa.RecordBatch, both: Encoders, size: int) -> Iterator[Merged]:
    """The pieces of a batch, in runs. Whole texts are merged together until they make a piece's work: both
    sides have the same bytes, so their ends can go on counting from text to text."""
    numbers = {n: batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("_pieces", "_a_base", "_b_base", "_own_a", "_own_b")}
    flat, offsets = [], []
    for n in ("_a", "_b"):
        column = batch.column(batch.schema.get_field_index(n))
        offsets.append(np.append(0, np.cumsum(pc.binary_length(column).to_numpy())) // both.dtype.itemsize)
        flat.append(np.frombuffer(b"".join(column.to_pylist()), both.dtype))
    run = np.cumsum(numbers["_own_a"] + numbers["_own_b"]) // size
    alone = numbers["_pieces"] > 1
    cuts = np.flatnonzero((np.diff(run) > 0) | alone[1:] | alone[:-1]) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
        if first == end:
            continue
        a, b = (f[o[first] : o[end]] for f, o in zip(flat, offsets, strict=True))
        own = [numbers[n][first:end] for n in ("_own_a", "_own_b")]
        a_ends, b_ends = (n[x].cumsum() + numbers[base][first] for n, x, base in zip(both.lengths, (a, b), ("_a_base", "_b_base"), strict=True))
        i, j, ends, common = overlaps(a_ends, b_ends, int(own[0].sum()), int(own[1].sum()))
        yield Merged(first, end, a, b, a_ends, b_ends, *own, (i, j), ends, common)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each is there; sorts ``keys``."""
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def pair_counts(pieces: DataFrame, paths: Paths, spec: Alignment = DEFAULT) -> DataFrame:
    """``pair`` (A's id times 2^32 plus B's) and ``n``, its links in the whole corpus."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoders(paths)
        none = np.zeros(0, np.int64)
        held, waiting, n = (none, none), [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in held], ["pair", "n"])

        def taken() -> tuple[np.ndarray, np.ndarray]:
            new = _counted(np.concatenate([none, *waiting]))
            return _summed(*(np.concatenate(parts) for parts in zip(held, new, strict=True)))

        for batch in batches:
            for m in _merged(batch, both, spec.piece):
                waiting.append(m.keys())
                n += len(waiting[-1])
                if n > 2_000_000:
                    held, waiting, n = taken(), [], 0
                    if len(held[0]) > spec.summed_pairs:
                        yield out()
                        held = (none, none)
        held = taken()
        yield out()

    columns = pieces.select("_pieces", "_a_base", "_b_base", "_own_a", "_own_b", "_a", "_b")
    return columns.mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _found(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each key in the sorted ones, whether it is there)."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


PART = "_closed boolean, _head_a array<int>, _head_b array<int>, _body string, _tail_a array<int>, _tail_b array<int>"
RARE = "_rare array<bigint>, _times array<bigint>"


def _stitched(parts: DataFrame, names: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row for each text of several pieces: measures summed, groups joined. A text's pieces follow
    each other after a sort; only the groups of one text are held, as its text was."""
    fields = {f.name: f for f in parts.schema.fields}
    schema = T.StructType([fields[n] for n in (*names, "_row", *measures, "_rare", "_times", "groups")])
    columns = ["_row", *measures, "_rare", "_times", "_closed", "_head_a", "_head_b", "_body", "_tail_a", "_tail_b"]
    end = 1 + len(measures)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, kept, sums, rare, stitch = None, None, [], ([], []), Stitcher()

        def out() -> pa.RecordBatch:
            values = [*kept.columns, pa.array([row]), *(pa.array([s], pa.int64()) for s in sums)]
            values += [*(pa.array([r], pa.list_(pa.int64())) for r in rare), pa.array([stitch.text()])]
            return pa.RecordBatch.from_arrays(values, schema.names)

        for batch in batches:
            for k, values in enumerate(zip(*(batch.column(c).to_pylist() for c in columns), strict=True)):
                if values[0] != row:
                    if row is not None:
                        yield out()
                    row, kept, sums = values[0], batch.slice(k, 1).select(list(names)), [0] * len(measures)
                    rare, stitch = ([], []), Stitcher()
                sums = [s + v for s, v in zip(sums, values[1:end], strict=True)]
                rare[0].extend(values[end])
                rare[1].extend(values[end + 1])
                stitch.add(*values[end + 2 :])
        if row is not None:
            yield out()

    return parts.repartition("_row").sortWithinPartitions("_row", "_piece").mapInArrow(joined, schema)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    a_ranks: str | None = None,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    groups: Callable[[Column], Column] = lambda text: text,
    spec: Alignment = DEFAULT,
) -> DataFrame:
    """The columns ``keep`` and, for each text, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``
    (links whose pair is the most frequent of its B id), ``count_sum`` (corpus counts summed over links)
    and ``groups``: an expression of the groups' text, applied before it is shuffled.

    A is a byte-level tokenizer file, B a piece model. ``a_ranks`` may name a file of A's vocabulary as ranks, which
    is faster to encode with. The files must be where every executor finds them.
    """
    paths = (a_path, b_path, a_ranks)
    if clash := {c.lower() for c in keep} & set(MEASURES):
        raise ValueError(f"columns of the result: {sorted(clash)}")
    spark = docs.sparkSession
    names = [f"_k{i}" for i in range(len(keep))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("_text"))
    whole, several = dealt(stored(cut_pieces(renamed, paths, "_text", names, spec), "pieces", compression="zstd"))
    pieces = whole.unionByName(several)
    pairs = stored(pair_counts(pieces, paths, spec), "pairs")
    # One row for each B id: no more than B has pieces.
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    judged = pairs.withColumn("b", b_id).join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))
    least = frequent_from(pairs, "n", spec.frequent_pairs)
    frequent = judged.where(F.col("n") >= least).toArrow()
    table = [frequent[c].to_numpy() for c in ("pair", "n", "is_best")]
    order = np.argsort(table[0])
    known = spark.sparkContext.broadcast(tuple(t[order] for t in table))
    measures = list(MEASURES[:-1])
    schema = T.StructType(
        [
            *(pieces.schema[n] for n in names), *PIECE.fields[:3], *(T.StructField(m, T.LongType()) for m in measures),
            *T._parse_datatype_string(f"{PART}, {RARE}").fields, T.StructField("groups", T.StringType()),
        ]
    )

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, (pair, count, is_best) = encoders(paths), known.value
        writer = GroupText(max(map(len, both.lengths)))
        ids, numbers = pa.list_(pa.int32()), pa.list_(pa.int64())
        kinds = [*[pa.int64()] * 6, pa.bool_(), ids, ids, pa.string(), ids, ids, numbers, numbers, pa.string()]
        for batch in batches:
            several = batch.column(batch.schema.get_field_index("_pieces")).to_numpy() > 1
            for m in _merged(batch, both, spec.piece):
                n = m.end - m.first
                # Where each text ends, in bytes: its last end is one of both sides.
                last = m.a_ends[np.cumsum(m.own_a)[m.own_a > 0] - 1] if n > 1 else m.link_ends[-1:]
                filled = np.flatnonzero(m.own_a) if n > 1 else np.zeros(min(1, len(last)), np.int64)
                text_of = lambda ends: filled[np.searchsorted(last, ends)]  # noqa: B023, E731
                keys, link_text = m.keys(), text_of(m.link_ends)
                at, there = _found(keys, pair)
                sums = [
                    m.own_a, m.own_b, np.bincount(text_of(m.common), minlength=n), np.bincount(link_text, minlength=n),
                    *(np.bincount(link_text[there], v[at[there]], n).astype(np.int64) for v in (is_best, count)),
                ]
                if several[m.first]:
                    parts = [(len(m.common) > 0, *writer.pieces(m.a[: m.own_a[0]], m.b[: m.own_b[0]], m.a_ends[: m.own_a[0]], m.b_ends[: m.own_b[0]], m.common))]
                    texts = [None]
                else:
                    parts = [(None,) * 6] * n
                    written = writer.words(m.a, m.b, np.searchsorted(m.common, m.a_ends), np.searchsorted(m.common, m.b_ends))
                    ends = np.cumsum(m.own_a + m.own_b).tolist()
                    texts = ["".join(written[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]
                # Pairs that are not in memory: for each text, which and how often.
                rare, rare_text = keys[~there], link_text[~there]
                order = np.lexsort((rare, rare_text))
                rare, rare_text = rare[order], rare_text[order]
                first = np.flatnonzero(np.append(True, (rare[1:] != rare[:-1]) | (rare_text[1:] != rare_text[:-1]))) if len(rare) else np.zeros(0, np.int64)
                offsets = np.append(0, np.cumsum(np.bincount(rare_text[first], minlength=n))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in (rare[first], np.diff(np.append(first, len(rare))))]
                columns = [pa.array(c, t) for c, t in zip([*sums, *zip(*parts, strict=True)], kinds, strict=False)]
                own = batch.slice(m.first, n).columns[: len(names) + 3]
                yield pa.RecordBatch.from_arrays([*own, *columns, *lists, pa.array(texts, pa.string())], schema.fieldNames())

    written = groups(F.col("groups")).alias("groups")
    of_text = [*names, "_row", *measures]
    long_texts = several.mapInArrow(aligned, schema)
    rare = [F.col("_rare"), F.col("_times")]
    found = stored(
        whole.mapInArrow(aligned, schema)
        .select(*of_text, *rare, written)
        .unionByName(_stitched(long_texts, names, measures).select(*of_text, *rare, written)),
        "aligned",
    )
    # Pairs that are not frequent: a shuffle join with all of their counts.
    zipped = F.explode(F.arrays_zip("_rare", "_times")).alias("r")
    looked_up = (
        found.select("_row", zipped)
        .select("_row", F.col("r._rare").alias("pair"), F.col("r._times").alias("times"))
        .join(judged.where(F.col("n") < least), "pair")
        .groupBy("_row")
        .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("_more_best"), F.sum(F.col("times") * F.col("n")).alias("_more_sum"))
    )
    return found.join(looked_up, "_row", "left").select(
        *[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)],
        "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
        "groups",
    )
