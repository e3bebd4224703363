"""Best-fit packing of token sequences, after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens. Packing only depends on how many pieces
of each length there are, so it is planned on that histogram (at most ``capacity`` numbers,
whatever the corpus size): dominance reduction fixes sets that are part of some optimal packing, and
best-fit decreasing places the rest. The plan says, for ranges of ranks within a length, which
sequence and place a piece gets; ranks are given to the pieces by Spark without gathering a length.

Cases: null and empty texts are one piece of the end token alone. Texts of any length are read whole and cut into
pieces. Repeated rows are packed each for itself; ids may be null or repeated. Pieces of one length are
interchangeable, so ties among them are broken by hash and place. An empty table gives no pieces. Other columns of
the documents are ignored; columns of pieces that have the name of a column added here are replaced.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import free_name, stored, without

CAPACITY = 2048
END_ID = 0
# Distinct words whose ids a worker remembers; beyond that, the older half stays.
REMEMBERED = 400_000
# Characters encoded at a time in a worker.
BLOCK_CHARS = 4_000_000
# Pieces in a bucket within which ranks are counted, and the least number of buckets.
BUCKET_PIECES = 100_000
LEAST_BUCKETS = 1024


@dataclass(frozen=True)
class Run:
    """Ranks ``first_rank`` .. + ``count`` of ``length`` fill sequences from ``first_sequence`` on,
    ``per_sequence`` in each, one after the other from place ``base``."""

    length: int
    first_rank: int
    count: int
    first_sequence: int
    per_sequence: int
    base: int


class _Plan:
    """Runs, and the counts of pieces not yet placed."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] += n
        self.rank = np.zeros(capacity + 1, np.int64)
        self.sequences = 0
        self.runs: list[Run] = []

    def place(self, length: int, n: int, first: int, per: int, base: int) -> None:
        """Put ``per`` pieces of ``length`` into each of ``n`` sequences from ``first`` on."""
        self.runs.append(Run(length, int(self.rank[length]), n * per, first, per, base))
        self.rank[length] += n * per
        self.left[length] -= n * per

    def fix(self, lengths: Sequence[int], n: int) -> None:
        """Fill ``n`` new sequences with the set ``lengths`` each."""
        base = 0
        for length in sorted(set(lengths), reverse=True):
            per = list(lengths).count(length)
            self.place(length, n, self.sequences, per, base)
            base += per * length
        self.sequences += n


def _dominating(left: np.ndarray, item: int, capacity: int) -> tuple[int, ...] | None:
    """Companions of ``item`` that dominate every other set with it, or None if none is known.

    A set dominates another if the other's members can be packed into its members. One of ``item``
    is taken out of ``left`` beforehand.
    """
    room = capacity - item
    fitting = np.flatnonzero(left[: room + 1])
    if not len(fitting):
        return ()
    largest = int(fitting[-1])
    # Filling the room exactly, or no two fitting together: the largest one dominates.
    two_least = int(fitting[0]) * 2 if left[fitting[0]] > 1 else int(fitting[:2].sum()) if len(fitting) > 1 else room + 1
    if largest == room or two_least > room:
        return (largest,)
    least = np.repeat(fitting[:3], np.minimum(left[fitting[:3]], 3))[:3]
    if len(least) == 3 and least.sum() <= room:
        return None
    # Two at most: the best pair sum decides between a single one and a pair.
    best = 0
    bound = 0  # the largest smaller member of any fitting pair
    for b in fitting[::-1].tolist():
        others = fitting[fitting <= min(b, room - b)]
        if len(others) and others[-1] == b and left[b] < 2:
            others = others[:-1]
        if len(others):
            best = max(best, b + int(others[-1]))
            bound = max(bound, int(others[-1]))
    if largest >= best:
        return (largest,)
    small = fitting[fitting <= room - largest]
    if len(small) and small[-1] == largest and left[largest] < 2:
        small = small[:-1]
    if len(small) and int(small[-1]) >= bound:
        return (largest, int(small[-1]))
    return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """The whole plan for a histogram of lengths (1 to ``capacity``)."""
    plan = _Plan(counts, capacity)
    left = plan.left
    for item in range(capacity, 0, -1):
        while left[item]:
            left[item] -= 1
            companions = _dominating(left, item, capacity)
            left[item] += 1
            if companions is None:
                break
            members = (item, *companions)
            # As often as all members last. While they do, the same reasoning holds.
            plan.fix(members, min(int(left[m]) // members.count(m) for m in set(members)))
    _best_fit(plan, capacity)
    return plan.runs


def _best_fit(plan: _Plan, capacity: int) -> None:
    """Best-fit decreasing in bulk: a sequence just used is again the fullest that fits, so each takes
    as many equal pieces as it can; groups of equally full sequences stay contiguous."""
    open_groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        room = length
        while plan.left[length]:
            while room <= capacity and not open_groups[room]:
                room += 1
            if room > capacity:
                n = -(-int(plan.left[length]) // (capacity // length))
                open_groups[capacity].append((plan.sequences, n))
                plan.sequences += n
                room = capacity
            first, n = open_groups[room].pop()
            per = room // length
            full = min(n, int(plan.left[length]) // per)
            if full:
                plan.place(length, full, first, per, capacity - room)
                open_groups[room - per * length].append((first, full))
            rest = int(plan.left[length]) if full < n else 0
            if rest:
                plan.place(length, 1, first + full, rest, capacity - room)
                open_groups[room - rest * length].append((first + full, 1))
            used = full + (rest > 0)
            if used < n:
                open_groups[room].append((first + used, n - used))


_TOKENIZERS: dict = {}


class _Encoder:
    """Ids of whole texts as bytes, by a tokenizer whose words never span white space: the ids of a
    text are those of its words, and each distinct word is encoded once.

    Words are taken in lower case, and stops behind letters apart from them, as the tokenizer does, so
    that fewer are distinct. Words of letters are encoded many at a time in one text; each is one word
    there, so its ids end with the first that closes a word.
    """

    # Characters that Python and the tokenizer do not lower or split alike; such texts are only split.
    ODD = re.compile("[\x1c-\x1fΣİ]")
    STOPS = re.compile(r"(?<=[^\W\d_])[.,;:!?]+(?=\s|\Z)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence as Normalizers
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit
        from tokenizers.pre_tokenizers import Sequence as PreTokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same for words of lower-case letters in composed form: nothing is left to normalise or cut.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = Normalizers([])
        self.plain.pre_tokenizer = PreTokenizers([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        cut = [self._words(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            # Frequent words are met early: the older half stays.
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
            new = set().union(*cut).difference(self.known)
        self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in cut]

    def _words(self, text: str) -> list[str]:
        if self.ODD.search(text):
            return [w.decode() for w in text.encode().split()]
        return self.STOPS.sub(r" \g<0>", text).lower().split()

    def _learn(self, words: set[str]) -> None:
        letters, other = [], []
        for w in words:
            plain = w.isalpha() and w.islower() and (w.isascii() or is_normalized("NFC", w))
            (letters if plain else other).append(w)
        for at in range(0, len(letters), 10_000):
            part = letters[at : at + 10_000]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            if len(ends) == len(part):
                data = ids.tobytes()
                self.known.update(zip(part, [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
            else:
                self._each(part)
        self._each(other)

    def _each(self, words: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self.known.update(zip(words, [np.array(e.ids, "<u4").tobytes() for e in found], strict=True))


def _encoder(path: str) -> _Encoder:
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[path] = _Encoder(path)
    return _TOKENIZERS[path]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars > BLOCK_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and ``ids`` (little-endian
    unsigned 32 bit) if wanted. The tokenizer file must be where every executor finds it."""
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.BinaryType())] if with_ids else []),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, stop in _blocks(texts):
                row, piece, ids = [], [], []
                for i, data in enumerate(encoder.encode(texts[first:stop]), first):
                    data += end
                    for k, at in enumerate(range(0, len(data), step)):
                        row.append(i)
                        piece.append(k)
                        ids.append(data[at : at + step])
                columns = [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array([k * capacity for k in piece], pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    *([pa.array(ids, pa.binary())] if with_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def ranked_by_length(pieces: DataFrame, length: str, order: Sequence[str], n: int, rank: str) -> DataFrame:
    """``pieces`` with ``rank`` from 0 among those of the same length.

    No length is gathered: rows are dealt over buckets by hash, numbered within (bucket, length), and
    moved up by the number of such rows in earlier buckets. The place a row is read from is part of the hash,
    so that equal rows, however many, are dealt as well; they are interchangeable.
    """
    buckets = max(LEAST_BUCKETS, n // BUCKET_PIECES)
    bucket = free_name(pieces.columns, "bucket")
    place = F.monotonically_increasing_id()
    dealt = pieces.withColumn(bucket, F.pmod(F.xxhash64(*order, place), F.lit(buckets)))
    counts = dealt.groupBy(length, bucket).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(length).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select(length, bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_moved"))
    within = F.row_number().over(Window.partitionBy(length, bucket).orderBy(*order)) - 1
    numbered = dealt.withColumn(rank, within.cast("long"))
    joined = numbered.join(moved, [length, bucket])
    return joined.withColumn(rank, F.col(rank) + F.col("_moved")).drop("_moved", bucket)


def pack(
    pieces: DataFrame,
    length: str = "length",
    order: Sequence[str] = ("doc_id", "piece", "start", "ids_crc32"),
    capacity: int = CAPACITY,
) -> DataFrame:
    """``pieces`` (stored, as they are read twice) with ``sequence_id`` and ``offset``.

    ``order`` must tell different pieces apart. Lengths are 1 to ``capacity``.
    """
    pieces = without(pieces, ("sequence_id", "offset"))
    counts = {int(r[length]): int(r["count"]) for r in pieces.groupBy(length).count().collect()}
    runs = sorted(plan_packing(counts, capacity), key=lambda r: (r.length, r.first_rank))
    rank = free_name(pieces.columns, "rank")
    ranked = ranked_by_length(pieces, length, order, sum(counts.values()), rank)
    # Runs as arrays in the order of (length, rank): the last that starts at or before a piece holds it.
    wide = np.int64(1) << np.int64(48)
    key = np.array([r.length * int(wide) + r.first_rank for r in runs], np.int64)
    table = np.array([(r.first_rank, r.first_sequence, r.per_sequence, r.base) for r in runs], np.int64).reshape(-1, 4)
    shared = pieces.sparkSession.sparkContext.broadcast((key, table))
    kept = [f for f in ranked.schema.fields if f.name != rank]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    ranked = ranked.select(*[f"`{f.name}`" for f in kept], rank)
    at = [f.name for f in kept].index(length)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, table = shared.value
        for batch in batches:
            long = batch.column(at).to_numpy().astype(np.int64)
            own = batch.column(len(kept)).to_numpy()
            run = table[np.searchsorted(key, long * wide + own, "right") - 1]
            turn, slot = np.divmod(own - run[:, 0], run[:, 2])
            added = [pa.array(run[:, 1] + turn), pa.array(run[:, 3] + slot * long)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *added], schema.fieldNames())

    return ranked.mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Cut and pack ``docs``: a row for each piece, with its sequence and its place there."""
    pieces = stored(cut_documents(docs, tokenizer_path, capacity=capacity, **options), "pieces")
    return pack(pieces, capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length and ``ids`` joined in order (needs ``with_ids``)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return joined.select("sequence_id", "length", ids.alias("ids"))
