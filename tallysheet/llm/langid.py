"""Language identification with bit-sliced Bloom filters of character n-grams.

One table of masks is a Bloom filter for every language at once: bit b of each mask belongs to language
b, and an n-gram's masks at its hash positions, and-ed, are all languages that contain it. A language
contains the n-grams that are about as frequent there as in the language where they are most frequent.
For a text, the languages of all its n-grams are counted; each count is corrected for the false
positives that the filter's fill lets expect, and the largest decides.

Cases: null texts and texts without a letter are ``und`` with score 0. Ties go to the first language in
code point order. Without any learned language everything is ``und``. Texts of any length are read whole, in
blocks. Repeated rows count and are predicted each for itself; ids may be null (such rows are not
learned from). Columns that have the name of a column added here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import stored, without

UNKNOWN = "und"
WORD = np.uint64(64)


@dataclass(frozen=True)
class LanguageModel:
    # The sample learned from: about so many documents of each language, by hash.
    docs_per_language: int = 2_000
    grams: tuple[int, ...] = (2, 3, 4)
    # N-grams that fewer documents of the sample have are left out (for a language that has fewer, its number).
    least_docs: int = 3
    # A language contains an n-gram if its share of documents there is at least this part of the largest share.
    part_of_largest: float = 0.2
    bits: int = 21
    hashes: int = 3
    # Characters handled at a time in a worker.
    block: int = 500_000


DEFAULT = LanguageModel()


@dataclass
class Filters:
    """``table`` has 2**bits rows of as many 64 bit words as the languages need."""

    languages: list[str] = field(default_factory=list)
    table: np.ndarray | None = None
    # For each language, the chance that an n-gram it does not contain is reported for it.
    false_rate: np.ndarray | None = None


@cache
def _letters() -> np.ndarray:
    """For each code point, its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(text: str) -> np.ndarray:
    """Lower-case letters of the text, with one 0 between words and around them."""
    low = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    low = np.concatenate([np.zeros(1, np.uint32), low, np.zeros(1, np.uint32)])
    gap = low == 0
    return low[~(gap & np.roll(gap, 1)) | (np.arange(len(low)) == 0)]


def gram_hashes(chars: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """64 bit hashes of the n-grams with at most the first and last character outside a word."""
    out = []
    for n in sizes:
        if len(chars) < n:
            continue
        width = len(chars) - n + 1
        mixed = np.full(width, n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ chars[k : width + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        inner = np.ones(width, bool)
        for k in range(1, n - 1):
            inner &= chars[k : width + k] != 0
        if n == 2:
            inner = (chars[:width] != 0) | (chars[1 : width + 1] != 0)
        out.append(mixed[inner])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _positions(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th position of each hash."""
    shift = np.uint64(64 - bits)
    return ((hashes * np.uint64((0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0xDB4F0B9175AE2165)[k])) >> shift).astype(np.int64)


def sample(docs: DataFrame, lang: Column, doc_id: Column, model: LanguageModel) -> DataFrame:
    """About ``docs_per_language`` rows of each language, by a hash of the id; languages are counted first."""
    rows = docs.where(lang.isNotNull())
    counts = rows.groupBy(lang.alias("l")).count()
    share = F.least(F.lit(1.0), F.lit(float(model.docs_per_language)) / F.col("count"))
    shares = counts.select("l", share.alias("share"))
    chance = F.pmod(F.xxhash64(doc_id, F.lit(3)), F.lit(1_000_003)) / F.lit(1_000_003)
    return rows.join(F.broadcast(shares), lang == F.col("l")).where(chance < F.col("share")).drop("l", "share")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", model: LanguageModel = DEFAULT) -> Filters:
    """Filters from the labelled rows of ``docs``. What reaches the driver is the table, of fixed size."""
    picked = sample(docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")), F.col("lang"), F.col("id"), model)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    found = [gram_hashes(letters(t[a : a + model.block]), model.grams) for a in range(0, len(t), model.block)]
                    by.setdefault(l, []).append(np.unique(np.concatenate(found)))
            for l, found in by.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                # A null n-gram counts the documents that have any.
                any_gram = sum(len(f) > 0 for f in found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l], pa.string()), pa.array([None], pa.int64()), pa.array([any_gram], pa.int64())], ["lang", "gram", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    grams = picked.select("lang", "text").mapInArrow(counted, "lang string, gram long, n long")
    grams = stored(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = {r["lang"]: r["count"] for r in picked.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda s: s.encode("utf-32-be"))
    if not languages:
        return Filters()
    docs_of = F.create_map([F.lit(x) for l in languages for x in (l, float(sizes[l]))])
    bit_of = F.create_map([F.lit(x) for b, l in enumerate(languages) for x in (l, b)])
    # For a language with fewer documents, n-grams that as many documents as it has contain are enough.
    learned = {r["lang"]: r["n"] for r in grams.where("gram is null").collect()}
    least = {l: min(model.least_docs, learned.get(l) or model.least_docs) for l in languages}
    least_of = F.create_map([F.lit(x) for l in languages for x in (l, least[l])])
    grams = grams.where("gram is not null")
    share = F.col("n") / F.element_at(docs_of, F.col("lang"))
    largest = grams.groupBy("gram").agg(F.max(share).alias("largest"), F.sum("n").alias("all")).where(F.col("all") >= min(least.values()))
    enough = F.col("all") >= F.element_at(least_of, F.col("lang"))
    held = grams.join(largest, "gram").where(enough & (share >= model.part_of_largest * F.col("largest")))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy().view(np.uint64)
            bit = batch.column(1).to_numpy().astype(np.int64)
            at = np.concatenate([_positions(gram, k, model.bits) for k in range(model.hashes)])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(bit, model.hashes))], ["at", "bit"])

    spots = held.select("gram", F.element_at(bit_of, F.col("lang")).cast("long").alias("bit")).mapInArrow(placed, "at long, bit long")
    word = (F.col("bit") / 64).cast("int")
    masks = spots.groupBy("at", word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    table = np.zeros((1 << model.bits, -(-len(languages) // 64)), np.uint64)
    found = masks.toArrow()
    table[found["at"].to_numpy(), found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    fill = np.array([((table[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)).mean() for b in range(len(languages))])
    return Filters(languages, table, fill**model.hashes)


def counts(text: str, filters: Filters, model: LanguageModel) -> tuple[int, np.ndarray]:
    """N-grams of the whole text, and how many of them each language is reported for."""
    total, hits = 0, np.zeros(len(filters.languages), np.int64)
    for a in range(0, len(text), model.block):
        hashes = gram_hashes(letters(text[a : a + model.block]), model.grams)
        if not len(hashes):
            continue
        total += len(hashes)
        mask = filters.table[_positions(hashes, 0, model.bits)]
        for k in range(1, model.hashes):
            mask &= filters.table[_positions(hashes, k, model.bits)]
        for w in range(mask.shape[1]):
            own = np.ascontiguousarray(mask[:, w])
            for b in range(64 * w, min(64 * w + 64, len(hits))):
                hits[b] += np.count_nonzero(own & np.uint64(1 << (b % 64)))
    return total, hits


def predict(text: str | None, filters: Filters, model: LanguageModel = DEFAULT) -> tuple[str, float]:
    """The language, and the corrected part of the n-grams that it contains."""
    if not text or not filters.languages:
        return UNKNOWN, 0.0
    total, hits = counts(text, filters, model)
    if not total:
        return UNKNOWN, 0.0
    p = filters.false_rate
    true = (hits - total * p) / np.maximum(1 - p, 1e-9) / total
    best = int(np.argmax(true))
    return filters.languages[best], float(np.clip(true[best], 0.0, 1.0))


def identify(docs: DataFrame, filters: Filters, text: str = "text", model: LanguageModel = DEFAULT) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. The filters have a fixed size (see ``bits``)."""
    docs = without(docs, ("lang_pred", "score"))
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.table, filters.false_rate))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])
    at = docs.columns.index(text)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        for batch in batches:
            found = [predict(t, own, model) for t in batch.column(at).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.fieldNames())

    return docs.mapInArrow(identified, schema)
