"""Rows that can have a partner, kept ahead of the shuffle for a join.

The keys of the smaller side become a bit table of fixed size, and their range in one numeric column two
bounds. All three are scalar subqueries: no job runs while the plan is built, and the bounds reach the
scan of the larger side, where statistics skip files and row groups. The table has one word for a key's hash, in
which the key sets three bits; a row passes if its word has all of its three. A row with a partner always passes.
Rows without one pass rarely while the table has some ten bits for each key, and more often beyond. A table that is
so full that most of them would pass is not asked, and then no hash is worked out for a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A row without a partner passes with the third power of the share of bits set: here, every other one.
FULL = 0.8


def _hashed(df: DataFrame, columns: Sequence[str], words: int) -> tuple[Column, Column]:
    """(word of a key, its three bits). Zeros of either sign are one key, as they are in a join."""
    plain = [F.col(c) + F.lit(0.0) if df.schema[c].dataType.typeName() in ("double", "float") else F.col(c) for c in columns]
    h = F.xxhash64(*plain)
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(h, F.lit(words)), bit(40).bitwiseOR(bit(46)).bitwiseOR(bit(52))


def may_match(rows: DataFrame, keys: DataFrame, on: Sequence[str], range_of: str | None = None, words: int = 1 << 17) -> DataFrame:
    """``rows`` without most of those whose columns ``on`` are not among ``keys``; an inner or semi join with
    ``keys`` gives the same result on either. ``range_of`` is one of the columns, numeric."""
    if any(rows.schema[c].dataType != keys.schema[c].dataType for c in on):
        # A join compares them after a cast, a hash does not.
        return rows
    word, bits = _hashed(keys, on, words)
    some = keys.select(word.alias("word"), bits.alias("bits"))
    every = rows.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    table = (
        some.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("table"), F.sum(F.bit_count("bits")).alias("set"))
        .select(F.when(F.col("set") <= FULL * 64 * words, F.col("table")).alias("table"))
    )
    if range_of:
        least, most = (keys.agg(f(range_of)).scalar() for f in (F.min, F.max))
        rows = rows.where((F.col(range_of) >= least) & (F.col(range_of) <= most))
    # The key as columns that a filter is not moved below: they may be long expressions, of which the four hashes would
    # each have a copy, in a method too long for Java to compile.
    parts = [f"_key_{i}" for i in range(len(on))]
    keyed = rows.select("*", F.inline(F.array(F.struct(*[F.col(c).alias(p) for c, p in zip(on, parts, strict=True)]))))
    word, bits = _hashed(keyed, parts, words)
    # No bit of the key is missing. Said with the bits once, as each mention works the hash out again.
    kept = F.bitwise_not(F.get(table.scalar(), word.cast("int"))).bitwiseAND(bits) == 0
    return keyed.where(table.scalar().isNull() | kept).drop(*parts)
