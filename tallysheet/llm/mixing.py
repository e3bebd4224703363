"""Mixing sources to target weights.

Sizes are summed per source, targets follow from weights by water filling, and every document is
taken floor(rate) times plus one copy whose draw is a Bernoulli trial. The trial is seeded by a hash of the
id, of the text, and of the turn of the document among those equal in both. So documents without an id, or
with one id, draw each for itself, and so do copies.

Cases: null text has size 0. Texts of any length are read whole. A null source is a source of its own, last in
order. A source of size 0 has target and rate 0. Ids may be null or repeated. Repeated rows are told apart by their
turn, in no stated order. An empty table gives an empty result. Columns that have the name of a column added
here are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.llm.tables import free_name, stored, without

ADDED = ("size", "source_size", "target", "copies", "taken")


@dataclass(frozen=True)
class Mix:
    # Weights by the rank of the source in code point order, repeating.
    weights: tuple[int, ...] = (3, 1, 2)
    # The whole mix and the most of one source, as multiples of what there is.
    total_share: float = 1.5
    most_share: int = 2
    seed: str = "mix"
    # Sources up to this many are broadcast; more take a shuffle join.
    broadcast_sources: int = 50_000


DEFAULT = Mix()


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: starts of words, without building the words."""
    padded = F.concat(F.lit(" "), F.coalesce(text, F.lit("")))
    # A word start is a separator followed by something else.
    return F.regexp_count(padded, F.lit(r"[\x20\x09-\x0D](?![\x20\x09-\x0D]|\z)")).cast("long")


def ranked(sources: DataFrame, source: str) -> DataFrame:
    """``sources`` (one row each) with ``rank`` from 0 in code point order, null last.

    No task sees all sources: rows are cut into ranges, numbered within, and moved up by the
    number of rows in earlier ranges.
    """
    spark = sources.sparkSession
    last = F.col(source).isNull()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stored(
        sources.repartitionByRange(parts, last, F.col(source)).withColumn("range", F.spark_partition_id()), "ranges"
    )
    counts = {r["range"]: r["count"] for r in cut.groupBy("range").count().collect()}
    before, total = {}, 0
    for k in sorted(counts):
        before[k], total = total, total + counts[k]
    moved = F.lit(0).cast("long")
    if before:
        moved = F.element_at(F.create_map([F.lit(x) for pair in before.items() for x in pair]), F.col("range"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(last, source)) - 1
    return cut.withColumn("rank", moved + within).drop("range")


def targets(sized: DataFrame, source: str = "source", size: str = "size", mix: Mix = DEFAULT) -> DataFrame:
    """One row for each source: ``source_size``, ``weight``, ``target``.

    Water filling in rounds: sources above their limit get the limit, and the rest is shared by
    weight again, until none is above. A round is one sum over the sources, of integers, so the
    result does not depend on the order of rows.
    """
    sums = sized.groupBy(F.col(source)).agg(F.sum(size).alias("source_size"))
    sources = ranked(sums, source)
    weights = F.array([F.lit(w) for w in mix.weights])
    sources = stored(
        sources.withColumn("weight", F.element_at(weights, (F.col("rank") % len(mix.weights) + 1).cast("int"))),
        "sources",
    )
    limit = mix.most_share * F.col("source_size")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"] * mix.total_share
    level = 0.0
    while True:
        over = F.col("weight") * F.lit(level) > limit
        r = sources.agg(
            F.sum(F.when(over, limit).otherwise(0)).alias("limited"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not r["weight"]:
            break
        share = (total - r["limited"]) / r["weight"]
        if share <= level:
            break
        level = share
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit).cast("double"))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def draw(doc_id: Column, digest: Column, turn: Column, seed: str) -> Column:
    """A number in [0, 1) from a hash: 52 bits of an MD5 digest."""
    named = F.coalesce(doc_id.cast("string"), F.lit("null"))
    hashed = F.md5(F.concat_ws(":", F.lit(seed), named, digest, turn.cast("string")))
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_turns(docs: DataFrame, narrow: DataFrame, keys: Sequence[str], turn: str, mix: Mix = DEFAULT) -> DataFrame:
    """``docs`` with the turn (from 1) of each row among those equal in ``keys``; ``narrow`` has the same
    rows in these columns and is cheap to read.

    Only rows that have an equal are shuffled. They are counted for each key and input partition and
    numbered within, so that no task sees all rows of a key.
    """
    repeated = stored(narrow.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).count().where("count > 1").drop("count"), "repeated")
    n = repeated.count()
    if not n:
        return docs.withColumn(turn, F.lit(1).cast("long"))
    if n <= mix.broadcast_sources:
        repeated = F.broadcast(repeated)
    part = free_name([*docs.columns, turn], "part")
    placed = docs.withColumn(part, F.spark_partition_id())
    equal = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    alone = placed.join(repeated, equal, "left_anti").withColumn(turn, F.lit(1).cast("long")).drop(part)
    several = placed.join(repeated, equal, "left_semi")
    counts = several.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col(part).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_{i}" for i in range(len(keys))]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(0)))
    numbered = several.withColumn(turn, within).join(counts, equal & (F.col(part) == F.col("_part")))
    moved = (F.col(turn) + F.col("_before")).alias(turn)
    return alone.unionByName(numbered.select(*[F.col(f"`{c}`") for c in docs.columns], moved))


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    size: str | None = None,
    digest: str | None = None,
    mix: Mix = DEFAULT,
) -> DataFrame:
    """``docs`` (from files, as they are read twice) with ``size``, ``source_size``, ``target``, ``copies``
    and ``taken``.

    ``size`` and ``digest`` name columns of ``docs`` that already have the sizes and the ``text_digest``; else
    those of ``text`` are worked out. A hot source is one row after partial sums; its documents never
    meet in one task.
    """
    sized = without(docs, [a for a in ADDED if a != size])
    sized = sized.withColumn("size", F.col(size).cast("long") if size else word_count(F.col(text)))
    own, turn = free_name(sized.columns, "mix_digest"), free_name(sized.columns, "mix_turn")
    sized = sized.withColumn(own, F.col(digest) if digest else text_digest(F.col(text)))
    keys = [doc_id, source, own]
    # The texts are read once for sizes and digests, and once for the result.
    narrow = sized.select(*dict.fromkeys([*keys, "size"]))
    if not (size and digest):
        narrow = stored(narrow, "sizes")
    by_source = stored(targets(narrow, source, "size", mix), "targets").select(
        F.col(source).alias(key := free_name(sized.columns, "mix_source")), "source_size", "target"
    )
    if by_source.count() <= mix.broadcast_sources:
        by_source = F.broadcast(by_source)
    mixed = with_turns(sized, narrow, keys, turn, mix).join(by_source, F.col(source).eqNullSafe(F.col(key)), "left").drop(key)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    extra = (draw(F.col(doc_id), F.col(own), F.col(turn), mix.seed) < rate - whole).cast("long")
    mixed = mixed.withColumn("copies", (whole + extra).cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return mixed.drop(own, turn)


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each document as often as it is taken, with ``columns`` only."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select([F.col(f"`{c}`") for c in columns] + [copies.alias("_copy")]).drop("_copy")
