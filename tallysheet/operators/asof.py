"""As-of join: for each left row the nearest right row in time, per key.

Spark has no public as-of join. ``asof_join`` is built to hold when one key, or one instant of one
key, carries a large share of the rows:

* The answer depends on key and time only, so it is worked out once per distinct (key, instant);
  copies collapse in the partial aggregate, before any shuffle.
* Time is cut into slices (days by default) and the running window is partitioned by key *and*
  slice. With unique instants a group is bounded by the clock resolution within one slice, not
  by the number of rows.
* A slice may hold no match for its last instants. The match then is the first right row of the
  next slice that has one; it is found on a table of one row per key and slice. An instant that is
  the only one in its slice takes it from there. Else it is fed into the slice's window as an extra
  right row, laid out like the others so that the union moves nothing.
* The answers return to the left rows through an equi-join on (key, instant). The answer side is
  unique there, and adaptive execution can split hot left partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("forward", "backward")


def _present(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def _changes(
    right: DataFrame,
    by: Sequence[str],
    right_ts: str,
    values: Sequence[str],
    tie_break: Sequence[str],
) -> DataFrame:
    """Right side reduced to one row per key and instant, packed as (by.., _t, _hit)."""
    if len(values) == 1 and list(tie_break) == list(values):
        # The lowest value by itself: plain values, unlike structs, can be aggregated by hash.
        least = (
            right.where(_present(by))
            .groupBy(*by, F.col(right_ts).alias("_t"))
            .agg(F.min(values[0]).alias("_value"))
        )
        hit = F.struct(F.col("_t").alias("ts"), F.col("_value").alias(values[0]))
        return least.select(*by, "_t", hit.alias("_hit")).where(F.col("_hit")["ts"].isNotNull())
    hit = F.struct(F.col(right_ts).alias("ts"), *values)
    # Ascending by the tie-break columns, nulls after all values.
    rank = F.struct(*[part for c in tie_break for part in (F.col(c).isNull(), F.col(c))])
    per_instant = (
        right.where(_present(by))
        .groupBy(*by, F.col(right_ts).alias("_t"))
        .agg(F.min_by(hit, rank).alias("_hit"))
    )
    # Tested on the packed value: a filter on the grouping key would sink into the input and keep
    # its shuffle from being shared with other uses of the same history.
    return per_instant.where(F.col("_hit")["ts"].isNotNull())


def _check(direction: str) -> bool:
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}, not {direction!r}")
    return direction == "forward"


def _unpack(df: DataFrame, left: DataFrame, values: Sequence[str], matched_ts: str) -> DataFrame:
    return df.select(
        *[left[c] for c in left.columns],
        *[F.col("_hit")[v].alias(v) for v in values],
        F.col("_hit")["ts"].alias(matched_ts),
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    direction: str = "forward",
    inclusive: bool = True,
    matched_ts: str = "matched_ts",
    tie_break: Sequence[str] | None = None,
    slice_of: Callable[[str], Column] = F.to_date,
    parts: int | None = None,
) -> DataFrame:
    """Left outer as-of join; adds ``values`` and ``matched_ts``, null where nothing matches.

    ``forward`` takes the first right row at or after the left time, ``backward`` the last at or
    before it; ``inclusive=False`` excludes equal times. Right rows that share key and time are
    reduced to the one lowest in ``tie_break`` (default: ``values``), nulls last. Rows with a null
    key or time match nothing. ``slice_of`` maps a time to its slice and must not decrease.

    With ``parts`` the right side is stored in that many buckets of ``by`` (see ``write_bucketed``), and is not
    moved: the left instants come to it. All of a key is one task then, so this is for keys whose distinct
    instants a task can sort.
    """
    forward = _check(direction)
    changes = _changes(right, by, right_ts, values, tie_break or values)
    hit_type = changes.schema["_hit"].dataType
    # Plain columns: both uses of the events below need all of them, so that they share one shuffle.
    flat = [f"_v{i}" for i in range(len(values))]
    # Where the events of a key, or of a slice of a key, are put together.
    together = (lambda df: df.repartition(parts, *by)) if parts else (lambda df: df.repartition(*by, "_slice"))

    instants = left.where(_present([*by, left_ts])).select(*by, F.col(left_ts).alias("_t")).distinct()
    asked = instants.select(*by, "_t", F.lit(0).alias("_side"), *[F.lit(None).cast(hit_type[v].dataType).alias(c) for c, v in zip(flat, values, strict=True)])
    known = changes.select(*by, "_t", F.lit(1).alias("_side"), *[F.col("_hit")[v].alias(c) for c, v in zip(flat, values, strict=True)])
    # Shuffled once for both uses below: neither the aggregate nor the window adds an exchange.
    if parts:
        events = together(asked).unionByName(known).withColumn("_slice", slice_of("_t"))
    else:
        events = together(asked.unionByName(known).withColumn("_slice", slice_of("_t")))

    # One row per key and slice: its outermost change, and the instant that has the farthest to go, if the slice has no
    # change for it. Instants are unique among the changes of a key, so their values are picked one by one.
    changed, asks = F.when(F.col("_side") == 1, F.col("_t")), F.when(F.col("_side") == 0, F.col("_t"))
    outermost, pick, farthest = (F.min, F.min_by, F.max) if forward else (F.max, F.max_by, F.min)
    cells = events.groupBy(*by, "_slice").agg(
        outermost(changed).alias("_edge_ts"),
        *[pick(c, changed).alias(f"_edge_{i}") for i, c in enumerate(flat)],
        farthest(changed).alias("_last"),
        farthest(asks).alias("_ask"),
        (F.min(asks) == F.max(asks)).alias("_one"),
    )
    last, ask = F.col("_last"), F.col("_ask")
    if inclusive:
        has_match = last >= ask if forward else last <= ask
    else:
        has_match = last > ask if forward else last < ask
    # What orders the slices is that instant or the change, so the slice is not sent. ``_asks``: 0, 1 or 2 for more.
    edges = ["_edge_ts", *[f"_edge_{i}" for i in range(len(flat))]]
    wanted = ask.isNotNull() & ~F.coalesce(has_match, F.lit(False))
    cells = cells.select(
        *by, *edges, F.when(wanted, ask).otherwise(F.col("_edge_ts")).alias("_at"), F.when(wanted, F.when(F.col("_one"), 1).otherwise(2)).otherwise(0).alias("_asks")
    )
    order = F.col("_at").desc() if forward else F.col("_at").asc()
    beyond = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # Time and values one by one, so that a value nobody reads is not carried through any of the shuffles. A value may
    # be null where a time is not.
    found = F.col("_edge_ts").isNotNull()
    far = (
        cells.withColumn("_far_ts", F.last("_edge_ts", ignorenulls=True).over(beyond))
        .withColumns({f"_far_{i}": F.last(F.when(found, F.struct(f"_edge_{i}")), ignorenulls=True).over(beyond) for i in range(len(flat))})
        .where((F.col("_asks") > 0) & F.col("_far_ts").isNotNull())
    )
    far_values = [F.col(f"_far_{i}")[f"_edge_{i}"] for i in range(len(flat))]
    # With one instant in the slice the answer is known here. Others go back to their slice's window.
    alone = far.where(F.col("_asks") == 1).select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_at").alias("_t"), F.col("_far_ts").alias("_hit_ts"),
        *[v.alias(f"_hit{c}") for c, v in zip(flat, far_values, strict=True)],
    )
    carried = far.where(F.col("_asks") > 1).select(
        *by, F.col("_far_ts").alias("_t"), F.lit(1).alias("_side"), *[v.alias(c) for c, v in zip(flat, far_values, strict=True)],
        slice_of("_at").alias("_slice"),
    )
    if not parts:
        carried = together(carried)

    time = F.col("_t").desc() if forward else F.col("_t").asc()
    side = F.col("_side").desc() if inclusive else F.col("_side").asc()
    running = (
        Window.partitionBy(*by, "_slice")
        .orderBy(time, side)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    is_change = F.col("_side") == 1
    answers = (
        events.unionByName(carried)
        .withColumn("_hit_ts", F.last(F.when(is_change, F.col("_t")), ignorenulls=True).over(running))
        .withColumns({f"_hit{c}": F.last(F.when(is_change, F.struct(c)), ignorenulls=True).over(running) for c in flat})
        .where((F.col("_side") == 0) & F.col("_hit_ts").isNotNull())
        .select(*[F.col(c).alias(f"_by_{c}") for c in by], "_t", "_hit_ts", *[F.col(f"_hit{c}")[c].alias(f"_hit{c}") for c in flat])
        .unionByName(alone)
    )
    same = [left[c] == F.col(f"_by_{c}") for c in by] + [left[left_ts] == F.col("_t")]
    return left.join(answers, reduce(and_, same), "left").select(
        *[left[c] for c in left.columns],
        *[F.col(f"_hit{c}").alias(v) for c, v in zip(flat, values, strict=True)],
        F.col("_hit_ts").alias(matched_ts),
    )


def asof_join_arrays(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    direction: str = "forward",
    inclusive: bool = True,
    matched_ts: str = "matched_ts",
    tie_break: Sequence[str] | None = None,
    slice_of: Callable[[str], Column] = F.to_date,
    longest: int = 10_000,
) -> DataFrame:
    """Same result, without a sort of the left rows: a sorted array of right rows for each key and slice,
    in which every left row of that cell looks for its match.

    A cell that has no match for its last instants takes the outermost right row of the nearest cell that has
    one. The cells meet the left rows in a shuffle join, unique on their side, so hot cells are split. As every
    left row walks its array, a cell with more than ``longest`` instants stops the job: choose shorter slices,
    or ``asof_join``. No size is counted beforehand.
    """
    forward = _check(direction)
    changes = _changes(right, by, right_ts, values, tie_break or values)
    hit_type = changes.schema["_hit"].dataType
    # Rows without key or time are left in: they collapse and match nothing, and a filter here would sink into the
    # input and keep its shuffles from being shared with the left rows.
    asked = left.select(*by, slice_of(left_ts).alias("_slice")).distinct()
    # Shuffled row by row: neither arrays nor their first elements twice.
    cells = (
        changes.select(*by, slice_of("_t").alias("_slice"), "_hit", F.lit(False).alias("_asked"))
        .unionByName(asked.select(*by, "_slice", F.lit(None).cast(hit_type).alias("_hit"), F.lit(True).alias("_asked")))
        .repartition(*by, "_slice")
        .groupBy(*by, "_slice")
        .agg(F.sort_array(F.collect_list("_hit")).alias("_hits"), F.bool_or("_asked").alias("_asked"))
    )
    order = F.col("_slice").desc() if forward else F.col("_slice").asc()
    beyond = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    edge = F.try_element_at("_hits", F.lit(1 if forward else -1))
    cells = cells.repartition(*by).withColumn("_edge", F.last(edge, ignorenulls=True).over(beyond)).where("_asked")
    too_long = F.raise_error(F.concat(F.lit("right rows in one slice: "), F.size("_hits").cast("string"))).cast(cells.schema["_hits"].dataType)
    cells = cells.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], "_slice", "_edge",
        F.when(F.size("_hits") <= longest, F.col("_hits")).otherwise(too_long).alias("_hits"),
    )
    ts = left[left_ts]

    def reachable(hit: Column) -> Column:
        if forward:
            return hit["ts"] >= ts if inclusive else hit["ts"] > ts
        return hit["ts"] <= ts if inclusive else hit["ts"] < ts

    same = [left[c] == F.col(f"_by_{c}") for c in by] + [slice_of(ts) == F.col("_slice")]
    joined = left.join(cells, reduce(and_, same), "left")
    nearest = F.try_element_at(F.filter("_hits", reachable), F.lit(1 if forward else -1))
    return _unpack(joined.withColumn("_hit", F.coalesce(nearest, F.col("_edge"))), left, values, matched_ts)
