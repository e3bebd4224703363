"""Top row per key as an aggregate. It combines map-side, so a hot key does not gather rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    prefer: Sequence[Column] | None = None,
) -> DataFrame:
    """For each key the values of its latest row, a null ``order`` counting as latest of all.

    Among rows that tie on ``order`` the one highest in ``prefer`` wins; without it, which must
    be numeric values then, the one lowest in ``values``. Nulls lose.
    """
    rank = [F.col(order).isNull(), F.col(order), *(prefer or [-F.col(v) for v in values])]
    if prefer is None:
        # A plain maximum, as the rank has the values. Spark knows that copies do not matter to it, and leaves out a distinct
        # below, with its shuffle.
        top = F.max(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(rank)], order, *values))
    else:
        top = F.max_by(F.struct(order, *values), F.struct(*rank))
    picked = df.groupBy(*keys).agg(top.alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in (order, *values)])
