"""Joins of a large fact side to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of all tables that ``df`` reads, from their files' sizes; None if one is not known.

    A dimension is made of its tables by joins on unique keys, so it is not larger than they are.
    Nothing is run. Catalyst's estimate for the dimension itself is not used: it multiplies the sizes
    of both inputs when a dimension is itself a join.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total if total < 1 << 62 else None


def is_small(dim: DataFrame, max_bytes: int = DEFAULT_RULES.broadcast_bytes) -> bool:
    """Whether ``lookup`` broadcasts the dimension."""
    size = stored_bytes(dim) if max_bytes else None
    return size is not None and size <= max_bytes


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Column,
    how: str = "left",
    max_bytes: int = DEFAULT_RULES.broadcast_bytes,
) -> DataFrame:
    """Join facts to a dimension without moving the facts, if the dimension is small enough.

    The bound is in bytes and known without a job. Beyond it this is a shuffle join: adaptive
    execution still broadcasts a dimension that turns out small, and splits the partitions of hot
    keys (only the fact side is split, so ``inner``, ``left`` and ``left_semi`` qualify).
    """
    if is_small(dim, max_bytes):
        dim = F.broadcast(dim)
    return facts.join(dim, on if isinstance(on, Column) else list(on), how)
