"""Counts of the whole corpus, looked up by its rows: frequent keys from memory, the rest by a join.

Few keys make up most occurrences. Those that are frequent enough, at most a stated number, are
broadcast; occurrences of all other keys go through a shuffle join with the whole table of counts. A
frequent key, which would be a hot join key, never takes part in that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequent_from(counts: DataFrame, n: str, most: int) -> int:
    """The least power of two that at most ``most`` rows of ``counts`` reach with their count ``n``."""
    bits = F.length(F.bin(F.col(n)))
    by_bits = {r["bits"]: r["count"] for r in counts.where(F.col(n) > 0).groupBy(bits.alias("bits")).count().collect()}
    total, least = 0, 63
    for b in sorted(by_bits, reverse=True):
        total += by_bits[b]
        if total > most:
            break
        least = b
    return 1 << (least - 1)
