"""Scans of a database within the number of connections it tolerates.

A lazy scan opens its connections whenever a plan runs it, next to the other scans of that plan. Here
every scan is a job of its own that lands its rows in the shared folder, in as many tasks as the database
has connections to give, and the scans of one database take turns, whichever thread asks. What follows reads
the landed files, as often as it likes. Turns are kept within a driver; drivers that share a database share its
budget by their settings.

Scans are cut at points that put equally many rows into each part. The points come from a histogram
that the database itself counts, of a bounded number of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from tallysheet.scratch import scratch_dir
from tallysheet.sources.jdbc import JdbcSource, as_table

# Buckets of the histogram that parts are cut by.
BUCKETS = 1_000

_TURNS: dict[str, Lock] = {}
_GUARD = Lock()


def _turn(source: JdbcSource) -> Lock:
    with _GUARD:
        return _TURNS.setdefault(source.url, Lock())


def land(spark: SparkSession, source: JdbcSource, scan: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """Run ``scan`` when it is the database's turn and return its rows from the shared folder.

    Filters and columns that are part of the scan reach the database by Spark's pushdown.
    """
    if spark.conf.get("spark.speculation", "false").lower() == "true":
        raise ValueError("speculative tasks open connections of their own; turn spark.speculation off for JDBC scans")
    path = scratch_dir(spark, purpose)
    with _turn(source):
        rows = scan()
        schema = rows.schema
        rows.coalesce(source.max_connections).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bounds_query(query: str, column: str) -> str:
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {as_table(query)}"


def histogram_query(query: str, column: str, low: int, width: int) -> str:
    bucket = f"FLOOR(({column} - {low}) / {width})"
    return f"SELECT {bucket} AS bucket, COUNT(*) AS n FROM {as_table(query)} WHERE {column} IS NOT NULL GROUP BY {bucket}"


def cut_points(histogram: list[tuple[int, int]], low: int, width: int, parts: int) -> list[int]:
    """Values at which to cut so that the parts have about as many rows each, from (bucket, rows)."""
    total = sum(n for _, n in histogram)
    points, seen, wanted = [], 0, 1
    for bucket, n in sorted(histogram):
        seen += n
        while wanted < parts and seen * parts >= wanted * total:
            points.append(low + (bucket + 1) * width)
            wanted += 1
    top = low + (max((b for b, _ in histogram), default=-1) + 1) * width
    return [p for p in dict.fromkeys(points) if p < top]


def equi_depth(read: Callable[[str], DataFrame], query: str, column: str, parts: int, buckets: int = BUCKETS) -> list[int]:
    """Cut points of the rows of ``query`` by a numeric column; none if one part is all there is. ``read`` runs a
    query in the database; both queries return at most a row for each bucket."""
    if parts < 2:
        return []
    found = read(bounds_query(query, column)).first()
    if found["low"] is None:
        return []
    low = math.floor(found["low"])
    width = max(1, math.ceil((found["high"] - low + 1) / buckets))
    rows = read(histogram_query(query, column, low, width)).collect()
    return cut_points([(int(r["bucket"]), int(r["n"])) for r in rows], low, width, parts)


def predicates(column: str, points: list[int]) -> list[str]:
    """One condition for each part; together they hold for every row once, nulls in the first part."""
    if not points:
        return ["1 = 1"]
    first = f"{column} < {points[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:], strict=False)]
    return [first, *middle, f"{column} >= {points[-1]}"]
