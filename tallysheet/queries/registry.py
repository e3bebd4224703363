"""Named queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from tallysheet.queries.oracle import FRACTION, oracle

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Decimals as text with all their digits, so that both engines hand out the same. No value of the
    library has more than twelve fraction digits."""

    plain = df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"

    def shown(name: str, dtype: DataType) -> Column:
        c = F.col(name)
        if not isinstance(dtype, DecimalType):
            return c
        if plain and dtype.scale <= FRACTION and dtype.precision - dtype.scale <= 38 - FRACTION:
            # Every value fits, and in ANSI mode the text of a decimal has no exponent.
            return c.cast(DecimalType(38, FRACTION)).cast("string").alias(name)
        # Whole and fraction apart: without ANSI mode small decimals are written with an exponent. The
        # remainder keeps all digits, where a difference of wide decimals would be cut.
        one, scale = F.lit(1).cast("decimal(1,0)"), F.lit(10**FRACTION).cast("decimal(13,0)")
        fraction = ((F.abs(c) % one) * scale).cast("decimal(38,0)").cast("string")
        whole = F.floor(F.abs(c)).cast("string")
        return F.concat(F.when(c < 0, "-").otherwise(""), whole, F.lit("."), F.lpad(fraction, FRACTION, "0")).alias(name)

    return df.select([shown(f.name, f.dataType) for f in df.schema.fields])


def query(name: str, sql: str | None, changed: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart over the oracle models, None if there is none. ``changed``
    states some of the models otherwise."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            _ORACLES[name] = oracle(sql, changed)
        return fn

    return register


def _load_all() -> None:
    from tallysheet.queries import extraction, fact, loading, models, quality  # noqa: F401


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
