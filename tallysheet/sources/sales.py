"""One scan template over the configured voucher sources."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tallysheet.config import DEFAULT_RULES, Rules, SalesSource
from tallysheet.sources.extract import Window, extract_sales, lower_columns, union_sources
from tallysheet.sources.jdbc import JdbcSource, body_query, header_query, read_jdbc
from tallysheet.sources.landing import equi_depth, land, predicates

# Fixed value: the column that numbers vouchers, in headers and bodies.
VOUCHER_NUMBER = "NUMEROCOMPROBANTE"

# Gives the header and body DataFrames of one source.
VoucherReader = Callable[[SalesSource, Window | None], tuple[DataFrame, DataFrame]]


def jdbc_reader(
    spark: SparkSession, db: JdbcSource, rules: Rules = DEFAULT_RULES, split_by: str | None = VOUCHER_NUMBER
) -> VoucherReader:
    """Vouchers of a database, landed within its connections: header and body take turns, and each is
    cut into as many parts as there are connections. ``split_by`` is a numeric column that both have; the
    parts have equally many headers. Without it, or with one connection, a scan is one task."""

    def read(source: SalesSource, window: Window | None) -> tuple[DataFrame, DataFrame]:
        if window is None:
            heads, lines = source.header, source.body
        else:
            heads, lines = header_query(source, window, rules), body_query(source, window, rules)
        parts: list[str] = []

        def headers() -> DataFrame:
            if split_by:
                asked = lambda text: read_jdbc(spark, db, text)
                parts.extend(predicates(split_by, equi_depth(asked, heads, split_by, db.max_connections)))
            return read_jdbc(spark, db, heads, parts)

        header = land(spark, db, headers, "header")
        return header, land(spark, db, lambda: read_jdbc(spark, db, lines, parts), "body")

    return read


def table_reader(spark: SparkSession) -> VoucherReader:
    """Sources that already sit in the catalog under their own table names."""

    def read(source: SalesSource, window: Window | None) -> tuple[DataFrame, DataFrame]:
        return spark.table(source.header), spark.table(source.body)

    return read


def read_sales(
    reader: VoucherReader,
    source: SalesSource,
    window: Window | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    header, body = (lower_columns(df) for df in reader(source, window))
    return extract_sales(header, body, source, window, rules)


def read_all_sales(
    reader: VoucherReader,
    window: Window | None = None,
    rules: Rules = DEFAULT_RULES,
    sources: Iterable[SalesSource] | None = None,
) -> DataFrame:
    return union_sources(
        [read_sales(reader, s, window, rules) for s in (sources or rules.sources)]
    )
