"""JDBC scans. A scan is cut into at most as many connections as the source tolerates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallysheet.config import DEFAULT_RULES, Rules, SalesSource
from tallysheet.sources.extract import Window


@dataclass(frozen=True)
class JdbcSource:
    """Connection settings. Pass secrets in from the caller's own configuration."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    max_connections: int = 1
    fetch_size: int = 10_000


def mysql(host: str, database: str, user: str, password: str, port: int = 3306) -> JdbcSource:
    url = f"jdbc:mysql://{host}:{port}/{database}?useCursorFetch=true"
    return JdbcSource(url, "com.mysql.cj.jdbc.Driver", user, password, max_connections=3)


def firebird(host: str, database: str, user: str, password: str, port: int = 3050) -> JdbcSource:
    url = f"jdbc:firebirdsql://{host}:{port}/{database}?charSet=UTF-8"
    return JdbcSource(url, "org.firebirdsql.jdbc.FBDriver", user, password, max_connections=1)


def as_table(query: str) -> str:
    """A table name, or a SELECT as a derived table."""
    text = query.strip().rstrip(";")
    return f"({text}) q" if text[:6].lower() == "select" else text


def jdbc_options(source: JdbcSource, query: str) -> dict[str, str]:
    """Reader options of a scan in one task."""
    return {
        "url": source.url,
        "driver": source.driver,
        "user": source.user,
        "password": source.password,
        "dbtable": as_table(query),
        "fetchsize": str(source.fetch_size),
        "preferTimestampNTZ": "true",
        "numPartitions": "1",
    }


def read_jdbc(spark: SparkSession, source: JdbcSource, query: str, parts: Sequence[str] = ()) -> DataFrame:
    """A table or a SELECT. ``parts`` are conditions that cut it, a task and a connection each; there
    may be no more than the source tolerates."""
    if len(parts) > source.max_connections:
        raise ValueError(f"{len(parts)} parts for {source.max_connections} connections")
    options = jdbc_options(source, query)
    if len(parts) < 2:
        return spark.read.format("jdbc").options(**options).load()
    kept = {k: v for k, v in options.items() if k not in ("url", "dbtable", "numPartitions")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(parts), properties=kept)


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def header_query(source: SalesSource, window: Window, rules: Rules = DEFAULT_RULES) -> str:
    """Headers of the window. Only the date is compared, so the source can use its index;
    the exact instant is tested again in Spark."""
    return (
        f"SELECT * FROM {source.header}"
        f" WHERE FECHACOMPROBANTE >= '{str(window.start)[:10]}'"
        f" AND FECHACOMPROBANTE < DATE_ADD('{str(window.end)[:10]}', INTERVAL 1 DAY)"
        f" AND ANULADA = 0 AND TIPOCOMPROBANTE IN ({_listed(rules.voucher_types)})"
    )


def body_query(source: SalesSource, window: Window, rules: Rules = DEFAULT_RULES) -> str:
    """Lines whose voucher is in the window. Bodies carry no date, so the source narrows them
    through the headers; otherwise every month would read every line ever sold."""
    return (
        f"SELECT b.* FROM {source.body} b"
        f" WHERE b.CODIGOARTICULO NOT IN ({_listed(rules.excluded_articles)})"
        f" AND EXISTS (SELECT 1 FROM ({header_query(source, window, rules)}) h"
        f" WHERE h.TIPOCOMPROBANTE = b.TIPOCOMPROBANTE"
        f" AND h.NUMEROCOMPROBANTE = b.NUMEROCOMPROBANTE)"
    )
