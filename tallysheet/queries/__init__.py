"""Every operator as a query over the supplied tables, with its DuckDB counterpart."""

from tallysheet.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
