"""Checks over the derived models."""

from __future__ import annotations


from tallysheet.operators.staging import stg_articulos, stg_clients
from tallysheet.plans.fact import build_fact, models_to_check
from tallysheet.quality.checks import (
    check_accepted,
    check_no_fanout,
    check_not_null,
    check_report,
    check_unique,
)
from tallysheet.quality.declared import DECLARED
from tallysheet.queries import fixtures as fx
from tallysheet.queries.models import _attach, _clients, _history, _sales
from tallysheet.queries.registry import query
from tallysheet.operators.accounts import resolve_account
from tallysheet.operators.prices import price_at_sale


@query(
    "dq_not_null",
    """select fuente, numero_comprobante, codigo_articulo from prices
    where precio_vigente_desde is null""",
)
def _not_null(spark, sf_dir):
    priced = price_at_sale(_attach(spark, sf_dir), _history(spark, sf_dir))
    return check_not_null(priced, "precio_vigente_desde").select(
        "fuente", "numero_comprobante", "codigo_articulo"
    )


@query(
    "dq_unique",
    """select codigo_rubro, count(*) as n from stg_articulos
    where codigo_rubro is not null group by 1 having count(*) > 1""",
)
def _unique(spark, sf_dir):
    return check_unique(stg_articulos(fx.source(spark, sf_dir, "src_articles")), "codigo_rubro")


@query(
    "dq_accepted",
    "select codigo_cliente, codigo_zona from stg_clients where codigo_zona not in ('BUILDING', 'MACHINERY')",
)
def _accepted(spark, sf_dir):
    clients = stg_clients(fx.raw_clients(spark, sf_dir))
    return check_accepted(clients, "codigo_zona", ("BUILDING", "MACHINERY")).select(
        "codigo_cliente", "codigo_zona"
    )


@query(
    "dq_fanout",
    """with n as (select (select count(*) from stg_sales) as rows_before,
                         (select count(*) from accounts) as rows_after)
    select rows_before, rows_after, rows_after > rows_before as fanout from n""",
)
def _fanout(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    return check_no_fanout(sales, resolve_account(sales, _clients(spark, sf_dir)))


# Oracle subquery behind each model, and the names under which it holds the fact columns.
_ORACLE_MODEL = {
    "stg_sales": "stg_sales", "stg_clients": "stg_clients", "stg_sellers": "stg_sellers",
    "stg_articulos": "stg_articulos", "stg_marcas_lineas": "stg_marcas",
    "stg_price_history": "stg_prices", "int_sales_accounts": "accounts", "int_sales_gm": "gm",
    "int_sales_enriched": "enriched", "int_sales_calculated": "calculated",
    "int_sales_breakdown": "breakdown", "fct_sales": "fact",
    "stg_rubros": "(select *, unidades_super_rubro as unidades_min_rubro from raw_rubros)",
}


def _declared_sql(checks):
    parts = []
    for c in checks:
        model = _ORACLE_MODEL[c.model]
        if c.kind == "not_null":
            failing = f"(select count(*) from {model} where {c.column} is null)"
        elif c.kind == "unique":
            failing = (
                f"(select count(*) from (select {c.column} from {model} where {c.column} is not null"
                f" group by 1 having count(*) > 1))"
            )
        else:
            values = ", ".join(f"'{v}'" for v in c.values)
            failing = f"(select count(*) from {model} where {c.column} not in ({values}))"
        parts.append(
            f"select '{c.model}' as model, '{c.column}' as column_name, '{c.kind}' as check_name,"
            f" {failing} as failures"
        )
    return "\nunion all ".join(parts)


@query("dq_declared_staging", _declared_sql([c for c in DECLARED if c.model.startswith("stg_")]))
def _declared_staging(spark, sf_dir):
    return check_report(fx.staged_tables(spark, sf_dir).models(), DECLARED)


@query("dq_declared_intermediate", _declared_sql([c for c in DECLARED if c.model.startswith("int_")]))
def _declared_intermediate(spark, sf_dir):
    return check_report(models_to_check(fx.staged_tables(spark, sf_dir, True), fx.RULES, by_voucher=True), DECLARED)


@query("dq_declared_mart", _declared_sql([c for c in DECLARED if c.model == "fct_sales"]))
def _declared_mart(spark, sf_dir):
    return check_report({"fct_sales": build_fact(fx.staged_tables(spark, sf_dir, True), fx.RULES, by_voucher=True)}, DECLARED)
