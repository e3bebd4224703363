"""From staged tables to the fact table, as one lazy plan."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, Rules
from tallysheet.functions import month_key
from tallysheet.operators.accounts import account_dimension, attach_accounts, detect_gm, resolve_account, with_accounts
from tallysheet.operators.articles import article_dimension, enrich_articles
from tallysheet.operators.lookup import is_small
from tallysheet.operators.mart import fct_sales
from tallysheet.operators.prices import price_at_sale
from tallysheet.operators.pricing import branch, breakdown, final_price
from tallysheet.operators.staging import STAGING
from tallysheet.sinks.tables import replace_table
from tallysheet.sources.tables import Catalog, raw, register


@dataclass(frozen=True)
class Staged:
    """The seven staged tables."""

    sales: DataFrame
    clients: DataFrame
    articulos: DataFrame
    sellers: DataFrame
    rubros: DataFrame
    marcas_lineas: DataFrame
    price_history: DataFrame

    def models(self) -> dict[str, DataFrame]:
        return {f"stg_{name}": df for name, df in vars(self).items()}


def staged(raw_tables: dict[str, DataFrame]) -> Staged:
    """Apply the staging function of each model to its raw table."""
    return Staged(
        **{
            model.removeprefix("stg_"): stage(raw_tables[table])
            for model, (table, stage) in STAGING.items()
        }
    )


def staged_from_catalog(spark: SparkSession, catalog: Catalog) -> Staged:
    return staged({table: raw(spark, catalog, table) for table, _ in STAGING.values()})


def priced_with_accounts(
    sales: DataFrame,
    clients: DataFrame,
    sellers: DataFrame,
    history: DataFrame,
    rules: Rules = DEFAULT_RULES,
    arrays: bool = False,
    parts: int | None = None,
    by_voucher: bool = False,
) -> DataFrame:
    """``price_at_sale(attach_accounts(sales))``. Where the accounts are broadcast, the sales without one go first and
    the others get its columns behind the shuffle for the price, not ahead of it."""
    if not is_small(account_dimension(clients, sellers, rules), rules.broadcast_bytes):
        return price_at_sale(attach_accounts(sales, clients, sellers, rules), history, rules, arrays=arrays, parts=parts)
    rows = price_at_sale(with_accounts(sales, clients, sellers, rules), history, rules, arrays=arrays, parts=parts, by_voucher=by_voucher)
    priced = [c for c in rows.columns if c not in sales.columns]
    rows = attach_accounts(rows, clients, sellers, rules)
    return rows.select(*[c for c in rows.columns if c not in priced], *priced)


def priced_sales(s: Staged, rules: Rules = DEFAULT_RULES, arrays: bool = False, by_voucher: bool = False) -> DataFrame:
    """Sales with account, supplier price, article attributes, final price and breakdown.

    Sales without account go first; prices next, so that the one shuffle of the sales happens before the account and
    article columns widen the rows. ``by_voucher``: see ``price_at_sale``.
    """
    rows = priced_with_accounts(s.sales, s.clients, s.sellers, s.price_history, rules, arrays, by_voucher=by_voucher)
    return _finished(rows, s, rules)


def _finished(rows: DataFrame, s: Staged, rules: Rules) -> DataFrame:
    rows = enrich_articles(rows, s.articulos, s.rubros, s.marcas_lineas, rules)
    return breakdown(branch(final_price(rows), rules))


def build_fact(s: Staged, rules: Rules = DEFAULT_RULES, arrays: bool = False, by_voucher: bool = False) -> DataFrame:
    return fct_sales(priced_sales(s, rules, arrays, by_voucher), rules)


def build_gathered(s: Staged, rules: Rules = DEFAULT_RULES, by_voucher: bool = False) -> tuple[DataFrame, bool]:
    """The fact for a write by month, and whether its rows are gathered by month already. If both dimensions are
    broadcast they are, ahead of the columns that come from these or are worked out."""
    dims = (account_dimension(s.clients, s.sellers, rules), article_dimension(s.articulos, s.rubros, s.marcas_lineas))
    if not all(is_small(d, rules.broadcast_bytes) for d in dims):
        return build_fact(s, rules), False
    rows = price_at_sale(with_accounts(s.sales, s.clients, s.sellers, rules), s.price_history, rules, by_voucher=by_voucher)
    rows = rows.withColumn("_month", month_key("fecha_comprobante")).hint("rebalance", F.col("_month"))
    rows = attach_accounts(rows, s.clients, s.sellers, rules)
    return fct_sales(_finished(rows, s, rules), rules), True


def intermediate_models(s: Staged, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The six intermediate models one by one, for views and for the checks declared on them."""
    accounts = resolve_account(s.sales, s.clients, rules)
    gm = detect_gm(accounts, s.clients, s.sellers, rules)
    enriched = enrich_articles(gm, s.articulos, s.rubros, s.marcas_lineas, rules)
    prices = price_at_sale(enriched, s.price_history, rules)
    calculated = final_price(prices)
    return {
        "int_sales_accounts": accounts,
        "int_sales_gm": gm,
        "int_sales_enriched": enriched,
        "int_sales_prices": prices,
        "int_sales_calculated": calculated,
        "int_sales_breakdown": breakdown(branch(calculated, rules)),
    }


def register_models(s: Staged, rules: Rules = DEFAULT_RULES) -> list[str]:
    """Expose the staged and intermediate models as temporary views under their names; nothing is
    computed. Returns the names."""
    models = s.models() | intermediate_models(s, rules)
    return [name for name, df in models.items() if register(df, name) is df]


def store_models(s: Staged, catalog: Catalog, names: Iterable[str] | None = None, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Write the staged and intermediate models (or some of them) as tables of their layers, for readers that want
    them stored; returns rows per table. A model without rows leaves its table as it was."""
    models = s.models() | intermediate_models(s, rules)
    wanted = list(models) if names is None else list(names)
    if unknown := set(wanted) - set(models):
        raise ValueError(f"unknown models: {sorted(unknown)}")
    layer = lambda name: catalog.layer("staging" if name.startswith("stg_") else "intermediate")
    return {name: replace_table(models[name], f"{layer(name)}.{name}") for name in wanted}


def models_to_check(s: Staged, rules: Rules = DEFAULT_RULES, by_voucher: bool = False) -> dict[str, DataFrame]:
    """The same models for the checks. Every one from the account join on has the same rows, and
    the last has all the columns, so the checks read that one instead of each in turn."""
    accounts = resolve_account(s.sales, s.clients, rules)
    last = priced_sales(s, rules, by_voucher=by_voucher)
    later = ("gm", "enriched", "prices", "calculated", "breakdown")
    return {"int_sales_accounts": accounts} | {f"int_sales_{name}": last for name in later}
