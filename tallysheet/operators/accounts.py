"""Account resolution and detection of discount-scheme (GM) sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, Rules
from tallysheet.functions import blank_to_null, discount_number, discount_text
from tallysheet.operators.lookup import lookup
from tallysheet.schemas import PERCENT


def _resolution() -> dict[str, Column]:
    """A client with a principal is secondary and books under that principal; one hop only."""
    principal = blank_to_null("cuenta_principal_codigo")
    return {
        "es_cuenta_secundaria": principal.isNotNull(),
        "codigo_cuenta_resuelta": F.coalesce(principal, F.col("codigo_cliente")),
    }


def resolve_account(sales: DataFrame, clients: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add principal code, secondary flag and resolved account. Unknown clients are kept."""
    principals = clients.select("codigo_cliente", "cuenta_principal_codigo")
    rows = lookup(sales, principals, ["codigo_cliente"], "left", rules.broadcast_bytes)
    return rows.withColumns(_resolution())


def _account_master(clients: DataFrame, sellers: DataFrame, rules: Rules) -> DataFrame:
    """What a sale takes over from its resolved account. The seller is joined and the discount read here,
    client by client, so that the sales do not pay for either."""
    text = discount_text("barrio", rules.gm_discount_pattern)
    number = discount_number(text)
    percent = number.try_cast(PERCENT)
    names = sellers.select(F.col("codigo_vendedor").alias("_seller"), "nombre_vendedor")
    master = clients.select(
        F.col("codigo_cliente").alias("codigo_cuenta_resuelta"),
        F.col("razon_social").alias("razon_social_cuenta"),
        F.col("barrio").alias("barrio_cliente"),
        F.col("codigo_vendedor").alias("codigo_vendedor_cliente"),
        F.col("codigo_zona").alias("codigo_zona_cliente"),
        F.col("codigo_particular").alias("codigo_particular_cliente"),
        F.col("es_gm").alias("cliente_es_gm"),
        text.isNotNull().alias("_has_discount"),
        percent.alias("_percent"),
        F.when(percent.isNull(), F.concat(F.lit("discount out of range: "), number)).alias("_unfit"),
    )
    seller_of = F.col("codigo_vendedor_cliente") == F.col("_seller")
    return master.join(names, seller_of, "left").drop("_seller")


def _flag_gm(rows: DataFrame, rules: Rules) -> DataFrame:
    """The flag asks for the text only: a malformed number still makes a GM sale, without rate. A well-formed
    one that does not fit stops the job, if there is a sale with it."""
    is_gm = (
        (F.col("tipo_comprobante") == rules.gm_voucher_type)
        & F.col("nro_punto_venta").isin(*rules.gm_points_of_sale)
        & F.col("_has_discount")
    )
    percent = F.coalesce("_percent", F.when(F.col("_unfit").isNotNull(), F.raise_error(F.col("_unfit"))))
    names = [c for c in rows.columns if c not in ("_has_discount", "_unfit", "_percent")]
    return rows.select(*names, percent.alias("gm_descuento_pct"), F.coalesce(is_gm, F.lit(False)).alias("es_venta_gm"))


def detect_gm(
    sales: DataFrame, clients: DataFrame, sellers: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Attach the resolved account and flag GM sales. Sales of unknown accounts are dropped."""
    master = _account_master(clients, sellers, rules)
    rows = lookup(sales, master, ["codigo_cuenta_resuelta"], "inner", rules.broadcast_bytes)
    return _flag_gm(rows, rules)


def account_dimension(clients: DataFrame, sellers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Each client with what its sales take over from the account it resolves to. Clients of unknown accounts
    are left out."""
    own = clients.select("codigo_cliente", "cuenta_principal_codigo").withColumns(_resolution())
    return own.join(_account_master(clients, sellers, rules), "codigo_cuenta_resuelta")


def attach_accounts(
    sales: DataFrame, clients: DataFrame, sellers: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """``detect_gm(resolve_account(sales))`` with one join of the sales instead of two.

    Each client is resolved to its account among the clients themselves. A sale whose client is
    unknown resolves to a code that is not in the master either, so the inner join drops it just
    as the two-step form does.
    """
    accounts = account_dimension(clients, sellers, rules)
    rows = lookup(sales, accounts, ["codigo_cliente"], "inner", rules.broadcast_bytes)
    return _flag_gm(rows, rules)


def with_accounts(sales: DataFrame, clients: DataFrame, sellers: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The sales that ``attach_accounts`` keeps, without its columns."""
    known = account_dimension(clients, sellers, rules).select("codigo_cliente")
    return lookup(sales, known, ["codigo_cliente"], "left_semi", rules.broadcast_bytes)
