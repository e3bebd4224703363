"""Feeds of the refresh groups from the two databases and the landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, Rules
from tallysheet.plans.incremental import Feeds
from tallysheet.sources.extract import (
    Window,
    extract_brand_lines,
    extract_prices,
    extract_rubros,
    extract_sellers,
    lower_columns,
)
from tallysheet.sources.jdbc import JdbcSource, read_jdbc
from tallysheet.sources.landing import land
from tallysheet.sources.pages import read_articles, read_clients
from tallysheet.sources.sales import VOUCHER_NUMBER, jdbc_reader, read_sales

# The tables of the sales database and of the price database, with the columns that are read.
RUBROS = ("RUBROS", ("codigorubro", "codigosuperrubro"))
UNITS = ("UNIDADESXRUBRO", ("codigosuperrubro", "descripcion", "unidades"))
SELLERS = ("Vendedores", ("codigovendedor", "razonsocialvend", "activo"))
BRIDGE = ("MarcasxLineas", ("id", "marca_id", "linea_id"))
BRANDS = ("Marcas", ("marca_id", "marca"))
LINES = ("Lineas", ("linea_id", "linea"))
ARTICLES = ("ARTICULOS", ("codigoarticulo", "activo"))
SUPPLIED = ("ARTICULOSPROVEEDOR", ("codigo", "codigoarticulo", "precio"))
CHANGES = ("CAMBIOSDEPRECIOPROVEEDOR", ("codigoarticuloproveedor", "fechamodificacion", "precio"))


def jdbc_feeds(
    spark: SparkSession,
    sales_db: JdbcSource,
    prices_db: JdbcSource,
    client_pages: str,
    product_pages: str,
    rules: Rules = DEFAULT_RULES,
    split_by: str | None = VOUCHER_NUMBER,
) -> Feeds:
    """All seven feeds. Every scan is landed in its turn (see ``landing``), with its filter and columns
    reaching the database by Spark's own pushdown; joins are made in Spark, on the landed rows."""

    def landed(db: JdbcSource, table: tuple[str, tuple[str, ...]], kept: Column | None = None) -> DataFrame:
        name, columns = table

        def scan() -> DataFrame:
            rows = lower_columns(read_jdbc(spark, db, name))
            return (rows if kept is None else rows.where(kept)).select(*columns)

        return land(spark, db, scan, name.lower())

    active = F.col("activo") == 1
    by_tag = {s.db: s for s in rules.sources}
    reader = jdbc_reader(spark, sales_db, rules, split_by)

    def sales(tag: str, window: Window) -> DataFrame:
        return read_sales(reader, by_tag[tag], window, rules)

    def prices(window: Window) -> DataFrame:
        changes = landed(prices_db, CHANGES, window.covers("fechamodificacion"))
        return extract_prices(landed(prices_db, ARTICLES, active), landed(prices_db, SUPPLIED), changes, window=window, rules=rules)

    return Feeds(
        clients=lambda: read_clients(spark, client_pages),
        sellers=lambda: extract_sellers(landed(sales_db, SELLERS, active)),
        articulos=lambda: read_articles(spark, product_pages),
        rubros=lambda: extract_rubros(landed(sales_db, RUBROS), landed(sales_db, UNITS), rules=rules),
        marcas_lineas=lambda: extract_brand_lines(*[landed(sales_db, t) for t in (BRIDGE, BRANDS, LINES)]),
        sales=sales,
        prices=prices,
    )
