"""Staging, account, article, price and pricing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallysheet.functions import discount_percent, discount_text, to_whole
from tallysheet.operators.accounts import attach_accounts, detect_gm, resolve_account
from tallysheet.operators.articles import brand_of, enrich_articles
from tallysheet.operators.asof import asof_join, asof_join_arrays
from tallysheet.operators.latest import latest_by
from tallysheet.operators.pricing import branch, breakdown, final_price
from tallysheet.operators.staging import (
    stg_articulos,
    stg_clients,
    stg_marcas_lineas,
    stg_price_history,
    stg_rubros,
    stg_sales,
    stg_sellers,
)
from tallysheet.plans.fact import priced_with_accounts
from tallysheet.queries import fixtures as fx
from tallysheet.queries.oracle import digits
from tallysheet.queries.registry import query
from tallysheet.scratch import scratch_dir
from tallysheet.sinks.tables import bucket_count, write_bucketed
from tallysheet.sources.extract import extract_brand_lines, extract_rubros, extract_sellers


def _sales(spark, sf_dir, by_voucher=False):
    return stg_sales(fx.raw_sales(spark, sf_dir, by_whole=by_voucher))


def _clients(spark, sf_dir):
    return stg_clients(fx.raw_clients(spark, sf_dir))


def _articles(spark, sf_dir):
    return stg_articulos(fx.source(spark, sf_dir, "src_articles"))


def _sellers(spark, sf_dir):
    return stg_sellers(extract_sellers(fx.source(spark, sf_dir, "src_sellers")))


def _rubros(spark, sf_dir):
    parts = (fx.source(spark, sf_dir, n) for n in ("src_rubros", "src_units"))
    return stg_rubros(extract_rubros(*parts))


def _brands(spark, sf_dir):
    parts = (fx.source(spark, sf_dir, n) for n in ("src_bridge", "src_brands", "src_lines"))
    return stg_marcas_lineas(extract_brand_lines(*parts))


def _history(spark, sf_dir):
    return stg_price_history(fx.raw_prices(spark, sf_dir))


def _amounts(*names):
    return ", ".join(map(digits, names))


STAGED_AMOUNTS = (
    "descuento_comprobante", "cantidad_articulo", "precio_unitario_articulo",
    "precio_total_articulo", "costo_venta_articulo", "descuento_articulo",
)


# --- staging -------------------------------------------------------------------------------


@query("stg_trim_cast", f"select * replace ({_amounts(*STAGED_AMOUNTS)}) from stg_sales")
def _stg_sales(spark, sf_dir):
    return _sales(spark, sf_dir)


@query(
    "stg_round_half_even",
    "select event_id, cast(round_even(event_id / 2.0, 0) as bigint) as whole from events",
)
def _half_even(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select(
        "event_id", to_whole(F.col("event_id") * 0.5).alias("whole")
    )


@query("stg_clients", "select * from stg_clients")
def _stg_clients(spark, sf_dir):
    empty = (
        "cuenta_principal_particular", "nombre_fantasia", "localidad", "domicilio", "telefono",
        "comentario", "latitude", "longitude", "conditions", "discounts", "campos_dinamicos",
        "sucursales",
    )
    return _clients(spark, sf_dir).drop(*empty)


@query("stg_articulos", "select * from stg_articulos")
def _stg_articulos(spark, sf_dir):
    return _articles(spark, sf_dir)


@query("stg_sellers", "select * from stg_sellers")
def _stg_sellers(spark, sf_dir):
    return _sellers(spark, sf_dir)


@query(
    "stg_rubros",
    """select codigo_rubro, codigo_super_rubro, descripcion_super_rubro,
      unidades_super_rubro as unidades_min_rubro from raw_rubros""",
)
def _stg_rubros(spark, sf_dir):
    return _rubros(spark, sf_dir)


@query("stg_marcas_lineas", "select * from stg_marcas")
def _stg_marcas(spark, sf_dir):
    return _brands(spark, sf_dir)


@query(
    "stg_price_history",
    f"select * replace ({_amounts('precio_actual_proveedor', 'precio_cambio')}) from stg_prices",
)
def _stg_prices(spark, sf_dir):
    return _history(spark, sf_dir)


# --- accounts ------------------------------------------------------------------------------


@query("resolve_account", f"select * replace ({_amounts(*STAGED_AMOUNTS)}) from accounts")
def _resolve(spark, sf_dir):
    return resolve_account(_sales(spark, sf_dir), _clients(spark, sf_dir))


@query(
    "account_rollup",
    f"""select strftime(fecha_comprobante, '%Y-%m') as year_month, codigo_cuenta_resuelta,
      count(*) as n_lines, {digits('sum(precio_total_articulo)', 'sale_price')}
    from accounts group by 1, 2""",
)
def _account_rollup(spark, sf_dir):
    rows = resolve_account(_sales(spark, sf_dir), _clients(spark, sf_dir))
    return rows.groupBy(
        F.date_format("fecha_comprobante", "yyyy-MM").alias("year_month"), "codigo_cuenta_resuelta"
    ).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("precio_total_articulo").alias("sale_price"))


_GM_SQL = f"select * replace ({_amounts(*STAGED_AMOUNTS, 'gm_descuento_pct')}) from gm"


@query("detect_gm", _GM_SQL)
def _gm(spark, sf_dir):
    clients = _clients(spark, sf_dir)
    accounts = resolve_account(_sales(spark, sf_dir), clients)
    return detect_gm(accounts, clients, _sellers(spark, sf_dir))


@query("attach_accounts", _GM_SQL)
def _attach(spark, sf_dir):
    return attach_accounts(_sales(spark, sf_dir), _clients(spark, sf_dir), _sellers(spark, sf_dir))


@query(
    "discount_regex",
    f"""select codigo_cliente, barrio, discount_text,
      {digits('try_cast(discount_text as decimal(20,10))', 'pct')} from discounts""",
)
def _discount(spark, sf_dir):
    text = discount_text("barrio", fx.RULES.gm_discount_pattern)
    c = _clients(spark, sf_dir).select("codigo_cliente", "barrio", text.alias("discount_text"))
    return c.withColumn("pct", discount_percent("discount_text"))


# --- articles ------------------------------------------------------------------------------


@query(
    "enrich_articles",
    f"""select * replace ({_amounts(*STAGED_AMOUNTS, 'gm_descuento_pct')},
      cast(unidades_min_rubro as double) as unidades_min_rubro) from enriched""",
)
def _enrich(spark, sf_dir):
    dims = (_articles(spark, sf_dir), _rubros(spark, sf_dir), _brands(spark, sf_dir))
    return enrich_articles(_attach(spark, sf_dir), *dims)


@query(
    "brand_cast_join",
    """select a.codigo_articulo, a.codigo_marca, m.marca_id, m.marca, m.linea_id, m.linea
    from stg_articulos a left join stg_marcas m on m.codigo_marca = try_cast(a.codigo_marca as int)""",
)
def _brand(spark, sf_dir):
    return brand_of(_articles(spark, sf_dir), _brands(spark, sf_dir)).select(
        "codigo_articulo", "codigo_marca", "marca_id", "marca", "linea_id", "linea"
    )


# --- prices --------------------------------------------------------------------------------


@query(
    "latest_price",
    f"""select codigo_articulo, fecha_modificacion, {digits('precio_actual_proveedor')}, {digits('precio_cambio')}
    from stg_prices
    qualify row_number() over (partition by codigo_articulo
      order by fecha_modificacion desc, precio_actual_proveedor, precio_cambio) = 1""",
)
def _latest(spark, sf_dir):
    return latest_by(
        _history(spark, sf_dir), ["codigo_articulo"], "fecha_modificacion",
        ["precio_actual_proveedor", "precio_cambio"],
    )


def _asof(kind, direction="forward", inclusive=True):
    def run(spark, sf_dir):
        sales = _sales(spark, sf_dir).select(
            "fuente", "numero_comprobante", "codigo_articulo", "fecha_comprobante"
        )
        return kind(
            sales,
            _history(spark, sf_dir),
            by=["codigo_articulo"],
            left_ts="fecha_comprobante",
            right_ts="fecha_modificacion",
            values=["precio_cambio"],
            direction=direction,
            inclusive=inclusive,
        )

    return run


def _asof_sql(condition):
    return f"""select v.fuente, v.numero_comprobante, v.codigo_articulo, v.fecha_comprobante,
      {digits('i.precio_cambio', 'precio_cambio')}, i.fecha_modificacion as matched_ts
    from stg_sales v asof left join instants i
      on i.codigo_articulo = v.codigo_articulo and i.fecha_modificacion {condition} v.fecha_comprobante"""


query("asof_window", _asof_sql(">="))(_asof(asof_join))
query("asof_array", _asof_sql(">="))(_asof(asof_join_arrays))
query("asof_window_strict", _asof_sql(">"))(_asof(asof_join, inclusive=False))
query("asof_backward", _asof_sql("<="))(_asof(asof_join, "backward"))
query("asof_backward_array", _asof_sql("<="))(_asof(asof_join_arrays, "backward"))


_PRICE_SQL = f"""select * replace ({_amounts(*STAGED_AMOUNTS, 'gm_descuento_pct',
    'precio_proveedor_vigente')}) from prices"""
_ARTICLE_COLUMNS = (
    "codigo_particular_articulo_master", "descripcion_articulo_master", "codigo_super_rubro",
    "descripcion_super_rubro", "unidades_min_rubro", "codigo_marca_int", "marca_id", "marca",
    "linea_id", "linea", "es_articulo_valido",
)


@query("price_at_sale", _PRICE_SQL.replace("* replace", f"* exclude ({', '.join(_ARTICLE_COLUMNS)}) replace"))
def _price(spark, sf_dir):
    return priced_with_accounts(_sales(spark, sf_dir, True), _clients(spark, sf_dir), _sellers(spark, sf_dir), _history(spark, sf_dir), by_voucher=True)


@query("price_at_sale_bucketed", _PRICE_SQL.replace("* replace", f"* exclude ({', '.join(_ARTICLE_COLUMNS)}) replace"))
def _price_bucketed(spark, sf_dir):
    """The change log stored in buckets of the article, which neither the as-of join nor the current price moves."""
    path = scratch_dir(spark, "price_log")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{path}'")
    history = _history(spark, sf_dir)
    parts = bucket_count(history)
    write_bucketed(history, f"{name}.price_log", ["codigo_articulo"], parts, ["fecha_modificacion"])
    log = spark.table(f"{name}.price_log")
    return priced_with_accounts(_sales(spark, sf_dir, True), _clients(spark, sf_dir), _sellers(spark, sf_dir), log, parts=parts, by_voucher=True)


# --- pricing rules -------------------------------------------------------------------------

_LINE = ("fuente", "numero_comprobante", "codigo_articulo", "codigo_deposito_articulo")


def _fine(*names):
    return ", ".join(map(digits, names))


@query(
    "final_price",
    f"""select {', '.join(_LINE)}, metodo_precio, {_fine('precio_final', 'gm_descuento_monto')}
    from calculated""",
)
def _final(spark, sf_dir):
    return final_price(_price(spark, sf_dir)).select(
        *_LINE, "metodo_precio", "precio_final", "gm_descuento_monto"
    )


@query(
    "discount_amount",
    f"""select fuente, count(*) as n_lines, count(gm_descuento_monto) as n_known,
      {digits('sum(gm_descuento_monto)', 'gm_descuento_monto')}
    from calculated where es_venta_gm group by 1""",
)
def _discount_amount(spark, sf_dir):
    rows = final_price(_price(spark, sf_dir)).where("es_venta_gm")
    return rows.groupBy("fuente").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count("gm_descuento_monto").alias("n_known"),
        F.sum("gm_descuento_monto").alias("gm_descuento_monto"),
    )


@query(
    "price_method",
    """select metodo_precio, es_venta_gm, es_cuenta_secundaria, count(*) as n_lines
    from calculated group by all""",
)
def _method(spark, sf_dir):
    return (
        final_price(_price(spark, sf_dir))
        .groupBy("metodo_precio", "es_venta_gm", "es_cuenta_secundaria")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


@query(
    "branch",
    """select nro_punto_venta, codigo_deposito_articulo, sucursal, count(*) as n_lines
    from breakdown group by all""",
)
def _branch(spark, sf_dir):
    # The account filter decides which lines there are; the branch needs nothing later.
    return (
        branch(_attach(spark, sf_dir))
        .groupBy("nro_punto_venta", "codigo_deposito_articulo", "sucursal")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


_PARTS = ("gm_cantidad", "gm_monto", "ds_cantidad", "ds_monto", "ppal_cantidad", "ppal_monto")


@query("breakdown", f"select {', '.join(_LINE)}, {_fine(*_PARTS)} from breakdown")
def _breakdown(spark, sf_dir):
    return breakdown(final_price(_price(spark, sf_dir))).select(*_LINE, *_PARTS)
