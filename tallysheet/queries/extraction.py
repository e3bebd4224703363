"""Extraction from source-side tables and landed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallysheet.config import PAGE_SIZE
from tallysheet.functions import compose_timestamp
from tallysheet.queries.fixtures import RULES, raw_prices, raw_sales, source, table
from tallysheet.queries.registry import query
from tallysheet.scratch import scratch_dir
from tallysheet.sources import pages as api
from tallysheet.sources.extract import (
    Window,
    extract_brand_lines,
    extract_prices,
    extract_rubros,
    extract_sellers,
)
from tallysheet.sources.sales import read_all_sales
from tallysheet.sources.tables import encode_nested, text_null_policy

START, END = "1997-01-01 00:00:00", "1998-01-01 00:00:00"
# The window ends at the time of the last voucher, so that the end instant makes a difference.
_LAST = "(select max(fecha_comprobante) from raw_sales)"


@query("extract_sales", "select * from raw_sales")
def _extract_sales(spark, sf_dir):
    return raw_sales(spark, sf_dir)


def _up_to_last(spark, sf_dir, closed):
    last = raw_sales(spark, sf_dir).agg(F.max("fecha_comprobante")).first()[0]
    return raw_sales(spark, sf_dir, Window(START, last, closed))


@query(
    "extract_sales_window_halfopen",
    f"select * from raw_sales where fecha_comprobante >= '{START}' and fecha_comprobante < {_LAST}",
)
def _halfopen(spark, sf_dir):
    return _up_to_last(spark, sf_dir, "left")


@query(
    "extract_sales_window_closed",
    f"select * from raw_sales where fecha_comprobante >= '{START}' and fecha_comprobante <= {_LAST}",
)
def _closed(spark, sf_dir):
    return _up_to_last(spark, sf_dir, "both")


@query("source_union", "select * from raw_sales")
def _source_union(spark, sf_dir):
    header, body = (source(spark, sf_dir, n) for n in ("src_header", "src_body"))

    def reader(cfg, window):
        mine = F.col("db") == cfg.db
        return header.where(mine).drop("db", "tipo_consumo"), body.where(mine).drop("db")

    return read_all_sales(reader, rules=RULES)


@query(
    "compose_timestamp",
    """select db, numerocomprobante,
      cast(concat(cast(fechacomprobante as varchar), ' ', hora) as timestamp) as fecha_comprobante
    from src_header""",
)
def _compose(spark, sf_dir):
    return source(spark, sf_dir, "src_header").select(
        "db", "numerocomprobante",
        compose_timestamp("fechacomprobante", "hora").alias("fecha_comprobante"),
    )


@query("extract_prices_distinct", "select * from raw_prices")
def _prices(spark, sf_dir):
    return raw_prices(spark, sf_dir)


@query(
    "extract_prices_window",
    f"select * from raw_prices where fechamodificacion >= '{START}' and fechamodificacion < '{END}'",
)
def _prices_window(spark, sf_dir):
    # Upper-case names and newest first, as the price database hands them out.
    parts = [source(spark, sf_dir, n) for n in ("src_catalogue", "src_supplied", "src_changes")]
    upper = [df.toDF(*[c.upper() for c in df.columns]) for df in parts]
    return extract_prices(*upper, window=Window(START, END), newest_first=True)


@query("dim_rubros_default", "select * from raw_rubros")
def _rubros(spark, sf_dir):
    return extract_rubros(*[source(spark, sf_dir, n) for n in ("src_rubros", "src_units")])


@query("dim_brand_lines", "select * from raw_marcas_lineas")
def _brand_lines(spark, sf_dir):
    names = ("src_bridge", "src_brands", "src_lines")
    return extract_brand_lines(*[source(spark, sf_dir, n) for n in names])


@query(
    "dim_active_sellers",
    "select codigovendedor, razonsocialvend as nombre from src_sellers where activo = 1",
)
def _sellers(spark, sf_dir):
    return extract_sellers(source(spark, sf_dir, "src_sellers"))


# --- landed API pages ------------------------------------------------------------------------


def _land(spark, resources, order_key, name):
    """Write resources as numbered pages, one page document per text line; returns the path.

    Bodies hold data and links only, as the services send them. A page holds the keys of one block of
    the page size; the last one names no successor.
    """
    numbered = resources.withColumn("page", (F.expr(f"{order_key} div {PAGE_SIZE}") + 1).cast("int"))
    last = numbered.agg(F.max("page")).first()[0]
    docs = (
        numbered.groupBy("page")
        .agg(F.collect_list(F.struct("id", "attributes")).alias("data"))
        .select(
            "page",
            "data",
            F.struct(
                F.when(F.col("page") < last, F.concat(F.lit("/v1?page="), F.col("page") + 1))
                .alias("next")
            ).alias("links"),
        )
    )
    path = scratch_dir(spark, name)
    docs.select(F.to_json(F.struct("data", "links")).alias("value")).write.text(path)
    return path


def _client_pages(spark, sf_dir):
    c = source(spark, sf_dir, "src_clients").withColumn("_key", F.col("codigocliente").cast("long"))
    main = F.when(
        F.col("cuenta_principal_codigo") != "",
        F.struct(F.col("cuenta_principal_codigo").alias("codigoCliente")),
    )
    attributes = F.struct(
        F.col("codigocliente").alias("cdCliente"),
        F.col("codigoparticular").alias("codigoParticular"),
        F.col("razonsocial").alias("razonSocial"),
        F.when(F.col("_key") % 6 != 0, F.col("vendedor")).alias("vendedor"),
        F.col("zona"),
        F.col("barrio"),
        F.col("gm"),
        F.when(F.col("ag"), True).alias("ag"),
        F.col("es_excel").alias("esExcel"),
        F.col("contrareembolso"),
        main.alias("cuentaPrincipal"),
        F.when(
            F.col("_key") % 4 == 0,
            F.struct(F.lit("CC").alias("condicion"), (F.col("_key") % 60).cast("int").alias("dias")),
        ).alias("conditions"),
        F.struct(F.col("latitude"), F.col("longitude")).alias("coordinates"),
        F.when(
            F.col("_key") % 5 == 0,
            F.array(F.struct(F.lit(1).alias("codigo"), F.col("zona").alias("valor"))),
        ).alias("camposDinamicos"),
    )
    return c.select("_key", F.col("codigocliente").alias("id"), attributes.alias("attributes"))


@query(
    "api_pages_flatten",
    """select codigocliente, codigoparticular, cuenta_principal_codigo,
      '' as cuenta_principal_particular, razonsocial, '' as nombre_fantasia,
      case when cast(codigocliente as bigint) % 6 <> 0 then vendedor else '' end as vendedor,
      zona, barrio, '' as localidad, '' as domicilio, '' as telefono, '' as comentario, gm, ag,
      es_excel, es_agro,
      es_plan_gomeria, contrareembolso, contradeposito, latitude, longitude,
      case when cast(codigocliente as bigint) % 4 = 0
        then concat('{"condicion":"CC","dias":', cast(codigocliente as bigint) % 60, '}')
        else '{}' end as conditions,
      '{}' as discounts,
      case when cast(codigocliente as bigint) % 5 = 0
        then concat('[{"codigo":1,"valor":"', zona, '"}]') else '[]' end as campos_dinamicos,
      '[]' as sucursales
    from src_clients""",
)
def _flatten(spark, sf_dir):
    path = _land(spark, _client_pages(spark, sf_dir), "_key", "client-pages")
    rows = api.read_clients(spark, path, multi_line=False)
    rows = encode_nested(rows, "conditions", "discounts", "campos_dinamicos", "sucursales")
    return rows


@query(
    "api_products_flatten",
    """select codigo_articulo, codigo_particular, descripcion, codigo_rubro, codigo_marca,
      case when cast(codigo_articulo as bigint) % 4 = 0 then '' else descripcion_marca end
        as descripcion_marca
    from src_articles""",
)
def _products(spark, sf_dir):
    a = source(spark, sf_dir, "src_articles").withColumn("_key", F.col("codigo_articulo").cast("long"))
    brand = F.struct(F.col("descripcion_marca").alias("descripcion"))
    attributes = F.struct(
        F.col("codigo_particular").alias("codigoParticular"),
        "descripcion",
        F.col("codigo_rubro").alias("codigoRubro"),
        F.col("codigo_marca").alias("codigoMarca"),
        F.when(F.col("_key") % 4 != 0, brand).alias("marca"),
    )
    products = a.select("_key", F.col("codigo_articulo").alias("id"), attributes.alias("attributes"))
    return api.read_articles(spark, _land(spark, products, "_key", "product-pages"), multi_line=False)


@query(
    "api_pages_complete",
    """with p as (select cast(codigocliente as bigint) // 250 + 1 as page, count(*) as items
               from src_clients group by 1)
    select count(*) as pages, cast(max(page) as int) as last_page, cast(0 as bigint) as repeated,
      cast(1 as bigint) as ends, false as last_has_next,
      cast(arg_max(items, page) as int) as last_items, cast(0 as bigint) as empty
    from p""",
)
def _complete(spark, sf_dir):
    path = _land(spark, _client_pages(spark, sf_dir), "_key", "client-pages")
    pages = api.read_api_pages(spark, path, api.CLIENT_PAGE, multi_line=False)
    api.check_pages(pages)
    return api.page_report(pages)


@query(
    "nested_roundtrip",
    """select event_id, cast(json_extract_string(props, '$.k') as int) as k,
      concat('{"k":', json_extract_string(props, '$.k'), '}') as encoded
    from events""",
)
def _nested(spark, sf_dir):
    decoded = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("encoded"))
    return encode_nested(decoded.withColumn("k", F.col("encoded.k")), "encoded")


@query(
    "text_null_policy",
    """select codigocliente, nullif(cuenta_principal_codigo, '') as cuenta_principal_codigo
    from src_clients""",
)
def _null_text(spark, sf_dir):
    c = source(spark, sf_dir, "src_clients").select("codigocliente", "cuenta_principal_codigo")
    return text_null_policy(text_null_policy(text_null_policy(c, "null"), "blank"), "null")
