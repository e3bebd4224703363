"""The supplied tables seen as source-side tables.

The same SQL text runs in Spark and in DuckDB. Column values are derived so that every rule is
exercised: amounts with five to eight fraction digits and rates with ten, vouchers that are voided or not known to be, repeated voucher numbers with two dates, halves as
numbers, unknown types, excluded articles, secondary and missing accounts, malformed codes, articles with
several suppliers and with no price history.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallysheet.config import Rules
from tallysheet.plans.fact import Staged, staged
from tallysheet.schemas import RAW_ARTICULOS, RAW_CLIENTS, RAW_TABLES, conform
from tallysheet.sources.extract import (
    VOUCHER_KEY,
    extract_brand_lines,
    extract_prices,
    extract_rubros,
    extract_sales,
    extract_sellers,
)

# In the derived data these two stand for the excluded articles.
EXCLUDED = ("42", "43")
RULES = Rules(excluded_articles=EXCLUDED)

_DB = "case {k} % 4 when 0 then 'DIMDS' when 1 then 'DIMPPAL' when 2 then 'DISDS' else 'DISPPAL' end"
_TYPE = (
    "case when {k} % 3 = 0 then 'RE' else case {k} % 7 when 0 then 'FA' when 1 then 'FB'"
    " when 2 then 'NCA' when 3 then 'NCB' when 4 then 'NDA' when 5 then 'NDB' else 'XX' end end"
)

# Some numbers are halves: they round to the even neighbour.
_NUMBER = "cast({k} as double) + case when {k} % 61 = 0 then 0.5 else 0.0 end"

SOURCE_SQL: dict[str, str] = {
    "src_header": f"""
select {_DB.format(k='o_orderkey')} as db,
  case when o_orderkey % 2 = 0 then 'DS' else 'PPAL' end as tipo_consumo,
  {_TYPE.format(k='o_orderkey')} as tipocomprobante,
  {_NUMBER.format(k='o_orderkey')} as numerocomprobante,
  cast(case o_orderkey % 13 when 0 then 17 when 1 then 18 when 2 then 19 when 3 then 109
       when 4 then 17 when 5 then 1 when 6 then 6 when 7 then 7 when 8 then 8 when 9 then 8888
       when 10 then 8888 when 11 then 2222 else 99 end as bigint) as nropuntodeventa,
  day as fechacomprobante,
  concat(lpad(cast(o_orderkey % 24 as string), 2, '0'), ':',
         lpad(cast(o_orderkey % 60 as string), 2, '0'), ':00') as hora,
  cast(o_custkey as string) as codigocliente,
  concat('Client ', cast(o_custkey as string)) as razonsocial,
  cast(o_orderkey % 5 as double) as descuentoporcentaje,
  case when o_orderkey % 37 = 0 then 1 when o_orderkey % 47 = 0 then null else 0 end as anulada
from (
  select o_orderkey, o_custkey, cast(o_orderdate as date) as day from orders
  union all
  select o_orderkey, o_custkey, cast(cast(o_orderdate as date) + interval '40' day as date) as day
  from orders where o_orderkey % 59 = 0 and o_orderdate < date '1998-01-01'
) as o""",
    "src_body": f"""
select {_DB.format(k='l_orderkey')} as db,
  {_TYPE.format(k='l_orderkey')} as tipocomprobante,
  {_NUMBER.format(k='l_orderkey')} as numerocomprobante,
  cast(l_partkey as string) as codigoarticulo,
  concat('P', cast(l_partkey as string)) as codigoparticular,
  concat('Voucher text ', cast(l_partkey as string)) as descripcion,
  l_quantity + cast(l_orderkey % 7 as double) / 1e5 as cantidad, l_extendedprice as preciounitario,
  l_extendedprice + cast(l_partkey % 1000 as double) / 1e8 as preciototal,
  l_tax + cast(l_suppkey % 10 as double) / 1e6 as costoventa, l_discount as descuento,
  lpad(cast(l_linenumber % 4 as string), 3, '0') as codigodeposito
from lineitem""",
    "src_clients": """
select cast(c_custkey as string) as codigocliente,
  concat('CP-', cast(c_custkey as string)) as codigoparticular,
  case when c_custkey % 50 = 3 then 'X-MISSING'
       when c_custkey % 10 = 3 then cast(c_custkey - 1 as string)
       else '' end as cuenta_principal_codigo,
  c_name as razonsocial,
  cast(c_nationkey as string) as vendedor,
  c_mktsegment as zona,
  case when c_custkey % 97 = 0 then concat('(1.2.3) M-', cast(c_custkey as string))
       when c_custkey % 3 <> 1 then concat('(', cast(c_custkey % 40 as string), case when c_custkey % 5 = 0 then '.0512345678' else '.50' end,
         ') M-', cast(c_custkey as string))
       else c_mktsegment end as barrio,
  c_custkey % 3 <> 1 as gm, c_custkey % 7 = 0 as ag,
  c_custkey % 10 = 3 as es_excel, false as es_agro, false as es_plan_gomeria,
  cast(c_custkey % 2 as int) as contrareembolso, cast(0 as int) as contradeposito,
  c_acctbal as latitude, cast(null as double) as longitude
from customer""",
    "src_sellers": """
select cast(n_nationkey as string) as codigovendedor, concat(n_name, '  ') as razonsocialvend,
  case when n_nationkey % 5 = 0 then 0 else 1 end as activo
from nation""",
    "src_articles": """
select cast(p_partkey as string) as codigo_articulo,
  concat('AP-', cast(p_partkey as string)) as codigo_particular,
  concat(' ', p_name, ' ') as descripcion,
  cast(p_size as string) as codigo_rubro,
  case when p_partkey % 41 = 0 then '' when p_partkey % 43 = 0 then 'n/a'
       else replace(p_brand, 'Brand#', '') end as codigo_marca,
  concat(p_type, ' ') as descripcion_marca
from part where p_partkey % 29 <> 0""",
    "src_rubros": """
select distinct cast(p_size as string) as codigorubro,
  case when p_size = 1 then '-1' when p_size = 2 then '377' when p_size = 3 then 'none'
       else cast(p_size % 10 as string) end as codigosuperrubro
from part""",
    "src_units": """
select distinct cast(p_size % 10 as string) as codigosuperrubro,
  concat('Super ', cast(p_size % 10 as string)) as descripcion,
  cast(p_size % 10 as double) as unidades
from part where p_size % 10 <> 7""",
    "src_bridge": """
select distinct cast(replace(p_brand, 'Brand#', '') as int) as id, p_brand as marca_id,
  concat('L', replace(p_brand, 'Brand#', '')) as linea_id
from part""",
    "src_brands": """
select distinct p_brand as marca_id, concat(' ', p_brand) as marca from part""",
    "src_lines": """
select distinct concat('L', replace(p_brand, 'Brand#', '')) as linea_id,
  concat('Line ', replace(p_brand, 'Brand#', ''), ' ') as linea
from part where p_brand <> 'Brand#3'""",
    "src_catalogue": """
select cast(p_partkey as string) as codigoarticulo,
  case when p_partkey % 31 = 0 then 0 else 1 end as activo
from part""",
    "src_supplied": """
select concat('S', cast(p_partkey as string)) as codigo, cast(p_partkey as string) as codigoarticulo,
  p_retailprice as precio
from part
union all
select concat('T', cast(p_partkey as string)) as codigo, cast(p_partkey as string) as codigoarticulo,
  p_retailprice + 1.5 as precio
from part where p_partkey % 4 = 0""",
    "src_changes": """
select concat('S', cast(l_partkey as string)) as codigoarticuloproveedor,
  l_shipdate as fechamodificacion, l_extendedprice + cast(l_orderkey % 100 as double) / 1e7 as precio
from lineitem where not (l_partkey % 4 = 0 and l_linenumber = 2)
union all
select concat('T', cast(l_partkey as string)) as codigoarticuloproveedor,
  l_shipdate as fechamodificacion, l_extendedprice + 0.125 as precio
from lineitem where l_partkey % 4 = 0 and l_linenumber in (2, 4)""",
}

BASE = {
    "src_header": "orders",
    "src_body": "lineitem",
    "src_clients": "customer",
    "src_sellers": "nation",
    "src_changes": "lineitem",
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source-side table; each derives from a single supplied table (``part`` if not listed)."""
    base = BASE.get(name, "part")
    # Under a name of its own, gone again once the plan is made: the caller's views are left alone.
    view = f"{base}_{uuid.uuid4().hex}"
    table(spark, sf_dir, base).createOrReplaceTempView(view)
    try:
        return spark.sql(re.sub(rf"\b(from|join) {base}\b", rf"\1 {view}", SOURCE_SQL[name]))
    finally:
        spark.catalog.dropTempView(view)


# All four sources in one pass: the tag joins the voucher key and both constants are columns.
ALL_SOURCES_KEY = ("db", *VOUCHER_KEY)


def raw_sales(spark: SparkSession, sf_dir: str, window=None, by_whole=False) -> DataFrame:
    header, body = (source(spark, sf_dir, n) for n in ("src_header", "src_body"))
    return extract_sales(header, body, window=window, rules=RULES, keys=ALL_SOURCES_KEY, by_whole=by_whole)


def raw_prices(spark: SparkSession, sf_dir: str, window=None) -> DataFrame:
    parts = [source(spark, sf_dir, n) for n in ("src_catalogue", "src_supplied", "src_changes")]
    return extract_prices(*parts, window=window)


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = source(spark, sf_dir, "src_clients")
    absent = [f for f in RAW_CLIENTS.fields if f.name not in clients.columns]
    filled = clients.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return conform(filled, RAW_CLIENTS)


def raw_tables(spark: SparkSession, sf_dir: str, by_whole: bool = False) -> dict[str, DataFrame]:
    def src(*names: str) -> list[DataFrame]:
        return [source(spark, sf_dir, n) for n in names]

    tables = {
        "raw_sales": raw_sales(spark, sf_dir, by_whole=by_whole),
        "raw_clients": raw_clients(spark, sf_dir),
        "raw_articulos": conform(*src("src_articles"), RAW_ARTICULOS),
        "raw_sellers": extract_sellers(*src("src_sellers")),
        "raw_price_history": raw_prices(spark, sf_dir),
        "raw_rubros": extract_rubros(*src("src_rubros", "src_units")),
        "raw_marcas_lineas": extract_brand_lines(*src("src_bridge", "src_brands", "src_lines")),
    }
    return {name: conform(df, RAW_TABLES[name]) for name, df in tables.items()}


def staged_tables(spark: SparkSession, sf_dir: str, by_voucher: bool = False) -> Staged:
    return staged(raw_tables(spark, sf_dir, by_voucher))
