"""One ``StructType`` per table. Readers always get a schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STR, DBL, INT, LONG, BOOL, TS = (
    StringType(), DoubleType(), IntegerType(), LongType(), BooleanType(), TimestampNTZType(),
)

# Staged amounts and quantities, and the discount percentage. Source amounts are doubles, of which
# eight fraction digits are kept; a number beyond the integer digits stops the job.
AMOUNT = DecimalType(22, 8)
PERCENT = DecimalType(20, 10)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# Fixed values from here on: table columns and document fields must be those of the sources.

# --- nested documents of the client and product services -------------------------------

CONDITIONS = _struct(condicion=STR, dias=INT, limiteMonto=DBL, monto=DBL, plan=INT)
DISCOUNTS = _struct(
    byBonus=DBL,
    byCondition=ArrayType(_struct(code=STR, description=STR, value=DBL, other=STR)),
    byBrand=ArrayType(_struct(code=STR, description=STR, value=DBL)),
)
COORDINATES = _struct(latitude=DBL, longitude=DBL)
DYNAMIC_FIELDS = ArrayType(_struct(codigo=INT, descripcion=STR, nombre=STR, valor=STR))
SUB_BRANCHES = ArrayType(
    _struct(id=STR, localidad=STR, cp=STR, zona=STR, direccion=STR, latitude=DBL, longitude=DBL)
)
LINKS = _struct(next=STR)

CLIENT_ATTRIBUTES = _struct(
    cdCliente=STR, codigoParticular=STR, razonSocial=STR, nombreFantasia=STR, vendedor=STR,
    zona=STR, barrio=STR, localidad=STR, domicilio=STR, telefono=STR, comentario=STR,
    gm=BOOL, ag=BOOL, esExcel=BOOL, esAgro=BOOL, esPlanGomeria=BOOL,
    contrareembolso=INT, contradeposito=INT,
    cuentaPrincipal=_struct(codigoCliente=STR, codigoParticular=STR),
    conditions=CONDITIONS, discounts=DISCOUNTS, coordinates=COORDINATES,
    camposDinamicos=DYNAMIC_FIELDS, sucursales=SUB_BRANCHES,
)
PRODUCT_ATTRIBUTES = _struct(
    codigoParticular=STR, descripcion=STR, codigoRubro=STR, codigoMarca=STR,
    marca=_struct(descripcion=STR),
)


def page_schema(attributes: StructType) -> StructType:
    """A landed API page: its number, its resources, and the link to the next page."""
    return _struct(
        page=INT, data=ArrayType(_struct(id=STR, attributes=attributes)), links=LINKS
    )


CLIENT_PAGE = page_schema(CLIENT_ATTRIBUTES)
PRODUCT_PAGE = page_schema(PRODUCT_ATTRIBUTES)

# --- raw layer ---------------------------------------------------------------------------

RAW_SALES = _struct(
    tipo_comprobante=STR, numero_comprobante=DBL, nro_punto_venta=LONG, db=STR, tipo_consumo=STR,
    fecha_comprobante=TS, codigo_cliente=STR, razon_social_cliente=STR, descuento_comprobante=DBL,
    codigo_articulo=STR, codigo_particular_articulo=STR, descripcion_articulo=STR,
    cantidad_articulo=DBL, precio_unitario_articulo=DBL, precio_total_articulo=DBL,
    costo_venta_articulo=DBL, descuento_articulo=DBL, codigo_deposito_articulo=STR,
)
RAW_CLIENTS = _struct(
    codigocliente=STR, codigoparticular=STR, cuenta_principal_codigo=STR,
    cuenta_principal_particular=STR, razonsocial=STR, nombre_fantasia=STR, vendedor=STR, zona=STR,
    barrio=STR, localidad=STR, domicilio=STR, telefono=STR, comentario=STR,
    gm=BOOL, ag=BOOL, es_excel=BOOL, es_agro=BOOL, es_plan_gomeria=BOOL,
    contrareembolso=INT, contradeposito=INT, latitude=DBL, longitude=DBL,
    conditions=CONDITIONS, discounts=DISCOUNTS, campos_dinamicos=DYNAMIC_FIELDS,
    sucursales=SUB_BRANCHES,
)
RAW_ARTICULOS = _struct(
    codigo_articulo=STR, codigo_particular=STR, descripcion=STR, codigo_rubro=STR,
    codigo_marca=STR, descripcion_marca=STR,
)
RAW_SELLERS = _struct(codigovendedor=STR, nombre=STR)
RAW_PRICE_HISTORY = _struct(codigoarticulo=STR, precioactual=DBL, fechamodificacion=TS, precio=DBL)
RAW_RUBROS = _struct(
    codigo_rubro=STR, codigo_super_rubro=STR, descripcion_super_rubro=STR, unidades_super_rubro=DBL
)
RAW_MARCAS_LINEAS = _struct(
    codigo_marca_int=INT, marca_id=STR, marca=STR, linea_id=STR, linea=STR
)
LOAD_AUDIT = _struct(
    asset=STR, load_month=STR, source=STR, row_count=LONG, loaded_at=TS
)

RAW_TABLES: dict[str, StructType] = {
    "raw_sales": RAW_SALES,
    "raw_clients": RAW_CLIENTS,
    "raw_articulos": RAW_ARTICULOS,
    "raw_sellers": RAW_SELLERS,
    "raw_price_history": RAW_PRICE_HISTORY,
    "raw_rubros": RAW_RUBROS,
    "raw_marcas_lineas": RAW_MARCAS_LINEAS,
}

# Partition columns of the monthly tables. ``db`` is data as well, so it is listed in both.
MONTH = "load_month"
PARTITIONS: dict[str, tuple[str, ...]] = {
    "raw_sales": (MONTH, "db"),
    "raw_price_history": (MONTH,),
}

# Sort order inside each written file, so that min/max statistics prune row groups.
SORTED_BY: dict[str, tuple[str, ...]] = {
    "raw_sales": ("codigo_articulo", "fecha_comprobante"),
    "raw_price_history": ("codigoarticulo", "fechamodificacion"),
    "fct_sales": ("account_code", "article_code"),
}

# --- mart ----------------------------------------------------------------------------------

# The columns of the fact table, in order.
FCT_SALES_COLUMNS = (
    "voucher_type", "voucher_number", "source", "point_of_sale", "deposit_code", "branch",
    "consumption_type",
    "invoice_datetime", "year_month",
    "client_code", "account_code", "account_name", "client_particular_code", "vendor_code",
    "vendor_name", "zone_code", "is_secondary_account",
    "article_code", "article_particular_code", "article_description", "rubro_code",
    "rubro_description", "min_units_rubro", "brand_code", "brand_id", "brand_name", "line_id",
    "line_name",
    "quantity", "sale_price", "provider_price", "provider_price_at_sale", "final_price",
    "is_gm_sale", "gm_discount_pct", "gm_discount_amount",
    "gm_quantity", "gm_amount", "ds_quantity", "ds_amount", "ppal_quantity", "ppal_amount",
    "is_valid_article", "price_method",
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, cast to its types."""
    return df.select([as_type(df, f.name, f.dataType) for f in schema.fields])


def as_type(df: DataFrame, name: str, dtype: DataType) -> Column:
    """A column in a type. One that has it stays as it is: Spark drops a column's second name that is like its first in
    some uses of a table and keeps it in others, and then these do not share their shuffles."""
    return F.col(name) if df.schema[name].dataType == dtype else F.col(name).cast(dtype).alias(name)
