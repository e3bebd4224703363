"""Staging: raw tables renamed, trimmed and typed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tallysheet.functions import to_amount, to_whole
from tallysheet.schemas import as_type


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns (old to new); the others and the order stay."""
    return df.withColumnsRenamed(mapping)


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; float to whole number rounds half to even."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def cast(name: str, dtype: str) -> Column:
        floating = kinds[name] in ("float", "double")
        if floating and dtype in ("bigint", "int", "long", "integer"):
            return F.rint(F.col(name)).cast(dtype)
        return F.col(name).cast(dtype)

    return df.withColumns({n: cast(n, t) for n, t in types.items()})


def stg_sales(raw: DataFrame) -> DataFrame:
    return raw.select(
        "tipo_comprobante",
        to_whole("numero_comprobante").alias("numero_comprobante"),
        F.col("nro_punto_venta").cast("int").alias("nro_punto_venta"),
        F.col("db").alias("fuente"),
        "tipo_consumo",
        as_type(raw, "fecha_comprobante", TimestampNTZType()),
        "codigo_cliente",
        "razon_social_cliente",
        to_amount("descuento_comprobante").alias("descuento_comprobante"),
        "codigo_articulo",
        "codigo_particular_articulo",
        "descripcion_articulo",
        to_amount("cantidad_articulo").alias("cantidad_articulo"),
        to_amount("precio_unitario_articulo").alias("precio_unitario_articulo"),
        to_amount("precio_total_articulo").alias("precio_total_articulo"),
        to_amount("costo_venta_articulo").alias("costo_venta_articulo"),
        to_amount("descuento_articulo").alias("descuento_articulo"),
        "codigo_deposito_articulo",
    )


# Raw name, staged name; the staged order of the client table.
_CLIENT_NAMES = {
    "codigocliente": "codigo_cliente",
    "codigoparticular": "codigo_particular",
    "razonsocial": "razon_social",
    "vendedor": "codigo_vendedor",
    "zona": "codigo_zona",
    "gm": "es_gm",
    "ag": "es_ag",
}
_CLIENT_FLAGS = (
    "es_gm", "es_ag", "es_excel", "es_agro", "es_plan_gomeria", "contrareembolso", "contradeposito",
)


def stg_clients(raw: DataFrame) -> DataFrame:
    return cast_all(rename(raw, _CLIENT_NAMES), dict.fromkeys(_CLIENT_FLAGS, "boolean"))


def stg_articulos(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"descripcion": F.trim("descripcion"), "descripcion_marca": F.trim("descripcion_marca")}
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("codigovendedor").alias("codigo_vendedor"), F.trim("nombre").alias("nombre_vendedor")
    )


def stg_rubros(raw: DataFrame) -> DataFrame:
    return rename(raw, {"unidades_super_rubro": "unidades_min_rubro"})


def stg_marcas_lineas(raw: DataFrame) -> DataFrame:
    return rename(raw, {"codigo_marca_int": "codigo_marca"}).withColumns(
        {"marca": F.trim("marca"), "linea": F.trim("linea")}
    )


def stg_price_history(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("codigoarticulo").alias("codigo_articulo"),
        to_amount("precioactual").alias("precio_actual_proveedor"),
        F.col("fechamodificacion").cast("timestamp_ntz").alias("fecha_modificacion"),
        to_amount("precio").alias("precio_cambio"),
    )


# Staged model, the raw table it reads, and its function.
STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_sales": ("raw_sales", stg_sales),
    "stg_clients": ("raw_clients", stg_clients),
    "stg_articulos": ("raw_articulos", stg_articulos),
    "stg_sellers": ("raw_sellers", stg_sellers),
    "stg_rubros": ("raw_rubros", stg_rubros),
    "stg_marcas_lineas": ("raw_marcas_lineas", stg_marcas_lineas),
    "stg_price_history": ("raw_price_history", stg_price_history),
}
