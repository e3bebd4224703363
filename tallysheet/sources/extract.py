"""Extraction: source-side tables (lower-case column names) to raw-layer rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, Rules, SalesSource
from tallysheet.functions import compose_timestamp, in_window, to_whole
from tallysheet.operators.keyfilter import may_match
from tallysheet.operators.lookup import lookup
from tallysheet.schemas import RAW_PRICE_HISTORY, RAW_SALES, conform

VOUCHER_KEY = ("tipocomprobante", "numerocomprobante")


@dataclass(frozen=True)
class Window:
    """A load window. ``closed='left'`` excludes the end instant, ``'both'`` keeps it."""

    start: datetime | str
    end: datetime | str
    closed: str = "left"

    def covers(self, ts: Column | str) -> Column:
        return in_window(ts, self.start, self.end, self.closed)

    def covers_day(self, day: Column | str) -> Column:
        """Coarser test on the bare date column; unlike ``covers`` it reaches the scan."""
        day = F.col(day) if isinstance(day, str) else day
        first, last = (F.to_date(F.lit(str(v)[:10])) for v in (self.start, self.end))
        # The column may hold a time of day: the last day ends where the next one begins.
        return (day >= first) & (day < F.date_add(last, 1))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _whole_or_nearest(number: Column) -> Column:
    """``to_whole``; where it does not fit what a cast without errors gives, so that a line without header stops no job."""
    beyond = F.when(F.isnan(number), F.lit(0)).when(number > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63)))
    return F.when(F.abs(number) < float(1 << 63), to_whole(number)).otherwise(beyond)


def extract_sales(
    header: DataFrame,
    body: DataFrame,
    source: SalesSource | None = None,
    window: Window | None = None,
    rules: Rules = DEFAULT_RULES,
    keys: Sequence[str] = VOUCHER_KEY,
    by_whole: bool = False,
) -> DataFrame:
    """Voucher lines of one source: header joined to body, filtered and renamed.

    With ``source`` the tag and type are stamped as constants; without it they are columns of the
    header, which is how several sources are extracted in one join (add ``db`` to ``keys``).
    The row filters sit on the bare columns of each side, ahead of the shuffle.

    With ``by_whole`` they meet by the whole number, as staged, and the numbers are compared behind the shuffle: what follows
    by staged voucher (see ``price_at_sale``) finds them together. A header whose number is out of range stops the job then, as
    staging does.
    """
    heads = header.where(
        F.col("tipocomprobante").isin(*rules.voucher_types) & (F.col("anulada") == 0)
    )
    if source is not None:
        heads = heads.withColumns(
            {"db": F.lit(source.db), "tipo_consumo": F.lit(source.tipo_consumo)}
        )
    heads = heads.withColumn("fecha_comprobante", compose_timestamp("fechacomprobante", "hora"))
    if window is not None:
        heads = heads.where(window.covers_day("fechacomprobante") & window.covers("fecha_comprobante"))
    # The test for null drops nothing more. It is said so that uses that ask for an article, and those that do not, read
    # the lines by the same filter and share their shuffle.
    article = F.col("codigoarticulo")
    lines = body.where(article.isNotNull() & ~article.isin(*rules.excluded_articles))
    if window is not None:
        # Bodies carry no date: most lines of other windows go before the shuffle.
        lines = may_match(lines, heads, keys, range_of=VOUCHER_KEY[1], words=rules.key_filter_words)
    # The number leads, as a join sorts by its keys in turn: tags and types are a few texts, alike for most rows.
    keys = sorted(keys, key=lambda c: c != VOUCHER_KEY[1])
    if by_whole:
        lines = lines.withColumnsRenamed({k: f"_{k}" for k in keys})
        number, theirs = F.col(keys[0]), F.col(f"_{keys[0]}")
        # Two comparisons, as Spark would shuffle by an equality.
        same = [to_whole(number) == _whole_or_nearest(theirs), *[F.col(k) == F.col(f"_{k}") for k in keys[1:]], number <= theirs, number >= theirs]
        joined = heads.join(lines, reduce(and_, same), "inner")
    else:
        joined = heads.join(lines, keys, "inner")
    return conform(
        joined.select(
            F.col("tipocomprobante").alias("tipo_comprobante"),
            F.col("numerocomprobante").alias("numero_comprobante"),
            F.col("nropuntodeventa").alias("nro_punto_venta"),
            "db",
            "tipo_consumo",
            "fecha_comprobante",
            F.col("codigocliente").alias("codigo_cliente"),
            F.col("razonsocial").alias("razon_social_cliente"),
            F.col("descuentoporcentaje").alias("descuento_comprobante"),
            F.col("codigoarticulo").alias("codigo_articulo"),
            F.col("codigoparticular").alias("codigo_particular_articulo"),
            F.col("descripcion").alias("descripcion_articulo"),
            F.col("cantidad").alias("cantidad_articulo"),
            F.col("preciounitario").alias("precio_unitario_articulo"),
            F.col("preciototal").alias("precio_total_articulo"),
            F.col("costoventa").alias("costo_venta_articulo"),
            F.col("descuento").alias("descuento_articulo"),
            F.col("codigodeposito").alias("codigo_deposito_articulo"),
        ),
        RAW_SALES,
    )


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources as one table (duplicates kept)."""
    return reduce(DataFrame.unionByName, parts)


def extract_prices(
    articles: DataFrame,
    supplier_articles: DataFrame,
    changes: DataFrame,
    window: Window | None = None,
    newest_first: bool = False,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Distinct price changes of active articles, with the supplier's current price beside each.

    ``newest_first`` sorts the result for display; leave it off ahead of a write.
    """
    changes = lower_columns(changes)
    if window is not None:
        changes = changes.where(window.covers("fechamodificacion"))
    changes = changes.select(
        F.col("codigoarticuloproveedor").alias("codigo"), "fechamodificacion", "precio"
    )
    active = lower_columns(articles).where(F.col("activo") == 1).select("codigoarticulo")
    supplied = lower_columns(supplier_articles).select(
        "codigo", "codigoarticulo", F.col("precio").alias("precioactual")
    )
    # Both catalogue tables are joined with each other first, so the change log, which is the
    # large side, meets one lookup only.
    catalogue = supplied.join(active, "codigoarticulo")
    rows = lookup(changes, catalogue, ["codigo"], "inner", max_bytes=rules.broadcast_bytes)
    rows = conform(rows, RAW_PRICE_HISTORY).distinct()
    return rows.orderBy(F.desc_nulls_first("fechamodificacion")) if newest_first else rows


def extract_rubros(
    rubros: DataFrame, units: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Categories with the description and minimum units of their super-category."""
    units = units.select(
        "codigosuperrubro",
        F.col("descripcion").alias("descripcion_super_rubro"),
        F.col("unidades").alias("unidades_super_rubro"),
    )
    return rubros.join(units, "codigosuperrubro", "left").select(
        F.col("codigorubro").alias("codigo_rubro"),
        F.col("codigosuperrubro").alias("codigo_super_rubro"),
        F.coalesce("descripcion_super_rubro", F.lit(rules.no_super_rubro)).alias(
            "descripcion_super_rubro"
        ),
        F.coalesce("unidades_super_rubro", F.lit(0.0)).alias("unidades_super_rubro"),
    )


def extract_brand_lines(bridge: DataFrame, brands: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per brand and line pair; names are null when the pair points nowhere."""
    pairs = bridge.select(
        F.col("id").alias("codigo_marca_int"),
        F.col("marca_id").alias("_brand"),
        F.col("linea_id").alias("_line"),
    )
    return (
        pairs.join(brands.select("marca_id", "marca"), F.col("_brand") == F.col("marca_id"), "left")
        .join(lines.select("linea_id", "linea"), F.col("_line") == F.col("linea_id"), "left")
        .select("codigo_marca_int", "marca_id", "marca", "linea_id", "linea")
    )


def extract_sellers(sellers: DataFrame) -> DataFrame:
    """Active sellers only."""
    return sellers.where(F.col("activo") == 1).select(
        "codigovendedor", F.col("razonsocialvend").alias("nombre")
    )
