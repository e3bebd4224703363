"""Supplier price at the time of the sale."""

from __future__ import annotations

from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, Rules
from tallysheet.operators.asof import asof_join, asof_join_arrays
from tallysheet.operators.latest import latest_by

# A price belongs to a voucher's article, not to a line: all lines of the key share the price
# found for the earliest time among them. The most selective part leads, as joins sort by it.
PRICE_KEY = ("numero_comprobante", "codigo_articulo", "tipo_comprobante", "fuente")
# Laid out in the order in which the extraction joins headers and lines.
VOUCHER = ("numero_comprobante", "fuente", "tipo_comprobante")


def current_prices(history: DataFrame) -> DataFrame:
    """Catalogue price of each article as of its latest change; the lower one on a tie."""
    return latest_by(
        history, ["codigo_articulo"], "fecha_modificacion", ["precio_actual_proveedor"]
    ).drop("fecha_modificacion")


def price_at_sale(
    sales: DataFrame,
    history: DataFrame,
    rules: Rules = DEFAULT_RULES,
    direction: str = "forward",
    arrays: bool = False,
    parts: int | None = None,
    by_voucher: bool = False,
) -> DataFrame:
    """Add the price in force at the sale, the time of the change it came from, and a found flag.

    The first change at or after the sale counts (``direction='backward'``: the last at or before
    it); without one, or when that change has no price, the current catalogue price does.

    ``arrays`` chooses the as-of join without a sort, ``parts`` says that the history is stored in so many buckets
    of the article and is to stay where it is. Everything is worked out on a narrow table of one row per price key, fallback included. The
    sales themselves are shuffled once, for the join that brings the result back. ``by_voucher`` says that the sales lie together
    by voucher (``VOUCHER``): then they stay there and the result comes to them. A voucher's lines are one task then.
    """
    # Without an article there is neither history nor fallback. Leaving these rows out here gives
    # all uses of the two inputs the same filter, so that their shuffles are shared.
    has_article = F.col("codigo_articulo").isNotNull()
    history = history.where(has_article)
    firsts = (
        sales.where(has_article)
        .groupBy(*PRICE_KEY)
        .agg(F.min("fecha_comprobante").alias("_first_sale"))
    )
    form = asof_join_arrays if arrays else partial(asof_join, parts=parts)
    join = partial(form, slice_of=lambda t: F.date_trunc(rules.price_slice, t))
    matched = join(
        firsts,
        history,
        by=["codigo_articulo"],
        left_ts="_first_sale",
        right_ts="fecha_modificacion",
        values=["precio_cambio"],
        direction=direction,
        matched_ts="precio_vigente_desde",
    )
    if by_voucher:
        return _to_vouchers(sales, matched, current_prices(history))
    # One row per article, from the whole history: no size is known beforehand, so adaptive execution
    # picks the join.
    priced = matched.join(current_prices(history), "codigo_articulo", "left")
    # A key with a null part has no historical price, only the fallback.
    whole = reduce(and_, [F.col(c).isNotNull() for c in PRICE_KEY])
    price = F.coalesce(F.when(whole, F.col("precio_cambio")), F.col("precio_actual_proveedor"))
    priced = priced.select(
        *[F.col(c).alias(f"_k_{c}") for c in PRICE_KEY],
        price.alias("precio_proveedor_vigente"),
        F.when(whole, F.col("precio_vigente_desde")).alias("precio_vigente_desde"),
    )
    same = reduce(and_, [sales[c].eqNullSafe(F.col(f"_k_{c}")) for c in PRICE_KEY])
    return sales.join(priced, same, "left").select(
        *[sales[c] for c in sales.columns],
        "precio_proveedor_vigente",
        "precio_vigente_desde",
        F.col("precio_proveedor_vigente").isNotNull().alias("tiene_precio_historico"),
    )


def _to_vouchers(sales: DataFrame, matched: DataFrame, current: DataFrame) -> DataFrame:
    """Bring the price of each key in ``matched`` to sales that lie together by voucher, without moving these.

    A join would: it has to have all of the price key together. A window only needs the rows of a key in one place, which
    they are by voucher. In it the price comes first and the lines of the key behind it."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in PRICE_KEY])
    # Only keys without a price go to the current ones. The test asks for columns of both sides of the as-of join, so that
    # neither is filtered ahead of it and both answers read the same shuffles.
    price, since = F.when(whole, F.col("precio_cambio")), F.when(whole, F.col("precio_vigente_desde")).alias("_since")
    priced = matched.where(price.isNotNull()).select(*PRICE_KEY, price.alias("_price"), since)
    wanting = matched.where(price.isNull()).join(current, "codigo_articulo", "left").select(*PRICE_KEY, F.col("precio_actual_proveedor").alias("_price"), since)
    priced = priced.unionByName(wanting).repartition(*VOUCHER)
    none = {f.name: F.lit(None).cast(f.dataType) for f in [*sales.schema.fields, *priced.schema.fields]}
    lines = sales.select("*", *[none[c].alias(c) for c in ("_price", "_since")], F.lit(1).alias("_line"))
    prices = priced.select(*[F.col(c) if c in PRICE_KEY else none[c].alias(c) for c in sales.columns], "_price", "_since", F.lit(0).alias("_line"))
    key = Window.partitionBy(*PRICE_KEY).orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.unionByName(prices).withColumns({c: F.first(c).over(key) for c in ("_price", "_since")}).where(F.col("_line") == 1)
    return rows.select(
        *sales.columns,
        F.col("_price").alias("precio_proveedor_vigente"),
        F.col("_since").alias("precio_vigente_desde"),
        F.col("_price").isNotNull().alias("tiene_precio_historico"),
    )
