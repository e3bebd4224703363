"""Landed JSON:API pages of the client and product services to raw-layer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tallysheet.schemas import (
    CLIENT_PAGE,
    CONDITIONS,
    DISCOUNTS,
    DYNAMIC_FIELDS,
    PRODUCT_PAGE,
    RAW_ARTICULOS,
    RAW_CLIENTS,
    SUB_BRANCHES,
    conform,
)
from tallysheet.scratch import scratch_dir


class EmptySource(ValueError):
    """A source returned nothing; loading it would wipe the stored table."""


class IncompletePages(ValueError):
    """The landed page set has a gap or stops early."""


# The number in the name of a page's file, and the one in the link to its successor.
FILE_NUMBER = r"(\d+)\D*$"
LINK_NUMBER = r"page[^=&]*=(\d+)"


def read_api_pages(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = True,
    file_number: str = FILE_NUMBER,
    link_number: str = LINK_NUMBER,
) -> DataFrame:
    """Landed pages, one row per page, parsed once and kept as a table in the shared folder.
    ``multi_line=False`` reads one page per text line.

    A body holds ``data`` and ``links``. The page number is not part of it, so it comes from the name
    of the file (one page to a file), else from the link: the page that names n + 1 as its successor
    is n, and a page without successor follows the last one named. A ``page`` in the body goes first.
    """
    read = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    named = F.lit(None).cast("int")
    if multi_line:
        named = F.regexp_extract("_metadata.file_name", file_number, 1).try_cast("int")
    linked = F.regexp_extract(F.coalesce("links.next", F.lit("")), link_number, 1).try_cast("int")
    number = F.coalesce("page", named, linked - 1)
    landed = scratch_dir(spark, "pages")
    read.withColumns({"page": number, "_successor": linked}).write.parquet(landed)
    pages = spark.read.parquet(landed)
    last = F.broadcast(pages.agg(F.coalesce(F.max("_successor"), F.lit(1)).alias("_last")))
    return pages.crossJoin(last).select(F.coalesce("page", "_last").alias("page"), "data", "links")


def resources(pages: DataFrame) -> DataFrame:
    """One row per resource; a page without data gives none."""
    return pages.select(F.explode("data").alias("r")).select("r.id", "r.attributes")


def page_report(pages: DataFrame) -> DataFrame:
    """One row: pages seen, highest number, repeats, open ends, empty pages, all as counts."""
    has_next = F.coalesce(F.col("links.next"), F.lit("")) != ""
    by_page = pages.groupBy("page").agg(
        F.count(F.lit(1)).alias("copies"),
        F.bool_or(has_next).alias("has_next"),
        F.min(F.coalesce(F.size("data"), F.lit(0))).alias("items"),
    )
    return by_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.max("page"), F.lit(0)).alias("last_page"),
        F.count_if(F.col("copies") > 1).alias("repeated"),
        F.count_if(~F.col("has_next")).alias("ends"),
        F.coalesce(F.max_by("has_next", "page"), F.lit(False)).alias("last_has_next"),
        F.coalesce(F.max_by("items", "page"), F.lit(0)).alias("last_items"),
        F.count_if(F.col("items") == 0).alias("empty"),
    )


def check_pages(pages: DataFrame) -> None:
    """Fail unless the pages run 1..n without gap or repeat and only page n ends the chain.

    An empty page ends the chain too, whether or not it names a successor, so it must be the last.
    """
    r = page_report(pages).first()
    contiguous = r.pages == r.last_page and r.repeated == 0
    ended_once = r.ends == (0 if r.last_has_next else 1)
    closed = not r.last_has_next or r.last_items == 0
    empty_inside = r.empty > (1 if r.last_items == 0 else 0)
    if not (contiguous and ended_once and closed) or (empty_inside and r.pages):
        raise IncompletePages(f"landed pages are incomplete: {r.asDict()}")


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptySource(f"{what} returned no rows; the stored table is kept")
    return df


def _empty(dtype: DataType) -> Column:
    """An empty object or list of the given type."""
    return F.from_json(F.lit("[]" if isinstance(dtype, ArrayType) else "{}"), dtype)


def map_clients(clients: DataFrame) -> DataFrame:
    """Client resources to raw rows; absent fields take the defaults of their type."""
    a = F.col("attributes")

    def text(path: str) -> Column:
        return F.coalesce(a[path], F.lit(""))

    def flag(path: str) -> Column:
        return F.coalesce(a[path], F.lit(False))

    def number(path: str) -> Column:
        return F.coalesce(a[path], F.lit(0))

    main = a["cuentaPrincipal"]
    return conform(
        clients.select(
            text("cdCliente").alias("codigocliente"),
            text("codigoParticular").alias("codigoparticular"),
            F.coalesce(main["codigoCliente"], F.lit("")).alias("cuenta_principal_codigo"),
            F.coalesce(main["codigoParticular"], F.lit("")).alias("cuenta_principal_particular"),
            text("razonSocial").alias("razonsocial"),
            text("nombreFantasia").alias("nombre_fantasia"),
            text("vendedor").alias("vendedor"),
            text("zona").alias("zona"),
            text("barrio").alias("barrio"),
            text("localidad").alias("localidad"),
            text("domicilio").alias("domicilio"),
            text("telefono").alias("telefono"),
            text("comentario").alias("comentario"),
            flag("gm").alias("gm"),
            flag("ag").alias("ag"),
            flag("esExcel").alias("es_excel"),
            flag("esAgro").alias("es_agro"),
            flag("esPlanGomeria").alias("es_plan_gomeria"),
            number("contrareembolso").alias("contrareembolso"),
            number("contradeposito").alias("contradeposito"),
            a["coordinates"]["latitude"].alias("latitude"),
            a["coordinates"]["longitude"].alias("longitude"),
            F.coalesce(a["conditions"], _empty(CONDITIONS)).alias("conditions"),
            F.coalesce(a["discounts"], _empty(DISCOUNTS)).alias("discounts"),
            F.coalesce(a["camposDinamicos"], _empty(DYNAMIC_FIELDS)).alias("campos_dinamicos"),
            F.coalesce(a["sucursales"], _empty(SUB_BRANCHES)).alias("sucursales"),
        ),
        RAW_CLIENTS,
    )


def map_articles(products: DataFrame) -> DataFrame:
    """Product resources to raw rows; absent fields are empty text."""
    a = F.col("attributes")

    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    return conform(
        products.select(
            text(F.col("id")).alias("codigo_articulo"),
            text(a["codigoParticular"]).alias("codigo_particular"),
            text(a["descripcion"]).alias("descripcion"),
            text(a["codigoRubro"]).alias("codigo_rubro"),
            text(a["codigoMarca"]).alias("codigo_marca"),
            text(a["marca"]["descripcion"]).alias("descripcion_marca"),
        ),
        RAW_ARTICULOS,
    )


def read_clients(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed client pages to raw rows, after the completeness and zero-row checks."""
    pages = read_api_pages(spark, path, CLIENT_PAGE, multi_line)
    check_pages(pages)
    return map_clients(require_nonempty(resources(pages), "client service"))


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed product pages to raw rows, after the completeness and zero-row checks."""
    pages = read_api_pages(spark, path, PRODUCT_PAGE, multi_line)
    check_pages(pages)
    return map_articles(require_nonempty(resources(pages), "product service"))
