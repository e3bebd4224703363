from datetime import date, datetime

import pytest

from tallysheet.config import SALES_SOURCES
from tallysheet.plans.feeds import jdbc_feeds
from tallysheet.schemas import RAW_SALES
from tallysheet.sources.extract import (
    Window,
    extract_brand_lines,
    extract_prices,
    extract_rubros,
    extract_sales,
    extract_sellers,
    lower_columns,
)
from tallysheet.sources.jdbc import (
    body_query,
    firebird,
    header_query,
    jdbc_options,
    mysql,
    read_jdbc,
)
from tallysheet.sources.sales import read_all_sales, table_reader
from tests.conftest import rows

HEADER = (
    "tipocomprobante string, numerocomprobante double, nropuntodeventa bigint, fechacomprobante date,"
    " hora string, codigocliente string, razonsocial string, descuentoporcentaje double, anulada int"
)
BODY = (
    "tipocomprobante string, numerocomprobante double, codigoarticulo string, codigoparticular string,"
    " descripcion string, cantidad double, preciounitario double, preciototal double, costoventa double,"
    " descuento double, codigodeposito string"
)


def head(number, kind="FA", day=date(2024, 1, 10), time="10:00:00", voided=0):
    return (kind, float(number), 1, day, time, "C1", "Client", 0.0, voided)


def line(number, article, kind="FA"):
    return (kind, float(number), article, "P", "D", 1.0, 2.0, 2.0, 1.0, 0.0, "001")


def vouchers(spark, heads, lines):
    return spark.createDataFrame(heads, HEADER), spark.createDataFrame(lines, BODY)


def test_voided_types_and_excluded_articles(spark):
    heads = [head(1), head(2, voided=1), head(3, voided=None), head(4, kind="XX"), head(5, kind="RE")]
    lines = [
        line(1, "A"), line(1, "42537"), line(1, None), line(2, "A"), line(3, "A"),
        line(4, "A", "XX"), line(5, "B", "RE"), line(5, "B", "FA"),
    ]
    got = extract_sales(*vouchers(spark, heads, lines), SALES_SOURCES[0])
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_SALES.fields]
    assert rows(got, "numero_comprobante", "codigo_articulo", "db", "tipo_consumo") == [
        (1.0, "A", "DIMDS", "DS"),
        (5.0, "B", "DIMDS", "DS"),
    ]


def test_window_first_last_and_end_instant(spark):
    heads = [
        head(1, day=date(2024, 1, 1), time="00:00:00"),
        head(2, day=date(2024, 1, 31), time="23:59:59"),
        head(3, day=date(2024, 2, 1), time="00:00:00"),
        head(4, day=date(2024, 2, 1), time="00:00:01"),
        head(5, day=date(2023, 12, 31), time="23:59:59"),
    ]
    data = vouchers(spark, heads, [line(n, "A") for n in range(1, 6)])
    month = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    half = extract_sales(*data, SALES_SOURCES[0], Window(*month))
    both = extract_sales(*data, SALES_SOURCES[0], Window(*month, closed="both"))
    assert [r[0] for r in rows(half, "numero_comprobante")] == [1.0, 2.0]
    assert [r[0] for r in rows(both, "numero_comprobante")] == [1.0, 2.0, 3.0]


def test_reused_number_multiplies_lines(spark):
    heads = [head(1), head(1, day=date(2024, 1, 11))]
    got = extract_sales(*vouchers(spark, heads, [line(1, "A"), line(1, "B")]), SALES_SOURCES[0])
    assert got.count() == 4


def test_lines_that_meet_by_the_whole_number_are_the_same(spark):
    # Halves round to a neighbour that is a number too; lines out of range have no header.
    numbers = [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, -0.0, -0.5, 2.0**53]
    heads = [head(n) for n in [*numbers, 0.0]]
    lines = [line(n, a) for n in [*numbers, 7.0, float("nan"), float("inf"), -1e300] for a in "AB"]
    data = vouchers(spark, heads, lines)
    plain, whole = (extract_sales(*data, SALES_SOURCES[0], by_whole=b) for b in (False, True))
    assert rows(whole, "numero_comprobante", "codigo_articulo") == rows(plain, "numero_comprobante", "codigo_articulo")
    assert plain.count() == 22 and whole.schema == plain.schema


def test_four_sources_from_catalog_tables(spark):
    for i, s in enumerate(SALES_SOURCES):
        header, body = vouchers(spark, [head(i)], [line(i, "A")])
        header.toDF(*[c.upper() for c in header.columns]).createOrReplaceTempView(s.header)
        body.createOrReplaceTempView(s.body)
    got = read_all_sales(table_reader(spark))
    assert rows(got, "db", "numero_comprobante") == [
        ("DIMDS", 0.0), ("DIMPPAL", 1.0), ("DISDS", 2.0), ("DISPPAL", 3.0),
    ]


def test_prices_distinct_active_and_windowed(spark):
    articles = spark.createDataFrame([("A", 1), ("B", 0)], "CODIGOARTICULO string, ACTIVO int")
    supplied = spark.createDataFrame(
        [("S1", "A", 9.0), ("S2", "A", 8.0), ("S3", "B", 7.0)],
        "CODIGO string, CODIGOARTICULO string, PRECIO double",
    )
    t = [datetime(2024, 1, 1), datetime(2024, 1, 20), datetime(2024, 2, 1)]
    changes = spark.createDataFrame(
        [("S1", t[0], 1.0), ("S1", t[0], 1.0), ("S2", t[1], 2.0), ("S1", t[2], 3.0), ("S3", t[0], 4.0)],
        "CODIGOARTICULOPROVEEDOR string, FECHAMODIFICACION timestamp_ntz, PRECIO double",
    )
    window = Window("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    got = extract_prices(articles, supplied, changes, window, newest_first=True)
    assert [tuple(r) for r in got.collect()] == [("A", 8.0, t[1], 2.0), ("A", 9.0, t[0], 1.0)]
    assert extract_prices(articles, supplied, changes).count() == 3


def test_dimensions(spark):
    rubros = spark.createDataFrame([("1", "10"), ("2", "99"), ("3", None)], "codigorubro string, codigosuperrubro string")
    units = spark.createDataFrame([("10", "Tyres", 4.0)], "codigosuperrubro string, descripcion string, unidades double")
    assert rows(extract_rubros(rubros, units)) == [
        ("1", "10", "Tyres", 4.0), ("2", "99", "SIN SUPERRUBRO", 0.0), ("3", None, "SIN SUPERRUBRO", 0.0),
    ]
    bridge = spark.createDataFrame([(1, "m1", "l1"), (2, "m1", "lx"), (3, "mx", "l1")], "id int, marca_id string, linea_id string")
    brands = spark.createDataFrame([("m1", "Brand")], "MARCA_ID string, MARCA string")
    lines = spark.createDataFrame([("l1", "Line")], "LINEA_ID string, LINEA string")
    assert rows(extract_brand_lines(bridge, lower_columns(brands), lower_columns(lines))) == [
        (1, "m1", "Brand", "l1", "Line"), (2, "m1", "Brand", None, None), (3, None, None, "l1", "Line"),
    ]
    sellers = spark.createDataFrame([("1", "Ana", 1), ("2", "Bo", 0)], "codigovendedor string, razonsocialvend string, activo int")
    assert rows(extract_sellers(sellers)) == [("1", "Ana")]


def test_jdbc_options_respect_connection_limits(spark):
    db = mysql("db.example", "sales", "u", "secret")
    options = jdbc_options(db, "SELECT 1;")
    assert options["dbtable"] == "(SELECT 1) q" and options["numPartitions"] == "1"
    assert "secret" not in repr(db)
    assert jdbc_options(firebird("h", "/p.fdb", "u", "s"), "ARTICULOS")["dbtable"] == "ARTICULOS"
    with pytest.raises(ValueError, match="4 parts for 3"):
        read_jdbc(spark, db, "T", ["a", "b", "c", "d"])


def test_source_queries_narrow_by_date_and_quote():
    window = Window("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    text = header_query(SALES_SOURCES[0], window)
    assert "FECHACOMPROBANTE >= '2024-01-01'" in text and "'NDB'" in text and "ANULADA = 0" in text
    body = body_query(SALES_SOURCES[0], window)
    assert text in body and "NOT IN ('42537'" in body


def test_window_rejects_unknown_closure():
    with pytest.raises(ValueError):
        Window("2024-01-01", "2024-02-01", "neither").covers("x")


def test_feeds_read_their_tables(spark, monkeypatch):
    """The readers with the database taken out: a table name or query gives a small frame."""
    asked = []
    when = datetime(2024, 1, 5, 10)
    stored = {
        "RUBROS": ([("r", "s")], "CODIGORUBRO string, CODIGOSUPERRUBRO string"),
        "UNIDADESXRUBRO": ([("s", "Super", 2.0)], "CODIGOSUPERRUBRO string, DESCRIPCION string, UNIDADES double"),
        "Vendedores": ([("1", "Ana", 1), ("2", "Bo", 0)], "codigovendedor string, razonsocialvend string, activo int"),
        "MarcasxLineas": ([(1, "m", "l")], "id int, marca_id string, linea_id string"),
        "Marcas": ([("m", "Brand")], "MARCA_ID string, MARCA string"),
        "Lineas": ([("l", "Line")], "LINEA_ID string, LINEA string"),
        "ARTICULOS": ([("a", 1), ("b", 0)], "CODIGOARTICULO string, ACTIVO int"),
        "ARTICULOSPROVEEDOR": ([("p", "a", 9.0), ("q", "b", 8.0)], "CODIGO string, CODIGOARTICULO string, PRECIO double"),
        "CAMBIOSDEPRECIOPROVEEDOR": (
            [("p", when, 7.0), ("q", when, 6.0), ("p", datetime(2024, 2, 1), 5.0)],
            "CODIGOARTICULOPROVEEDOR string, FECHAMODIFICACION timestamp_ntz, PRECIO double",
        ),
    }

    def fake(spark, db, query, parts=()):
        asked.append((query, parts))
        return spark.createDataFrame(*stored[query])

    monkeypatch.setattr("tallysheet.plans.feeds.read_jdbc", fake)
    db = mysql("h", "d", "u", "p")
    feeds = jdbc_feeds(spark, db, firebird("h", "/p.fdb", "u", "s"), "/clients", "/products")
    window = Window("2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert rows(feeds.sellers()) == [("1", "Ana")]
    assert rows(feeds.rubros()) == [("r", "s", "Super", 2.0)]
    assert rows(feeds.marcas_lineas()) == [(1, "m", "Brand", "l", "Line")]
    assert rows(feeds.prices(window)) == [("a", 9.0, when, 7.0)]
    assert {q for q, _ in asked} == set(stored)


def test_last_day_of_a_window_counts_to_its_end(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 10),), (datetime(2024, 4, 1),)], "day timestamp_ntz")
    window = Window("2024-03-01 00:00:00", "2024-03-31 14:30:00")
    assert df.where(window.covers_day("day")).count() == 1
