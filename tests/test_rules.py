from datetime import datetime
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallysheet.config import BRANCH_RULES
from tallysheet.operators.accounts import attach_accounts, detect_gm, resolve_account
from tallysheet.operators.articles import enrich_articles
from tallysheet.operators.latest import latest_by
from tallysheet.operators.mart import FACT_NAMES, fct_sales, sales_by, sales_rollup
from tallysheet.operators.pricing import branch, breakdown, final_price
from tallysheet.operators.staging import cast_all, stg_clients, stg_sales
from tallysheet.schemas import FCT_SALES_COLUMNS, RAW_CLIENTS, RAW_SALES
from tests.conftest import rows

CLIENT = (
    "codigo_cliente string, cuenta_principal_codigo string, razon_social string, barrio string,"
    " codigo_vendedor string, codigo_zona string, codigo_particular string, es_gm boolean"
)


def client(code, principal="", barrio="Centro", seller="1"):
    return (code, principal, f"Name {code}", barrio, seller, "Z", f"P{code}", False)


@pytest.fixture(scope="module")
def clients(spark):
    return spark.createDataFrame(
        [
            client("blank", ""), client("null", None), client("sub", "main"), client("lost", "nobody"),
            client("self", "self"), client("chain", "sub"), client("main", "", "(35.90) M-1614"),
            client("bad", "", "(1.2.3) x"), client("ghost", "", "x", seller="77"),
        ],
        CLIENT,
    )


@pytest.fixture(scope="module")
def sellers(spark):
    return spark.createDataFrame([("1", "Ana")], "codigo_vendedor string, nombre_vendedor string")


def sales_of(spark, *codes, kind="RE", pos=17):
    return spark.createDataFrame(
        [(c, kind, pos) for c in codes], "codigo_cliente string, tipo_comprobante string, nro_punto_venta int"
    )


def test_account_resolution(spark, clients):
    codes = ("blank", "null", "sub", "lost", "self", "chain", "main", "unknown", None)
    got = resolve_account(sales_of(spark, *codes), clients)
    found = {r.codigo_cliente: (r.es_cuenta_secundaria, r.codigo_cuenta_resuelta) for r in got.collect()}
    assert found == {
        "blank": (False, "blank"), "null": (False, "null"), "sub": (True, "main"),
        "lost": (True, "nobody"), "self": (True, "self"), "chain": (True, "sub"),
        "main": (False, "main"), "unknown": (False, "unknown"), None: (False, None),
    }


def test_unknown_accounts_are_dropped_and_account_data_comes_from_the_principal(spark, clients, sellers):
    accounts = resolve_account(sales_of(spark, "sub", "lost", "unknown", "ghost", None), clients)
    got = detect_gm(accounts, clients, sellers)
    assert rows(got, "codigo_cliente", "razon_social_cuenta", "nombre_vendedor", "codigo_vendedor_cliente") == [
        ("ghost", "Name ghost", None, "77"), ("sub", "Name main", "Ana", "1"),
    ]


def test_gm_needs_all_three_conditions(spark, clients, sellers):
    for kind, pos, code in product(("RE", "FA"), (17, 5, None), ("main", "blank")):
        accounts = resolve_account(sales_of(spark, code, kind=kind, pos=pos), clients)
        row = detect_gm(accounts, clients, sellers).first()
        assert row.es_venta_gm is (kind == "RE" and pos == 17 and code == "main")
        # The rate is filled wherever the text has one, GM or not.
        assert row.gm_descuento_pct == (Decimal("35.9") if code == "main" else None)


def test_malformed_rate_is_gm_without_rate(spark, clients, sellers):
    row = detect_gm(resolve_account(sales_of(spark, "bad"), clients), clients, sellers).first()
    assert (row.es_venta_gm, row.gm_descuento_pct) == (True, None)


def test_rates_are_read_once_for_each_client_and_stop_only_a_job_with_such_a_sale(spark, clients, sellers):
    huge = clients.unionByName(spark.createDataFrame([client("huge", "", "(99999999999999999999) x")], CLIENT))
    got = attach_accounts(sales_of(spark, "main", "bad"), huge, sellers)
    assert {r.codigo_cliente: r.gm_descuento_pct for r in got.collect()} == {"main": Decimal("35.9"), "bad": None}
    # Ahead of the join, not in the rows of the sales behind it.
    behind = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "RLIKE" not in behind and "regexp_extract" not in behind
    with pytest.raises(Exception, match="discount out of range: 99999999999999999999"):
        attach_accounts(sales_of(spark, "huge"), huge, sellers).collect()


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_one_join_equals_two(spark, clients, sellers, limit):
    from tallysheet.config import Rules

    rules = Rules(broadcast_bytes=limit)
    sales = sales_of(
        spark, "blank", "null", "sub", "lost", "self", "chain", "main", "unknown", "bad", "ghost", None
    )
    two = detect_gm(resolve_account(sales, clients, rules), clients, sellers, rules)
    one = attach_accounts(sales, clients, sellers, rules)
    assert set(one.columns) == set(two.columns)
    assert rows(one, *sorted(one.columns)) == rows(two, *sorted(one.columns))


def test_article_enrichment(spark):
    sales = spark.createDataFrame(
        [(a, "vp", "vd") for a in ("A", "B", "C", "D", "E", "missing", None)],
        "codigo_articulo string, codigo_particular_articulo string, descripcion_articulo string",
    )
    articles = spark.createDataFrame(
        [("A", "ap", "ad", "r1", "7"), ("B", None, None, "r2", ""), ("C", "ap", "ad", "r3", "n/a"),
         ("D", "ap", "ad", "r4", " 7 "), ("E", "ap", "ad", "r5", "8")],
        "codigo_articulo string, codigo_particular string, descripcion string, codigo_rubro string, codigo_marca string",
    )
    rubros = spark.createDataFrame(
        [("r1", "10", "Ten", 4.0), ("r2", "-1", "Out", 1.0), ("r3", "377", "Out", 1.0), ("r4", None, "?", None), ("r5", "x", "Text", 2.0)],
        "codigo_rubro string, codigo_super_rubro string, descripcion_super_rubro string, unidades_min_rubro double",
    )
    brands = spark.createDataFrame(
        [(7, "m", "Seven", "l", "Line")], "codigo_marca int, marca_id string, marca string, linea_id string, linea string"
    )
    got = enrich_articles(sales, articles, rubros, brands)
    picked = ("codigo_articulo", "descripcion_articulo_master", "unidades_min_rubro", "codigo_marca_int", "marca", "es_articulo_valido")
    assert rows(got, *picked) == [
        (None, "vd", 0.0, None, None, False),
        ("A", "ad", 4.0, "7", "Seven", True),
        ("B", "vd", 1.0, "", None, False),
        ("C", "ad", 1.0, "n/a", None, False),
        ("D", "ad", 0.0, " 7 ", "Seven", False),
        ("E", "ad", 2.0, "8", None, True),
        ("missing", "vd", 0.0, None, None, False),
    ]


def test_latest_by(spark):
    t = [datetime(2024, 1, d) for d in (1, 2)]
    df = spark.createDataFrame(
        [("a", t[0], 1.0), ("a", t[1], 5.0), ("a", t[1], 3.0), ("a", t[1], None), ("b", t[1], 1.0), ("b", None, 9.0), ("c", t[0], None)],
        "k string, t timestamp_ntz, v double",
    )
    assert rows(latest_by(df, ["k"], "t", ["v"])) == [("a", t[1], 3.0), ("b", None, 9.0), ("c", t[0], None)]


def test_the_latest_of_distinct_rows_needs_no_distinct(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), 1.0)] * 3, "k string, t timestamp_ntz, v double")
    plan = latest_by(df.distinct(), ["k"], "t", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


PRICED = (
    "es_venta_gm boolean, es_cuenta_secundaria boolean, gm_descuento_pct decimal(9,4),"
    " precio_proveedor_vigente decimal(18,4), cantidad_articulo decimal(18,4), precio_total_articulo decimal(18,4),"
    " tipo_consumo string"
)


def test_final_price_rules(spark):
    d = Decimal
    cases = {
        # gm, secondary, pct, price -> final, discount amount, method
        (True, False, d("35.9"), d("100.01")): (d("128.212820"), d("71.807180"), "GM_DESCONTADO"),
        (True, False, d("35.9"), None): (d(50), None, "PRECIO_ESTANDAR"),
        (True, False, None, d(100)): (d(50), d(0), "PRECIO_ESTANDAR"),
        (True, True, d("35.9"), d(100)): (d(0), d(0), "SECUNDARIA_CERO"),
        (False, True, d("35.9"), d(100)): (d(0), d(0), "SECUNDARIA_CERO"),
        (False, False, d("35.9"), d(100)): (d(50), d(0), "PRECIO_ESTANDAR"),
    }
    for (gm, sec, pct, price), expected in cases.items():
        df = spark.createDataFrame([(gm, sec, pct, price, d(2), d(50), "DS")], PRICED)
        r = final_price(df).first()
        assert (r.precio_final, r.gm_descuento_monto, r.metodo_precio) == expected


def test_price_product_is_exact(spark):
    d = Decimal
    df = spark.createDataFrame([(True, False, d("12.3456"), d("98765432.1234"), d("12345.6789"), d(0), "DS")], PRICED)
    exact = d("98765432.1234") * d("12345.6789") * (d(100) - d("12.3456")) / 100
    assert abs(final_price(df).first().precio_final - exact) <= d("1e-10")


def test_branch_pairs(spark):
    pairs = {
        (19, "000"): "BA", (1, None): "BA", (8888, "001"): "BA", (18, "x"): "MDP", (7, "x"): "MDP",
        (2222, "003"): "MDP", (17, "x"): "PICO", (6, "x"): "PICO", (2222, "001"): "PICO",
        (109, "x"): "ROSARIO", (8, "x"): "ROSARIO", (8888, "002"): "ROSARIO",
        (8888, "003"): "UNKNOWN", (2222, "002"): "UNKNOWN", (8888, None): "UNKNOWN", (None, "001"): "UNKNOWN", (5, "001"): "UNKNOWN",
    }
    df = spark.createDataFrame(list(pairs), "nro_punto_venta int, codigo_deposito_articulo string")
    got = {(r[0], r[1]): r[2] for r in branch(df).collect()}
    assert got == pairs
    assert len(BRANCH_RULES) == 8


def test_breakdown_is_exclusive(spark):
    d = Decimal
    data = [(gm, sec, d(10), d(100), d(2), d(50), kind) for gm in (True, False) for sec in (True, False) for kind in ("DS", "PPAL", "XX", None)]
    got = breakdown(final_price(spark.createDataFrame(data, PRICED)))
    for r in got.collect():
        amounts = [r.gm_monto, r.ds_monto, r.ppal_monto]
        quantities = [r.gm_cantidad, r.ds_cantidad, r.ppal_cantidad]
        known = r.es_venta_gm or r.tipo_consumo in ("DS", "PPAL")
        assert sum(amounts) == (r.precio_final if known else 0)
        # Secondary lines keep their quantity although their amount is zero.
        assert sum(quantities) == (2 if known else 0)
        assert sum(q != 0 for q in quantities) == known


def test_fact_columns(spark):
    from tallysheet.queries import fixtures as fx
    from tallysheet.plans.fact import build_fact

    fact = build_fact(fx.staged_tables(spark, "/root/testdata/sf0.001"), fx.RULES)
    assert tuple(fact.columns) == FCT_SALES_COLUMNS and len(fact.columns) == 44
    kinds = {f.name: f.dataType.simpleString() for f in fact.schema.fields}
    assert kinds["voucher_number"] == "bigint" and kinds["point_of_sale"] == "int"
    assert kinds["invoice_datetime"] == "timestamp_ntz" and kinds["min_units_rubro"] == "double"
    assert kinds["is_gm_sale"] == "boolean" and kinds["brand_code"] == "string"
    assert all(kinds[c].startswith("decimal") for c in ("quantity", "final_price", "gm_discount_pct", "ppal_amount"))


def test_labels_filter_and_rollup(spark):
    names = {c: "x" for c in FACT_NAMES.values()}
    data = [
        {**names, "fecha_comprobante": "2024-03-05 10:00:00", "metodo_precio": m, "precio_final": "2", "codigo_vendedor_cliente": v}
        for m, v in (("GM_DESCONTADO", "1"), ("SECUNDARIA_CERO", "1"), ("PRECIO_ESTANDAR", "2"))
    ]
    df = spark.createDataFrame(data).withColumn("fecha_comprobante", F.col("fecha_comprobante").cast("timestamp_ntz"))
    fact = fct_sales(df.withColumn("precio_final", F.col("precio_final").cast("decimal(18,4)")))
    assert [r[0] for r in rows(fact, "price_method")] == ["GM_DISCOUNTED", "SECONDARY_ZEROED", "STANDARD_PRICE"]
    assert sales_by(fact, "2024-03", "1").count() == 2
    assert sales_by(fact, "2024-04").count() == 0
    assert rows(sales_rollup(fact, ["year_month", "vendor_code"], ["final_price"])) == [
        ("2024-03", "1", Decimal(4)), ("2024-03", "2", Decimal(2)),
    ]


def test_staging_types(spark):
    sales = stg_sales(spark.createDataFrame([], RAW_SALES))
    kinds = dict(sales.dtypes)
    assert kinds["numero_comprobante"] == "bigint" and kinds["cantidad_articulo"] == "decimal(22,8)"
    staged = stg_clients(spark.createDataFrame([], RAW_CLIENTS))
    kinds = dict(staged.dtypes)
    assert kinds["contrareembolso"] == "boolean" and kinds["es_gm"] == "boolean"
    assert {"codigo_cliente", "razon_social", "codigo_vendedor", "codigo_zona"} <= set(kinds)
    flags = cast_all(spark.createDataFrame([(0,), (2,), (None,)], "n int"), {"n": "boolean"})
    assert [r[0] for r in flags.collect()] == [False, True, None]
    whole = cast_all(spark.createDataFrame([(2.5,), (3.5,)], "n double"), {"n": "int"})
    assert [r[0] for r in whole.collect()] == [2, 4]
