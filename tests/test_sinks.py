from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from decimal import Decimal
from threading import Event

import pytest
from pyspark.sql import functions as F

from tallysheet.config import DEFAULT_RULES, SALES_SOURCES
from tallysheet.operators.mart import sales_by
from tallysheet.plans.incremental import (
    GROUPS,
    Feeds,
    IncompleteMonth,
    backfill,
    load_month,
    month_window,
    month_windows,
    months_between,
    months_to_load,
    refresh,
    refresh_mart,
)
from tallysheet.quality.checks import CheckFailed
from tallysheet.queries import fixtures as fx
from tallysheet.schemas import RAW_SALES, conform
from tallysheet.scratch import scratch_dir
from tallysheet.sinks import versions
from tallysheet.sinks.audit import audit_rows, month_complete
from tallysheet.sinks.tables import (
    remove_replaced,
    replace_month,
    replace_partitions,
    replace_source_month,
    replace_table,
    write_mart,
)
from tallysheet.sinks.versions import ConcurrentReplace
from tallysheet.sources.tables import Catalog, init_catalog, raw
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
PRICES = "codigoarticulo string, precioactual double, fechamodificacion timestamp_ntz, precio double"


@pytest.fixture
def catalog(spark):
    path = scratch_dir(spark, "cat")
    c = Catalog(path.rsplit("/", 1)[-1].replace("-", "_") + "_")
    init_catalog(spark, c, path)
    return c


def prices(spark, *items):
    return spark.createDataFrame([(a, 1.0, datetime(2024, m, 5), p) for a, m, p in items], PRICES)


def sales(spark, *items):
    df = spark.createDataFrame(
        [(float(n), db, datetime(2024, m, 5)) for n, db, m in items],
        "numero_comprobante double, db string, fecha_comprobante timestamp_ntz",
    )
    return conform(
        df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in RAW_SALES.fields if f.name not in df.columns}),
        RAW_SALES,
    )


def test_init_twice_keeps_rows(spark, catalog):
    name = catalog.raw("raw_sellers")
    sellers = spark.createDataFrame([("1", "Ana")], "codigovendedor string, nombre string")
    assert replace_table(sellers, name) == 1
    init_catalog(spark, catalog)
    assert rows(raw(spark, catalog, "raw_sellers")) == [("1", "Ana")]


def test_replace_table_and_empty_guard(spark, catalog):
    name = catalog.raw("raw_sellers")
    two = spark.createDataFrame([("1", "Ana"), ("2", "Bo")], "codigovendedor string, nombre string")
    assert replace_table(two, name) == 2
    assert replace_table(two.where("codigovendedor = '2'"), name) == 1
    assert replace_table(two.where("false"), name) == 0
    assert rows(spark.table(name)) == [("2", "Bo")]


def test_replace_month(spark, catalog):
    name = catalog.raw("raw_price_history")
    assert replace_month(prices(spark, ("a", 1, 1.0), ("b", 1, 2.0)), name, "2024-01") == 2
    assert replace_month(prices(spark, ("a", 2, 3.0)), name, "2024-02") == 1
    for _ in range(2):
        assert replace_month(prices(spark, ("a", 1, 9.0)), name, "2024-01") == 1
    assert rows(spark.table(name), "codigoarticulo", "precio") == [("a", 3.0), ("a", 9.0)]
    assert replace_month(prices(spark, ("a", 1, 9.0)).where("false"), name, "2024-01") == 0
    assert rows(spark.table(name), "load_month", "precio") == [("2024-02", 3.0)]


def test_replace_source_month(spark, catalog):
    name = catalog.raw("raw_sales")
    for db in ("DIMDS", "DISDS"):
        assert replace_source_month(sales(spark, (1, db, 1), (2, db, 1)), name, db, "2024-01") == 2
    assert replace_source_month(sales(spark, (7, "DIMDS", 1)), name, "DIMDS", "2024-01") == 1
    assert rows(raw(spark, catalog, "raw_sales"), "db", "numero_comprobante") == [
        ("DIMDS", 7.0), ("DISDS", 1.0), ("DISDS", 2.0),
    ]
    assert replace_source_month(sales(spark, (7, "DIMDS", 1)).where("false"), name, "DIMDS", "2024-01") == 0
    assert rows(raw(spark, catalog, "raw_sales"), "db", "numero_comprobante") == [("DISDS", 1.0), ("DISDS", 2.0)]


def test_failed_load_keeps_the_stored_month_and_the_session_setting(spark, catalog):
    name = catalog.raw("raw_price_history")
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    broken = prices(spark, ("a", 1, 2.0)).withColumn("precio", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        replace_month(broken, name, "2024-01")
    assert rows(spark.table(name), "precio") == [(1.0,)]
    assert spark.conf.get(setting) == before


def test_write_mart_prunes_by_month(spark, catalog):
    fact = spark.createDataFrame(
        [("2024-01", "v", "acc", "art", 1), ("2024-02", "v", "acc", "art", 2)],
        "year_month string, vendor_code string, account_code string, article_code string, n int",
    )
    table = catalog.analytics("fct_sales")
    write_mart(fact, table)
    write_mart(fact, table)
    month = sales_by(spark.table(table), "2024-02")
    assert rows(month, "n") == [(2,)]
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_months():
    assert months_between("2023-11-20", datetime(2024, 1, 3)) == ["2023-11", "2023-12", "2024-01"]
    assert months_between("2023-11", "2024-01", end_offset=0) == ["2023-11", "2023-12"]
    assert months_between("2024-02", "2024-01") == [] and months_between("2024-03", "2024-01") == []
    assert months_to_load("2023-03-15") == ["2023-01", "2023-02", "2023-03"]
    w = month_window("2023-12")
    assert (w.start, w.end) == ("2023-12-01 00:00:00", "2024-01-01 00:00:00")


@pytest.mark.parametrize("offset", [0, 1])
def test_month_windows_agree_with_the_list(spark, offset):
    for first, last in (("2023-11-20", "2024-02-03"), ("2024-01-01", "2024-01-31"), ("2024-03-01", "2024-01-01")):
        bounds = spark.createDataFrame([(first, last)], "a string, b string")
        got = month_windows(bounds, "a", "b", offset)
        assert [r.load_month for r in got.orderBy("load_month").collect()] == months_between(first, last, offset)
        assert got.where("window_end <> window_start + interval 1 month").count() == 0


def test_backfill_clears_months_without_rows(spark, catalog):
    stored = sales(spark, (1, "DIMDS", 1), (2, "DIMDS", 2), (3, "DISDS", 2), (4, "DIMDS", 4))
    months = ["2024-01", "2024-02", "2024-03", "2024-04"]
    tags = [s.db for s in SALES_SOURCES]
    backfill(spark, catalog, "raw_sales", lambda w: stored, months, "fecha_comprobante", tags)
    assert raw(spark, catalog, "raw_sales").count() == 4

    # Only DIMDS of the first three months is reloaded, and February has become empty.
    again = sales(spark, (8, "DIMDS", 1), (9, "DISDS", 1))
    counts = backfill(spark, catalog, "raw_sales", lambda w: again, months[:3], "fecha_comprobante", ["DIMDS"])
    assert counts == {("2024-01", "DIMDS"): 1}
    assert rows(raw(spark, catalog, "raw_sales"), "load_month", "db", "numero_comprobante") == [
        ("2024-01", "DIMDS", 8.0), ("2024-02", "DISDS", 3.0), ("2024-04", "DIMDS", 4.0),
    ]
    zero = spark.table(catalog.audit).where("load_month = '2024-02' and source = 'DIMDS'").orderBy("loaded_at")
    assert [r.row_count for r in zero.collect()] == [1, 0]
    with pytest.raises(ValueError):
        backfill(spark, catalog, "raw_sales", lambda w: again, ["2024-01", "2024-03"], "fecha_comprobante")


def test_month_complete_counts_empty_loads(spark):
    loads = [("2024-01", s.db, 0 if i else 5) for i, s in enumerate(SALES_SOURCES)]
    loads += [("2024-02", s.db, 1) for s in SALES_SOURCES[:3]]
    audit = audit_rows(spark, "raw_sales", loads)
    got = month_complete(audit, [s.db for s in SALES_SOURCES])
    assert rows(got) == [("2024-01", 4, 5, True), ("2024-02", 3, 3, False)]


def test_load_month_records_the_load(spark, catalog):
    feed = lambda w: prices(spark, ("a", 1, 1.0)).where(w.covers("fechamodificacion"))
    assert load_month(spark, catalog, "raw_price_history", feed, "2024-01") == 1
    assert load_month(spark, catalog, "raw_price_history", feed, "2024-02") == 0
    got = rows(spark.table(catalog.audit), "asset", "load_month", "source", "row_count")
    assert got == [("raw_price_history", "2024-01", None, 1), ("raw_price_history", "2024-02", None, 0)]


@pytest.fixture
def feeds(spark):
    tables = fx.raw_tables(spark, SF)
    return Feeds(
        clients=lambda: tables["raw_clients"],
        sellers=lambda: tables["raw_sellers"],
        articulos=lambda: tables["raw_articulos"],
        rubros=lambda: tables["raw_rubros"],
        marcas_lineas=lambda: tables["raw_marcas_lineas"],
        sales=lambda db, w: fx.raw_sales(spark, SF, w).where(F.col("db") == db),
        prices=lambda w: fx.raw_prices(spark, SF, w),
    )


def test_refresh_groups_and_mart(spark, catalog, feeds):
    assert set(GROUPS) == {"full", "articles", "clients", "sales", "prices", "mart"}
    loaded = refresh(spark, catalog, "full", feeds)
    assert loaded["raw_clients"] == 150 and loaded["raw_sellers"] == 20
    loaded = refresh(spark, catalog, "sales", feeds, "1997-03", fx.RULES)
    assert set(loaded) == {f"raw_sales/{s.db}" for s in SALES_SOURCES}
    refresh(spark, catalog, "prices", feeds, "1997-04")
    refresh(spark, catalog, "mart", rules=fx.RULES)
    fact = spark.table(catalog.analytics("fct_sales"))
    assert rows(fact.select("year_month").distinct()) == [("1997-03",)]
    total = fact.agg(F.sum("gm_amount") + F.sum("ds_amount") + F.sum("ppal_amount"), F.sum("final_price")).first()
    assert total[0] == total[1] > Decimal(0)


def test_failing_check_stops_before_the_mart(spark, catalog, feeds):
    refresh(spark, catalog, "full", feeds)
    refresh(spark, catalog, "sales", feeds, "1997-03", fx.RULES)
    twice = raw(spark, catalog, "raw_sellers").unionByName(raw(spark, catalog, "raw_sellers"))
    replace_table(spark.createDataFrame(twice.toPandas()), catalog.raw("raw_sellers"))
    with pytest.raises(CheckFailed, match="stg_sellers.codigo_vendedor unique: 20"):
        refresh(spark, catalog, "mart", rules=DEFAULT_RULES)
    assert not spark.catalog.tableExists(catalog.analytics("fct_sales"))


def test_parallel_loads_leave_other_months_alone(spark, catalog):
    """Four months and four sources of one month, reloaded from threads at the same time."""
    name = catalog.raw("raw_sales")
    sources = [s.db for s in SALES_SOURCES]
    for m in range(1, 9):
        for db in sources[: 4 if m == 1 else 1]:
            replace_source_month(sales(spark, (m, db, m)), name, db, f"2024-{m:02d}")
    setting = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    work = [(sources[0], m) for m in range(2, 6)] + [(db, 1) for db in sources]
    with ThreadPoolExecutor(len(work)) as pool:
        jobs = [
            pool.submit(replace_source_month, sales(spark, (100 + m, db, m)), name, db, f"2024-{m:02d}")
            for db, m in work
        ]
        assert [j.result() for j in jobs] == [1] * len(work)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == setting
    stored = sorted(tuple(r) for r in spark.table(name).select("load_month", "db", "numero_comprobante").collect())
    expected = [("2024-01", db, 101.0) for db in sources]
    expected += [(f"2024-{m:02d}", sources[0], float(100 + m if m < 6 else m)) for m in range(2, 9)]
    assert stored == sorted(expected)


def test_a_reader_sees_all_months_of_a_backfill_or_none(spark, catalog):
    """24 months are replaced again and again while a thread reads them."""
    months = months_between("2022-01", "2023-12")
    feed = lambda price: spark.createDataFrame(
        [("a", 1.0, datetime(int(m[:4]), int(m[5:]), 5), price) for m in months], PRICES
    )
    load = lambda price: backfill(spark, catalog, "raw_price_history", lambda w: feed(price), months, "fechamodificacion")
    load(0.0)
    stop, seen = Event(), []

    def read():
        while not stop.is_set():
            found = raw(spark, catalog, "raw_price_history").select("load_month", "precio").collect()
            seen.append((len(found), {r["precio"] for r in found}))

    with ThreadPoolExecutor(1) as pool:
        reading = pool.submit(read)
        for price in (1.0, 2.0, 3.0):
            load(price)
        stop.set()
        reading.result()
    assert len(seen) > 3
    assert all(n == 24 and len(prices_seen) == 1 for n, prices_seen in seen), seen


def test_a_frame_goes_on_with_the_version_it_began_with(spark, catalog):
    name = catalog.raw("raw_price_history")
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    before = spark.table(name)
    replace_month(prices(spark, ("a", 1, 2.0)), name, "2024-01")
    assert rows(before, "precio") == [(1.0,)] and rows(spark.table(name), "precio") == [(2.0,)]


def test_of_two_loads_of_one_month_the_later_commit_fails(spark, catalog):
    name = catalog.raw("raw_price_history")
    replace_month(prices(spark, ("a", 1, 0.0), ("a", 2, 0.0)).where("month(fechamodificacion) = 1"), name, "2024-01")
    base = versions.current(spark, name)
    schema, by = spark.table(name).schema, ["load_month"]
    # A load that began from the same version is overtaken by another one of the same month, ...
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    with pytest.raises(ConcurrentReplace, match="2024-01"):
        versions.replace(spark, name, base, schema, by, lambda k: k == ("2024-01",), {("2024-01",): "nowhere"})
    assert rows(spark.table(name), "precio") == [(1.0,)]
    # ... but one of another month goes on top of it.
    replace_month(prices(spark, ("a", 2, 2.0)), name, "2024-02")
    folder = versions.current(spark, name).folders["2024-02",]
    versions.replace(spark, name, base, schema, by, lambda k: k == ("2024-03",), {("2024-03",): folder})
    assert rows(spark.table(name), "load_month", "precio") == [("2024-01", 1.0), ("2024-02", 2.0), ("2024-03", 2.0)]


def test_loads_of_one_month_at_the_same_time(spark, catalog):
    """Every load commits or fails clearly, and the stored rows are those of one that committed last."""
    name = catalog.raw("raw_price_history")
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(replace_month, prices(spark, ("a", 1, float(p))), name, "2024-01") for p in range(4)]
    failed = [p for p, j in enumerate(jobs) if isinstance(j.exception(), ConcurrentReplace)]
    done = [p for p, j in enumerate(jobs) if j.exception() is None]
    assert sorted(failed + done) == [0, 1, 2, 3] and done
    ((price,),) = rows(spark.table(name), "precio")
    assert price in done


def test_a_commit_that_was_not_published_is_completed(spark, catalog):
    name = catalog.raw("raw_price_history")
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    last = versions.current(spark, name)
    assert versions._commit(spark, name, last.number + 1, spark.table(name).schema, ["load_month"], {})
    assert not versions._commit(spark, name, last.number + 1, spark.table(name).schema, ["load_month"], last.folders)
    assert rows(spark.table(name), "precio") == [(1.0,)]
    assert versions.publish(spark, name) == last.number + 1
    assert rows(spark.table(name), "precio") == []


def test_tables_with_similar_names_are_left_alone(spark, catalog):
    name = catalog.raw("raw_price_history")
    spark.sql(f"CREATE TABLE {name}__voided (a int) USING parquet")
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    remove_replaced(spark, name)
    assert rows(spark.table(name), "precio") == [(1.0,)] and spark.catalog.tableExists(f"{name}__voided")


def test_plain_tables_are_not_taken_over(spark, catalog):
    name = catalog.raw("raw_plain")
    spark.sql(f"CREATE TABLE {name} (a int) USING parquet")
    with pytest.raises(ValueError, match="plain table"):
        versions.create_versioned(spark, name, RAW_SALES, ["db"])


def test_first_load_is_computed_once(spark, catalog):
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    df = spark.range(10).mapInArrow(counted, "id long")
    table = catalog.analytics("once")
    assert replace_table(df, table) == 10 and n.value == 10
    assert replace_table(df.where("id < 0"), catalog.analytics("none")) == 0
    assert not spark.catalog.tableExists(catalog.analytics("none"))


def test_rows_outside_the_scope_are_refused(spark, catalog):
    name = catalog.raw("raw_price_history")
    replace_month(prices(spark, ("a", 1, 1.0)), name, "2024-01")
    df = prices(spark, ("a", 2, 3.0)).withColumn("load_month", F.lit("2024-02"))
    with pytest.raises(ValueError):
        replace_partitions(df, name, {"load_month": ["2024-01"]})
    assert rows(spark.table(name), "codigoarticulo", "precio") == [("a", 1.0)]


def test_replaced_files_go_on_request(spark, catalog):
    name = catalog.raw("raw_price_history")
    for price in (1.0, 2.0, 3.0):
        replace_month(prices(spark, ("a", 1, price)), name, "2024-01")
    # Two folders of rows, and the lists of three versions.
    assert len(remove_replaced(spark, name)) == 5
    assert rows(spark.table(name), "precio") == [(3.0,)]
    assert remove_replaced(spark, name) == []
    replace_month(prices(spark, ("a", 2, 4.0)), name, "2024-02")
    assert rows(spark.table(name), "precio") == [(3.0,), (4.0,)]
    sellers = catalog.raw("raw_sellers")
    for who in ("Ana", "Bo"):
        replace_table(spark.createDataFrame([("1", who)], "codigovendedor string, nombre string"), sellers)
    assert len(remove_replaced(spark, sellers)) == 1
    assert rows(spark.table(sellers)) == [("1", "Bo")]


def test_failing_mart_check_keeps_the_old_rows(spark, catalog):
    name = catalog.analytics("fct_sales")
    first = spark.createDataFrame([("2024-01", 1)], "year_month string, voucher_number long")
    write_mart(first, name)

    def refuse(df):
        assert df.count() == 2
        raise CheckFailed("no")

    with pytest.raises(CheckFailed):
        write_mart(first.union(first), name, check=refuse)
    assert rows(spark.table(name)) == [("2024-01", 1)] or rows(spark.table(name)) == [(1, "2024-01")]
    for n in (2, 3):
        write_mart(first.withColumn("voucher_number", F.lit(n).cast("long")), name)
    assert [r["voucher_number"] for r in spark.table(name).collect()] == [3]
    remove_replaced(spark, name)
    database = name.rpartition(".")[0]
    assert spark.sql(f"SHOW TABLES IN {database} LIKE 'fct_sales__*'").count() == 1
    assert [r["voucher_number"] for r in spark.table(name).collect()] == [3]


def test_some_months_of_the_mart_are_replaced(spark, catalog):
    name = catalog.analytics("fct_sales")
    make = lambda *items: spark.createDataFrame(list(items), "n int, year_month string, voucher_number long")
    assert write_mart(make((1, "2024-01", 1), (1, "2024-02", 2), (1, None, 3)), name) == {"2024-01": 1, "2024-02": 1, None: 1}
    before = versions.current(spark, name).folders
    assert write_mart(make((2, "2024-02", 4)), name, months=["2024-02", "2024-03"], notes={"a": "it's"}) == {"2024-02": 1}
    after = versions.current(spark, name)
    assert {k for k in before if after.folders[k] == before[k]} == {("2024-01",), (None,)} and after.notes == {"a": "it's"}
    assert sorted(r["voucher_number"] for r in spark.table(name).collect()) == [1, 3, 4]
    with pytest.raises(ValueError, match="outside"):
        write_mart(make((2, "2024-02", 4)), name, months=["2024-03"])
    with pytest.raises(ValueError, match="other columns"):
        write_mart(make((2, "2024-02", 4)).drop("n"), name, months=["2024-02"])


def test_a_mart_from_an_earlier_layout_is_rebuilt(spark, catalog):
    for kind in ("TABLE", "VIEW"):
        name = catalog.analytics(f"old_{kind.lower()}")
        made = "USING parquet AS SELECT 1 AS a" if kind == "TABLE" else "AS SELECT 1 AS a"
        spark.sql(f"CREATE {kind} {name} {made}")
        write_mart(spark.createDataFrame([("2024-01", 5)], "year_month string, n int"), name)
        assert rows(spark.table(name), "n") == [(5,)]


def test_incomplete_months_stop_the_mart(spark, catalog, feeds):
    refresh(spark, catalog, "full", feeds)
    for s in SALES_SOURCES[:3]:
        load_month(spark, catalog, "raw_sales", lambda w: sales(spark), "2024-01", s.db)
    with pytest.raises(IncompleteMonth):
        refresh_mart(spark, catalog)
    # A source without rows is loaded all the same.
    load_month(spark, catalog, "raw_sales", lambda w: sales(spark), "2024-01", SALES_SOURCES[3].db)
    refresh_mart(spark, catalog)


def test_refresh_says_what_is_missing(spark, catalog, feeds):
    with pytest.raises(ValueError, match="needs a month"):
        refresh(spark, catalog, "sales", feeds)
    with pytest.raises(ValueError, match="needs feeds"):
        refresh(spark, catalog, "clients")
