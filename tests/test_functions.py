from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallysheet.config import GM_DISCOUNT_PATTERN
from tallysheet.functions import (
    compose_timestamp,
    discount_percent,
    discount_text,
    in_window,
    month_key,
    to_amount,
    to_whole,
)
from tallysheet.queries.registry import present


@pytest.mark.parametrize(
    "text, number, pct",
    [
        ("(35.90) M-1614", "35.90", Decimal("35.9")),
        ("  (5) x", "5", Decimal(5)),
        ("x (5)", None, None),
        ("()", None, None),
        ("(1.2.3) x", "1.2.3", None),
        ("(.) x", ".", None),
        ("(5", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_discount_text(spark, text, number, pct):
    df = spark.createDataFrame([(text,)], "barrio string")
    found = df.select(discount_text("barrio", GM_DISCOUNT_PATTERN).alias("t"))
    row = found.withColumn("p", discount_percent("t")).first()
    assert row.t == number
    assert row.p == pct


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_digits_are_cut(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(0.00004, "123456"), (12.34567, "33.33335"), (1.23456789, "7."), (float("nan"), ".5")], "v double, t string")
        got = df.select(to_amount("v"), discount_percent("t")).collect()
        assert [r[0] for r in got] == [Decimal("0.00004"), Decimal("12.34567"), Decimal("1.23456789"), None]
        assert [r[1] for r in got] == [Decimal(123456), Decimal("33.33335"), Decimal(7), Decimal("0.5")]
        for bad in (df.select(to_amount(F.col("v") * 1e15)), df.select(discount_percent(F.repeat("t", 4)))):
            with pytest.raises(Exception, match="out of range"):
                bad.where("t = '123456' or true").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(v,) for v in (2.5, 3.5, 3.7, -2.5, None)], "v double")
    assert [r[0] for r in df.select(to_whole("v")).collect()] == [2, 4, 4, -2, None]


def test_compose_timestamp(spark):
    data = [(date(2024, 1, 31), "23:59:58"), (date(2024, 1, 31), None), (None, "10:00:00"), (date(2024, 1, 31), "soon")]
    df = spark.createDataFrame(data, "d date, t string")
    got = [r[0] for r in df.select(compose_timestamp("d", "t")).collect()]
    assert got == [datetime(2024, 1, 31, 23, 59, 58), None, None, None]


def test_window_ends(spark):
    instants = ["2024-01-01 00:00:00", "2024-01-31 23:59:59.999999", "2024-02-01 00:00:00", "2023-12-31 23:59:59"]
    df = spark.createDataFrame([(t,) for t in instants], "t string").select(F.col("t").cast("timestamp_ntz"))
    half = df.where(in_window("t", "2024-01-01", "2024-02-01")).count()
    both = df.where(in_window("t", "2024-01-01", "2024-02-01", "both")).count()
    assert (half, both) == (2, 3)
    with pytest.raises(ValueError):
        in_window("t", "2024-01-01", "2024-02-01", "right")


def test_month_key(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 23:59:59' as t")
    assert df.select(month_key("t")).first()[0] == "2024-03"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimals_are_shown_alike_in_both_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = ["0", "-0.00000001", "0.00000012", "-12.5", "12345678901234.12345678", None]
        df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast("decimal(22,8)").alias("v"))
        assert [r.v for r in present(df).collect()] == [
            "0.000000000000", "-0.000000010000", "0.000000120000", "-12.500000000000", "12345678901234.123456780000", None,
        ]
        # The remainder of each decimal is dear, and only needed where its text may have an exponent.
        assert (" % " in present(df)._jdf.queryExecution().optimizedPlan().toString()) is (ansi == "false")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
