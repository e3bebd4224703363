from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallysheet.config import SALES_SOURCES
from tallysheet.operators.keyfilter import may_match
from tallysheet.queries import fixtures as fx
from tallysheet.scratch import scratch_dir
from tallysheet.sources.extract import Window, extract_sales

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 3_000])
def test_no_partner_is_lost_and_few_others_pass(spark, n):
    rows = spark.range(200_000).selectExpr("cast(id as double) as num", "cast(id % 7 as string) as kind")
    keys = spark.range(n).selectExpr("cast(id * 50 as double) as num", "cast((id * 50) % 7 as string) as kind")
    kept = may_match(rows, keys, ["kind", "num"], words=1 << 9)
    assert kept.join(keys, ["kind", "num"]).count() == n
    # Eleven bits for each key at most.
    assert kept.count() <= n + 200_000 * 0.05 * (n > 0)


def test_signs_of_zero_nulls_and_other_types(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (None,), (5.0,)], "num double")
    keys = spark.createDataFrame([(-0.0,), (None,)], "num double")
    kept = may_match(rows, keys, ["num"], range_of="num")
    assert kept.join(keys, "num").count() == 2 and kept.where("num = 5").count() == 0
    assert may_match(rows, keys.select(F.col("num").cast("long").alias("num")), ["num"]).count() == 4


def test_nothing_runs_while_the_plan_is_built_and_bounds_reach_the_scan(spark):
    path = scratch_dir(spark, "rows")
    spark.range(1000).selectExpr("cast(id as double) as num").write.parquet(path)
    failing = spark.range(3).select(F.raise_error(F.lit("ran")).cast("double").alias("num"))
    kept = may_match(spark.read.parquet(path), failing, ["num"], range_of="num")
    plan = _plan(kept)
    scan = plan[plan.index("FileScan") :].split("\n")[0]
    assert scan.count("Subquery") >= 2 and "Exchange" not in plan.split("Subquery")[0]


def test_lines_of_other_months_are_not_shuffled(spark):
    header, body = (fx.source(spark, SF, n) for n in ("src_header", "src_body"))
    window = Window("1997-03-01 00:00:00", "1997-04-01 00:00:00")
    keys = ["db", "tipocomprobante", "numerocomprobante"]
    wanted = extract_sales(header, body, window=window, rules=fx.RULES, keys=keys).count()
    heads = header.where(window.covers_day("fechacomprobante"))
    kept = may_match(body, heads, keys, range_of="numerocomprobante").count()
    # Voided vouchers and other types are among the keys here, so some lines more; of all lines it is a small part.
    assert wanted <= kept <= 1.5 * wanted and kept < body.count() / 20
    assert len(SALES_SOURCES) == 4


def test_the_hash_of_a_row_is_worked_out_once_for_its_word_and_once_for_each_bit(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"))
    plan = may_match(rows, rows.where("k < 10"), ["k"])._jdf.queryExecution().analyzed().toString()
    outer = next(line for line in plan.splitlines() if "Filter" in line)
    assert outer.split("scalar-subquery")[-1].count("xxhash64") == 4


def test_a_table_nearly_full_is_not_asked(spark):
    rows = spark.range(100_000).select(F.col("id").alias("k"))
    # Some nine bits in ten are set.
    assert may_match(rows, rows.where("k < 3200"), ["k"], words=64).count() == 100_000
    assert may_match(rows, rows.where("k < 300"), ["k"], words=64).count() < 10_000


def test_a_key_that_is_an_expression_is_worked_out_once(spark):
    rows = spark.range(1000).selectExpr("concat('kind ', cast(id % 7 as string)) as kind", "id as num")
    kept = may_match(rows, rows.where("num % 50 = 0"), ["kind", "num"])
    asked = next(line for line in _plan(kept).splitlines() if "Filter" in line and "xxhash64" in line)
    assert "concat" not in asked and kept.columns == rows.columns and kept.count() < 100


def test_lines_are_joined_by_the_number_first(spark):
    header, body = (fx.source(spark, SF, n) for n in ("src_header", "src_body"))
    joined = extract_sales(header, body, rules=fx.RULES, keys=fx.ALL_SOURCES_KEY)
    join = next(line for line in _plan(joined).splitlines() if "Join [" in line)
    assert "numerocomprobante" in join.split("Join [")[1].split(",")[0]
