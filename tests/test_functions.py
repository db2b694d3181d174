from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallylake.functions.catalog import create_functions
from tallylake.functions.dates import changed_since, in_months
from tallylake.functions.kpis import with_product_kpis
from tallylake.functions.levels import frustration_level


def kpis(spark, buy, msrp, qty):
    schema = "quantityinstock int, buyprice decimal(10,2), msrp decimal(10,2)"
    money = [None if v is None else D(v) for v in (buy, msrp)]
    row = with_product_kpis(spark.createDataFrame([(qty, *money)], schema)).first()
    return row.profit, row.profitpercent, row.promoind, row.demandind


@pytest.mark.parametrize(
    "buy, msrp, qty, expected",
    [
        ("40.00", "70.00", 7000, ("30.00", "75.00", 1, 0)),
        ("80.00", "200.10", 7000, ("120.10", "150.13", 1, 0)),
        ("10", "20", 0, ("10.00", "100.00", 0, 0)),
        ("10", "20", 1499, ("10.00", "100.00", 0, 1)),
        ("10", "20", 1500, ("10.00", "100.00", 0, 0)),
        ("10", "20", 1501, ("10.00", "100.00", 1, 0)),
        ("10", "12", 2000, ("2.00", "20.00", 0, 0)),
        ("10", "15", 100, ("5.00", "50.00", 0, 0)),
        ("30000", "45000.01", 100, ("15000.01", "50.00", 0, 1)),
        ("10", "8", 100, ("-2.00", "-20.00", 0, 0)),
    ],
)
def test_product_kpis(spark, buy, msrp, qty, expected):
    profit, percent, promo, demand = kpis(spark, buy, msrp, qty)
    assert (str(profit), str(percent), promo, demand) == expected


def test_product_kpis_without_a_result(spark):
    assert kpis(spark, None, "1", 1) == (None, None, None, None)
    assert kpis(spark, "0", "5", 1) == (D("5.00"), None, None, None)
    assert kpis(spark, "1", "5", None) == (D("4.00"), D("400.00"), None, None)
    assert kpis(spark, "0.01", "99999999.99", 1)[1] is None


def test_product_kpis_types_and_no_python(spark):
    schema = "quantityinstock smallint, buyprice decimal(10,2), msrp decimal(10,2)"
    out = with_product_kpis(spark.createDataFrame([], schema))
    assert out.dtypes[3:] == [
        ("profit", "decimal(10,2)"), ("profitpercent", "decimal(10,2)"), ("promoind", "smallint"), ("demandind", "smallint"),
    ]
    assert "EvalPython" not in out._jdf.queryExecution().executedPlan().toString()


def test_levels(spark):
    # The level names.
    sums = [-11, -10, -3, -2, -1, 0, 1, 2, 3, 10, 11, None]
    df = spark.createDataFrame([(s,) for s in sums], "s int")
    assert [r[0] for r in df.select(frustration_level(F.col("s"))).collect()] == [
        "unknown", "highly frustrated", "highly frustrated", "low frustrated", "low frustrated", "neutral",
        "happy", "happy", "overwhelming", "overwhelming", "unknown", "unknown",
    ]


def test_months_equal_the_function_form(spark):
    df = spark.sql("select explode(sequence(date'2021-12-01', date'2023-02-01', interval 1 day)) as d")
    ours = df.filter(in_months(F.col("d"), 2022, 7))
    assert ours.exceptAll(df.filter("year(d) = 2022 and month(d) >= 7")).isEmpty() and ours.count() == 184
    assert df.filter(in_months(F.col("d"), 2022, 12, 12)).count() == 31


def test_date_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = (
        orders.filter(in_months(F.col("o_orderdate").cast("date"), 1997, 7))
        .select("o_custkey")._jdf.queryExecution().executedPlan().toString()
    )
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_watermark(spark):
    df = spark.sql("select explode(sequence(date'2024-01-08', date'2024-01-10', interval 1 day)) as d")
    days = lambda **k: [r.d.day for r in df.filter(changed_since(F.col("d"), date(2024, 1, 10), **k)).collect()]
    assert days() == [10]
    assert days(inclusive=True) == [9, 10]
    assert days(days=2) == [9, 10]


def test_functions_of_the_catalog_equal_the_columns(spark):
    names = create_functions(spark, "default")
    cases = [("40.00", "70.00", 7000), ("10", "20", 1500), ("10", "12", 2000), ("0", "5", 10), (None, "1", 1), ("1", None, 1), ("1", "3", None), ("30000", "45000.01", 100)]
    frame = spark.createDataFrame([tuple(None if v is None else D(v) for v in c[:2]) + c[2:] for c in cases], "buyprice decimal(10,2), msrp decimal(10,2), quantityinstock int")
    by_text = spark.sql(f"SELECT k.* FROM (SELECT {names[0]}(buyprice, msrp, quantityinstock) AS k FROM {{f}})", f=frame)
    by_column = with_product_kpis(frame).select("profit", "profitpercent", "promoind", "demandind")
    assert by_text.dtypes == by_column.dtypes and by_text.collect() == by_column.collect()
    levels = spark.sql(f"SELECT s, {names[1]}(s) AS level FROM VALUES (-11), (-10), (-2), (0), (2), (10), (11), (NULL) AS t(s)")
    assert levels.select("level").collect() == levels.select(frustration_level(F.col("s"))).collect()
    assert "Python" not in by_text._jdf.queryExecution().executedPlan().toString()
