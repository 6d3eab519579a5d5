import math

import pytest
from pyspark.sql import functions as F

from freightloom.functions import exact_avg, exact_sum, exact_sum_product, rounded_ratio
from freightloom.plans import marts


def one(spark, values, aggregate):
    return spark.createDataFrame([(v,) for v in values], "v double").agg(aggregate.alias("x")).first().x


@pytest.mark.parametrize(
    "values, want",
    [
        ([1e-9, 3e-9], 4e-9), ([0.1] * 10, 1.0), ([None], None), ([1e15, 0.25, -1e15], 0.25), ([math.inf, 1.0], math.inf),
        ([1e16, 1.0], 1e16 + 1.0), ([9.99e15] * 20_000, 9.99e15 * 20_000), ([1.0, None, 2.0], 3.0), ([], None),
    ],
)
def test_sums(spark, values, want):
    found = one(spark, values, exact_sum("v"))
    assert found is None if want is None else found == pytest.approx(want, rel=1e-15)


def test_nan_stays(spark):
    assert math.isnan(one(spark, [math.nan, 1.0], exact_sum("v")))


def test_mean_of_small_values(spark):
    assert one(spark, [1e-9, 3e-9], exact_avg("v")) == pytest.approx(2e-9, rel=1e-15)
    assert one(spark, [70911.24] + [0.0] * 23, exact_avg("v", 3)) == 2954.635


def test_decimal_column_that_overflows(spark):
    df = spark.range(40).select(F.lit("9999999999999999").cast("decimal(38,8)").alias("v"))
    assert df.agg(exact_sum("v").alias("x")).first().x == pytest.approx(40 * 9999999999999999.0)


def test_products_keep_fractions(spark):
    df = spark.createDataFrame([(10.0, 2.5), (10.0, 0.4)], "a double, b double")
    assert df.agg(exact_sum_product("a", "b").alias("x")).first().x == 29.0
    odd = spark.createDataFrame([(10.0, 1 / 3), (None, 1.0)], "a double, b double")
    assert odd.agg(exact_sum_product("a", "b").alias("x")).first().x == pytest.approx(10 / 3)


def test_ratio_of_small_amounts(spark):
    row = spark.range(1).select(rounded_ratio(F.lit(4e-9), F.lit(2), 9).alias("x")).first()
    assert row.x == 2e-9


@pytest.mark.parametrize("total", [1e16, 3e17, math.inf])
def test_turnover_of_large_months(spark, total):
    orders = spark.createDataFrame(
        [("1/1/2020 1:00", 5.0, 2, total), ("1/2/2020 1:00", 5.0, 2, 0.25), ("3/2/2020 1:00", 5.0, 4, 8.1)],
        "order_date string, order_item_product_price double, order_item_quantity bigint, order_item_total double",
    )
    found = marts.inventory_levels(orders, as_of="2020-06-01 00:00:00").collect()
    by_month = {r.month_name: r for r in found}
    assert by_month["January"].inventory_turnover_ratio == pytest.approx((total + 0.25) / 2)
    assert by_month["March"].inventory_turnover_ratio == 2.03


def test_cents_survive_two_levels(spark):
    orders = spark.createDataFrame(
        [("1/1/2020 1:00", 100_000_000_000_000.0, 1, 1.0), ("1/1/2020 1:00", 0.01, 1, 1.0), ("1/28/2020 1:00", 100_000_000_000_000.0, 1, 1.0),
         ("1/28/2020 1:00", 0.01, 1, 1.0)],
        "order_date string, order_item_product_price double, order_item_quantity bigint, order_item_total double",
    )
    found = marts.inventory_levels(orders, as_of="2020-02-15 00:00:00").collect()
    assert {r.total_inventory_value for r in found} == {200_000_000_000_000.02}
