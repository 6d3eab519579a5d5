import datetime as dt
import math

import pytest
from helpers import plan_of, rows
from pyspark.errors import PySparkException

from freightloom.plans import analyses, marts
from freightloom.plans.staging import stage, with_order_ts
from freightloom.schema import MART_SCHEMAS, TABLES


def orders_frame(spark, records):
    """Staged orders; columns not given are NULL."""
    names = TABLES["order"].staged_schema.fieldNames()
    return spark.createDataFrame(
        [tuple(r.get(n) for n in names) for r in records], TABLES["order"].staged_schema
    )


def shipping_frame(spark, records):
    return spark.createDataFrame(records, TABLES["shipping"].staged_schema)


def test_retention_counts_customers_again_each_month(spark):
    orders = orders_frame(spark, [
        {"order_id": 1, "order_date": "1/5/2018 9:03", "order_customer_id": 10},
        {"order_id": 2, "order_date": "1/6/2018 9:03", "order_customer_id": 10},
        {"order_id": 3, "order_date": "2/1/2018 0:00", "order_customer_id": 10},
        {"order_id": 4, "order_date": "2/2/2018 0:00", "order_customer_id": 11},
        {"order_id": 5, "order_date": None, "order_customer_id": 12},
    ])
    # The order without a date sorts first, so it feeds the running total, and drops out of the join.
    assert [tuple(r) for r in marts.customer_retention_rate(orders).collect()] == [
        (2018, "January", 1, 2, 0.5), (2018, "February", 2, 4, 0.5),
    ]


def test_retention_starts_at_one_and_guards_zero(spark):
    orders = orders_frame(spark, [
        {"order_id": 1, "order_date": "1/5/2018 9:03", "order_customer_id": None},
        {"order_id": 2, "order_date": "2/5/2018 9:03", "order_customer_id": None},
    ])
    assert [tuple(r) for r in marts.customer_retention_rate(orders).collect()] == [
        (2018, "January", 0, 0, 1.0), (2018, "February", 0, 0, None),
    ]


def test_unreadable_dates_fail_unless_lenient(spark):
    orders = orders_frame(spark, [{"order_id": 1, "order_date": "2018-01-05", "order_customer_id": 1}])
    with pytest.raises(PySparkException, match="not an order date"):
        marts.customer_retention_rate(orders).collect()
    assert marts.customer_retention_rate(orders, lenient_dates=True).count() == 0


DEPARTMENTS = [(1, "Fan Shop", "EU"), (2, "Apparel", "LATAM")]
PRODUCTS = [(7, 70, "Balls", None, None, "ball", 1.0, "0"), (8, 70, "Balls", None, None, "bat", 1.0, "0")]
COMMITTED = [
    {"order_id": 1, "department_id": 1, "product_card_id": 7, "order_item_total": 10.5, "order_status": "COMPLETED"},
    {"order_id": 2, "department_id": 1, "product_card_id": 7, "order_item_total": 1.5, "order_status": "completed"},
    {"order_id": 3, "department_id": 1, "product_card_id": 8, "order_item_total": 2.0, "order_status": None},
    {"order_id": 4, "department_id": None, "product_card_id": 8, "order_item_total": 2.0, "order_status": None},
    {"order_id": 5, "department_id": 9, "product_card_id": 8, "order_item_total": 2.0, "order_status": None},
]


def dimensions(spark):
    return (
        spark.createDataFrame(DEPARTMENTS, TABLES["department"].staged_schema),
        spark.createDataFrame(PRODUCTS, TABLES["product"].staged_schema),
    )


def test_commitments_repeat_categories_and_drop_unknown_departments(spark):
    mart = marts.financial_commitments(orders_frame(spark, COMMITTED), *dimensions(spark))
    assert rows(mart) == [("Fan Shop", "EU", "Balls", 12.0, 0.5), ("Fan Shop", "EU", "Balls", 2.0, 0.0)]


def test_commitments_cap_and_status(spark):
    mart = marts.financial_commitments(
        orders_frame(spark, COMMITTED), *dimensions(spark), completed="completed", cap=2
    )
    assert rows(mart) == [("Fan Shop", "EU", "Balls", 12.0, 0.5)]


def test_open_commitments_count_missing_status_as_open(spark):
    found = analyses.open_commitments(orders_frame(spark, COMMITTED), dimensions(spark)[0])
    assert rows(found) == [("Fan Shop", "EU", 3.5, 2)]


def test_fraud_orders_by_average(spark):
    orders = orders_frame(spark, [
        {"order_id": 1, "order_customer_id": 1, "order_item_total": 1.0},
        {"order_id": 2, "order_customer_id": 2, "order_item_total": 5.0},
        {"order_id": 3, "order_customer_id": 2, "order_item_total": 4.0},
        {"order_id": 4, "order_customer_id": None, "order_item_total": None},
    ])
    assert [tuple(r) for r in marts.fraud_detection(orders).collect()] == [(2, 4.5, 2), (1, 1.0, 1), (None, None, 1)]


def test_inventory_buckets_future_and_missing_dates(spark):
    as_of = dt.datetime(2020, 6, 30, 12, 0)
    dates = {
        "6/30/2020 12:00": "0-30 days", "5/31/2020 12:00": "0-30 days", "5/30/2020 13:00": "0-30 days",
        "5/30/2020 12:00": "31-60 days", "5/1/2020 12:00": "31-60 days", "4/30/2020 12:00": "61-90 days",
        "4/1/2020 12:00": "61-90 days", "3/31/2020 12:00": "Over 90 days", "8/1/2020 0:00": "0-30 days",
    }
    orders = orders_frame(spark, [
        {"order_id": i, "order_date": d, "order_item_product_price": 1.5, "order_item_quantity": 2,
         "order_item_total": 3.0}
        for i, d in enumerate([*dates, None])
    ])
    mart = marts.inventory_levels(orders, as_of=as_of)
    found = [(r.month_name, r.age_range, r.inventory_value, r.total_inventory_value) for r in mart.collect()]
    assert found == [
        ("March", "Over 90 days", 3.0, 3.0),
        ("April", "61-90 days", 6.0, 6.0),
        ("May", "0-30 days", 6.0, 12.0),
        ("May", "31-60 days", 6.0, 12.0),
        ("June", "0-30 days", 3.0, 3.0),
        ("August", "0-30 days", 3.0, 3.0),
    ]
    assert {r.inventory_turnover_ratio for r in mart.collect() if r.month_name == "May"} == {6.0}


def test_turnover_guards_zero_quantity(spark):
    orders = orders_frame(spark, [
        {"order_id": 1, "order_date": "1/1/2020 0:00", "order_item_product_price": 1.0, "order_item_quantity": 0,
         "order_item_total": 3.0},
    ])
    row = marts.inventory_levels(orders, as_of="2020-01-02 00:00:00").first()
    assert row.inventory_turnover_ratio is None and row.inventory_value == 0.0


def test_performance_repeats_global_shipping_averages(spark):
    orders = orders_frame(spark, [
        {"order_id": 1, "order_date": "1/1/2020 0:00", "order_item_total": 1.005, "order_profit_per_order": 2.0},
        {"order_id": 2, "order_date": "2/1/2020 0:00", "order_item_total": 2.0, "order_profit_per_order": 1.0},
    ])
    shipping = shipping_frame(spark, [("a", 3, 4, "x", "Late"), ("b", 4, 4, "y", "Late"), ("c", None, 4, "z", "On")])
    assert [tuple(r) for r in marts.overall_performance(orders, shipping).collect()] == [
        (2020, "January", 1.01, 2.0, 3.5, 4.0), (2020, "February", 2.0, 1.0, 3.5, 4.0),
    ]


def test_payment_delays_skip_unknown_days_in_the_mean(spark):
    shipping = shipping_frame(spark, [("a", 3, 4, "x", "Late"), ("b", 6, 4, "y", "Late"), ("c", None, 4, "z", "Late")])
    assert rows(marts.payment_delays(shipping)) == [("Late", 0.5, 3)]


def test_mart_schemas_match_their_contract(spark):
    orders, shipping = orders_frame(spark, []), shipping_frame(spark, [])
    departments, products = dimensions(spark)
    built = marts.build_marts(
        {"order": orders, "shipping": shipping, "department": departments, "product": products}
    )
    for name, contract in MART_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in built[name].schema] == [(f.name, f.dataType) for f in contract], name


def test_staging_types(spark):
    flat = spark.createDataFrame([("1", "x")], "`Department Id` string, Market string")
    with pytest.raises(Exception, match="Department_Name"):
        stage(flat, "department").collect()


def test_staging_a_unique_table_needs_no_shuffle(spark):
    departments = spark.createDataFrame(
        [("1", "Fan Shop", "EU")], "Department_Id string, Department_Name string, Market string"
    )
    staged = stage(departments, "department", unique=True)
    assert rows(staged) == [(1, "Fan Shop", "EU")] and "Exchange" not in plan_of(staged)


def test_typed_order_ts(spark):
    typed = with_order_ts(orders_frame(spark, [{"order_id": 1, "order_date": "3/4/2019 5:06"}]))
    assert typed.select("order_ts", "order_year", "order_month").first() == (dt.datetime(2019, 3, 4, 5, 6), 2019, 3)


def test_delay_histogram_bins_negative_delays(spark):
    shipping = shipping_frame(spark, [("a", 1, 4, "x", ""), ("b", 4, 4, "x", ""), ("c", 9, 4, "x", "")])
    assert rows(analyses.delay_histogram(shipping, bin_days=5)) == [(-5, 1), (0, 1), (5, 1)]


def test_bottlenecks_are_ranked(spark):
    shipping = shipping_frame(spark, [("a", 9, 4, "slow", ""), ("b", 4, 4, "fast", ""), ("c", 9, 4, "also", "")])
    assert rows(analyses.bottlenecks(shipping, k=2)) == [("also", 5.0, 1, 1), ("slow", 5.0, 1, 2)]


def test_lead_time_quantiles(spark):
    flat = spark.createDataFrame(
        [("x", "1/1/2020 0:00", f"1/{1 + d}/2020 0:00") for d in (1, 1, 2, 5, 9)] + [("y", None, "1/1/2020 0:00")],
        "Shipping_Mode string, Order_Date string, Shipping_date string",
    )
    (row,) = rows(analyses.lead_time(flat))
    assert row[:4] == ("x", 5, 3.6, 2.0) and math.isclose(row[4], 7.4)


def test_incremental_filters(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(id) AS ts FROM range(10)")
    mark = analyses.high_water_mark(df.limit(5), "ts")
    assert analyses.newer_than(df, "ts", mark).count() == 5
    assert analyses.newer_than(df, "ts", None).count() == 10
    assert analyses.between_dates(df, "ts", "2020-01-02", dt.datetime(2020, 1, 5)).count() == 3


def test_no_mart_uses_python_or_a_cartesian_product(spark):
    departments, products = dimensions(spark)
    built = marts.build_marts({
        "order": orders_frame(spark, COMMITTED), "shipping": shipping_frame(spark, []),
        "department": departments, "product": products,
    })
    for name, mart in built.items():
        plan = plan_of(mart)
        assert not any(word in plan for word in ("Python", "Cartesian", "NestedLoop")), name
