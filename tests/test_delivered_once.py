"""Deliveries of the checks: joined once, and with the records that a filter on the flat records gives."""

import datetime as dt

import pytest
from checks.deliveries import AGAIN, LATE, deliveries
from checks.fixture import flat_orders
from helpers import plan_of, rows
from pyspark.sql import functions as F

from freightloom.functions import parse_order_ts

CUT = "1998-07-01"
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, None)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "JAPAN", 0), (1, "PERU", 1), (2, None, 0), (3, "LOST", 9)]),
    "supplier": ("s_suppkey bigint, s_nationkey int", [(1, 0), (2, 1), (2, 2), (3, 3), (4, None)]),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(1, "bolt", "B#1", "STEEL", 3, 1.5), (2, None, None, None, None, None)],
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
        [(1, "Customer#01", 0, "AUTO"), (2, None, 1, None), (2, "Customer#02", 2, "TOYS"), (3, "Customer#03", 3, "NONE")],
    ),
}


def day(text):
    return None if text is None else dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    dates = ["1997-03-02", "1997-05-31T23:59:59", "1997-05-01", "1998-06-30T23:59:59", "1998-07-01", "1998-07-01T00:00:30", None, "2000-02-29"]
    orders = [(k, k % 4 + 1 if k % 7 else None, "FOP"[k % 3], day(dates[k % 8]), f"{k % 5}-X") for k in range(1, 41)]
    items = [
        (k % 42, i % 3 + 1 if i else 2, (k + i) % 4 + 1, i, float(i), 10.25 * k, 0.05, 0.02 if k % 9 else None, "ARN"[i % 3], day(dates[(k + i) % 8]))
        for k in range(1, 45) for i in range(3)
    ]
    frames = TABLES | {
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string", [*orders, orders[4]]),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
            [*items, *items[:9]],
        ),
    }
    for name, (schema, values) in frames.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_a_delivery_joins_nothing_when_it_is_read(spark, folder):
    for delivery in deliveries(spark, folder, CUT):
        assert "Join" not in plan_of(delivery)


def test_deliveries_hold_the_records_of_a_filter_on_the_flat_ones(spark, folder):
    flat = flat_orders(spark, folder, customers=True)
    ts = parse_order_ts("order date (DateOrders)")
    month, number = F.date_format(ts, "yyyy-MM"), F.col("Order Id").cast("bigint")
    late = (ts >= F.lit(CUT).cast("timestamp_ntz")) | ((month == LATE) & (number % 2 == 0))
    first, second = deliveries(spark, folder, CUT)
    assert first.columns == second.columns == flat.columns
    assert rows(first) == rows(flat.where(~late)) != []
    assert rows(second) == rows(flat.where(late | (month == AGAIN))) != []


def test_orders_are_joined_last_and_customers_to_the_orders(spark, folder):
    plan = flat_orders(spark, folder, customers=True)._jdf.queryExecution().analyzed().toString()
    joins = [line.split("Join Inner, ")[1] for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "o_orderkey" in joins[0]
    assert any("o_custkey" in j and "c_custkey" in j for j in joins[1:])
