"""Sources and sinks: what is written must read back the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.operators import quality
from freightloom.plans.star import split_star
from freightloom.schema import TABLES, all_text, struct_of
from freightloom.session import scratch_dir
from freightloom.sources import (
    decode_messages,
    encode_messages,
    load_full_refresh,
    read_csv_inferred,
    read_csv_strings,
    read_parquet_glob,
    register_json_table,
    write_tables,
)

from .fixture import flat_orders, landed_orders, line_items, table
from .registry import query
from .sql import FIRST_ROWS, over_flat

ORDER_TEXT_SQL = """SELECT CAST(o_orderkey AS {key}) AS "Order Id", CAST(o_custkey AS {key}) AS "Customer Id",
    o_orderstatus AS "Order Status", CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS {amount}) AS "Sales",
    strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS "order date (DateOrders)",
    'priority "' || o_orderpriority || '", as given' AS "Remark" FROM orders"""


def order_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order Id"),
        F.col("o_custkey").cast("string").alias("Customer Id"),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("Sales"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("order date (DateOrders)"),
        F.concat(F.lit('priority "'), "o_orderpriority", F.lit('", as given')).alias("Remark"),
    )


def _order_csv(spark, sf_dir) -> str:
    path = scratch_dir(spark, "orders-csv")
    order_texts(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return path


@query("src_csv_strings", ORDER_TEXT_SQL.format(key="VARCHAR", amount="VARCHAR"))
def csv_strings(spark, sf_dir):
    return read_csv_strings(spark, _order_csv(spark, sf_dir))


@query("src_csv_inferred", ORDER_TEXT_SQL.format(key="BIGINT", amount="DOUBLE"))
def csv_inferred(spark, sf_dir):
    return read_csv_inferred(spark, _order_csv(spark, sf_dir))


@query(
    "src_parquet_scan",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
)
def parquet_scan(spark, sf_dir):
    return read_parquet_glob(spark, f"{sf_dir}/orders*.parquet").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )


EVENT_KIND = struct_of(
    {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
        "props": "string",
    }
)
EVENT_TOTALS = """SELECT event_type, COUNT(*) AS n_events, MIN(event_id) AS first_event, MAX(event_id) AS last_event,
    COUNT(DISTINCT user_id) AS users, {newest} AS newest,
    CAST(SUM(CAST(value AS DECIMAL(14,2))) AS DOUBLE) AS total FROM {table} GROUP BY event_type"""


@query(
    "src_json_table",
    EVENT_TOTALS.format(table="events", newest="strftime(MAX(ts), '%Y-%m-%d %H:%M:%S')"),
)
def json_table(spark, sf_dir):
    path = scratch_dir(spark, "events-json")
    table(spark, sf_dir, "events").select(*EVENT_KIND.fieldNames()).write.json(path)
    name = f"landed_events_{uuid.uuid4().hex}"
    register_json_table(spark, name, path, EVENT_KIND)
    newest = "date_format(MAX(ts), 'yyyy-MM-dd HH:mm:ss')"
    return spark.sql(EVENT_TOTALS.format(table=name, newest=newest))


@query(
    "json_encode_orders",
    over_flat(
        """SELECT Order_Id AS message_key, Order_Id, Order_Date, Order_Status, Sales, Order_Item_Total
        FROM flat"""
    ),
)
def json_encode(spark, sf_dir):
    """Encoded, then decoded again: the JSON text itself may differ between engines."""
    order_columns = TABLES["order"].raw_columns
    messages = encode_messages(flat_orders(spark, sf_dir), columns=order_columns)
    decoded = decode_messages(messages, all_text(order_columns))
    return decoded.select(
        F.col("key").alias("message_key"),
        F.col("`Order Id`").alias("Order_Id"),
        F.col("`order date (DateOrders)`").alias("Order_Date"),
        F.col("`Order Status`").alias("Order_Status"),
        "Sales",
        F.col("`Order Item Total`").alias("Order_Item_Total"),
    )


@query(
    "json_decode_events",
    "SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k FROM events",
)
def json_decode(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.col("event_type").alias("topic"),
    )
    return decode_messages(messages, struct_of({"k": "bigint"})).select(
        F.col("key").cast("bigint").alias("event_id"), F.col("topic").alias("event_type"), "k"
    )


#: Records for which a further file is written.
FILE_ROWS = 500_000

STAR_SIZES = {
    "customer": "COUNT(DISTINCT Customer_Id)",
    "product": "COUNT(DISTINCT Product_Card_Id)",
    "location": "COUNT(DISTINCT Order_Zipcode)",
    "order": "COUNT(DISTINCT Order_Id)",
    "shipping": "COUNT(DISTINCT (Shipping_date, Shipping_Mode))",
    "department": "COUNT(DISTINCT Department_Id)",
    "metadata": 'COUNT(DISTINCT "key")',
}


@query(
    "sink_star_roundtrip",
    over_flat(
        'SELECT Order_Id, Order_Date, Order_Customer_Id, Order_Item_Id, Product_Card_Id, Order_Item_Discount, '
        'Order_Item_Discount_Rate, Order_Item_Product_Price, Order_Item_Profit_Ratio, Order_Item_Quantity, '
        'Sales_per_customer, Sales, Order_Item_Total, Order_Profit_Per_Order, Order_Status, Department_Id '
        f"FROM {FIRST_ROWS['order']}"
    ),
)
def star_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "star")
    # Four files a table, and more for input beyond that.
    files = max(4, -(-line_items(spark, sf_dir).count() // FILE_ROWS))
    write_tables(split_star(landed_orders(spark, sf_dir)), path, partitions=files)
    return spark.read.parquet(f"{path}/order_fact")


@query(
    "load_full_refresh",
    over_flat(
        " UNION ALL ".join(
            f"SELECT '{TABLES[name].warehouse_name}' AS table_name, {size} AS n_rows FROM flat"
            for name, size in STAR_SIZES.items()
        ),
        customers=True,
    ),
)
def full_refresh(spark, sf_dir):
    """Loaded twice: the second load must replace the first."""
    path, database = scratch_dir(spark, "star"), f"freight_{uuid.uuid4().hex}"
    write_tables(split_star(landed_orders(spark, sf_dir, customers=True)), path)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    load_full_refresh(spark, path, database)
    load_full_refresh(spark, path, database)
    return quality.row_counts(
        {s.warehouse_name: spark.table(f"{database}.{s.warehouse_name}") for s in TABLES.values()}
    )
