"""Star tables: split, tolerant projection, renaming, safe casting, metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.functions import safe_cast
from freightloom.operators.projection import select_present, standardise_names
from freightloom.plans.star import star_table
from freightloom.schema import TABLES

from .fixture import flat_orders, line_items, table
from .registry import query
from .sql import FIRST_ROWS, over_flat


def _register_star(name: str) -> None:
    customers = name in ("customer", "location")
    columns = ", ".join(f'"{c}"' for c in TABLES[name].columns)

    @query(f"star_{name}", over_flat(f"SELECT {columns} FROM {FIRST_ROWS[name]}", customers))
    def star(spark, sf_dir):
        return star_table(flat_orders(spark, sf_dir, customers), name)


for _name in TABLES:
    _register_star(_name)


@query(
    "proj_tolerant",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def tolerant(spark, sf_dir):
    return select_present(
        table(spark, sf_dir, "customer"), ["c_custkey", "c_email", "c_name", "c_phone", "c_mktsegment"]
    )


@query(
    "proj_standardize",
    over_flat(
        """SELECT Order_Id, Order_Date, Shipping_date, Days_for_shipping_real,
        Days_for_shipping_scheduled, Sales, Order_Status FROM flat"""
    ),
)
def standardize(spark, sf_dir):
    wanted = [
        "Order Id", "order date (DateOrders)", "shipping date (DateOrders)", "Days for shipping (real)",
        "Days for shipment (scheduled)", "Sales", "Order Status",
    ]
    return standardise_names(flat_orders(spark, sf_dir).select(*[f"`{c}`" for c in wanted]))


_DIRTY = """CASE l_linenumber
    WHEN 1 THEN CAST(l_orderkey AS {text})
    WHEN 2 THEN concat(' ', CAST(l_orderkey AS {text}), ' ')
    WHEN 3 THEN concat(CAST(l_orderkey AS {text}), '.0')
    WHEN 4 THEN concat(CAST(l_orderkey % 10 AS {text}), 'e3')
    WHEN 5 THEN ''
    WHEN 6 THEN concat('no', CAST(l_orderkey AS {text}))
    END"""


@query(
    "proj_safe_cast",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN CAST(trim(raw) AS BIGINT) END AS as_integer,
    CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+([.][0-9]*)?(e[0-9]+)?') THEN CAST(trim(raw) AS DOUBLE) END
        AS as_float,
    raw AS as_text
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, {_DIRTY.format(text='VARCHAR')} AS raw FROM lineitem)""",
)
def safe_casts(spark, sf_dir):
    raw = F.expr(_DIRTY.format(text="STRING"))
    return line_items(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        safe_cast(raw, "bigint").alias("as_integer"),
        safe_cast(raw, "double").alias("as_float"),
        safe_cast(raw, "string").alias("as_text"),
    )


@query(
    "proj_arith",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) AS amount,
    CAST(date_diff('day', o_orderdate, l_shipdate) - CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS BIGINT)
        AS delay_days,
    l_quantity / (l_linenumber + 1) AS per_line
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def arithmetic(spark, sf_dir):
    lines = line_items(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_quantity").cast("decimal(10,0)")
    delay = F.datediff("l_shipdate", "o_orderdate") - F.substring("o_orderpriority", 1, 1).cast("bigint")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        amount.cast("double").alias("amount"),
        delay.cast("bigint").alias("delay_days"),
        (F.col("l_quantity") / (F.col("l_linenumber") + 1)).alias("per_line"),
    )
