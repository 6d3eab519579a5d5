"""The analyses that the reports describe in words."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.operators.projection import standardise_names
from freightloom.plans import analyses
from freightloom.schema import METADATA_COLUMNS, TABLES

from .fixture import flat_orders, named_orders, staged, table
from .registry import query
from .sql import money_avg, money_sum, month_of, over_flat, over_staged, parsed, year_of

DELAY = "(days_for_shipping_real - days_for_shipping_scheduled)"


@query(
    "doc_delay_histogram",
    over_staged(
        f"""SELECT CAST(floor({DELAY} / 7.0) * 7 AS BIGINT) AS delay_from, COUNT(*) AS shipments
        FROM stg_shipping GROUP BY ALL""",
        "shipping",
    ),
)
def delay_histogram(spark, sf_dir):
    return analyses.delay_histogram(staged(spark, sf_dir, "shipping"), bin_days=7)


@query(
    "doc_performance_by_region",
    over_staged(
        f"""SELECT market, department_name, COUNT(*) AS orders, {money_sum('order_item_total')} AS total_sales,
        {money_avg('order_profit_per_order')} AS avg_profit
        FROM stg_order JOIN stg_department USING (department_id) GROUP BY department_id, market, department_name""",
        "order",
        "department",
    ),
)
def performance_by_region(spark, sf_dir):
    return analyses.performance_by_region(staged(spark, sf_dir, "order"), staged(spark, sf_dir, "department"))


@query(
    "doc_monthly_trend",
    over_staged(
        """SELECT year, month, total_sales, previous_sales,
        ROUND(CAST(total_sales - previous_sales AS DOUBLE) / previous_sales * 100, 2) AS change_percent
        FROM (SELECT *, LAG(total_sales) OVER (ORDER BY year NULLS FIRST, month NULLS FIRST) AS previous_sales
              FROM monthly)""",
        "order",
        monthly=f"""SELECT {year_of('order_date')} AS year, {month_of('order_date')} AS month,
            {money_sum('order_item_total')} AS total_sales FROM stg_order GROUP BY ALL""",
    ),
)
def monthly_trend(spark, sf_dir):
    return analyses.monthly_trend(staged(spark, sf_dir, "order"))


@query(
    "doc_lead_time",
    over_flat(
        f"""SELECT Shipping_Mode AS shipping_mode, COUNT(*) AS shipments,
        CAST(SUM(days) AS DOUBLE) / COUNT(*) AS avg_days,
        CAST(quantile_cont(days, 0.5) AS DOUBLE) AS p50_days,
        CAST(quantile_cont(days, 0.9) AS DOUBLE) AS p90_days
        FROM (SELECT Shipping_Mode, date_sub('day', {parsed('Order_Date')}, {parsed('Shipping_date')}) AS days
              FROM flat) GROUP BY ALL"""
    ),
)
def lead_time(spark, sf_dir):
    return analyses.lead_time(named_orders(spark, sf_dir))


@query(
    "doc_bottleneck",
    over_staged(
        f"""SELECT shipping_mode, CAST(SUM({DELAY}) AS DOUBLE) / COUNT({DELAY}) AS avg_delay_days,
        COUNT(*) AS shipments,
        row_number() OVER (ORDER BY CAST(SUM({DELAY}) AS DOUBLE) / COUNT({DELAY}) DESC, shipping_mode) AS position
        FROM stg_shipping GROUP BY shipping_mode QUALIFY position <= 10""",
        "shipping",
    ),
)
def bottleneck(spark, sf_dir):
    return analyses.bottlenecks(staged(spark, sf_dir, "shipping"))


@query(
    "doc_open_commitments",
    over_staged(
        f"""SELECT department_name, market, {money_sum('order_item_total')} AS open_funds,
        COUNT(*) AS open_orders FROM stg_order JOIN stg_department USING (department_id)
        WHERE order_status IS DISTINCT FROM 'COMPLETED' GROUP BY department_id, department_name, market""",
        "order",
        "department",
    ),
)
def open_commitments(spark, sf_dir):
    return analyses.open_commitments(staged(spark, sf_dir, "order"), staged(spark, sf_dir, "department"))


@query(
    "doc_nested_extract",
    over_flat(
        """SELECT Order_Id, Order_Status, Sales, "key", "offset", "partition", "time", topic FROM flat"""
    ),
)
def nested_extract(spark, sf_dir):
    flat = flat_orders(spark, sf_dir)
    fields = [c for c in TABLES["order"].raw_columns]
    entries = [part for c in fields for part in (F.lit(c), F.col(f"`{c}`"))]
    nested = flat.select(
        F.create_map(*entries).alias("data"), F.struct(*METADATA_COLUMNS).alias("metadata")
    )
    return standardise_names(analyses.nested_records(nested, ["Order Id", "Order Status", "Sales"]))


@query(
    "doc_incremental_filter",
    """SELECT o_orderstatus, COUNT(*) AS n_orders, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    GROUP BY ALL""",
)
def incremental_filter(spark, sf_dir):
    """The date range reaches the Parquet scan as a pushed filter."""
    orders = analyses.between_dates(table(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01", "2000-01-01")
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )
