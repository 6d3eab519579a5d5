"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.functions import (
    age_bucket,
    batch_tag,
    parse_order_ts,
    percent_of,
    safe_divide,
    whole_days_between,
)
from freightloom.functions.dates import ORDER_TS_OUTPUT_PATTERN, as_of_column
from freightloom.operators.monthly import month_columns

from .fixture import AS_OF, table
from .registry import query
from .sql import AS_OF as SQL_AS_OF
from .sql import AGE_RANGE, rounded_ratio

ISO = "yyyy-MM-dd HH:mm:ss"


@query(
    "fn_parse_timestamp",
    """SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS unpadded,
    strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS padded,
    CASE WHEN event_id % 2 = 0 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END AS lenient
    FROM events""",
)
def parse_timestamp(spark, sf_dir):
    unpadded = F.date_format("ts", ORDER_TS_OUTPUT_PATTERN)
    padded = F.date_format("ts", "MM/dd/yyyy HH:mm")
    mixed = F.when(F.col("event_id") % 2 == 0, padded).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(parse_order_ts(unpadded), ISO).alias("unpadded"),
        F.date_format(parse_order_ts(padded), ISO).alias("padded"),
        F.date_format(parse_order_ts(mixed, lenient=True), ISO).alias("lenient"),
    )


@query(
    "fn_extract",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month
    FROM orders""",
)
def extract(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *month_columns("o_orderdate"))


@query(
    "fn_date_trunc",
    """SELECT event_id, strftime(date_trunc('year', ts), '%Y-%m-%d %H:%M:%S') AS year_start,
    strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S') AS month_start,
    CAST(month(ts) AS BIGINT) AS month FROM events""",
)
def date_trunc(spark, sf_dir):
    month_start = F.date_trunc("month", "ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(F.date_trunc("year", "ts"), ISO).alias("year_start"),
        F.date_format(month_start, ISO).alias("month_start"),
        F.month(month_start).cast("bigint").alias("month"),
    )


@query(
    "fn_timestamp_diff",
    """SELECT event_id, date_sub('day', ts, TIMESTAMP '2024-01-15 12:00:00') AS days_until,
    date_sub('day', TIMESTAMP '2024-01-15 12:00:00', ts) AS days_since FROM events""",
)
def timestamp_diff(spark, sf_dir):
    noon = as_of_column("2024-01-15 12:00:00")
    return table(spark, sf_dir, "events").select(
        "event_id",
        whole_days_between("ts", noon).alias("days_until"),
        whole_days_between(noon, F.col("ts")).alias("days_since"),
    )


@query(
    "fn_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(3,2)), 2) AS DOUBLE) AS half_up,
    ROUND(l_quantity / 8, 2) AS eighths FROM lineitem""",
)
def rounding(spark, sf_dir):
    tax = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(3,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.round(tax.cast("double"), 2).alias("half_up"),
        F.round(F.col("l_quantity") / 8, 2).alias("eighths"),
    )


@query(
    "fn_safe_divide",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_quantity / NULLIF(l_linenumber - 1, 0) AS ratio,
    {rounded_ratio('l_linenumber * 100', '7')} AS percent FROM lineitem""",
)
def safe_division(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        safe_divide("l_quantity", F.col("l_linenumber") - 1).alias("ratio"),
        percent_of("l_linenumber", F.lit(7)).alias("percent"),
    )


@query(
    "fn_case_bucket",
    f"""SELECT o_orderkey, {AGE_RANGE} AS age_range
    FROM (SELECT o_orderkey, date_sub('day', o_orderdate, {SQL_AS_OF}) AS age FROM orders)""",
)
def case_bucket(spark, sf_dir):
    age = whole_days_between("o_orderdate", as_of_column(AS_OF))
    return table(spark, sf_dir, "orders").select("o_orderkey", age_bucket(age).alias("age_range"))


@query("fn_batch_tag", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS batch_tag FROM events")
def tag(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", batch_tag("ts").alias("batch_tag"))
