"""Analyses the reports describe in words only; the definitions are stated here."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact_avg, exact_sum, parse_order_ts, percent_of, safe_divide, whole_days_between
from ..operators.dedup import key_counts
from ..operators.joins import attach_dimension
from ..operators.limits import top_k
from ..operators.monthly import by_month, previous_value
from ..schema import METADATA_COLUMNS
from .marts import COMPLETED


def shipping_delay() -> Column:
    """Actual minus scheduled shipping days."""
    return F.col("days_for_shipping_real") - F.col("days_for_shipping_scheduled")


def delay_histogram(shipping: DataFrame, bin_days: int = 1) -> DataFrame:
    """Shipments per delay, in bins of ``bin_days`` starting at ``delay_from``."""
    start = (F.floor(shipping_delay() / bin_days) * bin_days).cast("bigint")
    return shipping.groupBy(start.alias("delay_from")).agg(F.count("*").alias("shipments"))


def performance_by_region(orders: DataFrame, departments: DataFrame) -> DataFrame:
    """Orders, sales and mean profit per market and department."""
    per_department = orders.groupBy("department_id").agg(
        F.count("*").alias("orders"),
        exact_sum("order_item_total").alias("total_sales"),
        exact_avg("order_profit_per_order").alias("avg_profit"),
    )
    return attach_dimension(
        per_department, departments, "department_id", ["department_name", "market"]
    ).select("market", "department_name", "orders", "total_sales", "avg_profit")


def monthly_trend(orders: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Monthly sales with the month before and the change against it in percent."""
    monthly = by_month(orders, lenient=lenient_dates).agg(exact_sum("order_item_total").alias("total_sales"))
    trend = previous_value(monthly, "total_sales", "previous_sales")
    change = percent_of(F.col("total_sales") - F.col("previous_sales"), "previous_sales")
    return trend.withColumn("change_percent", change)


def lead_time(
    flat: DataFrame, probabilities: Sequence[float] = (0.5, 0.9), lenient_dates: bool = False
) -> DataFrame:
    """Whole days from order to shipment per shipping mode: count, mean and quantiles.

    ``flat`` holds flat order records under standard names. Days are counted per
    distinct value first; a calendar bounds how many there can be, so the exact
    quantiles work on a small frequency table.
    """
    days = whole_days_between(
        parse_order_ts("Order_Date", lenient_dates), parse_order_ts("Shipping_date", lenient_dates)
    )
    counted = key_counts(
        flat.select(F.col("Shipping_Mode").alias("shipping_mode"), days.alias("days")).filter("days IS NOT NULL"),
        ["shipping_mode", "days"],
    )
    quantiles = [
        F.percentile("days", F.lit(p), F.col("n")).alias(f"p{round(100 * p)}_days") for p in probabilities
    ]
    return counted.groupBy("shipping_mode").agg(
        F.sum("n").alias("shipments"),
        safe_divide(F.sum(F.col("days") * F.col("n")), F.sum("n")).alias("avg_days"),
        *quantiles,
    )


def bottlenecks(shipping: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` shipping modes with the largest mean delay, ranked."""
    delays = shipping.groupBy("shipping_mode").agg(
        safe_divide(F.sum(shipping_delay()), F.count(shipping_delay())).alias("avg_delay_days"),
        F.count("*").alias("shipments"),
    )
    worst = top_k(delays, "avg_delay_days", k, tie_break=["shipping_mode"])
    # At most k rows reach the unpartitioned window.
    position = F.row_number().over(Window.orderBy(F.col("avg_delay_days").desc_nulls_last(), "shipping_mode"))
    return worst.withColumn("position", position.cast("bigint"))


def open_commitments(orders: DataFrame, departments: DataFrame, completed: str = COMPLETED) -> DataFrame:
    """Funds committed on orders that are not completed, per department and market.

    An order without a status counts as open.
    """
    is_open = ~F.col("order_status").eqNullSafe(completed)
    per_department = (
        orders.filter(is_open)
        .groupBy("department_id")
        .agg(exact_sum("order_item_total").alias("open_funds"), F.count("*").alias("open_orders"))
    )
    return attach_dimension(
        per_department, departments, "department_id", ["department_name", "market"]
    ).select("department_name", "market", "open_funds", "open_orders")


def nested_records(df: DataFrame, fields: Sequence[str], data: str = "data", metadata: str = "metadata") -> DataFrame:
    """Flat records from nested ones: the named fields of ``data``, then the metadata."""
    return df.select(
        *[F.col(data)[f].alias(f) for f in fields],
        *[F.col(metadata)[m].alias(m) for m in METADATA_COLUMNS],
    )


def between_dates(
    df: DataFrame, ts: str, start: dt.datetime | str | None = None, end: dt.datetime | str | None = None
) -> DataFrame:
    """Rows with ``start <= ts < end``; on a typed column the filter reaches the scan."""
    kind = df.schema[ts].dataType
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(ts) < F.lit(end).cast(kind))
    return df


def newer_than(df: DataFrame, ts: str, mark: dt.datetime | str | None) -> DataFrame:
    """Rows after a high-water mark; all rows if there is none yet."""
    return df if mark is None else df.filter(F.col(ts) > F.lit(mark).cast(df.schema[ts].dataType))


def not_before(df: DataFrame, ts: str, mark: dt.datetime | str | None) -> DataFrame:
    """Rows at or after a high-water mark and those without a time; all rows if there is no mark yet.

    For runs whose results do not change when a row is read again.
    """
    return df if mark is None else df.filter(F.col(ts).isNull() | (F.col(ts) >= F.lit(mark).cast(df.schema[ts].dataType)))


def high_water_mark(df: DataFrame, ts: str):
    """Newest timestamp, to be kept as the mark of the next incremental run."""
    return df.agg(F.max(ts)).first()[0]


