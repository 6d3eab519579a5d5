"""The six business marts, each a function of staging tables.

Rows come out ordered where the report has an order. Order matters on reading
only: a stored table has none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    age_bucket,
    decimal_sum,
    decimal_sum_product,
    exact_avg,
    exact_sum,
    exact_sum_product,
    rounded_ratio,
    safe_divide,
    sum_of_parts,
    whole_days_between,
)
from ..functions.dates import as_of_column
from ..operators.joins import attach_dimension, attach_totals, with_month_name
from ..operators.limits import capped
from ..operators.monthly import MONTH_KEYS, by_month, month_columns, order_time, previous_value, running_total

# Fixed value: the status that counts as fulfilled.
COMPLETED = "COMPLETED"


def monthly_customers(
    orders: DataFrame, lenient_dates: bool = False, relative_error: float | None = None
) -> DataFrame:
    """Distinct customers per month; with ``relative_error`` by sketches, which shuffle no customer ids."""
    counted = (
        F.count_distinct("order_customer_id")
        if relative_error is None
        else F.approx_count_distinct("order_customer_id", relative_error)
    )
    return by_month(orders, lenient=lenient_dates).agg(counted.alias("distinct_customers"))


def customer_retention_rate(
    orders: DataFrame, lenient_dates: bool = False, relative_error: float | None = None
) -> DataFrame:
    """Monthly customers, their running total, and the previous total over the current one.

    The "rate" is a ratio of running totals in which a customer counts again in
    every month, not a cohort retention. The first month is 1.0.
    """
    return retention_report(monthly_customers(orders, lenient_dates, relative_error))


def retention_report(monthly: DataFrame) -> DataFrame:
    """``customer_retention_rate`` from distinct customers per month."""
    totals = running_total(monthly, "distinct_customers", "cumulative_customers")
    # Spark puts both windows, which share their order, into the same single task.
    rows = previous_value(totals, "cumulative_customers", "_previous")
    rate = F.when(F.col("_previous").isNull(), F.lit(1.0)).otherwise(
        F.round(safe_divide("_previous", "cumulative_customers"), 2)
    )
    return (
        with_month_name(rows.withColumn("customer_retention_rate", rate))
        .orderBy(*MONTH_KEYS)
        .select(
            "year", "month_name", "distinct_customers", "cumulative_customers", "customer_retention_rate"
        )
    )


def commitments_by_product(orders: DataFrame, completed: str = COMPLETED) -> DataFrame:
    """Committed funds, completed and total orders per department and product."""
    return orders.groupBy("department_id", "product_card_id").agg(
        exact_sum("order_item_total").alias("total_committed_funds"),
        F.sum(F.when(F.col("order_status") == completed, 1).otherwise(0)).alias("completed_orders"),
        F.count("*").alias("total_orders"),
    )


def financial_commitments(
    orders: DataFrame,
    departments: DataFrame,
    products: DataFrame,
    completed: str = COMPLETED,
    cap: int | None = None,
) -> DataFrame:
    """Committed funds and fulfilment rate per department and product.

    Shown by category, so a (department, market, category) may appear once per
    product. ``cap`` limits each input to its first rows by id.
    """
    per_product = commitments_by_product(capped(orders, cap, ["order_id"]), completed)
    return commitments_report(
        per_product, capped(departments, cap, ["department_id"]), capped(products, cap, ["product_card_id"])
    )


def commitments_report(per_product: DataFrame, departments: DataFrame, products: DataFrame) -> DataFrame:
    """``financial_commitments`` from the figures per department and product."""
    named = attach_dimension(per_product, departments, "department_id", ["department_name", "market"])
    named = attach_dimension(named, products, "product_card_id", ["category_name"])
    return named.select(
        "department_name",
        "market",
        "category_name",
        "total_committed_funds",
        safe_divide("completed_orders", "total_orders").alias("commitment_fulfillment_rate"),
    )


def customer_order_averages(orders: DataFrame) -> DataFrame:
    """Mean order total and number of orders per customer."""
    return orders.groupBy("order_customer_id").agg(
        exact_avg("order_item_total").alias("avg_order_total"), F.count("*").alias("num_orders")
    )


def fraud_detection(orders: DataFrame) -> DataFrame:
    """Customers by mean order total, largest first, to screen for anomalies."""
    return largest_averages_first(customer_order_averages(orders))


def largest_averages_first(averages: DataFrame) -> DataFrame:
    """The reading order of the fraud report; a stored table has none."""
    return averages.orderBy(F.col("avg_order_total").desc_nulls_last(), "order_customer_id")


def inventory_by_age(
    orders: DataFrame,
    as_of: Column | dt.datetime | str | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """Unrounded inventory sums per month and age range of the order date.

    Amounts come as double and, in ``*_exact``, as decimal where a decimal holds them.
    """
    orders = orders.withColumn("_ts", order_time(orders, lenient=lenient_dates))
    return orders.groupBy(*month_columns("_ts"), age_range("_ts", as_of)).agg(*inventory_sums())


def age_range(ts: Column | str, as_of: Column | dt.datetime | str | None = None) -> Column:
    """Age range of a time at ``as_of``."""
    return age_bucket(whole_days_between(ts, as_of_column(as_of))).alias("age_range")


def inventory_sums() -> list[Column]:
    """Aggregates of the inventory report over orders, to be added up further."""
    return [
        exact_sum_product("order_item_product_price", "order_item_quantity").alias("value"),
        decimal_sum_product("order_item_product_price", "order_item_quantity").alias("value_exact"),
        exact_sum("order_item_total").alias("sales"),
        decimal_sum("order_item_total").alias("sales_exact"),
        F.sum("order_item_quantity").alias("quantity"),
        F.count("order_item_quantity").alias("quantities"),
    ]


def inventory_levels(
    orders: DataFrame,
    as_of: Column | dt.datetime | str | None = None,
    lenient_dates: bool = False,
) -> DataFrame:
    """Inventory value, turnover and ageing; one row per month and age range.

    Orders are aggregated once, by month and age range. The monthly figures are
    added up from those few rows and rounded last. ``as_of`` defaults to now.
    """
    return inventory_report(inventory_by_age(orders, as_of, lenient_dates))


def inventory_report(by_age: DataFrame) -> DataFrame:
    """``inventory_levels`` from the sums per month and age range."""
    _, value = sum_of_parts("value_exact", "value")
    sales_exact, sales = sum_of_parts("sales_exact", "sales")
    # Sales over mean quantity, as one division; of doubles where a decimal has no room for the product.
    counted = F.sum("quantities")
    product = sales_exact.try_cast("decimal(24,8)") * counted.cast("decimal(13,0)")
    turnover = F.coalesce(
        rounded_ratio(product, F.sum("quantity"), 2),
        F.round(safe_divide(sales * counted.cast("double"), F.sum("quantity").cast("double")), 2),
    )
    per_month = (
        by_age.groupBy(*MONTH_KEYS)
        .agg(
            F.round(value, 2).alias("total_inventory_value"),
            turnover.alias("inventory_turnover_ratio"),
            # At most one entry per age range.
            F.collect_list(F.struct("age_range", F.round("value", 2).alias("inventory_value"))).alias("ages"),
        )
    )
    rows = per_month.select(
        *MONTH_KEYS, "total_inventory_value", "inventory_turnover_ratio", F.inline("ages")
    )
    return (
        with_month_name(rows)
        .orderBy(*MONTH_KEYS, "age_range")
        .select(
            "year",
            "month_name",
            "total_inventory_value",
            "inventory_turnover_ratio",
            "age_range",
            "inventory_value",
        )
    )


def shipment_averages(shipping: DataFrame) -> DataFrame:
    """One row: mean actual and scheduled shipping days over all shipments."""
    return shipping.agg(
        F.round(_mean_days("days_for_shipping_real"), 2).alias("avg_actual_shipment_days"),
        F.round(_mean_days("days_for_shipping_scheduled"), 2).alias("avg_scheduled_shipment_days"),
    )


def _mean_days(days: Column | str) -> Column:
    """Aggregate: mean of whole days; an integer sum is exact."""
    return safe_divide(F.sum(days), F.count(days))


def overall_performance(orders: DataFrame, shipping: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Monthly sales and mean profit, beside the shipping averages of all time.

    ``avg_profit_margin`` is the mean profit per order, not a ratio.
    """
    return performance_report(monthly_performance(orders, lenient_dates), shipment_averages(shipping))


def monthly_performance(orders: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Sales and mean profit per month."""
    return by_month(orders, lenient=lenient_dates).agg(
        F.round(exact_sum("order_item_total"), 2).alias("total_sales"),
        exact_avg("order_profit_per_order", digits=2).alias("avg_profit_margin"),
    )


def performance_report(monthly: DataFrame, averages: DataFrame) -> DataFrame:
    """``overall_performance`` from monthly figures and the one row of shipping averages."""
    return (
        attach_totals(with_month_name(monthly), averages)
        .orderBy(*MONTH_KEYS)
        .select(
            "year",
            "month_name",
            "total_sales",
            "avg_profit_margin",
            "avg_actual_shipment_days",
            "avg_scheduled_shipment_days",
        )
    )


def payment_delays(shipping: DataFrame) -> DataFrame:
    """Mean shipping delay and count per delivery status.

    The "payment delay" is actual minus scheduled shipping days, over shipments
    that are unique by date and mode.
    """
    delay = F.col("days_for_shipping_real") - F.col("days_for_shipping_scheduled")
    return shipping.groupBy("delivery_status").agg(
        _mean_days(delay).alias("avg_payment_delay"), F.count("*").alias("count_of_orders")
    )


def build_marts(
    staged: dict[str, DataFrame],
    as_of: Column | dt.datetime | str | None = None,
    cap: int | None = None,
    completed: str = COMPLETED,
    lenient_dates: bool = False,
) -> dict[str, DataFrame]:
    """All six marts by name, from staging tables by name, to be stored.

    The fraud report is left unordered, as sorting all customers for a table is
    wasted; ``largest_averages_first`` orders it on reading.
    """
    orders, shipping = staged["order"], staged["shipping"]
    return {
        "customer_retention_rate": customer_retention_rate(orders, lenient_dates),
        "financial_commitments": financial_commitments(
            orders, staged["department"], staged["product"], completed, cap
        ),
        "fraud_detection": customer_order_averages(orders),
        "inventory_levels": inventory_levels(orders, as_of, lenient_dates),
        "overall_performance": overall_performance(orders, shipping, lenient_dates),
        "payment_delays": payment_delays(shipping),
    }
