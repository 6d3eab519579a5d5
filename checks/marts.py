"""The six marts over the flat records."""

from __future__ import annotations

from freightloom.plans import marts

from .fixture import AS_OF, staged
from .registry import query
from .sql import AS_OF as SQL_AS_OF
from .sql import (
    AGE_RANGE,
    money,
    money_avg,
    money_sum,
    money_units,
    month_of,
    over_staged,
    parsed,
    rounded_ratio,
    year_of,
)

YEAR, MONTH = year_of("order_date"), month_of("order_date")


@query(
    "mart_customer_retention_rate",
    over_staged(
        """SELECT year, month_name, distinct_customers, cumulative_customers,
        CASE WHEN previous IS NULL THEN 1.0::DOUBLE
             ELSE """
        + rounded_ratio("previous", "cumulative_customers")
        + """ END AS customer_retention_rate
        FROM (SELECT *, LAG(cumulative_customers) OVER (ORDER BY year NULLS FIRST, month NULLS FIRST)
                  AS previous FROM cumulative)
        JOIN months ON month = month_num""",
        "order",
        monthly=f"""SELECT {YEAR} AS year, {MONTH} AS month,
            COUNT(DISTINCT order_customer_id) AS distinct_customers FROM stg_order GROUP BY ALL""",
        cumulative="""SELECT *, CAST(SUM(distinct_customers) OVER
            (ORDER BY year NULLS FIRST, month NULLS FIRST) AS BIGINT) AS cumulative_customers FROM monthly""",
    ),
)
def retention(spark, sf_dir):
    return marts.customer_retention_rate(staged(spark, sf_dir, "order"))


@query(
    "mart_financial_commitments",
    over_staged(
        """SELECT department_name, market, category_name, total_committed_funds,
        CAST(completed AS DOUBLE) / n AS commitment_fulfillment_rate
        FROM per_product JOIN stg_department USING (department_id) JOIN stg_product USING (product_card_id)""",
        "order",
        "department",
        "product",
        per_product=f"""SELECT department_id, product_card_id,
            {money_sum('order_item_total')} AS total_committed_funds,
            SUM(CASE WHEN order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS completed, COUNT(*) AS n
            FROM stg_order GROUP BY ALL""",
    ),
)
def commitments(spark, sf_dir):
    return marts.financial_commitments(
        staged(spark, sf_dir, "order"), staged(spark, sf_dir, "department"), staged(spark, sf_dir, "product")
    )


@query(
    "mart_fraud_detection",
    over_staged(
        f"""SELECT order_customer_id, {money_avg('order_item_total')} AS avg_order_total,
        COUNT(*) AS num_orders FROM stg_order GROUP BY order_customer_id""",
        "order",
    ),
)
def fraud(spark, sf_dir):
    return marts.fraud_detection(staged(spark, sf_dir, "order"))


INVENTORY_VALUE = f"SUM({money('order_item_product_price')} * CAST(order_item_quantity AS DECIMAL(10,0)))"

TURNOVER = rounded_ratio(
    f"{money_units('order_item_total')} * COUNT(order_item_quantity)", "SUM(order_item_quantity) * 10000"
)


@query(
    "mart_inventory_levels",
    over_staged(
        """SELECT t.year, month_name, total_inventory_value, inventory_turnover_ratio, age_range,
        inventory_value
        FROM totals t JOIN ages a ON t.year = a.year AND t.month = a.month
        JOIN months ON t.month = month_num""",
        "order",
        dated=f"""SELECT *, {YEAR} AS year, {MONTH} AS month,
            date_sub('day', {parsed('order_date')}, {SQL_AS_OF}) AS age FROM stg_order""",
        totals=f"""SELECT year, month, CAST(ROUND({INVENTORY_VALUE}, 2) AS DOUBLE) AS total_inventory_value,
            {TURNOVER} AS inventory_turnover_ratio
            FROM dated GROUP BY year, month""",
        ages=f"""SELECT year, month,
            {AGE_RANGE} AS age_range,
            CAST(ROUND({INVENTORY_VALUE}, 2) AS DOUBLE) AS inventory_value
            FROM dated GROUP BY ALL""",
    ),
)
def inventory(spark, sf_dir):
    return marts.inventory_levels(staged(spark, sf_dir, "order"), as_of=AS_OF)


MEAN_PROFIT = rounded_ratio(
    money_units("order_profit_per_order"), "COUNT(order_profit_per_order) * 10000"
)
SHIPMENT_AVERAGES = f"""SELECT
    {rounded_ratio('SUM(days_for_shipping_real)', 'COUNT(days_for_shipping_real)')} AS avg_actual_shipment_days,
    {rounded_ratio('SUM(days_for_shipping_scheduled)', 'COUNT(days_for_shipping_scheduled)')}
        AS avg_scheduled_shipment_days FROM stg_shipping"""


@query(
    "mart_overall_performance",
    over_staged(
        """SELECT year, month_name, total_sales, avg_profit_margin, avg_actual_shipment_days,
        avg_scheduled_shipment_days FROM monthly JOIN months ON month = month_num CROSS JOIN shipments""",
        "order",
        "shipping",
        monthly=f"""SELECT {YEAR} AS year, {MONTH} AS month,
            CAST(ROUND(SUM({money('order_item_total')}), 2) AS DOUBLE) AS total_sales,
            {MEAN_PROFIT} AS avg_profit_margin
            FROM stg_order GROUP BY ALL""",
        shipments=SHIPMENT_AVERAGES,
    ),
)
def performance(spark, sf_dir):
    return marts.overall_performance(staged(spark, sf_dir, "order"), staged(spark, sf_dir, "shipping"))


@query(
    "mart_payment_delays",
    over_staged(
        """SELECT delivery_status,
        CAST(SUM(days_for_shipping_real - days_for_shipping_scheduled) AS DOUBLE)
            / COUNT(days_for_shipping_real - days_for_shipping_scheduled) AS avg_payment_delay,
        COUNT(*) AS count_of_orders FROM stg_shipping GROUP BY delivery_status""",
        "shipping",
    ),
)
def delays(spark, sf_dir):
    return marts.payment_delays(staged(spark, sf_dir, "shipping"))
