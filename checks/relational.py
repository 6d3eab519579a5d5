"""Joins, aggregates, windows, limits and inline tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.functions import (
    AMOUNT,
    age_bucket,
    exact_avg,
    exact_sum,
    exact_sum_product,
    month_calendar,
    parse_order_ts,
    rounded_ratio,
    whole_days_between,
)
from freightloom.functions.dates import as_of_column
from freightloom.operators.joins import attach_dimension, attach_totals, join_on_keys, with_month_name
from freightloom.operators.limits import capped, head, top_k
from freightloom.operators.monthly import by_month, month_columns, previous_value, running_total
from freightloom.operators.projection import union_all_by_name
from freightloom.plans import marts
from freightloom.session import scratch_dir

from .fixture import AS_OF, line_items, staged, table
from .marts import SHIPMENT_AVERAGES, TURNOVER
from .registry import query
from .sql import AS_OF as SQL_AS_OF
from .sql import AGE_RANGE, money_avg, money_sum, month_of, over_staged, parsed, year_of

YEAR, MONTH = year_of("order_date"), month_of("order_date")
MONTHLY_CUSTOMERS = f"""SELECT {YEAR} AS year, {MONTH} AS month,
    COUNT(DISTINCT order_customer_id) AS distinct_customers FROM stg_order GROUP BY ALL"""


# --- joins --------------------------------------------------------------------


@query(
    "join_month_lookup",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, strftime(o_orderdate, '%B') AS month_name
    FROM orders""",
)
def month_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *month_columns("o_orderdate"))
    return with_month_name(orders).select("o_orderkey", "year", "month_name")


@query(
    "join_two_key",
    over_staged(
        "SELECT year, month, total_sales, avg_profit FROM sales JOIN profit USING (year, month)",
        "order",
        sales=f"""SELECT {YEAR} AS year, {MONTH} AS month, {money_sum('order_item_total')} AS total_sales
            FROM stg_order GROUP BY ALL""",
        profit=f"""SELECT {YEAR} AS year, {MONTH} AS month,
            {money_avg('order_profit_per_order')} AS avg_profit FROM stg_order GROUP BY ALL""",
    ),
)
def two_key(spark, sf_dir):
    orders = staged(spark, sf_dir, "order")
    sales = by_month(orders).agg(exact_sum("order_item_total").alias("total_sales"))
    profit = by_month(orders).agg(exact_avg("order_profit_per_order").alias("avg_profit"))
    return join_on_keys(sales, profit, ["year", "month"])


@query(
    "join_dim_department",
    over_staged(
        f"""SELECT department_id, department_name, market, n_orders, total FROM
        (SELECT department_id, COUNT(*) AS n_orders, {money_sum('order_item_total')} AS total
         FROM stg_order GROUP BY ALL) JOIN stg_department USING (department_id)""",
        "order",
        "department",
    ),
)
def dim_department(spark, sf_dir):
    per_department = (
        staged(spark, sf_dir, "order")
        .groupBy("department_id")
        .agg(F.count("*").alias("n_orders"), exact_sum("order_item_total").alias("total"))
    )
    return attach_dimension(
        per_department, staged(spark, sf_dir, "department"), "department_id", ["department_name", "market"]
    )


@query(
    "join_dim_product",
    over_staged(
        f"""SELECT product_card_id, product_name, category_name, n_orders, total FROM
        (SELECT product_card_id, COUNT(*) AS n_orders, {money_sum('order_item_total')} AS total
         FROM stg_order GROUP BY ALL) JOIN stg_product USING (product_card_id)""",
        "order",
        "product",
    ),
)
def dim_product(spark, sf_dir):
    per_product = (
        staged(spark, sf_dir, "order")
        .groupBy("product_card_id")
        .agg(F.count("*").alias("n_orders"), exact_sum("order_item_total").alias("total"))
    )
    return attach_dimension(
        per_product, staged(spark, sf_dir, "product"), "product_card_id", ["product_name", "category_name"]
    )


@query(
    "join_cross_scalar",
    over_staged(
        f"""SELECT delivery_status, shipments, avg_actual_shipment_days, avg_scheduled_shipment_days
        FROM (SELECT delivery_status, COUNT(*) AS shipments FROM stg_shipping GROUP BY ALL) CROSS JOIN
        ({SHIPMENT_AVERAGES})""",
        "shipping",
    ),
)
def cross_scalar(spark, sf_dir):
    shipping = staged(spark, sf_dir, "shipping")
    per_status = shipping.groupBy("delivery_status").agg(F.count("*").alias("shipments"))
    return attach_totals(per_status, marts.shipment_averages(shipping))


# --- aggregates ---------------------------------------------------------------


@query(
    "agg_count",
    over_staged("SELECT order_status, COUNT(*) AS n_orders FROM stg_order GROUP BY ALL", "order"),
)
def count(spark, sf_dir):
    return staged(spark, sf_dir, "order").groupBy("order_status").agg(F.count("*").alias("n_orders"))


@query(
    "agg_sum_monthly",
    over_staged(
        f"""SELECT {YEAR} AS year, {MONTH} AS month, {money_sum('order_item_total')} AS total_sales,
        {money_sum('order_profit_per_order')} AS total_profit FROM stg_order GROUP BY ALL""",
        "order",
    ),
)
def sum_monthly(spark, sf_dir):
    return by_month(staged(spark, sf_dir, "order")).agg(
        exact_sum("order_item_total").alias("total_sales"),
        exact_sum("order_profit_per_order").alias("total_profit"),
    )


@query(
    "agg_avg_customer",
    over_staged(
        f"""SELECT order_customer_id, {money_avg('order_item_total')} AS avg_order_total
        FROM stg_order GROUP BY ALL""",
        "order",
    ),
)
def avg_customer(spark, sf_dir):
    return marts.customer_order_averages(staged(spark, sf_dir, "order")).drop("num_orders")


@query("agg_count_distinct", over_staged(MONTHLY_CUSTOMERS, "order"))
def count_distinct(spark, sf_dir):
    return marts.monthly_customers(staged(spark, sf_dir, "order"))


@query(
    "agg_conditional",
    over_staged(
        """SELECT department_id, CAST(SUM(CASE WHEN order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT)
        AS completed_orders, COUNT(*) AS total_orders FROM stg_order GROUP BY department_id""",
        "order",
    ),
)
def conditional(spark, sf_dir):
    return staged(spark, sf_dir, "order").groupBy("department_id").agg(
        F.sum(F.when(F.col("order_status") == marts.COMPLETED, 1).otherwise(0)).alias("completed_orders"),
        F.count("*").alias("total_orders"),
    )


@query(
    "agg_sum_product",
    over_staged(
        """SELECT product_card_id, CAST(SUM(CAST(order_item_product_price AS DECIMAL(18,4))
        * CAST(order_item_quantity AS DECIMAL(10,0))) AS DOUBLE) AS inventory_value
        FROM stg_order GROUP BY ALL""",
        "order",
    ),
)
def sum_product(spark, sf_dir):
    value = exact_sum_product("order_item_product_price", "order_item_quantity")
    return staged(spark, sf_dir, "order").groupBy("product_card_id").agg(value.alias("inventory_value"))


@query(
    "agg_sum_small",
    """SELECT l_shipmode AS flag, CAST(SUM(l_quantity) AS DOUBLE) / 1073741824 AS total,
    CAST(SUM(l_quantity) AS DOUBLE) / 1073741824 / COUNT(*) AS mean FROM
    (SELECT l_returnflag || l_linestatus AS l_shipmode, l_quantity FROM lineitem) GROUP BY ALL""",
)
def sum_small(spark, sf_dir):
    """Amounts around 1e-9, far below the decimals of an amount; halvings, so that doubles add up exactly."""
    small = F.col("l_quantity") / F.lit(2**30)
    return line_items(spark, sf_dir).groupBy(F.concat("l_returnflag", "l_linestatus").alias("flag")).agg(
        exact_sum(small).alias("total"), exact_avg(small).alias("mean")
    )


@query(
    "agg_sum_product_fractional",
    """SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity / 8 AS DECIMAL(10,3))) AS DOUBLE)
    AS inventory_value FROM lineitem GROUP BY ALL""",
)
def sum_product_fractional(spark, sf_dir):
    """Quantities in eighths."""
    value = exact_sum_product("l_extendedprice", F.col("l_quantity") / 8)
    return line_items(spark, sf_dir).groupBy("l_suppkey").agg(value.alias("inventory_value"))


@query(
    "agg_ratio",
    over_staged(
        f"SELECT {YEAR} AS year, {MONTH} AS month, {TURNOVER} AS turnover FROM stg_order GROUP BY ALL",
        "order",
    ),
)
def ratio(spark, sf_dir):
    total = exact_sum("order_item_total").cast(AMOUNT) * F.count("order_item_quantity")
    return by_month(staged(spark, sf_dir, "order")).agg(
        rounded_ratio(total, F.sum("order_item_quantity"), 2).alias("turnover")
    )


@query(
    "agg_global",
    over_staged(SHIPMENT_AVERAGES, "shipping"),
)
def global_aggregate(spark, sf_dir):
    return marts.shipment_averages(staged(spark, sf_dir, "shipping"))


@query(
    "agg_age_bucket",
    over_staged(
        f"""SELECT year, month, {AGE_RANGE} AS age_range, COUNT(*) AS n_orders,
            CAST(SUM(quantity) AS BIGINT) AS quantity
        FROM (SELECT {YEAR} AS year, {MONTH} AS month, order_item_quantity AS quantity,
            date_sub('day', {parsed('order_date')}, {SQL_AS_OF}) AS age FROM stg_order)
        GROUP BY ALL""",
        "order",
    ),
)
def age_buckets(spark, sf_dir):
    ts = parse_order_ts("order_date")
    age = age_bucket(whole_days_between(ts, as_of_column(AS_OF))).alias("age_range")
    return (
        staged(spark, sf_dir, "order")
        .groupBy(*month_columns(ts), age)
        .agg(F.count("*").alias("n_orders"), F.sum("order_item_quantity").alias("quantity"))
    )


@query(
    "agg_composite_key",
    over_staged(
        f"""SELECT department_id, product_card_id, {money_sum('order_item_total')} AS total_committed_funds,
        CAST(SUM(CASE WHEN order_status = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS completed_orders,
        COUNT(*) AS total_orders FROM stg_order GROUP BY ALL""",
        "order",
    ),
)
def composite_key(spark, sf_dir):
    return marts.commitments_by_product(staged(spark, sf_dir, "order"))


# --- windows ------------------------------------------------------------------


@query(
    "win_running_total",
    over_staged(
        """SELECT year, month, distinct_customers, CAST(SUM(distinct_customers) OVER
        (ORDER BY year NULLS FIRST, month NULLS FIRST) AS BIGINT) AS cumulative_customers FROM monthly""",
        "order",
        monthly=MONTHLY_CUSTOMERS,
    ),
)
def running(spark, sf_dir):
    monthly = marts.monthly_customers(staged(spark, sf_dir, "order"))
    return running_total(monthly, "distinct_customers", "cumulative_customers")


@query(
    "win_lag",
    over_staged(
        """SELECT year, month, distinct_customers,
        LAG(distinct_customers) OVER (ORDER BY year NULLS FIRST, month NULLS FIRST) AS previous_customers
        FROM monthly""",
        "order",
        monthly=MONTHLY_CUSTOMERS,
    ),
)
def lag(spark, sf_dir):
    monthly = marts.monthly_customers(staged(spark, sf_dir, "order"))
    return previous_value(monthly, "distinct_customers", "previous_customers")


# --- limits -------------------------------------------------------------------


def stored_orders(spark, sf_dir):
    """The staged orders as a batch run stores them; a cap reads its input several times."""
    path = scratch_dir(spark, "staged-orders")
    staged(spark, sf_dir, "order").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "limit_cap_ordered",
    over_staged(
        """SELECT order_id, department_id, product_card_id, order_status FROM stg_order
        ORDER BY order_id NULLS FIRST LIMIT 50000""",
        "order",
    ),
)
def cap_ordered(spark, sf_dir):
    """The reference size, which takes all staged orders of the smaller test tables."""
    return capped(stored_orders(spark, sf_dir), 50_000, ["order_id"]).select(
        "order_id", "department_id", "product_card_id", "order_status"
    )


@query(
    "limit_cap_staged",
    over_staged(
        """SELECT order_id, department_id, product_card_id, order_status FROM stg_order
        ORDER BY order_id NULLS FIRST LIMIT 1000""",
        "order",
    ),
)
def cap_staged(spark, sf_dir):
    return capped(stored_orders(spark, sf_dir), 1_000, ["order_id"]).select(
        "order_id", "department_id", "product_card_id", "order_status"
    )


@query(
    "limit_cap_text_key",
    """SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5000""",
)
def cap_text_key(spark, sf_dir):
    """Text first: a few flags that a third of all rows share, then numbers."""
    order = ["l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return capped(line_items(spark, sf_dir).select(order), 5_000, order)


@query(
    "limit_cap_hot_key",
    """SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem
    ORDER BY l_returnflag, l_orderkey, l_linenumber LIMIT 30000""",
)
def cap_hot_key(spark, sf_dir):
    """The cap falls among the rows of a key that half of all rows share."""
    return capped(line_items(spark, sf_dir).select("l_returnflag", "l_orderkey", "l_linenumber"), 30_000, ["l_returnflag"])


@query(
    "limit_head",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 5",
)
def first_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return head(customers, order_by=["c_custkey"])


@query(
    "topk_customers",
    over_staged(
        f"""SELECT order_customer_id, {money_avg('order_item_total')} AS avg_order_total,
        COUNT(*) AS num_orders FROM stg_order GROUP BY order_customer_id
        ORDER BY avg_order_total DESC, order_customer_id LIMIT 20""",
        "order",
    ),
)
def top_customers(spark, sf_dir):
    averages = marts.customer_order_averages(staged(spark, sf_dir, "order"))
    return top_k(averages, "avg_order_total", 20, tie_break=["order_customer_id"])


# --- inline tables and unions ---------------------------------------------------


@query(
    "calendar_months",
    """SELECT CAST(m.month AS BIGINT) AS month, strftime(make_date(2000, CAST(m.month AS INTEGER), 1), '%B')
        AS month_name, COUNT(o_orderkey) AS n_orders
    FROM range(1, 13) m(month) LEFT JOIN orders ON month(o_orderdate) = m.month GROUP BY ALL""",
)
def calendar(spark, sf_dir):
    per_month = (
        table(spark, sf_dir, "orders").groupBy(F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    )
    return (
        month_calendar(spark)
        .join(per_month, "month", "left")
        .select(
            F.col("month").cast("bigint").alias("month"),
            "month_name",
            F.coalesce("n", F.lit(0)).alias("n_orders"),
        )
    )


@query(
    "union_by_name",
    """SELECT c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment, c_nationkey AS nation_key
    FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("party_name"),
    )
    return union_all_by_name([customers, suppliers])
