"""Data-quality checks over staging tables and raw text."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.functions import parse_order_ts
from freightloom.operators import quality
from freightloom.operators.projection import union_all_by_name
from freightloom.schema import TABLES
from freightloom.session import scratch_dir

from .fixture import AS_OF, named_orders, staged, table
from .profile import GAPPY, gappy_orders
from .registry import query
from .sql import AS_OF as SQL_AS_OF
from .sql import over_flat, over_staged, parsed


@query(
    "dq_not_null",
    f"""SELECT 'o_orderkey' AS "column", COUNT(*) AS n_rows, COUNT(*) FILTER (o_orderkey IS NULL) AS failures
    FROM {GAPPY} UNION ALL
    SELECT 'o_custkey', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL) FROM {GAPPY} UNION ALL
    SELECT 'o_orderstatus', COUNT(*), COUNT(*) FILTER (o_orderstatus IS NULL) FROM {GAPPY}""",
)
def not_null(spark, sf_dir):
    return quality.not_null(gappy_orders(spark, sf_dir), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(
    "dq_unique",
    over_staged(
        """SELECT 'flat' AS table_name, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys,
        COUNT(*) FILTER (n > 1) AS repeated_keys,
        CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT) AS rows_with_repeated_key
        FROM (SELECT Order_Id, COUNT(*) AS n FROM flat GROUP BY ALL)
        UNION ALL SELECT 'stg_order', CAST(SUM(n) AS BIGINT), COUNT(*), COUNT(*) FILTER (n > 1),
        CAST(COALESCE(SUM(n) FILTER (n > 1), 0) AS BIGINT)
        FROM (SELECT order_id, COUNT(*) AS n FROM stg_order GROUP BY ALL)""",
        "order",
    ),
)
def unique(spark, sf_dir):
    checked = {
        "flat": quality.unique(named_orders(spark, sf_dir), ["Order_Id"]),
        "stg_order": quality.unique(staged(spark, sf_dir, "order"), ["order_id"]),
    }
    return union_all_by_name([df.select(F.lit(name).alias("table_name"), "*") for name, df in checked.items()])


@query(
    "dq_castable",
    over_flat(
        """SELECT 'Order_Id' AS "column", 'bigint' AS wanted_type, COUNT(Order_Id) AS n_values,
        COUNT(*) FILTER (NOT regexp_full_match(trim(Order_Id), '[+-]?[0-9]+')) AS failures FROM flat
        UNION ALL SELECT 'Sales', 'bigint', COUNT(Sales),
        COUNT(*) FILTER (NOT regexp_full_match(trim(Sales), '[+-]?[0-9]+')) FROM flat
        UNION ALL SELECT 'Order_Item_Total', 'double', COUNT(Order_Item_Total),
        COUNT(*) FILTER (TRY_CAST(Order_Item_Total AS DOUBLE) IS NULL) FROM flat
        UNION ALL SELECT 'Shipping_Mode', 'double', COUNT(Shipping_Mode),
        COUNT(*) FILTER (TRY_CAST(Shipping_Mode AS DOUBLE) IS NULL) FROM flat"""
    ),
)
def castable(spark, sf_dir):
    wanted = {"Order_Id": "bigint", "Order_Item_Total": "double", "Shipping_Mode": "double"}
    flat = named_orders(spark, sf_dir)
    return union_all_by_name([quality.castable(flat, wanted), quality.castable(flat, {"Sales": "bigint"})])


@query(
    "dq_recency",
    over_staged(
        f"""SELECT strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest,
        date_sub('day', newest, {SQL_AS_OF}) AS age_days, date_sub('day', newest, {SQL_AS_OF}) <= 1 AS is_recent
        FROM (SELECT MAX({parsed('order_date')}) AS newest FROM stg_order)""",
        "order",
    ),
)
def recency(spark, sf_dir):
    found = quality.recency(staged(spark, sf_dir, "order"), parse_order_ts("order_date"), days=1, as_of=AS_OF)
    return found.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


COUNTED_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "dq_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in COUNTED_TABLES),
)
def row_counts(spark, sf_dir):
    return quality.row_counts({t: table(spark, sf_dir, t) for t in COUNTED_TABLES})


@query(
    "dq_schema_contract",
    over_staged(
        """SELECT 'shipping_date' AS "column", 'string' AS declared_type, 'string' AS actual_type, 'ok' AS status,
        COUNT(shipping_date) AS n_values FROM stg_shipping
        UNION ALL SELECT 'days_for_shipping_real', 'bigint', 'string', 'type differs',
            COUNT(days_for_shipping_real) FROM stg_shipping
        UNION ALL SELECT 'days_for_shipping_scheduled', 'bigint', 'bigint', 'ok',
            COUNT(days_for_shipping_scheduled) FROM stg_shipping
        UNION ALL SELECT 'shipping_mode', 'string', '-', 'missing', 0
        UNION ALL SELECT 'delivery_status', 'string', 'string', 'ok', COUNT(delivery_status) FROM stg_shipping
        UNION ALL SELECT 'carrier', '-', 'string', 'undeclared', COUNT(shipping_mode) FROM stg_shipping""",
        "shipping",
    ),
)
def schema_contract(spark, sf_dir):
    """A drifted shipping table: one column retyped, one renamed."""
    drifted = (
        staged(spark, sf_dir, "shipping")
        .withColumn("days_for_shipping_real", F.col("days_for_shipping_real").cast("string"))
        .withColumnRenamed("shipping_mode", "carrier")
    )
    return quality.schema_contract(drifted, TABLES["shipping"].staged_schema)


def _order_rules():
    return {
        "order has an id": quality.rule_not_null("o_orderkey"),
        "total is a number": quality.rule_castable("o_totalprice_text", "double"),
        "customer is known": quality.rule_not_null("o_custkey"),
        "total is positive": F.col("o_totalprice_text").try_cast("double") > 0,
    }


def _dirty_orders(spark, sf_dir):
    """Orders with missing customers and unreadable totals by rule."""
    total = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("-"), total)).otherwise(total).alias("o_totalprice_text"),
    )


_DIRTY = """(SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR)
    ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) END AS t FROM orders)"""


@query(
    "dq_quarantine",
    f"""SELECT o_orderkey, o_custkey, t AS o_totalprice_text, array_to_string(list_filter([
        CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL THEN 'total is a number' END,
        CASE WHEN o_custkey IS NULL THEN 'customer is known' END,
        CASE WHEN NOT coalesce(TRY_CAST(t AS DOUBLE) > 0, FALSE) THEN 'total is positive' END], lambda x: x IS NOT NULL), '; ') AS broken
    FROM {_DIRTY} WHERE TRY_CAST(t AS DOUBLE) IS NULL OR o_custkey IS NULL OR TRY_CAST(t AS DOUBLE) <= 0""",
)
def quarantine(spark, sf_dir):
    """Rows that break a rule, as they were set aside while the others were written."""
    path, orders = scratch_dir(spark, "checked"), _dirty_orders(spark, sf_dir)
    quality.write_checked(orders, _order_rules(), path)
    aside = quality.read_checked(spark, path, orders.schema, quarantine=True)
    return aside.withColumn("broken", F.array_join(quality.BROKEN, "; ")).drop(quality.BROKEN)


@query(
    "dq_rule_report",
    f"""SELECT rule, n_rows, failures FROM (
        SELECT 'order has an id' AS rule, COUNT(*) AS n_rows, COUNT(*) FILTER (o_orderkey IS NULL) AS failures FROM {_DIRTY}
        UNION ALL SELECT 'total is a number', COUNT(*), COUNT(*) FILTER (t IS NOT NULL AND TRY_CAST(t AS DOUBLE) IS NULL) FROM {_DIRTY}
        UNION ALL SELECT 'customer is known', COUNT(*), COUNT(*) FILTER (o_custkey IS NULL) FROM {_DIRTY}
        UNION ALL SELECT 'total is positive', COUNT(*), COUNT(*) FILTER (NOT coalesce(TRY_CAST(t AS DOUBLE) > 0, FALSE)) FROM {_DIRTY})""",
)
def rule_report(spark, sf_dir):
    """All rules of a table in one scan."""
    return quality.rule_report(_dirty_orders(spark, sf_dir), _order_rules())
