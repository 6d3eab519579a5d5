"""Deduplication: staging tables, one row per key, reports and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from freightloom.operators.dedup import dedup_report, dedupe_by_key, flag_duplicates
from freightloom.operators.projection import union_all_by_name
from freightloom.schema import TABLES

from .fixture import line_items, named_orders, staged
from .registry import query
from .sql import over_flat, over_staged


def _register_staged(name: str) -> None:
    @query(f"stg_{name}", over_staged(f"SELECT * FROM stg_{name}", name))
    def stg(spark, sf_dir):
        return staged(spark, sf_dir, name)


for _name in TABLES:
    _register_staged(_name)

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TIE = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query(
    "dedup_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def by_key(spark, sf_dir):
    return dedupe_by_key(
        line_items(spark, sf_dir),
        LINE_KEYS,
        LINE_TIE,
        output=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
    )


@query(
    "dedup_report",
    over_flat(
        """SELECT 'order' AS table_name, COUNT(*) AS rows_before, COUNT(DISTINCT Order_Id) AS rows_after,
        COUNT(*) - COUNT(DISTINCT Order_Id) AS rows_removed FROM flat
        UNION ALL SELECT 'shipping', COUNT(*), COUNT(DISTINCT (Shipping_date, Shipping_Mode)),
        COUNT(*) - COUNT(DISTINCT (Shipping_date, Shipping_Mode)) FROM flat
        UNION ALL SELECT 'product', COUNT(*), COUNT(DISTINCT Product_Card_Id),
        COUNT(*) - COUNT(DISTINCT Product_Card_Id) FROM flat"""
    ),
)
def report(spark, sf_dir):
    flat = named_orders(spark, sf_dir)
    return union_all_by_name(
        [
            dedup_report(flat, TABLES[name].keys).select(F.lit(name).alias("table_name"), "*")
            for name in ("order", "shipping", "product")
        ]
    )


@query(
    "dedup_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) > 1 AS duplicate_flag FROM lineitem""",
)
def flags(spark, sf_dir):
    return flag_duplicates(line_items(spark, sf_dir), LINE_KEYS, LINE_TIE).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "duplicate_flag"
    )


@query(
    "dedup_flag_copies",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) > 1 AS duplicate_flag
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)""",
)
def flag_copies(spark, sf_dir):
    """Every record delivered twice."""
    lines = line_items(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return flag_duplicates(lines.union(lines), LINE_KEYS, ["l_partkey", "l_suppkey"])
