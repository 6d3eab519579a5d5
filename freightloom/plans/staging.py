"""Staging: typed, deduplicated versions of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_order_ts, safe_cast
from ..operators.dedup import dedupe_by_key
from ..operators.monthly import month_columns
from ..operators.projection import quoted, standardise_names
from ..schema import TABLES, TableSpec

# Folders of a stored order table.
ORDER_PARTS = ("order_year", "order_month")


def stage(table: DataFrame, spec: TableSpec | str, unique: bool = False) -> DataFrame:
    """Keep one row per raw key and cast every column, bad values becoming NULL.

    Keys are compared as they arrive: ``'1'`` and ``'01'`` stay two rows even
    though both become 1. ``table`` is a warehouse table, or the flat records
    themselves, whose extra columns then help to choose the surviving rows.
    ``unique`` says that the table already has one row per key, as the star split
    leaves it; the rows are then cast in place, without a shuffle.
    """
    spec = TABLES[spec] if isinstance(spec, str) else spec
    kept = standardise_names(table)
    if not unique:
        kept = dedupe_by_key(kept, spec.keys, spec.tie_break, repeats=spec.repeats, output=spec.columns)
    return kept.select(
        *[
            safe_cast(F.col(quoted(c)), spec.types.get(c, "string")).alias(spec.staged_name(c))
            for c in spec.columns
        ]
    )


def stage_warehouse(
    spark: SparkSession, database: str, names=None, unique: bool = False
) -> dict[str, DataFrame]:
    """Staging tables over the warehouse, as temporary views named ``stg_<table>``.

    ``unique`` spares every read of a view the deduplication, for warehouse
    tables that the star split has left with one row per key.
    """
    staged = {}
    for name in names or TABLES:
        staged[name] = stage(spark.table(f"{database}.{TABLES[name].warehouse_name}"), name, unique)
        staged[name].createOrReplaceTempView(f"stg_{name}")
    return staged


def with_order_ts(orders: DataFrame, lenient: bool = False) -> DataFrame:
    """Add the typed order timestamp and its year and month beside the text.

    Stored this way, date filters reach the Parquet scan, and a table laid out
    by ``order_year`` and ``order_month`` skips whole folders.
    """
    year, month = month_columns("order_ts")
    return (
        orders.withColumn("order_ts", parse_order_ts("order_date", lenient))
        .withColumn(ORDER_PARTS[0], year)
        .withColumn(ORDER_PARTS[1], month)
    )
