"""Joins. Only sides of a fixed size carry a broadcast hint.

Dimensions are joined without a hint: adaptive execution broadcasts one whose
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sort-merge joins, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_calendar


def with_month_name(df: DataFrame, month: str = "month") -> DataFrame:
    """Add ``month_name``; rows whose month is NULL or not a month drop out."""
    calendar = F.broadcast(month_calendar(df.sparkSession)).withColumnRenamed("month", "_month")
    return df.join(calendar, df[month] == F.col("_month"), "inner").drop("_month")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equally named keys; rows with a NULL key drop out."""
    return left.join(right, list(keys), "inner")


def attach_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Inner join of facts to the named attributes of a dimension."""
    return facts.join(dimension.select(key, *attributes), key, "inner")


def attach_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Put the one row of a keyless aggregate beside every row.

    A scalar subquery: it runs once, its values become constants of the outer
    query, and nothing is joined. More than one row is an error.
    """
    one_row = totals.select(F.struct(*totals.columns)).scalar()
    return df.withColumn("_totals", one_row).select(*df.columns, "_totals.*")
