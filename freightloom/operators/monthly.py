"""Monthly grouping and the windows that run over monthly results.

The windows here have no partition key and so run in one task. They are meant
for aggregated rows, one per month, of which a calendar can hold only so many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse_order_ts

MONTH_KEYS = ("year", "month")


def month_columns(ts: Column | str) -> tuple[Column, Column]:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(ts).cast("bigint").alias("year"), F.month(ts).cast("bigint").alias("month")


def order_time(df: DataFrame, date_text: str = "order_date", lenient: bool = False) -> Column:
    """The order's timestamp: the typed column of a stored staging table, or else the parsed text."""
    return F.col("order_ts") if "order_ts" in df.columns else parse_order_ts(date_text, lenient)


def by_month(df: DataFrame, date_text: str = "order_date", lenient: bool = False, extra: Sequence[Column] = ()):
    """Group by year and month of the order (and by ``extra`` columns)."""
    with_ts = df.withColumn("_ts", order_time(df, date_text, lenient))
    return with_ts.groupBy(*month_columns("_ts"), *extra)


def running_total(df: DataFrame, value: str, total: str, order_by: Sequence[str] = MONTH_KEYS) -> DataFrame:
    """Running total up to and including the current row's peers."""
    return df.withColumn(total, F.sum(value).over(Window.orderBy(*order_by)))


def previous_value(
    df: DataFrame, value: str, previous: str, order_by: Sequence[str] = MONTH_KEYS
) -> DataFrame:
    """Value of the row before; NULL on the first row."""
    return df.withColumn(previous, F.lag(value, 1).over(Window.orderBy(*order_by)))
