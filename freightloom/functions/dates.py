"""Date parsing and calendar arithmetic, in UTC wall-clock time (``timestamp_ntz``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order dates read "1/5/2018 9:03"; fields may be zero-padded.
ORDER_TS_PATTERN = "M/d/yyyy H:m"
ORDER_TS_OUTPUT_PATTERN = "M/d/yyyy H:mm"
BATCH_TAG_PATTERN = "yyyyMMdd_HHmmss"

# The month calendar.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_order_ts(text: Column | str, lenient: bool = False) -> Column:
    """Timestamp of an order date text; NULL stays NULL.

    Unreadable text fails the query, or becomes NULL if ``lenient``.
    """
    text = _column(text)
    # Parsed as an instant at offset zero, so that no time of day is lost to the
    # daylight-saving gaps of the session's zone.
    instant = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f"{ORDER_TS_PATTERN} X"))
    parsed = F.timestamp_add("SECOND", F.unix_seconds(instant), _epoch())
    if lenient:
        return parsed
    complaint = F.concat(F.lit("not an order date: "), text)
    return F.coalesce(parsed, F.when(text.isNotNull(), F.raise_error(complaint)))


def now_utc() -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def as_of_column(as_of: Column | dt.datetime | str | None) -> Column:
    """``as_of`` as a column; ``None`` means now. Date-times are taken as UTC."""
    if as_of is None:
        return now_utc()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp_ntz")


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Full 24-hour periods from ``start`` to ``end``, negative if ``end`` comes first."""
    start, end = (_column(c).cast("timestamp_ntz") for c in (start, end))
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def batch_tag(ts: Column | str) -> Column:
    """Second-resolution tag of a landing batch, e.g. ``20240131_235959``."""
    return F.date_format(_column(ts), BATCH_TAG_PATTERN)


def month_calendar(spark: SparkSession) -> DataFrame:
    """The twelve months as ``(month, month_name)``; a local relation, never larger."""
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(MONTH_NAMES, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS calendar(month, month_name)")
