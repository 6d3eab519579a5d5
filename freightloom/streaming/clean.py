"""Cleaning, stamping and deduplicating streams of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.projection import quoted

# Parts a hot key is split into before its copies meet.
SPREAD = 16


def clean_and_stamp(df: DataFrame, stamp: str = "timestamp") -> DataFrame:
    """Drop records with any missing value and add the time of processing.

    All records of a micro-batch carry the same time.
    """
    return df.dropna("any").withColumn(stamp, F.current_timestamp())


def dedupe_stream(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    delay: str = "1 hour",
    spread: int = SPREAD,
) -> DataFrame:
    """Drop redelivered records: repeats of the keys within ``delay``.

    Time is the arrival of the record unless ``event_time`` names a timestamp
    column. The watermark bounds the state, and repeats that come later than
    ``delay`` pass through. With ``event_time``, *any* record older than the
    watermark is dropped, repeated or not, so ``delay`` must then cover the
    largest lateness.

    A key redelivered very often would send all its copies to one task. Copies
    are therefore dropped in two steps: first within ``spread`` random parts, and
    then among the at most ``spread`` survivors per key. Which part a copy falls
    into does not matter for the result. ``spread=1`` leaves the first step out.
    """
    time = event_time or "_arrival"
    timed = stream if event_time else stream.withColumn(time, F.current_timestamp())
    timed = timed.withWatermark(time, delay)
    if spread > 1:
        part = F.floor(F.rand(seed=0) * spread)
        timed = timed.withColumn("_part", part).dropDuplicatesWithinWatermark([*keys, "_part"])
    return timed.dropDuplicatesWithinWatermark(list(keys)).select(
        *[F.col(quoted(c)) for c in stream.columns]
    )
