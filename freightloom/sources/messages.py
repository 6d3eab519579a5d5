"""Keyed JSON messages, for batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import message_key
from ..operators.projection import quoted
from ..schema import METADATA_COLUMNS, RAW_ORDER_SCHEMA

ORDER_KEY = "Order Id"
ORDER_TOPIC = "supply-chain-orders"


def encode_messages(df: DataFrame, key: str | None = ORDER_KEY, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as ``(key, value)``: the key column's text or NULL, and the row as JSON.

    NULL values are written out, so every message has all fields.
    """
    fields = F.struct(*[F.col(quoted(c)) for c in (columns or df.columns)])
    value = F.to_json(fields, {"ignoreNullFields": "false"}).alias("value")
    has_key = key is not None and key in df.columns
    id_text = F.col(quoted(key)).cast("string") if has_key else F.lit(None).cast("string")
    return df.select(message_key(id_text).alias("key"), value)


def decode_messages(
    messages: DataFrame,
    schema: T.StructType = RAW_ORDER_SCHEMA,
    malformed: str = "FAILFAST",
    with_metadata: bool = True,
) -> DataFrame:
    """Fields of JSON message values, followed by the message's metadata.

    ``messages`` has the columns of a Kafka source: key, value, topic, partition,
    offset and timestamp, any of which but ``value`` may be absent. The metadata
    columns are text except ``timestamp``, which becomes ``time``, the text of
    its milliseconds since the epoch.
    ``malformed="PERMISSIVE"`` turns unreadable messages into rows of NULLs.
    """
    record = F.from_json(F.col("value").cast("string"), schema, {"mode": malformed})
    available = {c: F.col(c).cast("string") for c in ("key", "offset", "partition", "topic")}
    available["time"] = F.unix_millis(F.col("timestamp").cast("timestamp")).cast("string")
    source_of = {"time": "timestamp"}
    metadata = [
        c for c in METADATA_COLUMNS if with_metadata and source_of.get(c, c) in messages.columns
    ]
    return messages.select(record.alias("record"), *[available[c].alias(c) for c in metadata]).select(
        "record.*", *metadata
    )
