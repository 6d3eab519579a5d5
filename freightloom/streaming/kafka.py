"""Kafka as source and sink. Needs the spark-sql-kafka package on the cluster.

Everything downstream takes any frame with the columns of this source, so other
brokers, or files, can stand in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources.messages import ORDER_KEY, ORDER_TOPIC, encode_messages

# Rows of one micro-batch. A topic's backlog is then taken in many batches, not as one.
MAX_ROWS_PER_TRIGGER = 2_000_000


def kafka_source_options(
    servers: str,
    topic: str = ORDER_TOPIC,
    start: str = "earliest",
    max_rows_per_trigger: int | None = MAX_ROWS_PER_TRIGGER,
    group_id: str | None = None,
) -> dict[str, str]:
    """Source options. Offsets live in the query's checkpoint, not in the group.

    ``start`` counts for a new checkpoint only: replaying a topic means starting
    from ``earliest`` with a fresh checkpoint folder.
    ``max_rows_per_trigger`` bounds a micro-batch; with ``None`` a trigger takes
    all there is.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if max_rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_rows_per_trigger)
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def read_topic(spark: SparkSession, servers: str, topic: str = ORDER_TOPIC, **options) -> DataFrame:
    """Stream of messages: key, value, topic, partition, offset, timestamp."""
    return (
        spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **options)).load()
    )


def publish(
    df: DataFrame,
    servers: str,
    topic: str = ORDER_TOPIC,
    key: str = ORDER_KEY,
    columns: Sequence[str] | None = None,
    checkpoint: str | None = None,
):
    """Send rows as keyed JSON, acknowledged by all replicas and retried up to 3 times.

    A batch frame is written at once; a streaming frame needs ``checkpoint`` and
    returns the running query.
    """
    messages = encode_messages(df, key, columns)
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
    }
    if not df.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a streaming publish needs a checkpoint folder")
    return (
        messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    )
