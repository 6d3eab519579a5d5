"""Streams fed from the test tables, drained into files and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.operators.joins import attach_totals
from freightloom.schema import all_text
from freightloom.session import scratch_dir
from freightloom.sources import decode_messages, encode_messages, read_json_records
from freightloom.sources.messages import ORDER_TOPIC
from freightloom.streaming import (
    clean_and_stamp,
    dedupe_stream,
    land,
    land_counted,
    land_observed,
    landed_batches,
    landed_file_metrics,
    observed_batches,
)

from .fixture import table
from .registry import query

MESSAGE_COLUMNS = (
    "Order Id", "Order Customer Id", "Order Status", "Sales", "order date (DateOrders)", "Shipping Mode"
)


def read_stream(spark, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream; the source wants a glob rather than one path."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}*.parquet")


def order_messages(spark, sf_dir: str) -> DataFrame:
    """Orders as a stream of keyed JSON messages with broker metadata."""
    orders = read_stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order Id"),
        F.col("o_custkey").cast("string").alias("Order Customer Id"),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("o_totalprice").cast("decimal(14,2)").cast("string").alias("Sales"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("order date (DateOrders)"),
        F.col("o_orderpriority").alias("Shipping Mode"),
    )
    offset = F.col("key").cast("bigint")
    return encode_messages(orders).select(
        "key",
        "value",
        F.lit(ORDER_TOPIC).alias("topic"),
        (offset % 8).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_seconds(offset).alias("timestamp"),
    )


def decoded_orders(spark, sf_dir: str) -> DataFrame:
    return decode_messages(order_messages(spark, sf_dir), all_text(MESSAGE_COLUMNS))


def drain(stream: DataFrame, path: str, checkpoint: str, file_format: str = "parquet", **options):
    running = land(stream, path, checkpoint, file_format, **options)
    running.awaitTermination()
    return running


LANDED_ORDERS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS "Order Id", CAST(o_custkey AS VARCHAR) AS "Order Customer Id",
    o_orderstatus AS "Order Status", CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS "Sales",
    strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS "order date (DateOrders)", o_orderpriority AS "Shipping Mode", CAST(o_orderkey AS VARCHAR) AS "key",
    CAST(o_orderkey AS VARCHAR) AS "offset", CAST(o_orderkey % 8 AS VARCHAR) AS "partition",
    CAST(o_orderkey * 1000 AS VARCHAR) AS "time", '{ORDER_TOPIC}' AS topic FROM orders"""


@query("stream_land_orders", LANDED_ORDERS)
def land_orders(spark, sf_dir):
    path = scratch_dir(spark, "landed")
    drain(decoded_orders(spark, sf_dir), path, scratch_dir(spark, "checkpoint"))
    return spark.read.parquet(path)


@query("stream_land_json", LANDED_ORDERS)
def land_json(spark, sf_dir):
    path = scratch_dir(spark, "landed")
    stream = decoded_orders(spark, sf_dir)
    drain(stream, path, scratch_dir(spark, "checkpoint"), "json")
    return read_json_records(spark, path, stream.schema)


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
# Timestamps are compared as text.
SHOWN_EVENT = ", ".join(EVENT_COLUMNS).replace("ts,", "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,")
PLAIN_EVENTS = f"SELECT {SHOWN_EVENT} FROM events"


def shown(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stream_replay",
    f"SELECT {SHOWN_EVENT}, CAST(1 AS BIGINT) AS landed, CAST(1 AS BIGINT) AS replayed FROM events",
)
def replay(spark, sf_dir):
    """A restart on the same checkpoint adds nothing; a fresh one replays everything."""
    stream = read_stream(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    path, checkpoint = scratch_dir(spark, "landed"), scratch_dir(spark, "checkpoint")
    drain(stream, path, checkpoint)
    drain(stream, path, checkpoint)
    again = scratch_dir(spark, "replayed")
    drain(stream, again, scratch_dir(spark, "checkpoint"))
    first = spark.read.parquet(path).withColumn("run", F.lit("landed"))
    second = spark.read.parquet(again).withColumn("run", F.lit("replayed"))
    return shown(first.union(second)).groupBy(*EVENT_COLUMNS).agg(
        F.count_if(F.col("run") == "landed").alias("landed"),
        F.count_if(F.col("run") == "replayed").alias("replayed"),
    )


@query("stream_dedup", PLAIN_EVENTS)
def dedup(spark, sf_dir):
    """Every event is delivered twice and lands once."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    stream = read_stream(session, sf_dir, "events").select(*EVENT_COLUMNS)
    path = scratch_dir(spark, "landed")
    once = dedupe_stream(stream.union(stream), ["event_id"])
    drain(once, path, scratch_dir(spark, "checkpoint"))
    return shown(spark.read.parquet(path))


@query(
    "stream_clean_stamp",
    """SELECT event_id, event_type, value FROM events WHERE event_type <> 'error' AND user_id % 5 <> 0""",
)
def clean_stamp(spark, sf_dir):
    """The stamp itself is wall-clock time and left out of the comparison."""
    stream = read_stream(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("user_id") % 5 != 0, F.col("value")).alias("value"),
    )
    path = scratch_dir(spark, "landed")
    drain(clean_and_stamp(stream), path, scratch_dir(spark, "checkpoint"))
    stamped = spark.read.parquet(path)
    return stamped.filter(F.col("timestamp").isNotNull()).drop("timestamp")


@query(
    "stream_batch_metrics",
    """SELECT COUNT(*) AS rows_read, COUNT(*) AS rows_landed, CAST(120 AS BIGINT) AS batches, CAST(2 AS BIGINT) AS n_columns
    FROM events""",
)
def batch_metrics(spark, sf_dir):
    """Over a hundred micro-batches, with a restart in between."""
    folder = scratch_dir(spark, "events-in")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    parts = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(120))).repartition("part")
    parts.filter("part < 70").write.partitionBy("part").parquet(folder)
    path, metrics, checkpoint = (scratch_dir(spark, p) for p in ("landed", "metrics", "checkpoint"))
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    stream = reader.parquet(f"{folder}/part=*")
    land_counted(stream, path, metrics, checkpoint).awaitTermination()
    parts.filter("part >= 70").write.mode("append").partitionBy("part").parquet(folder)
    land_counted(stream, path, metrics, checkpoint).awaitTermination()
    counted = landed_batches(spark, metrics).agg(
        F.sum("n_rows").alias("rows_read"), F.count("*").alias("batches")
    )
    landed = landed_file_metrics(spark.read.schema(events.schema).parquet(f"{path}/*")).agg(
        F.sum("n_rows").alias("rows_landed"), F.max("n_columns").alias("n_columns")
    )
    return attach_totals(landed, counted)


@query(
    "stream_observed_metrics",
    """SELECT COUNT(*) AS n_rows, COUNT(value) AS n_values, MIN(ts) AS first_ts, MAX(ts) AS last_ts, CAST(20 AS BIGINT) AS batches
    FROM (SELECT event_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)""",
)
def observed_metrics(spark, sf_dir):
    """Counts and extremes taken while twenty micro-batches are written, with a restart in between."""
    folder = scratch_dir(spark, "events-in")
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    parts = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(20))).repartition("part")
    path, metrics, checkpoint = (scratch_dir(spark, p) for p in ("landed", "metrics", "checkpoint"))
    measures = {"n_values": F.count("value"), "first_ts": F.min("ts"), "last_ts": F.max("ts")}
    for half in (F.col("part") < 12, F.col("part") >= 12):
        parts.filter(half).write.mode("append").partitionBy("part").parquet(folder)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part=*")
        land_observed(stream, path, metrics, checkpoint, measures).awaitTermination()
    return observed_batches(spark, metrics).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"), F.count("*").alias("batches"),
    )
