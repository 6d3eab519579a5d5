"""Landing a stream as files, exactly once per checkpoint."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def land(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    drain: bool = True,
    interval: str | None = None,
    rows_per_file: int | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append the stream to files under ``path`` (Parquet, or JSON lines).

    ``drain`` processes everything available and stops; otherwise the query runs
    on, one micro-batch per ``interval``. The checkpoint holds the offsets, so a
    restart continues where the last committed batch ended. A fresh checkpoint
    replays the source; it needs a fresh ``path`` too, as the old one already
    records its batches as landed.
    The state of a deduplicating stream is kept in as many parts as its session
    has shuffle partitions at the first start; read the stream in a session of
    its own (``spark.newSession()``) to choose another number.
    """
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, drain, interval).start()


def _triggered(writer: DataStreamWriter, drain: bool, interval: str | None) -> DataStreamWriter:
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def land_counted(
    stream: DataFrame,
    path: str,
    metrics: str,
    checkpoint: str,
    file_format: str = "parquet",
    drain: bool = True,
    interval: str | None = None,
    rows_per_file: int | None = None,
) -> StreamingQuery:
    """Land like ``land``, and keep a row of metrics per micro-batch under ``metrics``.

    Each batch is a folder ``batch_id=<n>`` under both paths. A batch that is
    repeated after a failure replaces its folder, so records land once and counts
    stay complete over any number of batches and restarts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path.rstrip('/')}/batch_id={batch_id}"
        writer = batch.write.mode("overwrite").format(file_format)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.save(folder)
        landed = batch.sparkSession.read.schema(batch.schema).format(file_format).load(folder)
        counted = landed.agg(F.count("*").alias("n_rows"))
        counted.write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, drain, interval).start()


def land_observed(
    stream: DataFrame,
    path: str,
    metrics: str,
    checkpoint: str,
    measures: Mapping[str, Column] | None = None,
    file_format: str = "parquet",
    drain: bool = True,
    interval: str | None = None,
    rows_per_file: int | None = None,
) -> StreamingQuery:
    """Land like ``land_counted``, with metrics taken from the write itself: no batch is read a second time.

    ``measures`` are aggregates over a batch by name, beside ``n_rows``. Spark collects them while the rows pass
    to the files (``observe``), each task's once it has succeeded. The folders are those of ``land_counted``;
    ``observed_batches`` reads the metrics. A batch that is repeated replaces its row.
    """
    taken = {"n_rows": F.count(F.lit(1))} | dict(measures or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"landed-{uuid.uuid4().hex}")
        writer = batch.observe(seen, *[m.alias(name) for name, m in taken.items()]).write.mode("overwrite").format(file_format)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.save(f"{path.rstrip('/')}/batch_id={batch_id}")
        found = seen.get
        kinds = batch.limit(0).agg(*[m.alias(name) for name, m in taken.items()]).schema
        row = batch.sparkSession.createDataFrame([tuple(found[name] for name in taken)], kinds)
        row.coalesce(1).write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, drain, interval).start()


def observed_batches(spark: SparkSession, metrics: str) -> DataFrame:
    """The metrics of every micro-batch so far, with its ``batch_id``."""
    return spark.read.parquet(metrics).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def landed_batches(spark: SparkSession, metrics: str) -> DataFrame:
    """Rows landed by every micro-batch so far, ``(batch_id, n_rows)``."""
    found = spark.read.schema("n_rows bigint, batch_id bigint").parquet(metrics)
    return found.select("batch_id", "n_rows")


def landed_file_metrics(landed: DataFrame) -> DataFrame:
    """Rows, columns and bytes of every landed file.

    ``landed`` must be a plain scan of the landed files.
    """
    return (
        landed.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes"))
        .withColumn("n_columns", F.lit(len(landed.columns)).cast("bigint"))
    )
