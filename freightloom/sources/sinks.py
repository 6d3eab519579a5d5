"""Batch sinks: star tables as files, warehouse tables, the data dictionary."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from ..schema import TABLES
from ..session import LARGE_SIDE_BY_SIDE, OWN_FILES, shuffles_dropped, together

log = logging.getLogger(__name__)


def write_tables(
    tables: Mapping[str, DataFrame],
    path: str,
    partitions: int | None = None,
    compression: str = "snappy",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Overwrite ``path/<name>`` with each table as Parquet; tables without columns are skipped.

    ``partitions`` fixes the number of files at the price of a shuffle; without
    it the plan's own partitioning is written. ``partition_by`` lays the named
    tables out in folders so that later reads can skip them.
    Tables are written side by side, or one by one with ``partitions``. Returns the names written.
    """
    written = []
    for name, df in tables.items():
        if df.columns:
            written.append(name)
        else:
            log.warning("skipping %s: no columns", name)

    def write(name: str) -> None:
        df = tables[name]
        out = df.repartition(partitions) if partitions else df
        writer = out.write.mode("overwrite").option("compression", compression)
        if partition_by and partition_by.get(name):
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(f"{path.rstrip('/')}/{name}")

    if written:
        spark = SparkSession.getActiveSession()
        with shuffles_dropped(spark) if spark else nullcontext():
            # Dealt to a number of files, a table is shuffled once more.
            together([lambda name=name: write(name) for name in written], 1 if partitions else LARGE_SIDE_BY_SIDE)
    return written


def load_full_refresh(
    spark: SparkSession, path: str, database: str, names: Mapping[str, str] | None = None
) -> list[str]:
    """Replace the warehouse tables with the star files under ``path``, side by side.

    ``names`` maps file names to table names; by default all seven star tables.
    Returns the qualified names of the tables loaded.
    """
    names = names or {spec.star_name: spec.warehouse_name for spec in TABLES.values()}

    def load(source: str, table: str) -> str:
        files = spark.read.parquet(f"{path.rstrip('/')}/{source}")
        files.write.mode("overwrite").option("compression", OWN_FILES).saveAsTable(f"{database}.{table}")
        return f"{database}.{table}"

    return together([lambda s=source, t=table: load(s, t) for source, table in names.items()])


def write_data_dictionary(dictionary: DataFrame, path: str) -> None:
    """Data dictionary as one CSV file; it has one row per profiled column."""
    dictionary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
