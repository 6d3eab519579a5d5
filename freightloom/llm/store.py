"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame

from freightloom.session import scratch_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and read again.

    Cuts the lineage: later jobs read files, so a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark, purpose: str) -> str:
    """URI of a fresh folder for files that tasks write themselves."""
    path = scratch_dir(spark, purpose)
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a folder URI (``file``, ``s3``, ``gs``, ``hdfs``, ...); usable inside tasks."""
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem, path.rstrip("/")


def write_file(uri: str, name: str, attempt: int, data: bytes) -> str:
    """Write ``folder/name`` in one go and return its path.

    The bytes go to a name of the task attempt's own first and are then moved into place, so a
    retried or speculative task replaces a file by an equal one and never leaves half of it.
    """
    filesystem, folder = open_folder(uri)
    filesystem.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{attempt}"
    with filesystem.open_output_stream(draft) as out:
        out.write(data)
    filesystem.move(draft, f"{folder}/{name}")
    return f"{folder}/{name}"
