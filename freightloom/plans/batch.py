"""The batch run: landed records to star files, warehouse tables, staging, marts and checks.

Every step reads what the step before has stored. A run may take only records
not older than the last run's newest one: its survivors of each key are merged
with those kept from before, which gives the tables a run over all records gives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_order_ts
from ..operators import quality
from ..operators.dedup import dedupe_by_key
from ..operators.projection import missing_columns, quoted, standardise_names, union_all_by_name
from ..schema import MART_SCHEMAS, TABLES
from ..session import OWN_FILES, shuffles_dropped, together
from ..sources import load_full_refresh, read_bronze, write_tables
from ..sources.file_index import overlapping_files, read_files, refresh_index
from ..sources.snapshots import remove_folder
from .analyses import high_water_mark, not_before
from .marts import build_marts
from .staging import ORDER_PARTS, stage, with_order_ts
from .star import star_survivors

ORDER_DATE = "Order_Date"
MARKS = "batch_marks"
FINDINGS = "quality_findings"


def last_mark(spark: SparkSession, database: str) -> tuple[int, dt.datetime] | None:
    """Number and high-water mark of the last finished run."""
    if not spark.catalog.tableExists(f"{database}.{MARKS}"):
        return None
    row = spark.table(f"{database}.{MARKS}").orderBy(F.col("run").desc()).first()
    return (row["run"], row["mark"]) if row else None


def _survivors(bronze: DataFrame, kept: Mapping[str, DataFrame], everything: DataFrame) -> dict[str, DataFrame]:
    """First record of each key and table, among new records and the survivors of earlier runs.

    A table without its key keeps all records, so records that are read again would be added
    again; it is made from everything that has landed.
    """
    merged = {}
    for spec in TABLES.values():
        new = star_survivors(bronze, spec)
        if new.columns and spec.star_name in kept:
            both = union_all_by_name([kept[spec.star_name], new])
            if missing_columns(both, spec.keys):
                new = star_survivors(everything, spec)
            else:
                new = dedupe_by_key(both, spec.keys, spec.tie_break)
        merged[spec.star_name] = new
    return merged


def run_batch(
    spark: SparkSession,
    bronze_path: str,
    star_path: str,
    database: str,
    as_of: Column | dt.datetime | str | None = None,
    cap: int | None = None,
    partitions: int | None = None,
    lenient_dates: bool = False,
    incremental: bool = False,
    index_path: str | None = None,
) -> list[str]:
    """Rebuild star files, warehouse, staging and marts from the landed records, and check them.

    ``incremental`` reads only records ordered at the time of the last finished
    run's newest one or later, and those without a readable order date (records
    that land later but are older are left to the next full run); without an
    earlier run it reads all. Orders are staged with a typed
    timestamp, in folders by year and month, so that date filters skip folders;
    with ``index_path`` such a run keeps an index of the landed files there, and
    opens only those that may hold records as new (``sources.file_index``);
    each staging table is stored once and also readable as the view ``stg_<table>``.
    Every step overwrites its target and the mark is written last, so a failed
    run is repeated as a whole. Findings of the checks are in the table
    ``quality_findings``. Returns the names of the mart tables.
    """
    with shuffles_dropped(spark):
        return _run(spark, bronze_path, star_path, database, as_of, cap, partitions, lenient_dates, incremental, index_path)


def _run(
    spark: SparkSession, bronze_path: str, star_path: str, database: str, as_of: Column | dt.datetime | str | None, cap: int | None,
    partitions: int | None, lenient_dates: bool, incremental: bool, index_path: str | None,
) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    everything = bronze = standardise_names(read_bronze(spark, bronze_path))
    ordered = parse_order_ts(ORDER_DATE, lenient_dates)
    before = last_mark(spark, database)
    kept: dict[str, DataFrame] = {}
    if incremental and before:
        if index_path:
            refresh_index(spark, bronze_path, index_path)
            files = overlapping_files(spark, bronze_path, index_path, before[1], untimed=True)
            bronze = standardise_names(read_files(spark, files, read_bronze(spark, bronze_path).schema))
        bronze = not_before(bronze.withColumn("_ts", ordered), "_ts", before[1]).drop("_ts")
        kept = _read_survivors(spark, star_path, before[0])
    run = before[0] + 1 if before else 1

    # Survivors keep the columns that chose them, for later merges; star files do not.
    folder = _survivor_folder(star_path, run)
    survived = write_tables(_survivors(bronze, kept, everything), folder, partitions=partitions, compression=OWN_FILES)
    by_star_name = {spec.star_name: spec for spec in TABLES.values()}
    star = {}
    for name in survived:
        found = spark.read.parquet(f"{folder}/{name}")
        star[name] = found.select(*[F.col(quoted(c)) for c in by_star_name[name].columns if c in found.columns])
    write_tables(star, star_path, partitions=partitions)
    names = {name: by_star_name[name].warehouse_name for name in survived}
    load_full_refresh(spark, star_path, database, names)

    staging = [name for name, spec in TABLES.items() if spec.star_name in names]
    stored = together([lambda n=name: _store_staged(spark, database, n, lenient_dates) for name in staging])
    staged = dict(zip(staging, stored))
    marts = build_marts(staged, as_of=as_of, cap=cap, lenient_dates=lenient_dates)
    together([lambda n=n, m=m: m.write.mode("overwrite").saveAsTable(f"{database}.{n}") for n, m in marts.items()])
    stored = {name: spark.table(f"{database}.{name}") for name in marts}
    check_build(staged, stored).write.mode("overwrite").saveAsTable(f"{database}.{FINDINGS}")

    mark = high_water_mark(staged["order"], "order_ts")
    spark.createDataFrame([(run, mark)], "run bigint, mark timestamp_ntz").write.mode("append").saveAsTable(
        f"{database}.{MARKS}"
    )
    if before:  # nothing reads the survivors of the run before any more
        remove_folder(spark, _survivor_folder(star_path, before[0]))
    return [f"{database}.{name}" for name in marts]


def _survivor_folder(star_path: str, run: int) -> str:
    return f"{star_path.rstrip('/')}/_survivors/{run}"


def _read_survivors(spark: SparkSession, star_path: str, run: int) -> dict[str, DataFrame]:
    found = {}
    for spec in TABLES.values():
        try:
            found[spec.star_name] = read_bronze(spark, f"{_survivor_folder(star_path, run)}/{spec.star_name}")
        except FileNotFoundError:
            continue  # the table's columns have not landed yet
    return found


def _store_staged(spark: SparkSession, database: str, name: str, lenient_dates: bool) -> DataFrame:
    """Cast the unique warehouse table once, store it and make it readable as a view."""
    table = f"{database}.stg_{name}"
    staged = stage(spark.table(f"{database}.{TABLES[name].warehouse_name}"), name, unique=True)
    writer = staged.write
    if name == "order":
        # One task per folder, or several for a large one.
        writer = with_order_ts(staged, lenient_dates).hint("rebalance", *ORDER_PARTS).write.partitionBy(*ORDER_PARTS)
    writer.mode("overwrite").option("compression", OWN_FILES).saveAsTable(table)
    spark.table(table).createOrReplaceTempView(f"stg_{name}")
    return spark.table(table)


def check_build(staged: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """Findings ``(check, table_name, subject, n_rows, failures)`` on staging tables and marts.

    Keys must be present and unique after the cast, and tables must have the
    declared columns and types. Rows without failures are findings too.
    """
    found = []
    for name, df in staged.items():
        spec = TABLES[name]
        keys = [spec.staged_name(k) for k in spec.keys if spec.staged_name(k) in df.columns]
        if keys:
            missing = quality.not_null(df, keys).withColumnRenamed("column", "subject")
            repeated = quality.unique(df, keys).select(
                F.lit(", ".join(keys)).alias("subject"), "n_rows", F.col("repeated_keys").alias("failures")
            )
            found += [_finding("not_null", name, missing), _finding("unique", name, repeated)]
        found.append(_finding("contract", name, _contract(df.drop(*ORDER_PARTS, "order_ts"), spec.staged_schema)))
    for name, df in marts.items():
        found.append(_finding("contract", name, _contract(df, MART_SCHEMAS[name])))
    return union_all_by_name(found)


def _contract(df: DataFrame, contract) -> DataFrame:
    return quality.schema_contract(df, contract).select(
        F.col("column").alias("subject"), F.col("n_values").alias("n_rows"), (F.col("status") != "ok").cast("bigint").alias("failures")
    )


def _finding(check: str, table: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"), "subject", "n_rows", "failures")
