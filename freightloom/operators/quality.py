"""Data-quality checks. Each returns rows of findings rather than raising."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import safe_cast, whole_days_between
from ..functions.dates import as_of_column
from .dedup import key_counts
from .projection import quoted, union_all_by_name


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows checked and rows without a value."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    found = [
        F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_{i}").alias("failures")
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*found)))


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys used more than once and rows holding those keys.

    ``dedup.duplicate_groups`` lists the offending keys.
    """
    repeated = F.col("n") > 1
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("rows_with_repeated_key"),
    )


def castable(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column: values present and values the wanted type cannot hold."""
    aggregates, found = [], []
    for i, (column, type_name) in enumerate(types.items()):
        value = F.col(quoted(column))
        bad = value.isNotNull() & safe_cast(value, type_name).isNull()
        aggregates += [F.count(value).alias(f"_n{i}"), F.count_if(bad).alias(f"_bad{i}")]
        found.append(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(type_name).alias("wanted_type"),
                F.col(f"_n{i}").alias("n_values"),
                F.col(f"_bad{i}").alias("failures"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*found)))


def recency(
    df: DataFrame, ts: Column | str, days: int, as_of: Column | dt.datetime | str | None = None
) -> DataFrame:
    """One row: newest timestamp, its age in whole days and whether that is within ``days``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    newest = df.agg(F.max(ts).cast("timestamp_ntz").alias("newest"))
    age = whole_days_between("newest", as_of_column(as_of))
    return newest.withColumn("age_days", age).withColumn("is_recent", F.col("age_days") <= days)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return union_all_by_name(
        [
            df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ]
    )


def schema_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Declared against actual columns, with the number of values found in each.

    ``status`` is ``ok``, ``missing`` (declared only), ``undeclared`` (present
    only) or ``type differs``.
    """
    declared = {f.name: f.dataType.simpleString() for f in contract.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(
        F.lit(0).alias("_none"),
        *[F.count(F.col(quoted(c))).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    position = {c: i for i, c in enumerate(df.columns)}
    found = []
    for column in dict.fromkeys([*declared, *actual]):
        want, have = declared.get(column), actual.get(column)
        if have is None:
            status = "missing"
        elif want is None:
            status = "undeclared"
        else:
            status = "ok" if want == have else "type differs"
        n_values = F.col(f"_{position[column]}") if have else F.lit(0).cast("bigint")
        found.append(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(want or "-").alias("declared_type"),
                F.lit(have or "-").alias("actual_type"),
                F.lit(status).alias("status"),
                n_values.alias("n_values"),
            )
        )
    return counts.select(F.inline(F.array(*found)))


#: Column in which quarantined rows say which rules they broke.
BROKEN = "broken_rules"


def rule_not_null(column: str) -> Column:
    """Rule: the column has a value."""
    return F.col(quoted(column)).isNotNull()


def rule_castable(column: str, type_name: str) -> Column:
    """Rule: the column is missing or holds a value of the type."""
    value = F.col(quoted(column))
    return value.isNull() | safe_cast(value, type_name).isNotNull()


def with_broken_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Every row with the names of the rules it breaks, in their order. A rule that gives NULL is broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(BROKEN, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))


def passed(checked: DataFrame) -> DataFrame:
    """Rows of ``with_broken_rules`` that break none, as they were."""
    return checked.where(F.size(BROKEN) == 0).drop(BROKEN)


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows of ``with_broken_rules`` that break a rule, with the rules."""
    return checked.where(F.size(BROKEN) > 0)


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per rule ``rule, n_rows, failures``: all rules of a table in one aggregate over one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_{i}") for i, rule in enumerate(rules.values())],
    )
    found = [
        F.struct(F.lit(name).alias("rule"), F.col("_rows").alias("n_rows"), F.col(f"_{i}").alias("failures")) for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*found)))


def write_checked(df: DataFrame, rules: Mapping[str, Column], path: str) -> None:
    """Write good rows and quarantined ones in one pass, under ``path/quarantine=false`` and ``path/quarantine=true``.

    Good rows have an empty ``broken_rules`` there; ``read_checked`` gives either side.
    """
    checked = with_broken_rules(df, rules)
    checked.withColumn("quarantine", F.size(BROKEN) > 0).write.mode("append").partitionBy("quarantine").parquet(path)


def read_checked(spark: SparkSession, path: str, schema: T.StructType, quarantine: bool = False) -> DataFrame:
    """Good rows of ``write_checked``, or the quarantined ones with the rules they broke; only their folder is scanned."""
    whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.ArrayType(T.StringType())), T.StructField("quarantine", T.BooleanType())])
    rows = spark.read.schema(whole).parquet(path).where(F.col("quarantine") == quarantine).drop("quarantine")
    return rows if quarantine else rows.drop(BROKEN)
