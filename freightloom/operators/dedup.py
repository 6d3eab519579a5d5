"""One row per key, and reports about repeated keys.

NULL keys form one group like any other value. Every function here stays even
under a hot key: rows are reduced within each map task before they are shuffled
by key, or are shuffled by something finer than the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .projection import missing_columns, quoted

# Copies of one row that a task writes out at a time when duplicates are flagged.
PORTION = 65_536


def _tie_order(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] | None) -> list[str]:
    """Columns that decide among rows of one key.

    A ``tie_break`` that is fully at hand is taken to tell rows apart, which
    leaves the other columns free to be pruned. Otherwise all columns take part:
    rows that still tie are equal, so it does not matter which of them is kept.
    """
    present = [c for c in (tie_break or ()) if c in df.columns]
    if tie_break and len(present) == len(tie_break):
        return [c for c in present if c not in keys]
    rest = [c for c in df.columns if c not in present]
    return [c for c in present + rest if c not in keys]


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    tie_break: Sequence[str] | None = None,
    missing_ok: bool = False,
    repeats: bool = False,
    output: Sequence[str] | None = None,
    ranked_last: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row of each key in ``tie_break`` order (all columns by default).

    ``row_number() = 1`` lets Spark keep one row per key and map task before the
    shuffle, so a key holding a third of all rows costs one row per task.

    repeats
        Set when equal rows are common, as for dimensions cut out of flat order
        records: they are collapsed by a hash aggregate first, which spares
        sorting every record.
    output
        Columns to return, if the tie-break needs columns the result does not.
    ranked_last
        Columns that decide among rows which tie on a complete tie-break.
    missing_ok
        Return the input when a key column is absent instead of raising.
    """
    absent = missing_columns(df, keys)
    if absent:
        if missing_ok:
            return df
        raise ValueError(f"key columns not found: {absent}")
    if output is not None:
        # Columns outside the result take part only if the caller ranks by them.
        ranked = [c for c in (tie_break or ()) if c in df.columns]
        df = df.select(*[F.col(quoted(c)) for c in dict.fromkeys([*output, *keys, *ranked])])
    if repeats:
        df = df.distinct()
    by_key = Window.partitionBy(*[F.col(quoted(k)) for k in keys])
    decisive = _tie_order(df, keys, tie_break)
    decisive += [c for c in ranked_last if c not in keys and c not in decisive]
    order = [F.col(quoted(c)) for c in decisive] or [F.lit(1)]
    kept = df.withColumn("_rank", F.row_number().over(by_key.orderBy(*order))).filter("_rank = 1")
    return kept.select(*[F.col(quoted(c)) for c in (output or df.columns)])


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = (), flag: str = "duplicate_flag"
) -> DataFrame:
    """Mark all rows but the first of each key, in ``tie_break`` order, instead of dropping them.

    Rows that tie are ranked by their other columns. Equal rows are counted
    before they are shuffled; one of them can be a key's first, the others are
    its copies. The first rows are joined back on all columns, which are unique
    then, and copies are written out again in portions, so neither a hot key
    nor a row with many copies gathers in one task.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    first = dedupe_by_key(counted.drop("_copies"), keys, tie_break, ranked_last=df.columns)
    first = first.select(*[F.col(quoted(c)).alias(f"_first_{i}") for i, c in enumerate(df.columns)])
    same = F.lit(True)
    for i, c in enumerate(df.columns):
        same = same & counted[quoted(c)].eqNullSafe(first[f"_first_{i}"])
    marked = counted.join(first.withColumn("_is_first", F.lit(True)), same, "left")
    portions = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(PORTION).cast("bigint"))
    spread = marked.withColumn("_from", F.explode(portions)).repartition(*columns, F.col("_from"))
    upto = F.least(F.col("_from") + PORTION, "_copies") - 1
    copies = spread.withColumn("_copy", F.explode(F.sequence("_from", upto)))
    return copies.select(*columns, (F.col("_is_first").isNull() | (F.col("_copy") > 0)).alias(flag))


def key_counts(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count("*").alias(count))


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after deduplication, in one row."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("rows_removed"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None, count: str = "copies") -> DataFrame:
    """Keys (all columns by default) that occur more than once, with their count."""
    return key_counts(df, keys or df.columns, count).filter(F.col(count) > 1)
