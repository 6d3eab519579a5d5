"""Column profiling as Spark jobs.

NaN counts as missing, as in data-frame libraries. Per-column results come from
one aggregate row turned into rows, so their size is the number of columns.
Distinct counts and top values share one shuffle: all columns are unpivoted to
``(column, value)`` and counted together, which avoids the row expansion of
several ``count(distinct ...)`` in one query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact_avg, percent_of, rounded_ratio, safe_divide, value_label
from .joins import attach_totals
from .order_statistics import exact_quantiles
from .projection import quoted

TOP_VALUES = 10
PARTS = 64
QUARTILES = (0.25, 0.5, 0.75)
MEASURES = ("mean", "std", "min", "q25", "median", "q75", "max", "range", "iqr")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _missing(df: DataFrame, column: str) -> Column:
    value = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _present(df: DataFrame, column: str) -> Column:
    return F.when(~_missing(df, column), F.col(quoted(column)))


def _rows_per_column(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


def _no_columns(df: DataFrame, schema: str) -> DataFrame:
    """The report on no columns at all."""
    return df.sparkSession.createDataFrame([], schema)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    return "categorical" if isinstance(data_type, T.StringType) else "other"


def type_census(df: DataFrame) -> DataFrame:
    """Data type, kind, non-missing and total count of every column."""
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count(_present(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    return _rows_per_column(
        counts,
        [
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(_kind(f.dataType)).alias("kind"),
                F.col(f"_{i}").alias("non_null"),
                F.col("_total").alias("total"),
            )
            for i, f in enumerate(df.schema.fields)
        ],
    )


def _mean(df: DataFrame, column: str, digits: int | None) -> Column:
    """Aggregate: exact mean; whole numbers need no fallback for values beyond the decimal."""
    value = _present(df, column)
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        return exact_avg(value, digits)
    total = F.sum(value.cast("decimal(20,0)"))
    if digits is None:
        return safe_divide(total, F.count(value))
    return rounded_ratio(total, F.count(value), digits)


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = 2, approximate: bool = False
) -> DataFrame:
    """Count, mean, sample standard deviation, extremes, quartiles, range and IQR.

    Quartiles are exact and interpolated, for which the one-row aggregate and
    three more scans (further ones for very large columns) run right away, unless ``approximate`` asks for Spark's sketch, which costs no
    extra pass. ``digits=None`` leaves values unrounded.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        return _no_columns(df, "column string, count bigint, " + ", ".join(f"{m} double" for m in MEASURES))
    aggregates = [F.lit(0).alias("_none")]
    for i, c in enumerate(columns):
        value = _present(df, c).cast("double")
        aggregates += [
            F.count(value).alias(f"_n{i}"),
            _mean(df, c, digits).alias(f"_mean{i}"),
            F.stddev_samp(value).alias(f"_std{i}"),
            F.min(value).alias(f"_min{i}"),
            F.max(value).alias(f"_max{i}"),
        ]
        if approximate:
            aggregates.append(F.percentile_approx(value, list(QUARTILES)).alias(f"_q{i}"))
    one_row = df.agg(*aggregates)
    if not approximate:
        found = one_row.first()
        one_row = df.sparkSession.createDataFrame([found], one_row.schema)
        extents = {c: (found[f"_n{i}"], found[f"_min{i}"], found[f"_max{i}"]) for i, c in enumerate(columns)}
    fields = ("n", "mean", "std", "min", "max") + (("q",) if approximate else ())
    names = {"n": "count", "q": "quartiles"}
    base = _rows_per_column(
        one_row,
        [
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"_{f}{i}").alias(names.get(f, f)) for f in fields],
            )
            for i, c in enumerate(columns)
        ],
    )
    if not approximate:
        quantiles = exact_quantiles(df, columns, QUARTILES, extents)
        pivoted = quantiles.groupBy("column").agg(
            F.array(
                *[F.max(F.when(F.col("probability") == p, F.col("quantile"))) for p in QUARTILES]
            ).alias("quartiles")
        )
        # Both sides have one row per column.
        base = base.join(F.broadcast(pivoted), "column", "left")
    q25, median, q75 = (F.col("quartiles")[i] for i in range(3))
    shown = (
        ("mean", F.col("mean")),
        ("std", F.col("std")),
        ("min", F.col("min")),
        ("q25", q25),
        ("median", median),
        ("q75", q75),
        ("max", F.col("max")),
        ("range", F.col("max") - F.col("min")),
        ("iqr", q75 - q25),
    )
    return base.select(
        "column",
        "count",
        *[(v if digits is None else F.round(v, digits)).alias(name) for name, v in shown],
    )


def _counted_values(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """``(column, value, n)`` with values as text; missing values are counted under NULL."""
    columns = list(columns or categorical_columns(df))
    if not columns:
        return _no_columns(df, "column string, value string, n bigint")
    numeric = set(numeric_columns(df))
    pairs = []
    for i, c in enumerate(columns):
        value = _present(df, c)
        if c in numeric:
            value = value + F.lit(0)  # -0.0 and 0.0 are one value
        pairs.append(F.struct(F.lit(i).alias("position"), value.cast("string").alias("value")))
    counted = (
        df.select(F.inline(F.array(*pairs))).groupBy("position", "value").agg(F.count("*").alias("n"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(names[F.col("position")].alias("column"), "value", "n")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Occurrences of each value of the columns (the categorical ones by default)."""
    return _counted_values(df, columns).filter(F.col("value").isNotNull())


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, relative_error: float | None = None
) -> DataFrame:
    """Number of distinct values per column, missing ones ignored.

    Exact counts shuffle every distinct value. With ``relative_error`` each
    column is counted by a sketch of fixed size, in one pass without a shuffle
    of values.
    """
    if relative_error is not None:
        return _approximate_distinct_counts(df, list(columns or categorical_columns(df)), relative_error)
    return _counted_values(df, columns).groupBy("column").agg(F.count("value").alias("distinct_values"))


def _approximate_distinct_counts(df: DataFrame, columns: Sequence[str], relative_error: float) -> DataFrame:
    if not columns:
        return _no_columns(df, "column string, distinct_values bigint")
    sketches = [F.approx_count_distinct(_present(df, c), relative_error).alias(f"_{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("distinct_values")) for i, c in enumerate(columns)]
    return _rows_per_column(df.agg(*sketches), rows)


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent values per column, with their share of all rows.

    Ties go to the smaller value. Labels are cut after ranking. Values are ranked
    in parts of each column first, so that for any ``k`` the ranking of a column
    sees ``k`` values per part and not all distinct ones.
    """
    order = [F.col("n").desc(), F.col("value")]
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS))
    in_part = F.row_number().over(Window.partitionBy("column", part).orderBy(*order))
    candidates = value_counts(df, columns).withColumn("position", in_part).filter(F.col("position") <= k)
    in_column = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    ranked = candidates.withColumn("position", in_column)
    total = df.agg(F.count("*").alias("_total"))
    return attach_totals(ranked.filter(F.col("position") <= k), total).select(
        "column",
        F.col("position").cast("bigint").alias("position"),
        value_label("value").alias("value"),
        "n",
        percent_of("n", "_total").alias("percent"),
    )


def _missing_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(_missing(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    return _rows_per_column(
        counts,
        [
            F.struct(
                F.lit(c).alias("column"), F.col(f"_{i}").alias("missing"), F.col("_total").alias("total")
            )
            for i, c in enumerate(df.columns)
        ],
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, most affected first; percentage rounded half even."""
    return (
        _missing_counts(df)
        .filter(F.col("missing") > 0)
        .select("column", "missing", percent_of("missing", "total", half_even=True).alias("missing_percent"))
        .orderBy(F.col("missing").desc(), "column")
    )


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells, all cells and the percentage to four places."""
    totals = _missing_counts(df).agg(
        F.sum("missing").alias("missing_cells"), F.sum("total").alias("total_cells")
    )
    return totals.withColumn("missing_percent", percent_of("missing_cells", "total_cells", 4))


def quality_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns by kind, missing cells and completeness."""
    n_columns = len(df.columns)
    totals = _missing_counts(df).agg(
        F.max("total").alias("n_rows"),
        F.sum("missing").alias("missing_cells"),
        F.sum("total").alias("_cells"),
    )
    return totals.select(
        "n_rows",
        F.lit(n_columns).cast("bigint").alias("n_columns"),
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"),
        F.lit(len(categorical_columns(df))).cast("bigint").alias("categorical_columns"),
        "missing_cells",
        percent_of("missing_cells", "_cells", 4).alias("missing_percent"),
        percent_of(F.col("_cells") - F.col("missing_cells"), "_cells").alias("completeness_percent"),
    )


def data_dictionary(df: DataFrame, relative_error: float | None = None) -> DataFrame:
    """One row per column: type, counts, distinct values and printed extremes.

    Distinct values are counted exactly, or with ``relative_error`` by sketches, which shuffle no values.
    """
    numeric = set(numeric_columns(df))
    extremes = df.agg(
        F.lit(0).alias("_none"),
        *[F.min(_present(df, c)).alias(f"_lo{i}") for i, c in enumerate(df.columns) if c in numeric],
        *[F.max(_present(df, c)).alias(f"_hi{i}") for i, c in enumerate(df.columns) if c in numeric],
    )

    def printed(name: str) -> Column:
        return F.format_string("%.2f", F.col(name).cast("double"))

    bounds = _rows_per_column(
        extremes,
        [
            F.struct(
                F.lit(c).alias("column"),
                (printed(f"_lo{i}") if c in numeric else F.lit("-")).alias("minimum"),
                (printed(f"_hi{i}") if c in numeric else F.lit("-")).alias("maximum"),
            )
            for i, c in enumerate(df.columns)
        ],
    )
    # All three inputs have one row per column of the profiled table.
    return (
        type_census(df)
        .join(F.broadcast(distinct_counts(df, df.columns, relative_error)), "column", "left")
        .join(F.broadcast(bounds), "column")
        .select(
            "column",
            "data_type",
            "non_null",
            (F.col("total") - F.col("non_null")).alias("missing"),
            F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
            "minimum",
            "maximum",
        )
    )
