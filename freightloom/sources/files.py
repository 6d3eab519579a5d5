"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.projection import quoted

# Texts a data-frame CSV reader takes for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The byte sequences of well-formed UTF-8, each byte as a character of its own.
_WELL_FORMED = (
    r"[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    r"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}"
)
_UNEVEN = "_uneven_record"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def read_parquet_glob(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """All Parquet files under a path or glob as one table.

    ``merge_schema`` reads every footer; leave it off when the files agree.
    """
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_bronze(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Landed order records; raises ``FileNotFoundError`` if nothing has landed.

    The scan's own listing of the files tells, so they are listed once.
    """
    try:
        return read_parquet_glob(spark, path, merge_schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"path does not exist: {path}") from error
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise FileNotFoundError(f"path holds no files: {path}") from error
        raise


def with_row_locator(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``, which together identify a row of a Parquet scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def _decoded(value: Column) -> Column:
    """Text whose characters are the bytes of UTF-8 as real text, without bytes that are not UTF-8."""
    clean = F.regexp_replace(value, f"((?:{_WELL_FORMED})+)|[\\x80-\\xff]", "$1")
    text = F.decode(F.encode(clean, "ISO-8859-1"), "UTF-8")
    return F.when(value.rlike(r"[\x80-\xff]"), text).otherwise(value)


def read_csv_strings(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV records with a header, every value a string.

    An empty value is ``''``; a field that a short record lacks is NULL. Bytes
    that are not UTF-8 are dropped: the file is read with one character a byte,
    and the bytes of each value are decoded then.
    ``multi_line`` is for files with line breaks inside quotes; such files
    cannot be split, so each is read by one task.
    ``columns`` gives the header if it is known, which saves reading it first.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _UNEVEN)
    )
    if columns is None:
        names = reader.csv(path).columns
    else:
        names = [c.encode().decode("latin-1") for c in columns]
    fields = [T.StructField(c, T.StringType()) for c in [*names, _UNEVEN]]
    raw = reader.schema(T.StructType(fields)).csv(path)
    # A record with too few or too many fields comes along as a whole, to count its fields.
    unquoted = F.regexp_replace(F.col(_UNEVEN), r'"(?:[^"]|"")*"', "")
    held = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    raw = raw.withColumn("_held", F.coalesce(held, F.lit(len(names))))
    return raw.select(
        *[
            F.when(F.col("_held") > i, F.coalesce(_decoded(F.col(quoted(c))), F.lit("")))
            .alias(c.encode("latin-1").decode(errors="ignore"))
            for i, c in enumerate(names)
        ]
    )


def _infer_types(df: DataFrame) -> dict[str, str]:
    """bigint, double, boolean or string for each text column, in one aggregation."""
    checks = []
    for i, c in enumerate(df.columns):
        value = F.col(quoted(c))
        checks += [
            F.count(value).alias(f"_n{i}"),
            F.bool_and(
                value.isNull() | (value.rlike(_NUMBER) & value.try_cast("bigint").isNotNull())
            ).alias(f"_long{i}"),
            F.bool_and(value.rlike(_NUMBER)).alias(f"_double{i}"),
            F.bool_and(value.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"_bool{i}"),
        ]
    seen = df.agg(*checks).first()
    types = {}
    for i, c in enumerate(df.columns):
        if seen[f"_n{i}"] == 0:
            types[c] = "double"  # a column without values reads as all NaN
        elif seen[f"_long{i}"]:
            types[c] = "bigint"
        elif seen[f"_double{i}"]:
            types[c] = "double"
        else:
            types[c] = "boolean" if seen[f"_bool{i}"] else "string"
    return types


def read_csv_inferred(
    spark: SparkSession,
    path: str,
    missing: Sequence[str] = MISSING_TEXTS,
    multi_line: bool = False,
) -> DataFrame:
    """CSV records with column types inferred from all values.

    Dates stay text. Texts that stand for a missing value become NULL, and a
    whole-number column keeps its type despite them. Types are checked over
    whole columns, which takes one extra pass over the file.
    """
    text = read_csv_strings(spark, path, multi_line=multi_line)
    text = text.select(
        *[F.when(~F.col(quoted(c)).isin(*missing), F.col(quoted(c))).alias(c) for c in text.columns]
    )
    types = _infer_types(text)
    return text.select(*[F.col(quoted(c)).cast(types[c]).alias(c) for c in text.columns])


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, array_files: bool = False
) -> DataFrame:
    """JSON records: one per line, or with ``array_files`` one array per file."""
    reader = spark.read.option("multiLine", array_files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def register_json_table(spark: SparkSession, name: str, path: str, schema: T.StructType) -> DataFrame:
    """Make landed JSON files queryable by name, without copying them."""
    return spark.catalog.createTable(name, path=path, source="json", schema=schema)
