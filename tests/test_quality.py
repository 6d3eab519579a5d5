import datetime as dt

from helpers import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.operators import quality
from freightloom.plans import marts
from freightloom.schema import MART_SCHEMAS, TABLES


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert rows(quality.not_null(df, ["a", "b c"])) == [("a", 2, 0), ("b c", 2, 1)]


def test_unique_counts_null_keys_as_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,), (2,)], "k int")
    assert rows(quality.unique(df, ["k"])) == [(6, 3, 2, 5)]
    assert rows(quality.unique(df.limit(0), ["k"])) == [(0, 0, 0, 0)]


def test_castable(spark):
    df = spark.createDataFrame([("1", "1.5"), ("x", None), (None, "1d")], "a string, b string")
    assert rows(quality.castable(df, {"a": "bigint", "b": "double"})) == [
        ("a", "bigint", 2, 1), ("b", "double", 2, 1),
    ]


def test_recency(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 12:00:00' AS ts UNION ALL SELECT NULL")
    late = dt.datetime(2020, 1, 3, 11, 59)
    assert rows(quality.recency(df, "ts", 1, late)) == [(dt.datetime(2020, 1, 1, 12), 1, True)]
    assert rows(quality.recency(df, "ts", 0, late))[0][2] is False
    assert rows(quality.recency(df.limit(0), "ts", 1, late)) == [(None, None, None)]


def test_row_counts(spark):
    assert rows(quality.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_contract_reports_every_kind_of_drift(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c string")
    contract = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                             T.StructField("d", T.StringType())])
    assert rows(quality.schema_contract(df, contract)) == [
        ("a", "bigint", "int", "type differs", 1), ("b", "string", "string", "ok", 1),
        ("c", "-", "string", "undeclared", 0), ("d", "string", "-", "missing", 0),
    ]


def test_marts_keep_their_contract(spark):
    shipping = spark.createDataFrame([("a", 1, 2, "m", "Late")], TABLES["shipping"].staged_schema)
    report = quality.schema_contract(marts.payment_delays(shipping), MART_SCHEMAS["payment_delays"])
    assert {r.status for r in report.collect()} == {"ok"}


def rules():
    return {"has id": quality.rule_not_null("id"), "number": quality.rule_castable("t", "double"), "small": F.col("t").try_cast("double") < 10}


def odd(spark):
    return spark.createDataFrame([(1, "5"), (None, "7"), (2, "x"), (3, None), (None, "99"), (4, "1")], "id int, t string")


def test_rows_are_routed_by_the_rules_they_break(spark, tmp_path):
    path, df = str(tmp_path / "checked"), odd(spark)
    quality.write_checked(df, rules(), path)
    quality.write_checked(df.where("false"), rules(), path)  # nothing lands
    assert rows(quality.read_checked(spark, path, df.schema)) == [(1, "5"), (4, "1")]
    aside = quality.read_checked(spark, path, df.schema, quarantine=True)
    assert {(r.id, r.t): r.broken_rules for r in aside.collect()} == {
        (None, "7"): ["has id"], (2, "x"): ["number", "small"], (3, None): ["small"], (None, "99"): ["has id", "small"],
    }
    assert all("quarantine=true" in f for f in aside.inputFiles()) or "PartitionFilters: [isnotnull(quarantine" in plan_of(aside)


def test_all_rules_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "odd")
    odd(spark).write.parquet(path)
    report = quality.rule_report(spark.read.parquet(path), rules())
    assert plan_of(report).count("FileScan parquet") == 1
    assert rows(report) == sorted([("has id", 6, 2), ("number", 6, 1), ("small", 6, 3)])
    assert rows(quality.rule_report(odd(spark).where("false"), rules())) == sorted((name, 0, 0) for name in rules())
    assert quality.passed(quality.with_broken_rules(odd(spark), {})).count() == 6
