import json

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from freightloom.plans.analyses import between_dates, nested_records
from freightloom.schema import RAW_ORDER_SCHEMA, all_text, struct_of
from freightloom.sources import (
    decode_messages,
    encode_messages,
    load_full_refresh,
    read_bronze,
    read_csv_inferred,
    read_csv_strings,
    read_json_records,
    read_parquet_glob,
    register_json_table,
    write_tables,
)


def write(path, data):
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_csv_values_stay_text(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'Order Id,Note\n007,"say ""hi"", then"\n,\n1.50, x \n')
    assert rows(read_csv_strings(spark, path)) == [
        ("", ""), ("007", 'say "hi", then'), ("1.50", " x "),
    ]


def test_csv_drops_bytes_that_are_not_utf8(spark, tmp_path):
    path = write(tmp_path / "o.csv", b"a,b\nS\xe3o,\xc3\xa9t\xc3\xa9\n")
    assert rows(read_csv_strings(spark, path)) == [("So", "été")]


def test_csv_keeps_genuine_replacement_characters(spark, tmp_path):
    path = write(tmp_path / "o.csv", "a,ключ\n".encode() + "x\ufffdy,".encode() + b"\xff\xf0\x9f\x98\x80\xe3\n")
    df = read_csv_strings(spark, path)
    assert df.columns == ["a", "ключ"] and rows(df) == [("x\ufffdy", "😀")]


def test_csv_short_records_lack_fields(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'a,b,c\n1\n2,\n"3,3",x\n4,,\n5,6,7,8\n"6\n')
    found = sorted(map(tuple, read_csv_strings(spark, path).collect()))
    assert found[:5] == [("1", None, None), ("2", "", None), ("3,3", "x", None), ("4", "", ""), ("5", "6", "7")]


def test_csv_with_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    assert rows(read_csv_strings(spark, path, multi_line=True)) == [("1", "two\nlines"), ("2", "x")]


def test_csv_with_known_header(spark, tmp_path):
    path = write(tmp_path / "o.csv", "a,b\n1,2\n")
    assert rows(read_csv_strings(spark, path, columns=["a", "b"])) == [("1", "2")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_strings(spark, path, columns=["b", "a"]).collect()


def test_csv_inference_follows_whole_columns(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        "i,f,s,d,b,gap,none\n1,1.5,x,1/5/2018 9:03,True,NA,\n2,2,1d,1/6/2018 9:03,False,7,NaN\n",
    )
    df = read_csv_inferred(spark, path)
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "string", "boolean", "bigint", "double"]
    assert rows(df) == [
        (1, 1.5, "x", "1/5/2018 9:03", True, None, None), (2, 2.0, "1d", "1/6/2018 9:03", False, 7, None),
    ]


def test_guard(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        read_bronze(spark, str(tmp_path / "absent"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match="no files"):
        read_bronze(spark, str(tmp_path / "empty"))
    spark.range(1).write.parquet(str(tmp_path / "full"))
    assert read_bronze(spark, str(tmp_path / "full")).count() == 1


def test_parquet_glob_merges_schemas_and_odd_names(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "`Order Id` string, `a (b)` string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([("2",)], "`Order Id` string").write.parquet(str(tmp_path / "p2"))
    df = read_parquet_glob(spark, str(tmp_path / "p*"), merge_schema=True)
    assert rows(df.select("`Order Id`", "`a (b)`")) == [("1", "x"), ("2", None)]


def test_json_arrays_and_lines(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps([{"a": "1"}, {"a": "2"}], indent=2))
    write(tmp_path / "l.json", '{"a": "3"}\n{"a": "4"}\n')
    assert rows(read_json_records(spark, str(tmp_path / "a.json"), "a string", array_files=True)) == [("1",), ("2",)]
    assert rows(read_json_records(spark, str(tmp_path / "l.json"))) == [("3",), ("4",)]


def test_json_table(spark, tmp_path):
    write(tmp_path / "l.json", '{"a": "3"}\n{"a": "4"}\n')
    register_json_table(spark, "landed_lines", str(tmp_path), struct_of({"a": "string"}))
    assert spark.sql("SELECT count(*) FROM landed_lines WHERE a > '3'").first()[0] == 1


def test_messages_keep_nulls_and_key_rules(spark):
    df = spark.createDataFrame([("7", "x", None), ("", "y", "z"), (None, None, "w")],
                               "`Order Id` string, a string, b string")
    sent = encode_messages(df)
    assert rows(sent.select("key")) == [("7",), (None,), (None,)]
    assert json.loads(sent.filter("key = '7'").first()["value"]) == {"Order Id": "7", "a": "x", "b": None}
    back = decode_messages(sent, all_text(df.columns), with_metadata=False)
    assert rows(back) == rows(df)


def test_messages_without_the_key_column(spark):
    assert rows(encode_messages(spark.createDataFrame([("x",)], "a string")).select("key")) == [(None,)]


def test_decode_adds_metadata_as_text(spark):
    df = spark.sql(
        """SELECT CAST('7' AS BINARY) AS key, CAST('{"a": "x", "extra": 1}' AS BINARY) AS value, 't' AS topic,
        3 AS partition, 11L AS offset, TIMESTAMP '2020-01-01 00:00:00' AS timestamp"""
    )
    decoded = decode_messages(df, all_text(["a"]))
    assert decoded.columns == ["a", "key", "offset", "partition", "time", "topic"]
    assert rows(decoded) == [("x", "7", "11", "3", "1577836800000", "t")]


def test_malformed_messages(spark):
    df = spark.createDataFrame([("{broken",)], "value string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode_messages(df, RAW_ORDER_SCHEMA).collect()
    lenient = decode_messages(df, all_text(["a"]), malformed="PERMISSIVE")
    assert rows(lenient) == [(None,)]


def test_tables_are_overwritten_and_empty_ones_skipped(spark, tmp_path):
    path = str(tmp_path / "star")
    none = spark.range(0).select()
    assert write_tables({"a": spark.range(5), "none": none}, path, partitions=2) == ["a"]
    assert write_tables({"a": spark.range(3)}, path, compression="zstd") == ["a"]
    assert spark.read.parquet(f"{path}/a").count() == 3


def test_partitioned_tables_are_pruned(spark, tmp_path):
    path = str(tmp_path / "star")
    df = spark.range(20).withColumn("order_year", F.col("id") % 4)
    write_tables({"fact": df}, path, partition_by={"fact": ["order_year"]})
    read = spark.read.parquet(f"{path}/fact").filter("order_year = 2")
    assert read.count() == 5 and "PartitionFilters: [isnotnull(order_year" in plan_of(read)


def test_full_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "star")
    spark.sql("CREATE DATABASE IF NOT EXISTS refresh_test")
    for n in (4, 2):
        write_tables({"order_fact": spark.range(n)}, path)
        assert load_full_refresh(spark, path, "refresh_test", {"order_fact": "fact_order"}) == [
            "refresh_test.fact_order"
        ]
    assert spark.table("refresh_test.fact_order").count() == 2


def test_nested_records(spark):
    df = spark.sql(
        """SELECT map('Order Id', '1', 'Sales', '2.5') AS data,
        named_struct('key', 'k', 'offset', '5', 'partition', '0', 'time', '9', 'topic', 't') AS metadata"""
    )
    assert rows(nested_records(df, ["Sales", "Order Id"])) == [("2.5", "1", "k", "5", "0", "9", "t")]


def test_date_filter_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(between_dates(orders, "o_orderdate", "1997-01-01", "1998-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
