import collections

import pytest
from helpers import plan_of, rows

from freightloom.operators import dedup
from freightloom.operators.dedup import dedup_report, dedupe_by_key, duplicate_groups, flag_duplicates
from freightloom.plans.staging import stage
from freightloom.sources import with_row_locator


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), ("b", 5)], "k string, v int")
    assert rows(dedupe_by_key(df, ["k"])) == [("a", 3), ("b", 5), (None, 1)]


def test_equal_rows_collapse(spark):
    df = spark.createDataFrame([(1, 100), (1, 100), (2, 101)], "Order_Id int, Customer_Id int")
    assert rows(dedupe_by_key(df, ["Order_Id"])) == [(1, 100), (2, 101)]


def test_tie_break_and_output(spark):
    df = spark.createDataFrame([("a", 2, 9), ("a", 1, 8), ("b", 3, 7)], "k string, o int, v int")
    assert rows(dedupe_by_key(df, ["k"], ["o"], output=["k", "v"])) == [("a", 8), ("b", 7)]


@pytest.mark.parametrize("repeats", [False, True])
def test_keys_only_frame(spark, repeats):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedupe_by_key(df, ["k"], repeats=repeats)) == [(1,), (2,)]


def test_missing_key_raises_unless_allowed(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="nope"):
        dedupe_by_key(df, ["nope"])
    assert dedupe_by_key(df, ["nope"], missing_ok=True).count() == 2


def test_raw_keys_are_compared_as_text(spark):
    df = spark.createDataFrame([("1", "Fan Shop", "EU"), ("01", "Apparel", "EU")],
                               "Department_Id string, Department_Name string, Market string")
    assert rows(stage(df, "department")) == [(1, "Apparel", "EU"), (1, "Fan Shop", "EU")]


def test_report(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k int")
    assert rows(dedup_report(df, ["k"])) == [(5, 3, 2)]
    assert rows(dedup_report(df.limit(0), ["k"])) == [(0, 0, 0)]


def test_flags_mark_all_but_the_first(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", 3), (None, 4), (None, 5), ("b", 6)], "k string, offset int"
    )
    assert rows(flag_duplicates(df, ["k"], ["offset"])) == sorted(
        [("a", 1, False), ("a", 2, True), ("a", 3, True), (None, 4, False), (None, 5, True), ("b", 6, False)],
        key=repr,
    )


def test_flags_mark_exact_copies(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 1, "x"), ("k", 1, "a"), ("k", 2, "x"), ("k", 2, "x"), (None, None, None)] + [(None, None, None)], "k string, v int, w string")
    assert rows(flag_duplicates(df, ["k"], ["v"])) == sorted(
        [("k", 1, "a", False), ("k", 1, "x", True), ("k", 1, "x", True), ("k", 2, "x", True), ("k", 2, "x", True),
         (None, None, None, False), (None, None, None, True)], key=repr)
    assert flag_duplicates(df.limit(0), ["k"], ["v"]).count() == 0


def test_flags_with_a_third_of_all_rows_equal(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PORTION", 100)
    df = spark.range(9_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "1 AS v")
    flagged = flag_duplicates(df, ["k"], ["v"])
    assert flagged.count() == 9_000 and flagged.filter("NOT duplicate_flag").count() == 6_001
    assert flagged.filter("k = 0 AND NOT duplicate_flag").count() == 1


def test_flags_tell_equal_rows_apart_by_locator(spark, tmp_path):
    spark.createDataFrame([("a",)] * 40 + [("b",)] * 2, "k string").repartition(3).write.parquet(
        str(tmp_path / "t")
    )
    located = with_row_locator(spark.read.parquet(str(tmp_path / "t")))
    flagged = flag_duplicates(located, ["k"], ["_file", "_row"]).select("k", "duplicate_flag")
    assert collections.Counter(rows(flagged)) == {
        ("a", False): 1, ("a", True): 39, ("b", False): 1, ("b", True): 1,
    }


def test_duplicate_groups_over_all_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, None), (None, None)], "a int, b string")
    assert rows(duplicate_groups(df)) == [(1, "x", 2), (None, None, 2)]


def test_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    plan = plan_of(dedupe_by_key(df, ["k"], ["v"]))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_repeats_are_collapsed_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id % 10 AS v")
    plan = plan_of(dedupe_by_key(df, ["k"], repeats=True))
    assert "HashAggregate" in plan[plan.rindex("Exchange"):]


def test_hot_key_holding_a_third_of_all_rows(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    assert dedupe_by_key(df, ["k"], ["v"]).count() == 20_001
    flagged = flag_duplicates(df, ["k"], ["v"])
    assert flagged.filter("duplicate_flag").count() == 9_999
    plan = plan_of(flagged.hint("merge"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
