import datetime as dt
import math
import random

import pytest
from helpers import rows, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freightloom.functions import (
    age_bucket,
    exact_avg,
    exact_sum,
    exact_sum_product,
    message_key,
    month_calendar,
    parse_order_ts,
    percent_of,
    rounded_ratio,
    safe_cast,
    safe_divide,
    value_label,
    whole_days_between,
)
from freightloom.functions.dates import as_of_column, now_utc


def text_frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "s string")


def test_safe_cast_to_integer(spark):
    df = text_frame(spark, ["12", " 12 ", "12.0", "1e3", "", "abc", None])
    assert values(df.select(safe_cast("s", "bigint"))) == [12, 12, None, None, None, None, None]


def test_safe_cast_to_float_refuses_java_suffixes(spark):
    df = text_frame(spark, ["12.5", "1e3", "1d", "2.5F", "", "abc", None, "inf"])
    assert values(df.select(safe_cast("s", "double"))) == [12.5, 1000.0, None, None, None, None, None, math.inf]


def test_parse_accepts_padded_and_unpadded(spark):
    df = text_frame(spark, ["1/5/2018 9:03", "01/05/2018 09:03", "01/15/2020 10:30", None])
    assert values(df.select(parse_order_ts("s"))) == [
        dt.datetime(2018, 1, 5, 9, 3), dt.datetime(2018, 1, 5, 9, 3), dt.datetime(2020, 1, 15, 10, 30), None,
    ]


def test_parse_strict_and_lenient(spark):
    df = text_frame(spark, ["2018-01-05"])
    assert values(df.select(parse_order_ts("s", lenient=True))) == [None]
    with pytest.raises(PySparkException, match="not an order date"):
        df.select(parse_order_ts("s")).collect()


def test_parse_does_not_depend_on_the_session_zone(spark):
    df = text_frame(spark, ["3/10/2019 2:30"])  # does not exist in New York
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        days = whole_days_between(parse_order_ts("s"), as_of_column("2019-03-12 02:30:00"))
        assert rows(df.select(F.month(parse_order_ts("s")), days)) == [(3, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_days_truncate(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (TIMESTAMP_NTZ '2020-01-01 12:00:00', TIMESTAMP_NTZ '2020-01-02 11:59:00'),
        (TIMESTAMP_NTZ '2020-01-01 12:00:00', TIMESTAMP_NTZ '2020-01-02 12:00:00'),
        (TIMESTAMP_NTZ '2020-01-02 12:00:00', TIMESTAMP_NTZ '2020-01-01 00:00:00') AS t(a, b)"""
    )
    assert values(df.select(whole_days_between("a", "b"))) == [0, 1, -1]


def test_age_buckets(spark):
    df = spark.createDataFrame([(d,) for d in (-5, 0, 30, 31, 60, 61, 90, 91, None)], "d int")
    assert values(df.select(age_bucket("d"))) == [
        "0-30 days", "0-30 days", "0-30 days", "31-60 days", "31-60 days", "61-90 days", "61-90 days",
        "Over 90 days", "Over 90 days",
    ]


def test_as_of_takes_aware_times_as_utc(spark):
    aware = dt.datetime(2020, 1, 1, 1, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert values(spark.range(1).select(as_of_column(aware))) == [dt.datetime(2019, 12, 31, 23)]


def test_now_is_utc(spark):
    now = values(spark.range(1).select(now_utc()))[0]
    assert abs(now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=1)


def test_safe_divide_and_percent(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (3337, 20000), (343, 20000)], "a int, b int")
    assert values(df.select(safe_divide("a", "b")))[:2] == [None, 0.25]
    assert values(df.select(percent_of("a", "b"))) == [None, 25.0, 16.69, 1.72]


def test_percent_half_even(spark):
    df = spark.createDataFrame([(3337, 20000), (343, 20000), (3339, 20000)], "a int, b int")
    assert values(df.select(percent_of("a", "b", half_even=True))) == [16.68, 1.72, 16.7]


def test_round_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (-0.125,)], "x double")
    assert values(df.select(F.round("x", 2))) == [2.68, 0.13, -0.13]


def test_message_key_and_label(spark):
    df = text_frame(spark, ["", "17", None, "x" * 60])
    assert values(df.select(message_key("s")))[:3] == [None, "17", None]
    assert values(df.select(value_label("s")))[3] == "x" * 50


def test_month_calendar(spark):
    months = rows(month_calendar(spark))
    assert len(months) == 12 and (1, "January") in months and (12, "December") in months


def test_exact_sums_do_not_depend_on_order(spark):
    amounts = [round(random.Random(1).uniform(-1e6, 1e6), 4) for _ in range(1)] + [0.1] * 999
    for seed in (1, 2, 3):
        shuffled = amounts[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame([(a,) for a in shuffled], "x double").repartition(7)
        total = df.agg(exact_sum("x")).first()[0]
        assert total == round(amounts[0] + 99.9, 4)


def test_exact_sum_falls_back_to_doubles(spark):
    df = spark.createDataFrame([(1e300,), (1.0,), (None,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == 1e300
    nan = spark.createDataFrame([(math.nan,), (1.0,)], "x double")
    assert math.isnan(nan.agg(exact_sum("x")).first()[0])


def test_exact_aggregates_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None, None)], "x double, n bigint")
    assert df.agg(exact_sum("x"), exact_avg("x"), exact_sum_product("x", "n"), exact_avg("x", 2)).first() == (
        None, None, None, None,
    )


def test_average_rounds_ties_up(spark):
    df = spark.createDataFrame([(70911.24, 24)], "total double, n bigint")
    assert df.select(rounded_ratio(F.col("total"), F.col("n"), 2)).first()[0] == 2954.64


def test_sum_product_multiplies_exactly(spark):
    df = spark.createDataFrame([(0.1, 3)] * 10, "price double, n bigint")
    assert df.agg(exact_sum_product("price", "n")).first()[0] == 3.0
