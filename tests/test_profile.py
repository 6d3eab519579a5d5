import math
import random

import numpy as np
import pandas as pd
import pytest
from helpers import plan_of, rows, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightloom.operators import limits, order_statistics, profile
from freightloom.operators.limits import capped, head, top_k
from freightloom.operators.order_statistics import column_extents, exact_quantiles, values_at_ranks
from freightloom.sources import write_data_dictionary


@pytest.fixture(scope="module")
def gappy(spark):
    return spark.createDataFrame(
        [(1, 1.0, "x", None), (2, None, "y", None), (3, math.nan, "y", None), (None, -0.0, None, None)],
        "n int, v double, s string, empty string",
    )


def test_shape_and_types(gappy):
    assert rows(profile.shape(gappy)) == [(4, 4)]
    assert rows(profile.type_census(gappy)) == [
        ("empty", "string", "categorical", 0, 4), ("n", "int", "numeric", 3, 4),
        ("s", "string", "categorical", 3, 4), ("v", "double", "numeric", 2, 4),
    ]


def test_missing_counts_nan_and_sorts(gappy):
    assert [tuple(r) for r in profile.missing_values(gappy).collect()] == [
        ("empty", 4, 100.0), ("v", 2, 50.0), ("n", 1, 25.0), ("s", 1, 25.0),
    ]
    assert rows(profile.missing_total(gappy)) == [(8, 16, 50.0)]


def test_nothing_missing_gives_no_rows(spark):
    assert profile.missing_values(spark.range(3)).count() == 0


def test_quality_summary(gappy):
    assert rows(profile.quality_summary(gappy)) == [(4, 4, 2, 2, 8, 50.0, 50.0)]


def test_distinct_ignores_missing_and_keeps_empty_columns(gappy):
    assert rows(profile.distinct_counts(gappy)) == [("empty", 0), ("s", 2)]


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"] + [(None,), ("z" * 60,)], "s string")
    found = rows(profile.top_values(df, k=3))
    assert found == [("s", 1, "a", 2, 25.0), ("s", 2, "b", 2, 25.0), ("s", 3, "c", 1, 12.5)]
    longest = profile.top_values(df).filter(F.length("value") > 10)
    assert values(longest.select("value")) == ["z" * 50]


def test_numeric_summary_matches_pandas(spark):
    rng = random.Random(3)
    data = pd.DataFrame({
        "a": [rng.gauss(10, 3) for _ in range(501)],
        "b": [float(rng.randrange(5)) if rng.random() > 0.2 else math.nan for _ in range(501)],
    })
    found = {r["column"]: r for r in profile.numeric_summary(spark.createDataFrame(data), digits=None).collect()}
    for name, want in data.describe().items():
        got = found[name]
        assert got["count"] == want["count"]
        for key, field in (("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "q25"), ("50%", "median"),
                           ("75%", "q75"), ("max", "max")):
            assert got[field] == pytest.approx(want[key], rel=1e-9), (name, key)
        assert got["iqr"] == pytest.approx(want["75%"] - want["25%"], rel=1e-9)


def test_numeric_summary_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    found = {r["column"]: r for r in profile.numeric_summary(df).collect()}
    assert found["a"]["count"] == 0 and found["a"]["median"] is None and found["b"]["median"] == 1.0


def test_approximate_summary_has_the_same_columns(gappy):
    exact, sketch = profile.numeric_summary(gappy), profile.numeric_summary(gappy, approximate=True)
    assert exact.columns == sketch.columns and sketch.count() == 2


@pytest.mark.parametrize(
    "data",
    [
        list(range(1000)),
        [0.0] * 400 + [1.0] * 200 + [2.5],
        [math.exp(x / 20) for x in range(-500, 700)],
        [1e300, -1e300] + [x / 7 for x in range(500)],
        [5e-324, 0.0, 1e-323] * 30,
        [-math.inf, math.inf] + [float(x) for x in range(100)],
        [math.inf] * 70 + [-math.inf] * 30,
        [10.0**x for x in range(-300, 300)] * 9,
        [1.0] * 5000 + [2.0] * 5000,
        [1.0] * 4999 + [2.0] * 5001 + [3.0, 0.0],
    ],
)
def test_narrowing_finds_exact_quantiles(spark, data, monkeypatch):
    """A coarse sketch forces several rounds."""
    monkeypatch.setattr(order_statistics, "ACCURACY", 50)
    monkeypatch.setattr(order_statistics, "GRID", 25)
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = exact_quantiles(df, ["x"], probabilities)
    got = {r["probability"]: r["quantile"] for r in found.collect()}
    with np.errstate(invalid="ignore"):
        for p in probabilities:
            want = np.quantile(np.array(data, dtype=float), p)
            if np.isnan(want):  # between equal infinities; the value itself is as good
                assert math.isinf(got[p])
            else:
                assert got[p] == pytest.approx(want, rel=1e-12), p


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=60), st.floats(0, 1))
def test_quantiles_by_property(spark, data, p):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    found = exact_quantiles(df, ["x"], [p]).first()["quantile"]
    assert found == pytest.approx(np.quantile(data, p), rel=1e-9, abs=1e-6)


def test_values_at_ranks(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 3, 9, None]], "x bigint")
    found = values_at_ranks(df, {"x": range(5)}, column_extents(df, ["x"]))
    assert found == {("x", 0): 3.0, ("x", 1): 3.0, ("x", 2): 5.0, ("x", 3): 9.0}


def test_no_task_holds_a_column(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    assert "Window" not in plan_of(exact_quantiles(df, ["x"], [0.5]))
    assert "Window" not in plan_of(capped(df, 5_000, ["x"]))


@pytest.mark.parametrize("n", [0, 1, 700, 1500, 2999, 3000, 3001, 9000])
@pytest.mark.parametrize("order", [["k", "v"], ["t", "v"], ["d", "k", "v"], ["same", "v"], ["same"]])
def test_cap_for_any_order_columns(spark, monkeypatch, n, order):
    monkeypatch.setattr(limits, "SAMPLE_KEYS", 50)
    monkeypatch.setattr(limits, "PIVOTS", 4)
    df = spark.range(3000).select(
        F.when(F.col("id") != 7, F.col("id") % 97).alias("k"), F.col("id").cast("int").alias("v"),
        F.concat(F.lit("order-"), F.col("id") % 13).alias("t"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 31).cast("int")).alias("d"),
        F.lit(1.5).alias("same"),
    )
    got = capped(df, n, order)
    assert got.count() == min(n, 3000)
    if order != ["same"]:
        assert rows(got.select(order)) == rows(df.orderBy(*order).limit(n).select(order))


def test_cap_of_nothing(spark):
    df = spark.range(0)
    assert capped(df, 5, ["id"]).count() == 0
    assert capped(df, None, ["id"]) is df


def test_head_and_top_k(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "a int, b int")
    assert [r.a for r in head(df).collect()] == [0, 1, 2, 3, 4]
    assert [r.a for r in top_k(df, "b", 2, ["a"]).collect()] == [2, 5]


def test_dictionary_round_trip(spark, gappy, tmp_path):
    dictionary = profile.data_dictionary(gappy)
    assert rows(dictionary) == [
        ("empty", "string", 0, 4, 0, "-", "-"), ("n", "int", 3, 1, 3, "1.00", "3.00"),
        ("s", "string", 3, 1, 2, "-", "-"), ("v", "double", 2, 2, 2, "-0.00", "1.00"),
    ]
    path = str(tmp_path / "dictionary")
    write_data_dictionary(dictionary, path)
    assert rows(spark.read.schema(dictionary.schema).option("header", True).csv(path)) == rows(dictionary)


def test_zero_and_negative_zero_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "v double")
    assert rows(profile.distinct_counts(df, ["v"])) == [("v", 1)]


def test_tables_without_text_or_numbers(spark):
    text, number = spark.createDataFrame([("a",)], "s string"), spark.createDataFrame([(1,)], "n int")
    assert profile.numeric_summary(text).collect() == []
    assert profile.numeric_summary(text).columns == profile.numeric_summary(number).columns
    assert profile.numeric_summary(text).dtypes == profile.numeric_summary(number).dtypes
    for report in (profile.distinct_counts, profile.top_values, profile.value_counts):
        assert report(number).collect() == []
        assert report(number).dtypes == report(text).dtypes
    assert profile.distinct_counts(number, relative_error=0.05).collect() == []


def test_approximate_distinct_counts(spark):
    df = spark.range(5000).select((F.col("id") % 700).cast("string").alias("a"), F.lit("x").alias("b"))
    found = dict(rows(profile.distinct_counts(df, relative_error=0.02)))
    assert found["b"] == 1 and abs(found["a"] - 700) < 70


def test_many_top_values(spark):
    df = spark.range(4000).select((F.col("id") % 3000).cast("string").alias("a"))
    found = [(r.value, r.n) for r in profile.top_values(df, k=2000).orderBy("position").collect()]
    want = sorted(((str(v), 2 if v < 1000 else 1) for v in range(3000)), key=lambda x: (-x[1], x[0]))[:2000]
    assert found == want
