"""Steps whose tasks must not grow with the input, and steps that go on side by side."""

import datetime as dt
import threading
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

import checks.deliveries
import checks.sources
from freightloom.operators import order_statistics
from freightloom.plans import batch
from freightloom.sources import sinks

N = 3_000


@pytest.fixture(scope="module")
def one_month(spark, tmp_path_factory):
    """Tables whose line items are all of one month."""
    folder = str(tmp_path_factory.mktemp("one_month"))
    when = F.lit(dt.datetime(1997, 3, 4)).cast("timestamp_ntz")
    item = spark.range(N).select(F.col("id").alias("i"))
    tables = {
        "lineitem": item.select(
            F.col("i").alias("l_orderkey"), (F.col("i") % 7).alias("l_partkey"), (F.col("i") % 3).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            F.lit(2.0).alias("l_quantity"), F.lit(10.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.05).alias("l_tax"),
            F.lit("N").alias("l_returnflag"), when.alias("l_shipdate"),
        ),
        "orders": item.select(
            F.col("i").alias("o_orderkey"), (F.col("i") % 5).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
            when.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
        ),
        "part": spark.range(7).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand", "'t' p_type", "3 p_size", "1.5D p_retailprice"),
        "supplier": spark.range(3).selectExpr("id s_suppkey", "'s' s_name", "1 s_nationkey", "0D s_acctbal"),
        "nation": spark.sql("select 1 n_nationkey, 'N' n_name, 1 n_regionkey"),
        "region": spark.sql("select 1 r_regionkey, 'R' r_name"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def kept_in(monkeypatch, module, tmp_path):
    monkeypatch.setattr(module, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))


def records(spark, folder):
    """Records of each file of a folder."""
    return [spark.read.parquet(str(f)).count() for f in Path(folder).glob("*.parquet")]


def test_files_of_one_month_do_not_grow_with_it(spark, one_month, tmp_path, monkeypatch):
    kept_in(monkeypatch, checks.deliveries, tmp_path)
    monkeypatch.setattr(checks.deliveries, "FILE_ROWS", 50)
    assert checks.deliveries.skipping_scan(spark, one_month).count() == N
    held = records(spark, tmp_path / "landed")
    assert sum(held) == N and len(held) >= 50 and max(held) <= 200


def test_star_files_grow_in_number_with_the_input(spark, one_month, tmp_path, monkeypatch):
    kept_in(monkeypatch, checks.sources, tmp_path)
    monkeypatch.setattr(checks.sources, "FILE_ROWS", 100)
    assert checks.sources.star_roundtrip(spark, one_month).count() == N
    held = records(spark, tmp_path / "star" / "order_fact")
    assert sum(held) == N and len(held) == N // 100


class _Meeting:
    """Stands for a table and its writer; a write ends only when another one is under way."""

    columns = ("a",)

    def __init__(self, barrier):
        self.barrier = barrier

    write = property(lambda self: self)

    def mode(self, *_):
        return self

    def option(self, *_):
        return self

    def parquet(self, _):
        self.barrier.wait(timeout=20)


def test_tables_are_written_side_by_side():
    barrier = threading.Barrier(2)
    assert sinks.write_tables({"a": _Meeting(barrier), "b": _Meeting(barrier)}, "/nowhere") == ["a", "b"]


def test_staging_goes_on_side_by_side(spark, tmp_path, monkeypatch):
    barrier = threading.Barrier(2)
    monkeypatch.setattr(batch, "_store_staged", lambda *_: barrier.wait(timeout=20))
    monkeypatch.setattr(batch, "build_marts", lambda *_, **__: pytest.skip("staged"))
    flat = spark.createDataFrame([("1", "1/2/1997 0:00", "2", "N")], ["Order Id", "order date (DateOrders)", "Department Id", "Department Name"])
    flat.write.parquet(str(tmp_path / "bronze"))
    with pytest.raises(pytest.skip.Exception):
        batch.run_batch(spark, str(tmp_path / "bronze"), str(tmp_path / "star"), "side_by_side")


def test_rounds_after_the_first_look_at_few_values(spark, monkeypatch):
    n, seen = 40_000, []
    narrow = order_statistics._narrow
    monkeypatch.setattr(order_statistics, "CARRIED", 20)
    monkeypatch.setattr(order_statistics, "_narrow", lambda df, spans: seen.extend(s.rows for s in spans) or narrow(df, spans))
    spread = spark.range(n).select(((F.col("id") * 7_919) % n).cast("double").alias("v"), (F.col("id") % 2).cast("double").alias("w"))
    found = order_statistics.exact_quantiles(spread, ["v", "w"], (0.25, 0.5, 0.75))
    want = [("v", p, p * (n - 1)) for p in (0.25, 0.5, 0.75)] + [("w", 0.25, 0.0), ("w", 0.5, 0.5), ("w", 0.75, 1.0)]
    assert rows(found) == rows(spark.createDataFrame(want, found.schema))
    assert seen and max(seen) < n // 100
