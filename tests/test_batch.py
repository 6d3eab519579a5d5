import pytest
from checks.fixture import AS_OF, flat_orders
from helpers import plan_of, rows
from pyspark.sql import functions as F

from freightloom.plans import marts
from freightloom.plans.batch import run_batch
from freightloom.plans.staging import stage
from freightloom.schema import MART_SCHEMAS, TABLES


def test_batch_run_from_landed_records_to_marts(spark, sf_dir, tmp_path):
    bronze, star = str(tmp_path / "bronze"), str(tmp_path / "star")
    flat_orders(spark, sf_dir, customers=True).write.parquet(bronze)
    for _ in range(2):  # a rerun replaces everything
        built = run_batch(spark, bronze, star, "batch_test", as_of=AS_OF)
    assert built == [f"batch_test.{name}" for name in MART_SCHEMAS]

    landed = spark.read.parquet(bronze)
    staged = {name: stage(landed, name) for name in ("order", "shipping", "product", "department")}
    want = marts.build_marts(staged, as_of=AS_OF)
    for name in MART_SCHEMAS:
        assert rows(spark.table(f"batch_test.{name}")) == rows(want[name]), name
    assert "Window" not in plan_of(spark.table("stg_shipping"))  # stored, not deduplicated again
    findings = spark.table("batch_test.quality_findings")
    assert findings.filter("failures > 0").collect() == []
    assert {r.check for r in findings.select("check").distinct().collect()} == {"not_null", "unique", "contract"}
    assert spark.table("stg_metadata").columns == TABLES["metadata"].staged_schema.fieldNames()


def test_star_tables_scan_only_their_own_columns(spark, sf_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    flat_orders(spark, sf_dir).write.parquet(bronze)
    plan = plan_of(stage(spark.read.parquet(bronze), "department"))
    assert "ReadSchema: struct<Department Id:string,Department Name:string,Market:string>" in plan


def test_batch_without_metadata_or_customers(spark, sf_dir, tmp_path):
    """Tables whose columns never landed are skipped, not failed."""
    bronze, star = str(tmp_path / "bronze"), str(tmp_path / "star")
    flat = flat_orders(spark, sf_dir)
    flat.drop("key", "offset", "partition", "time", "topic").write.parquet(bronze)
    run_batch(spark, bronze, star, "partial_test", as_of=AS_OF)
    assert {t.name for t in spark.catalog.listTables("partial_test")} >= {"fact_order", "payment_delays"}
    assert not spark.catalog.tableExists("partial_test.dim_metadata")


def test_a_month_filter_skips_folders(spark, sf_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    flat_orders(spark, sf_dir).write.parquet(bronze)
    run_batch(spark, bronze, str(tmp_path / "star"), "pruned_test", as_of=AS_OF)
    orders = spark.table("pruned_test.stg_order")
    month = orders.filter((F.col("order_year") == 1997) & (F.col("order_month") == 3))
    assert 0 < month.count() < orders.count() / 20
    plan = plan_of(month)
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert len(month.inputFiles()) < len(orders.inputFiles()) or "order_month" in plan
    assert orders.filter("year(order_ts) <> order_year OR month(order_ts) <> order_month").count() == 0


@pytest.fixture(scope="module")
def delivered(spark, sf_dir):
    """The records in three deliveries by date."""
    flat = flat_orders(spark, sf_dir, customers=True).cache()
    year = F.substring_index(F.split("order date (DateOrders)", " ")[0], "/", -1).cast("int")
    return [flat.filter(year < 1997), flat.filter((year >= 1997) & (year < 2000)), flat.filter(year >= 2000)], flat


def test_incremental_runs_give_what_a_full_run_gives(spark, delivered, tmp_path):
    deliveries, flat = delivered
    bronze, whole = str(tmp_path / "bronze"), str(tmp_path / "whole")
    for part in deliveries:
        part.write.mode("append").parquet(bronze)
        run_batch(spark, bronze, str(tmp_path / "star"), "step_test", as_of=AS_OF, incremental=True)
    flat.write.parquet(whole)
    run_batch(spark, whole, str(tmp_path / "other"), "whole_test", as_of=AS_OF)
    tables = [*MART_SCHEMAS, *(f"stg_{name}" for name in TABLES)]
    for name in tables:
        assert rows(spark.table(f"step_test.{name}")) == rows(spark.table(f"whole_test.{name}")), name
    # A run without anything new changes nothing.
    run_batch(spark, bronze, str(tmp_path / "star"), "step_test", as_of=AS_OF, incremental=True)
    for name in tables:
        assert rows(spark.table(f"step_test.{name}")) == rows(spark.table(f"whole_test.{name}")), name


def test_an_indexed_incremental_run_opens_only_new_files(spark, delivered, tmp_path, monkeypatch):
    from freightloom.plans import batch

    deliveries, flat = delivered
    bronze, index, star = str(tmp_path / "bronze"), str(tmp_path / "index"), str(tmp_path / "star")
    opened = []
    read = batch.read_files
    monkeypatch.setattr(batch, "read_files", lambda spark, files, schema: opened.append(files) or read(spark, files, schema))
    for part in deliveries:
        part.coalesce(2).write.mode("append").parquet(bronze)
        run_batch(spark, bronze, star, "indexed_test", as_of=AS_OF, incremental=True, index_path=index)
    landed = len(spark.read.parquet(bronze).inputFiles())
    assert [len(files) <= 4 for files in opened] == [True, True] and landed == 6
    whole = {name: stage(flat, name) for name in ("order", "shipping", "product", "department")}
    for name, mart in marts.build_marts(whole, as_of=AS_OF).items():
        assert rows(spark.table(f"indexed_test.{name}")) == rows(mart), name
    # Survivors are kept for the next run only.
    assert [p.name for p in (tmp_path / "star" / "_survivors").iterdir()] == ["3"]


def test_deliveries_that_split_a_timestamp_and_hold_null_dates(spark, sf_dir, tmp_path):
    """Records of one time land in two deliveries, as do records without a date and with an unreadable one."""
    date, order = "order date (DateOrders)", F.col("Order Id").cast("long")
    number = F.pmod(F.xxhash64(order), F.lit(40))
    years = F.substring_index(F.split(date, " ")[0], "/", -1).cast("int")
    flat = flat_orders(spark, sf_dir, customers=True).withColumn("_year", years).withColumn(
        date, F.when(number == 0, None).when(number == 1, "no date").when(F.col("_year") == 1996, "12/31/1996 10:00").otherwise(F.col(date))
    ).cache()
    later = (F.col("_year") > 1996) | (F.pmod(F.xxhash64(order, F.lit(1)), F.lit(2)) == 1) & ((F.col("_year") == 1996) | (number < 2))
    bronze, whole = str(tmp_path / "bronze"), str(tmp_path / "whole")
    for part in (flat.filter(~later), flat.filter(later)):
        part.drop("_year").write.mode("append").parquet(bronze)
        run_batch(spark, bronze, str(tmp_path / "star"), "tie_test", as_of=AS_OF, lenient_dates=True, incremental=True)
    flat.drop("_year").write.parquet(whole)
    run_batch(spark, whole, str(tmp_path / "other"), "tie_whole_test", as_of=AS_OF, lenient_dates=True)
    for name in [*MART_SCHEMAS, *(f"stg_{name}" for name in TABLES)]:
        assert rows(spark.table(f"tie_test.{name}")) == rows(spark.table(f"tie_whole_test.{name}")), name


def test_a_table_without_its_key_does_not_grow_by_records_read_again(spark, delivered):
    from freightloom.operators.projection import standardise_names
    from freightloom.plans.batch import _survivors

    flat = standardise_names(delivered[1].limit(200))
    spec = TABLES["department"]
    keyless = flat.drop(*spec.keys)
    kept = {spec.star_name: _survivors(keyless, {}, keyless)[spec.star_name]}
    again = _survivors(keyless.limit(50), kept, keyless)[spec.star_name]
    assert again.count() == kept[spec.star_name].count() == 200


def test_findings_name_what_is_wrong(spark, sf_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    flat = flat_orders(spark, sf_dir)
    broken = flat.limit(1).withColumn("Order Id", F.lit("no number")).withColumn("Product Card Id", F.lit(None).cast("string"))
    flat.union(broken).write.parquet(bronze)
    run_batch(spark, bronze, str(tmp_path / "star"), "broken_test", as_of=AS_OF)
    bad = spark.table("broken_test.quality_findings").filter("failures > 0")
    assert rows(bad.select("check", "table_name", "subject")) == [
        ("not_null", "order", "order_id"), ("not_null", "product", "product_card_id"),
    ]
