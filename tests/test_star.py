import pytest
from helpers import rows

from freightloom.operators.projection import (
    select_present,
    standardise_names,
    union_all_by_name,
)
from freightloom.plans.star import split_star, star_table
from freightloom.schema import BUSINESS_TABLES, RAW_COLUMNS, RENAMES, TABLES, standard_name


def raw_frame(spark, records):
    columns = list(records[0])
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in records], schema)


def test_layout():
    assert len(RAW_COLUMNS) == 47
    assert [len(TABLES[t].raw_columns) for t in (*BUSINESS_TABLES, "metadata")] == [10, 8, 7, 16, 5, 3, 5]
    assert standard_name("order date (DateOrders)") == "Order_Date"
    assert standard_name("Days for shipment (scheduled)") == "Days_for_shipping_scheduled"
    assert RENAMES["Customer Id"] == "Customer_Id" and "key" not in RENAMES


def test_select_present_keeps_order_and_warns(spark, caplog):
    df = spark.createDataFrame([(1, 2)], "b int, `a (x)` int")
    assert select_present(df, ["a (x)", "missing", "b"]).columns == ["a (x)", "b"]
    assert "missing" in caplog.text


def test_select_present_without_any_column(spark):
    empty = select_present(spark.range(3), ["x"])
    assert empty.columns == [] and empty.count() == 0


def test_standardise_leaves_other_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Order Id` int, other int, `shipping date (DateOrders)` int")
    assert standardise_names(df).columns == ["Order_Id", "other", "Shipping_date"]



def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("k", 2)], "y string, x int")
    assert rows(union_all_by_name([a, b])) == [(1, None), (2, "k")]


RECORDS = [
    {"Order Id": "1", "Order Item Id": "2", "Sales": "5.0", "Department Id": "3", "Department Name": "Fan Shop",
     "Market": "EU", "shipping date (DateOrders)": "1/2/2018 0:00", "Shipping Mode": "First Class"},
    {"Order Id": "1", "Order Item Id": "1", "Sales": "7.0", "Department Id": "3", "Department Name": "Fan Shop",
     "Market": "EU", "shipping date (DateOrders)": "1/2/2018 0:00", "Shipping Mode": "Same Day"},
    {"Order Id": "2", "Order Item Id": "3", "Sales": "9.0", "Department Id": "4", "Department Name": "Apparel",
     "Market": "EU", "shipping date (DateOrders)": "1/2/2018 0:00", "Shipping Mode": "Same Day"},
]


def test_star_dedupes_under_the_standard_key(spark):
    orders = star_table(raw_frame(spark, RECORDS), "order")
    assert orders.columns == ["Order_Id", "Order_Item_Id", "Sales", "Department_Id"]
    assert rows(orders) == [("1", "1", "7.0", "3"), ("2", "3", "9.0", "4")]


def test_star_without_dedupe_keeps_all_rows(spark):
    assert star_table(raw_frame(spark, RECORDS), "order", dedupe=False).count() == 3


def test_shipping_key_is_date_and_mode(spark):
    assert star_table(raw_frame(spark, RECORDS), "shipping").count() == 2


def test_split_has_all_tables_and_empty_metadata(spark):
    tables = split_star(raw_frame(spark, RECORDS))
    assert list(tables) == [TABLES[t].star_name for t in TABLES]
    assert tables["metadata_dimension"].columns == []
    assert tables["department_dimension"].count() == 2


def test_extractor_can_be_replaced(spark):
    nested = raw_frame(spark, RECORDS).selectExpr("struct(*) AS data")

    def from_data(df, columns):
        return standardise_names(df.select("data.*")).select(
            *[c for c in columns if c in {"Department_Id", "Department_Name", "Market"}]
        )

    departments = star_table(nested, "department", dedupe=False, extract=from_data)
    assert departments.distinct().count() == 2


@pytest.mark.parametrize("name", list(TABLES))
def test_keys_and_types_name_own_columns(name):
    spec = TABLES[name]
    assert set(spec.keys) <= set(spec.columns) and set(spec.types) <= set(spec.columns)
