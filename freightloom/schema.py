"""Table layouts: raw order columns, their standard names, keys and types.

A raw order record is flat and every value is text. ``TABLES`` says which of
its columns belong to which star table, what the key of that table is and which
types the staging step casts to.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: raw column names by table, in record order -----------------

CUSTOMER_COLUMNS = (
    "Customer Id", "Customer Email", "Customer Fname", "Customer Lname", "Customer Segment",
    "Customer City", "Customer Country", "Customer State", "Customer Street", "Customer Zipcode",
)
PRODUCT_COLUMNS = (
    "Product Card Id", "Product Category Id", "Category Name", "Product Description",
    "Product Image", "Product Name", "Product Price", "Product Status",
)
LOCATION_COLUMNS = (
    "Order Zipcode", "Order City", "Order State", "Order Region", "Order Country",
    "Latitude", "Longitude",
)
ORDER_COLUMNS = (
    "Order Id", "order date (DateOrders)", "Order Customer Id", "Order Item Id", "Product Card Id",
    "Order Item Discount", "Order Item Discount Rate", "Order Item Product Price",
    "Order Item Profit Ratio", "Order Item Quantity", "Sales per customer", "Sales",
    "Order Item Total", "Order Profit Per Order", "Order Status", "Department Id",
)
SHIPPING_COLUMNS = (
    "shipping date (DateOrders)", "Days for shipping (real)", "Days for shipment (scheduled)",
    "Shipping Mode", "Delivery Status",
)
DEPARTMENT_COLUMNS = ("Department Id", "Department Name", "Market")
METADATA_COLUMNS = ("key", "offset", "partition", "time", "topic")

# Raw names whose standard name is not simply "blank becomes underscore".
IRREGULAR_NAMES = {
    "order date (DateOrders)": "Order_Date",
    "shipping date (DateOrders)": "Shipping_date",
    "Days for shipping (real)": "Days_for_shipping_real",
    "Days for shipment (scheduled)": "Days_for_shipping_scheduled",
}

# ------------------------------------------------------------------------------


def standard_name(raw: str) -> str:
    """Standard column name of a raw order column."""
    return IRREGULAR_NAMES.get(raw, raw.replace(" ", "_"))


def struct_of(columns: dict[str, str]) -> T.StructType:
    """Schema from column names and SQL type names."""
    by_name = {
        "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType(),
    }
    return T.StructType([T.StructField(name, by_name[kind]) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    """One star table.

    ``keys`` and ``tie_break`` are standard names. ``tie_break`` may name columns
    outside the table: they steer which row of a key survives while they are at
    hand (on the flat records). Together with the keys they identify a record.
    ``repeats`` marks tables whose rows recur on many flat records, so collapsing
    equal rows before the shuffle pays off.
    """

    name: str
    star_name: str
    warehouse_name: str
    raw_columns: tuple[str, ...]
    keys: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)
    tie_break: tuple[str, ...] = ()
    repeats: bool = False
    staged_prefix: str = ""

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(standard_name(c) for c in self.raw_columns)

    def staged_name(self, column: str) -> str:
        return self.staged_prefix + column.lower()

    @property
    def staged_schema(self) -> T.StructType:
        """Schema of the staging table: the contract checked by ``quality.schema_contract``."""
        return struct_of({self.staged_name(c): self.types.get(c, "string") for c in self.columns})


# File names, table names, keys and types.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "customer", "customer_dimension", "dim_customer", CUSTOMER_COLUMNS,
            keys=("Customer_Id",),
            types={"Customer_Id": "bigint"},
            repeats=True,
        ),
        TableSpec(
            "product", "product_dimension", "dim_product", PRODUCT_COLUMNS,
            keys=("Product_Card_Id",),
            types={
                "Product_Card_Id": "bigint",
                "Product_Category_Id": "bigint",
                "Product_Price": "double",
            },
            repeats=True,
        ),
        TableSpec(
            "location", "location_dimension", "dim_location", LOCATION_COLUMNS,
            keys=("Order_Zipcode",),
            types={"Latitude": "double", "Longitude": "double"},
            repeats=True,
        ),
        TableSpec(
            "order", "order_fact", "fact_order", ORDER_COLUMNS,
            keys=("Order_Id",),
            types={
                "Order_Id": "bigint",
                "Order_Customer_Id": "bigint",
                "Order_Item_Id": "bigint",
                "Product_Card_Id": "bigint",
                "Order_Item_Discount": "double",
                "Order_Item_Discount_Rate": "double",
                "Order_Item_Product_Price": "double",
                "Order_Item_Profit_Ratio": "double",
                "Order_Item_Quantity": "bigint",
                "Sales_per_customer": "double",
                "Sales": "double",
                "Order_Item_Total": "double",
                "Order_Profit_Per_Order": "double",
                "Department_Id": "bigint",
            },
            tie_break=("Order_Item_Id", "Product_Card_Id", "Department_Id", "Shipping_date", "Sales"),
        ),
        TableSpec(
            "shipping", "shipping_dimension", "dim_shipping", SHIPPING_COLUMNS,
            keys=("Shipping_date", "Shipping_Mode"),
            types={"Days_for_shipping_real": "bigint", "Days_for_shipping_scheduled": "bigint"},
            tie_break=("Order_Id", "Order_Item_Id", "Product_Card_Id", "Department_Id", "Sales"),
        ),
        TableSpec(
            "department", "department_dimension", "dim_department", DEPARTMENT_COLUMNS,
            keys=("Department_Id",),
            types={"Department_Id": "bigint"},
            repeats=True,
        ),
        TableSpec(
            "metadata", "metadata_dimension", "dim_metadata", METADATA_COLUMNS,
            keys=("key",),
            types={"offset": "bigint", "partition": "bigint", "time": "bigint"},
            tie_break=("topic", "partition", "offset"),
            staged_prefix="metadata_",
        ),
    )
}

BUSINESS_TABLES = ("customer", "product", "location", "order", "shipping", "department")

RAW_COLUMNS: tuple[str, ...] = tuple(
    dict.fromkeys(c for name in BUSINESS_TABLES for c in TABLES[name].raw_columns)
)

RENAMES: dict[str, str] = {
    c: standard_name(c) for c in (*RAW_COLUMNS, *METADATA_COLUMNS) if standard_name(c) != c
}


def all_text(columns) -> T.StructType:
    """Schema in which every column is text, as raw records arrive."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_ORDER_SCHEMA = all_text(RAW_COLUMNS)


def _schema(declaration: str) -> T.StructType:
    """Plain columns of a declaration; Spark's own parser would need a running session."""
    return struct_of(dict(column.split() for column in declaration.split(",")))


# Mart names, columns and types.
MART_SCHEMAS: dict[str, T.StructType] = {
    "customer_retention_rate": _schema(
        "year bigint, month_name string, distinct_customers bigint, "
        "cumulative_customers bigint, customer_retention_rate double"
    ),
    "financial_commitments": _schema(
        "department_name string, market string, category_name string, "
        "total_committed_funds double, commitment_fulfillment_rate double"
    ),
    "fraud_detection": _schema(
        "order_customer_id bigint, avg_order_total double, num_orders bigint"
    ),
    "inventory_levels": _schema(
        "year bigint, month_name string, total_inventory_value double, "
        "inventory_turnover_ratio double, age_range string, inventory_value double"
    ),
    "overall_performance": _schema(
        "year bigint, month_name string, total_sales double, avg_profit_margin double, "
        "avg_actual_shipment_days double, avg_scheduled_shipment_days double"
    ),
    "payment_delays": _schema(
        "delivery_status string, avg_payment_delay double, count_of_orders bigint"
    ),
}
