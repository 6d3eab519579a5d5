"""Flat raw order records derived from the test tables.

One record per line item, all values text, under the raw column names. The SQL
twin of this mapping is in ``checks.sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.functions.dates import ORDER_TS_OUTPUT_PATTERN
from freightloom.operators.projection import standardise_names
from freightloom.plans.staging import stage
from freightloom.session import OWN_FILES, scratch_dir, shuffles_dropped
from freightloom.sources.messages import ORDER_TOPIC

# The day on which ages are measured: just after the newest order.
AS_OF = "2001-08-02 00:00:00"


#: Columns of joined items that flat records are made of.
ITEM_COLUMNS = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
    "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "n_nationkey", "n_name", "r_name",
    "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "home_name", "home_region",
)
#: Those of the customer.
CUSTOMER_ITEM_COLUMNS = ITEM_COLUMNS[-6:]

#: Line items that are joined at a time where they land: the joins shuffle several times what the tables hold.
ITEMS_AT_ONCE = 24_000_000
SHARE = "_share"

_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its schema is read from the file once, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table."""
    return table(spark, sf_dir, "lineitem")


def _text(value: Column | str, type_name: str | None = None) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return (value.cast(type_name) if type_name else value).cast("string")


def _date_text(name: str) -> Column:
    return F.date_format(name, ORDER_TS_OUTPUT_PATTERN)


def joined_items(spark: SparkSession, sf_dir: str, customers: bool = False, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Line items with order, product and supplier details, in the tables' own columns and types.

    ``customers`` adds those of the customer, who is joined to the orders, of which there are fewer than line items.
    ``share``, a number and how many there are, gives those of one share of the orders; each order is in one share.
    """

    def shared(rows: DataFrame, key: str) -> DataFrame:
        number, n = share
        return rows if n == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == number)

    orders = shared(table(spark, sf_dir, "orders"), "o_orderkey")
    if customers:
        home = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("home_key"),
            F.col("n_name").alias("home_name"),
            F.col("n_regionkey").alias("home_region_key"),
        )
        home_region = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("home_region_id"), F.col("r_name").alias("home_region")
        )
        customer = (
            table(spark, sf_dir, "customer")
            .join(home, F.col("c_nationkey") == F.col("home_key"))
            .join(home_region, F.col("home_region_key") == F.col("home_region_id"))
        )
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    # Two fact tables meet in a shuffle, the hint keeps small test tables on that plan too. They meet last: what the
    # orders and customers add is shuffled once per order, and the line items of an order come out side by side.
    return (
        shared(line_items(spark, sf_dir), "l_orderkey")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    )


def shares(spark: SparkSession, sf_dir: str) -> int:
    """In how many shares joined items land."""
    return max(1, -(-line_items(spark, sf_dir).count() // ITEMS_AT_ONCE))


def land(
    spark: SparkSession, sf_dir: str, path: str, made: Callable[[DataFrame], DataFrame], customers: bool = False, by: tuple[str, ...] = ()
) -> int:
    """Write what is ``made`` of the joined items to ``path``, share after share; the number of shares.

    Each share's shuffles are gone before the next begins, so the scratch space does not grow with the tables.
    ``by`` lays the files out in folders; the number of a share is in ``SHARE``, if that is among them.
    """
    n = shares(spark, sf_dir)
    with shuffles_dropped(spark):
        for number in range(n):
            # What the line items of an order repeat lies together, which a file compresses best.
            rows = made(joined_items(spark, sf_dir, customers, (number, n)).sortWithinPartitions("o_orderkey"))
            if SHARE in by:
                rows = rows.withColumn(SHARE, F.lit(number))
            rows.write.mode("append").option("compression", OWN_FILES).partitionBy(*by).parquet(path)
    return n


def landed_orders(spark: SparkSession, sf_dir: str, customers: bool = False) -> DataFrame:
    """The flat records over joined items that have landed in their own types, for several tables to be made of them."""
    path = scratch_dir(spark, "items")
    columns = [c for c in ITEM_COLUMNS if customers or c not in CUSTOMER_ITEM_COLUMNS]
    land(spark, sf_dir, path, lambda joined: joined.select(*columns), customers)
    schema = joined_items(spark, sf_dir, customers).select(*columns).schema
    return flat_records(spark.read.schema(schema).parquet(path), customers)


def flat_records(joined: DataFrame, customers: bool = False) -> DataFrame:
    """Flat records of joined line items: all values text, under the raw column names, plus message metadata."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    status = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("PROCESSING")
    )
    delivery = (
        F.when(F.col("l_returnflag") == "A", "Advance shipping")
        .when(F.col("l_returnflag") == "R", "Late delivery")
        .otherwise("Shipping on time")
    )
    total = price * (F.lit(1).cast("decimal(3,2)") - discount)
    columns = {
        "Product Card Id": _text("l_partkey"),
        "Product Category Id": _text("p_size"),
        "Category Name": F.col("p_type"),
        "Product Description": F.concat_ws(" ", "p_brand", "p_name"),
        "Product Image": F.concat(F.lit("https://example.com/product/"), _text("l_partkey")),
        "Product Name": F.col("p_name"),
        "Product Price": _text("p_retailprice", "decimal(12,2)"),
        "Product Status": _text(F.col("p_size") % 2),
        "Order Id": _text("o_orderkey"),
        "order date (DateOrders)": _date_text("o_orderdate"),
        "Order Customer Id": _text("o_custkey"),
        "Order Item Id": _text("l_linenumber"),
        "Order Item Discount": _text(price * discount),
        "Order Item Discount Rate": _text(discount),
        "Order Item Product Price": _text("p_retailprice", "decimal(12,2)"),
        "Order Item Profit Ratio": _text("l_tax", "decimal(3,2)"),
        "Order Item Quantity": _text("l_quantity", "int"),
        "Sales per customer": _text(total),
        "Sales": _text(price),
        "Order Item Total": _text(total),
        "Order Profit Per Order": _text(price * F.col("l_tax").cast("decimal(3,2)")),
        "Order Status": status,
        "Department Id": _text("n_nationkey"),
        "shipping date (DateOrders)": _date_text("l_shipdate"),
        "Days for shipping (real)": _text(F.datediff("l_shipdate", "o_orderdate")),
        "Days for shipment (scheduled)": F.substring("o_orderpriority", 1, 1),
        "Shipping Mode": F.col("o_orderpriority"),
        "Delivery Status": delivery,
        "Department Name": F.col("n_name"),
        "Market": F.col("r_name"),
        "key": _text("o_orderkey"),
        "offset": _text(F.col("l_partkey") * 100 + F.col("l_linenumber")),
        "partition": _text(F.col("l_suppkey") % 16),
        "time": _text(F.unix_millis(F.col("o_orderdate").cast("timestamp"))),
        "topic": F.lit(ORDER_TOPIC),
    }
    if customers:
        city = F.concat(F.lit("City of "), "home_name")
        state = F.concat(F.lit("State of "), "home_name")
        columns |= {
            "Customer Id": _text("c_custkey"),
            "Customer Email": F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")),
            "Customer Fname": F.split_part("c_name", F.lit("#"), F.lit(1)),
            "Customer Lname": F.split_part("c_name", F.lit("#"), F.lit(2)),
            "Customer Segment": F.col("c_mktsegment"),
            "Customer City": city,
            "Customer Country": F.col("home_name"),
            "Customer State": state,
            "Customer Street": F.concat(_text("c_custkey"), F.lit(" Main Street")),
            "Customer Zipcode": F.lpad(_text(F.col("c_custkey") % 100000), 5, "0"),
            "Order Zipcode": F.lpad(_text("c_nationkey"), 5, "0"),
            "Order City": city,
            "Order State": state,
            "Order Region": F.col("home_region"),
            "Order Country": F.col("home_name"),
            "Latitude": _text("c_nationkey", "decimal(6,2)"),
            "Longitude": _text(-F.col("c_nationkey"), "decimal(6,2)"),
        }
    return joined.select(*[c.alias(name) for name, c in columns.items()])


def flat_orders(spark: SparkSession, sf_dir: str, customers: bool = False) -> DataFrame:
    """Line items with order, product and supplier details, plus message metadata.

    ``customers`` adds the customer and location columns, which need three more joins.
    """
    return flat_records(joined_items(spark, sf_dir, customers), customers)


def named_orders(spark: SparkSession, sf_dir: str, customers: bool = False) -> DataFrame:
    """Flat records under standard names."""
    return standardise_names(flat_orders(spark, sf_dir, customers))


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A staging table over the flat records."""
    return stage(flat_orders(spark, sf_dir, customers=name in ("customer", "location")), name)
