"""Deliveries merged into published months, versions of them, and reads by the index of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightloom.functions import parse_order_ts
from freightloom.operators.projection import standardise_names
from freightloom.plans.deliveries import distinct_customers, merge_delivery
from freightloom.session import scratch_dir
from freightloom.sources.file_index import read_between, refresh_index
from freightloom.sources.snapshots import SnapshotStore

from . import marts  # noqa: F401  registers the SQL that is shared here
from .fixture import AS_OF, ITEM_COLUMNS, SHARE, flat_records, joined_items, land, line_items, shares
from .registry import ORACLES, query
from .sql import over_flat, over_staged, parsed

CUT = "1998-07-01"
#: Months of which half the orders are delivered late, and of which all are delivered again.
LATE, AGAIN = "1997-05", "1997-03"

#: Records that a landed file should have at most, if there are more than 24 files.
FILE_ROWS = 500_000

_merged: dict[tuple[str, str], SnapshotStore] = {}


def landed_items(spark, sf_dir: str, cut: str = CUT) -> tuple[DataFrame, int]:
    """The joined items of two deliveries, and in how many shares they have landed.

    The tables are joined once and land in their own types; the texts are made of them on reading, so that a
    table of a merge reads the columns it has and joins nothing.
    """
    ts, number = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey")
    month = F.date_format(ts, "yyyy-MM")
    late = (ts >= F.lit(cut).cast("timestamp_ntz")) | ((month == LATE) & (number % 2 == 0))
    part = F.when(late, "second").when(~late & (month == AGAIN), "both").when(~late, "first")
    landed = scratch_dir(spark, "delivered")

    def dealt(joined: DataFrame) -> DataFrame:
        return joined.select(*ITEM_COLUMNS, part.alias("_delivery")).where(F.col("_delivery").isNotNull())

    n = land(spark, sf_dir, landed, dealt, customers=True, by=("_delivery", SHARE))
    schema = dealt(joined_items(spark, sf_dir, customers=True)).schema.add(SHARE, T.IntegerType())
    return spark.read.schema(schema).parquet(landed), n


def delivery(items: DataFrame, name: str) -> DataFrame:
    """The flat records of one of the deliveries."""
    return flat_records(items.where(F.col("_delivery").isin("both", name)), customers=True)


def deliveries(spark, sf_dir: str, cut: str = CUT) -> list:
    """The flat records in two deliveries; the second also holds late and repeated records of two old months."""
    items, _ = landed_items(spark, sf_dir, cut)
    return [delivery(items, name) for name in ("first", "second")]


def merged(spark, sf_dir: str) -> SnapshotStore:
    """Both deliveries merged and published, once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _merged:
        store = SnapshotStore(spark, scratch_dir(spark, "published"))
        for delivery in deliveries(spark, sf_dir):
            merge_delivery(spark, store, delivery, as_of=AS_OF)
        _merged[key] = store
    return _merged[key]


def _register(name: str, mart: str) -> None:
    @query(name, ORACLES[f"mart_{mart}"])
    def published(spark, sf_dir):
        return merged(spark, sf_dir).read(mart)


for _name, _mart in {
    "batch_months": "overall_performance",
    "batch_months_retention": "customer_retention_rate",
    "batch_months_commitments": "financial_commitments",
    "batch_months_inventory": "inventory_levels",
    "batch_months_delays": "payment_delays",
}.items():
    _register(_name, _mart)


@query(
    "agg_count_distinct_sketch",
    over_staged(
        "SELECT COUNT(DISTINCT order_customer_id) AS distinct_customers, TRUE AS sketch_is_near FROM stg_order", "order"
    ),
)
def count_distinct_sketch(spark, sf_dir):
    """Distinct customers of all months: counted, and whether the merged sketches of the months are within three standard errors."""
    store = merged(spark, sf_dir)
    orders = store.read("order")
    exact = orders.agg(F.count_distinct("Order_Customer_Id").alias("distinct_customers"))
    estimate = distinct_customers(store).select(F.col("distinct_customers").alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("distinct_customers")) <= 3 * 0.01625 * F.col("distinct_customers")
    return exact.join(F.broadcast(estimate)).select("distinct_customers", near.alias("sketch_is_near"))


_EARLY = f"{parsed('Order_Date')} < TIMESTAMP '{CUT}' AND NOT (strftime({parsed('Order_Date')}, '%Y-%m') = '{LATE}' AND CAST(Order_Id AS BIGINT) % 2 = 0)"


@query(
    "batch_snapshot",
    over_flat(
        " UNION ALL ".join(
            f"SELECT '{moment}' AS moment, '{table}' AS table_name, COUNT(DISTINCT {key}) AS n_rows FROM flat WHERE {wanted}"
            for moment, wanted in (("after a run that died", _EARLY), ("after publishing", "TRUE"))
            for table, key in (
                ("order", "Order_Id"), ("shipping", "(Shipping_date, Shipping_Mode)"), ("product", "Product_Card_Id"),
                ("department", "Department_Id"),
            )
        ),
    ),
)
def snapshot(spark, sf_dir):
    """Rows that readers see after a run that died before it published, and after one that published."""
    store = SnapshotStore(spark, scratch_dir(spark, "published"))
    items, n = landed_items(spark, sf_dir)
    first, second = (delivery(items, name) for name in ("first", "second"))
    merge_delivery(spark, store, first, as_of=AS_OF)
    dead = store.draft()
    parts = [standardise_names(delivery(items.where(F.col(SHARE) == number), "second")) for number in range(n)]
    dead.write("order", parts, F.date_format(parse_order_ts("Order_Date"), "yyyy-MM"))
    dead.keep("shipping")

    def counts(moment):
        return [
            store.read(name).agg(F.lit(moment).alias("moment"), F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
            for name in ("order", "shipping", "product", "department")
        ]

    seen = counts("after a run that died")
    merge_delivery(spark, store, second, as_of=AS_OF)
    rows = seen + counts("after publishing")
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionAll(more)
    return whole


@query(
    "src_skipping_scan",
    over_flat(
        f"""SELECT Order_Id, Order_Item_Id, Order_Date, Product_Card_Id, Sales FROM flat
        WHERE {parsed('Order_Date')} >= TIMESTAMP '1997-02-01' AND {parsed('Order_Date')} < TIMESTAMP '1997-04-01'"""
    ),
)
def skipping_scan(spark, sf_dir):
    """Records of two months, from the landed files that the index says may hold any."""
    landed, index = scratch_dir(spark, "landed"), scratch_dir(spark, "file-index")
    month = F.date_format("o_orderdate", "yyyy-MM")
    files = max(24, -(-line_items(spark, sf_dir).count() // (FILE_ROWS * shares(spark, sf_dir))))

    def by_month(joined: DataFrame) -> DataFrame:
        # By record within a month, as a month alone would be one task's however large it is.
        ranges = joined.repartitionByRange(files, month, "o_orderkey", "l_linenumber", "l_partkey")
        return flat_records(ranges.sortWithinPartitions("o_orderkey"))

    land(spark, sf_dir, landed, by_month)
    refresh_index(spark, landed, index)
    rows = standardise_names(read_between(spark, landed, index, "1997-02-01", "1997-04-01"))
    return rows.select("Order_Id", "Order_Item_Id", "Order_Date", "Product_Card_Id", "Sales")
