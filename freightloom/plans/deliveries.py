"""Deliveries merged into published months: only what a delivery changes is rewritten.

The orders that survive are kept by month of the order, shipments by month of the shipping date, dimensions in
groups of their key. A delivery is reduced to the first record of each key, compared with the kept record of
that key, and only months and groups in which a record is new or replaced are written anew. Beside the records
lie partial figures of each month, which add up: the marts are made from them, without a look at the records
of other months. All tables of a run are published as one version (``sources.snapshots``).

Kept records of a delivery's keys are looked up in few parts. Where the key tells the part, those parts are
read; an order's month may change with its record, so there the parts are read whose key bounds overlap the
delivery's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import decimal_sum, exact_sum, parse_order_ts, safe_divide, sum_of_parts
from ..operators.dedup import dedupe_by_key
from ..operators.monthly import by_month, month_columns, order_time
from ..operators.projection import quoted, standardise_names
from ..schema import TABLES, TableSpec
from ..session import LARGE_SIDE_BY_SIDE, OWN_FILES, scratch_dir, shuffles_dropped, together
from ..sources.snapshots import Draft, SnapshotStore, remove_folder
from . import marts
from .staging import stage
from .star import star_survivors

#: Groups of keys that a dimension is kept in.
KEY_GROUPS = 8
#: Part of records without a readable date.
UNDATED = "undated"
#: Bits of a customer sketch's registers; its standard error is 1.04 / sqrt(2 ** bits).
SKETCH_BITS = 12

#: Partial figures with a part for each month, and those of a few rows a month, which are one part.
MONTHLY_PARTS, ONE_PART = ("month_products", "time_inventory"), ("month_figures", "month_customers", "month_shipping")
PARTIALS = (*MONTHLY_PARTS, *ONE_PART)
MONTH_LABEL = "month_label"

_OLD = "_kept_before"


@dataclass(frozen=True)
class Layout:
    """Which part a record belongs to, and whether its key alone tells."""

    label: Column
    by_key: bool
    #: Key column whose whole-number bounds are noted, where the key does not tell the part.
    bounds: str | None = None


def _month(date: str, lenient: bool) -> Column:
    return F.coalesce(F.date_format(parse_order_ts(quoted(date), lenient), "yyyy-MM"), F.lit(UNDATED))


def layout(spec: TableSpec, lenient: bool = False) -> Layout:
    """How a table is parted."""
    if spec.name == "order":
        return Layout(_month("Order_Date", lenient), False, spec.keys[0])
    if spec.name == "shipping":
        return Layout(_month("Shipping_date", True), True)  # shipping dates are text in the marts
    group = F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in spec.keys]), F.lit(KEY_GROUPS))
    return Layout(F.format_string("group-%02d", group), True)


def merge_records(draft: Draft, spec: TableSpec, delivered: DataFrame, lenient: bool = False) -> list[str]:
    """Merge a delivery into the kept records of a table, one for each key; labels of the parts written.

    Of a kept and a delivered record the one first in the tie-break order survives; of two that tie the kept
    one. A part in which nothing changes is taken over as it is. The columns of the first delivery are the
    table's; a later one without some of them has NULL there, and other new columns are not kept.
    """
    new = star_survivors(delivered, spec)
    if not new.columns or any(k not in new.columns for k in spec.keys):
        draft.keep(spec.name)
        return []
    how = layout(spec, lenient)
    bound = F.col(quoted(how.bounds)) if how.bounds else None
    if not draft.old_parts(spec.name):
        return draft.write(spec.name, new, how.label, bound)
    with ExitStack() as scratch:
        return _merged_into(draft, spec, new, how, bound, scratch)


def _merged_into(
    draft: Draft, spec: TableSpec, new: DataFrame, how: Layout, bound: Column | None, scratch: ExitStack
) -> list[str]:
    """``merge_records`` into a table that there is; what it stores for itself goes with ``scratch``."""
    key = [F.col(quoted(k)) for k in spec.keys]
    old_parts = draft.old_parts(spec.name)
    columns = draft.old(spec.name, []).columns
    new = _with_columns(new, columns)
    new = _scratch(new.withColumn("_label", how.label), f"delivered-{spec.name}", scratch)
    if how.by_key:
        labels = {r["_label"] for r in new.select("_label").distinct().collect()}
        near = [p for p in old_parts if p.part in labels]
    else:
        number = bound.try_cast("bigint")
        low, high, odd = new.agg(F.min(number), F.max(number), F.count_if(number.isNull())).first()
        near = [p for p in old_parts if p.may_hold(low, high, odd)]
    old = draft.old(spec.name, near).withColumn("_label", how.label)
    keys = new.select(*[c.alias(f"_key_{i}") for i, c in enumerate(key)])
    same = reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(key)])
    rivals = old.join(keys, same, "left_semi").withColumn(_OLD, F.lit(0))
    both = rivals.unionByName(new.withColumn(_OLD, F.lit(1)))
    # Rows of a key: the survivor, and the label of the kept record it may replace.
    kept_label = F.max(F.when(F.col(_OLD) == 0, F.col("_label"))).over(Window.partitionBy(*key))
    winners = dedupe_by_key(both.withColumn("_from", kept_label), spec.keys, spec.tie_break or None, ranked_last=[_OLD])
    changed = _scratch(winners.where(F.col(_OLD) == 1).drop(_OLD), f"changed-{spec.name}", scratch)
    moves = changed.select(F.explode(F.array_compact(F.array("_label", "_from"))).alias("label")).distinct()
    touched = {r.label for r in moves.collect()}
    if not touched:
        draft.keep(spec.name)
        return []
    gone = changed.select(*[c.alias(f"_key_{i}") for i, c in enumerate(key)])
    stay = draft.old(spec.name, [p for p in old_parts if p.part in touched]).join(gone, same, "left_anti")
    written = draft.write(spec.name, stay.unionByName(changed.select(*[F.col(quoted(c)) for c in columns])), how.label, bound)
    draft.keep(spec.name, without=touched)
    return sorted(touched | set(written))


def _with_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(quoted(c)) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _scratch(df: DataFrame, purpose: str, scratch: ExitStack) -> DataFrame:
    """``df`` stored in the shared scratch folder, since several jobs read it; removed with ``scratch``."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    scratch.callback(remove_folder, spark, path)
    df.write.option("compression", OWN_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def order_partials(orders: DataFrame, lenient: bool = False) -> dict[str, DataFrame]:
    """Figures of whole months of staged orders, by name, with their month in ``MONTH_LABEL``.

    ``month_figures`` and ``month_customers`` are final for their month, as a month's orders lie in one part.
    The others add up over months; those of the inventory are kept by time of order, so that ages can be told
    at any moment (orders have minutes, so a calendar bounds their number).
    """
    orders = orders.withColumn("order_ts", order_time(orders, lenient=lenient))
    customers = by_month(orders).agg(
        F.count_distinct("order_customer_id").alias("distinct_customers"),
        F.hll_sketch_agg("order_customer_id", SKETCH_BITS).alias("customer_sketch"),
    )
    products = orders.groupBy(*month_columns("order_ts"), "department_id", "product_card_id").agg(
        exact_sum("order_item_total").alias("funds"), decimal_sum("order_item_total").alias("funds_exact"),
        F.count_if(F.col("order_status") == marts.COMPLETED).alias("completed"), F.count(F.lit(1)).alias("n_orders"),
    )
    month = F.when(F.col("year").isNull(), F.lit(UNDATED)).otherwise(F.format_string("%04d-%02d", "year", "month"))
    return {
        "month_figures": marts.monthly_performance(orders).withColumn(MONTH_LABEL, month),
        "month_customers": customers.withColumn(MONTH_LABEL, month),
        "month_products": products.withColumn(MONTH_LABEL, month),
        "time_inventory": orders.groupBy("order_ts").agg(*marts.inventory_sums()).withColumn(
            MONTH_LABEL, F.coalesce(F.date_format("order_ts", "yyyy-MM"), F.lit(UNDATED))
        ),
    }


def shipping_partials(shipping: DataFrame) -> DataFrame:
    """Days and shipments by month of the shipping date and delivery status; they add up."""
    real, planned = F.col("days_for_shipping_real"), F.col("days_for_shipping_scheduled")
    return shipping.withColumn(MONTH_LABEL, _month("shipping_date", True)).groupBy(MONTH_LABEL, "delivery_status").agg(
        F.sum(real).alias("real_days"), F.count(real).alias("real_n"), F.sum(planned).alias("planned_days"), F.count(planned).alias("planned_n"),
        F.sum(real - planned).alias("delay_days"), F.count(real - planned).alias("delay_n"), F.count(F.lit(1)).alias("n_orders"),
    )


def _replace_months(draft: Draft, table: str, partial: DataFrame, months: list[str]) -> None:
    """Put the partial figures of some months in the place of the old ones."""
    if table in MONTHLY_PARTS:
        draft.write(table, partial, F.col(MONTH_LABEL))
        draft.keep(table, without=months)
        return
    old = draft.old(table)
    if old is not None:
        partial = old.where(~F.col(MONTH_LABEL).isin(months)).unionByName(partial)
    draft.write(table, partial.coalesce(1))


def merged_marts(
    partials: Mapping[str, DataFrame], departments: DataFrame, products: DataFrame, as_of: Column | dt.datetime | str | None = None
) -> dict[str, DataFrame]:
    """Marts from the partial figures of all months."""
    shipping = partials["month_shipping"]
    averages = shipping.agg(
        F.round(safe_divide(F.sum("real_days"), F.sum("real_n")), 2).alias("avg_actual_shipment_days"),
        F.round(safe_divide(F.sum("planned_days"), F.sum("planned_n")), 2).alias("avg_scheduled_shipment_days"),
    )
    per_product = partials["month_products"].groupBy("department_id", "product_card_id").agg(
        sum_of_parts("funds_exact", "funds")[1].alias("total_committed_funds"),
        F.sum("completed").alias("completed_orders"), F.sum("n_orders").alias("total_orders"),
    )
    times = partials["time_inventory"].withColumn("_ts", F.col("order_ts"))
    value_exact, value = sum_of_parts("value_exact", "value")
    sales_exact, sales = sum_of_parts("sales_exact", "sales")
    by_age = times.groupBy(*month_columns("_ts"), marts.age_range("_ts", as_of)).agg(
        value.alias("value"), value_exact.alias("value_exact"), sales.alias("sales"), sales_exact.alias("sales_exact"),
        F.sum("quantity").alias("quantity"), F.sum("quantities").alias("quantities"),
    )
    return {
        "customer_retention_rate": marts.retention_report(partials["month_customers"].drop("customer_sketch", MONTH_LABEL)),
        "financial_commitments": marts.commitments_report(per_product, departments, products),
        "inventory_levels": marts.inventory_report(by_age),
        "overall_performance": marts.performance_report(partials["month_figures"], averages),
        "payment_delays": shipping.groupBy("delivery_status").agg(
            safe_divide(F.sum("delay_days"), F.sum("delay_n")).alias("avg_payment_delay"), F.sum("n_orders").alias("count_of_orders")
        ),
    }


#: Tables of records that a delivery is merged into.
RECORDS = ("order", "shipping", "department", "product", "customer", "location")


def merge_delivery(
    spark: SparkSession,
    store: SnapshotStore,
    delivered: DataFrame,
    as_of: Column | dt.datetime | str | None = None,
    lenient_dates: bool = False,
) -> dict[str, list[str]]:
    """Merge delivered flat records into the published tables, and publish them with their marts as one version.

    The result is that of a run over all records delivered so far, whatever was delivered again or late. Returns
    the parts written for each table of records. A run that fails leaves the published version as it was.
    ``fraud_detection``, a row per customer, is not among the marts: its figures change with every order.
    """
    with shuffles_dropped(spark):
        return _merge(store.draft(), delivered, as_of, lenient_dates)


def _merge(draft: Draft, delivered: DataFrame, as_of: Column | dt.datetime | str | None, lenient_dates: bool) -> dict[str, list[str]]:
    named = standardise_names(delivered)
    merges = [lambda name=name: merge_records(draft, TABLES[name], named, lenient_dates) for name in RECORDS]
    written = dict(zip(RECORDS, together(merges, LARGE_SIDE_BY_SIDE)))

    def rewritten(name: str) -> DataFrame:
        return stage(draft.read(name, written[name]), TABLES[name], unique=True)

    partials: dict[str, tuple[DataFrame, list[str]]] = {}
    if written["order"]:
        partials |= {t: (df, written["order"]) for t, df in order_partials(rewritten("order"), lenient_dates).items()}
    if written["shipping"]:
        partials["month_shipping"] = (shipping_partials(rewritten("shipping")), written["shipping"])
    together([lambda t=t, p=p: _replace_months(draft, t, *p) for t, p in partials.items()])
    for table in PARTIALS:
        if table not in partials:
            draft.keep(table)
    if all(draft.has(t) for t in (*PARTIALS, "department", "product")):
        dims = [stage(draft.read(name), TABLES[name], unique=True) for name in ("department", "product")]
        found = merged_marts({t: draft.read(t) for t in PARTIALS}, *dims, as_of=as_of)
        together([lambda n=n, m=m: draft.write(n, m) for n, m in found.items()])
    draft.publish()
    return written


def distinct_customers(store: SnapshotStore, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row: distinct customers of the months from ``start`` to ``end`` (``yyyy-MM``, both included), from stored sketches.

    Sketches of months are merged without counting a customer twice; no order is read. The standard error is
    1.04 / sqrt(2 ** SKETCH_BITS), about 1.6 %.
    """
    sketches = store.read("month_customers")
    if start is not None or end is not None:
        month = F.col(MONTH_LABEL)
        sketches = sketches.where((month != UNDATED) & (month >= (start or "")) & (month <= (end or "9999-12")))
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("customer_sketch")), F.lit(0)).alias("distinct_customers"))
