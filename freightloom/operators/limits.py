"""First rows and top rows, always in a stated order."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import PORTION
from .projection import quoted

# Keys sampled per round, and how many of them are counted against.
SAMPLE_KEYS = 4_096
PIVOTS = 32


def head(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows in ``order_by`` order (all columns by default)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def top_k(df: DataFrame, metric: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``metric``."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *tie_break).limit(k)


def _key(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns as one value; structs compare like rows, missing values first."""
    return F.struct(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(order_by)])


def _literal(df: DataFrame, order_by: Sequence[str], values: Sequence) -> Column:
    return F.struct(
        *[F.lit(v).cast(df.schema[c].dataType).alias(f"k{i}") for i, (c, v) in enumerate(zip(order_by, values))]
    )


def capped(df: DataFrame, n: int | None, order_by: Sequence[str]) -> DataFrame:
    """At most ``n`` rows, the first ones in ``order_by`` order; ``None`` keeps all.

    A plain limit would send n rows from every task to one. Instead the key of
    the n-th row is closed in on: rows are counted against keys from a small
    sample, and what lies strictly between two of them is looked at next, until
    it is as small as a sample or all of one key. Rows before it are kept by a
    filter, and only those few are put in order. Rows of one key are closed in on
    the same way by their other columns, so a key of any number of rows stays
    spread over its tasks. Runs jobs right away: a count,
    and a sample and a count per round, each of which leaves about a hundredth
    of the rows, so store an expensive input first. Order columns may have any
    type that has an order.
    """
    if n is None:
        return df
    key = _key(df, order_by)
    literal = functools.cache(lambda values: _literal(df, order_by, values))
    low, high, before, rows = None, None, 0, df.count()  # keys strictly between; rows before, rows between

    def between() -> DataFrame:
        above = F.lit(True) if low is None else key > literal(low)
        return df.filter(above if high is None else above & (key < literal(high)))

    def cut(rest: DataFrame) -> DataFrame:
        return rest if low is None else df.filter(key <= literal(low)).unionByName(rest)

    while rows > SAMPLE_KEYS and before + rows > n:
        picked = between().select(key.alias("key")).sample(min(1.0, SAMPLE_KEYS / rows)).distinct()
        sample = [tuple(row["key"]) for row in picked.orderBy("key").collect()]
        # Pivots lie close together where the n-th row is expected, and reach the ends further out.
        expected = (n - before) / rows * len(sample)
        steps = [math.copysign(k * k * len(sample) / PIVOTS**2, k) for k in range(-PIVOTS, PIVOTS + 1)]
        places = sorted({min(max(0, round(expected + s)), len(sample) - 1) for s in steps}) if sample else []
        pivots = [sample[p] for p in places]
        counts = [F.count_if(test) for p in pivots for test in (key < literal(p), key <= literal(p))]
        found = between().agg(F.count(F.lit(1)), *counts).first()
        ends = [before, *(before + c for c in found[1:]), before + found[0]]
        part = next((i for i in range(1, len(ends)) if ends[i] >= n), len(ends) - 1)
        if part % 2 == 0:  # the n-th row has a pivot's key, as have all rows of this part
            pivot = pivots[part // 2 - 1]
            same = _of_one_key(df.filter(key == literal(pivot)), n - ends[part - 1], order_by)
            return df.filter(key < literal(pivot)).unionByName(same)
        low, high = pivots[part // 2 - 1] if part > 1 else low, pivots[part // 2] if part // 2 < len(pivots) else high
        before, rows = ends[part - 1], ends[part] - ends[part - 1]
    if before + rows <= n and high is None:
        return df
    return cut(between().orderBy(*[F.col(quoted(c)) for c in order_by]).limit(n - before))


def _of_one_key(same: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` of rows with equal ``order_by``, by their other columns.

    Rows equal in all columns are one row, written out ``n`` times in portions. Columns without an order, such
    as maps, do not tell rows apart; where there are any, as where few rows are wanted, a plain limit ends it.
    """
    plain = [f.name for f in same.schema.fields if isinstance(f.dataType, T.AtomicType)]
    rest = [c for c in same.columns if c not in order_by and c in plain]
    if n <= SAMPLE_KEYS:
        return same.orderBy(*[F.col(quoted(c)) for c in rest]).limit(n) if rest else same.limit(n)
    if rest:
        return capped(same, n, [*order_by, *rest])
    if len(plain) < len(same.columns):
        return same.limit(n)
    starts = F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"), F.lit(PORTION).cast("bigint"))
    spread = same.limit(1).withColumn("_from", F.explode(starts)).repartition("_from")
    upto = F.least(F.col("_from") + PORTION, F.lit(n).cast("bigint")) - 1
    return spread.withColumn("_copy", F.explode(F.sequence("_from", upto))).drop("_from", "_copy")
