"""Exact order statistics of columns of any size and distribution.

``percentile`` keeps every distinct value of a group in one task. Here a wanted
rank is closed in on instead: a quantile sketch of each column gives two values
around every rank; one count of all
columns tells how many values lie before these cuts, and a filter brings the few
values around the ranks along. That is three scans for all columns and ranks. Of columns so
large that more than ``CARRIED`` values lie around a rank, what lies
between two cuts is looked at in further rounds, of two aggregations each,
that leave a few thousandths of the values, until few enough are left to be brought along. Values at which the rank
falls are found as such, so repeated values, infinities and any spread of
magnitudes take the same path, and no task ever holds the values of a column.
"""

from __future__ import annotations

import bisect
import dataclasses
import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import quoted

# The sketch errs by at most n / ACCURACY ranks; it is asked for GRID + 1 evenly spaced quantiles.
ACCURACY = 4_000
GRID = 2_000
# Values around a rank that are brought to the driver to be put in order.
CARRIED = 1 << 14
# Brackets counted in one job; generated code takes no more than a hundred results at once. A job scans its columns alone.
BRACKETS = 24


@dataclasses.dataclass(frozen=True)
class _Span:
    """Values of one column from ``low`` to ``high``, among which the wanted rank lies."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    rows: int

    @property
    def key(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns as ``(position, value)`` rows without missing values. No shuffle.

    ``position`` is the column's place in ``columns``; fixed-width keys keep the
    aggregations over cells cheap.
    """
    pairs = [
        F.struct(F.lit(i).alias("position"), F.col(quoted(c)).cast("double").alias("value"))
        for i, c in enumerate(columns)
    ]
    long = df.select(F.inline(F.array(*pairs)))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _in_ranges(df: DataFrame, ranges: Sequence[tuple], names: str) -> DataFrame:
    """Cells joined to ranges ``(number, column, low, high, ...)`` that hold them.

    Ranges are a handful per column, so safe to broadcast.
    """
    columns = sorted({r[1] for r in ranges})
    rows = [(r[0], columns.index(r[1]), *r[2:]) for r in ranges]
    table = df.sparkSession.createDataFrame(rows, names)
    inside = (F.col("position") == F.col("at")) & F.col("value").between(F.col("low"), F.col("high"))
    return _cells_within(df, {c: [(r[2], r[3]) for r in ranges if r[1] == c] for c in columns}).join(F.broadcast(table), inside, "inner")


def _cells_within(df: DataFrame, ranges: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """``cells`` of the columns that lie in one of their ranges; others are left out before rows become cells."""
    within = {}
    for column, own in ranges.items():
        own = sorted(set(own))
        # Many ranges are looked at as one, so that the test of a row stays short.
        own = own if len(own) <= BRACKETS else [(own[0][0], max(high for _, high in own))]
        value = _number(df, column)
        within[column] = functools.reduce(operator.or_, [value.between(low, high) for low, high in own])
    pairs = [
        F.struct(F.lit(i).alias("position"), F.when(test, _number(df, c)).alias("value")) for i, (c, test) in enumerate(within.items())
    ]
    rows = df.where(functools.reduce(operator.or_, within.values()))
    return rows.select(F.inline(F.array(*pairs))).where("value is not null")


def _brackets(df: DataFrame, spans: Sequence[_Span]) -> list[tuple[float, float]]:
    """For each span two values of it between which its rank lies, as far as the sketch can tell."""
    keys = sorted({s.key for s in spans})
    found = _in_ranges(df, [(i, *k) for i, k in enumerate(keys)], "number int, at int, low double, high double")
    edges = {row["number"]: row["edges"] for row in found.groupBy("number").agg(edges_of(F.col("value")).alias("edges")).collect()}
    brackets = []
    for span in spans:
        own = edges[keys.index(span.key)]
        first, last = _bracket(own, span.rank - span.below, span.rows)
        brackets.append((own[first], own[last]))
    return brackets


def _narrow(df: DataFrame, spans: Sequence[_Span]) -> list[_Span]:
    """One round for spans of more than one value: a found rank has ``low == high`` then."""
    brackets = _brackets(df, spans)
    value, left, right = F.col("value"), F.col("left"), F.col("right")
    parts = {
        "under": value < left,
        "left": value == left,
        "inside": (value > left) & (value < right),
        "right": (value == right) & (left < right),
        "over": value > right,
    }
    aggregates = []
    for name, part in parts.items():
        aggregates += [
            F.count_if(part).alias(f"{name}_n"),
            F.min(F.when(part, value)).alias(f"{name}_low"),
            F.max(F.when(part, value)).alias(f"{name}_high"),
        ]
    # Neighbouring ranks mostly share their bracket, which is counted once.
    numbers = {r: i for i, r in enumerate(sorted({(*s.key, *b) for s, b in zip(spans, brackets)}))}
    ranges = [(i, *r) for r, i in numbers.items()]
    found = _in_ranges(df, ranges, "number int, at int, low double, high double, left double, right double")
    counted = {row["number"]: row for row in found.groupBy("number").agg(*aggregates).collect()}
    narrowed = []
    for span, bracket in zip(spans, brackets):
        i = numbers[*span.key, *bracket]
        below = span.below
        for name in parts:
            rows = counted[i][f"{name}_n"]
            if span.rank < below + rows:
                break
            below += rows
        low, high = counted[i][f"{name}_low"], counted[i][f"{name}_high"]
        narrowed.append(dataclasses.replace(span, low=low, high=high, below=below, rows=rows))
    return narrowed


Extents = dict[str, tuple[int, float, float]]
#: Evenly spaced quantiles of a column as a sketch has them.
Edges = dict[str, Sequence[float]]


def edges_of(value: Column) -> Column:
    """Aggregate: a column's evenly spaced quantiles, as far as the sketch can tell."""
    # As one expression: a literal for each share would be a call to the JVM for each.
    shares = ", ".join(f"{k / GRID!r}D" for k in range(GRID + 1))
    return F.percentile_approx(value, F.expr(f"array({shares})"), ACCURACY)


def _number(df: DataFrame, column: str) -> Column:
    number = F.col(quoted(column)).cast("double")
    return F.when(~F.isnan(number), number)


def column_extents(df: DataFrame, columns: Sequence[str]) -> Extents:
    """Count, smallest and largest value of each column, missing values left out."""
    aggregates = [F.lit(0).alias("_none")]
    for i, c in enumerate(columns):
        value = _number(df, c)
        aggregates += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"low{i}"), F.max(value).alias(f"high{i}")]
    row = df.agg(*aggregates).first()
    return {c: (row[f"n{i}"], row[f"low{i}"], row[f"high{i}"]) for i, c in enumerate(columns)}


def column_edges(df: DataFrame, columns: Sequence[str]) -> Edges:
    """Quantile edges of columns that have values; one scan.

    Kept apart from other aggregates, which generated code computes only where there is no sketch among them.
    """
    if not columns:
        return {}
    row = df.agg(*[edges_of(_number(df, c)).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"e{i}"] for i, c in enumerate(columns)}


def _bracket(own: Sequence[float], rank: int, rows: int) -> tuple[int, int]:
    """Places among the edges of a column's ``rows`` values between which a rank of it lies."""
    share = (rank + 0.5) / rows
    return max(0, math.floor((share - 2 / ACCURACY) * GRID)), min(GRID, math.ceil((share + 2 / ACCURACY) * GRID))


def _carried(df: DataFrame, spans: Sequence[_Span]) -> list[_Span]:
    """Spans of at most ``CARRIED`` values, found among these; one scan."""
    keys = sorted({s.key for s in spans})
    held: list[list[float]] = [[] for _ in keys]
    for row in _in_ranges(df, [(i, *k) for i, k in enumerate(keys)], "number int, at int, low double, high double").select("number", "value").collect():
        held[row.number].append(row.value)
    for values in held:
        values.sort()
    found = [held[keys.index(s.key)][s.rank - s.below] for s in spans]
    return [dataclasses.replace(s, low=v, high=v) for s, v in zip(spans, found)]


def _located(df: DataFrame, spans: Sequence[_Span], edges: Edges) -> list[_Span]:
    """Spans of whole columns whose rank falls on a cut, or among the few values around it, are found; others shrink to the cuts.

    One scan counts the values before and up to each cut, another brings what lies around the ranks along; plain
    counts and filters, which generated code computes.
    """
    wanted: dict[str, list[tuple[int, int]]] = {}
    for span in spans:
        wanted.setdefault(span.column, []).append(_bracket(edges[span.column], span.rank, span.rows))
    # Brackets of neighbouring ranks overlap, and are looked at as one.
    brackets: dict[str, list[tuple[float, float]]] = {}
    near: dict[str, set[tuple[float, float]]] = {}
    rows = {span.column: span.rows for span in spans}
    for column, places in wanted.items():
        joined: list[list[int]] = []
        for first, last in sorted(places):
            if joined and first <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], last)
            else:
                joined.append([first, last])
        for first, last in joined:
            own = (edges[column][first], edges[column][last])
            brackets.setdefault(column, []).append(own)
            if own[0] < own[1] and ((last - first) / GRID + 2 / ACCURACY) * rows[column] <= CARRIED:
                near.setdefault(column, set()).add(own)
    every = [(column, *own) for column in sorted(brackets) for own in brackets[column]]
    counted: dict[tuple[str, float, float], list[int]] = {}
    for start in range(0, len(every), BRACKETS):
        part = every[start : start + BRACKETS]
        tests = [t for column, left, right in part for v in [_number(df, column)] for t in (v < left, v <= left, v < right, v <= right)]
        found = list(df.agg(*[F.count_if(t).alias(f"_{i}") for i, t in enumerate(tests)]).first())
        counted |= {key: found[4 * i : 4 * i + 4] for i, key in enumerate(part)}
    columns = sorted(near)
    inside = {c: functools.reduce(operator.or_, [(_number(df, c) > a) & (_number(df, c) < b) for a, b in sorted(near[c])]) for c in columns}
    values: dict[str, list[float]] = {c: [] for c in columns}
    if columns:
        pairs = [F.struct(F.lit(i).alias("position"), F.when(inside[c], _number(df, c)).alias("value")) for i, c in enumerate(columns)]
        few = df.where(functools.reduce(operator.or_, inside.values())).select(F.inline(F.array(*pairs))).where("value is not null")
        for row in few.collect():
            values[columns[row.position]].append(row.value)
    for held in values.values():
        held.sort()

    def at(span: _Span) -> _Span:
        for left, right in brackets[span.column]:
            before, upto, below_right, upto_right = counted[span.column, left, right]
            if before <= span.rank < upto:
                return dataclasses.replace(span, low=left, high=left)
            if below_right <= span.rank < upto_right:
                return dataclasses.replace(span, low=right, high=right)
            if upto <= span.rank < below_right:
                if (left, right) not in near.get(span.column, ()):
                    return dataclasses.replace(span, low=left, high=right, below=before, rows=upto_right - before)
                held = values[span.column]
                value = held[bisect.bisect_right(held, left) + span.rank - upto]
                return dataclasses.replace(span, low=value, high=value)
        return span

    return [at(span) for span in spans]


def values_at_ranks(
    df: DataFrame, ranks: dict[str, Sequence[int]], extents: Extents, edges: Edges | None = None
) -> dict[tuple[str, int], float]:
    """The values at zero-based ranks of columns, by column and rank. Runs jobs right away; with ``edges`` mostly one."""
    spans = [
        _Span(column, rank, low, high, 0, n)
        for column, wanted in ranks.items()
        for n, low, high in [extents[column]]
        for rank in sorted(set(wanted))
        if 0 <= rank < n
    ]
    wide = [s for s in spans if s.low < s.high]
    if edges is not None and wide:
        at = {(s.column, s.rank): s for s in _located(df, wide, edges)}
        spans = [at.get((s.column, s.rank), s) for s in spans]
    while open_spans := [s for s in spans if s.low < s.high]:
        few, many = ([s for s in open_spans if (s.rows <= CARRIED) == own] for own in (True, False))
        closer = (_carried(df, few) if few else []) + (_narrow(df, many) if many else [])
        narrowed = {(s.column, s.rank): s for s in closer}
        spans = [narrowed.get((s.column, s.rank), s) for s in spans]
    return {(s.column, s.rank): s.low for s in spans}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], extents: Extents | None = None
) -> DataFrame:
    """``(column, probability, quantile)``, linearly interpolated between neighbours.

    Runs one small aggregation for the extents, unless they are given, one for
    the sketches, one for the counts and a filter around all ranks; columns of more than
    some million values take two more per further round. Columns without any
    value are absent from the result.
    """
    extents = extents or column_extents(df, columns)
    edges = column_edges(df, [c for c in columns if extents[c][0]])
    positions = {
        (c, float(p)): p * (extents[c][0] - 1) for c in columns for p in probabilities if extents[c][0]
    }
    ranks: dict[str, list[int]] = {}
    for (column, _), position in positions.items():
        ranks.setdefault(column, []).extend((math.floor(position), math.ceil(position)))
    at = values_at_ranks(df, ranks, extents, edges)
    rows = []
    for (column, p), position in positions.items():
        low, high = at[column, math.floor(position)], at[column, math.ceil(position)]
        part = position - math.floor(position)
        # Equal neighbours need no interpolation, which would make NaN of infinite ones.
        rows.append((column, p, low if low == high else low + (high - low) * part))
    return df.sparkSession.createDataFrame(rows, "column string, probability double, quantile double")
