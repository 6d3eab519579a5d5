"""Casts, guarded arithmetic, labels and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ageing buckets in days; the last one is open.
AGE_EDGES = (30, 60, 90)

# Fixed value: value labels in reports are cut to this many characters.
LABEL_LENGTH = 50


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_cast(value: Column | str, type_name: str) -> Column:
    """Cast that turns unreadable values into NULL.

    Spark reads ``'1d'`` and ``'1f'`` as numbers; a value with such a suffix is
    not a number here.
    """
    value = _column(value)
    if type_name in ("double", "float"):
        suffixed = value.cast("string").rlike(r"[0-9.][dDfF]\s*$")
        return F.when(~suffixed, value.try_cast(type_name))
    return value.try_cast(type_name)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Floating-point ratio; NULL when the denominator is zero."""
    bottom = _column(denominator)
    return _column(numerator).cast("double") / F.nullif(bottom, F.lit(0)).cast("double")


def percent_of(part: Column | str, total: Column | str, digits: int = 2, half_even: bool = False) -> Column:
    """``part`` as a percentage of ``total``, rounded half up, or half even on request.

    Multiplying first leaves one division, so counts that share a tie such as
    16.685 are rounded from that value and not from a neighbouring double.
    """
    share = safe_divide(_column(part) * F.lit(100), total)
    return F.bround(share, digits) if half_even else F.round(share, digits)


def value_label(value: Column | str) -> Column:
    return F.substring(_column(value).cast("string"), 1, LABEL_LENGTH)


def message_key(value: Column | str) -> Column:
    """Message key: an empty id counts as missing."""
    return F.nullif(_column(value), F.lit(""))


def age_bucket(age_days: Column | str, edges: Sequence[int] = AGE_EDGES) -> Column:
    """Label of the first bucket whose upper edge holds the age.

    Negative ages fall into the first bucket and unknown ages into the open one.
    """
    age = _column(age_days)
    label = F.when(age <= edges[0], F.lit(f"0-{edges[0]} days"))
    for previous, edge in zip(edges, edges[1:]):
        label = label.when(age <= edge, F.lit(f"{previous + 1}-{edge} days"))
    return label.otherwise(F.lit(f"Over {edges[-1]} days"))
