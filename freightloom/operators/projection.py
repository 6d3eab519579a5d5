"""Projections: tolerant selection, renaming, safe casting, nested access, union."""

from __future__ import annotations

import functools
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import RENAMES

log = logging.getLogger(__name__)


def quoted(name: str) -> str:
    """Column name safe to use in an expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in columns if c not in present]


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the requested columns that exist, in the requested order.

    Absent ones are logged. If none exists the result has no columns and no rows.
    """
    absent = missing_columns(df, columns)
    if absent:
        log.warning("columns not found: %s", absent)
    kept = [c for c in columns if c not in set(absent)]
    if not kept:
        return df.limit(0).select()
    return df.select(*[F.col(quoted(c)) for c in kept])


def standardise_names(df: DataFrame, renames: Mapping[str, str] = RENAMES) -> DataFrame:
    """Rename raw columns to their standard names in one projection; others stay."""
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns are matched by name and missing ones are NULL."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
