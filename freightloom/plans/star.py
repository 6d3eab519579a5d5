"""Star schema: flat order records split into seven tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..operators.dedup import dedupe_by_key
from ..operators.projection import select_present, standardise_names
from ..schema import TABLES, TableSpec

Extractor = Callable[[DataFrame, Sequence[str]], DataFrame]


def star_table(
    flat: DataFrame,
    spec: TableSpec | str,
    dedupe: bool = True,
    extract: Extractor = select_present,
) -> DataFrame:
    """One star table of the flat records, with standard names and one row per key.

    Names are standardised first, so the key is found under its standard name.
    ``extract`` picks the table's columns and may be replaced for records of
    another shape. A table none of whose columns exist comes out without columns.
    """
    spec = TABLES[spec] if isinstance(spec, str) else spec
    named = standardise_names(flat)
    table = extract(named, spec.columns)
    output = table.columns
    if not output or not dedupe:
        return table
    # The key and tie-break may lie outside the table; they are pruned again afterwards.
    helpers = [c for c in (*spec.keys, *spec.tie_break) if c in named.columns and c not in output]
    return dedupe_by_key(
        extract(named, [*output, *helpers]) if helpers else table,
        spec.keys,
        spec.tie_break,
        missing_ok=not set(spec.keys) <= set(named.columns),
        repeats=spec.repeats,
        output=output,
    )


def star_survivors(flat: DataFrame, spec: TableSpec) -> DataFrame:
    """The first record of each key with the table's columns and those that chose it.

    The helpers are kept so that survivors of several runs can be merged.
    """
    named = standardise_names(flat)
    if not any(c in named.columns for c in spec.columns):
        return select_present(named, spec.columns)
    kept = list(dict.fromkeys([*spec.columns, *spec.keys, *spec.tie_break]))
    table = select_present(named, kept)
    return dedupe_by_key(table, spec.keys, spec.tie_break, missing_ok=True, repeats=spec.repeats)


def split_star(flat: DataFrame, dedupe: bool = True, extract: Extractor = select_present) -> dict[str, DataFrame]:
    """All seven star tables by their file names.

    Each is its own plan over the flat records; reading Parquet, each scans only
    its own columns.
    """
    return {
        spec.star_name: star_table(flat, spec, dedupe=dedupe, extract=extract) for spec in TABLES.values()
    }
