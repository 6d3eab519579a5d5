"""DuckDB SQL for the Merkle manifest, with a common table expression for each level of the trees."""

from __future__ import annotations

#: Levels written out, which bounds the rows of a group (8 ** 8) and the number of groups (8 ** 3).
GROUP_LEVELS, TOP_LEVELS = 8, 3

#: CRC-32 of a text of digits, bit by bit.
_CRC = """
xor(list_reduce(
  list_concat([4294967295::UBIGINT], list_transform(str_split_regex(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
  lambda crc, byte: list_reduce(
    list_concat([xor(crc, byte)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, step: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END
  )
), 4294967295::UBIGINT)"""


def _part(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || ({value}::VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_part(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(prefix: str, tree: str, count: int) -> str:
    """Per level: each node's neighbours in its run, and the next level's nodes."""
    parts = []
    for k in range(count):
        run = f"OVER (PARTITION BY {tree}, i // 8 ORDER BY i ROWS BETWEEN"
        parts.append(f"""
{prefix}_side{k} AS (
  SELECT {tree}, i, n,
    coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {prefix}{k}
),
{prefix}{k + 1} AS (
  SELECT {tree}, i // 8 AS i, (max(n) + 7) // 8 AS n,
    CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE max(digest) END AS digest
  FROM {prefix}{k} GROUP BY {tree}, i // 8
)""")
    return ",".join(parts)


def _folds(prefix: str, tree: str, number: str, count: int, first: str) -> str:
    """Walk up from the rows of ``first``: fold the used digest, gather the siblings."""
    parts, last = [], first
    for k in range(count):
        parts.append(f"""
{prefix}_walk{k} AS (
  SELECT w.* EXCLUDE (folded, others),
    CASE WHEN s.n > 1 THEN sha256(s.before || w.folded || s.after) ELSE w.folded END AS folded, w.others || s.before || s.after AS others
  FROM {last} w JOIN {prefix}_side{k} s ON w.{tree} = s.{tree} AND w.{number} // {8**k} = s.i
)""")
        last = f"{prefix}_walk{k}"
    return ",".join(parts)


MANIFEST_SQL = f"""
WITH rows AS (
  SELECT *, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM rows
), g0 AS (SELECT tree, i, n, leaf AS digest FROM leaves),{_levels("g", "tree", GROUP_LEVELS)},
roots AS (
  SELECT tree, digest AS subroot, 1 AS whole, row_number() OVER (ORDER BY tree) - 1 AS number, count(*) OVER () AS n FROM g{GROUP_LEVELS}
), t0 AS (SELECT whole, number AS i, n, subroot AS digest FROM roots),{_levels("t", "whole", TOP_LEVELS)},
start AS (
  SELECT l.doc_id, l.leaf, l.tree, l.i, r.subroot, r.number, r.whole, coalesce(l.changed, l.leaf) AS folded, '' AS others
  FROM leaves l JOIN roots r USING (tree)
),{_folds("g", "tree", "i", GROUP_LEVELS, "start")},{_folds("t", "whole", "number", TOP_LEVELS, f"g_walk{GROUP_LEVELS - 1}")}
SELECT doc_id, leaf, subroot, root, sha256(others) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM t_walk{TOP_LEVELS - 1}, (SELECT digest AS root FROM t{TOP_LEVELS})
"""
