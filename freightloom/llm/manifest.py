"""Merkle manifest of a dataset, stored as blocks in van Emde Boas order.

Rows become leaves. The leaves of a group, in order, form a tree in which every ``FANOUT`` consecutive nodes
have one parent (the last run may be shorter, even a single node) until one node is left; the groups' roots
form the dataset's tree the same way. A digest is SHA-256 over the hexadecimal text of its children's.

Layout. A tree is cut at half its height, and the halves again, until the pieces have at most
``BLOCK_LEVELS`` levels of edges. That gives strata of aligned subtrees, the blocks, one stored row each; the
roots of a stratum's blocks are the bottom nodes of the next stratum. Within a block the same halving goes on:
its nodes lie in van Emde Boas order, the top half's first, then each bottom subtree's. ``address`` finds a
node by arithmetic alone, for construction and for the siblings of a proof alike, so a path to the root reads
one block per stratum whatever the size of a page or cache line.

Building goes up the strata, proofs come down them: a block's own path joins the siblings found in it and is
handed to the blocks below. Rows are numbered by a range sort of digests and per-partition counts, a
block holds at most ``FANOUT ** BLOCK_LEVELS`` bottom nodes, and texts are hashed where they are read, so no
task's work depends on how large a group is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

_BITS = 3
FANOUT = 1 << _BITS
BLOCK_LEVELS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_DIGEST = 32
_MOST_LEVELS = 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def strata(levels: int) -> list[int]:
    """Heights of the blocks of a tree with so many levels of edges, bottom stratum first: halves of halves."""
    if levels <= BLOCK_LEVELS:
        return [levels]
    return strata((levels + 1) // 2) + strata(levels // 2)


def tree_nodes(rows: int) -> int:
    """Nodes of a full tree with so many rows of nodes."""
    return (FANOUT**rows - 1) // (FANOUT - 1)


def address(height: int, level: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes in van Emde Boas order; ``level`` counts from a block's bottom, ``index`` along the level."""
    index = np.asarray(index, np.int64)
    place = np.zeros_like(index)
    rows, depth = height + 1, height - level
    while rows > 1:
        top = rows // 2
        if depth < top:
            rows = top
            continue
        below = FANOUT ** (depth - top)
        rows, depth = rows - top, depth - top
        place = place + tree_nodes(top) + index // below * tree_nodes(rows)
        index = index % below
    return place


def level_counts(bottom: int, height: int) -> list[int]:
    """Nodes that are there on each level of a block with so many bottom nodes."""
    return [-(-bottom // FANOUT**level) for level in range(height + 1)]


def parent(run: bytes) -> bytes:
    """Digest over the digests of a run."""
    return hashlib.sha256(run.hex().encode()).digest()


def block(digests: np.ndarray, height: int) -> np.ndarray:
    """A block's nodes, placed, from its bottom ones (rows of 32 bytes); places without a node are zero."""
    nodes = np.zeros((tree_nodes(height + 1), _DIGEST), np.uint8)
    row = digests
    for level, count in enumerate(level_counts(len(digests), height)):
        nodes[address(height, level, np.arange(count))] = row
        if level < height:
            parents = b"".join(parent(row[k : k + FANOUT].tobytes()) for k in range(0, count, FANOUT))
            row = np.frombuffer(parents, np.uint8).reshape(-1, _DIGEST)
    return nodes


def block_paths(nodes: np.ndarray, height: int, bottom: int) -> Iterator[bytes]:
    """For each bottom node of a block its path to the block's root: place, size of the run and the run's others, by level."""
    runs = []
    for level, count in enumerate(level_counts(bottom, height)[:-1]):
        row = nodes[address(height, level, np.arange(count))].tobytes()
        step = FANOUT * _DIGEST
        runs.append([row[k : k + step] for k in range(0, len(row), step)])
    for number in range(bottom):
        path = []
        for row in runs:
            number, place = number >> _BITS, number & (FANOUT - 1)
            run = row[number]
            path += [bytes((place, len(run) // _DIGEST)), run[: place * _DIGEST], run[(place + 1) * _DIGEST :]]
        yield b"".join(path)


def siblings(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """What stands before and after the path's own node in its run, level by level."""
    at = 0
    while at < len(path):
        before = at + 2 + path[at] * _DIGEST
        after = at + 2 + (path[at + 1] - 1) * _DIGEST
        yield path[at + 2 : before], path[before:after]
        at = after


def proof_digest(path: bytes) -> str:
    """SHA-256 of all siblings of a path."""
    return hashlib.sha256(b"".join(a + b for a, b in siblings(path)).hex().encode()).hexdigest()


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for before, after in siblings(path):
        leaf = parent(before + leaf + after)
    return leaf


@dataclass(frozen=True)
class Tree:
    """Stored strata of the trees of a table, bottom first: ``tree, n, block, height, nodes, root, items, changed``."""

    strata: list[DataFrame]
    #: ``tree, n, digest``: the root of each tree.
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """The groups' trees and the tree over their roots; ``root`` is None for a table without rows."""

    groups: Tree
    top: Tree
    root: bytes | None


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the values: ``-`` for null, else the bytes of the UTF-8 text, ``:`` and the text."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Every row with its ``rank`` in its tree and the tree's ``n``; and the largest ``n``.

    Rows equal in ``order`` are alike, so a number tells them apart and lets them lie in several partitions.
    """
    keys = ["tree", *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranged.drop("_row").withColumn("_place", F.monotonically_increasing_id()), "manifest-leaves")
    placed = placed.withColumn("_part", F.call_function("shiftright", F.col("_place"), F.lit(33)))
    runs = placed.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # A tree has one run for each partition at most.
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("n")
    )
    runs = stored(runs, "manifest-runs")
    largest = runs.agg(F.max("n")).first()[0] or 0
    ranked = placed.join(runs, ["tree", "_part"]).withColumn("rank", F.col("_place") + F.col("_shift"))
    return ranked.drop("_place", "_part", "_shift"), largest


def _levels(count: int) -> int:
    return next(k for k in range(_MOST_LEVELS + 1) if FANOUT**k >= count)


def _height(count: Column, stratum: int) -> tuple[Column, Column]:
    """Height of a stratum's blocks in a tree of so many leaves (null: it has no such stratum), and whether it is the last."""
    levels = F.size(F.filter(F.array(*[F.lit(FANOUT**k) for k in range(_MOST_LEVELS)]), lambda power: power < count))
    heights = [strata(k) for k in range(_MOST_LEVELS + 1)]
    own = F.get(F.array(*[F.lit(h[stratum] if stratum < len(h) else None).cast("int") for h in heights]), levels)
    return own, F.get(F.array(*[F.lit(len(h) == stratum + 1) for h in heights]), levels)


def _built(nodes: DataFrame, stratum: int, item_type: str | None) -> DataFrame:
    """Blocks of a stratum from its bottom nodes ``tree, n, rank, digest`` (and ``item, changed`` of leaves)."""
    height, last = _height(F.col("n"), stratum)
    leaves = item_type is not None
    rows = nodes.withColumn("height", height).withColumn("last", last)
    rows = rows.withColumn("block", F.call_function("shiftright", F.col("rank"), F.col("height") * _BITS))
    fields = "tree string, n long, block long, height int, last boolean, bottom int, nodes binary, root binary"
    if leaves:
        fields += f", items array<{item_type}>, changed array<binary>"
    names = ["tree", "n", "block", "height", "last"]

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        height = key[3].as_py()
        digests = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, _DIGEST)
        placed = block(digests, height)
        root = placed[address(height, height, np.zeros(1, np.int64))].tobytes()
        row = {name: pa.array([value.as_py()], value.type) for name, value in zip(names, key)}
        row |= {"bottom": pa.array([len(digests)], pa.int32()), "nodes": pa.array([placed.tobytes()]), "root": pa.array([root])}
        if leaves:
            row |= {"items": pa.array([table["item"].to_pylist()], pa.list_(table["item"].type))}
            row |= {"changed": pa.array([table["changed"].to_pylist()], pa.list_(pa.binary()))}
        return pa.table(row)

    kept = [*names, "rank", "digest", *(["item", "changed"] if leaves else [])]
    return stored(rows.select(kept).groupBy(*names).applyInArrow(build, fields), f"manifest-blocks-{stratum}")


def build_trees(leaves: DataFrame, order: Sequence[str]) -> Tree:
    """Trees over leaves ``tree, digest, item, changed``, ordered by the columns ``order`` within each tree."""
    item_type = leaves.schema["item"].dataType.simpleString()
    nodes, largest = _numbered(leaves, order)
    found, roots = [], []
    for stratum in range(max(len(strata(k)) for k in range(_levels(largest) + 1))):
        blocks = _built(nodes, stratum, item_type if stratum == 0 else None)
        found.append(blocks)
        roots.append(blocks.where("last").select("tree", "n", F.col("root").alias("digest")))
        nodes = blocks.where("not last").select("tree", "n", F.col("block").alias("rank"), F.col("root").alias("digest"))
    whole = roots[0]
    for more in roots[1:]:
        whole = whole.unionAll(more)
    return Tree(found, whole)


def _opened(tree: Tree, tops: DataFrame, leaf, fields: str) -> DataFrame:
    """Rows for the leaves of all trees, made by ``leaf(item, digest, changed, path, above)`` in the order of ``fields``.

    ``tops`` has for each tree what lies above its root: ``tree, path, above``.
    """
    kinds = fields.split(", ")
    names = [f.split()[0] for f in kinds]
    down = "tree string, block long, path binary, above binary"

    def opened(blocks: pa.Table) -> Iterator[tuple[int, bytes, np.ndarray, bytes, dict]]:
        row = blocks.to_pylist()[0]
        nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, _DIGEST)
        bottom = nodes[address(row["height"], 0, np.arange(row["bottom"]))]
        for number, path in enumerate(block_paths(nodes, row["height"], row["bottom"])):
            yield number, bottom[number].tobytes(), path, row

    def descend(blocks: pa.Table, paths: pa.Table) -> pa.Table:
        rows = []
        above = paths.to_pylist()[0] if len(paths) else None
        if len(blocks) and above:
            for number, _, path, row in opened(blocks):
                rows.append((row["tree"], row["block"] * row["bottom_full"] + number, path + above["path"], above["above"]))
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(["tree", "block", "path", "above"], columns, kinds)})

    def finish(blocks: pa.Table, paths: pa.Table) -> pa.Table:
        rows = []
        above = paths.to_pylist()[0] if len(paths) else None
        if len(blocks) and above:
            for number, digest, path, row in opened(blocks):
                rows.append(leaf(row["items"][number], digest, row["changed"][number], path + above["path"], above["above"]))
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.table({n: pa.array(c, _arrow(k)) for n, c, k in zip(names, columns, kinds)})

    paths = None
    for stratum in reversed(range(len(tree.strata))):
        blocks = tree.strata[stratum].withColumn("bottom_full", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("height") * _BITS))
        own = blocks.where("last").select(F.col("tree").alias("of"), F.col("block").alias("top"))
        own = own.join(tops, F.col("of") == F.col("tree")).select(F.col("of").alias("tree"), F.col("top").alias("block"), "path", "above")
        paths = own if paths is None else paths.unionAll(own)
        step, kind = (descend, down) if stratum else (finish, fields)
        joined = blocks.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(step, kind)
        paths = stored(joined, f"manifest-paths-{stratum}") if stratum else joined
    return paths


def _arrow(field: str) -> pa.DataType:
    return {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[field.split()[1]]


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_column: str = "doc_id", group: str = "lang", changed: Column | None = None) -> Manifest:
    """The manifest of a table: a leaf per row over ``columns``, a tree per ``group``, ordered by id, and one over the groups.

    Groups are ordered as UTF-8 bytes, a null one first. Null ids come first; rows with equal ids are ordered
    by their leaf, and equal rows are leaves of their own. ``changed`` is the leaf that ``proofs`` folds in
    place of the row's own one (null: its own). An integer, string or date id is kept as it is.
    """
    leaf = leaf_digest([F.col(c) for c in columns])
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    changed = F.lit(None).cast("binary") if changed is None else changed
    rows = docs.select(tree.alias("tree"), F.col(id_column).alias("item"), leaf.alias("digest"), changed.alias("changed"))
    groups = build_trees(stored(rows, "manifest-digests"), ["item", "digest"])
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("item"), "digest", F.lit(None).cast("binary").alias("changed"))
    top = build_trees(stored(roots, "manifest-roots"), ["item"])
    root = top.roots.first()
    return Manifest(groups, top, None if root is None else bytes(root["digest"]))


def proofs(manifest: Manifest, id_column: str = "doc_id") -> DataFrame:
    """Per row: its id, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``proof_sha256`` is over all siblings on the way to the root. ``folded_root`` is computed from the leaf that
    was given as changed, or the row's own, and those siblings; ``verified`` says whether it is the root.
    """
    kind = manifest.groups.strata[0].schema["items"].dataType.elementType.simpleString()
    root = manifest.root or b""
    name = f"{id_column} {kind}"

    def group_row(item, digest, changed, path, above):
        return item, path, digest

    def row(item, digest, changed, path, above):
        end = folded(changed or digest, path)
        return item, digest.hex(), above.hex(), root.hex(), proof_digest(path), end.hex(), end == root

    nothing = F.lit(b"")
    tops = manifest.top.roots.select("tree", nothing.alias("path"), nothing.alias("above"))
    tops = stored(_opened(manifest.top, tops, group_row, "tree string, path binary, above binary"), "manifest-tops")
    return _opened(
        manifest.groups, tops, row,
        f"{name}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def lowered_leaf(columns: Sequence[str] = COLUMNS, text: str = "text") -> Column:
    """The leaf of a row whose text has its A-Z lowered."""
    return leaf_digest([F.translate(c, _UPPER, _LOWER) if c == text else F.col(c) for c in columns])


def checked(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Proofs of all rows, where those whose id's CRC-32 is divisible by 3 are checked with their text's A-Z lowered.

    Every row of ``docs`` gives one row, repeated ones too; an empty table gives none. Null values are part of
    a leaf; a row with a null id is checked as it is. Columns beyond ``COLUMNS`` are not looked at.
    """
    tampered = F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 0
    return proofs(build(docs, id_column=id_column, changed=F.when(tampered, lowered_leaf())), id_column)
