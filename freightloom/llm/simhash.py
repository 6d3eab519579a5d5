"""Near-duplicates by SimHash fingerprints, found with BK-trees.

A fingerprint has 64 bits; two link at ``radius`` or fewer differing bits. Equal fingerprints are
merged first, so a group of copies, whatever its size, is one node from there on.

Candidate search. The 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius
differ in at most ``radius`` blocks and so agree on at least two whole blocks; every pair of blocks is
a table keyed by those bits, and linked fingerprints meet in a bucket of at least one table. A bucket
is a shard of the search: it gets a BK-tree, whose children are keyed by their distance to the parent,
and a search follows only edges whose key is within the radius of the distance to the node. Buckets of
more than ``shard_rows`` fingerprints are dealt into several shards; each shard's tree is sent to the
bucket's other shards, which search it block by block, so no task ever holds more than two shards and
no link is lost.

A task returns spanning links only (at most one a fingerprint and search), never all pairs of a dense
group. Components are found by alternating large-star and small-star rounds on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .store import stored

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
SHARD_ROWS = 4096

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: Hashes of one document held at a time; longer documents are added up in pieces.
_HASHES_AT_ONCE = 1 << 20


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set, highest bit first."""
    as_bytes = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(as_bytes[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)])


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a whole text; 0 for null and for texts without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
        total = len(words) - shingle_words + 1
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for start in range(0, total, _HASHES_AT_ONCE):
        size = min(_HASHES_AT_ONCE, total - start)
        counts += _bit_counts([digest(s, HASH_SEED) for s in islice(shingles, size)])
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", keep: Sequence[Column] = (), shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` of every row, and ``fp``: its text's fingerprint as a signed long."""
    rows = docs.select(F.col(text).alias("_text"), *keep)
    schema = StructType([*rows.schema.fields[1:], StructField("fp", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((simhash(t.as_py(), shingle_words) for t in batch.column(0)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints.view(np.int64))], schema.names)

    return rows.mapInArrow(run, schema)


class BKTree:
    """Integers by Hamming distance; every child hangs on the edge of its distance to the parent."""

    def __init__(self) -> None:
        self._nodes: list[tuple[int, dict[int, int]]] = []

    def insert(self, value: int) -> None:
        nodes = self._nodes
        at, new = 0, len(nodes)
        while nodes:
            node, edges = nodes[at]
            distance = (node ^ value).bit_count()
            if distance not in edges:
                edges[distance] = new
                break
            at = edges[distance]
        nodes.append((value, {}))

    def within(self, value: int, radius: int) -> list[int]:
        """Positions (in order of insertion) of all values at most ``radius`` bits away."""
        found, open_nodes = [], [0] if self._nodes else []
        while open_nodes:
            at = open_nodes.pop()
            node, edges = self._nodes[at]
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            for key, child in edges.items():
                if distance - radius <= key <= distance + radius:
                    open_nodes.append(child)
        return found


def spanning_links(own: list[int], other: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the radius connects: inside ``own``, or between ``own`` and ``other`` if that has values."""
    tree, values = BKTree(), own + other
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    if other:
        for value in own:
            tree.insert(value)
    for k in range(len(own) if other else 0, len(values)):
        for match in tree.within(values[k], radius):
            a, b = root(k), root(match)
            if a != b:
                parent[a] = b
                links.append((values[k], values[match]))
        if not other:
            tree.insert(values[k])
    return links


def _band_keys(fp: Column, radius: int) -> list[Column]:
    """One key for each pair of the ``radius + 2`` blocks: the bits of both, as one long."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    parts = [
        F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if b < 64 else F.shiftrightunsigned(fp, a)
        for a, b in zip(edges, edges[1:])
    ]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    return [F.shiftleft(parts[i], widths[j]).bitwiseOR(parts[j]) for i, j in combinations(range(radius + 2), 2)]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, whose components are those of all pairs of distinct ``fp`` within the radius."""
    keys = _band_keys(F.col("fp"), radius)
    rows = prints.select("fp", F.posexplode(F.array(*keys)).alias("band", "key"))
    sizes = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / shard_rows).cast("long")
    shard = F.pmod(F.xxhash64("fp"), F.col("shards"))
    # Shard s meets every shard t of its bucket once: the pair (s, t) searches s's tree for t's fingerprints.
    searches = (
        rows.join(sizes, ["band", "key"])
        .withColumn("shards", shards)
        .withColumn("shard", shard)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .select(
            "band", "key", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"),
            (F.col("shard") > F.col("other")).alias("asks"), "fp",
        )
    )
    group = ["band", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides, out = None, ([], []), []
        for batch in batches:
            *parts, asks, values = (c.to_pylist() for c in batch.columns)
            for key, side, value in zip(zip(*parts), asks, values):
                if key != current:
                    out += _group_links(current, sides, radius)
                    current, sides = key, ([], [])
                sides[side].append(value & 0xFFFFFFFFFFFFFFFF)
            if len(out) >= 10_000:
                yield _link_batch(out)
                out = []
        out += _group_links(current, sides, radius)
        yield _link_batch(out)

    links = searches.repartition(*group).sortWithinPartitions(*group, "fp").mapInArrow(run, "a long, b long")
    return links.distinct()


def _group_links(key: tuple | None, sides: tuple[list[int], list[int]], radius: int) -> list[tuple[int, int]]:
    if key is None:
        return []
    own, other = sides
    if key[2] == key[3]:
        return spanning_links(own + other, [], radius)
    return spanning_links(own, other, radius) if own and other else []


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links; the root is its component's smallest node.

    Alternates large-star and small-star until nothing changes. Minima are pre-aggregated, and joins on
    a hub node are ones adaptive execution can split.
    """
    edges = stored(links.where("a <> b").select("a", "b"), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
        # Here a < b; b's smallest neighbour takes over its other ones.
        large = large.where("a < b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lowest, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
        edges = stored(small.union(lowest.select(F.col("m").alias("a"), "b")).distinct(), "links")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _classes(prints: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """``(fp, root, component_id)`` for every fingerprint; ``root`` names its component."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(fingerprint_links(distinct.select("fp"), radius, shard_rows))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(firsts, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, its own included. Null and empty texts have
    fingerprint zero and link like any other; rows repeated in the input are repeated in the result; a null
    id is never the smallest unless its component has no other (then null). An empty table gives no rows.
    Other columns of ``docs`` are not looked at, whatever their names.
    """
    prints = stored(with_fingerprint(docs, text, [F.col(id_column).alias("id")], shingle_words), "simhash")
    return prints.join(_classes(prints, radius, shard_rows), "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: that with the smallest id, then the smallest text digest.

    Null ids come last in a group and null texts count as empty ones, so a group of null ids keeps one row too.
    Of rows equal in id and text one stays. Columns are those of ``docs``; none may start with ``_near_``.
    """
    key = F.md5(F.coalesce(F.col(text), F.lit("")))
    prints = stored(with_fingerprint(docs, text, [F.col(id_column).alias("id"), key.alias("key")], shingle_words), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    kept = prints.join(_classes(prints, radius, shard_rows), "fp").groupBy("root").agg(first)
    kept = kept.select(F.col("first.id").alias("_near_id"), F.col("first.key").alias("_near_key"))
    rows = docs.withColumn("_near_digest", key)
    same = rows[id_column].eqNullSafe(kept["_near_id"]) & (rows["_near_digest"] == kept["_near_key"])
    order = Window.partitionBy("_near_id", "_near_key").orderBy("_near_digest")
    return rows.join(kept, same).withColumn("_near_rank", F.row_number().over(order)).where("_near_rank = 1").select(docs.columns)
