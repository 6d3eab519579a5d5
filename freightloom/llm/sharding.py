"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

A shuffle that is uniform over all permutations sends a random number of rows from each partition to each
shard; those numbers follow the multivariate hypergeometric law given the partitions' and the shards' sizes.
They are drawn first, exactly, on the driver: a small matrix of counts, whatever the corpus. Then each
partition permutes its rows and deals them out by its row of the matrix, the rows are exchanged, and each
shard permutes what it got. Shard sizes are at most one apart (the law ``rows``).

Permutations are orders of seeded hashes, so a retried task repeats them. Partitions are hash classes of the
rows rather than what tasks happen to read, which makes the result independent of files and task counts. A
shard's second permutation is cut into ranges of the hash that are numbered apart; no task sorts a shard.
Rows alike are counted, numbered, and dealt out in portions, so a row that is a third of the table is spread
like any others. Everything over rows is DataFrame functions; texts are read once and never shuffled.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

SHARDS = 8
SEED = 23
#: Rows of a partition, unless the matrix would have more than ``MATRIX_CELLS`` cells.
PARTITION_ROWS = 1 << 14
MATRIX_CELLS = 1 << 17
#: Rows of a range of the second permutation.
RANGE_ROWS = 1 << 11
#: Rows alike that are dealt out together at most.
PORTION = 1 << 10


def hypergeometric(good: int, bad: int, drawn: int, rng: np.random.Generator) -> int:
    """How many of ``drawn`` rows out of ``good + bad`` are good ones, by inversion.

    The law's probabilities follow from that of its mode by the ratios of neighbouring ones; no factorials are
    needed, so the draw is exact, to the rounding of doubles, for populations of any size. Left out are
    only terms below 1e-25 of the mode's. The work grows with the law's standard deviation.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    whole = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (whole + 2), low), high)
    spread = math.sqrt(drawn * (good / whole) * (bad / whole) * ((whole - drawn) / max(1, whole - 1)))
    reach = 64 + math.ceil(12 * spread)
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    above = np.cumprod((good - up) / (up + 1) * ((drawn - up) / (bad - drawn + up + 1)))
    below = np.cumprod(down / (good - down + 1) * ((bad - drawn + down) / (drawn - down + 1)))
    total = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    place = int(np.searchsorted(total, rng.random() * total[-1], side="right"))
    return mode - len(below) + min(place, len(total) - 1)


def communication_matrix(partition_rows: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """Rows each partition sends to each shard: an exact draw from the law that a uniform shuffle follows.

    Line sums are the partitions' sizes, column sums the shards' (at most one apart). A line is drawn shard by
    shard, each count given those before it.
    """
    total = sum(partition_rows)
    left = [total // shards + (s < total % shards) for s in range(shards)]
    lines = []
    for rows in partition_rows:
        line, pool = [], sum(left)
        for own in left:
            pool -= own
            line.append(hypergeometric(own, pool, rows, rng))
            rows -= line[-1]
        lines.append(line)
        left = [own - sent for own, sent in zip(left, line)]
    return np.array(lines, np.int64).reshape(len(partition_rows), shards)


def _order(purpose: int, seed: int, number: str) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(purpose), "id", "size", "text_crc32", number)


def uniform_shards(
    docs: DataFrame, shards: int = SHARDS, text: str = "text", id_column: str = "doc_id", seed: int = SEED,
) -> DataFrame:
    """Per row: its id, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``slot`` is the row's place in its shard, gapless from 0. A null text has size 1 and the checksum of
    nothing; null ids and repeated rows are rows like any other and get slots of their own. An empty table
    gives no rows. ``grown_shard`` is null, as this law does not follow keys. Columns other than id and text
    are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    alike = rows.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    alike = stored(alike, "shard-rows")
    total = alike.agg(F.sum("copies")).first()[0] or 0
    partitions = max(1, min(math.ceil(total / PARTITION_ROWS), MATRIX_CELLS // shards))
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(PORTION).cast("long"))
    portions = alike.withColumn("start", F.explode(starts)).withColumn("end", F.least(F.col("start") + PORTION, "copies"))
    portions = portions.withColumn("part", F.pmod(_order(0, seed, "start"), F.lit(partitions)))

    counted = dict(portions.groupBy("part").agg(F.sum(F.col("end") - F.col("start"))).collect())
    sizes = [counted.get(p, 0) for p in range(partitions)]
    matrix = communication_matrix(sizes, shards, np.random.default_rng(seed))
    # Line p holds the first rank that does not go to each shard; the lines come as one JSON literal of bounded size.
    ends = json.dumps(np.cumsum(matrix, axis=1).tolist())
    lines = docs.sparkSession.range(1).select(
        F.posexplode(F.from_json(F.lit(ends), "array<array<bigint>>")).alias("part", "ends")
    ).withColumn("part", F.col("part").cast("long"))
    # Portions are opened in their partition, which the window then finds as it needs it.
    rows = portions.repartition("part").withColumn("copy", F.explode(F.sequence("start", F.col("end") - 1)))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(_order(1, seed, "copy"), "id")).cast("long") - 1
    dealt = rows.withColumn("rank", rank).join(F.broadcast(lines), "part")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("rank")))
    ranges = 1 << max(0, math.ceil(math.log2(max(1, total / shards / RANGE_ROWS))))
    second = _order(2, seed, "copy")
    dealt = dealt.select("id", "size", "text_crc32", shard.alias("shard"), second.alias("order"))
    dealt = stored(dealt.withColumn("range", F.pmod("order", F.lit(ranges))), "shard-dealt")

    in_range = dealt.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = in_range.select("shard", "range", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy("order", "id")) - 1
    return dealt.withColumn("inside", inside).join(offsets, ["shard", "range"]).select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
