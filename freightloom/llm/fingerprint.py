"""Homomorphic multiset fingerprints of documents.

Each paragraph of a text is hashed to a wide vector, and the vectors are added modulo a power of two. The
sum does not depend on the paragraphs' order, and paragraphs can be added to it or taken out of it without
the rest of the text. By default paragraphs end at line ends and after sentences, since a text of one line
would else be like nothing but itself.

A vector has ``LANES`` entries of plus or minus one, bits of a SHA-512 of the paragraph, added modulo 2 ** 30.
(A row's text has fewer than 2 ** 31 bytes, so fewer paragraphs than that.) Bits are summed, two lanes to a long with room between
them, next to the number of paragraphs; an entry is twice the lane less that number. The squared distance of
two sums estimates the number of paragraphs that differ (with a relative error of about sqrt(2 / LANES)),
which gives a likeness between 0 and 1.

All of it is DataFrame functions on the columns' arrays.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 128
MODULUS = 1 << 30
#: Where a text is cut into paragraphs.
CUT = r"\n+|(?<=[.!?])\s+"
#: Documents of one range of ids, and the most ranges.
RANGE_ROWS = 1024
FANOUT = 256

_HASHES = LANES // 64
_ONE_PER_LANE = 0x0000_0001_0000_0001
_MASK = 0x3FFF_FFFF_3FFF_FFFF
_WORDS = 32 * _HASHES


def multiset_sum(text: Column, cut: str = CUT) -> Column:
    """The sum of the vectors of a text's paragraphs: packed lanes, then the number of paragraphs."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), cut), lambda p: p != "")
    shifts = F.array(*[F.lit(k) for k in range(32)])
    part = 128 // _HASHES  # hex digits of the digest that make 64 bits

    def bits(digest: Column) -> Column:
        hashes = F.array(*[F.xxhash64(F.substring(digest, 1 + part * k, part)) for k in range(_HASHES)])
        lanes = F.transform(hashes, lambda h: F.transform(shifts, lambda k: _shifted(h, k)))
        return F.concat(F.flatten(lanes), F.array(F.lit(1).cast("long")))

    zero = F.array_repeat(F.lit(0).cast("long"), _WORDS + 1)
    digests = F.transform(pieces, lambda p: F.sha2(p.cast("binary"), 512))
    return F.aggregate(digests, zero, lambda total, digest: combined(total, bits(digest)))


def _shifted(value: Column, places: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, places).bitwiseAND(F.lit(_ONE_PER_LANE))


def combined(first: Column, second: Column) -> Column:
    """The sum for the paragraphs of both: insertion."""
    return F.zip_with(first, second, lambda a, b: (a + b).bitwiseAND(F.lit(_MASK)))


def removed(whole: Column, part: Column) -> Column:
    """The sum for the paragraphs of ``whole`` without those of ``part``: deletion."""
    high, low = F.lit(_MASK & ~0xFFFF_FFFF), F.lit(MODULUS - 1)  # each lane by itself, so that none borrows from the other
    lower = lambda a, b: (a.bitwiseAND(low) - b.bitwiseAND(low)).bitwiseAND(low)
    upper = lambda a, b: (a.bitwiseAND(high) - b.bitwiseAND(high)).bitwiseAND(high)
    return F.zip_with(whole, part, lambda a, b: upper(a, b).bitwiseOR(lower(a, b)))


def entries(total: Column) -> Column:
    """The vector's entries as integers around zero."""
    number = F.element_at(total, _WORDS + 1).bitwiseAND(F.lit(MODULUS - 1))
    lanes = F.flatten(F.transform(
        F.slice(total, 1, _WORDS),
        lambda w: F.transform(F.array(F.lit(0), F.lit(32)), lambda k: F.call_function("shiftright", w, k).bitwiseAND(F.lit(MODULUS - 1))),
    ))
    half = MODULUS // 2
    return F.transform(lanes, lambda c: F.pmod(2 * c - number + half, F.lit(MODULUS)) - half)


def likeness(first: Column, second: Column) -> Column:
    """Shared part of two entry vectors' paragraphs, from 0 to 1; of two empty texts 1."""
    # As doubles, exact below 2 ** 53: squares of very long texts' entries are beyond a long.
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    apart = square(F.zip_with(first, second, lambda a, b: a - b))
    both = square(first) + square(second)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / both))


def as_text(total: Column) -> Column:
    """The sum as hex digits."""
    return F.array_join(F.transform(total, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


_KEY = "struct<none:int,id:bigint,hash:bigint>"


def _range_bounds(rows: DataFrame) -> list[tuple[int, int, int]]:
    """Keys at which ranges of about ``RANGE_ROWS`` rows start, ``FANOUT ** 2`` at most; not all need be rows' own.

    Quantiles of the ids give the bounds. An id that is several quantiles, or null ids, that fill several
    ranges, are cut at equal steps of the hash.
    """
    count, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col("_key.none") == 1)).first()
    ranges = max(1, min(FANOUT**2 // 2, math.ceil(count / RANGE_ROWS)))
    ids: list[int] = []
    if count > nulls:
        shares = [k / ranges for k in range(ranges)]
        ids = rows.where("_key.none = 0").agg(F.percentile_approx("_key.id", shares, 20 * len(shares) + 100)).first()[0]
    cuts = Counter((0, i) for i in ids)
    if nulls:
        cuts[1, 0] = math.ceil(ranges * nulls / count)
    return sorted((*key, -(1 << 63) + (k << 64) // parts) for key, parts in cuts.items() for k in range(parts))


def _constant(values: list, kind: str) -> Column:
    """A literal array, folded from JSON when the plan is made."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _range_of(key: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """Number of the range that holds a key: a search in groups of bounds, then in one group."""
    named = [dict(zip(("none", "id", "hash"), b)) for b in bounds]
    groups = [named[k : k + FANOUT] for k in range(0, len(named), FANOUT)]
    reached = lambda array: F.size(F.filter(array, lambda b: b <= key))
    group = F.greatest(reached(_constant([g[0] for g in groups], f"array<{_KEY}>")), F.lit(1))
    inner = F.get(_constant(groups, f"array<array<{_KEY}>>"), group - 1)
    return ((group - 1) * FANOUT + F.greatest(reached(inner), F.lit(1)) - 1).cast("int")


def with_next(docs: DataFrame, columns: list[str], id_column: str = "id", told_by: tuple[str, ...] = ()) -> DataFrame:
    """Every row with ``next``: the struct of ``columns`` of the row after it by ascending id; the last row's is the first's.

    Null ids come last. Of equal ids, and of null ones, the order is that of a hash of ``told_by`` (default:
    ``columns``), which also cuts them into ranges if they are many; only rows alike in it are never parted. A table of
    one row is its own next. Rows are moved once, to their range; each range's first row is also sent to the
    range before it that has rows, where it only serves as the next one.
    """
    number = F.coalesce(F.col(id_column).cast("long"), F.lit(0).cast("long"))
    key = F.struct(F.isnull(id_column).cast("int").alias("none"), number.alias("id"), F.xxhash64(*(told_by or columns)).alias("hash"))
    rows = docs.withColumn("_key", key)
    rows = rows.withColumn("_range", _range_of(F.col("_key"), _range_bounds(rows) or [(0, 0, 0)]))
    starts = [(r["_range"], tuple(r["first"])) for r in rows.groupBy("_range").agg(F.min("_key").alias("first")).orderBy("_range").collect()]
    # kind 0: the row itself; 1: a range's first row for the range before; 2: the first row of all for the last range's end.
    firsts = [
        {"range": here, "none": first[0], "id": first[1], "hash": first[2], "to": before, "kind": 1 if k else 2}
        for k, ((here, first), (before, _)) in enumerate(zip(starts, starts[-1:] + starts[:-1]))
    ]
    numbers = [-1] * (starts[-1][0] + 1 if starts else 1)
    for k, (here, _) in enumerate(starts):
        numbers[here] = k
    kind = "array<struct<range:int,none:int,id:bigint,hash:bigint,to:int,kind:int>>"
    own = F.get(_constant(firsts, kind), F.get(_constant(numbers, "array<int>"), F.col("_range")))
    is_first = F.struct(own["none"].alias("none"), own["id"].alias("id"), own["hash"].alias("hash")) == F.col("_key")
    copies = F.filter(
        F.array(
            F.struct(F.col("_range").alias("range"), F.lit(0).alias("kind")),
            F.when(is_first, F.struct(own["to"].alias("range"), own["kind"].alias("kind"))),
        ),
        lambda c: c.isNotNull(),
    )
    rows = rows.withColumn("_copy", F.explode(copies)).withColumn("_in", F.col("_copy.range")).withColumn("_kind", F.col("_copy.kind"))
    order = Window.partitionBy("_in").orderBy(F.col("_kind") == 2, "_key", *columns, "_kind")
    return rows.withColumn("next", F.lead(F.struct(*columns)).over(order)).where("_kind = 0").drop("_key", "_range", "_copy", "_in", "_kind")


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", cut: str = CUT) -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is the text with its last ``floor(n_chars / 4)`` code points replaced by the first as many
    of the next document's, by ascending id (after the last: the first). Null texts count as empty; an empty
    text's sum is zero, and its likeness to another empty one is 1. Null ids come last, and repeated rows
    follow each other. An empty table gives no rows. Columns other than id and text are not looked at.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("total", multiset_sum(F.col("text"), cut)), ["text", "total"], told_by=("text",))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("new", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - F.col("new")).cast("int")), F.substring(F.col("next.text"), F.lit(1), F.col("new"))
    )
    rows = rows.withColumn("edited", edited).withColumn("edited_total", multiset_sum(F.col("edited"), cut))
    rows = rows.select(
        "id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "total", "edited_total",
        entries(F.col("total")).alias("own"), entries(F.col("edited_total")).alias("changed"), entries(F.col("next.total")).alias("after"),
    )
    return rows.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", as_text(F.col("total")).alias("fingerprint"),
        as_text(F.col("edited_total")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
