"""Mixing sources to target weights by temperature.

Shares ``p`` of the sources' tokens are raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised. The exponent is bisected to meet a target entropy (the largest exponent whose weights
reach that part of the largest possible entropy) or a repetition limit (the smallest exponent, so the most
even mixture, that reads no source more than so many times as often as another). An entropy is a sum over
the table of sources; one Spark job tries many exponents at once, and nothing but sums leaves it.

The weights are realised as budgeted permutations of blocks: a source's documents are dealt into blocks of
about ``block_tokens``, or a ``LEAST_BLOCKS``-th of a small source's tokens, so that what is read meets the budget
within such a part or a document; each epoch runs through all blocks in an order of its own, and the last one stops
where the source's budget is used up. The order is that of a hash, so whether a block is taken is a
comparison with its source's cutoff, and texts are never shuffled. The cutoff comes from sums over ranges of
the order first and over one range's blocks then, so the blocks of a source that holds a third of all
tokens are not gathered either.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

BLOCK_TOKENS = 1 << 16
#: Blocks of a source at least, as far as its documents go.
LEAST_BLOCKS = 1024
MAX_REPEATS = 2.0
SEED = 11
#: Points tried by one job, and jobs; they leave an interval of POINTS ** -ROUNDS.
POINTS, ROUNDS = 64, 6
#: Ranges of the block order per source.
RANGES = 1024
_NONE = "<none>"


def token_count(text: Column) -> Column:
    """Words of a text; at least 1, so that empty and null texts can be dealt out too."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)), F.lit(1)).cast("long")


def exponent(sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent in [0, 1] for the limits given; ``sources`` has positive ``tokens``.

    ``target_entropy`` is a part of the logarithm of the number of sources, which exponent 0 always reaches.
    ``max_repeats`` limits how much more often the most repeated source is read than the least repeated one;
    a source is read in proportion to ``p ** (exponent - 1)``. If both are given, the exponent of the entropy
    is raised as far as the repetition limit needs; with the repetition limit alone it starts at 0. No limit, no
    source or a single one gives 1.
    """
    total, least, most, count = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
    if not count or count == 1:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))

    def bisect(kept) -> float:
        """Largest exponent for which ``kept`` holds; it holds at 0 and up to some point."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            tried = [low + (high - low) * k / POINTS for k in range(1, POINTS + 1)]
            held = [k for k, ok in enumerate(kept(tried)) if ok]
            step = (high - low) / POINTS
            low = tried[held[-1]] if held else low
            if held and held[-1] == POINTS - 1:
                return high
            high = low + step
        return low

    def entropies(tried: list[float]) -> list[bool]:
        # With z = sum(p^a): entropy = log z - a * sum(p^a log p) / z.
        sums = [f(F.pow(share, F.lit(a))) for a in tried for f in (F.sum, lambda x: F.sum(x * F.log(share)))]
        found = sources.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).select(
            F.array(*[F.log(F.col(f"s{2 * k}")) - a * F.col(f"s{2 * k + 1}") / F.col(f"s{2 * k}") for k, a in enumerate(tried)])
        ).first()[0]
        return [e >= target_entropy * math.log(count) for e in found]

    def too_often(tried: list[float]) -> list[bool]:
        return [(most / least) ** (1 - a) > max_repeats for a in tried]

    found = 1.0 if max_repeats is None else 0.0
    if target_entropy is not None:
        found = bisect(entropies)
    if max_repeats is not None and (most / least) ** (1 - found) > max_repeats:
        found = min(1.0, bisect(too_often) + POINTS**-ROUNDS)
    return found


def _block(id_column: Column, text: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(id_column, text), blocks)


def _order(source: Column, epoch: Column, block: Column, seed: int) -> Column:
    """Place of a block in its source's permutation of an epoch: a hash, so any long."""
    return F.xxhash64(F.lit(seed), source, epoch, block)


def mixed(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source",
    target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` as often as the mixture reads them, with ``_mix_epoch``, ``_mix_block``, ``_mix_order``, ``_mix_weight``.

    ``budget_tokens`` (default: the least that reads every document once) is shared out by the weights. A
    source reads ``floor(budget / tokens)`` whole epochs (numbered from 0), then the blocks that come first
    in one more permutation while they fit its budget. ``_mix_order`` is the block's place in the epoch as a
    hash; sorting by epoch and order gives the reading order. A null source is a source of its own; null and
    empty texts count one token; repeated rows are dealt and read alike; an empty table gives no rows.
    Columns of ``docs`` may have any names that do not start with ``_mix_``.
    """
    rows = docs.withColumn("_mix_tokens", token_count(F.col(text)))
    name = F.coalesce(F.col(source).cast("string"), F.lit(_NONE))
    none = F.col(source).isNull()
    by_source = stored(
        rows.groupBy(name.alias("_mix_source"), none.alias("_mix_none")).agg(F.sum("_mix_tokens").alias("tokens")), "mix-sources"
    )
    power = exponent(by_source, target_entropy, max_repeats)
    total, norm, floor = by_source.agg(
        F.sum("tokens"), F.sum(F.pow("tokens", F.lit(power))), F.max(F.col("tokens") / F.pow("tokens", F.lit(power)))
    ).first()
    if total is None:
        norm, floor = 1.0, 1.0
    weight = F.pow("tokens", F.lit(power)) / F.lit(norm)
    budget = F.lit(float(budget_tokens)) if budget_tokens is not None else F.lit(floor * norm)
    # A billionth more than the budget keeps rounding from taking a document off a whole epoch.
    plan = by_source.withColumn("_mix_weight", weight).withColumn("_mix_budget", budget * weight * (1 + 1e-9))
    plan = plan.withColumn("_mix_epochs", F.floor(F.col("_mix_budget") / F.col("tokens")).cast("long")).withColumn(
        "_mix_blocks", F.greatest(F.ceil(F.col("tokens") / block_tokens).cast("long"), F.lit(LEAST_BLOCKS).cast("long"))
    )
    plan = plan.withColumn("_mix_left", F.col("_mix_budget") - F.col("_mix_epochs") * F.col("tokens"))
    plan = stored(plan.drop("tokens"), "mix-plan")
    keys = ["_mix_source", "_mix_none"]

    def placed(columns: list[str]) -> DataFrame:
        own = rows.withColumn("_mix_source", name).withColumn("_mix_none", none).join(plan, keys)
        return own.withColumn("_mix_block", _block(F.col(id_column), F.col(text), F.col("_mix_blocks"))).select(*columns)

    last = _order(F.struct(*keys), F.col("_mix_epochs"), F.col("_mix_block"), seed)
    blocks = (
        placed([*keys, "_mix_block", "_mix_epochs", "_mix_left", "_mix_tokens"])
        .groupBy(*keys, "_mix_block", "_mix_epochs", "_mix_left").agg(F.sum("_mix_tokens").alias("tokens"))
        .withColumn("order", last)
        .withColumn("range", F.shiftright("order", 64 - RANGES.bit_length() + 1))
    )
    blocks = stored(blocks, "mix-blocks")
    ranges = blocks.groupBy(*keys, "range").agg(F.sum("tokens").alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("before", F.coalesce(before, F.lit(0)))
    # Only the range in which the budget runs out is looked at block by block; those before it fit whole.
    running = F.sum("tokens").over(Window.partitionBy(*keys, "range").orderBy("order", "_mix_block"))
    inside = blocks.join(ranges, [*keys, "range"]).where("before <= _mix_left").withColumn("reached", F.col("before") + running)
    cutoffs = inside.where("reached <= _mix_left").groupBy(*keys).agg(F.max("order").alias("_mix_cutoff"))
    plan = stored(plan.join(cutoffs, keys, "left"), "mix-cutoffs")

    extra = (last <= F.col("_mix_cutoff")).cast("long")
    reads = F.sequence(F.lit(0).cast("long"), F.col("_mix_epochs") - 1 + F.coalesce(extra, F.lit(0)))
    whole = F.when(F.col("_mix_epochs") + F.coalesce(extra, F.lit(0)) > 0, reads).otherwise(F.array().cast("array<bigint>"))
    return placed([*docs.columns, *keys, "_mix_block", "_mix_epochs", "_mix_cutoff", "_mix_weight"]).withColumn(
        "_mix_epoch", F.explode(whole)
    ).withColumn("_mix_order", _order(F.struct(*keys), F.col("_mix_epoch"), F.col("_mix_block"), seed)).select(
        *docs.columns, "_mix_epoch", "_mix_block", "_mix_order", "_mix_weight"
    )
