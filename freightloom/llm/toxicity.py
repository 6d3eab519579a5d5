"""Toxicity classifier by non-negative positive-unlabelled learning.

The learner sees documents confirmed as toxic and unlabelled ones, most of which are not toxic but some of
which are; no document is confirmed as clean. With the class prior p, the risk of a score g is::

    p E_toxic[loss(g)] + max(0, E_unlabelled[loss(-g)] - p E_toxic[loss(-g)])

The second term estimates the risk on clean documents: the unlabelled documents' share that is toxic is
subtracted. It cannot be negative in truth, so when a step finds it below zero, the model has begun to
memorise the confirmed documents, and the step goes the other way on that term alone.

Features are words and their beginnings (3 to 7 characters), hashed into buckets and counted. A text's
evidence is the sum of its features' weights over its number of words to the power of ``LENGTH_POWER``:
between a sum, by which long texts would gather noise, and a mean, in which a few words would vanish. Weights
are never negative, so harmless words cannot hide harmful ones, and shrink to zero unless they earn their
place. Training is numpy, in small batches with a step size per weight; the weights of the second half of the
steps are averaged.

The sum is linear in a text's words, so scorers get one number per bucket and add it up over whole texts, in
pieces of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7)
LENGTH_POWER = 0.75
#: Words at which the power's scale is one.
USUAL_WORDS = 100
#: Documents learned from, at most: confirmed toxic and unlabelled ones.
TOXIC_ROWS, UNLABELLED_ROWS = 2000, 8000
#: A feature counts if this many of the confirmed documents have it.
LEAST_DOCS = 3
EPOCHS, BATCHES, RATE, SHRINK = 40, 8, 0.3, 1e-4
THRESHOLD = 0.5
SEED = 11

ROWS_BACK = 1000
#: Code points read at once; texts are cut at white space, so only a longer word is ever cut.
PIECE = 1 << 19

_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded size, cut at white space."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = max(text.rfind(" ", start, end), text.rfind("\n", start, end))
            end = cut + 1 if cut > start else end
        yield text[start:end]
        start = end


def _buckets(hashes: np.ndarray, length: int) -> np.ndarray:
    mixed = (hashes + np.uint64(length)) * _FACTOR
    return ((mixed ^ (mixed >> np.uint64(29))) * _FACTOR >> _SHIFT).astype(np.int32)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature occurrence, each one's text number, and the texts' numbers of words."""
    found = [_WORD.findall(t.lower()) for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    words = [w for row in found for w in row]
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int64), counts
    owner = np.repeat(np.arange(len(texts)), counts)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    # A beginning's hash is a sum over its characters and their places, so all of a word's come from one running sum.
    place = (np.arange(len(points)) - np.repeat(starts, lengths)).astype(np.uint64)
    terms = (points + np.uint64(1)) * (place * np.uint64(2) + np.uint64(1)) * _FACTOR
    terms ^= terms >> np.uint64(31)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    buckets, owners = [_buckets(running[starts + lengths] - running[starts], 0)], [owner]
    for k in PREFIXES:
        longer = lengths > k
        buckets.append(_buckets(running[starts[longer] + k] - running[starts[longer]], k))
        owners.append(owner[longer])
    return np.concatenate(buckets), np.concatenate(owners), counts


def _scale(words: np.ndarray) -> np.ndarray:
    return (USUAL_WORDS / np.maximum(words, 1)) ** LENGTH_POWER / 10


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * values))


@dataclass(frozen=True)
class Model:
    """A weight per bucket and a bias."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of being toxic per text; one without words gets the bias's."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        held: list[tuple[int, str]] = []
        size = 0

        def add() -> None:
            buckets, owner, words = features([t for _, t in held])
            places = np.array([k for k, _ in held])
            np.add.at(total, places, np.bincount(owner, self.weight[buckets], len(held)))
            np.add.at(count, places, words)

        for k, text in enumerate(texts):
            for piece in pieces(text or ""):
                held.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    add()
                    held, size = [], 0
        if held:
            add()
        return _sigmoid(total * _scale(count) + self.bias)


Bag = tuple[np.ndarray, np.ndarray, int]


def bag(text: str) -> Bag:
    """Distinct buckets of a text, how often each occurs, and the number of words."""
    parts, words = [], 0
    for piece in pieces(text):
        buckets, _, counts = features([piece])
        parts.append(buckets)
        words += int(counts[0])
    if not parts:
        return np.empty(0, np.int32), np.empty(0, np.int32), 0
    found, counts = np.unique(np.concatenate(parts), return_counts=True)
    return found.astype(np.int32), counts.astype(np.int32), words


class _Rows:
    """Bags as one sparse matrix over the features in use."""

    def __init__(self, bags: list[Bag], number: np.ndarray) -> None:
        columns = [number[b] for b, _, _ in bags]
        used = [c >= 0 for c in columns]
        self.column = np.concatenate([c[u] for c, u in zip(columns, used)])
        sizes = np.fromiter((u.sum() for u in used), np.int64, len(bags))
        scale = _scale(np.fromiter((w for _, _, w in bags), np.int64, len(bags)))
        self.value = np.concatenate([n[u] for (_, n, _), u in zip(bags, used)]) * np.repeat(scale, sizes)
        self.ends = np.concatenate([[0], np.cumsum(sizes)])

    def chosen(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column, value and own row number of the entries of some rows."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[rows] - (ends - sizes), sizes)
        return self.column[places], self.value[places], np.repeat(np.arange(len(rows)), sizes)


def train(toxic: list[Bag], unlabelled: list[Bag], prior: float) -> Model:
    """Fit weights and bias; ``prior`` is the toxic share of the unlabelled documents."""
    if not toxic or not unlabelled:
        return Model(np.zeros(BUCKETS), float("-inf"))
    rng = np.random.default_rng(SEED)
    seen = np.bincount(np.concatenate([b for b, _, _ in toxic]), minlength=BUCKETS)
    used = np.flatnonzero(seen >= min(LEAST_DOCS, len(toxic)))
    number = np.full(BUCKETS, -1)
    number[used] = np.arange(len(used))
    sets = _Rows(toxic, number), _Rows(unlabelled, number)
    weight, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    squares, bias_squares = np.full(len(used), 1e-8), 1e-8
    mean_weight, mean_bias, averaged = np.zeros(len(used)), 0.0, 0
    for epoch in range(EPOCHS):
        parts = [np.array_split(rng.permutation(n), BATCHES) for n in (len(toxic), len(unlabelled))]
        for own, other in zip(*parts):
            if not len(own) or not len(other):
                continue
            rows = [s.chosen(p) for s, p in zip(sets, (own, other))]
            g_toxic, g_other = (bias + np.bincount(at, weight[c] * v, len(p)) for (c, v, at), p in zip(rows, (own, other)))
            clean_risk = np.logaddexp(0, g_other).mean() - prior * np.logaddexp(0, g_toxic).mean()
            back_toxic = -prior * _sigmoid(g_toxic) / len(own)  # of the clean risk
            back_other = _sigmoid(g_other) / len(other)
            if clean_risk >= 0:
                back_toxic = back_toxic - prior * _sigmoid(-g_toxic) / len(own)
            else:
                back_toxic, back_other = -back_toxic, -back_other
            slope, bias_slope = np.zeros(len(used)), 0.0
            for (c, v, at), back in zip(rows, (back_toxic, back_other)):
                slope += np.bincount(c, back[at] * v, len(used))
                bias_slope += back.sum()
            squares += slope * slope
            bias_squares += bias_slope**2
            step = RATE / np.sqrt(squares)
            weight = np.maximum(weight - step * (slope + SHRINK), 0)
            bias -= RATE * bias_slope / np.sqrt(bias_squares)
            if 2 * epoch >= EPOCHS:
                mean_weight += weight
                mean_bias += bias
                averaged += 1
    whole = np.zeros(BUCKETS)
    whole[used] = mean_weight / max(averaged, 1)
    return Model(whole, mean_bias / max(averaged, 1))


def held_out(id_column: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id's text is divisible by 5."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", id_column: str = "doc_id",
    prior: float | None = None, toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """Train on confirmed toxic documents and unlabelled text; neither uses rows that are held out.

    At most ``toxic_rows`` documents with label 1 and ``unlabelled_rows`` of all documents, with or without a label, are
    learned from, chosen by a hash of the id; their ids are broadcast, their texts read whole. Label 0 is used
    for nothing but the class prior, by default the share of label 1 among all labels that are not held out.
    Rows whose id or text is null, or whose label is not 0 or 1, are not learned from; of an id's several
    labels or texts the smallest counts. Without a confirmed row nothing is known, and every score is 0.
    """
    own = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    own = own.groupBy("id").agg(F.min("label").alias("label"))
    if prior is None:
        prior = own.agg(F.avg("label")).first()[0] or 0.0
    prior = min(max(prior, 1e-4), 0.9)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    # Each set in order of a hash of its own, so that which documents are confirmed does not decide which are unlabelled.
    known = own.where("label = 1").select("id").orderBy(F.xxhash64("id"), "id").limit(toxic_rows)
    ids = texts.where(~held_out(F.col("id"))).select("id").distinct()
    unknown = ids.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(unlabelled_rows)
    both = known.withColumn("confirmed", F.lit(1)).unionAll(unknown.withColumn("confirmed", F.lit(0)))
    chosen = both.groupBy("id").agg(F.max("confirmed").alias("toxic"), (F.min("confirmed") == 0).alias("other"))
    # One text an id before any goes to another task, however often a sampled id is repeated.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic", "other").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_BACK):
                part = batch.slice(start, ROWS_BACK)
                found = [bag(t) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2),
                    pa.array([b.astype("<i4").tobytes() for b, _, _ in found], pa.binary()),
                    pa.array([n.astype("<i4").tobytes() for _, n, _ in found], pa.binary()),
                    pa.array([w for _, _, w in found], pa.int64()),
                ], ["id", "toxic", "other", "buckets", "counts", "words"])

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        held = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4"), w) for b, c, w in zip(frame["buckets"], frame["counts"], frame["words"])]
        toxic = [b for b, mark in zip(held, frame["toxic"]) if mark]
        model = train(toxic, [b for b, mark in zip(held, frame["other"]) if mark], prior)
        return pd.DataFrame({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    kind = docs.schema[id_column].dataType.simpleString()
    sample = rows.select("id", "toxic", "other", "text").mapInArrow(
        bags, f"id {kind}, toxic int, other boolean, buckets binary, counts binary, words long"
    )
    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "weight binary, bias double").first()
    if fitted is None:
        return Model(np.zeros(BUCKETS), float("-inf"))
    return Model(np.frombuffer(fitted["weight"], np.float64), fitted["bias"])


def with_score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (default: all) of every row and its text's score in the column ``name``; null texts count as empty."""
    keep = docs.columns if keep is None else keep
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text).alias("_text"), *keep)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + [f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_BACK):
                batch = whole.slice(start, ROWS_BACK)
                scores = shipped.value.scores(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores)], [*keep, name])

    return rows.mapInArrow(run, fields)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; ``predicted`` is 1 from ``THRESHOLD`` up.

    Every row of ``docs`` gives one row, repeated ones too; a null id counts as held out. An empty table
    gives no rows. Only the text enters a score; a null or empty one gets the bias's.
    """
    scored = with_score(docs, fit(docs, labels, text=text, id_column=id_column), text, [id_column])
    return scored.select(
        id_column, F.coalesce(held_out(F.col(id_column)), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays below ``THRESHOLD``, with the columns of ``docs``."""
    name = "_toxicity_score"
    return with_score(docs, fit(docs, labels, text=text, id_column=id_column), text, name=name).where(F.col(name) < THRESHOLD).select(docs.columns)
