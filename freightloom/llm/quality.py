"""Quality classifier on supervised subword embeddings.

Features of a text are its words and the 3- to 5-character n-grams of its words (``<`` and ``>`` mark word
ends) and, for a word equal to the one before it, a mark of its own for the repetition; all are hashed into
one table of learned vectors. A document is the mean of its features' vectors, and a
softmax layer turns the mean into class probabilities. Vectors and layer are trained together by
stochastic gradient descent, one document a step, on a bounded sample of the labelled rows.

Scoring. The mean and the layer are linear, so a feature's vector enters a score only through one number,
its product with the difference of the two classes' weights. Scorers get that one number per bucket
(``BUCKETS`` doubles, whatever the corpus) and add it up over whole texts with numpy, in pieces of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
EPOCHS = 8
RATE = 2.0
SAMPLE_ROWS = 4000
THRESHOLD = 0.3
SEED = 7

#: Rows of a batch that a scoring task returns.
ROWS_BACK = 1000
#: Code points read at once; texts are cut at white space, so only a longer word is ever cut.
PIECE = 1 << 19
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Bucket of the mark for a repeated word.
_REPEATED = 0


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = max(text.rfind(" ", start, end), text.rfind("\n", start, end))
            end = cut + 1 if cut > start else end
        yield text[start:end]
        start = end


def _buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = hashes * _FACTOR
    return ((mixed ^ (mixed >> np.uint64(29))) * _FACTOR >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature occurrence of the texts, and each one's text number (features are not in order)."""
    joined = " ".join(" ".join(t.split()) for t in texts)
    words_in = np.fromiter((len(t.split()) for t in texts), np.int64, len(texts))
    words = joined.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    marked = "<" + "><".join(words) + ">"
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    text_of_word = np.repeat(np.arange(len(texts)), words_in)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(points))  # code points to the word's end, own included
    # A word's hash depends on its code points and their places in it.
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    weights = (points + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _FACTOR
    weights ^= weights >> np.uint64(31)
    found, owner = [_buckets(np.add.reduceat(weights, starts))], [text_of_word]
    again = np.fromiter(map(eq, words, words[1:]), bool, len(words) - 1) & (text_of_word[1:] == text_of_word[:-1])
    found.append(np.full(again.sum(), _REPEATED, np.int32))
    owner.append(text_of_word[1:][again])
    text_of_point = np.repeat(text_of_word, lengths)
    rolling = points
    for n in range(2, max(NGRAMS) + 1):
        rolling = rolling[:-1] * np.uint64(1_000_003) + points[n - 1 :]
        if n in NGRAMS:
            inside = left[: len(rolling)] >= n
            found.append(_buckets(rolling[inside] + np.uint64(n)))
            owner.append(text_of_point[: len(rolling)][inside])
    return np.concatenate(found), np.concatenate(owner)


@dataclass(frozen=True)
class Model:
    """What scoring needs: a number per bucket, the layer's bias, both as class 1 minus class 0."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 per text; a text without words gets the bias's."""
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        held: list[tuple[int, str]] = []
        size = 0

        def add() -> None:
            buckets, owner = features([t for _, t in held])
            places = np.array([k for k, _ in held])
            np.add.at(total, places, np.bincount(owner, self.weight[buckets], len(held)))
            np.add.at(count, places, np.bincount(owner, minlength=len(held)))

        for k, text in enumerate(texts):
            for piece in _pieces(text or ""):
                held.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    add()
                    held, size = [], 0
        if held:
            add()
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Fit vectors and layer; a bag holds a document's distinct buckets and how often each occurs."""
    rng = np.random.default_rng(SEED)
    # Vectors start at zero, so features that training never saw leave a score alone.
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    layer = rng.normal(0, DIMENSIONS**-0.5, (2, DIMENSIONS)).astype(np.float32)
    # The bias is the classes' share, which is also the score of a text without words.
    bias = np.log(np.maximum(np.bincount(labels, minlength=2), 1)).astype(np.float32)
    steps, step = EPOCHS * max(len(bags), 1), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, counts = bags[k]
            if not len(buckets):
                continue
            share = (counts / counts.sum()).astype(np.float32)
            rows = vectors[buckets]
            mean = share @ rows
            logits = layer @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[k]] -= 1
            back = error @ layer
            layer -= rate * np.outer(error, mean)
            # Shares are small; dividing by their norm keeps steps of long and short documents alike.
            vectors[buckets] = rows - np.outer(rate * share / (share @ share) ** 0.5, back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(id_column: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id's text is divisible by 5."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``sample_rows`` labelled documents that are not held out, chosen by a hash of the id.

    The sample's ids are few by that bound, so they are broadcast; its texts are read whole. Rows whose id,
    text or label is null, or whose label is not 0 or 1, are not learned from; of an id's several labels or
    texts the smallest counts. Without any labelled row every score is one half.
    """
    own = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    chosen = own.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).where("text is not null")
    # One text an id before any goes to the learning task, however often a sampled id is repeated.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, body, mark in zip(*(c.to_pylist() for c in batch.columns)):
                parts = [features([p])[0] for p in _pieces(body)]
                buckets, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int32),) * 2
                out.append((key, mark, buckets.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:])],
                ["id", "label", "buckets", "counts"],
            )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        held = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4")) for b, c in zip(frame["buckets"], frame["counts"])]
        model = train(held, frame["label"].to_numpy(np.int64))
        return pd.DataFrame({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    kind = docs.schema[id_column].dataType.simpleString()
    sample = rows.select("id", "text", "label").mapInArrow(bags, f"id {kind}, label int, buckets binary, counts binary")
    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "weight binary, bias double").first()
    if fitted is None:
        return Model(np.zeros(BUCKETS), 0.0)
    return Model(np.frombuffer(fitted["weight"], np.float64), fitted["bias"])


def with_score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (default: all) of every row and its text's score in the column ``name``.

    Null texts count as empty; a text without words gets the score of the model's bias.
    """
    keep = docs.columns if keep is None else keep
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text).alias("_text"), *keep)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + [f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Texts may go back along with the scores, so they go in small batches.
            for start in range(0, whole.num_rows, ROWS_BACK):
                batch = whole.slice(start, ROWS_BACK)
                scores = shipped.value.scores(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores)], [*keep, name])

    return rows.mapInArrow(run, fields)


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row; ``predicted`` is 1 from ``THRESHOLD`` up.

    Every row of ``docs`` gives one row, repeated ones too; a null id counts as held out. An empty table
    gives no rows. Only the text enters a score.
    """
    scored = with_score(docs, fit(docs, labels, text=text, id_column=id_column), text, [id_column])
    return scored.select(
        id_column, F.coalesce(held_out(F.col(id_column)), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``THRESHOLD``, with the columns of ``docs``."""
    model = fit(docs, labels, text=text, id_column=id_column)
    name = "_quality_score"
    return with_score(docs, model, text, name=name).where(F.col(name) >= THRESHOLD).select(docs.columns)
