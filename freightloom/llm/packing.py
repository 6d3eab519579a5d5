"""Lexical retrieval packing: windows of related documents.

Texts are tokenised once and stored. How many documents hold each term, and the mean length, are counted over
all of them. Documents are then sorted by their rarest terms that another document holds too, the rarest first,
and cut into shards of about ``shard_bytes`` of text: those that share their rarest term lie side by side
whatever the corpus's size, and a term of more documents than a shard holds is divided by the next terms (in
the end by a hash). A BM25 inverted index over each shard is weighted by the corpus's statistics, and windows
are filled one after the other: a seed document, then the unused documents that its most telling terms
retrieve, best first, then those that its other terms do, until the window is full. A document that does not
fit is cut at the window's end and its rest opens the next window, so only a shard's last window is padded.
When a seed retrieves nothing unused, the next unused document in the shard's order is the new seed within the
same window. Of a row that is repeated, as a mixture repeats its documents, no two copies share a window as
long as the shard has anything else to put there.

Retrieval itself does not leave a shard: of two related documents whose rarest shared terms differ, neither
finds the other if they lie in different shards. A task holds one shard at a time, and no shard holds more
than ``shard_bytes`` (a document counts ``DOC_BYTES`` besides its text) and one document, however often a row
is repeated. Rows are sorted, so a retried task
packs them alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .store import stored
from .tokens import END_ID, VOCABULARY, encode_all

WINDOW = 4096
SHARD_BYTES = 4 << 20
DOC_BYTES = 64
#: Highest-weighted terms of a seed that make its first query; its other terms make the second.
QUERY_TERMS = 24
#: Rarest terms by which documents are sorted into shards.
PLACE_TERMS = 8
K1, B = 1.2, 0.75

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Statistics(NamedTuple):
    """What BM25 takes from a whole corpus."""

    count: int  # documents
    mean: float  # of their lengths
    holding: np.ndarray  # by term, the documents that hold it


class Distinct:
    """Distinct terms of documents, in no order; without sorting."""

    def __init__(self, terms: int) -> None:
        self._last = np.empty(terms, np.int64)

    def __call__(self, document: np.ndarray) -> np.ndarray:
        places = np.arange(len(document))
        self._last[document] = places
        return document[self._last[document] == places]


def statistics(documents: DataFrame, terms: int, dtype: str) -> Statistics:
    """Counted over all of ``documents``, which has ``ids`` as bytes; at most ``terms`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, holding, count, total = Distinct(terms), np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            for ids in _documents(batch.column(0), dtype):
                holding[distinct(ids)] += 1
                total += len(ids)
            count += len(batch)
        held = np.flatnonzero(holding)
        numbers = np.append(held, [-1, -2])
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.append(holding[held], [count, total]))], ["term", "n"])

    sums = documents.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(sums.column("term").to_pylist(), sums.column("n").to_pylist()))
    count, total = found.pop(-1, 0), found.pop(-2, 0)
    holding = np.zeros(terms, np.int64)
    holding[list(found)] = list(found.values())
    return Statistics(count, total / max(count, 1), holding)


def _documents(column: pa.Array, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(ids, dtype) for ids in column.to_pylist()]


class Index:
    """BM25 inverted index of one shard, by the statistics of the corpus or else its own."""

    def __init__(self, documents: list[np.ndarray], corpus: Statistics | None = None) -> None:
        count = len(documents)
        lengths = np.fromiter(map(len, documents), np.int64, count)
        owner = np.repeat(np.arange(count, dtype=np.int64), lengths)
        pairs = np.sort(np.concatenate(documents).astype(np.int64) * count + owner)
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        frequency = np.diff(np.append(first, len(pairs)))
        term, self._doc = np.divmod(pairs[first], count)
        edges = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        posted = np.diff(np.append(edges, len(term)))
        among, mean, holding = (corpus.count, corpus.mean, corpus.holding[term[edges]]) if corpus else (count, lengths.mean(), posted)
        idf = np.log1p((among - holding + 0.5) / (holding + 0.5))
        norm = K1 * (1 - B + B * lengths / mean)
        weight = np.repeat(idf, posted) * frequency * (K1 + 1) / (frequency + norm[self._doc])
        self._weight = weight
        self._start, self._size = edges, posted
        # The same postings by document: term numbers, the highest weight first.
        number = np.repeat(np.arange(len(edges)), posted)
        order = np.lexsort((number, -weight, self._doc))
        self._terms = number[order]
        self._bounds = np.searchsorted(self._doc[order], np.arange(count + 1))
        self._count = count

    def related(self, seed: int, query: slice = slice(QUERY_TERMS)) -> np.ndarray:
        """Documents sharing a query term with the seed, best first, ties to the earlier one."""
        terms = self._terms[self._bounds[seed] : self._bounds[seed + 1]]
        terms = terms[self._size[terms] > 1][query]
        if not len(terms):
            return terms
        parts = [slice(s, s + n) for s, n in zip(self._start[terms], self._size[terms])]
        docs = np.concatenate([self._doc[p] for p in parts])
        score = np.bincount(docs, np.concatenate([self._weight[p] for p in parts]), self._count)
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def pack(
    documents: list[np.ndarray], window: int = WINDOW, corpus: Statistics | None = None, alike: list[int] | None = None
) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece; each id lies in exactly one piece.

    Documents with the same number in ``alike`` do not share a window while others are left.
    """
    if not documents:
        return
    alike = list(range(len(documents))) if alike is None else alike
    here: set[int] = set()  # numbers of what the window holds
    only_alike = False  # nothing else is left for this window
    index, used = Index(documents, corpus), np.zeros(len(documents), bool)
    sequence, filled, next_unused = 0, 0, 0
    rest: tuple[int, int] | None = None  # document and how many of its ids are placed
    queue: Iterator[int] = iter(())

    def unused(seed: int) -> Iterator[int]:
        for query in (slice(QUERY_TERMS), slice(QUERY_TERMS, None)):
            found = index.related(seed, query)
            yield from found[~used[found]]

    while True:
        if rest is None:
            doc = next((int(d) for d in queue if not used[d] and alike[d] not in here), None)
            if doc is None:
                while next_unused < len(documents) and used[next_unused]:
                    next_unused += 1
                if next_unused == len(documents):
                    return
                doc = next_unused
                if alike[doc] in here and not only_alike:
                    doc = next((d for d in range(doc, len(documents)) if not used[d] and alike[d] not in here), doc)
                    only_alike = doc == next_unused
                queue = iter(()) if only_alike else unused(doc)
            used[doc] = True
            rest = (doc, 0)
        doc, start = rest
        if start and filled == 0 and len(documents[doc]) - start < window:
            queue = unused(doc)  # what is left of a cut document seeds the next window
        length = min(window - filled, len(documents[doc]) - start)
        yield doc, start, length, sequence, filled
        here.add(alike[doc])
        filled += length
        rest = (doc, start + length) if start + length < len(documents[doc]) else None
        if filled == window:
            sequence, filled, only_alike = sequence + 1, 0, False
            here.clear()
            if rest is None:
                queue = iter(())


def packed(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", vocabulary: str = VOCABULARY, end_id: int = END_ID,
    window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's; ``doc_tokens`` counts
    all ids of the document with ``end_id``; ``ids_crc32`` is that of the piece's ids as little-endian
    unsigned 32-bit integers. Null texts count as empty and give the end id alone. Every row is a document
    of its own, so repeated rows, ties and null ids are packed as often as they occur. An empty table gives
    no pieces. Columns other than id and text are not looked at.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    terms = max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1)
    dtype = "<u2" if terms <= 1 << 16 else "<u4"
    names = ["id", "tie", "row", "size", "ids"]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [d.astype(dtype).tobytes() for d in encode_all(batch.column(4), vocabulary, end_id)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary())], names)

    # The row's number tells repeated rows apart. It stays as it is, as the table is stored.
    rows = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(id_column, text).alias("tie"), F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"), F.col(text).alias("text"),
    )
    documents = stored(rows.mapInArrow(tokenise, f"id {kind}, tie long, row long, size long, ids binary"), "packing-documents")
    corpus = statistics(documents, terms, dtype)
    shared = np.flatnonzero(corpus.holding > 1)
    rank = np.full(terms, len(shared), np.uint32)
    rank[shared[np.argsort(corpus.holding[shared], kind="stable")]] = np.arange(len(shared))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(terms)
        for batch in batches:
            places = []
            for ids in _documents(batch.column(4), dtype):
                ranks = rank[distinct(ids)]
                if len(ranks) > PLACE_TERMS:
                    ranks = np.partition(ranks, PLACE_TERMS - 1)[:PLACE_TERMS]
                places.append(np.sort(ranks[ranks < len(shared)]).astype(">u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.binary())], [*names, "place"])

    shards = (documents.agg(F.sum(F.col("size") + DOC_BYTES)).first()[0] or 0) // shard_bytes + 1
    parts = min(int(shards), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order_by = ["place", "tie", "row"]
    placed = documents.mapInArrow(place, f"id {kind}, tie long, row long, size long, ids binary, place binary")
    dealt = placed.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by).select("id", "tie", "size", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, size, ids, ties, held = TaskContext.get().partitionId(), 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            number = shard << 17 | part
            pieces = [(ids[d], s, n, zlib.crc32(held[d][s : s + n].astype("<u4").tobytes()), len(held[d]), (number << 32) + q, o) for d, s, n, q, o in pack(held, window, corpus, ties)]
            kinds = [batch.column(0).type, *[pa.int64()] * 6]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces), kinds)], names)

        for batch in batches:
            for key, tie, bytes_, document in zip(*(c.to_pylist() for c in batch.columns[:3]), _documents(batch.column(3), dtype)):
                if held and size + bytes_ + DOC_BYTES > shard_bytes:
                    yield close()
                    shard, size, ids, ties, held = shard + 1, 0, [], [], []
                size += bytes_ + DOC_BYTES
                ids.append(key)
                ties.append(tie)
                held.append(document)
        if held:
            yield close()

    return dealt.mapInArrow(run, PIECES.format(id=kind))
