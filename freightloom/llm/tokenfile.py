"""Token ids in files coded by a static range asymmetric numeral system.

A file holds the ids of consecutive documents::

    magic, frequency table, blocks, document table, block places, place of the document table, magic

The frequency table is counted over all of the file's ids and shared by its blocks. A block is ``BLOCK_IDS``
consecutive ids (the last one fewer), coded by ``LANES`` interleaved states into one stream of 32-bit words,
and is independent of the others. Every ``CHECKPOINT_STEPS`` steps it notes the states and the place in the
stream, so decoding can start there: numpy decodes all segments of many blocks side by side. Table, document
table and every block's decoded ids carry a CRC-32, which reading verifies.

Documents are sorted by id over the whole corpus; a task writes its range as one or more files of about
``FILE_IDS`` ids, so its memory is bounded.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import open_folder, shared_folder, stored, write_file
from .tokens import END_ID, VOCABULARY, encode_all

MAGIC = b"RANSIDS1"
LANES = 32
BLOCK_IDS = 1 << 15
CHECKPOINT_STEPS = 256
FILE_IDS = 1 << 23
#: Frequencies add up to 2 ** PRECISION.
PRECISION = 20
#: Most tasks that read files back.
READING_TASKS = 1 << 15
#: Blocks coded or decoded side by side.
TOGETHER = 128

_LOW = 1 << 31  # a state is at least this between symbols
_MASK = np.uint64((1 << PRECISION) - 1)
_SHIFT = np.uint64(PRECISION)
_WORD = np.uint64(32)


class CorruptFile(ValueError):
    """A token file's checksum or structure is wrong."""


@dataclass(frozen=True)
class Table:
    """Distinct ids, their frequencies, and the sum of the frequencies before each."""

    symbols: np.ndarray
    frequency: np.ndarray

    @classmethod
    def count(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        spare = (1 << PRECISION) - len(symbols)
        frequency = 1 + counts * spare // counts.sum()
        short = (1 << PRECISION) - int(frequency.sum())
        frequency[np.argsort(-counts, kind="stable")[:short]] += 1
        return cls(symbols.astype(np.uint32), frequency.astype(np.uint32))

    @property
    def before(self) -> np.ndarray:
        return np.cumsum(self.frequency, dtype=np.uint64) - self.frequency


def _encode_blocks(numbers: np.ndarray, table: Table) -> list[tuple[list[tuple[int, np.ndarray]], np.ndarray]]:
    """Checkpoints and words of each row of ``numbers`` (symbol numbers; rows x steps x lanes)."""
    rows, steps, lanes = numbers.shape
    frequency, before = table.frequency.astype(np.uint64), table.before
    by_step = np.ascontiguousarray(numbers.transpose(1, 0, 2), np.intp).reshape(steps, rows * lanes)
    state = np.full(rows * lanes, _LOW, np.uint64)
    words = np.empty(rows * steps * lanes, np.uint32)
    left = (np.arange(rows) + 1) * (steps * lanes)  # where each row's words start, from the end backwards
    first = left - steps * lanes
    notes: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        share = frequency.take(by_step[step])
        full = state >= share << np.uint64(63 - PRECISION)
        placed = full.reshape(rows, lanes).cumsum(axis=1)
        left = left - placed[:, -1]
        words[((left - 1)[:, None] + placed).ravel()[full]] = state[full].astype(np.uint32)
        state >>= full * _WORD
        quotient = state // share
        state += (quotient << _SHIFT) - quotient * share
        state += before.take(by_step[step])
        if step % CHECKPOINT_STEPS == 0:
            notes.append((left, state.reshape(rows, lanes).copy()))
    notes.reverse()
    return [
        ([(int(at[r] - left[r]), states[r]) for at, states in notes], words[left[r] : first[r] + steps * lanes]) for r in range(rows)
    ]


def encode(ids: np.ndarray, table: Table) -> list[bytes]:
    """The ids' blocks: length, checkpoints, words and CRC of the ids, then checkpoints and words."""
    numbers = np.zeros(int(table.symbols[-1]) + 1, np.int32)
    numbers[table.symbols] = np.arange(len(table.symbols))
    number = numbers[ids]
    whole = len(ids) // BLOCK_IDS * BLOCK_IDS
    groups = [(a, min(a + BLOCK_IDS * TOGETHER, whole), BLOCK_IDS) for a in range(0, whole, BLOCK_IDS * TOGETHER)]
    if whole < len(ids):
        groups.append((whole, len(ids), len(ids) - whole))
    out = []
    for start, stop, size in groups:
        # A short block's unused lanes code the most frequent symbol; its length says where it ends.
        pad = np.full(-(stop - start) % LANES, np.argmax(table.frequency), np.int32)
        rows = np.concatenate([number[start:stop], pad]).reshape((stop - start) // size, -1, LANES)
        for k, (notes, words) in enumerate(_encode_blocks(rows, table)):
            own = ids[start + k * size : start + (k + 1) * size].astype("<u4").tobytes()
            head = struct.pack("<IIII", size, len(notes), len(words), zlib.crc32(own))
            checkpoints = b"".join(struct.pack("<I", at) + states.astype("<u8").tobytes() for at, states in notes)
            out.append(head + checkpoints + words.astype("<u4").tobytes())
    return out


def _decode_segments(words: np.ndarray, place: np.ndarray, state: np.ndarray, steps: int, table: Table, slots: np.ndarray) -> np.ndarray:
    """Symbol numbers (segments x steps x lanes) from each segment's place in ``words`` and its states."""
    frequency, before = table.frequency.astype(np.uint64), table.before
    segments = len(state)
    out = np.empty((steps, segments * LANES), np.int32)
    state = state.ravel()
    for step in range(steps):
        slot = state & _MASK
        symbol = slots.take(slot.view(np.int64))
        out[step] = symbol
        state = frequency.take(symbol) * (state >> _SHIFT) + slot - before.take(symbol)
        short = state < _LOW
        taken = short.reshape(segments, LANES).cumsum(axis=1)
        read = words.take(((place - 1)[:, None] + taken).ravel()[short])
        state[short] = (state[short] << _WORD) | read
        place = place + taken[:, -1]
    return out.reshape(steps, segments, LANES).transpose(1, 0, 2)


def decode(data: bytes, table: Table, places: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of the blocks at ``places`` in ``data``, several blocks at a time, verified."""
    slots = np.repeat(np.arange(len(table.symbols)), table.frequency)
    head_size, note_size = 16, 4 + 8 * LANES
    for start in range(0, len(places), TOGETHER):
        group, words, at, states, used = [], [], [], [], 0
        for place in places[start : start + TOGETHER].tolist():
            size, notes, count, crc = struct.unpack_from("<IIII", data, place)
            note = np.frombuffer(data, np.uint8, notes * note_size, place + head_size).reshape(notes, note_size)
            at.append(note[:, :4].copy().view("<u4")[:, 0].astype(np.int64) + used)
            states.append(note[:, 4:].copy().view("<u8"))
            words.append(np.frombuffer(data, "<u4", count, place + head_size + notes * note_size))
            used += count
            group.append((size, notes, crc))
        stream = np.append(np.concatenate(words), np.uint32(0)).astype(np.uint64)
        # Segments of the same number of steps are decoded together; only a block's last one can be shorter.
        steps = [min(CHECKPOINT_STEPS, -(-size // LANES) - k * CHECKPOINT_STEPS) for size, notes, _ in group for k in range(notes)]
        steps = np.array(steps)
        at, states = np.concatenate(at), np.concatenate(states).astype(np.uint64)
        parts: list[np.ndarray] = [np.empty(0, np.int32)] * len(steps)
        for length in np.unique(steps):
            chosen = np.flatnonzero(steps == length)
            found = _decode_segments(stream, at[chosen], states[chosen], int(length), table, slots)
            for k, segment in zip(chosen, found):
                parts[k] = segment.reshape(-1)
        first = 0
        for size, notes, crc in group:
            ids = table.symbols[np.concatenate(parts[first : first + notes])[:size]]
            first += notes
            if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
                raise CorruptFile("a block's checksum does not match")
            yield ids


def to_bytes(keys: list[int | None], documents: list[np.ndarray]) -> bytes:
    """The file of some documents (each with at least one id), with their ids in the document table."""
    ids = np.concatenate(documents).astype(np.uint32)
    table = Table.count(ids)
    packed = struct.pack("<I", len(table.symbols)) + table.symbols.astype("<u4").tobytes() + table.frequency.astype("<u4").tobytes()
    blocks = encode(ids, table)
    start = len(MAGIC) + len(packed) + 4
    places = start + np.cumsum([0, *map(len, blocks)])
    own = np.array([0 if k is None else k for k in keys], "<i8").tobytes() + np.array([k is None for k in keys], np.uint8).tobytes()
    lengths = np.fromiter(map(len, documents), "<u8", len(documents)).tobytes()
    tail = struct.pack("<II", len(keys), len(blocks)) + own + lengths + places[:-1].astype("<u8").tobytes()
    return b"".join(
        [MAGIC, packed, struct.pack("<I", zlib.crc32(packed)), *blocks, tail, struct.pack("<IQ", zlib.crc32(tail), int(places[-1])), MAGIC]
    )


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, Iterator[np.ndarray]]:
    """Keys and lengths of a file's documents, and its ids block by block."""
    end = len(data) - len(MAGIC) - 12
    if data[: len(MAGIC)] != MAGIC or data[-len(MAGIC) :] != MAGIC:
        raise CorruptFile("not a whole token file")
    crc, place = struct.unpack_from("<IQ", data, end)
    if zlib.crc32(data[place:end]) != crc:
        raise CorruptFile("the document table's checksum does not match")
    (symbols,) = struct.unpack_from("<I", data, len(MAGIC))
    after = len(MAGIC) + 4 + 8 * symbols
    if zlib.crc32(data[len(MAGIC) : after]) != struct.unpack_from("<I", data, after)[0]:
        raise CorruptFile("the frequency table's checksum does not match")
    numbers = np.frombuffer(data, "<u4", 2 * symbols, len(MAGIC) + 4)
    docs, blocks = struct.unpack_from("<II", data, place)
    keys = np.frombuffer(data, "<i8", docs, place + 8).tolist()
    none = np.frombuffer(data, np.uint8, docs, place + 8 + 8 * docs)
    lengths = np.frombuffer(data, "<u8", docs, place + 8 + 9 * docs).astype(np.int64)
    places = np.frombuffer(data, "<u8", blocks, place + 8 + 17 * docs).astype(np.int64)
    table = Table(numbers[:symbols], numbers[symbols:])
    return [None if n else k for k, n in zip(keys, none)], lengths, decode(data, table, places)


def write_corpus(
    docs: DataFrame, folder: str, text: str = "text", id_column: str = "doc_id", vocabulary: str = VOCABULARY,
    end_id: int = END_ID, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write all texts' ids under the folder URI, in ascending id order; one row per file: ``name, first_id, n_ids, n_docs``.

    ``first_id`` counts the ids of all files before it. Null texts count as empty and hold the end id alone;
    documents with a null id come first; of equal ids the smaller text comes first. An empty table gives no
    file. Columns other than id and text are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt, number = context.partitionId(), context.taskAttemptId(), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"part-{part:05d}-{number:05d}.ids"
            write_file(folder, name, attempt, to_bytes(keys, held))
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "name": [name], "n_ids": [size], "n_docs": [len(keys)]})

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode_all(batch.column(1), vocabulary, end_id)):
                keys.append(key)
                held.append(ids)
                size += len(ids)
                if size >= file_ids:
                    yield close()
                    keys, held, size, number = [], [], 0, number + 1
        if keys:
            yield close()

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    # A third of all ids may be null: equal ids are spread by how their texts begin, which keeps them in order.
    ordered = rows.withColumn("start", F.substring("text", 1, 64)).repartitionByRange("id", "start")
    ordered = ordered.sortWithinPartitions("id", "text").select("id", "text")
    files = stored(ordered.mapInArrow(run, "part long, number long, name string, n_ids long, n_docs long"), "token-files")
    before = F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("name", F.coalesce(before, F.lit(0)).alias("first_id"), "n_ids", "n_docs")


def read_corpus(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``, all from the files' bytes.

    ``files`` names them with the number of ids before each (``name, first_id``). A wrong checksum raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                filesystem, path = open_folder(folder)
                with filesystem.open_input_stream(f"{path}/{name}") as stream:
                    keys, lengths, blocks = from_bytes(stream.read())
                sums = np.array(list(_document_sums(lengths, blocks)), np.int64)
                starts = first + np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    # One task a file, whatever few bytes their names have; beyond the bound a task reads several, one by one.
    tasks = max(1, min(files.count(), READING_TASKS))
    spread = files.select("name", "first_id").repartitionByRange(tasks, "first_id", "name")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _document_sums(lengths: np.ndarray, blocks: Iterator[np.ndarray]) -> Iterator[int]:
    """CRC-32 of each document's ids, which may lie in several blocks."""
    block, at = b"", 0
    for length in lengths.tolist():
        left, crc = 4 * length, 0
        while left:
            if at == len(block):
                block, at = next(blocks).astype("<u4").tobytes(), 0
            part = block[at : at + left]
            crc = zlib.crc32(part, crc)
            at += len(part)
            left -= len(part)
        yield crc


def token_files(docs: DataFrame, **settings) -> DataFrame:
    """Write the ids of ``docs`` into a fresh shared folder and read them back; settings are those of ``write_corpus``."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    return read_corpus(spark, write_corpus(docs, folder, **settings), folder)
