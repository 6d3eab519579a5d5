"""WARC archives: writing pages, and reading byte ranges.

Writing. Every record is a gzip member of its own. Of records with equal payloads of at least
``REVISIT_BYTES`` the one with the smallest id is a response, the others are revisits that name it; smaller
ones are responses. First holders are found by a minimum per digest, which is pre-aggregated; a payload that
a third of all pages share costs one row per task.

Reading. A task gets a byte range of a file. It scans for gzip magic, takes each find as a candidate, and
keeps it if the member starts with a WARC version line; it owns the records that start in its range and
reads past the range's end to finish the last one. Bytes inside a member that look like magic are skipped
with the member; such bytes before a range's first member are told apart by decoding. (A payload that holds
an archive which deflate could only store is the one case that decoding cannot tell.)
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import open_folder, shared_folder, stored, write_file

REVISIT_BYTES = 100
#: A task starts a new archive beyond this many compressed bytes.
FILE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
LEVEL = 3

_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 20
#: Compressed bytes handed to the unpacker at once.
_PIECE = 1 << 16
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Most tasks that read ranges back.
READING_TASKS = 1 << 15


class CorruptArchive(ValueError):
    """A record that starts well does not end well, or its payload does not match its digest."""


def with_record_type(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """``id, url, payload, digest, record_type, refers_to`` of every page; a null payload is empty.

    Of pages that share the smallest id and a payload, repeated rows that is, all are responses. A page with
    a null id is a revisit only if some page with the same payload has an id; without one all are responses.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_column).alias("id"), F.col("url").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= REVISIT_BYTES
    first = rows.where(large).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(first.select("digest", "first"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).withColumn(
        "record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    ).drop("first")


def _fields(pairs: list[tuple[str, object]]) -> bytes:
    # Line breaks in a value would start a new field; a URL holds none once they are escaped.
    clean = ((k, str(v).replace("\r", "%0D").replace("\n", "%0A")) for k, v in pairs)
    return "".join(f"{k}: {v}\r\n" for k, v in clean).encode("utf-8", "surrogatepass")


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed. A revisit's block is the HTTP head alone, which tells the payload's length."""
    head = _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block = b"HTTP/1.1 200 OK\r\n" + head + b"\r\n" + (payload if refers_to is None else b"")
    name = "none" if key is None else key
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Truncated", "length")]
    return b"WARC/1.1\r\n" + _fields(fields) + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page into archives under the folder URI; one row per archive: ``name, bytes, records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, members, size = 0, [], 0

        def close() -> pa.RecordBatch:
            name = f"part-{context.partitionId():05d}-{number:05d}.warc.gz"
            write_file(folder, name, context.taskAttemptId(), b"".join(members))
            return pa.RecordBatch.from_pydict({"name": [name], "bytes": [size], "records": [len(members)]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                members.append(_member(record(*row)))
                size += len(members[-1])
                if size >= file_bytes:
                    yield close()
                    number, members, size = number + 1, [], 0
        if members:
            yield close()

    rows = with_record_type(pages, id_column, html).select(F.col("id").cast("long"), "url", "payload", "digest", "refers_to")
    return stored(rows.mapInArrow(run, "name string, bytes long, records long"), "warc-files")


class _Window:
    """A growing view of a file from some byte on."""

    def __init__(self, source, start: int) -> None:
        self._source, self.start, self.data = source, start, b""
        source.seek(start)

    def grow(self) -> bool:
        more = self._source.read(_CHUNK)
        self.data += more
        return bool(more)

    def drop(self, until: int) -> None:
        """Bytes before file offset ``until`` are not needed any more."""
        if until - self.start >= _CHUNK:
            self.data = self.data[until - self.start :]
            self.start = until


def _inflate(window: _Window, at: int, limit: int | None = None) -> tuple[bytes, int] | None:
    """The member at file offset ``at`` and the offset behind it (with ``limit``: only its first bytes); None if it is none."""
    unpacker, out, place = zlib.decompressobj(31), [], at - window.start
    size = 0
    while True:
        if place >= len(window.data) and not window.grow():
            return None
        piece = window.data[place : place + _PIECE]
        try:
            got = unpacker.decompress(piece, 0 if limit is None else limit - size)
        except zlib.error:
            return None
        out.append(got)
        size += len(got)
        place += len(piece)
        if unpacker.eof or (limit is not None and size >= limit):
            return b"".join(out), window.start + place - len(unpacker.unused_data)


def _is_record(window: _Window, at: int) -> bool:
    found = _inflate(window, at, 5)
    return found is not None and found[0].startswith(b"WARC/")


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    block: bytes
    offset: int


def parse(data: bytes, offset: int = 0) -> Record:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise CorruptArchive(f"no end of the fields of the record at {offset}")
    lines = data[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = data[end + 4 : end + 4 + int(fields.get("content-length", 0))]
    if len(block) != int(fields.get("content-length", 0)):
        raise CorruptArchive(f"the record at {offset} is cut short")
    return Record(fields, block, offset)


def read_range(source, start: int, stop: int) -> Iterator[Record]:
    """Records whose gzip member starts in ``start .. stop - 1`` of a seekable binary file."""
    window, at, inside = _Window(source, start), start, False
    while at < stop:
        if not inside:
            # Look for the next candidate; two bytes of magic may still be to come.
            found = window.data.find(_MAGIC, at - window.start)
            if found < 0:
                at = max(at, window.start + len(window.data) - len(_MAGIC) + 1)
                window.drop(min(at, window.start + len(window.data)))
                if not window.grow():
                    return
                continue
            at = window.start + found
            if at >= stop:
                return
            if not _is_record(window, at):
                at += 1
                continue
        member = _inflate(window, at)
        if member is None:
            if inside:  # padding or foreign bytes after a member
                inside, at = False, at + 1
                continue
            raise CorruptArchive(f"the member at {at} does not end")
        data, after = member
        if data.startswith(b"WARC/"):
            yield parse(data, at)
        at, inside = after, True
        window.drop(after)


def read_archives(spark: SparkSession, files: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per record: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, name, offset``.

    ``files`` names archives and their sizes (``name, bytes``), as writing returns them. The payload of a
    response is hashed again and must match its field; length and digest of a revisit are those its head tells.
    """

    def key(name: str | None) -> int | None:
        tail = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(tail) if tail.lstrip("-").isdigit() else None

    def row(found: Record) -> tuple:
        head, _, payload = found.block.partition(b"\r\n\r\n")
        kind, digest = found.fields["warc-type"], found.fields["warc-payload-digest"].removeprefix("sha256:")
        size = len(payload)
        if kind == "revisit":
            size = next(int(line[15:]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
        elif hashlib.sha256(payload).hexdigest() != digest:
            raise CorruptArchive(f"the payload at {found.offset} does not match its digest")
        return key(found.fields["warc-record-id"]), found.fields["warc-target-uri"], size, digest, kind, key(found.fields.get("warc-refers-to"))

    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, name string, offset long"
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64() if f.endswith("long") else pa.string() for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                filesystem, path = open_folder(folder)
                rows = []
                with filesystem.open_input_file(f"{path}/{name}") as source:
                    for found in read_range(source, start, stop):
                        rows.append((*row(found), name, found.offset))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    ranges = files.select("name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"), "bytes")
    ranges = ranges.select("name", "start", F.least(F.col("start") + range_bytes, "bytes").alias("stop"))
    # One task a range, whatever few bytes their names have; beyond the bound a task reads several, one by one.
    tasks = max(1, min(ranges.count(), READING_TASKS))
    return ranges.repartitionByRange(tasks, "name", "start").mapInArrow(run, fields)


def archived(pages: DataFrame, id_column: str = "page_id", html: str = "html", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` into archives in a fresh shared folder and read them back by byte ranges.

    Null and empty payloads are records of no bytes; a null URL is read back empty; repeated rows give
    repeated records; an empty table gives no archive and no rows. Columns other than id, url and html are
    not looked at.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    return read_archives(spark, write_archives(pages, folder, id_column, html), folder, range_bytes)
