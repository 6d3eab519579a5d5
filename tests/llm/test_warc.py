import gzip
import hashlib
import io
import zlib

import pytest

from freightloom.llm import warc


def member(key, payload, refers_to=None):
    return warc._member(warc.record(key, f"http://h/{key}", payload, hashlib.sha256(payload).hexdigest(), refers_to))


@pytest.fixture(scope="module")
def archive():
    """Records whose payloads hold gzip magic, whole gzip members and incompressible bytes; foreign bytes between them."""
    noise = b"".join(hashlib.sha512(bytes([k])).digest() for k in range(200))
    inner = gzip.compress(b"WARC is not the first word here" * 9)
    payloads = [b"", b"short", b"\x1f\x8b\x08" * 50, noise, noise + inner + noise, b"\x1f\x8b\x08\x00" + noise, b"<html>" * 5000]
    members = [member(k, p) for k, p in enumerate(payloads * 3)]
    members.insert(4, gzip.compress(b"foreign member"))
    members.insert(9, b"\x00" * 11)
    return b"".join(members), len(payloads) * 3


@pytest.mark.parametrize("size", [1, 7, 100, 1000, 4096, 1 << 20])
def test_ranges_own_each_record_once(archive, size, monkeypatch):
    monkeypatch.setattr(warc, "_CHUNK", 512)
    monkeypatch.setattr(warc, "_PIECE", 64)
    data, count = archive
    if size < 100:
        data = data[:6000]
        count = len(list(warc.read_range(io.BytesIO(archive[0]), 0, 6000)))
    found = [r for a in range(0, len(data), size) for r in warc.read_range(io.BytesIO(archive[0]), a, min(a + size, len(data)))]
    assert [r.fields["warc-record-id"] for r in found] == [f"<urn:page:{k}>" for k in range(count)]
    assert len({r.offset for r in found}) == count


def test_a_record_cut_short_is_an_error():
    data = member(1, b"x" * 1000)
    with pytest.raises(warc.CorruptArchive):
        list(warc.read_range(io.BytesIO(data[:-20]), 0, len(data)))
    assert list(warc.read_range(io.BytesIO(b""), 0, 0)) == []
    assert list(warc.read_range(io.BytesIO(b"no archive at all"), 0, 17)) == []


def test_members_are_plain_gzip_and_fields_hold_no_line_breaks():
    data = gzip.decompress(warc._member(warc.record(3, "http://h/\r\nX: y", b"p", "d", None)))
    found = warc.parse(data)
    assert found.fields["warc-target-uri"] == "http://h/%0D%0AX: y" and "x" not in found.fields
    assert found.block.endswith(b"\r\n\r\np") and zlib.crc32(data)


def expected(rows):
    first = {}
    for key, page in rows:
        body = (page or "").encode()
        if len(body) >= 100 and key is not None:
            first[body] = min(first.get(body, key), key)
    out = []
    for key, page in rows:
        body = (page or "").encode()
        holder = first.get(body)
        refers = holder if holder is not None and holder != key else None
        out.append((key, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_bytes", [200, 4 << 20])
def test_round_trip_of_odd_pages(spark, range_bytes):
    long, edge = "é" * 50, "a" * 99
    rows = [(1, long), (2, long), (0, None), (3, ""), (4, "x"), (5, "x"), (6, edge), (7, edge), (8, "p" * 200_000), (9, long), (9, long), (None, long), (10, "\x1f�\x08" * 99)]
    pages = spark.createDataFrame([(k, None if k == 4 else f"u{k}", h, 1, 2) for k, h in rows], "page_id long, url string, html string, digest int, id int")
    read = warc.archived(pages, range_bytes=range_bytes)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()]
    assert sorted(found, key=repr) == expected(rows)
    assert warc.archived(pages.where("false")).count() == 0


def test_small_archives_are_closed_early(spark, sf_dir):
    from freightloom.llm.store import shared_folder

    folder = shared_folder(spark, "warc-test")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    files = warc.write_archives(pages, folder, file_bytes=20_000)
    assert files.count() > 3
    assert warc.read_archives(spark, files, folder, 5000).count() == pages.count()
