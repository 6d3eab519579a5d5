import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from freightloom.llm import tokenfile, tokens

ODD = [
    None, "", " ", "don't CAN'T 's we're!!'s  x²³ 12345", "\n\n a\tb\r\nc", "日本語 テスト 😀😀 a", "ª µ ß ẞ ÿ İstanbul ΣΑΣ ΑΣ",
    "<|endoftext|>x <|startoftext|> <|EndOfText|>", "a\x85b \x1cc \x00 d", "'S 'T it'S 'll", "é ́a", "a﻿b ​c", "ﬁ Ǆ ǅ",
    " \xa0 \xad«» ¿qué? ¼½", "y" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.VOCABULARY)


@pytest.mark.parametrize("limits", [(1 << 22, 900_000), (64, 900_000), (64, 3)])
def test_ids_are_the_librarys(library, monkeypatch, limits):
    monkeypatch.setattr(tokens, "TEXT_BYTES", limits[0])
    monkeypatch.setattr(tokens, "KEPT_WORDS", limits[1])
    tokens._encoders.clear()
    texts = ODD + [(t or "") * 20 for t in ODD]
    for text, ids in zip(texts, tokens.encode_all(pa.array(texts, pa.string()))):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2]
    tokens._encoders.clear()


def test_every_letter_before_a_mark(library):
    """Marks after any letter of Unicode, alone and at a word's end: normal form may end a letter in a combining mark."""
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = [f"{c}{m} ab{c}{m}" for m in ",." for c in letters]
    tokens._encoders.clear()
    chunks = [texts[k : k + 5000] for k in range(0, len(texts), 5000)]
    for chunk in chunks:
        want = [e.ids for e in library.encode_batch_fast(chunk, add_special_tokens=False)]
        got = [ids.tolist() for ids in tokens.encode_all(pa.array(chunk), end_id=None)]
        assert got == want, next((t for t, a, b in zip(chunk, got, want) if a != b))
    apart = tokens.encoder(tokens.VOCABULARY)._apart
    assert not apart["\u095c"] and apart["a"] and apart["\u00e9"]
    tokens._encoders.clear()


def test_words_of_several_scripts_before_marks(library):
    texts = ["पहाड़, सड़क. बढ़ना, पढ़.", "পাহাড়, বড়. আষাঢ়.", "ਗੜ੍ਹ, ਲੜਾਈ. ਜ਼ਮੀਨ,", "שָׁלוֹם, שׁ. שׂ, יִ.", "ADLİ, İSTANBULLULARDANDI. KEDİ.", "가각, 힣. 나, ㄱ.", "ΟΔΟΣ, ΣΑΣ. ς,"]
    for text, ids in zip(texts, tokens.encode_all(pa.array(texts), end_id=None)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 2, 31, 32, 33, 8192, 8193, 32768, 32769, 70_001])
def test_coding_round_trip(size):
    ids = np.minimum(np.random.default_rng(size).zipf(1.3, size), 49_407).astype(np.uint32)
    keys, lengths, blocks = tokenfile.from_bytes(tokenfile.to_bytes([None], [ids]))
    assert keys == [None] and lengths.tolist() == [size]
    assert np.array_equal(np.concatenate(list(blocks)), ids)


def test_one_symbol_and_compression():
    same = np.full(100_000, 7, np.uint32)
    assert np.array_equal(np.concatenate(list(tokenfile.from_bytes(tokenfile.to_bytes([1], [same]))[2])), same)
    skewed = np.minimum(np.random.default_rng(0).geometric(0.2, 200_000), 60).astype(np.uint32)
    share = np.bincount(skewed) / len(skewed)
    entropy = -sum(p * np.log2(p) for p in share if p) / 8
    assert len(tokenfile.to_bytes([1], [skewed])) / len(skewed) < entropy * 1.1


def test_decoding_may_start_at_any_checkpoint():
    ids = np.arange(20_000, dtype=np.uint32) % 97
    table = tokenfile.Table.count(ids)
    (block,) = tokenfile.encode(ids, table)
    notes = int(np.frombuffer(block, "<u4", 1, 4)[0])
    assert notes == -(-(-(-20_000 // tokenfile.LANES)) // tokenfile.CHECKPOINT_STEPS) > 1
    note = np.frombuffer(block, np.uint8, notes * 260, 16).reshape(notes, 260)
    words = np.append(np.frombuffer(block, "<u4", -1, 16 + notes * 260), 0).astype(np.uint64)
    slots = np.repeat(np.arange(97), table.frequency)
    place = note[1:2, :4].copy().view("<u4")[:, 0].astype(np.int64)
    found = tokenfile._decode_segments(words, place, note[1:2, 4:].copy().view("<u8"), 256, table, slots)
    start = tokenfile.CHECKPOINT_STEPS * tokenfile.LANES
    assert np.array_equal(table.symbols[found.reshape(-1)], ids[start : 2 * start])


@pytest.mark.parametrize("place", [3, 40, 30_000, -60, -3])
def test_damage_is_found(place):
    ids = (np.arange(50_000, dtype=np.uint32) * 7919) % 1013
    data = bytearray(tokenfile.to_bytes([4], [ids]))
    data[place] ^= 1
    with pytest.raises(tokenfile.CorruptFile):
        for _ in tokenfile.from_bytes(bytes(data))[2]:
            pass


def expected(rows, library):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [1 << 23, 100])
def test_files_of_odd_rows(odd_docs, no_docs, library, file_ids):
    found = tokenfile.token_files(odd_docs, file_ids=file_ids).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected([(r.doc_id, r.text) for r in odd_docs.collect()], library)
    assert tokenfile.token_files(no_docs).count() == 0


def test_query_equals_the_library(spark, sf_dir, library):
    from freightloom.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op2_rans_token_files"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == expected(rows, library)


def test_files_are_read_by_as_many_tasks(spark, tmp_path):
    docs = spark.range(200).selectExpr("id as doc_id", "repeat('word ', 50) as text").repartition(3)
    folder = f"file://{tmp_path}"
    files = tokenfile.write_corpus(docs, folder, file_ids=200)
    assert files.count() > 40
    read = tokenfile.read_corpus(spark, files, folder)
    assert read.rdd.getNumPartitions() == files.count()
    held = [len(part) for part in files.select("name", "first_id").repartitionByRange(files.count(), "first_id", "name").rdd.glom().collect()]
    assert max(held) <= 2
    assert read.count() == 200


def test_equal_and_null_ids_are_spread(spark):
    rows = [(None, f"n{k}") for k in range(300)] + [(7, "same")] * 300 + [(k, f"t{k}") for k in range(1000, 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = tokenfile.token_files(docs, file_ids=64).orderBy("start").collect()
    assert len(found) == 900 and found[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    assert [r.doc_id for r in found] == [None] * 300 + [7] * 300 + list(range(1000, 1300))
