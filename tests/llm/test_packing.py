import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from freightloom.llm import packing
from freightloom.llm.tokens import VOCABULARY


def bm25(documents, seed):
    """Scores of all documents by the plain formula, for the seed's most telling terms."""
    count, mean = len(documents), np.mean([len(d) for d in documents])
    sets = [set(d.tolist()) for d in documents]
    holding = {t: sum(t in s for s in sets) for t in sets[seed]}

    def weight(term, doc):
        often = (documents[doc] == term).sum()
        idf = np.log1p((count - holding[term] + 0.5) / (holding[term] + 0.5))
        return idf * often * (packing.K1 + 1) / (often + packing.K1 * (1 - packing.B + packing.B * len(documents[doc]) / mean))

    terms = sorted((t for t in sets[seed] if holding[t] > 1), key=lambda t: (-weight(t, seed), t))[: packing.QUERY_TERMS]
    return [sum(weight(t, d) for t in terms if t in sets[d]) for d in range(count)]


def test_retrieval_is_bm25():
    rng = np.random.default_rng(1)
    documents = [np.minimum(rng.zipf(1.4, rng.integers(1, 80)), 60).astype(np.uint32) for _ in range(40)]
    index = packing.Index(documents)
    for seed in range(40):
        want = np.array(bm25(documents, seed))
        found = index.related(seed)
        assert set(found.tolist()) == set(np.flatnonzero(want).tolist())
        assert (np.diff(want[found]) <= 1e-9).all()


def test_windows_are_full_and_hold_every_id_once():
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 50, rng.integers(1, 300)).astype(np.uint32) for _ in range(100)] + [np.arange(1000, dtype=np.uint32)]
    pieces = list(packing.pack(documents, window=128))
    ends = defaultdict(int)
    for doc, start, length, _, _ in pieces:
        assert start == ends[doc] and length > 0
        ends[doc] += length
    assert [ends[d] for d in range(len(documents))] == [len(d) for d in documents]
    filled = defaultdict(int)
    for _, _, length, sequence, offset in pieces:
        assert offset == filled[sequence]
        filled[sequence] += length
    assert all(n == 128 for n in [filled[s] for s in sorted(filled)][:-1])
    assert list(packing.pack([], window=128)) == []


def test_related_documents_share_a_window():
    rng = np.random.default_rng(3)
    documents = [rng.integers(100 * (k % 5), 100 * (k % 5) + 100, 64).astype(np.uint32) for k in range(100)]
    windows = defaultdict(set)
    for doc, _, _, sequence, _ in packing.pack(documents, window=256):
        windows[sequence].add(doc % 5)
    assert sum(len(kinds) == 1 for kinds in windows.values()) >= 20


def check(found, rows):
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted(
        ((key, tuple([*library.encode(text or "", add_special_tokens=False).ids, 2])) for key, text in rows), key=repr
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        place = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= packing.WINDOW
    texts = defaultdict(list)
    for key, ids in want:
        texts[key, len(ids)].append(ids)
    assert set(texts) == set(pieces)
    for key, copies in texts.items():
        covered = np.zeros(key[1], int)
        for r in pieces[key]:
            covered[r.start : r.start + r.length] += 1
            part = [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids in copies]
            assert r.ids_crc32 in part
        assert (covered == len(copies)).all()


@pytest.mark.parametrize("shard_bytes", [packing.SHARD_BYTES, 3000])
def test_pieces_of_odd_rows(odd_docs, no_docs, shard_bytes):
    check(packing.packed(odd_docs, shard_bytes=shard_bytes).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert packing.packed(no_docs).count() == 0


def test_query_packs_all_documents(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    found = QUERIES["op8_lexical_packing"](spark, sf_dir).collect()
    check(found, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    sizes = defaultdict(int)
    for r in found:
        sizes[r.sequence_id] += r.length
    assert sum(n < packing.WINDOW for n in sizes.values()) <= len({s >> 32 for s in sizes})


def test_weights_are_those_of_the_whole_corpus():
    """Term 1 is rarer than 2 in the shard and common in the corpus."""
    documents = [np.array(d, np.uint32) for d in ([1, 2], [1, 3], [2, 4], [2, 5])]
    holding = np.array([0, 900, 3, 1, 1, 1])
    assert packing.Index(documents).related(0)[1] == 1
    assert packing.Index(documents, packing.Statistics(1000, 2.0, holding)).related(0).tolist() == [0, 2, 3, 1]


def test_documents_that_share_only_a_late_term_are_found():
    rare = np.arange(100, 140, dtype=np.uint32)
    filler = [np.arange(200 + 10 * k, 210 + 10 * k, dtype=np.uint32) for k in range(5)]
    seed, twin = np.append(rare, 7), np.array([7, 8, 9], np.uint32)
    documents = [seed, rare.copy(), *filler, twin, np.array([7, 9], np.uint32)]
    order = [d for d, start, *_ in packing.pack(documents, window=1000) if not start]
    assert order.index(7) < order.index(2) and order.index(8) < order.index(2)


@pytest.mark.parametrize("copies", [1, 8])
def test_related_documents_meet_at_every_size(spark, copies):
    """Each topic's documents lie in the same shard or two, of dozens, and repeated rows are divided."""
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in ("sol", "mer", "tan", "vik", "pol", "rud") for b in ("ane", "ort", "ish", "umo", "eck")]
    topics = ["zebra", "violin", "glacier", "pepper", "comet", "tulip", "anchor", "walrus", "marble", "saddle", "lantern", "oyster"]
    rows = []
    for k, topic in enumerate(topics):
        for j in range(8 * copies):
            rows.append((100 * k + j, " ".join([*rng.choice(words, 60), topic])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    shards = defaultdict(set)
    every = set()
    for r in packing.packed(docs, shard_bytes=4000 * copies).collect():
        shards[r.doc_id // 100].add(r.sequence_id >> 32)
        every.add(r.sequence_id >> 32)
    assert len(every) >= 10
    assert np.mean([len(s) for s in shards.values()]) <= 3


def test_a_row_repeated_often_fills_several_shards(spark):
    docs = spark.createDataFrame([(1, "the same words again and again")] * 400, "doc_id long, text string").repartition(4)
    found = packing.packed(docs, shard_bytes=2000).collect()
    assert len({r.sequence_id >> 32 for r in found}) >= 6 and sum(r.length for r in found) == 400 * found[0].doc_tokens


def test_copies_do_not_share_a_window():
    """Two readings of each document, as a mixture has them, lie in different windows."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 300, rng.integers(5, 40)) for _ in range(60)]
    documents, alike = texts + texts, [*range(60), *range(60)]
    windows = {}
    for doc, _, _, sequence, _ in packing.pack(documents, 128, alike=alike):
        windows.setdefault(sequence, []).append((alike[doc], doc))
    shared = [q for q, held in windows.items() if len({a for a, _ in held}) < len({d for _, d in held})]
    assert len(windows) > 15 and set(shared) <= set(sorted(windows)[-2:])  # at the end there may be nothing else


def test_many_copies_and_empty_texts_take_linear_time():
    import time

    begin = time.perf_counter()
    same = [np.array([2], np.uint16)] * 60_000
    pieces = list(packing.pack(same, 4096, alike=[0] * len(same)))
    assert len(pieces) == 60_000 and time.perf_counter() - begin < 30


def test_a_shard_of_empty_texts_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(null as string) as text").coalesce(1)
    found = packing.packed(docs, shard_bytes=packing.DOC_BYTES * 500).collect()
    assert len(found) == 3000
    assert max(sum(r.sequence_id >> 32 == s for r in found) for s in {r.sequence_id >> 32 for r in found}) <= 500
