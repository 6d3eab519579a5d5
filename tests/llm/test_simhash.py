import random

import xxhash
from brute import brute_components, brute_simhash

from freightloom.llm import simhash


def test_simhash_of_a_text_matches_bit_counting(odd_docs):
    for row in odd_docs.collect():
        assert simhash.simhash(row.text) == brute_simhash(row.text)


def test_long_texts_are_added_up_in_pieces(monkeypatch):
    text = " ".join(str(k) for k in range(500))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 7)
    assert simhash.simhash(text) == whole == brute_simhash(text)


def test_seed_and_case():
    assert simhash.simhash("One") == xxhash.xxh64_intdigest(b"one", 42)
    assert simhash.simhash("É") == xxhash.xxh64_intdigest("É".encode(), 42)  # only A-Z are lowered
    assert simhash.simhash("a b") != simhash.simhash("a b")


def test_bk_tree_finds_all_within_the_radius():
    draw = random.Random(3)
    values = [draw.getrandbits(64) & 0xFFFFFF for _ in range(400)]
    tree = simhash.BKTree()
    for value in values:
        tree.insert(value)
    for value in values[:50]:
        near = {k for k, other in enumerate(values) if (value ^ other).bit_count() <= 3}
        assert set(tree.within(value, 3)) == near
    assert simhash.BKTree().within(1, 3) == []


def test_links_connect_what_brute_force_connects_in_hot_buckets(spark):
    # A chain and a dense family share most bits, so buckets exceed the shard size many times over.
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    family = {centre}
    while len(family) < 300:
        value = draw.choice(sorted(family))
        family.add(value ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)))
    values = sorted(family | {draw.getrandbits(64) for _ in range(300)} | {0, 7, 2**64 - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    for shard_rows in (4096, 16):
        links = simhash.fingerprint_links(prints, shard_rows=shard_rows)
        found = {r.node: r.root for r in simhash.components(links).collect()}
        want = brute_components(values)
        groups = {}
        for value, sign in zip(values, signed):
            groups.setdefault(found.get(sign, sign), set()).add(value)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(links).collect()}
    assert found == {k: 0 for k in range(201)} | {500: 500, 501: 500}
    assert simhash.components(links.where("false")).count() == 0


def test_near_duplicates_on_odd_rows(odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    prints = [brute_simhash(t) for _, t in rows]
    first = {}
    for group in brute_components(sorted(set(prints))):
        ids = [i for (i, _), p in zip(rows, prints) if p in group and i is not None]
        first |= {p: min(ids, default=None) for p in group}
    want = sorted(((i, f"{p:016x}", first[p]) for (i, _), p in zip(rows, prints)), key=repr)
    assert sorted(map(tuple, found), key=repr) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one_leaves_one_row_of_each_group(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 0, 3, 6, 7, 8, 9, 10, 11, 12]
    assert simhash.keep_one(no_docs).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    found = QUERIES["op1_simhash_near_dedup"](spark, sf_dir).collect()
    rows = [(r.doc_id, brute_simhash(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    first = {}
    for group in brute_components(sorted({p for _, p in rows})):
        first |= {p: min(i for i, q in rows if q in group) for p in group}
    assert sorted(map(tuple, found)) == sorted((i, f"{p:016x}", first[p]) for i, p in rows)
