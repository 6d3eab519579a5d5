import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from freightloom.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(digests):
    """Levels of nodes, bottom first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[k : k + 8])) for k in range(0, len(row), 8)])
    return levels


def brute_path(levels, number):
    path = []
    for row in levels[:-1]:
        run = row[number // 8 * 8 : number // 8 * 8 + 8]
        path.append((run[: number % 8], run[number % 8 + 1 :]))
        number //= 8
    return path


def brute_manifest(rows):
    """Expected rows from ``(doc_id, source, lang, n_chars, text)``."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, brute_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = brute_tree([r[2] for r in groups[name]])
    top = brute_tree([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for number, (_, _, leaf, row) in enumerate(groups[name]):
            path = brute_path(trees[name], number) + brute_path(top, place)
            end = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                end = brute_leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for before, after in path:
                end = sha("".join(before) + end + "".join(after))
            proof = sha("".join("".join(b) + "".join(a) for b, a in path))
            out.append((row[0], leaf, trees[name][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(out, key=repr)


def found(docs):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in manifest.checked(docs).select(columns).collect()), key=repr)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*manifest.COLUMNS).collect()]


@pytest.mark.parametrize("height", range(5))
def test_addresses_are_a_permutation_and_subtrees_are_together(height):
    places = [manifest.address(height, level, np.arange(8 ** (height - level))) for level in range(height + 1)]
    assert sorted(np.concatenate(places).tolist()) == list(range(manifest.tree_nodes(height + 1)))
    assert places[-1][0] == 0
    rows = height + 1
    if rows > 1:  # each bottom subtree of the first halving is one stretch
        top = rows // 2
        bottom, size = rows - top, manifest.tree_nodes(rows - top)
        for tree in range(8**top):
            held = [p[tree * 8 ** (bottom - 1 - level) : (tree + 1) * 8 ** (bottom - 1 - level)] for level, p in enumerate(places[:bottom])]
            held = np.concatenate(held)
            assert held.min() == manifest.tree_nodes(top) + tree * size and held.max() - held.min() == size - 1


def test_strata_are_halves_of_bounded_height():
    for levels in range(21):
        heights = manifest.strata(levels)
        assert sum(heights) == levels and max(heights) <= manifest.BLOCK_LEVELS
        assert all(h > 0 for h in heights) or levels == 0


@pytest.mark.parametrize("bottom", [1, 2, 8, 9, 63, 64, 65, 511, 512])
def test_block_paths_lead_to_the_root(bottom):
    digests = [hashlib.sha256(bytes([k % 256, k // 256])).digest() for k in range(bottom)]
    levels = brute_tree([d.hex() for d in digests])
    height = len(levels) - 1
    nodes = manifest.block(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32), height)
    for number, path in enumerate(manifest.block_paths(nodes, height, bottom)):
        assert manifest.folded(digests[number], path).hex() == levels[-1][0]
        assert [(b.hex(), a.hex()) for b, a in manifest.siblings(path)] == [("".join(b), "".join(a)) for b, a in brute_path(levels, number)]


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(docs) == brute_manifest(rows_of(docs))


def test_several_strata_and_many_groups(spark):
    """Trees of 0 to 4 levels of edges, and a tree of groups that has two; one group holds most rows."""
    sizes = {"big": 700, **{f"g{k}": 1 + k % 10 for k in range(20)}, None: 9, "é": 8}
    rows, number = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((number, f"Text {number}" if number % 7 else None, lang, "s", number % 5))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(docs) == brute_manifest(rows_of(docs))


def test_odd_rows(odd_docs, no_docs):
    wide = odd_docs.selectExpr("*", "1 as tree", "2 as digest", "3 as item", "4 as rank", "5 as n")
    assert found(wide) == brute_manifest(rows_of(odd_docs))
    assert manifest.checked(no_docs).count() == 0


def test_equal_rows_are_spread(spark):
    """A row that is a third of the table lies in several partitions of the range sort."""
    docs = spark.createDataFrame([(5, "same", "en", "s", 4)] * 300 + [(k, f"t{k}", "en", "s", 2) for k in range(600)], "doc_id long, text string, lang string, source string, n_chars long")
    assert found(docs) == brute_manifest(rows_of(docs))


def test_any_change_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r for r in manifest.proofs(manifest.build(docs)).collect()}
    assert all(r.verified and r.folded_root == r.root for r in before.values())
    changed = manifest.leaf_digest([manifest.F.concat(manifest.F.col("text"), manifest.F.lit("!")) if c == "text" else manifest.F.col(c) for c in manifest.COLUMNS])
    after = manifest.proofs(manifest.build(docs, changed=changed)).collect()
    assert not any(r.verified for r in after)
    assert all((r.leaf, r.root, r.proof_sha256) == (before[r.doc_id].leaf, before[r.doc_id].root, before[r.doc_id].proof_sha256) for r in after)
