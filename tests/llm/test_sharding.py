import math
import zlib

import numpy as np
import pytest
from helpers import final_plan_of

from freightloom.llm import sharding


def test_matrix_has_exact_margins_and_the_right_law():
    sizes = [5, 0, 17, 100, 1]
    draws = [sharding.communication_matrix(sizes, 3, np.random.default_rng(k)) for k in range(3000)]
    for matrix in draws[:50]:
        assert matrix.sum(axis=1).tolist() == sizes and matrix.sum(axis=0).tolist() == [41, 41, 41] and (matrix >= 0).all()
    cell = np.array([m[2, 0] for m in draws])  # hypergeometric: 17 of 123 with 41 good
    assert cell.mean() == pytest.approx(17 / 3, abs=0.15)
    assert cell.var() == pytest.approx(17 * (1 / 3) * (2 / 3) * (123 - 17) / 122, rel=0.12)


@pytest.mark.parametrize("good, bad, drawn", [(3, 4, 5), (41, 82, 17), (500, 3, 400), (1, 1000, 30), (700, 900, 650)])
def test_draws_follow_the_law(good, bad, drawn):
    rng = np.random.default_rng(3)
    draws = np.bincount([sharding.hypergeometric(good, bad, drawn, rng) for _ in range(20_000)], minlength=drawn + 1)
    want = np.array([math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn) for k in range(drawn + 1)]) * 20_000
    assert draws[want == 0].sum() == 0
    often = want >= 5
    assert ((draws - want)[often] ** 2 / want[often]).sum() < often.sum() + 5 * math.sqrt(2 * often.sum()) + 5


def test_draws_follow_the_law_beyond_a_billion_rows():
    """A large population's law near its mode, by logarithms of exact ratios."""
    good, bad, drawn = 3 * 10**12, 5 * 10**12, 10**6
    rng = np.random.default_rng(4)
    draws = np.array([sharding.hypergeometric(good, bad, drawn, rng) for _ in range(20_000)])
    mean, variance = drawn * good / (good + bad), drawn * (3 / 8) * (5 / 8) * (good + bad - drawn) / (good + bad - 1)
    assert draws.mean() == pytest.approx(mean, abs=5 * math.sqrt(variance / 20_000))
    assert draws.var() == pytest.approx(variance, rel=0.05)
    share = np.mean(np.abs(draws - mean) <= math.sqrt(variance))
    assert share == pytest.approx(0.6827, abs=0.02)
    assert len(set((draws % 2).tolist())) == 2
    assert sharding.hypergeometric(10**13, 0, 10**12, rng) == 10**12 and sharding.hypergeometric(0, 10**13, 5, rng) == 0


def test_matrix_of_a_huge_table_has_exact_margins():
    sizes = [10**9 + k for k in range(20)]
    matrix = sharding.communication_matrix(sizes, 8, np.random.default_rng(5))
    assert matrix.sum(axis=1).tolist() == sizes and (matrix >= 0).all()
    assert matrix.sum(axis=0).max() - matrix.sum(axis=0).min() <= 1


def check(found, rows, shards=8):
    def key(r):
        return repr(r)

    want = sorted([(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows], key=key)
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in found], key=key) == want
    counts = [0] * shards
    for r in found:
        assert r.law == "rows" and r.grown_shard is None
        counts[r.shard] += 1
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))


@pytest.mark.parametrize("rows_each", [(1 << 14, 1 << 11), (3, 2)])
def test_odd_rows(odd_docs, no_docs, monkeypatch, rows_each):
    monkeypatch.setattr(sharding, "PARTITION_ROWS", rows_each[0])
    monkeypatch.setattr(sharding, "RANGE_ROWS", rows_each[1])
    check(sharding.uniform_shards(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    check(sharding.uniform_shards(odd_docs, shards=3).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], 3)
    assert sharding.uniform_shards(no_docs).count() == 0


def test_order_is_mixed_and_repeatable(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = sorted(map(tuple, sharding.uniform_shards(docs).collect()))
    assert first == sorted(map(tuple, sharding.uniform_shards(docs.repartition(7)).collect()))
    other = sorted(map(tuple, sharding.uniform_shards(docs, seed=1).collect()))
    assert first != other
    place = np.array([r[5] for r in first])
    assert abs(np.corrcoef(np.arange(len(place)), place)[0, 1]) < 0.25
    assert len({r[4] for r in first[:40]}) > 4


def test_query_is_native(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    found = QUERIES["op7_uniform_sharding"](spark, sf_dir)
    check(found.collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    assert not any(word in final_plan_of(found) for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_a_row_that_is_a_third_of_the_table_is_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PORTION", 16)
    monkeypatch.setattr(sharding, "PARTITION_ROWS", 64)
    monkeypatch.setattr(sharding, "RANGE_ROWS", 16)
    parts = []
    monkeypatch.setattr(sharding, "stored", lambda df, name, whole=sharding.stored: parts.append(df) or whole(df, name))
    rows = [(3, "same")] * 500 + [(k, f"t{k}") for k in range(1000, 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.uniform_shards(docs).collect()
    check(found, rows)
    share = [sum(r.doc_id == 3 for r in found if r.shard == s) for s in range(8)]
    assert min(share) > 30 and max(share) < 100
    dealt = parts[1].groupBy("range").count().collect()
    assert max(r["count"] for r in dealt) < 300
    assert parts[0].count() == 1001  # rows alike are counted before they are dealt out
