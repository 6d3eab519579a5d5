import numpy as np
import pytest
from pyspark.sql import functions as F

from freightloom.llm import neighbours


def exact(ids, points, key, k):
    score = np.sqrt(((points - points[ids == key][0]) ** 2).sum(axis=1))
    order = [j for j in np.lexsort((ids, score)) if ids[j] != key][:k]
    return [(int(ids[j]), score[j]) for j in order]


def clustered(seed, count, width=16):
    """Points around a few centres; one centre holds a third of them, very close together."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    home = np.where(rng.random(count) < 0.33, 0, rng.integers(1, 12, count))
    return centres[home] + rng.normal(size=(count, width)) * np.where(home == 0, 0.01, 0.5)[:, None]


def test_robust_prune_keeps_the_nearest_and_drops_what_it_covers():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0], [1, 0.01]])
    kept = neighbours.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 5, 0, -1, 1]]))[0]
    assert kept[kept >= 0].tolist() == [1, 3, 4]


def test_beam_search_on_a_whole_graph_is_exact():
    points = np.random.default_rng(0).normal(size=(30, 4))
    edges = np.array([[j for j in range(30) if j != i] for i in range(30)])
    graph = neighbours.Graph(points, edges, np.array([3]))
    found, near = neighbours.beam_search(graph, points[:5] + 0.1, 6)
    for row, own, distance in zip(points[:5] + 0.1, found, near):
        want = np.argsort(((points - row) ** 2).sum(axis=1))[:6]
        assert own.tolist() == want.tolist()
        assert np.allclose(distance, np.sort(((points - row) ** 2).sum(axis=1))[:6])


def test_graph_has_bounded_degree_and_no_loops():
    points = clustered(1, 1500)
    graph = neighbours.build(points)
    assert graph.edges.shape == (1500, neighbours.DEGREE)
    assert not (graph.edges == np.arange(1500)[:, None]).any()
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() for e in graph.edges)


@pytest.mark.parametrize("shard_rows", [8192, 500])
def test_recall_with_a_dense_group(spark, shard_rows):
    points, ids = clustered(2, 2000), np.arange(2000)
    rows = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(rows, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).toPandas()
    hits = 0
    for key, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        order = list(zip(own["score"], own["vec_id"]))
        assert order == sorted(order)
        want = exact(ids, points, key, 10)
        hits += len(set(own["vec_id"]) & {i for i, _ in want})
    assert found["query_id"].nunique() == 100 and hits >= 0.95 * 1000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [0.0, 5.0]), (11, [0.0, 5.0]),
    ]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, score int")
    found = neighbours.nearest(frame, F.lit(True)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    far = 26**0.5
    assert got == {
        0: [(1, 0.0), (2, 0.0), (3, 1.0), (11, far)],
        1: [(0, 0.0), (2, 0.0), (3, 1.0), (11, far)],
        2: [(0, 0.0), (1, 0.0), (3, 1.0), (11, far)],
        3: [(0, 1.0), (1, 1.0), (2, 1.0), (11, 29**0.5)],
        11: [(0, far), (1, far), (2, far), (3, 29**0.5)],
    }
    assert neighbours.nearest(frame.where("false"), F.lit(True)).count() == 0
    assert neighbours.nearest(frame, F.lit(False)).count() == 0


def test_copies_beyond_k_are_not_needed(spark):
    rows = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), (F.col("id") >= 290).cast("double")).alias("embedding"))
    found = neighbours.nearest(rows, F.col("vec_id") % 100 == 0).collect()
    assert {r.query_id for r in found} == {0, 100, 200}
    for key in (0, 100, 200):
        assert sorted(r.vec_id for r in found if r.query_id == key) == [i for i in range(11) if i != key][:10]


def test_query_finds_nearly_all_true_neighbours(spark, sf_dir):
    from freightloom.llm.queries import QUERIES

    found = QUERIES["op4_pruned_graph_neighbours"](spark, sf_dir).toPandas()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, points = table["vec_id"].to_numpy(), np.stack([np.array(v, float) for v in table["embedding"]])
    hits = 0
    for key, own in found.groupby("query_id"):
        want = dict(exact(ids, points, key, 10))
        true = np.sqrt(((points - points[ids == key][0]) ** 2).sum(axis=1))
        assert all(true[ids == i][0] == s for i, s in zip(own["vec_id"], own["score"]))
        hits += len(want.keys() & set(own["vec_id"]))
    assert found["query_id"].nunique() == (ids % 100 == 0).sum() and hits >= 0.95 * len(found)
