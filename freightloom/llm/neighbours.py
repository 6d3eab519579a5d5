"""Approximate nearest neighbours on robust-pruned directed graphs.

Distinct vectors are dealt into shards of about ``SHARD_ROWS``, each with a graph of its own. Points are
inserted in batches: a greedy beam search proposes neighbours for each (all it kept, and the batch's own
nearest), and robust pruning keeps a diverse few: the nearest is kept, and drops every candidate that is more
than ``ALPHA`` times closer to it than to the point. Edges are also added backwards and pruned again. A
second pass over all points repairs what the first built on a smaller graph. Graphs are stored as rows.
Walks start at several points far from each other, as a dense group, whose points know little but each
other, may hold the middle.

A query walks every shard's graph with a beam; distances are Euclidean on the original vectors in double
precision, and the nearest over all shards are kept. Queries are dealt into blocks, so a task holds one
graph and one block. Equal vectors are one point, which stands for its ``k + 1`` smallest ids: more of them
cannot be among ``k`` nearest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

NEIGHBOURS = 10
SHARD_ROWS = 8192
QUERY_ROWS = 2048
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
SEED = 5
#: Points at which a walk starts.
STARTS = 32
#: Points inserted, or queries walked, side by side.
BATCH = 512


@dataclass
class Graph:
    """Points and, per point, up to ``DEGREE`` neighbours (-1: none)."""

    points: np.ndarray
    edges: np.ndarray
    starts: np.ndarray


def _squared(points: np.ndarray, norms: np.ndarray, queries: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Squared distances from each query to its chosen points (queries x candidates); no point: infinite."""
    products = np.einsum("qcd,qd->qc", points[chosen], queries)
    found = norms[chosen] - 2 * products + np.einsum("qd,qd->q", queries, queries)[:, None]
    return np.where(chosen < 0, np.inf, np.maximum(found, 0))


def beam_search(graph: Graph, queries: np.ndarray, beam: int, norms: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest points met by each query's walk (-1 beyond), nearest first, and their squared distances."""
    norms = np.einsum("nd,nd->n", graph.points, graph.points) if norms is None else norms
    count = len(queries)
    seen = np.zeros((count, len(graph.points) + 1), bool)  # the last column stands for "no point"
    seen[:, -1] = True
    ids = np.full((count, beam), -1, np.int64)
    starts = graph.starts[:beam]
    ids[:, : len(starts)] = starts
    seen[:, starts] = True
    near = np.full((count, beam), np.inf)
    near[:, : len(starts)] = _squared(graph.points, norms, queries, ids[:, : len(starts)])
    walked = np.zeros((count, beam), bool)
    active = np.arange(count)
    while len(active):
        open_near = np.where(walked[active] | (ids[active] < 0), np.inf, near[active])
        pick = open_near.argmin(axis=1)
        going = np.isfinite(open_near[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        walked[active, pick] = True
        candidates = graph.edges[ids[active, pick]]
        candidates = np.where(seen[active[:, None], candidates], -1, candidates)
        seen[active[:, None], candidates] = True
        distance = _squared(graph.points, norms, queries[active], candidates)
        merged_ids = np.concatenate([ids[active], candidates], axis=1)
        merged_near = np.concatenate([near[active], distance], axis=1)
        merged_walked = np.concatenate([walked[active], np.zeros(candidates.shape, bool)], axis=1)
        best = np.argsort(merged_near, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(merged_ids, best, 1)
        near[active] = np.take_along_axis(merged_near, best, 1)
        walked[active] = np.take_along_axis(merged_walked, best, 1)
    return np.where(np.isfinite(near), ids, -1), near


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Up to ``DEGREE`` diverse neighbours of each owner among its candidates (-1: none); never the owner itself."""
    vectors = points[candidates]
    own = points[owners]
    distance = np.einsum("qcd,qcd->qc", vectors, vectors) - 2 * np.einsum("qcd,qd->qc", vectors, own) + np.einsum("qd,qd->q", own, own)[:, None]
    distance = np.where((candidates < 0) | (candidates == owners[:, None]), np.inf, np.maximum(distance, 0))
    order = np.argsort(distance, axis=1, kind="stable")
    candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
    vectors = points[candidates]
    sizes = np.einsum("qcd,qcd->qc", vectors, vectors)
    # A repeated candidate lies at distance zero from its first, which drops it.
    between = sizes[:, :, None] + sizes[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1))
    out = np.full((len(owners), DEGREE), -1, np.int64)
    rows = np.arange(len(owners))
    for slot in range(DEGREE):
        pick = distance.argmin(axis=1)
        there = np.isfinite(distance[rows, pick])
        if not there.any():
            break
        out[there, slot] = candidates[rows, pick][there]
        dropped = ALPHA**2 * np.maximum(between[rows, pick], 0) <= distance
        distance = np.where(dropped, np.inf, distance)
        distance[rows, pick] = np.inf
    return out


def _spread(points: np.ndarray, norms: np.ndarray, count: int) -> np.ndarray:
    """The point nearest the middle, then always the one farthest from those chosen."""
    chosen = [int((norms - 2 * points @ points.mean(axis=0)).argmin())]
    distance = np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        distance = np.minimum(distance, norms - 2 * points @ points[chosen[-1]] + norms[chosen[-1]])
        distance[chosen] = -np.inf
        chosen.append(int(distance.argmax()))
    return np.array(chosen)


def build(points: np.ndarray) -> Graph:
    """Graph over the points, which are distinct."""
    count = len(points)
    norms = np.einsum("nd,nd->n", points, points)
    graph = Graph(points, np.full((count, DEGREE), -1, np.int64), _spread(points, norms, STARTS))
    order = np.random.default_rng(SEED).permutation(count)
    for turn in range(2):
        at, size = 0, 1 if turn == 0 else BATCH
        while at < count:
            batch = order[at : at + size]
            at, size = at + size, min(BATCH, 2 * size)
            met, _ = beam_search(graph, points[batch], min(BUILD_BEAM, count), norms)
            # Points of one batch do not see each other in the graph yet, so they are proposed directly.
            peers = norms[batch] - 2 * points[batch] @ points[batch].T
            close = batch[np.argsort(peers, axis=1, kind="stable")[:, : DEGREE // 2]]
            proposed = np.concatenate([met, graph.edges[batch], close], axis=1)
            graph.edges[batch] = robust_prune(points, batch, proposed)
            _add_back_edges(graph, batch)
    return graph


def _add_back_edges(graph: Graph, batch: np.ndarray) -> None:
    targets, sources = graph.edges[batch].ravel(), np.repeat(batch, DEGREE)
    targets, sources = targets[targets >= 0], sources[targets >= 0]
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    owners, starts, counts = np.unique(targets, return_index=True, return_counts=True)
    for low in range(0, len(owners), BATCH):
        own = owners[low : low + BATCH]
        wide = np.full((len(own), int(counts[low : low + BATCH].max())), -1, np.int64)
        for k, (s, n) in enumerate(zip(starts[low : low + BATCH], counts[low : low + BATCH])):
            wide[k, :n] = sources[s : s + n]
        wide[(wide[:, :, None] == graph.edges[own][:, None, :]).any(axis=2)] = -1
        room = (graph.edges[own] < 0).sum(axis=1)
        new = (wide >= 0).sum(axis=1)
        fits = new <= room
        for k in np.flatnonzero(fits & (new > 0)):
            free = np.flatnonzero(graph.edges[own[k]] < 0)[: new[k]]
            graph.edges[own[k], free] = wide[k][wide[k] >= 0]
        full = ~fits
        if full.any():
            for part in np.array_split(np.flatnonzero(full), math.ceil(full.sum() / 128)):
                proposed = np.concatenate([graph.edges[own[part]], wide[part]], axis=1)
                graph.edges[own[part]] = robust_prune(graph.points, own[part], proposed)


def _usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and one of them not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS,
    shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every row that ``is_query`` marks.

    ``score`` is the Euclidean distance; ties go to the smaller id; a row is never its own neighbour, an equal
    vector with another id may be. Rows whose vector is null, empty, zero or holds null or non-finite
    components, or whose id is null, take no part. Vectors of another length than the query's are no
    candidates. Rows repeated with one id count once. Fewer than ``k`` candidates give fewer rows; an empty
    table gives none. Columns other than id and vector are not looked at.
    """
    rows = vectors.select(
        F.col(id_column).alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("vector"), is_query.alias("asks")
    )
    rows = stored(rows.where(F.col("id").isNotNull() & _usable(F.col("vector"))), "ann-rows")
    # One point per distinct vector. Adding zero turns -0.0 into 0.0, so equal vectors have equal keys.
    keyed = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    order = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    ids = keyed.groupBy("vector", "id").agg(F.max("asks").alias("asks"))
    first = ids.select("vector", "id").withColumn("place", order).where(F.col("place") <= k + 1)
    points = first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = stored(points.withColumn("length", F.size("vector")), "ann-points")
    sizes = {r["length"]: math.ceil(r["count"] / shard_rows) for r in points.groupBy("length").count().collect()}
    shards = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]) if sizes else F.lit(None).cast("map<int,int>")
    point_id = F.element_at("ids", 1)
    dealt = points.withColumn("shard", F.pmod(F.xxhash64(point_id), shards[F.col("length")]).cast("long"))

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(first=frame["ids"].str[0]).sort_values("first")
        graph = build(np.stack(frame["vector"].to_list()))
        members = np.array([list(i) + [-1] * (k + 1 - len(i)) for i in frame["ids"]], np.int64)
        counts = frame["ids"].str.len().to_numpy(np.int64)
        return pd.DataFrame({
            "length": [frame["length"].iloc[0]], "shard": [frame["shard"].iloc[0]], "starts": [graph.starts.tobytes()],
            "points": [graph.points.tobytes()], "edges": [graph.edges.astype("<i4").tobytes()],
            "members": [members.tobytes()], "counts": [counts.tobytes()],
        })

    schema = "length int, shard long, starts binary, points binary, edges binary, members binary, counts binary"
    graphs = stored(dealt.groupBy("length", "shard").applyInPandas(make, schema), "ann-graphs")

    asked = ids.where("asks").select("id", "vector", F.size("vector").alias("length"))
    total = max(1, asked.count())
    blocks = math.ceil(total / QUERY_ROWS)
    all_shards = F.sequence(F.lit(0).cast("long"), shards[F.col("length")].cast("long") - 1)
    queries = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("shard", F.explode(all_shards))
    targets = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["length", "shard", "block"]

    def walk(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            one = left.iloc[0]
            points = np.frombuffer(one["points"]).reshape(-1, one["length"])
            edges = np.frombuffer(one["edges"], "<i4").reshape(-1, DEGREE).astype(np.int64)
            graph = Graph(points, edges, np.frombuffer(one["starts"], np.int64))
            members = np.frombuffer(one["members"], np.int64).reshape(len(points), -1)
            counts = np.frombuffer(one["counts"], np.int64)
            right = right.sort_values("id")
            for low in range(0, len(right), BATCH):
                part = right.iloc[low : low + BATCH]
                asked = np.stack(part["vector"].to_list())
                met, _ = beam_search(graph, asked, min(beam, len(points)))
                for key_id, query, own in zip(part["id"].to_numpy(), asked, met):
                    out.append(_expanded(key_id, query, own[own >= 0], points, members, counts, k))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    found = targets.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(walk, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _expanded(
    key: int, query: np.ndarray, met: np.ndarray, points: np.ndarray, members: np.ndarray, counts: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest members of the points met, without the query's own row, with exact distances."""
    score = np.sqrt(((points[met] - query) ** 2).sum(axis=1))
    ids = members[met]
    there = (np.arange(ids.shape[1]) < counts[met][:, None]) & (ids != key)
    scores = np.broadcast_to(score[:, None], ids.shape)[there]
    best = np.lexsort((ids[there], scores))[:k]
    return np.full(len(best), key, np.int64), ids[there][best], scores[best]


def brute_force(points: np.ndarray, ids: np.ndarray, query: np.ndarray, key: int, k: int) -> Iterator[int]:
    """Ids of the exact nearest, to measure recall against."""
    score = np.sqrt(((points - query) ** 2).sum(axis=1))
    order = np.lexsort((ids, score))
    yield from [int(ids[j]) for j in order if ids[j] != key][:k]
