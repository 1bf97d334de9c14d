"""The graph and the sharded search against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from segloom.llm.neighbours import Graph, fit_centres, fit_margin, nearest_centre, nearest_neighbours, similar_pairs, top_k, unit_vectors
from segloom.session import table


def clustered(n, dimension=16, clusters=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dimension))
    x = centres[rng.integers(0, clusters, n)] + 0.6 * rng.normal(size=(n, dimension))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def recall(found, x, queries, k):
    exact = np.argsort(-(x[queries] @ x.T), axis=1)[:, :k]
    return np.mean([len(set(f) & set(e)) / k for f, e in zip(found, exact)])


def test_graph():
    x = clustered(3000)
    graph = Graph(x)
    assert graph.edges.max() < len(x) and (graph.edges[np.arange(len(x))] != np.arange(len(x))[:, None]).all()
    queries = np.arange(0, 3000, 7)
    ids, sims = top_k(graph, x[queries], 10, 32)
    assert recall(ids, x, queries, 10) >= 0.9
    assert np.allclose(sims, np.take_along_axis(x[queries] @ x.T, ids, 1), atol=1e-5) and (np.diff(sims, axis=1) <= 1e-6).all()


def test_small_and_equal():
    for x in (clustered(1), clustered(3), np.repeat(clustered(1), 200, axis=0)):
        ids, _ = top_k(Graph(x), x, min(len(x), 5), 32)
        assert (np.sort(ids, axis=1)[:, -1] < len(x)).all()
    assert fit_centres(clustered(50), 4).shape == (4, 16)


def test_sharded(spark):
    x = clustered(1500)
    rows = [(f"k{i:04d}", [float(v) * (1 + i % 5) for v in x[i]], "x") for i in range(len(x))]
    rows += [("null", None, "x"), ("zero", [0.0] * 16, "x"), ("short", [1.0], "x"), ("nan", [float("nan")] * 16, "x"), ("inner", [1.0, None] * 8, "x"), (None, [1.0] * 16, "x"), rows[3], ("copy", rows[5][1], "x")]
    df = spark.createDataFrame(rows, "k string, v array<float>, key string")
    options = {"dimension": 16, "shard_size": 150, "ask": 4}
    assert unit_vectors(df, "k", "v", 16).count() == 1501
    found = nearest_neighbours(df, "k", "v", 10, **options).toPandas()
    assert (found.groupby("k").size() == 10).all() and found.k.nunique() == 1501 and (found.k != found.neighbour).all()
    number = {f"k{i:04d}": i for i in range(len(x))} | {"copy": 5}
    sims = x @ x.T
    got = [set(map(number.get, g)) for _, g in found[found.k.str.startswith("k")].groupby("k").neighbour]
    exact = [set(np.argsort(-sims[i])[1:11]) for i in range(len(x))]
    assert np.mean([len(a & b) / 10 for a, b in zip(got, exact)]) >= 0.9
    pairs = {tuple(r) for r in similar_pairs(df, "k", "v", 0.9999, **options).collect()}
    assert ("copy", "k0005") in pairs


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v array<float>")
    assert nearest_neighbours(df, "k", "v", 5, dimension=4).count() == 0
    one = spark.createDataFrame([("a", [1.0, 2.0])], "k string, v array<float>")
    assert nearest_neighbours(one, "k", "v", 5, dimension=2).count() == 0


def test_whole_table(spark, data):
    chunks = table(spark, data, "child_chunks")
    unit = unit_vectors(chunks, "chunk_id", "embedding", 64).toPandas().sort_values("key")
    x, keys = np.stack(unit.vec), unit.key.tolist()
    sims = x @ x.T
    exact = {tuple(sorted((keys[a], keys[b]))) for a, b in zip(*np.where(np.triu(sims, 1) >= 0.95))}
    assert {tuple(r) for r in similar_pairs(chunks, "chunk_id", "embedding", 0.95).collect()} == exact


def test_batch_and_many_reverse_edges():
    """Nodes of one batch are proposed to each other, and a node weighs all its reverse edges."""
    x = clustered(1500, clusters=1)
    graph = Graph(x[:64])
    graph.x, graph.edges = x, np.full((1500, graph.degree), -1, np.int32)
    near = x @ x.T
    np.fill_diagonal(near, -9)
    among = graph._among(np.arange(200))
    assert all(near[i, :200].argmax() in among[i] for i in range(200))
    sources = np.argsort(near[0], kind="stable")[-100:].astype(np.int32)  # the nearest come last
    graph._link_back(sources, np.zeros((100, 1), np.int32))
    assert sources[-1] in graph.edges[0]


def test_asks_enough_shards():
    """With many centres three don't hold the nearest; those within the fitted margin do, and are fewer where fewer will do."""
    x = clustered(4000, clusters=1)
    centres = fit_centres(x, 200)
    assert fit_margin(x, fit_centres(x, 1), 10, 0.9) == 0
    margin = fit_margin(x, centres, 10, 0.95)
    home, queries = nearest_centre(x, centres), np.arange(2000, 2500)
    sims = x[queries] @ x.T
    sims[np.arange(500), queries] = -9
    near = home[np.argsort(-sims, axis=1)[:, :10]]
    to_centres = x[queries] @ centres.T
    held = np.take_along_axis(to_centres, near, axis=1) >= to_centres.max(axis=1, keepdims=True) - margin
    rank = np.take_along_axis(np.argsort(np.argsort(-to_centres, axis=1), axis=1), near, axis=1)
    assert (rank < 3).mean() < 0.8 < 0.93 < held.mean()


@pytest.mark.parametrize("shard_size", [2000, 100, 15])
def test_recall_at_many_shards(spark, data, shard_size):
    """Recall against brute force on the data's vectors, in one shard, some ten and some eighty."""
    chunks = table(spark, data, "child_chunks")
    unit = unit_vectors(chunks, "chunk_id", "embedding", 64).toPandas().sort_values("key")
    x, keys = np.stack(unit.vec), unit.key.to_numpy()
    sims = x @ x.T
    np.fill_diagonal(sims, -9)
    exact = {k: set(keys[np.argsort(-sims[i])[:10]]) for i, k in enumerate(keys)}
    found = nearest_neighbours(chunks, "chunk_id", "embedding", 10, shard_size=shard_size).toPandas().groupby("chunk_id").neighbour.agg(set)
    assert len(found) == len(keys)
    assert np.mean([len(exact[k] & found[k]) / 10 for k in keys]) >= 0.9


def test_prune_weighs_few_empty_places(monkeypatch):
    """Edges are those of a loop; nodes with few candidates aren't weighed over the places that others fill."""
    x = clustered(400, clusters=1)
    graph = Graph(x)
    rng = np.random.default_rng(2)
    nodes = np.arange(300, dtype=np.int32)
    candidates = np.full((300, 72), -1, np.int32)
    for i in range(300):
        n = 72 if i % 50 == 0 else rng.integers(0, 8)
        candidates[i, rng.choice(72, n, replace=False)] = rng.integers(0, 400, n)
    weighed, diverse = [], Graph._diverse
    monkeypatch.setattr(Graph, "_diverse", lambda self, own, held: weighed.append(held.size) or diverse(self, own, held))
    got = graph.prune(nodes, candidates)
    assert sum(weighed) < candidates.size / 3
    for node, row in zip(nodes, candidates):
        left = sorted({int(c) for c in row} - {-1, int(node)}, key=lambda c: 2 - 2 * float(x[c] @ x[node]))
        edges = []
        while left and len(edges) < graph.degree:
            edges.append(left.pop(0))
            left = [c for c in left if (2 - 2 * float(x[c] @ x[edges[-1]])) * graph.relax > 2 - 2 * float(x[c] @ x[node])]
        assert [e for e in got[node].tolist() if e >= 0] == edges


def test_search_in_parts(monkeypatch):
    """A search holds a bounded number of queries at once, with the answers of one alone."""
    x = clustered(2000)
    graph, own, sizes, search = Graph(x), np.where(np.arange(700) % 3, np.arange(700), -1), [], Graph._search
    monkeypatch.setattr(Graph, "_search", lambda self, queries, *rest: sizes.append(len(queries)) or search(self, queries, *rest))
    together = top_k(graph, x[:700], 10, 48, own)
    assert max(sizes) <= 256
    for i in range(0, 700, 70):
        alone = top_k(graph, x[i : i + 1], 10, 48, own[i : i + 1])
        assert set(alone[0][0]) == set(together[0][i]) and np.allclose(alone[1][0], together[1][i], atol=1e-6)
    assert graph.search(x[:0], 48)[0].shape == (0, 48)
