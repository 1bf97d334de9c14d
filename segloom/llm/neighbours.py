"""Nearest vectors by a robust-pruned graph in each shard.

Vectors are normalised and parted into shards by the centres of a bounded
sample; a large shard is salted into several. Within a shard a directed graph
is grown: greedy searches on the graph so far propose neighbours of the next
vectors, relaxed pruning keeps diverse edges. Each vector then asks the shards
whose centres are nearly as near as its nearest one by beam search, and the best
answers of all are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.session import hash_sample, materialize


def unit_vectors(df: DataFrame, key: str, vector: str, dimension: int) -> DataFrame:
    """Rows (key, vec) of the usable vectors at length 1, one a key.

    Left out are vectors that are null, of another length than ``dimension``,
    all zeros, or hold a null, NaN or infinite number, and rows without a key.
    A key that has several vectors keeps the smallest.
    """
    kind = df.schema[key].dataType.simpleString()

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            right = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(lists), dimension), False))
            kept = batch.filter(pa.array(right))
            if not kept.num_rows:
                continue
            x = kept.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
            with np.errstate(all="ignore"):
                top = np.abs(x).max(axis=1, keepdims=True)
                x = x / top  # so that the squares neither vanish nor overflow
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
            good = np.isfinite(x).all(axis=1)
            flat = pa.array(x[good].reshape(-1))
            offsets = pa.array(np.arange(0, good.sum() * dimension + 1, dimension, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([kept.column(0).filter(pa.array(good)), pa.ListArray.from_arrays(offsets, flat)], names=["key", "vec"])

    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<float>").alias("v"))
    found = rows.mapInArrow(scaled, f"key {kind}, vec array<float>")
    return found.groupBy("key").agg(F.min("vec").alias("vec"))


def _slices(n: int, size: int = 1000) -> list[slice]:
    return [slice(at, min(n, at + size)) for at in range(0, n, size)]


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of each vector's nearest centre, in slices, so that no table of all vectors by all centres is made."""
    return np.concatenate([np.argmax(x[part] @ centres.T, axis=1) for part in _slices(len(x))] or [np.zeros(0, int)])


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """``count`` centres of the sample by spherical k-means."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), count, replace=False)].copy()
    for _ in range(rounds):
        own = nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres.astype(np.float32)


def fit_margin(sample: np.ndarray, centres: np.ndarray, k: int, share: float, queries: int = 1000) -> float:
    """By how much less similar than the nearest a centre may be, for the centres within to hold ``share`` of the k nearest.

    Measured by brute force for ``queries`` vectors of the sample. Neighbours in
    a sample lie farther apart than in the whole, so the margin isn't too small.
    """
    home = nearest_centre(sample, centres)
    needed = []
    for part in _slices(min(len(sample), queries), 100):
        block = sample[part]
        sims = block @ sample.T
        sims[np.arange(len(block)), np.arange(part.start, part.stop)] = -9
        near = np.argpartition(-sims, min(k, sims.shape[1]) - 1, axis=1)[:, :k]
        to_centres = block @ centres.T
        needed.append((to_centres.max(axis=1, keepdims=True) - np.take_along_axis(to_centres, home[near], axis=1)).ravel())
    return float(np.quantile(np.concatenate(needed), share, method="higher"))


#: Queries that are searched, and nodes that are pruned, at once: as many as a core's cache holds.
_AT_ONCE, _PRUNED = 256, 128


class Graph:
    """A robust-pruned directed graph over the unit vectors of a shard."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, degree: int = 24, beam: int = 32, relax: float = 1.2, entries: int = 128, seed: int = 11) -> None:
        self.x, self.degree, self.beam, self.relax = x, degree, beam, relax
        n = len(x)
        self.order = np.random.default_rng(seed).permutation(n).astype(np.int32)
        self.entries = self.order[: min(n, entries)]
        self.edges = np.full((n, degree), -1, np.int32) if edges is None else edges
        if edges is None:
            self._grow()

    def search(self, queries: np.ndarray, beam: int, width: int = 4, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best (ids, similarities) that a greedy search finds for each query; -1 where there are fewer.

        It begins at the entries and, for a query that is a node itself, at ``own`` (-1 where it is none).
        """
        parts = [self._search(queries[part], beam, width, None if own is None else own[part]) for part in _slices(len(queries), _AT_ONCE)]
        if not parts:
            return np.zeros((0, beam), np.int32), np.zeros((0, beam), np.float32)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, queries: np.ndarray, beam: int, width: int, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        q, columns = len(queries), len(self.x) + 1
        seen = np.zeros((q, columns), bool)
        seen[:, -1] = True
        start = self.entries
        sims = queries @ self.x[start].T
        m = max(0, beam - len(start))
        extra = np.full((q, m + 1), -1, np.int32)
        extra_sims = np.full((q, m + 1), -9, np.float32)
        if own is not None:
            known = np.flatnonzero((own >= 0) & ~np.isin(own, start))
            extra[known, 0] = own[known]
            extra_sims[known, 0] = np.einsum("ij,ij->i", self.x[own[known]], queries[known])
            seen[known, own[known]] = True
        ids = np.concatenate([np.broadcast_to(start, (q, len(start))), extra], axis=1)
        sims = np.concatenate([sims, extra_sims], axis=1)
        best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam] if sims.shape[1] > beam else np.broadcast_to(np.arange(beam), (q, beam))
        ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
        seen[:, start] = True
        seen = seen.reshape(-1)
        done = ids < 0
        active = np.arange(q)
        while len(active):
            a, a_ids, a_sims, a_done = len(active), ids[active], sims[active], done[active]
            row = np.arange(a)[:, None]
            open_sims = np.where(a_done, np.float32(9), -a_sims)
            pick = np.argpartition(open_sims, width - 1, axis=1)[:, :width]
            live = open_sims[row, pick] < 9
            a_done[row, pick] = True
            # The places in ``seen`` of the neighbours of the picked ones; -1 is the last column of the row before, which counts as seen.
            at, which = np.nonzero(live)
            near = self.edges.take(a_ids[at, pick[at, which]], axis=0) + (active[at] * columns)[:, None]
            near = near[~seen.take(near)]
            near.sort()
            if len(near):
                near = near[np.concatenate([[True], near[1:] != near[:-1]])]
                seen[near] = True
                asker = near // columns
                found = near - asker * columns
                value = np.einsum("ij,ij->i", self.x.take(found, axis=0), queries.take(asker, axis=0))
                # Those better than the worst of the pool, to the left, so that few columns are joined to it.
                asker = np.searchsorted(active, asker)
                better = value > a_sims.min(axis=1)[asker]
                asker, found, value = asker[better], found[better], value[better]
                count = np.bincount(asker, minlength=a)
                if wide := int(count.max()):
                    slot = np.arange(len(asker)) - np.repeat(np.cumsum(count) - count, count)
                    new_ids = np.full((a, wide), -1, np.int32)
                    new_sims = np.full((a, wide), -9, np.float32)
                    new_ids[asker, slot], new_sims[asker, slot] = found, value
                    all_sims = np.concatenate([a_sims, new_sims], axis=1)
                    best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
                    a_ids = np.concatenate([a_ids, new_ids], axis=1)[row, best]
                    a_done = np.concatenate([a_done, new_ids < 0], axis=1)[row, best]
                    a_sims = all_sims[row, best]
            ids[active], sims[active], done[active] = a_ids, a_sims, a_done
            active = active[~a_done.all(axis=1)]
        return ids, sims

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """The diverse edges of each node among its candidates (-1: none).

        The nearest candidate is taken, and those that are closer to it, by the
        relaxed measure, than to the node are dropped; and so on.
        """
        ordered = np.where(candidates == nodes[:, None], -1, candidates)
        ordered.sort(axis=1)
        ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
        ordered.sort(axis=1)
        # Those with few candidates together, so that few empty places are weighed; as many at once as a core's cache holds.
        count = (ordered >= 0).sum(axis=1)
        rank = np.argsort(count, kind="stable")
        out = np.full((len(nodes), self.degree), -1, np.int32)
        for part in _slices(len(nodes), _PRUNED):
            own = rank[part]
            if most := int(count[own[-1]]):
                out[own] = self._diverse(nodes[own], ordered[own, ordered.shape[1] - most :])
        return out

    def _diverse(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        b = len(nodes)
        own = np.matmul(self.x[candidates], self.x[nodes][:, :, None])[:, :, 0]
        distance = np.where(candidates >= 0, 2 - 2 * own, np.inf)
        rank = np.argsort(distance, axis=1, kind="stable")
        ordered, distance = np.take_along_axis(candidates, rank, 1), np.take_along_axis(distance, rank, 1)
        x = self.x[ordered]
        mutual = np.matmul(x, x.transpose(0, 2, 1))
        alive = np.isfinite(distance)
        out = np.full((b, self.degree), -1, np.int32)
        row = np.arange(b)
        for k in range(self.degree):
            first = np.argmax(alive, axis=1)
            some = alive[row, first]
            if not some.any():
                break
            out[:, k] = np.where(some, ordered[row, first], -1)
            alive[row, first] = False
            alive &= (2 - 2 * mutual[row, first]) * self.relax > distance
        return out

    def _link_back(self, nodes: np.ndarray, edges: np.ndarray) -> None:
        """Add the reverse of new edges; a node with too many is pruned again."""
        source = np.repeat(nodes, edges.shape[1])
        target = edges.reshape(-1)
        keep = target >= 0
        source, target = source[keep], target[keep]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        owners, begin, count = np.unique(target, return_index=True, return_counts=True)
        # In rounds of at most ``2 * degree`` new edges a node, until all have been weighed.
        most = 2 * self.degree
        slot = np.arange(len(target)) - np.repeat(begin, count)
        number = np.repeat(np.arange(len(owners)), count)
        for at in range(0, int(count.max()) if len(count) else 0, most):
            fits = (slot >= at) & (slot < at + most)
            held = np.flatnonzero(count > at)
            place = np.cumsum(count > at) - 1
            extra = np.full((len(held), int(min(most, count.max() - at))), -1, np.int32)
            extra[place[number[fits]], slot[fits] - at] = source[fits]
            self._weigh(owners[held], extra)

    def _weigh(self, owners: np.ndarray, extra: np.ndarray) -> None:
        joined = np.sort(np.concatenate([self.edges[owners], extra], axis=1), axis=1)
        joined[:, 1:][joined[:, 1:] == joined[:, :-1]] = -1
        full = (joined >= 0).sum(axis=1) > self.degree
        loose = np.sort(joined[~full], axis=1)[:, ::-1][:, : self.degree]
        self.edges[owners[~full]] = loose
        self.edges[owners[full]] = self.prune(owners[full], joined[full])

    def _among(self, nodes: np.ndarray) -> np.ndarray:
        """The nearest of each of ``nodes`` among themselves, which a search doesn't propose to each other."""
        sims = self.x[nodes] @ self.x[nodes].T
        np.fill_diagonal(sims, -9)
        k = min(self.degree // 2, len(nodes) - 1)
        return nodes[np.argpartition(-sims, k - 1, axis=1)[:, :k]] if k > 0 else np.full((len(nodes), 1), -1, np.int32)

    def _grow(self) -> None:
        n, at = len(self.x), min(len(self.x), 64)
        first = self.order[:at]
        self.edges[first] = self.prune(first, np.broadcast_to(first, (at, at)))
        while at < n:
            nodes = self.order[at : at + min(max(64, at // 2), 1024, n - at)]
            ids, _ = self.search(self.x[nodes], self.beam)
            self._link(nodes, ids)
            at += len(nodes)
        # Again on the finished graph, from each node itself.
        for nodes in np.array_split(self.order, max(1, n // 1024)):
            ids, _ = self.search(self.x[nodes], self.beam, own=nodes)
            self._link(nodes, np.concatenate([ids, self.edges[nodes]], axis=1))

    def _link(self, nodes: np.ndarray, candidates: np.ndarray) -> None:
        edges, before = self.prune(nodes, np.concatenate([candidates, self._among(nodes)], axis=1)), self.edges[nodes]
        self.edges[nodes] = edges
        # The reverse of an edge that was there before has been weighed.
        self._link_back(nodes, np.where((edges[:, :, None] == before[:, None, :]).any(axis=2), -1, edges))


def top_k(graph: Graph, queries: np.ndarray, k: int, beam: int, own: np.ndarray | None = None, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, similarities) of each query, best first."""
    ids, sims = [], []
    for at in range(0, len(queries), block):
        i, s = graph.search(queries[at : at + block], beam, own=None if own is None else own[at : at + block])
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        ids.append(np.take_along_axis(i, best, 1)), sims.append(np.take_along_axis(s, best, 1))
    return np.concatenate(ids), np.concatenate(sims)


def _matrix(lists: pa.ChunkedArray | pa.Array, width: int, dtype: type) -> np.ndarray:
    whole = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return whole.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))


def assign_shards(vectors: DataFrame, centres: np.ndarray, margin: float, ask: int = 1) -> DataFrame:
    """Add ``near``: the numbers of the centres within ``margin`` of the nearest one's similarity, at least ``ask``, nearest first."""
    ask = min(ask, len(centres))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in _slices(whole.num_rows):
                batch = whole.slice(part.start, part.stop - part.start)
                sims = _matrix(batch.column(1), centres.shape[1], np.float32) @ centres.T
                least = np.minimum(sims.max(axis=1) - margin, np.partition(sims, len(centres) - ask, axis=1)[:, len(centres) - ask])
                row, centre = np.nonzero(sims >= least[:, None])
                order = np.lexsort((centre, -sims[row, centre], row))
                offsets = np.searchsorted(row[order], np.arange(batch.num_rows + 1)).astype(np.int32)
                near = pa.ListArray.from_arrays(pa.array(offsets), pa.array(centre[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), near], names=["key", "vec", "near"])

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(nearest, f"key {kind}, vec array<float>, near array<int>")


def nearest_candidates(
    df: DataFrame, key: str, vector: str, *, k: int = 10, dimension: int = 64, shard_size: int = 8000, ask: int = 1, share: float = 0.98, beam: int = 48, sample_bound: int = 40_000
) -> DataFrame:
    """Rows (key, neighbour, similarity): the k best of each shard that a vector asks, other keys only.

    Every usable vector (see ``unit_vectors``) is in the index of one shard and
    asks the shards of the centres within a margin of its nearest one, at least
    ``ask``; the margin is fitted so that they hold ``share`` of the nearest in
    the sample (``fit_margin``). Similarity is the cosine. The
    centres are fitted on at most ``sample_bound`` vectors, one for about
    ``shard_size`` vectors and at most one for eight of the sample (so their
    number is bounded; a corpus of more than ``sample_bound / 8 * shard_size``
    vectors wants a larger sample). A shard of more than twice that size is salted into
    several, each with a graph of its own that all its askers ask; askers are
    taken in blocks. So no group grows with the data. An empty table, or one
    vector alone, gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    total = df.count()
    sample = hash_sample(df.select(key, vector), [key], sample_bound, total)
    rows = unit_vectors(sample, key, vector, dimension).select("vec").toArrow()
    count = min(max(1, round(total / shard_size)), max(1, rows.num_rows // 8))
    points = _matrix(rows["vec"], dimension, np.float32) if rows.num_rows else np.zeros((1, dimension), np.float32)
    centres = fit_centres(points, count)
    margin = fit_margin(points, centres, k, share)
    placed = materialize(assign_shards(unit_vectors(df, key, vector, dimension), centres, margin, ask), "placed")
    homes = placed.groupBy(F.col("near")[0].alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    # One row a shard: how many parts it has, and in how many blocks its askers come.
    askers = placed.select(F.explode("near").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("asked"))
    shape = homes.join(askers, "shard").select("shard", F.greatest(F.lit(1), F.ceil(F.col("n") / (2 * shard_size))).cast("int").alias("parts"), F.ceil(F.col("asked") / (8 * shard_size)).cast("int").alias("blocks"))
    shape = F.broadcast(materialize(shape, "shape"))  # at most sample_bound / 8 rows
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")
    stored = placed.select("key", "vec", F.col("near")[0].alias("shard")).join(shape, "shard").select("shard", part, "key", "vec", "blocks")

    def build(group: pa.Table) -> pa.Table:
        x = _matrix(group["vec"], dimension, np.float32)
        return group.append_column("edges", _lists(Graph(x).edges)).append_column("node", pa.array(np.arange(len(x), dtype=np.int32)))

    index = stored.groupBy("shard", "part").applyInArrow(build, f"shard int, part int, key {kind}, vec array<float>, blocks int, edges array<int>, node int")
    index = materialize(index, "graph")
    per_block = index.select("shard", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key", "vec", "edges", "node")
    asking = placed.select("key", "vec", F.explode("near").alias("shard")).join(shape, "shard")
    asking = asking.withColumn("block", F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks")).cast("int"))
    asking = asking.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "key", "vec")

    def answer(nodes: pa.Table, queries: pa.Table) -> pa.Table:
        names = pa.schema([("key", queries.schema.field("key").type), ("neighbour", queries.schema.field("key").type), ("similarity", pa.float32())])
        if not nodes.num_rows or not queries.num_rows:
            return names.empty_table()
        nodes = nodes.sort_by("node")
        edges = nodes["edges"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(nodes.num_rows, -1)
        graph = Graph(_matrix(nodes["vec"], dimension, np.float32), edges)
        own = pc.fill_null(pc.index_in(queries["key"], value_set=nodes["key"]), -1).to_numpy()
        ids, sims = top_k(graph, _matrix(queries["vec"], dimension, np.float32), k + 1, max(beam, k + 1), own)
        row = np.repeat(np.arange(queries.num_rows), ids.shape[1])
        flat, value = ids.reshape(-1), sims.reshape(-1)
        row, flat, value = row[flat >= 0], flat[flat >= 0], value[flat >= 0]
        out = pa.table([queries["key"].take(pa.array(row)), nodes["key"].take(pa.array(flat)), pa.array(value)], schema=names)
        return out.filter(pc.not_equal(out["key"], out["neighbour"]))

    return (
        per_block.groupBy("shard", "part", "block")
        .cogroup(asking.groupBy("shard", "part", "block"))
        .applyInArrow(answer, f"key {kind}, neighbour {kind}, similarity float")
    )


def nearest_neighbours(df: DataFrame, key: str, vector: str, k: int = 10, **options) -> DataFrame:
    """Rows (key, place, neighbour, similarity): the k most similar vectors of other keys, best first.

    Approximate: see ``nearest_candidates`` for the cases and options. Ties in
    similarity are broken by the neighbour's key. Fewer than k other vectors
    give fewer rows.
    """
    candidates = nearest_candidates(df, key, vector, k=k, **options)
    entry = F.struct((-F.col("similarity")).alias("far"), "neighbour")
    best = candidates.groupBy("key").agg(F.slice(F.sort_array(F.collect_set(entry)), 1, k).alias("best"))
    rows = best.select("key", F.posexplode("best").alias("place", "hit"))
    return rows.select(F.col("key").alias(key), (F.col("place") + 1).alias("place"), F.col("hit.neighbour").alias("neighbour"), (-F.col("hit.far")).alias("similarity"))


def similar_pairs(df: DataFrame, key: str, vector: str, least: float, **options) -> DataFrame:
    """Rows (key_a, key_b): pairs of keys among each other's nearest whose cosine is at least ``least``, the smaller key first."""
    close = nearest_candidates(df, key, vector, **options).where(F.col("similarity") >= least)
    return close.select(F.least("key", "neighbour").alias("key_a"), F.greatest("key", "neighbour").alias("key_b")).distinct()
