"""Packing of items into containers of fixed capacity.

The lengths of all items make a histogram that is no longer than the capacity.
Dynamic programming cuts it into length buckets with the least padding; a plan
of batches is made from the counts of the buckets alone; each item finds its
batch from its place within its bucket. Neither items nor keys pass through
the driver, only the histogram.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.session import materialize

CAPACITY = 2048


def bucket_edges(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """The upper edges of at most ``buckets`` length buckets with the least padding, by dynamic programming.

    An item is padded to the edge of its bucket. Edges are lengths that occur.
    """
    order = np.argsort(lengths)
    x, c = lengths[order].astype(float), counts[order].astype(float)
    n = len(x)
    buckets = min(buckets, n)
    items, tokens = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])
    # padding[i, j]: of the lengths i..j in one bucket with the edge x[j]
    padding = x[None, :] * (items[1:][None, :] - items[:-1][:, None]) - (tokens[1:][None, :] - tokens[:-1][:, None])
    padding[np.tril_indices(n, -1)] = np.inf
    best = padding[0].copy()
    choice = np.zeros((buckets, n), np.int32)
    for k in range(1, buckets):
        total = padding.copy()
        total[1:] += best[:-1, None]
        total[0] = np.inf
        choice[k] = np.argmin(total, axis=0)
        best = np.minimum(total[choice[k], np.arange(n)], np.inf)
    edges, j = [], n - 1
    for k in range(buckets - 1, -1, -1):
        edges.append(int(x[j]))
        j = int(choice[k, j]) - 1
        if j < 0:
            break
    return np.array(edges[::-1], np.int64)


def plan_batches(edges: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (edge, first place, places, per container, first container) that place every item of every bucket.

    The longest bucket with items left opens a container; the longest bucket
    that still fits in the token budget tops it up, until nothing fits. The same
    filling is repeated as long as the counts allow, so there are few fillings.
    """
    left = {int(e): int(c) for e, c in zip(edges, counts) if c}
    used = dict.fromkeys(left, 0)
    rows, container = [], 0
    while left:
        budget, filling = capacity, {}
        for e in sorted(left, reverse=True):
            n = min(budget // e, left[e])
            if n:
                filling[e] = n
                budget -= n * e
        times = min(left[e] // n for e, n in filling.items())
        for e, n in filling.items():
            rows.append((e, used[e], n * times, n, container))
            used[e] += n * times
            left[e] -= n * times
            if not left[e]:
                del left[e]
        container += times
    return rows


def pack_items(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, buckets: int = 128, part: int = 200_000) -> DataFrame:
    """Rows (container_id, key, piece_no, first_token, n_tokens): where each item, or piece of an item, lies.

    An item longer than ``capacity`` is divided into pieces of the capacity and
    a rest; no other item is divided. The sizes in a container add up to no
    more than the capacity. An item of size null or 0 has one row without a
    container. A bucket is counted in as many parts as hold ``part`` items each.
    Repeated rows are items of their own; an empty table gives no
    rows; further columns are ignored. ``items`` is read once and written.
    """
    spark = items.sparkSession
    rows = items.select(F.col(key).alias("key"), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("size"))
    rows = materialize(rows, "sizes")
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / capacity) - 1).cast("int")
    pieces = rows.select("key", "size", F.explode(F.sequence(F.lit(0), last)).alias("piece_no"))
    pieces = pieces.select("key", "piece_no", (F.col("piece_no") * capacity).alias("first_token"), F.least(F.lit(capacity), F.col("size") - F.col("piece_no") * capacity).alias("n"))
    # The histogram has at most as many rows as the capacity.
    histogram = pieces.where("n > 0").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()
    empty = pieces.where("n <= 0").select(F.lit(None).cast("bigint").alias("container_id"), F.col("key").alias(key), "piece_no", "first_token", F.lit(0).alias("n_tokens"))
    if not histogram:
        return empty
    lengths, counts = np.array([r.n for r in histogram]), np.array([r.c for r in histogram])
    edges = bucket_edges(lengths, counts, buckets)
    in_bucket = np.bincount(np.searchsorted(edges, lengths), weights=counts, minlength=len(edges)).astype(np.int64)
    plan = plan_batches(edges, in_bucket, capacity)
    # Edges and plan are bounded by the number of buckets, whatever the items.
    salts = dict(zip(edges.tolist(), (-(-in_bucket // part)).tolist()))
    edge_of = [(int(n), int(edges[np.searchsorted(edges, n)])) for n in lengths]
    edge_of = spark.createDataFrame([(n, e, salts[e]) for n, e in edge_of], "n int, edge int, salts bigint")
    plan_rows = spark.createDataFrame(plan, "edge int, first bigint, places bigint, per bigint, container bigint")
    placed = pieces.join(F.broadcast(edge_of), "n").withColumn("salt", F.pmod(F.xxhash64("key", "piece_no"), F.col("salts")))
    # The place within a bucket: a bucket may hold a third of all items, so it is counted in salted parts.
    along = Window.partitionBy("edge").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("edge", "salt").agg(F.count(F.lit(1)).alias("c")).select("edge", "salt", F.coalesce(F.sum("c").over(along), F.lit(0)).alias("start"))
    inside = Window.partitionBy("edge", "salt").orderBy("key", "piece_no")
    numbered = placed.withColumn("row", F.row_number().over(inside)).join(starts, ["edge", "salt"])
    numbered = numbered.withColumn("place", F.col("start") + F.col("row") - 1)
    at = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("places"))
    found = numbered.alias("i").join(F.broadcast(plan_rows).alias("p"), (F.col("i.edge") == F.col("p.edge")) & at)
    container = F.col("container") + F.floor((F.col("place") - F.col("first")) / F.col("per"))
    full = found.select(container.alias("container_id"), F.col("key").alias(key), "piece_no", "first_token", F.col("n").alias("n_tokens"))
    return full.unionByName(empty)
