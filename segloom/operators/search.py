"""Exact and quantised nearest-neighbour search for a set of queries, joined to what the hits belong to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.functions import timecode as tc
from segloom.functions import vectors as vx


def usable_vectors(df: DataFrame, key: str, vector: str, dimension: int) -> DataFrame:
    """Rows (key, vec) of the usable vectors: of ``dimension`` finite numbers that aren't all zero; null keys are left out."""
    return df.where(F.col(key).isNotNull() & vx.usable(F.col(vector), dimension)).select(F.col(key).alias("key"), F.col(vector).alias("vec"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    return x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow


def _codes(column: pa.Array, dimension: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    return np.floor(x * 127.0 / np.abs(x).max(axis=1, keepdims=True) + 0.5)


#: Decimals of a distance by which hits are ranked; beyond them two ways of adding up the same numbers differ.
PLACES = 12


class _Best:
    """The k nearest keys of each query so far, by distance and then key, whatever the order in which rows come."""

    def __init__(self, names: pa.Array, codes: np.ndarray, k: int, keys: pa.DataType) -> None:
        self.names, self.codes, self.k = names, codes, k
        self.unit = codes / np.linalg.norm(codes, axis=1, keepdims=True)
        self.edge = np.full(len(codes), np.inf)
        self.schema = pa.schema([("q", pa.int64()), ("distance", pa.float64()), ("key", keys)])
        self.held, self.fresh, self.waiting = self.schema.empty_table(), [], 0

    def add(self, keys: pa.Array, codes: np.ndarray, tile: int = 1024) -> None:
        x = codes / np.linalg.norm(codes, axis=1, keepdims=True)
        for at in range(0, len(self.unit), tile):
            far = 1.0 - self.unit[at : at + tile] @ x.T
            n = min(self.k, len(x))
            edge = np.minimum(np.partition(far, n - 1, axis=1)[:, n - 1], self.edge[at : at + tile]) if n == self.k else self.edge[at : at + tile]
            row, col = np.nonzero(far <= edge[:, None] + 1e-9)
            # Row by row, so that the sum doesn't depend on which rows came together.
            distance = np.round(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", self.unit[at + row], x[col])), PLACES)
            self.fresh.append(pa.table([pa.array(at + row), pa.array(distance), keys.take(pa.array(col))], schema=self.schema))
            self.waiting += len(row)
        if self.waiting > max(200_000, 4 * self.k * len(self.unit)):
            self.settle()

    def settle(self) -> None:
        ranked = pa.concat_tables([self.held, *self.fresh]).sort_by([("q", "ascending"), ("distance", "ascending"), ("key", "ascending")])
        q = ranked["q"].to_numpy()
        place = np.arange(len(q)) - np.searchsorted(q, q)
        self.held, self.fresh, self.waiting = ranked.filter(pa.array(place < self.k)), [], 0
        last = ranked.filter(pa.array(place == self.k - 1))
        self.edge[last["q"].to_numpy()] = last["distance"].to_numpy()

    def hits(self) -> pa.RecordBatch:
        self.settle()
        t = self.held
        columns = [self.names.take(t["q"]), t["key"], t["distance"]]
        flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(flat, names=["query", "key", "distance"])


def nearest(corpus: DataFrame, queries: DataFrame, k: int, dimension: int, *, quantised: bool = False, block: int = 20_000, part_size: int = 200_000) -> DataFrame:
    """Rows (query, key, distance, place): the k nearest rows of ``corpus`` for each query, by cosine distance.

    Both sides are rows (key, vec) of usable vectors. The queries are a stated
    set. Up to ``block`` of them go with each task; each task holds the k best
    of all its rows and passes those on, so what is shuffled is queries times
    tasks times k. More queries come in blocks, the corpus in parts of about
    ``part_size`` rows, and each part meets each block once. Hits are ranked by
    the distance to 12 decimals and then by key, whatever the partitions; the
    result has 6. ``quantised`` computes with whole numbers of 8 bits. An empty
    side gives no rows; repeated keys are rows of their own.
    """
    kind, query_kind = corpus.schema["key"].dataType.simpleString(), queries.schema["key"].dataType.simpleString()
    spark = corpus.sparkSession
    prepare = _codes if quantised else _matrix
    blocks = max(1, -(-queries.count() // block))
    schema = f"query {query_kind}, key {kind}, distance double"
    if blocks == 1:
        few = queries.limit(block).toArrow().combine_chunks()
        if not few.num_rows:
            return spark.createDataFrame([], f"query {query_kind}, key {kind}, distance double, place int")
        names, q = few["key"].combine_chunks(), prepare(few["vec"].combine_chunks(), dimension)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                best = best or _Best(names, q, k, batch.schema.field(0).type)
                for at in range(0, batch.num_rows, 2048):
                    part = batch.slice(at, 2048)
                    best.add(part.column(0), prepare(part.column(1), dimension))
            if best:
                yield best.hits()

        found = corpus.mapInArrow(scan, schema)
    else:
        parts = max(1, -(-corpus.count() // part_size))
        spread = corpus.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "part", "key", "vec")
        asked = queries.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"), F.col("key").alias("query"), F.col("vec").alias("qvec"))
        asked = asked.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "query", "qvec")

        def meet(rows: pa.Table, asking: pa.Table) -> pa.Table:
            if not rows.num_rows or not asking.num_rows:
                return pa.table({"query": pa.array([], asking.schema.field("query").type), "key": pa.array([], rows.schema.field("key").type), "distance": pa.array([], pa.float64())})
            asking = asking.combine_chunks()
            best = _Best(asking["query"].combine_chunks(), prepare(asking["qvec"].combine_chunks(), dimension), k, rows.schema.field("key").type)
            for at in range(0, rows.num_rows, 2048):
                part = rows.slice(at, 2048).combine_chunks()
                best.add(part["key"].combine_chunks(), prepare(part["vec"].combine_chunks(), dimension))
            return pa.Table.from_batches([best.hits()])

        found = spread.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(meet, schema)
    order = Window.partitionBy("query").orderBy("distance", "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).withColumn("distance", F.round("distance", 6))


def with_context(hits: DataFrame, chunks: DataFrame, videos: DataFrame, parents: DataFrame) -> DataFrame:
    """Hits (query, key, distance, place) with their chunk, its video's title and the parent's text, else the chunk's own.

    A hit whose video is unknown is dropped, as the inner join says; one without
    a parent, or whose parent's text is empty, keeps its own text.
    """
    columns = ["chunk_id", "video_id", "parent_chunk_id", "text", "start_time", "end_time", "youtube_link"]
    own = chunks.select(*columns).dropDuplicates(["chunk_id"])
    texts = parents.select("parent_chunk_id", F.col("text").alias("parent_text")).dropDuplicates(["parent_chunk_id"])
    joined = hits.join(own, hits["key"] == own["chunk_id"]).join(videos.select("video_id", "video_title").dropDuplicates(["video_id"]), "video_id")
    joined = joined.join(texts, "parent_chunk_id", "left")
    return joined.select(
        "query",
        "place",
        "distance",
        "chunk_id",
        "video_id",
        "video_title",
        "start_time",
        "end_time",
        "youtube_link",
        F.coalesce("parent_chunk_id", F.lit("")).alias("parent_chunk_id"),
        F.coalesce(F.nullif("parent_text", F.lit("")), "text", F.lit("")).alias("context"),
    )


def rendered(hits: DataFrame, width: int = 200) -> DataFrame:
    """Hits of ``with_context`` as lines: query, place, header, snippet."""
    text = F.col("context")
    header = F.format_string("[%.3f] %s (%s - %s)", F.col("distance"), F.col("video_title"), tc.minutes_seconds(F.col("start_time")), tc.minutes_seconds(F.col("end_time")))
    snippet = F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)
    return hits.select("query", "place", header.alias("header"), snippet.alias("snippet"))


def hit_rates(hits: DataFrame, labels: DataFrame, query_labels: DataFrame) -> DataFrame:
    """One row: queries, share whose first hit and share of whose three first hits have the query's label, mean, least and most best distance.

    ``labels`` has (key, label), ``query_labels`` (query, query_label).
    """
    joined = hits.join(labels, "key").join(query_labels, "query").withColumn("same", F.col("label") == F.col("query_label"))
    per_query = joined.groupBy("query").agg(
        F.max(F.when(F.col("place") == 1, F.col("same").cast("int"))).alias("top1"),
        F.min(F.when(F.col("place") <= 3, F.col("same").cast("int"))).alias("top3"),
        F.min("distance").alias("best"),
    )
    return per_query.agg(
        F.count(F.lit(1)).alias("queries"),
        F.round(F.avg("top1"), 6).alias("top1_rate"),
        F.round(F.avg("top3"), 6).alias("top3_rate"),
        F.round(F.avg("best"), 6).alias("avg_best"),
        F.min("best").alias("min_best"),
        F.max("best").alias("max_best"),
    )
