"""The chunk store: three Parquet tables with insert-if-new, delete with cascade, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.config import StoreConfig
from segloom.operators import search
from segloom.session import file_system, materialize

TABLES = ("videos", "parent_chunks", "child_chunks")
CHILD_COLUMNS = ("chunk_id", "chunk_index", "video_id", "parent_chunk_id", "text", "start_time", "end_time", "token_count", "youtube_link", "context_before", "context_after", "embedding")
PARENT_COLUMNS = ("parent_chunk_id", "parent_index", "video_id", "text", "start_time", "end_time", "token_count")
VIDEO_COLUMNS = ("video_id", "video_title", "total_chunks", "total_parent_chunks", "created_at")


def child_rows(chunks: DataFrame) -> DataFrame:
    """Child chunks as they are stored: an empty parent id becomes null, contexts default to empty, vectors to float; one row a chunk."""
    columns = {
        "parent_chunk_id": F.nullif("parent_chunk_id", F.lit("")),
        "context_before": F.coalesce("context_before", F.lit("")),
        "context_after": F.coalesce("context_after", F.lit("")),
        "embedding": F.col("embedding").cast("array<float>"),
    }
    return chunks.withColumns(columns).select(*CHILD_COLUMNS).dropDuplicates(["chunk_id"])


def new_videos(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """The incoming videos that aren't stored yet, once each."""
    return incoming.where("video_id is not null").dropDuplicates(["video_id"]).join(existing.select("video_id"), "video_id", "left_anti")


def without_videos(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """The rows of any of the three tables that stay when ``deleted`` (video_id) goes, with all that belongs to it."""
    return rows.join(deleted.select("video_id").distinct(), "video_id", "left_anti")


def store_stats(videos: DataFrame, parents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: how many videos, parents, chunks, and chunks with an embedding."""
    one = lambda df, name: df.select(F.lit(name).alias("name"))
    rows = one(videos, "videos").unionByName(one(parents, "parent_chunks"))
    rows = rows.unionByName(chunks.select(F.when(F.col("embedding").isNull(), F.lit("chunk")).otherwise(F.lit("embedded")).alias("name")))
    count = lambda *names: F.count_if(F.col("name").isin(*names))
    return rows.agg(count("videos").alias("videos"), count("parent_chunks").alias("parent_chunks"), count("chunk", "embedded").alias("child_chunks"), count("embedded").alias("chunks_with_embeddings"))


def list_videos(videos: DataFrame) -> DataFrame:
    """All videos, the latest first; those without a date last, ties by id."""
    return videos.select(*VIDEO_COLUMNS).orderBy(F.col("created_at").desc_nulls_last(), "video_id")


#: Each table is parted into so many folders by a hash of the video.
BUCKETS = 64


class Store:
    """A store in a folder. Each table is a Parquet folder, parted by a hash of the video, so that a video's rows lie in one part."""

    def __init__(self, spark: SparkSession, config: StoreConfig) -> None:
        self.spark, self.config = spark, config

    def _path(self, name: str) -> str:
        return f"{self.config.path}/{name}"

    def table(self, name: str) -> DataFrame:
        self._finish_swaps(name)
        columns = {"videos": VIDEO_COLUMNS, "parent_chunks": PARENT_COLUMNS, "child_chunks": CHILD_COLUMNS}[name]
        return self.spark.read.parquet(self._path(name)).select(*columns)

    def exists(self, name: str) -> bool:
        fs, path = file_system(self.spark, f"{self._path(name)}/_SUCCESS")
        return fs.exists(path)

    def ingest(self, videos: DataFrame, parents: DataFrame, chunks: DataFrame) -> dict[str, int]:
        """Append what belongs to new videos; how many were added, and how many were there already (which counts as success).

        The videos table comes last, so a batch that failed is taken again.
        """
        named = videos.where("video_id is not null").dropDuplicates(["video_id"]).select(*VIDEO_COLUMNS)
        new = materialize(new_videos(named, self.table("videos")) if self.exists("videos") else named, "new").select(*VIDEO_COLUMNS)
        keep = lambda df: df.join(new.select("video_id"), "video_id", "left_semi")
        rows = {"parent_chunks": keep(parents).select(*PARENT_COLUMNS), "child_chunks": child_rows(keep(chunks)), "videos": new}
        for name, df in rows.items():
            if name != "videos" and self.exists(name):
                # What an earlier, failed batch left of these videos is not doubled.
                key = "chunk_id" if name == "child_chunks" else "parent_chunk_id"
                df = df.join(self.table(name).select(key), key, "left_anti").select(*df.columns)
            bucket = F.pmod(F.xxhash64("video_id"), F.lit(BUCKETS)).alias("bucket")
            df.select("*", bucket).write.mode("append").partitionBy("bucket").parquet(self._path(name))
        added = new.count()
        return {"added": added, "present": named.count() - added}

    def _finish_swaps(self, name: str) -> None:
        """Finish what a delete that was cut off between its renames left."""
        fs, path = file_system(self.spark, f"{self.config.path}/.old-{name}")
        if not fs.exists(path):
            return
        for old in (s.getPath() for s in fs.listStatus(path)):
            home = file_system(self.spark, f"{self._path(name)}/{old.getName()}")[1]
            staged = file_system(self.spark, f"{self.config.path}/.staged-{name}/{old.getName()}")[1]
            if not fs.exists(home):
                fs.rename(staged if fs.exists(staged) else old, home)
            fs.delete(old, True)

    def delete(self, video_id: str) -> bool:
        """Remove a video and all that belongs to it; whether it was there.

        Of each table only the part that holds the video is written again, and
        put in place by renaming. The videos table comes last, so a delete that
        was cut off is found and done again.
        """
        gone = self.spark.createDataFrame([(video_id,)], "video_id string")
        if not self.table("videos").where(F.col("video_id") == video_id).limit(1).count():
            return False
        bucket = gone.select(F.pmod(F.xxhash64("video_id"), F.lit(BUCKETS))).first()[0]
        for name in ("child_chunks", "parent_chunks", "videos"):
            self._finish_swaps(name)
            part = f"{self._path(name)}/bucket={bucket}"
            fs, home = file_system(self.spark, part)
            if not fs.exists(home):
                continue
            staged, old = (file_system(self.spark, f"{self.config.path}/.{kind}-{name}/bucket={bucket}")[1] for kind in ("staged", "old"))
            without_videos(self.spark.read.parquet(part), gone).write.mode("overwrite").parquet(staged.toString())
            fs.mkdirs(old.getParent())
            fs.rename(home, old)
            fs.rename(staged, home)
            fs.delete(old, True)
        return True

    def search(self, queries: DataFrame, k: int = 10, use_quantized: bool | None = None) -> DataFrame:
        """The k nearest chunks of each query (key, vec), with titles and parent texts."""
        quantised = self.config.use_quantized if use_quantized is None else use_quantized
        chunks = self.table("child_chunks")
        corpus = search.usable_vectors(chunks, "chunk_id", "embedding", self.config.dimension)
        hits = search.nearest(corpus, queries, k, self.config.dimension, quantised=quantised)
        return search.with_context(hits, chunks, self.table("videos"), self.table("parent_chunks"))

    def stats(self) -> DataFrame:
        return store_stats(*(self.table(n) for n in TABLES))

    def list_videos(self) -> DataFrame:
        return list_videos(self.table("videos"))
