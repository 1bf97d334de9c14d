"""Two-level chunks of transcripts: boundaries, child chunks, parents, overlap, roll-ups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import ChunkConfig
from segloom.functions import text as tx
from segloom.functions import vectors as vx
from segloom.operators.fold import Rule, greedy_groups
from segloom.operators.ordered import dense_position
from segloom.session import materialize


def child_rule(c: ChunkConfig) -> Rule:
    """A child ends before a row that would exceed its maximum, unless the row continues it, or at a boundary past the target."""

    def rule(total: np.ndarray, count: np.ndarray, weight: np.ndarray, boundary: np.ndarray, continues: np.ndarray) -> np.ndarray:
        over = (total + weight > c.child_max) & (total >= c.child_min)
        held = continues & (total + weight <= c.child_hard_max)
        return np.where(over, ~held, (total >= c.child_target) & boundary)

    return rule


def parent_rule(c: ChunkConfig) -> Rule:
    """A parent ends before a child that would exceed its maximum, or past the target once it has two children."""

    def rule(total: np.ndarray, count: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (total + weight > c.parent_max) & (total >= c.parent_min) | (total >= c.parent_target) & (count >= 2)

    return rule


def previous_in_blocks(df: DataFrame, key: str, pos: str, columns: list[str], block: int = 8192) -> DataFrame:
    """Add ``prev_<column>``: the value at the place before, without one task for a whole key.

    The last row of each block is also handed to the next block.
    """
    at = F.floor(F.col(pos) / block)
    window = Window.partitionBy(key, "__block").orderBy(pos)
    handed = F.when(F.col(pos) % block == block - 1, F.array(at, at + 1)).otherwise(F.array(at))
    spread = df.select("*", F.explode(handed).alias("__block"), at.alias("__own"))
    with_prev = spread.withColumns({f"prev_{c}": F.lag(c).over(window) for c in columns})
    return with_prev.where("__block = __own").drop("__block", "__own")


def positioned_segments(segments: DataFrame) -> DataFrame:
    """Scanned segments with seconds, tokens, ``continues`` and ``pos``, their dense place in the video.

    Rows are the non-blank segments of ``scan_segments``; unreadable times are
    0. They are written before they are placed, so that no pattern is evaluated
    twice.
    """
    seconds = lambda c: F.coalesce(F.col(c) / 1000.0, F.lit(0.0))
    made = {"start": seconds("start_ms"), "end": seconds("end_ms"), "tokens": tx.token_count(F.col("text")), "continues": tx.is_continuation(F.col("text"))}
    return dense_position(materialize(segments.withColumns(made), "scanned"), "video_id", "seg_index", "pos")


def pause_boundaries(positioned: DataFrame, pause: float = 3.0) -> DataFrame:
    """Add ``boundary``: the row starts more than ``pause`` seconds after the one before it ended; false at the first row."""
    rows = previous_in_blocks(positioned, "video_id", "pos", ["end"])
    return rows.withColumn("boundary", F.coalesce(F.round(F.col("start") - F.col("prev_end"), 3) > pause, F.lit(False))).drop("prev_end")


def semantic_boundaries(rows: DataFrame, key: str, pos: str, vector: str, threshold: float = 0.5) -> DataFrame:
    """Add ``similarity`` to the row before and ``boundary``: to 6 decimals it is below ``threshold``.

    A missing or zero vector has similarity 0; the first row is no boundary.
    """
    held = previous_in_blocks(rows, key, pos, [vector, pos])
    similarity = F.coalesce(F.when(F.size(vector) == F.size(f"prev_{vector}"), vx.cosine(F.col(vector), F.col(f"prev_{vector}"))), F.lit(0.0))
    similarity = F.when(F.isnan(similarity), F.lit(0.0)).otherwise(similarity)
    first = F.col(f"prev_{pos}").isNull()
    return held.withColumn("similarity", F.when(~first, similarity)).withColumn("boundary", ~first & (F.round(similarity, 6) < threshold)).drop(f"prev_{vector}", f"prev_{pos}")


def detect_boundaries(positioned: DataFrame, embedded: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Add ``boundary``: a topic change or a pause before the row.

    ``embedded`` has the rows' embeddings (video_id, pos, embedding); a row
    without one counts as a change of topic, as one with a zero vector does.
    """
    paused = pause_boundaries(positioned, config.pause_seconds).withColumnRenamed("boundary", "paused")
    held = semantic_boundaries(paused.join(embedded, ["video_id", "pos"], "left"), "video_id", "pos", "embedding", config.similarity_threshold)
    return held.withColumn("boundary", F.col("boundary") | F.col("paused")).drop("embedding", "similarity", "paused")


def child_assignment(bounded: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Rows (video_id, pos, chunk_index): the child chunk of each segment.

    Input: video_id, pos, tokens, continues, boundary. Each segment is in exactly one chunk, in order.
    """
    rows = bounded.select("video_id", "pos", F.col("tokens").alias("weight"), F.col("boundary").alias("a"), F.col("continues").alias("b"))
    groups = greedy_groups(rows, "video_id", child_rule(config), least=config.child_min, heaviest=max(config.child_min, config.child_max, config.child_hard_max))
    return groups.withColumnRenamed("group", "chunk_index")


def _ordered_text(pos: str, text: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(pos, text)))
    return F.array_join(F.transform(pieces, lambda p: p[text]), " ")


def child_chunks(bounded: DataFrame, assignment: DataFrame) -> DataFrame:
    """The child chunks: chunk_id, chunk_index, video_id, text, start_time, end_time, token_count, youtube_link.

    A chunk has a few hundred segments at most, so its text is put together in a group of its own.
    """
    joined = bounded.join(assignment, ["video_id", "pos"])
    chunks = joined.groupBy("video_id", "chunk_index").agg(
        _ordered_text("pos", "text").alias("text"), F.min_by("start", "pos").alias("start_time"), F.max_by("end", "pos").alias("end_time")
    )
    return chunks.select(
        tx.numbered_id(F.col("video_id"), "_", F.col("chunk_index")).alias("chunk_id"),
        "chunk_index",
        "video_id",
        "text",
        "start_time",
        "end_time",
        tx.token_count(F.col("text")).alias("token_count"),
        tx.deep_link(F.col("video_id"), F.col("start_time")).alias("youtube_link"),
    )


def overlap_context(chunks: DataFrame, n_tokens: int = 50) -> DataFrame:
    """Add ``context_before`` and ``context_after``: the neighbours' last and first words, empty at the ends.

    Neighbours are found by joining on the index next to one's own, which no large video turns into one task.
    """
    before = chunks.select("video_id", (F.col("chunk_index") + 1).alias("chunk_index"), tx.last_tokens(F.col("text"), n_tokens).alias("context_before"))
    after = chunks.select("video_id", (F.col("chunk_index") - 1).alias("chunk_index"), tx.first_tokens(F.col("text"), n_tokens).alias("context_after"))
    joined = chunks.join(before, ["video_id", "chunk_index"], "left").join(after, ["video_id", "chunk_index"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("context_before", "context_after")})


def parent_assignment(chunks: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Rows (video_id, chunk_index, parent_index): the parent of each child."""
    rows = chunks.select("video_id", F.col("chunk_index").alias("pos"), F.col("token_count").alias("weight"), F.lit(False).alias("a"), F.lit(False).alias("b"))
    groups = greedy_groups(rows, "video_id", parent_rule(config), least=config.parent_min, heaviest=max(config.parent_min, config.parent_max))
    return groups.select("video_id", F.col("pos").cast("int").alias("chunk_index"), F.col("group").alias("parent_index"))


def parent_chunks(chunks: DataFrame, assignment: DataFrame) -> DataFrame:
    """The parents: parent_chunk_id, parent_index, video_id, text, start_time, end_time, token_count, child_chunk_ids."""
    joined = chunks.join(assignment, ["video_id", "chunk_index"])
    ids = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda p: p["chunk_id"])
    parents = joined.groupBy("video_id", "parent_index").agg(
        _ordered_text("chunk_index", "text").alias("text"),
        F.min_by("start_time", "chunk_index").alias("start_time"),
        F.max_by("end_time", "chunk_index").alias("end_time"),
        ids.alias("child_chunk_ids"),
    )
    return parents.select(
        tx.numbered_id(F.col("video_id"), "_P", F.col("parent_index")).alias("parent_chunk_id"),
        "parent_index",
        "video_id",
        "text",
        "start_time",
        "end_time",
        tx.token_count(F.col("text")).alias("token_count"),
        "child_chunk_ids",
    )


def token_stats(chunks: DataFrame) -> DataFrame:
    """Per video: number of chunks, mean, least and most tokens."""
    return chunks.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.round(F.avg("token_count"), 6).alias("avg_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens")
    )


def video_rollup(videos: DataFrame, chunks: DataFrame, parents: DataFrame) -> DataFrame:
    """Per video its counted chunks and parents, 0 where it has none."""
    count = lambda df, name: df.groupBy("video_id").agg(F.count(F.lit(1)).alias(name))
    joined = videos.select("video_id", "video_title").join(count(chunks, "chunks"), "video_id", "left").join(count(parents, "parent_chunks"), "video_id", "left")
    return joined.fillna(0, ["chunks", "parent_chunks"])
