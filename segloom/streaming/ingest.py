"""Transcript files and segments as streams.

Each run takes what has arrived since the last one and stops; the checkpoint
is the record of what has been done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.operators.segments import scan_segments
from segloom.sources.transcripts import TRANSCRIPT

SEGMENTS = "segment_id bigint, video_id string, seg_index int, start_time string, end_time string, speaker string, language string, content string, seg_start double, received_at timestamp"


def transcript_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """New transcript files of a folder, one row a segment; the file's name is its origin."""
    files = (
        spark.readStream.schema(TRANSCRIPT).option("multiLine", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_batch).json(path)
    ).withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    rows = files.where(~F.col("stem").endswith("_chunks") & (F.col("stem") != "manifest"))
    return rows.select(tx.stem_id(F.col("stem")).alias("video_id"), F.posexplode("segments").alias("seg_index", "s")).select("video_id", "seg_index", "s.*")


def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all that is there by now to the Parquet folder ``target``, each input once."""
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def segment_stream(spark: SparkSession, path: str, late: str = "14 days") -> DataFrame:
    """New segment files as scanned segments, each delivered segment once within ``late`` of its first delivery."""
    raw = spark.readStream.schema(SEGMENTS).parquet(path).withWatermark("received_at", late)
    return scan_segments(raw.dropDuplicatesWithinWatermark(["segment_id"]))
