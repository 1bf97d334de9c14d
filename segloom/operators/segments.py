"""Transcript segments: reading, cleaning, ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.functions import timecode as tc


def start_ms(start_time: str = "start_time", seg_start: str = "seg_start") -> Column:
    """A segment's start in ms: its time code, or the loader's seconds where the code can't be read."""
    seconds = F.col(seg_start)
    usable = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < 9e15)
    return F.coalesce(tc.parse_ms(F.col(start_time)), F.when(usable, F.round(seconds * 1000).cast("bigint")))


def timed_segments(segments: DataFrame) -> DataFrame:
    """Rows (video_id, start_ms, end_ms); a time that can't be read is null.

    The interval operators leave out what has no start, no end, or no length;
    a filter here would read each time twice.
    """
    return segments.select("video_id", start_ms().alias("start_ms"), tc.parse_ms(F.col("end_time")).alias("end_ms"))


def deliver_once(segments: DataFrame, key: str = "segment_id") -> DataFrame:
    """One row a key; deliveries of a segment are alike but for the time they came. Rows with a null key are kept."""
    # A row without a key gets a number of its own, so that one pass serves both.
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return segments.withColumn("__own", own).dropDuplicates([key, "__own"]).drop("__own")


def scan_segments(segments: DataFrame) -> DataFrame:
    """Stripped, non-blank segments with their parsed seconds; nulls become the empty defaults."""
    cleaned = segments.select(
        "segment_id",
        "video_id",
        "seg_index",
        tx.strip(F.coalesce("content", F.lit(""))).alias("text"),
        tc.parse_ms(F.col("start_time")).alias("start_ms"),
        tc.parse_ms(F.col("end_time")).alias("end_ms"),
        F.coalesce("speaker", F.lit("")).alias("speaker"),
        F.coalesce("language", F.lit("")).alias("language"),
    )
    return cleaned.where("text <> ''")
