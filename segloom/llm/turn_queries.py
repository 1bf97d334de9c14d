"""Queries on speaker turns (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segloom.llm.turns import clean_turns, turn_starts
from segloom.session import table


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """One row a true turn."""
    found = turn_starts(table(spark, directory, "transcript_segments"), table(spark, directory, "video_speakers"))
    return found.select("video_id", "first_segment_id", "speaker_no")


def p1_turns(spark: SparkSession, directory: str) -> DataFrame:
    """The clean texts of all segments with speech, with their turns."""
    return clean_turns(table(spark, directory, "transcript_segments"), table(spark, directory, "video_speakers"))


QUERIES = {"p1_found": p1_found, "p1_turns": p1_turns}
SQL: dict[str, str] = {}
