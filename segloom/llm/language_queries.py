"""Queries on languages (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm.language import Languages, mislabelled, passage_languages, record_languages, sample_languages
from segloom.session import table


def _records(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, Languages]:
    segments = table(spark, directory, "transcript_segments").select(F.col("segment_id").alias("id"), F.col("language").alias("label"), F.col("content").alias("text"))
    documents = table(spark, directory, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    return segments, documents, sample_languages(table(spark, directory, "lang_samples"), segments)


def _both(f, spark: SparkSession, directory: str) -> DataFrame:
    segments, documents, languages = _records(spark, directory)
    kind = lambda df, name: df.select(F.lit(name).alias("record_kind"), F.col("id").alias("record_id"), *[c for c in df.columns if c != "id"])
    return kind(f(segments, languages), "segment").unionByName(kind(f(documents, languages), "document"))


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """The records whose label is missing or wrong, or whose text holds two languages."""
    return _both(mislabelled, spark, directory)


def p2_languages(spark: SparkSession, directory: str) -> DataFrame:
    """The language of every record, with its confidence."""
    return _both(lambda r, l: record_languages(r, l).drop("label").distinct(), spark, directory)


def p2_passages(spark: SparkSession, directory: str) -> DataFrame:
    """The passages of every record, each with a language and a confidence."""
    return _both(lambda r, l: passage_languages(r, l).drop("label").distinct(), spark, directory)


QUERIES = {"p2_found": p2_found, "p2_languages": p2_languages, "p2_passages": p2_passages}
SQL: dict[str, str] = {}
