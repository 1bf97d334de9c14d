"""Queries on texts that lost their end (problem 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segloom.llm.truncation import hidden_limits, judge_endings, truncated, truncation_rates
from segloom.session import table


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    """The documents whose text breaks off."""
    return truncated(table(spark, directory, "documents")).where("truncated").select("doc_id").distinct()


def p8_rates(spark: SparkSession, directory: str) -> DataFrame:
    """How often each source truncates."""
    return truncation_rates(truncated(table(spark, directory, "documents")))


def p8_limits(spark: SparkSession, directory: str) -> DataFrame:
    """The hidden storage limits of the sources, with how much more often texts lack a closing mark there."""
    return hidden_limits(judge_endings(table(spark, directory, "documents"))[0]).drop("e")


QUERIES = {"p8_found": p8_found, "p8_rates": p8_rates, "p8_limits": p8_limits}
SQL: dict[str, str] = {}
