"""Queries on pieces (problem 4), neighbours (5), token ids (6) and containers (7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm.neighbours import nearest_neighbours, similar_pairs
from segloom.llm.packing import CAPACITY, pack_items
from segloom.llm.splitting import split_texts
from segloom.llm.tokenizer import count_tokens, encode_texts
from segloom.session import materialize, table


def p4_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """The pieces of all oversized child and parent texts."""
    child = split_texts(table(spark, directory, "child_chunks"), "chunk_id", "text", 300)
    parent = split_texts(table(spark, directory, "parent_chunks"), "parent_chunk_id", "text", 1000)
    return child.withColumn("level", F.lit("child")).unionByName(parent.withColumn("level", F.lit("parent")))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """The oversized texts: those that have pieces."""
    return p4_pieces(spark, directory).select("item_id").distinct()


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """The pairs of chunks whose embeddings have a cosine of at least 0.95."""
    pairs = similar_pairs(table(spark, directory, "child_chunks"), "chunk_id", "embedding", 0.95)
    return pairs.withColumnsRenamed({"key_a": "chunk_id_a", "key_b": "chunk_id_b"})


def p5_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    """The 10 most similar chunks of every chunk with a usable embedding."""
    return nearest_neighbours(table(spark, directory, "child_chunks"), "chunk_id", "embedding", 10)


def p6_ids(spark: SparkSession, directory: str) -> DataFrame:
    """The token ids of every document."""
    return encode_texts(table(spark, directory, "documents"), "doc_id", "text")


def p7_containers(spark: SparkSession, directory: str) -> DataFrame:
    """Where each document lies in containers of 2,048 tokens."""
    return pack_items(count_tokens(table(spark, directory, "documents"), "doc_id", "text"), "doc_id", "n_tokens")


def p7_fill(spark: SparkSession, directory: str) -> DataFrame:
    """How full the containers are: their number by tenths of the capacity, with the tokens they hold."""
    packed = materialize(p7_containers(spark, directory), "packed").where("container_id is not null")
    sizes = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    tenth = F.least(F.lit(9), F.floor(F.col("used") * 10 / CAPACITY)).cast("int").alias("tenth")
    return sizes.groupBy(tenth).agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.sum("pieces").alias("pieces"), F.max("used").alias("most"))


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p5_found": p5_found, "p5_neighbours": p5_neighbours, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_fill": p7_fill}

_WORDS = "len(list_filter(regexp_split_to_array(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+'), lambda x: x <> ''))"
SQL = {
    "p4_found": f"""
select distinct item_id from (
  select chunk_id as item_id, {_WORDS} as n, 300 as most from child_chunks
  union all
  select parent_chunk_id, {_WORDS}, 1000 from parent_chunks)
where floor(n * 1.3) > most
""",
}
