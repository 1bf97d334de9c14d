"""Services outside the cluster (embedding, transcription) behind small interfaces.

A client is made once a task from a factory, takes texts (or files) in batches
and is retried while it says that it is busy. The default embedding needs no
network: words hashed into a vector.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.functions import text as tx


class Busy(Exception):
    """The service asks to wait."""


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


class Transcriber(Protocol):
    def transcribe(self, path: str) -> tuple[str, int, int]:
        """(JSON of the transcript, input tokens, output tokens)"""


def patiently(call: Callable[[], object], tries: int = 3, wait: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """``call()``, again after a wait that doubles, while it raises ``Busy``; the last one is passed on after its wait."""
    for n in range(tries):
        try:
            return call()
        except Busy:
            sleep(wait * 2**n)
            if n == tries - 1:
                raise
    raise ValueError("tries must be at least 1")


def embed_texts(df: DataFrame, key: str, text: str, factory: Callable[[], Embedder], batch: int = 100) -> DataFrame:
    """Rows (key, embedding) from a client; a null text is embedded as an empty one. No row leaves its partition."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                client = client or factory()
                part = whole.slice(at, batch)
                texts = [t or "" for t in part.column(1).to_pylist()]
                vectors = np.asarray(patiently(lambda: client.embed(texts)), np.float32)  # noqa: B023
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(vectors), pa.list_(pa.float32()))], names=["key", "embedding"])

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, embedding array<float>")
    return out.withColumnRenamed("key", key)


def transcribe_files(files: DataFrame, factory: Callable[[], Transcriber]) -> DataFrame:
    """Rows (path, transcript, input_tokens, output_tokens, error) of audio files (path); a file that fails is a row with its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                client = client or factory()
                try:
                    rows.append((path, *patiently(lambda: client.transcribe(path)), None))  # noqa: B023
                except Exception as error:  # noqa: BLE001
                    rows.append((path, None, 0, 0, str(error)))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["path", "transcript", "input_tokens", "output_tokens", "error"])

    return files.select("path").mapInArrow(run, "path string, transcript string, input_tokens bigint, output_tokens bigint, error string")


def hash_embeddings(df: DataFrame, key: str, text: str, dimension: int = 64) -> DataFrame:
    """Rows (key, embedding): words hashed into a vector of length 1; a text without words has all zeros."""
    terms = df.select(F.col(key).alias(key), tx.hashed_words(F.col(text), dimension).alias("w"))
    counts = F.aggregate(F.col("w"), F.array_repeat(F.lit(0), dimension), lambda acc, w: F.transform(acc, lambda x, i: F.when(i == w["bucket"], x + w["sign"]).otherwise(x)))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    rows = terms.withColumn("v", counts).withColumn("n", length)
    return rows.select(key, F.transform("v", lambda x: F.when(F.col("n") > 0, x / F.col("n")).otherwise(F.lit(0.0)).cast("float")).alias("embedding"))
