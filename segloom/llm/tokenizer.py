"""Byte-level BPE with a two-tier lookup.

Most pre-tokens of a text are whole entries of the vocabulary. A minimal
perfect hash finds those; the others are merged byte by byte with a heap over a
linked list. The vocabulary is public data; the driver sends its file along with
the job.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how byte-level BPE of this vocabulary parts a text before it merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary of lines ``base64 rank``."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}


def _mixed(words: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """64-bit hashes of 64-bit words under seeds."""
    with np.errstate(over="ignore"):
        x = words ^ (np.uint64(0x9E3779B97F4A7C15) * (np.asarray(seed).astype(np.uint64) + np.uint64(1)))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _fingerprints(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit number of each byte string."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), np.uint64, len(tokens))


class PerfectHash:
    """A minimal perfect hash of byte strings: hash, displace, compare.

    Keys fall into buckets of about four; the largest buckets first look for a
    displacement that sends their keys to free slots. There are as many slots
    as keys. A string that is no key also gets a slot, so the key there is compared.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.keys = list(ranks)
        n = self.size = len(self.keys)
        prints = _fingerprints(self.keys)
        self.buckets = max(1, n // 4)
        bucket = (_mixed(prints, 0) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(counts)
        taken = np.zeros(n, bool)
        self.shift = np.zeros(self.buckets, np.int64)
        slot_of = np.empty(n, np.int64)
        for b in np.argsort(-counts, kind="stable"):
            members = order[ends[b] - counts[b] : ends[b]]
            if not len(members):
                break
            first = 1
            while True:
                tries = np.arange(first, first + 64)
                slots = (_mixed(prints[members][None, :], tries[:, None]) % np.uint64(n)).astype(np.int64)
                free = ~taken[slots].any(axis=1)
                if len(members) > 1:
                    ordered = np.sort(slots, axis=1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if free.any():
                    k = int(np.argmax(free))
                    self.shift[b], slot_of[members] = tries[k], slots[k]
                    taken[slots[k]] = True
                    break
                first += 64
        self.slot_keys = np.empty(n, object)
        self.slot_ranks = np.empty(n, np.int64)
        self.slot_keys[slot_of] = self.keys
        self.slot_ranks[slot_of] = [ranks[k] for k in self.keys]

    def find(self, tokens: list[bytes]) -> np.ndarray:
        """The rank of each byte string, or -1."""
        if not tokens:
            return np.empty(0, np.int64)
        prints = _fingerprints(tokens)
        bucket = (_mixed(prints, 0) % np.uint64(self.buckets)).astype(np.int64)
        slot = (_mixed(prints, self.shift[bucket]) % np.uint64(self.size)).astype(np.int64)
        held = self.slot_keys[slot]
        hit = np.fromiter((a == b for a, b in zip(held, tokens)), bool, len(tokens))
        return np.where(hit, self.slot_ranks[slot], -1)


def merge_bytes(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: the lowest ranked pair first, the leftmost among equals."""
    n = len(token)
    end = list(range(1, n + 1))  # of the part that begins here
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < n and (rank := ranks.get(token[left : end[right]])) is not None:
            heapq.heappush(heap, (rank, left, right, end[right]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, left, right, stop = heapq.heappop(heap)
        if not alive[left] or after[left] != right or right >= n or not alive[right] or end[right] != stop:
            continue
        end[left], after[left], alive[right] = stop, after[right], False
        if after[left] < n:
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [ranks[token[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts; what it has worked out of a pre-token it keeps, up to a bound."""

    def __init__(self, path: str, keep: int = 200_000) -> None:
        self.ranks = load_ranks(path)
        self.whole = PerfectHash(self.ranks)
        self.part = regex.compile(PATTERN)
        self.kept: dict[str, tuple[int, ...]] = {}
        self.keep = keep

    def learn(self, tokens: Iterable[str]) -> None:
        new = [t for t in set(tokens) if t not in self.kept]
        if len(self.kept) + len(new) > self.keep:
            self.kept.clear()
            new = list(set(tokens))
        as_bytes = [t.encode("utf-8", "surrogatepass") for t in new]
        for token, raw, rank in zip(new, as_bytes, self.whole.find(as_bytes).tolist()):
            self.kept[token] = (rank,) if rank >= 0 else tuple(merge_bytes(raw, self.ranks))

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        parts = [self.part.findall(t) if t else [] for t in texts]
        self.learn({p for ps in parts for p in ps})
        kept = self.kept
        out = []
        for ps in parts:
            ids: list[int] = []
            for p in ps:
                ids += kept[p]
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(path)


def _sent(df: DataFrame, path: str | None) -> str:
    """The vocabulary's path, its file having been sent to the executors once a Spark context."""
    where, context = path or vocabulary_path(), df.sparkSession.sparkContext
    sent = getattr(context, "_segloom_sent", set())
    if where not in sent:
        context.addFile(where)
        context._segloom_sent = sent | {where}
    return where


def _here(path: str) -> str:
    """The file that came with the job, else that at ``path`` itself."""
    came = Path(SparkFiles.get(Path(path).name))
    return str(came) if came.exists() else path


def _batches(batches: Iterator[pa.RecordBatch], path: str, lengths: bool) -> Iterator[pa.RecordBatch]:
    coder = encoder(_here(path))
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for at in range(0, max(1, len(texts)), 256):
            ids = coder.encode(texts[at : at + 256])
            keys = batch.column(0).slice(at, 256)
            if lengths:
                values = pa.array([len(i) for i in ids], pa.int32())
            else:
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                flat = np.fromiter((x for i in ids for x in i), np.int32, int(offsets[-1]))
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([keys, values], names=["key", "value"])


def encode_texts(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """Rows (key, ids): the token ids of each text without special tokens.

    A null or empty text has the empty list. Each row of ``df`` gives one row,
    repeated keys too; further columns are ignored. A text is encoded whole,
    whatever its length; no row leaves its partition.
    """
    where = _sent(df, path)
    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lambda b: _batches(b, where, False), f"key {kind}, value array<int>")
    return out.select(F.col("key").alias(key), F.col("value").alias("ids"))


def count_tokens(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """Rows (key, n_tokens): how many ids each text has; 0 for a null or empty one."""
    where = _sent(df, path)
    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(lambda b: _batches(b, where, True), f"key {kind}, value int")
    return out.select(F.col("key").alias(key), F.col("value").alias("n_tokens"))
