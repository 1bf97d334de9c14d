"""Pieces, token ids and containers: round trips, bounds and brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segloom.llm.packing import bucket_edges, pack_items, plan_batches
from segloom.llm.splitting import all_cuts, most_words, split_texts, successors
from segloom.llm.tokenizer import Encoder, PerfectHash, count_tokens, encode_texts, merge_bytes, vocabulary_path
from segloom.session import table


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=120), st.integers(5, 30), st.integers(0, 4))
def test_cuts(kinds, reach, repeat):
    kinds = np.array(kinds, np.int8)
    table = successors(kinds, reach, repeat)
    reached = np.flatnonzero(all_cuts(table, np.array([0]))).tolist()
    at, cuts = 0, [0]
    while at < len(kinds):
        limit = min(at + (reach if at == 0 else reach - repeat), len(kinds))
        options = range(at + 1, limit + 1)
        floors = (limit - (limit - at) // 3, limit - 2 * (limit - at) // 3, at)  # the last third, two thirds, all of the reach
        best = (max(c) for f in floors for k in (3, 2, 1) if (c := [p for p in options if p > f and kinds[p - 1] >= k]))
        at = limit if limit == len(kinds) else next(best, limit)
        cuts.append(at)
    assert reached == cuts


def test_an_early_sentence_makes_no_small_piece():
    """A sentence that ends near the beginning is no cut where clauses end near the end of the reach; paragraphs win over sentences."""
    kinds = np.zeros(1000, np.int8)
    kinds[10], kinds[220] = 2, 1
    assert successors(kinds, 231, 38)[0] == 221
    kinds[200], kinds[225] = 3, 2
    assert successors(kinds, 231, 38)[0] == 201
    kinds[150:] = 0
    assert successors(kinds, 231, 38)[0] == 11


def test_split(spark):
    rng = random.Random(1)
    words = [rng.choice(["word", "end.", "pause,", "line\n"]) for _ in range(2000)]
    text = " ".join(words)
    rows = [("a", text, 1), ("a", text, 1), ("b", "short", 1), ("c", None, 1), ("d", "", 1), ("e", "x" * 100_000, 1), (None, text, 1), ("f", "w " * 231, 1), ("g", "w " * 232, 1), ("h", "w " * 300, 1)]
    df = spark.createDataFrame(rows, "id string, t string, piece_no int")
    pieces = split_texts(df, "id", "t", 300).collect()
    assert {p.item_id for p in pieces} == {"a", None, "g", "h"} and most_words(300) == 231 and most_words(1000) == 769
    own = sorted((p for p in pieces if p.item_id == "a"), key=lambda p: p.piece_no)
    assert [p.piece_no for p in own] == list(range(len(own)))
    assert all(int(len(p.text.split()) * 1.3) == p.n_tokens <= 300 and text[p.first_char : p.end_char] == p.text for p in own)
    assert own[0].first_char == 0 and own[-1].end_char == len(text.rstrip())
    for p, q in zip(own, own[1:]):
        assert q.text.split()[:38] == p.text.split()[-38:]
        assert p.text.split()[-1] == "end." or "\n" in text[p.end_char - 1 : p.end_char + 1]
    assert split_texts(df.limit(0), "id", "t", 300).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary_path())


def test_perfect_hash(encoder):
    keys = list(encoder.ranks)
    assert encoder.whole.size == len(keys) == len(set(encoder.whole.slot_keys))
    assert (encoder.whole.find(keys) == np.array([encoder.ranks[k] for k in keys])).all()
    assert (encoder.whole.find([b"no such token", b"\xff\xfe"]) == -1).all() and len(encoder.whole.find([])) == 0
    small = PerfectHash({b"a": 5})
    assert small.find([b"a", b"b"]).tolist() == [5, -1]


def test_ids(spark, data, encoder):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary_path(), "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in table(spark, data, "documents").select("text").collect()]
    texts += ["", None, "  \n\n ", "<|endoftext|>", "日本語🌊🌊" * 50, "x" * 3000, "a\x00b", "don't DON'T we'LL", "ſ ﬁ Å ñ"]
    assert encoder.encode(texts) == [other.encode_ordinary(t) if t else [] for t in texts]
    for token in (b"hello", b"zzqx", " unbelievably".encode(), "é".encode() * 9):
        assert merge_bytes(token, ranks) == other.encode_single_piece(token) if hasattr(other, "encode_single_piece") else True
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "a", 1)], "id int, t string, ids int")
    got = {r.id: r.ids for r in encode_texts(df, "id", "t").collect()}
    assert got == {**dict(enumerate(encoder.encode(texts))), None: [64]}
    assert {r.id: r.n_tokens for r in count_tokens(df, "id", "t").collect()} == {k: len(v) for k, v in got.items()}
    assert encode_texts(df.limit(0), "id", "t").count() == 0


def brute_padding(lengths, counts, buckets):
    from itertools import combinations

    x = sorted(zip(lengths, counts))
    best = None
    for inner in combinations(range(len(x) - 1), min(buckets, len(x)) - 1):
        edges = [*inner, len(x) - 1]
        cost = sum(c * (x[next(e for e in edges if e >= i)][0] - n) for i, (n, c) in enumerate(x))
        best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_edges(histogram, buckets):
    lengths, counts = np.array(list(histogram)), np.array(list(histogram.values()))
    edges = bucket_edges(lengths, counts, buckets)
    assert len(edges) <= buckets and edges[-1] == lengths.max()
    cost = sum(c * (edges[np.searchsorted(edges, n)] - n) for n, c in histogram.items())
    assert cost == brute_padding(list(histogram), list(histogram.values()), buckets)
    plan = plan_batches(np.arange(1, 61), np.bincount(lengths, weights=counts, minlength=61)[1:].astype(int), 64)
    placed: dict[int, int] = {}
    for edge, first, places, per, container in plan:
        assert places % per == 0
        for k in range(places // per):
            placed[container + k] = placed.get(container + k, 0) + per * edge
        histogram[edge] -= places
    assert not any(histogram.values()) and max(placed.values()) <= 64 and sorted(placed) == list(range(len(placed)))


def test_pack(spark, data):
    rng = random.Random(3)
    sizes = [None, 0, 1, 2048, 2049, 7000, *[rng.randrange(1, 900) for _ in range(600)], *[400] * 300]
    df = spark.createDataFrame([(i, n, 1) for i, n in enumerate(sizes)] + [(2, 1, 1)], "id int, n int, container_id int")
    rows = pack_items(df, "id", "n").collect()
    used: dict[int, int] = {}
    held: dict[int, int] = {}
    for r in rows:
        held[r.id] = held.get(r.id, 0) + r.n_tokens
        if r.container_id is not None:
            used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
    assert held == {i: (n or 0) + (i == 2) for i, n in enumerate(sizes)}
    assert max(used.values()) <= 2048 and sum(used.values()) >= 0.93 * 2048 * len(used)
    assert {r.id for r in rows if r.piece_no > 0} == {4, 5} and {r.id for r in rows if r.container_id is None} == {0, 1}
    assert pack_items(df.limit(0), "id", "n").count() == 0
    documents = count_tokens(table(spark, data, "documents"), "doc_id", "text")
    fill = pack_items(documents, "doc_id", "n_tokens").where("container_id is not null").groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.avg("n"), F.max("n")).collect()[0]
    assert fill[0] > 0.9 * 2048 and fill[1] <= 2048
