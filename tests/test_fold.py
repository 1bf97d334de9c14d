"""Greedy groups against a plain loop, over block edges too."""

from __future__ import annotations

import random

import pytest

from segloom.config import ChunkConfig
from segloom.operators.chunks import child_rule, parent_rule, previous_in_blocks
from segloom.operators.fold import greedy_groups
from segloom.operators.ordered import dense_position, previous_value


def child_loop(rows, c=ChunkConfig()):
    groups, cur, group = [], 0, 0
    for t, boundary, continues in rows:
        if cur:
            split = False
            if cur + t > c.child_max and cur >= c.child_min:
                split = not (continues and cur + t <= c.child_hard_max)
            elif cur >= c.child_target and boundary:
                split = True
            if split:
                group, cur = group + 1, 0
        groups.append(group)
        cur += t
    return [g - 1 if g == group and cur < c.child_min and group > 0 else g for g in groups]


def parent_loop(tokens, c=ChunkConfig()):
    groups, cur, n, group = [], 0, 0, 0
    for t in tokens:
        if n and ((cur + t > c.parent_max and cur >= c.parent_min) or (cur >= c.parent_target and n >= 2)):
            group, cur, n = group + 1, 0, 0
        groups.append(group)
        cur, n = cur + t, n + 1
    return [g - 1 if g == group and cur < c.parent_min and group > 0 else g for g in groups]


def run(spark, keys, rule, least, **sizes):
    rows = [(k, i, t, b, c, "x", 9) for k, items in keys.items() for i, (t, b, c) in enumerate(items)]
    df = spark.createDataFrame(rows, "k string, pos bigint, weight int, a boolean, b boolean, block string, own int")
    out = {k: [None] * len(items) for k, items in keys.items()}
    for r in greedy_groups(df, "k", rule, least=least, **{"heaviest": 1000, **sizes}).collect():
        out[r.k][r.pos] = r.group
    return out


def test_known_children(spark):
    f, t = False, True
    keys = {
        "a": [(100, f, f)] * 3,
        "b": [(150, f, f), (100, f, f), (45, f, t), (140, f, f)],
        "c": [(100, f, f), (100, f, f), (50, t, f), (130, f, f)],
        "d": [(100, f, f), (50, t, f), (60, t, f)],
        "e": [(20, f, f), (500, f, f), (10, f, f)],
        "f": [(200, f, f), (60, t, t), (130, f, f)],
        "g": [(5, f, f)],
    }
    expected = {"a": [0, 0, 0], "b": [0, 0, 0, 1], "c": [0, 0, 1, 1], "d": [0, 0, 0], "e": [0, 0, 0], "f": [0, 0, 1], "g": [0]}
    assert {k: child_loop(v) for k, v in keys.items()} == expected
    assert run(spark, keys, child_rule(ChunkConfig()), 128) == expected


def test_known_parents(spark):
    lists = {"a": [200] * 9, "b": [900, 200], "c": [900, 600], "d": [850, 100, 100, 600], "e": [900]}
    expected = {"a": [0, 0, 0, 0, 1, 1, 1, 1, 1], "b": [0, 0], "c": [0, 1], "d": [0, 0, 1, 1], "e": [0]}
    assert {k: parent_loop(v) for k, v in lists.items()} == expected
    assert run(spark, {k: [(t, False, False) for t in v] for k, v in lists.items()}, parent_rule(ChunkConfig()), 512) == expected


def test_over_blocks(spark):
    rng = random.Random(8)
    keys = {k: [(rng.choice([1, 5, 20, 90, 300]), rng.random() < 0.2, rng.random() < 0.1) for _ in range(n)] for k, n in (("long", 3000), ("edge", 700), ("short", 3))}
    keys["ones"] = [(1, False, False)] * 1500
    keys["many"] = [(rng.choice([150, 200, 260]), False, False) for _ in range(650 * 40)]
    got = run(spark, keys, child_rule(ChunkConfig()), 128, block=350, heaviest=300)
    assert got == {k: child_loop(v) for k, v in keys.items()}


def test_one_large_key(spark):
    """Two million rows of one key: blocks are joined in two rounds, and none of them is a whole key."""
    df = spark.range(2_000_000).selectExpr("'k' as k", "id as pos", "cast(pmod(xxhash64(id), 120) + 1 as int) as weight", "pmod(xxhash64(id), 7) = 0 as a", "false as b")
    got = greedy_groups(df, "k", child_rule(ChunkConfig()), least=128, heaviest=300, block=1000).toPandas().sort_values("pos").group.to_numpy()
    rows = df.toPandas()
    assert (got == child_loop(list(zip(rows.weight.tolist(), rows.a.tolist(), rows.b.tolist())))).all()


def test_too_long(spark):
    """Rows without weight could make a group of any length, which is an error and not a wrong result."""
    with pytest.raises(Exception, match="a group of more than 300 rows"):
        run(spark, {"k": [(0, False, False)] * 2000}, child_rule(ChunkConfig()), 128, block=350, heaviest=300)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, pos bigint, weight int, a boolean, b boolean")
    assert greedy_groups(df, "k", child_rule(ChunkConfig()), least=128, heaviest=300).count() == 0


def test_ordered(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.choice([None, i])) for k in ("a", "b") for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "k string, o int, v int").withColumn("bucket", __import__("pyspark").sql.functions.expr("o div 50"))
    expected = {}
    for k in ("a", "b"):
        last = None
        for n, (_, o, v) in enumerate(sorted(r for r in rows if r[0] == k)):
            expected[k, o] = (last, n)
            last = v if v is not None else last
    from pyspark.sql import functions as F

    got = {(r.k, r.o): r.p for r in previous_value(df, "k", "bucket", ["o"], {"p": F.col("v")}).collect()}
    assert got == {key: v[0] for key, v in expected.items()}
    got = {(r.k, r.o): r.n for r in dense_position(df, "k", "o", "n", block=64).collect()}
    assert got == {key: v[1] for key, v in expected.items()}
    placed = dense_position(df, "k", "o", "n")
    before = {(r.k, r.n): r.prev_o for r in previous_in_blocks(placed, "k", "n", ["o"], block=16).collect()}
    order = {k: sorted(r[1] for r in rows if r[0] == k) for k in ("a", "b")}
    assert before == {(k, i): order[k][i - 1] if i else None for k in order for i in range(200)}
