"""Interval union against a sweep, with random and adverse intervals."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segloom.operators.intervals import coalesce_blocks, drop_covered, dyadic_blocks, interval_gaps, merge_intervals, merge_siblings


def sweep(intervals):
    periods = []
    for s, e in sorted(i for i in intervals if i[0] is not None and i[1] is not None and i[0] < i[1]):
        if periods and s <= periods[-1][1]:
            periods[-1][1] = max(periods[-1][1], e)
        else:
            periods.append([s, e])
    return [tuple(p) for p in periods]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(1, 200)), max_size=40))
def test_blocks(pairs):
    intervals = [(s, s + n) for s, n in pairs]
    start, end = np.array([i[0] for i in intervals], np.int64), np.array([i[1] for i in intervals], np.int64)
    level, index = dyadic_blocks(start, end)
    covered = {x for s, e in intervals for x in range(s, e)}
    assert {x for b, i in zip(level.tolist(), index.tolist()) for x in range(i << b, (i + 1) << b)} == covered
    level, index = merge_siblings(*drop_covered(level, index))
    cells = [x for b, i in zip(level.tolist(), index.tolist()) for x in range(i << b, (i + 1) << b)]
    assert len(cells) == len(set(cells)) and set(cells) == covered
    assert list(zip(*map(np.ndarray.tolist, coalesce_blocks(level, index)))) == sweep(intervals)


def cases():
    rng = random.Random(4)
    rows = [("a", s := rng.randrange(0, 40_000_000), s + rng.randrange(1, 40_000)) for _ in range(1500)]
    rows += [("b", 5, 10), ("b", 5, 10), ("b", 10, 12), ("b", 20, 19), ("b", None, 5), ("b", 7, None), (None, 1, 2), (None, 5, 6)]
    rows += [("long", 0, 10), ("long", 20, 10**13), ("long", 10**12, 10**12 + 5), ("long", 2 * 10**13, 2 * 10**13 + 1)]
    rows += [("edge", 0, 1 << 21), ("edge", 1 << 21, (1 << 21) + 5), ("edge", 3 << 21, 5 << 21), ("edge", (7 << 21) - 1, (7 << 21) + 1)]
    rows += [("whole", 1 << 42, 3 << 42), ("whole", (1 << 42) + 7, (1 << 42) + 9), ("whole", 10, 11), ("negative", -50, -20), ("negative", -10, 4)]
    return rows


def test_gaps_and_periods(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in cases()], "k string, s bigint, e bigint, key string, bucket int")
    periods, gaps = set(), set()
    for k in {r[0] for r in cases()} - {None}:
        merged = sweep([r[1:] for r in cases() if r[0] == k])
        periods |= {(k, *p) for p in merged}
        gaps |= {(k, a[1], b[0]) for a, b in zip(merged, merged[1:])}
    found = interval_gaps(df, "k", "s", "e").collect()
    assert len(found) == len(gaps) and {tuple(r) for r in found} == gaps
    found = merge_intervals(df, "k", "s", "e").collect()
    assert len(found) == len(periods) and {tuple(r) for r in found} == periods


def test_empty(spark):
    df = spark.createDataFrame([], "k string, s bigint, e bigint")
    assert interval_gaps(df, "k", "s", "e").count() == 0
    assert merge_intervals(df, "k", "s", "e").count() == 0
