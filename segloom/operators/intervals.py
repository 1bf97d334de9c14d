"""Interval union and gaps by canonical dyadic blocks.

An integer interval [start, end) is the union of few dyadic blocks (aligned
ranges of a power of two). A block within another one is redundant, two
sibling blocks make their parent, and neighbouring blocks make a period. The
work is done in buckets of 2**21 units: a piece of an interval that ends
within a bucket is one of that bucket's rows; the buckets that it covers
whole are an interval in units of a bucket, and so on (three levels hold 63
bits). So no task holds a whole key, and a very long interval costs few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.operators.ordered import previous_value
from segloom.session import materialize

WIDTH = 21
_SIZE = 1 << WIDTH
#: Distance of two groups on the line on which a task's groups are laid out; more than a bucket, so groups never touch.
_STRIDE = WIDTH + 1


def dyadic_blocks(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The canonical dyadic blocks (level, index) of the intervals [start, end), all levels at once."""
    lo, hi = start.astype(np.int64), end.astype(np.int64)
    levels, index = [], []
    for level in range(64):
        live = lo < hi
        if not live.any():
            break
        lo, hi = lo[live], hi[live]
        for odd, at in ((lo & 1 == 1, lo), (hi & 1 == 1, hi - 1)):
            levels.append(np.full(int(odd.sum()), level, np.int64))
            index.append(at[odd])
        lo, hi = (lo + 1) >> 1, hi >> 1
    if not levels:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(levels), np.concatenate(index)


def drop_covered(level: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that are in no other block, in order of their start. Dyadic blocks nest or are apart."""
    start = index << level
    order = np.lexsort((-level, start))
    start, level, index = start[order], level[order], index[order]
    reach = np.maximum.accumulate(start + (np.int64(1) << level)) if len(start) else start
    keep = np.ones(len(start), bool)
    keep[1:] = start[1:] >= reach[:-1]
    return level[keep], index[keep]


def merge_siblings(level: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace two sibling blocks by their parent, level by level upward."""
    done_level, done_index = [], []
    top = int(level.max()) if len(level) else -1
    carried = np.empty(0, np.int64)
    at = 0
    while at <= top or len(carried):
        own = np.sort(np.concatenate([carried, index[level == at]]))
        pair = np.zeros(len(own), bool)
        if len(own) > 1:
            pair[:-1] = (own[:-1] & 1 == 0) & (own[1:] == own[:-1] + 1)
        second = np.zeros(len(own), bool)
        second[1:] = pair[:-1]
        alone = ~(pair | second)
        done_level.append(np.full(int(alone.sum()), at, np.int64))
        done_index.append(own[alone])
        carried = own[pair] >> 1
        at += 1
    if not done_level:
        return level, index
    return np.concatenate(done_level), np.concatenate(done_index)


def coalesce_blocks(level: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The periods [start, end) that the blocks cover, in order."""
    start = index << level
    order = np.argsort(start, kind="stable")
    start = start[order]
    end = start + (np.int64(1) << level[order])
    if not len(start):
        return start, end
    first = np.ones(len(start), bool)
    first[1:] = start[1:] != end[:-1]
    last = np.append(first[1:], True)
    return start[first], end[last]


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge rows (key, level, bucket, lo, hi), sorted by the first three, within each group.

    Groups are laid out side by side on one line, so that a batch of groups is
    merged at once; the last group of a batch waits for its rest.
    """
    rest: pa.Table | None = None

    def merged(t: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        lo, hi = t["lo"].to_numpy().astype(np.int64), t["hi"].to_numpy().astype(np.int64)
        offset = group << _STRIDE
        level, index = dyadic_blocks(lo + offset, hi + offset)
        start, end = coalesce_blocks(*merge_siblings(*drop_covered(level, index)))
        own = start >> _STRIDE
        first = np.searchsorted(group, own)
        base = t["bucket"].to_numpy()[first] << WIDTH
        grade = t["level"].to_numpy()[first].astype(np.int64)
        lo, hi = (base + (start & ((1 << _STRIDE) - 1))) << (WIDTH * grade), (base + end - (own << _STRIDE)) << (WIDTH * grade)
        inner = np.zeros(len(own), bool)
        inner[1:] = own[1:] == own[:-1]
        before = pa.array(np.concatenate([[0], hi[:-1]])[: len(hi)] if len(hi) else hi, pa.int64(), mask=~inner)
        return pa.RecordBatch.from_arrays(
            [t["key"].take(pa.array(first)).combine_chunks(), pa.array(grade.astype(np.int32)), t["bucket"].take(pa.array(first)).combine_chunks(), pa.array(lo), pa.array(hi), before],
            names=["key", "level", "bucket", "period_start", "period_end", "previous_end"],
        )

    def groups(t: pa.Table) -> np.ndarray:
        key = t["key"].combine_chunks().dictionary_encode(null_encoding="encode")
        code = (key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy(zero_copy_only=False)
        change = np.zeros(len(code), np.int64)
        for x in (code, t["level"].to_numpy(), t["bucket"].to_numpy()):
            change[1:] |= x[1:] != x[:-1]
        return np.cumsum(change)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        group = groups(t)
        cut = int(np.searchsorted(group, group[-1]))
        rest = t.slice(cut)
        if cut:
            yield merged(t.slice(0, cut), group[:cut])
    if rest is not None and rest.num_rows:
        yield merged(rest, groups(rest))


def _pieces(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Rows (key, level, bucket, lo, hi): the intervals, parted at the buckets of each level."""

    def parts(lo, hi, level):
        first, last = F.shiftright(lo, WIDTH), F.shiftright(hi - 1, WIDTH)
        piece = lambda b, a, z: F.struct(F.lit(level).alias("level"), b.alias("bucket"), (a - F.shiftleft(b, WIDTH)).cast("int").alias("lo"), (z - F.shiftleft(b, WIDTH)).cast("int").alias("hi"))
        one = F.when(first == last, piece(first, lo, hi))
        left = F.when(first < last, piece(first, lo, F.shiftleft(first + 1, WIDTH)))
        right = F.when(first < last, piece(last, F.shiftleft(last, WIDTH), hi))
        return [one, left, right], first + 1, last

    s, e = F.col("s"), F.col("e")
    made, lo1, hi1 = parts(s, e, 0)
    made1, lo2, hi2 = parts(lo1, hi1, 1)
    made2, _, _ = parts(lo2, hi2, 2)
    two = lo1 < hi1
    many = F.array(*made[1:], *(F.when(two, m) for m in made1), *(F.when(two & (lo2 < hi2), m) for m in made2))
    # Most intervals are one piece; only the others build the longer list. Rows of no length have no piece.
    pieces = F.when((s < e) & (F.shiftright(s, WIDTH) == F.shiftright(e - 1, WIDTH)), F.array(made[0])).when(s < e, F.filter(many, lambda p: p.isNotNull()))
    wide = df.select(F.col(key).alias("key"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    return wide.where("key is not null").select("key", F.explode(pieces).alias("p")).select("key", "p.level", "p.bucket", "p.lo", "p.hi")


def bucket_periods(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The periods of each (key, level, bucket), with the end of the one before it in its bucket."""
    kind = df.schema[key].dataType.simpleString()
    pieces = _pieces(df, key, start, end)
    parted = pieces.repartition("key", "level", "bucket").sortWithinPartitions("key", "level", "bucket")
    return parted.mapInArrow(
        _merge_batches,
        f"key {kind}, level int, bucket bigint, period_start bigint, period_end bigint, previous_end bigint",
    )


def interval_gaps(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The gaps between a key's intervals [start, end): key, gap_start, gap_end, one row a gap.

    A gap is a longest stretch of more than 0 units between two intervals that
    none of the key's intervals covers. Start and end are whole numbers; rows
    where one is null, the key too, or the end isn't later are left out. Repeated rows change nothing; an empty table gives no rows; further
    columns, whatever their names, are ignored.
    """
    runs = materialize(bucket_periods(df, key, start, end), "periods")
    summary = runs.where("level = 0").groupBy("key", "bucket").agg(F.min("period_start").alias("s"), F.max("period_end").alias("e"))
    coarse = runs.where("level > 0").select("key", F.lit(None).cast("bigint").alias("bucket"), F.col("period_start").alias("s"), F.col("period_end").alias("e"))
    rows = summary.unionByName(coarse)
    # A covering row starts no later than what it covers; it comes first among equals, as its bucket is null.
    before = Window.partitionBy("key").orderBy("s", F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    swept = rows.select("key", "bucket", "s", F.max("e").over(before).alias("reach"))
    across = swept.where("s > reach").select("key", F.col("reach").alias("gap_start"), F.col("s").alias("gap_end"))
    covered = swept.where("bucket is not null and s < reach").select("key", "bucket")
    inner = runs.where("level = 0 and previous_end is not null")
    within = inner.join(covered, ["key", "bucket"], "left_anti").select(
        "key", F.col("previous_end").alias("gap_start"), F.col("period_start").alias("gap_end")
    )
    return across.unionByName(within).withColumnRenamed("key", key)


def merge_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The continuous periods of each key's intervals: key, period_start, period_end.

    Intervals that overlap, nest or touch make one period. The cases are those
    of ``interval_gaps``: a period runs from a gap's end (or the key's first
    start) to the next gap's start (or the key's last end).
    """
    valid = df.where((F.col(start) < F.col(end)) & F.col(key).isNotNull())
    gaps = materialize(interval_gaps(df, key, start, end).withColumnRenamed(key, "key"), "gaps")
    ends = valid.groupBy(F.col(key).alias("key")).agg(F.min(F.col(start).cast("bigint")).alias("first"), F.max(F.col(end).cast("bigint")).alias("last"))
    marks = ends.select("key", F.col("first").alias("at"), F.lit(None).cast("bigint").alias("stop")).unionByName(
        gaps.select("key", F.col("gap_end").alias("at"), F.col("gap_start").alias("stop"))
    )
    marks = marks.withColumn("bucket", F.shiftright("at", WIDTH))
    found = previous_value(marks, "key", "bucket", ["at"], {"next_stop": F.col("stop")}, following=True)
    full = found.join(ends.select("key", "last"), "key")
    return full.select(F.col("key").alias(key), F.col("at").alias("period_start"), F.coalesce("next_stop", "last").alias("period_end"))
