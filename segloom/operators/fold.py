"""Greedy grouping of ordered rows, without a sequential pass over a whole key.

Whether a group ends before a row depends only on the group's rows so far, so
the end of the group that would begin at a row can be found for every row at
once. A key is cut into blocks of rows with a margin of the following rows;
each block tells, for every place where a group may enter it, where the groups
leave it. Such maps compose, so blocks are joined into larger ones, round by
round, until a key is one; on the way back each block learns where it is really
entered, and a last pass marks the groups. No task holds a whole key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.session import materialize

#: rule(sum so far, rows so far, weight, flag a, flag b) -> whether a group ends before the row, elementwise.
Rule = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def group_ends(weight: np.ndarray, a: np.ndarray, b: np.ndarray, rule: Rule, stop: np.ndarray) -> np.ndarray:
    """For each row, the row before which a group that begins there ends, at the latest at its ``stop`` (the end of its key)."""
    end = stop.copy()
    start = np.arange(len(weight))
    total, count, at = weight.astype(np.int64), np.ones(len(weight), np.int64), start + 1
    while len(start):
        live = at < stop[start]
        start, total, count, at = start[live], total[live], count[live], at[live]
        if not len(start):
            break
        ends = rule(total, count, weight[at], a[at], b[at])
        end[start[ends]] = at[ends]
        go = ~ends
        start, at = start[go], at[go]
        total, count, at = total[go] + weight[at], count[go] + 1, at + 1
    return end


def leave(end: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: where the groups from there leave the block's own rows, and how many begin in it."""
    jump = np.append(end, len(end))
    inside = np.append(own, False)
    count = inside.astype(np.int64)
    while (on := inside & inside[jump]).any():
        count = np.where(on, count + count[jump], count)
        jump = np.where(on, jump[jump], jump)
    return jump[:-1], count[:-1]


class _Rows:
    """The rows of some keys of one block, by key and place; a key's own rows come before those of its margin."""

    def __init__(self, t: pa.Table) -> None:
        self.t = t.sort_by([("key", "ascending"), ("pos", "ascending")]).combine_chunks()
        self.weight, self.a, self.b, self.own = (self.t[c].to_numpy() for c in ("weight", "a", "b", "own"))
        code = self.t["key"].combine_chunks().dictionary_encode().indices.to_numpy()
        change = np.ones(len(code), bool)
        change[1:] = code[1:] != code[:-1]
        self.first = np.flatnonzero(change)
        self.last = np.append(self.first[1:], len(code))
        self.number = np.cumsum(change) - 1
        self.keys = self.t["key"].combine_chunks().take(pa.array(self.first))
        self.own_end = self.first + np.add.reduceat(self.own.astype(np.int64), self.first)

    def ends(self, rule: Rule) -> np.ndarray:
        return group_ends(self.weight, self.a, self.b, rule, self.last[self.number])


def _lists(values: np.ndarray, first: np.ndarray, last: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The stretches [first, last) of ``values`` as lists."""
    size = last - first
    offsets = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first, size)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values[place], kind))


class _Maps:
    """The maps of some blocks, by key and block: for each place of entry the place of entry into the next block, and how many groups begin on the way."""

    def __init__(self, t: pa.Table) -> None:
        self.t = t.sort_by([("key", "ascending"), ("block", "ascending")]).combine_chunks()
        out, count = self.t["out"].combine_chunks(), self.t["count"].combine_chunks()
        self.offset = out.offsets.to_numpy() - out.offsets[0].as_py()
        self.out, self.count = out.flatten().to_numpy(), count.flatten().to_numpy()
        self.block = self.t["block"].to_numpy()
        code = self.t["key"].combine_chunks().dictionary_encode().indices.to_numpy()
        change = np.ones(len(code), bool)
        change[1:] = (code[1:] != code[:-1]) | (self.block[1:] // _FAN != self.block[:-1] // _FAN)
        self.first = np.flatnonzero(change)
        self.last = np.append(self.first[1:], len(code))

    def step(self, i: int, entry: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From entries into block ``i`` to those into the next; a group that begins beyond a short last block stays beyond it."""
        a, n = self.offset[i], self.offset[i + 1] - self.offset[i]
        into = entry < n
        at = a + np.minimum(entry, n - 1)
        return np.where(into, self.out[at], entry - n), np.where(into, count + self.count[at], count)


#: Blocks that are joined into one in a round.
_FAN = 32


def _joined(t: pa.Table) -> pa.Table:
    m = _Maps(t)
    outs, counts = [], []
    for first, last in zip(m.first.tolist(), m.last.tolist()):
        entry = np.arange(m.offset[first + 1] - m.offset[first])
        count = np.zeros(len(entry), np.int64)
        for i in range(first, last):
            entry, count = m.step(i, entry, count)
        outs.append(entry), counts.append(count)
    size = np.array([len(o) for o in outs])
    ends = np.cumsum(size)
    rows = pa.array(m.first)
    lists = (_lists(np.concatenate(x), ends - size, ends, pa.int64()) for x in (outs, counts))
    return pa.table([m.t["key"].combine_chunks().take(rows), pa.array(m.block[m.first] // _FAN), *lists], names=["key", "block", "out", "count"])


def _entered(t: pa.Table, parents: pa.Table) -> pa.Table:
    """Where each block is entered and the number of its first group, from those of the joined blocks."""
    m = _Maps(t)
    known = {(k, b): (e, f) for k, b, e, f in zip(*(parents[c].to_pylist() for c in ("key", "block", "entry", "first")))}
    keys = m.t["key"].combine_chunks().take(pa.array(m.first)).to_pylist()
    entries, firsts = np.zeros(len(m.block), np.int64), np.zeros(len(m.block), np.int64)
    for key, first, last in zip(keys, m.first.tolist(), m.last.tolist()):
        e, f = known[key, int(m.block[first]) // _FAN]
        entry, count = np.array([e]), np.array([f])
        for i in range(first, last):
            entries[i], firsts[i] = entry[0], count[0]
            entry, count = m.step(i, entry, count)
    return m.t.select(["key", "block"]).append_column("entry", pa.array(entries)).append_column("first", pa.array(firsts))


def block_entries(blocks: DataFrame, kind: str) -> DataFrame:
    """Rows (key, block, entry, first) of blocks (key, block, out, count), block 0 of a key being entered at its first row."""
    levels, above = [blocks], blocks.agg(F.max("block")).first()[0] or 0
    while above:
        parent = F.floor(F.col("block") / _FAN)
        joined = levels[-1].groupBy(F.pmod(F.xxhash64("key", parent), F.lit(1 << 14))).applyInArrow(_joined, f"key {kind}, block bigint, out array<bigint>, count array<bigint>")
        levels.append(materialize(joined, "blocks"))
        above //= _FAN
    zero = F.lit(0).cast("bigint")
    entries = levels.pop().select("key", "block", zero.alias("entry"), zero.alias("first"))
    while levels:
        salt = lambda b: F.pmod(F.xxhash64("key", b), F.lit(1 << 14))
        below = levels.pop().groupBy(salt(F.floor(F.col("block") / _FAN)))
        entries = below.cogroup(entries.groupBy(salt(F.col("block")))).applyInArrow(_entered_some, f"key {kind}, block bigint, entry bigint, first bigint")
    return entries


def _entered_some(t: pa.Table, parents: pa.Table) -> pa.Table:
    if t.num_rows:
        return _entered(t, parents)
    return parents.slice(0, 0).select(["key", "block", "entry", "first"])


def greedy_groups(df: DataFrame, key: str, rule: Rule, *, least: int, heaviest: int, block: int = 8192, part_size: int = 16_384) -> DataFrame:
    """Rows (key, pos, group) for rows (key, pos, weight, a, b), pos dense from 0 in each key.

    Groups are formed greedily by ``rule``. A last group whose weights sum to
    less than ``least`` joins the one before it, if there is one. ``heaviest``
    is a weight by which the rule ends every group: each row weighing at least
    1, no group has more rows, and a block looks that far ahead. A longer group,
    as of rows that weigh 0, is an error. Rows with a null key are left out; an
    empty table gives no rows. ``df`` is read three times, so the caller writes
    it first if it is costly. Keys are worked on together, the same block of all
    keys of a part of about ``part_size`` rows at a time.
    """
    kind = df.schema[key].dataType.simpleString()
    margin, block = heaviest + 2, max(block, 2 * (heaviest + 2))
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col("pos").cast("bigint"), F.col("weight").cast("bigint"), "a", "b")
    at = F.floor(F.col("pos") / block)
    homes = F.when((F.col("pos") % block < margin) & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
    parts = max(1, df.count() // part_size)
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    spread = rows.select("*", F.explode(homes).alias("block"), part.alias("part")).withColumn("own", at == F.col("block"))

    def ends_of(r: _Rows) -> np.ndarray:
        end = r.ends(rule)
        full = r.last - r.own_end >= margin  # there may be more rows than the block sees
        cut = r.own & full[r.number] & (end == r.last[r.number])
        if cut.any():
            raise ValueError(f"a group of more than {heaviest} rows; rows must weigh at least 1, and the rule end a group by that weight")
        return end

    def summary(t: pa.Table) -> pa.Table:
        r = _Rows(t)
        out, count = leave(ends_of(r), r.own)
        entries = np.minimum(r.first + margin, r.own_end)
        number = pa.array(np.full(len(r.keys), t["block"][0].as_py(), np.int64))
        lists = (_lists(x, r.first, entries, pa.int64()) for x in (out - r.own_end[r.number], count))
        return pa.table([r.keys, number, *lists], names=["key", "block", "out", "count"])

    # Most keys are one block, which is entered at its first row; only the others are joined.
    longer = rows.where(F.col("pos") >= block).select("key").distinct()
    several = spread.join(longer, "key", "left_semi")
    blocks = several.groupBy("part", "block").applyInArrow(summary, f"key {kind}, block bigint, out array<bigint>, count array<bigint>")
    entries = block_entries(materialize(blocks, "blocks"), kind).where("block > 0 or entry > 0").withColumn("part", part)

    def mark(rows: pa.Table, starts: pa.Table) -> pa.Table:
        r = _Rows(rows)
        end = ends_of(r)
        entry, first = np.zeros(len(r.keys), np.int64), np.zeros(len(r.keys), np.int64)
        place = pc.index_in(starts["key"], value_set=r.keys).to_numpy()
        entry[place], first[place] = starts["entry"].to_numpy(), starts["first"].to_numpy()
        n = len(end)
        reached = np.zeros(n + 1, bool)
        begin = r.first + entry
        reached[begin[begin < r.own_end]] = True
        # Successors of groups within a key's own rows, squared until all are known.
        jump = np.append(np.where(end < r.own_end[r.number], end, n), n)
        while True:
            known = np.flatnonzero(reached[:n])
            reached[jump[known]] = True
            if int(reached[:n].sum()) == len(known):
                break
            jump = jump[jump]
        total = np.cumsum(reached[:n])
        before = total[r.first] - reached[r.first]
        group = first[r.number] + total - before[r.number] - 1
        return pa.table([r.t["key"], r.t["pos"], r.t["weight"], pa.array(group)], names=["key", "pos", "weight", "group"]).filter(pa.array(r.own))

    marked = spread.groupBy("part", "block").cogroup(entries.groupBy("part", "block")).applyInArrow(mark, f"key {kind}, pos bigint, weight bigint, group bigint")
    marked = materialize(marked, "groups")
    sums = marked.groupBy("key", "group").agg(F.sum("weight").alias("sum"))
    last = sums.groupBy("key").agg(F.max("group").alias("group"), F.max_by("sum", "group").alias("sum"))
    tail = last.where((F.col("sum") < least) & (F.col("group") > 0)).select("key", "group", (F.col("group") - 1).alias("merged"))
    out = marked.join(tail, ["key", "group"], "left")
    return out.select(F.col("key").alias(key), "pos", F.coalesce("merged", "group").cast("int").alias("group"))
