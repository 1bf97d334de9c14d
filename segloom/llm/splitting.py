"""Splitting of oversized texts at natural boundaries.

The boundaries of a text are the ends of its words. Each is joined to its
farthest legal successor: the last boundary of the best kind that a piece which
begins there, with the words it repeats, can reach near its end. All cuts of all texts of a
batch then come from squaring that table: after k rounds the first 2**k cuts
of every text are known. A text is one row, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.functions.text import TOKENS_PER_WORD, overlap_words

_WORD = re.compile(r"\S+")
_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)\]]*$")
_CLAUSE = re.compile(r"[,;:—–]+[\"'”’»)\]]*$")
PIECES = "item_id string, piece_no int, first_char int, end_char int, n_tokens int, text string"


def most_words(limit: int) -> int:
    """The largest number of words whose token estimate is within ``limit``."""
    n = int(limit / TOKENS_PER_WORD) + 2
    while int(n * TOKENS_PER_WORD) > limit:
        n -= 1
    return n


def boundary_kinds(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """For each word: 3 a paragraph ends after it, 2 a sentence, 1 a clause, 0 none."""
    kinds = np.zeros(len(spans), np.int8)
    for i, (a, z) in enumerate(spans):
        word = text[max(a, z - 8) : z]
        if i + 1 < len(spans) and "\n" in text[z : spans[i + 1][0]]:
            kinds[i] = 3
        elif _SENTENCE.search(word):
            kinds[i] = 2
        elif _CLAUSE.search(word):
            kinds[i] = 1
    return kinds


def successors(kinds: np.ndarray, reach: int, repeat: int) -> np.ndarray:
    """The farthest legal successor of each boundary 0..n of one text; n is its own.

    A piece has at most ``reach`` words, of which all but the first text's
    piece repeat ``repeat`` words. The last end of a paragraph in the last third
    of the reach counts, else the last end of a sentence there, else of a
    clause; where that third has none, the same in the last two thirds, then in
    all of the reach; else the last word.
    """
    n = len(kinds)
    at = np.arange(n + 1)
    limit = np.minimum(at + np.where(at == 0, reach, reach - repeat), n)
    third, two = limit - (limit - at) // 3, limit - 2 * (limit - at) // 3
    best = limit.copy()
    lasts = []
    for least in (1, 2, 3):
        mark = np.zeros(n + 1, np.int64)
        mark[1:][kinds >= least] = at[1:][kinds >= least]
        lasts.append(np.maximum.accumulate(mark)[limit])
    for floor, least in ((f, k) for f in (at, two, third) for k in range(3)):
        best = np.where(lasts[least] > floor, lasts[least], best)
    return np.where(limit == n, n, best)


def all_cuts(successor: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which boundaries the greedy cuts from ``first`` reach, by squaring the table of successors."""
    reached = np.zeros(len(successor), bool)
    reached[first] = True
    jump = successor
    while True:
        known = np.flatnonzero(reached)
        reached[jump[known]] = True
        if int(reached.sum()) == len(known):
            return reached
        jump = jump[jump]


def _split(batches: Iterator[pa.RecordBatch], limit: int, overlap: int) -> Iterator[pa.RecordBatch]:
    reach, repeat = most_words(limit), overlap_words(overlap) if overlap else 0
    if repeat >= reach:
        raise ValueError("the overlap must be smaller than the limit")
    schema = pa.schema([("item_id", pa.string()), ("piece_no", pa.int32()), ("first_char", pa.int32()), ("end_char", pa.int32()), ("n_tokens", pa.int32()), ("text", pa.string())])
    for batch in batches:
        items, texts, spans, tables, firsts, at = [], [], [], [], [], 0
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text is None or len(text) < 2 * reach or len(text.split()) <= reach:
                continue
            words = [m.span() for m in _WORD.finditer(text)]
            table = successors(boundary_kinds(text, words), reach, repeat)
            items.append(item), texts.append(text), spans.append(words), tables.append(table + at), firsts.append(at)
            at += len(table)
        if not items:
            continue
        cut = all_cuts(np.concatenate(tables), np.array(firsts))
        columns: list[list] = [[] for _ in schema]
        for item, text, words, first, table in zip(items, texts, spans, firsts, tables):
            ends = np.flatnonzero(cut[first : first + len(table)])
            for k, (a, z) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                begin = max(0, a - repeat) if k else 0
                low, high = words[begin][0], words[z - 1][1]
                for column, value in zip(columns, (item, k, low, high, int((z - begin) * TOKENS_PER_WORD), text[low:high])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def split_texts(df: DataFrame, item: str, text: str, limit: int, overlap: int = 50) -> DataFrame:
    """The pieces of the texts of more than ``limit`` tokens: item_id, piece_no, first_char, end_char, n_tokens, text.

    A text's tokens are floor(1.3 x its words). A piece is a stretch of the
    text, so what stands between its words stays; from the second piece on it
    begins with the last words (38 for 50 tokens) of the piece before. Null,
    empty and short texts have no rows. A repeated row's pieces come once; an
    item whose rows have different texts has the pieces of each; items without
    an id are kept apart by their texts. Further columns are ignored.
    """
    rows = df.select(F.col(item).cast("string"), F.col(text))
    return rows.mapInArrow(lambda b: _split(b, limit, overlap), PIECES).dropDuplicates(["item_id", "piece_no", "first_char", "end_char", "text"])
