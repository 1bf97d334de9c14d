"""Language of documents and passages by compression.

A text is compressed with one raw-content dictionary of sample sentences per
language; the language of the smallest result is the text's, unless the margin
to the next one is narrow. Texts are parted into passages at the ends of
sentences, long runs without punctuation into overlapping windows of words, so
that a text of two languages shows both.
"""

from __future__ import annotations

import gc
import html
import re
import unicodedata
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.fillers import HESITATIONS
from segloom.session import hash_sample

# How labels name the languages, beside their two-letter codes and what begins with one.
LANGUAGE_NAMES = {
    "en": ("eng", "english", "anglais", "englisch", "inglés", "ingles", "inglês"),
    "fr": ("fre", "fra", "french", "français", "francais", "französisch", "francés", "frances", "francês"),
    "de": ("ger", "deu", "german", "allemand", "deutsch", "alemán", "aleman", "alemão", "alemao"),
    "es": ("spa", "spanish", "espagnol", "spanisch", "español", "espanol", "castellano", "castilian", "espanhol"),
    "pt": ("por", "port", "portuguese", "portugais", "portugiesisch", "portugués", "portugues", "português", "brazilian"),
}
_NAMED = {name: code for code, names in LANGUAGE_NAMES.items() for name in (code, *names)}

#: Fewest words of a record, or of a clause, that show its language.
LEAST_WORDS = 6
#: Windows of so many words, in runs of more than so many words without the end of a sentence.
_WINDOW, _RUN = 6, 32
#: Windows so many apart hold five words of each clause of six; a passage in which one of them differs is looked at again.
_GLANCE = 3
#: Margin, as a share of the second smallest size, below which a language is rejected, and that of a second language.
REJECT, SECOND = 0.12, 0.2
#: Bytes by which a clause in a second language must be smaller than in the text's.
_GAIN = 6
#: Records that are classified at once.
_BATCH = 2048

_MARKS = re.compile(r"\[[^\]]*\]|\([^)]*\)|\{[^}]*\}|<[^>]*>|\*[^*\n]*\*|[♪♫♩♬]+|https?://\S+|\d+:\d\d(?::\d\d)?(?:[.,:]\d+)?(?:\s*-+>?(?=\s|$))?|[#@]\w+")
_LABEL = re.compile(r"^\s*(?:>>[^:\n]{1,60}:|-\s+[^\n]{1,50}?\s+-(?=\s)|(?:[^\W\d_][\w#.'-]*(?:[ ,]+[\w#.'()-]+){0,3}\s*:(?=\s)))", re.M)
_SIGNS = re.compile(r"[\[({<*♪♫♩♬:#@>]")
_SENTENCE = re.compile(r"(?<=[.!?…;])\s+|\n+|\s+[—–|/•]+\s+")
#: Where none of the rarer marks is, sentences are parted at these ends alone, which are found much faster.
_RARE, _ANY_END, _END = re.compile(r"[—–|/•]"), re.compile(r"[.!?…;]\s|[\n—–|/•]"), re.compile(r"[.!?…;\n](?:(?<=\n)\n*|(?<!\n)\s+)")
_NO_SPACE = re.compile(r"\S+")
_INVISIBLE = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]")


def label_code(label: str | None) -> str | None:
    """The language that a label names, in any of its forms; null where it names none of the five."""
    bare = (label or "").strip().strip(".").lower()
    return _NAMED.get(bare) or _NAMED.get(re.split(r"[-_ ]", bare, maxsplit=1)[0].strip("."))


def readable(text: str) -> str:
    """The text without labels, times, annotations, links and invisible marks, in lower case."""
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFC", text))
    if ":" in text or "- " in text:
        text = _LABEL.sub(" ", text)
    if _SIGNS.search(text):
        text = _MARKS.sub(" ", text)
    return text.lower()


def word_spans(text: str, at: int, end: int) -> list[tuple[int, int]]:
    """(first char, end char) of the words of a stretch of text."""
    return [m.span() for m in _NO_SPACE.finditer(text, at, end)]


def window_starts(n: int) -> list[int]:
    """The first words of windows ``_GLANCE`` apart over ``n`` words; the last window ends with the last word."""
    last = max(0, n - _WINDOW)
    return [*range(0, last, _GLANCE), last]


@lru_cache(4096)
def _windows(n: int) -> tuple[tuple[int, ...], tuple[slice, ...]]:
    """The first words of the windows over ``n`` words, and the windows."""
    starts = window_starts(n)
    return tuple(starts), tuple(slice(i, i + _WINDOW) for i in starts)


def _parted(text: str) -> list[tuple[int, int, str, list[str]]]:
    if not _ANY_END.search(text):
        words = text.split()
        return [(0, len(text), text, words)] if words else []
    out, at = [], 0
    if _RARE.search(text):
        cuts = [m.span() for m in _SENTENCE.finditer(text)]
    else:
        cuts = [(a if text[a] == "\n" else a + 1, z) for a, z in (m.span() for m in _END.finditer(text))]
    for end, after in [*cuts, (len(text), len(text))]:
        part = text[at:end]
        words = part.split()
        if words:
            out.append((at, end, part, words))
        at = after
    return out


def passages(text: str) -> list[tuple[int, int, str, int]]:
    """(first char, end char, text, words) of the passages of a readable text.

    Passages are sentences, or runs of words without the end of one.
    """
    return [(at, end, part, len(words)) for at, end, part, words in _parted(text)]


class _Numbers(dict):
    """Numbers of texts, in the order in which they were first asked for; ``fresh`` has the new ones."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, text: str) -> int:
        self.fresh.append(text)
        self[text] = n = len(self)
        return n


class _Met:
    """Sizes of the texts met, up to a bound and a batch."""

    def __init__(self, width: int) -> None:
        self.known, self.table = _Numbers(), np.zeros((0, width), np.int32)

    def sizes(self, texts: list[str], languages: Languages, bound: int) -> np.ndarray:
        known = self.known
        if len(known) > bound or known.fresh:  # fresh: a batch before broke off
            known.clear()
            known.fresh = []
        begin = len(known)
        number = np.fromiter(map(known.__getitem__, texts), np.int64, len(texts))
        if known.fresh:
            end = len(known)
            if end > len(self.table):
                # Room for as many again, so that the table isn't copied with each batch.
                self.table = np.concatenate([self.table[:begin], np.zeros((2 * end - begin, self.table.shape[1]), np.int32)])
            self.table[begin:end] = languages.sizes([t.encode("utf-8", "replace") for t in known.fresh])
            known.fresh = []
        return self.table[number]


@dataclass
class Languages:
    """A compressor for each language, with the language's samples as raw content before the text."""

    codes: list[str]
    samples: list[bytes]
    level: int = 1
    run: str = ""  #: which run they were made for; no other one's sizes are used

    def __post_init__(self) -> None:
        self.run = self.run or uuid.uuid4().hex
        self.compressors, self.windows, self.wholes = [], _Met(len(self.codes)), _Met(len(self.codes))
        for content in self.samples:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=self.level)
            settings = zstandard.ZstdCompressionParameters.from_level(self.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))

    def __reduce__(self) -> tuple:
        return _of_worker, (tuple(self.codes), tuple(self.samples), self.level, self.run)  # each worker makes its own compressors

    @property
    def known(self) -> dict[str, int]:
        return self.windows.known

    @property
    def table(self) -> np.ndarray:
        return self.windows.table

    def sizes(self, texts: list[bytes]) -> np.ndarray:
        """Compressed sizes, one row a text, one column a language."""
        out = np.zeros((len(texts), len(self.codes)), np.int32)
        for at in range(0, len(texts), 4096):
            part = texts[at : at + 4096]
            for j, c in enumerate(self.compressors):
                made = c.multi_compress_to_buffer(part, threads=0)
                out[at : at + len(part), j] = np.fromiter(map(len, made), np.int32, len(part))
        return out

    def known_sizes(self, texts: list[str], bound: int = 500_000) -> np.ndarray:
        """``sizes`` of short texts that come often: those met are kept, up to ``bound`` and a batch."""
        return self.windows.sizes(texts, self, bound)

    def whole_sizes(self, texts: list[str], bound: int = 100_000) -> np.ndarray:
        """``sizes`` of passages; they are kept apart, as most come once."""
        return self.wholes.sizes(texts, self, bound)


@lru_cache(1)
def _of_worker(codes: tuple[str, ...], samples: tuple[bytes, ...], level: int, run: str) -> Languages:
    """The compressors of a worker: its tasks of one run share them, and the sizes met."""
    return Languages(list(codes), list(samples), level, run)


def sample_languages(samples: DataFrame, labelled: DataFrame | None = None, *, bound: int = 15_000, size: int = 16_000, most: int = 4000) -> Languages:
    """The compressors of the labelled sample sentences.

    At most about ``most`` sample sentences of each language are read, chosen by
    a hash. With ``labelled`` (columns id,
    label, text) each dictionary is lengthened to about ``size`` bytes by
    sentences from at most ``bound`` of its rows, chosen by a hash of the id,
    whose label agrees with a clear result of the sample sentences alone.
    """
    known = samples.where("lang is not null and text is not null")
    # The same share of each language's sentences, whichever it has.
    scale = 1 << 30
    shares = known.groupBy("lang").agg((F.lit(0.95 * most * scale) / F.count(F.lit(1))).alias("share"))
    all_of = (F.col("share") >= 0.95 * scale) | (F.pmod(F.xxhash64("sample_id", "text"), F.lit(scale)) < F.col("share"))
    rows = known.join(F.broadcast(shares), "lang").where(all_of).orderBy("lang", "sample_id", "text").collect()
    by: dict[str, list[str]] = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r.text.lower())
    codes = sorted(by)
    first = Languages(codes, ["\n".join(by[c]).encode() for c in codes])
    if labelled is None or not codes:
        return first
    chosen = hash_sample(labelled.where("label is not null and text is not null"), ["id"], bound, labelled.count()).orderBy("id").collect()
    found = [(label_code(r.label), t) for r in chosen for _, _, t, n in passages(readable(r.text)) if n >= 8]
    found = [(c, t) for c, t in dict.fromkeys(found) if c in by]
    sizes = first.sizes([t.encode() for _, t in found])
    best, margin = decide(sizes)
    more: dict[str, list[str]] = {c: [] for c in codes}
    room = dict.fromkeys(codes, size)
    for (c, t), b, m in zip(found, best, margin):
        if codes[b] == c and m >= 0.2 and room[c] > 0:
            more[c].append(t)
            room[c] -= len(t.encode()) + 1
    return Languages(codes, ["\n".join([*more[c], *by[c]]).encode() for c in codes])


def decide(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language of the smallest size of each row, and its margin to the next as a share of that."""
    if sizes.shape[1] < 2:
        return np.zeros(len(sizes), int), np.ones(len(sizes))
    ordered = np.sort(sizes, axis=1)
    return sizes.argmin(axis=1), (ordered[:, 1] - ordered[:, 0]) / np.maximum(1, ordered[:, 1])


@dataclass
class _Rows:
    """What ``classify`` finds: an entry a passage or window, in order."""

    passage: np.ndarray  #: number in ``flat``
    owner: np.ndarray  #: number of the text
    begin: np.ndarray  #: first word in the passage
    end: np.ndarray  #: end word in the passage
    best: np.ndarray  #: language
    margin: np.ndarray
    gain: np.ndarray  #: over the text's language
    fresh: np.ndarray  #: words that aren't in the row before
    window: np.ndarray
    weight: np.ndarray  #: words of each text in clear passages, by language
    clear: list[str]  #: the readable texts
    flat: list[tuple[int, int, str, list[str]]]  #: the passages of all texts
    own: np.ndarray  #: the text of each passage


def classify(texts: list[str | None], languages: Languages) -> tuple[list[str], list[tuple]]:
    """The readable texts, and rows (text, first and end char of a passage, first and end word in it, words, language, margin, gain over the text's language, words not in the row before, window)."""
    r = _classified(texts, languages)
    spans = [r.flat[j] for j in r.passage.tolist()]
    return r.clear, list(zip(r.owner.tolist(), (p[0] for p in spans), (p[1] for p in spans), *(c.tolist() for c in (r.begin, r.end, r.end - r.begin, r.best, r.margin, r.gain, r.fresh, r.window))))


def _classified(texts: list[str | None], languages: Languages) -> _Rows:
    """The languages of the passages of texts.

    A passage of as many words as two clauses is glanced at in windows, and
    looked at in every window around those that aren't in its language (or are
    unclear, where it is so itself); it is parted into windows where one is
    clearly in another language or it has no clear one. The sizes of a long run
    of words are the means of its windows, as a long text soon compresses by
    itself. The language of a text is the one with most words in clear passages.
    """
    clear = [readable(t) if t else "" for t in texts]
    parts = list(map(_parted, clear))
    flat = list(chain.from_iterable(parts))
    own = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), int, len(parts)))
    n_words = np.array([len(p[3]) for p in flat], int)
    sizes = np.zeros((len(flat), len(languages.codes)), np.int32)
    short = np.flatnonzero(n_words <= _RUN)
    sizes[short] = languages.whole_sizes([flat[j][2] for j in short.tolist()])
    again = np.flatnonzero(n_words >= 2 * _WINDOW)
    words = [flat[j][3] for j in again.tolist()]
    cuts = list(map(_windows, n_words[again].tolist()))
    count = np.array([len(c[0]) for c in cuts], int)
    join = " ".join
    seen = languages.known_sizes([join(w[part]) for w, (_, windows) in zip(words, cuts) for part in windows])
    of, first = np.repeat(np.arange(len(again)), count), np.fromiter(chain.from_iterable(c[0] for c in cuts), int, int(count.sum()))
    long = n_words[again] > _RUN
    if len(again):
        means = np.add.reduceat(seen, np.cumsum(count) - count) / count[:, None]
        sizes[again[long]] = np.round(means[long])
    best, margin = decide(sizes)
    seen_best, seen_margin = decide(seen)
    narrow = margin[again] < np.where(long, REJECT, 0.3)
    suspect = (seen_best != best[again][of]) | narrow[of] & (seen_margin < REJECT)
    # Every window between a suspect one and its neighbours.
    closer = np.unique(np.concatenate([of[suspect] * (1 << 32) + first[suspect] + d for d in (-2, -1, 1, 2)])) if suspect.any() else np.zeros(0, int)
    near_of, near_first = closer >> 32, closer & ((1 << 32) - 1)
    real = near_first <= np.maximum(0, n_words[again][near_of] - _WINDOW)
    real &= ~np.isin(closer, of * (1 << 32) + first)
    near_of, near_first = near_of[real], near_first[real]
    near = languages.known_sizes([join(words[g][i : i + _WINDOW]) for g, i in zip(near_of.tolist(), near_first.tolist())])
    of, first, inner = np.concatenate([of, near_of]), np.concatenate([first, near_first]), np.concatenate([seen, near])
    inner_best, inner_margin = decide(inner)
    whole, place = best[again][of], np.arange(len(inner))
    apart = (inner_best != whole) & (inner_margin >= SECOND) & (inner[place, whole] - inner[place, inner_best] >= _GAIN)
    parted = narrow | long & np.isin(np.arange(len(again)), of[: len(suspect)][suspect])
    parted[of[apart]] = True
    whole_one = np.ones(len(flat), bool)
    whole_one[again[parted]] = False
    taken = parted[of]
    # The rows: passages that stay whole, and the windows of the others, in order.
    passage = np.concatenate([np.flatnonzero(whole_one), again[of[taken]]])
    begin = np.concatenate([np.zeros(int(whole_one.sum()), int), first[taken]])
    end = np.concatenate([n_words[whole_one], np.minimum(first[taken] + _WINDOW, n_words[again[of[taken]]])])
    window = np.arange(len(passage)) >= whole_one.sum()
    sizes = np.concatenate([sizes[whole_one], inner[taken]])
    order = np.lexsort((begin, passage))
    passage, begin, end, window, sizes = passage[order], begin[order], end[order], window[order], sizes[order]
    best, margin = decide(sizes)
    owner = own[passage]
    inside = np.zeros(len(passage), bool)
    inside[1:] = (passage[1:] == passage[:-1]) & (begin[1:] < end[:-1])
    fresh = end - begin
    fresh[1:] = np.where(inside[1:], end[1:] - end[:-1], fresh[1:])
    weight = np.zeros((len(texts), len(languages.codes)))
    good = margin >= REJECT
    np.add.at(weight, (owner[good], best[good]), fresh[good])
    main = weight.argmax(axis=1)
    gain = sizes[np.arange(len(passage)), main[owner]] - sizes[np.arange(len(passage)), best] if len(passage) else best
    # A window in another language counts where the one before or after it is in that language, too.
    same = inside.copy()
    same[1:] &= best[1:] == best[:-1]
    gain = np.where(window & ~(same | np.append(same[1:], False)[: len(same)]), 0, gain)
    return _Rows(passage, owner, begin, end, best, margin, gain, fresh, window, weight, clear, flat, own)


# Hesitations that are also ordinary words of one of the languages.
_ALSO_WORDS = ("um", "er", "este", "ben", "hum")
_SILENT = frozenset(h + mark for h in HESITATIONS for mark in (",", "...", "…", *(() if h in _ALSO_WORDS else ("", ".", "?", "!", ";", ":"))))
_CONTENT = re.compile(r"\w\S*")


class _Content(dict):
    """1 for a word that is no hesitation, else 0; one that is also a word is a hesitation before a comma or an ellipsis."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        found = _CONTENT.search(word)
        self[word] = n = int(found is not None and found.group() not in _SILENT)
        return n


_is_content = _Content().__getitem__


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without the search for cycles: the many lists of a batch hold none, and go by their counts."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _record_rows(batches: Iterator[pa.RecordBatch], languages: Languages) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, language, confidence, words, mixed), one a language that a record holds, one without where none is clear."""
    codes = pa.array(languages.codes, pa.string())
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            with _uncollected():
                r = _classified(batch.column(2).to_pylist(), languages)
            n, every = batch.num_rows, np.arange(batch.num_rows)
            words = np.bincount(r.own, [sum(map(_is_content, p[3])) for p in r.flat], n).astype(np.int32)
            widest = np.zeros(n)
            np.maximum.at(widest, r.owner, r.margin)
            good = r.margin >= REJECT
            cell = r.owner[good], r.best[good]
            total = np.zeros_like(r.weight)
            np.add.at(total, cell, r.fresh[good] * r.margin[good])
            confidence = total / np.maximum(1, r.weight)
            # A further language needs a clause of its own, clearly apart from the text's language.
            clause = (r.end - r.begin >= LEAST_WORDS) & (r.margin >= SECOND) & (r.gain >= _GAIN)
            further = np.zeros(r.weight.shape, bool)
            further[r.owner[clause], r.best[clause]] = True
            main, held = r.weight.argmax(axis=1) if n else every, r.weight.any(axis=1)
            further[every, main] = False
            others, language = np.nonzero(further)
            rank = np.lexsort((language, -r.weight[others, language], others))
            others, language = others[rank], language[rank]
            place = np.concatenate([every, others])
            best = np.concatenate([main, language])
            sure = np.concatenate([np.where(held, confidence[every, main], widest), confidence[others, language]])
            order = np.argsort(place, kind="stable")
            place, best, sure = place[order], best[order], sure[order]
            at_row = pa.array(place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at_row), batch.column(1).take(at_row), codes.take(pa.array(best, mask=~held[place])), pa.array(sure), pa.array(words[place]), pa.array(further.any(axis=1)[place])],
                names=["id", "label", "language", "confidence", "words", "mixed"],
            )


def _passage_rows(batches: Iterator[pa.RecordBatch], languages: Languages) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, passage_no, language, confidence, text): neighbouring passages of a language make one."""
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH):
            batch = whole.slice(at, _BATCH)
            with _uncollected():
                clear, rows = classify(batch.column(2).to_pylist(), languages)
            merged: list[list] = []
            spans: tuple[tuple, list[tuple[int, int]]] = ((), [])
            for i, a, z, first, end, _, lang, margin, gain, n, window in rows:
                if window:
                    if spans[0] != (i, a):
                        spans = (i, a), word_spans(clear[i], a, z)
                    a, z = spans[1][first][0], spans[1][end - 1][1]
                # A window of the text's language has no gain; another language must be as clear as a second one.
                if margin < REJECT or window and gain and (margin < SECOND or gain < _GAIN):
                    continue
                if merged and merged[-1][0] == i and merged[-1][3] == lang:
                    merged[-1][2] = max(z, merged[-1][2])
                    merged[-1][4] += n
                    merged[-1][5] += n * margin
                else:
                    a = max(a, merged[-1][2]) if merged and merged[-1][0] == i else a
                    merged.append([i, a, z, lang, n, n * margin])
            numbers: dict[int, int] = {}
            place, number = pa.array([m[0] for m in merged], pa.int64()), []
            for m in merged:
                numbers[m[0]] = numbers.get(m[0], -1) + 1
                number.append(numbers[m[0]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(place), batch.column(1).take(place), pa.array(number, pa.int32()), pa.array([languages.codes[m[3]] for m in merged], pa.string()), pa.array([m[5] / m[4] for m in merged], pa.float64()), pa.array([clear[m[0]][m[1] : m[2]] for m in merged], pa.string())],
                names=["id", "label", "passage_no", "language", "confidence", "text"],
            )


def record_languages(records: DataFrame, languages: Languages) -> DataFrame:
    """Rows (id, label, language, confidence, words, mixed) of records (id, label, text).

    One row for the language of a text; one more, and ``mixed``, for each other
    language in which a clause of at least six words clearly is. ``confidence``
    is the mean margin between the smallest and the next compressed size as a
    share of the latter, from 0 to 1. ``words`` counts the words that are no
    hesitations. A text that is rejected, its margins being narrow, has a row
    without a language and with the widest of its margins; null and blank texts
    have one with the confidence 0. Repeated records have their rows again;
    nothing is shuffled.
    """
    kind = records.schema["id"].dataType.simpleString()
    return records.select("id", "label", "text").mapInArrow(lambda b: _record_rows(b, languages), f"id {kind}, label string, language string, confidence double, words int, mixed boolean")


def passage_languages(records: DataFrame, languages: Languages) -> DataFrame:
    """Rows (id, label, passage_no, language, confidence, text): each record's text in stretches of one language.

    The text is the readable one, in lower case. The cases are those of ``record_languages``.
    """
    kind = records.schema["id"].dataType.simpleString()
    return records.select("id", "label", "text").mapInArrow(lambda b: _passage_rows(b, languages), f"id {kind}, label string, passage_no int, language string, confidence double, text string")


def mislabelled(records: DataFrame, languages: Languages) -> DataFrame:
    """Rows (id, language): the records without a language, with a wrong one, or with two.

    Of records with at least six words: the true language where the label names
    none or another; each of them where the text holds several. A record that
    comes twice counts once.
    """
    found = record_languages(records, languages).where((F.col("words") >= LEAST_WORDS) & F.col("language").isNotNull())
    forms = F.create_map(*(F.lit(x) for name, code in _NAMED.items() for x in (name, code)))
    bare = F.lower(F.btrim(F.coalesce("label", F.lit("")), F.lit(" .\t\n")))
    named = F.coalesce(F.try_element_at(forms, bare), F.try_element_at(forms, F.btrim(F.get(F.split(bare, "[-_ ]"), F.lit(0)), F.lit("."))))
    wrong = F.col("mixed") | named.isNull() | (named != F.col("language"))
    return found.where(wrong).select("id", "language").distinct()
