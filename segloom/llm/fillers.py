"""Annotations, times and fillers in transcript text.

Hesitations are a small fixed list; which other short phrases may serve as
fillers is learned from where they stand: a filler is set off by commas in the
middle of a sentence far more often than an ordinary word is. Whether such a
phrase is a filler where it stands is decided for each occurrence: by the marks
around it, by whether the words around it also follow each other without it,
and by how often the phrase is set off in the segment's language.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, islice
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.functions.binding import let
from segloom.session import hash_sample, materialize

# Sounds of hesitation in the five languages of the data.
HESITATIONS = (
    *("um", "uh", "uhm", "er", "erm", "hmm", "hm", "mm", "mmm", "mhm", "mm-hmm", "uh-huh", "ah", "eh"),
    *("euh", "heu", "bah", "ben", "hein"),
    *("äh", "ähm", "öh", "öhm"),
    *("este", "hã", "ahn", "hum", "hã-hã"),
)

#: Bracketed or starred annotations, musical notes.
ANNOTATION = r"\[[^\]]*\]|\([^)]*\)|\{[^}]*\}|<[^>]*>|\*[^*]*\*|[♪♫♩♬]+"
#: Times, with what surrounds them: [00:01:02], (03:32), <00:01:02>, 00:01:02 - , 01:43:28,169 -->
TIME = r"[\[(<]?\d+:\d\d(?::\d\d)?(?:[.,:]\d+)?[\])>]?(?:\s*-+>?(?=\s|$))?"
#: A label in front of the text: >> X: , - X - , X:
LABEL = r">>[^:\n]{1,60}:|-\s+[^\n]{1,60}?\s+-(?=\s|$)|\p{L}[\p{L}\p{N}_#.'\-]*(?:[ ,]+[\p{L}\p{N}_#.'()\-]+){0,4}\s*:(?=\s|$)"
_FRONT = rf"(?U)^(?:\s|{TIME}|{ANNOTATION})*(?:{LABEL})"


def _alternation(phrases: tuple[str, ...]) -> str:
    longest_first = sorted({p.lower() for p in phrases}, key=lambda p: (-len(p), p))
    return "|".join(re.escape(p).replace(r"\ ", r"\s+") for p in longest_first)


def without_marks(content: Column) -> Column:
    """``content`` without label, times and annotations; null gives an empty text."""
    # The long patterns are only tried where a sign of them is there.
    labelled = lambda t: F.when(t.contains(":") | t.rlike(r"^\s*[-(\[<]"), F.regexp_replace(t, _FRONT, " ")).otherwise(t)
    signs = lambda t: reduce(or_, (t.contains(c) for c in "[({<*:♪♫♩♬"))  # no time is without a colon
    marked = lambda t: F.when(signs(t), F.regexp_replace(t, rf"(?U)(?=[\[({{<*♪♫♩♬\d])(?:{ANNOTATION}|{TIME})", " ")).otherwise(t)
    # A label, too, has one of the signs or a hyphen; most texts have none and stay as they are.
    return let(F.coalesce(content, F.lit("")), lambda t: F.when(signs(t) | t.contains("-"), let(labelled(t), marked)).otherwise(t))


@dataclass(frozen=True)
class Fillers:
    """What ``learn_fillers`` found.

    ``phrases`` may be fillers. ``prior`` is, for (phrase, language), the logit
    of the share of its occurrences that are fillers. ``weights`` are those of
    ``CONTEXT`` after a constant. ``pairs`` has the words that follow each other
    in the corpus (phrase, n).
    """

    phrases: tuple[str, ...] = HESITATIONS
    prior: dict[tuple[str, str], float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-4.0, 2.5, 1.5, 2.5, 2.5, 1.5, 4.0, 1.5, -2.0)
    pairs: DataFrame | None = None

    def score(self, phrase: str, language: str, context: tuple[float, ...]) -> float:
        """Above 0 for a filler, ``context`` being the values of ``CONTEXT``."""
        prior = self.prior.get((phrase, language), self.prior.get((phrase, ""), 0.0))
        return self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], context)) + prior

    def in_silence(self, language: str) -> tuple[str, ...]:
        """The phrases that are fillers where nothing but such phrases is said."""
        alone = tuple(float(name in ("left_start", "right_stop", "alone")) for name in CONTEXT)
        return tuple(p for p in self.phrases if p in HESITATIONS or self.score(p, language, alone) > 0)


#: What is seen of an occurrence: the marks before and after it, whether its neighbours are known to follow each other,
#: whether it has none in its sentence, whether it is said again at once.
CONTEXT = ("left_comma", "left_start", "right_comma", "right_ellipsis", "right_stop", "bridged", "alone", "again")


def without_phrases(text: Column, phrases: tuple[str, ...]) -> Column:
    """``text`` without the phrases and the commas that set them off."""
    if not phrases:
        return text
    word = rf"(?iuU)(?<![\p{{L}}\p{{N}}'’-])(?:{_alternation(phrases)})(?![\p{{L}}\p{{N}}'’-])"
    return F.regexp_replace(text, rf"{word}(?:\.\.\.|…|[,;.!?]+(?=\s*$)|,)?", " ")


def language_of(label: Column) -> Column:
    """The first two letters of a language label in lower case, empty for none."""
    return F.coalesce(F.lower(F.substring(F.ltrim(label), 1, 2)), F.lit(""))


def holds_speech(content: Column, fillers: Fillers, language: Column | None = None) -> Column:
    """Whether a letter or digit is left without label, times, annotations and fillers.

    A text that consists of possible fillers alone holds none, unless one of
    them isn't a filler in its language even so.
    """
    single, double = [p for p in fillers.phrases if " " not in p], tuple(p for p in fillers.phrases if " " in p)
    openings = sorted({p.split()[0] for p in double})
    lists: dict[tuple[str, ...], list[str]] = {}
    for code in sorted({code for _, code in fillers.prior} - {""}):
        lists.setdefault(fillers.in_silence(code), []).append(code)

    def kept(text: Column) -> Column:
        left = without_phrases(text, fillers.in_silence(""))
        for phrases, codes in lists.items():
            if language is not None and phrases != fillers.in_silence(""):
                left = F.when(language.isin(*codes), without_phrases(text, phrases)).otherwise(left)
        return left.rlike(r"[\p{L}\p{N}]")

    # A text that ends with a word, which is no part of a filler, holds speech: a label, a time or an annotation would
    # end after it. So does one that begins with such a word and has no colon (so no label, no time). The patterns are
    # for the others.
    last = F.rtrim(F.substring_index(F.rtrim(content), " ", -1), F.lit(",.!?"))
    parts = tuple(w for p in fillers.phrases for w in p.split())
    ordinary = F.lower(last).rlike(rf"^(?!(?:{_alternation(parts)})\z)['’]*[a-zà-öø-ÿœ][a-zà-öø-ÿœ'’]*\z")
    first = F.rtrim(F.substring_index(F.ltrim(content), " ", 1), F.lit(",.!?"))
    two = content.rlike(rf"(?iuU)^\s*(?:{_alternation(double)})(?![\p{{L}}\p{{N}}'’-])") if double else F.lit(False)
    plain = lambda w: w.rlike(r"^['’]*\p{L}[\p{L}'’]*\z") & ~w.isin(single) & ~content.contains(":") & ~(w.isin(openings) & two)
    return F.coalesce(ordinary, F.lit(False)) | F.coalesce(let(F.lower(first), plain), F.lit(False)) | let(without_marks(content), kept)


def _fit(features: np.ndarray, target: np.ndarray, steps: int = 400, rate: float = 0.5, times: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression, both classes weighing the same; ``times`` is how often each row was seen."""
    times = np.ones(len(features)) if times is None else times
    x = np.column_stack([np.ones(len(features)), features])
    share = times * np.where(target == 1, 0.5 / max(1, times @ target), 0.5 / max(1, times @ (1 - target)))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= rate * (x.T @ (share * (p - target)) + 1e-4 * w)
    return w


_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_TOKENS = re.compile(_WORD)
_BETWEEN = re.compile(rf"(?<=,)\s({_WORD}(?:\s{_WORD})?)(?=,\s)")
_BEFORE_END = re.compile(rf"(?<=[.!?])\s({_WORD}(?:\s{_WORD})?)(?=\.\.\.\s*$)")


class _Stretches(dict):
    """The words of stretches of text."""

    def __missing__(self, stretch: str) -> tuple[str, ...]:
        self[stretch] = found = tuple(_TOKENS.findall(stretch))
        return found


def _phrase_counts(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Rows (language, phrase, total, between, trailing, edge): partial counts of the phrases of one or two words.

    They stand between commas, before an ellipsis at the end, or between a
    comma and the text's beginning or end.
    """
    total: dict[str, Counter] = {}
    between, trailing, edge = Counter(), Counter(), Counter()
    # No word holds white space, so the words of a stretch are the same wherever it comes.
    known = _Stretches()

    def rows() -> pa.RecordBatch:
        keys, numbers = [], []
        for code, counts in total.items():
            single: Counter = Counter()
            for (first, second), n in counts.items():
                if not first:
                    continue  # from text to text
                single[first] += n
                if second:
                    keys.append((code, f"{first} {second}"))
                    numbers.append(n)
            keys += [(code, w) for w in single]
            numbers += single.values()
        columns = [pa.array([k[j] for k in keys], pa.string()) for j in range(2)]
        columns += [pa.array(numbers, pa.int64()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (between, trailing, edge))]
        return pa.RecordBatch.from_arrays(columns, names=["language", "phrase", "total", "between", "trailing", "edge"])

    for batch in batches:
        # The words of a batch's texts by language, an empty one after each text.
        tokens: dict[str, list[str]] = {}
        for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = tokens.get(label)
            if own is None:
                own = tokens[label] = []
            own.extend(chain.from_iterable(map(known.__getitem__, t.split())))
            own.append("")
            first = t.find(",")
            if first >= 0:
                last = t.rfind(",")
                if last > first and (found := _BETWEEN.findall(t)):
                    between.update([(label, re.sub(r"\s+", " ", m)) for m in found])
                for part in (t[:first].strip(), t[last + 1 :].strip(" .!?…")):
                    if len(part) < 20:
                        edge[label, part] += 1
            if "..." in t:
                trailing.update((label, re.sub(r"\s+", " ", m)) for m in _BEFORE_END.findall(t))
        for label, own in tokens.items():
            counts = total.get(label)
            if counts is None:
                counts = total[label] = Counter()
            # Each word with the next one, the last with none.
            counts.update(zip(own, islice(own, 1, None)))
        if len(known) > most:
            known.clear()
        if sum(map(len, total.values())) > most:
            yield rows()
            total.clear(), between.clear(), trailing.clear(), edge.clear()
    yield rows()


#: The largest share of a phrase's occurrences that are taken for fillers beforehand, and its logit.
_MOST_SHARE = 0.98
_MOST_PRIOR = math.log(_MOST_SHARE / (1 - _MOST_SHARE))


def _context(text: str, spans: list[tuple[int, int]], words: list[str], i: int, n: int, skipped: frozenset[str]) -> tuple[tuple[float, ...], str | None]:
    """The values of ``CONTEXT`` (bridged still 0) of the ``n`` words from word ``i``, and the pair of words around them."""
    before = text[spans[i - 1][1] : spans[i][0]] if i else "."
    after = text[spans[i + n - 1][1] : spans[i + n][0]] if i + n < len(words) else text[spans[i + n - 1][1] :].strip() or "."
    opened = i == 0 or any(c in ".!?…" for c in before)
    ellipsis = after.lstrip().startswith(("...", "…"))
    closed = not ellipsis and (any(c in ".!?…" for c in after) or i + n >= len(words))
    a, z = i - 1, i + n
    while a >= 0 and words[a] in skipped:
        a -= 1
    while z < len(words) and words[z] in skipped:
        z += 1
    first, last = None if opened or a < 0 else words[a], None if ellipsis or closed or z >= len(words) else words[z]
    again = words[i + n : i + 2 * n] == words[i : i + n] or i >= n and words[i - n : i] == words[i : i + n]
    marked = lambda gap: any(not c.isspace() for c in gap)
    values = (not opened and marked(before), opened, not ellipsis and not closed and marked(after), ellipsis, closed, False, first is None and last is None, again)
    return tuple(map(float, values)), f"{first} {last}" if first is not None and last is not None else None


def _places(text: str, phrases: frozenset[str]) -> tuple[list[tuple[int, int]], list[str], list[tuple[int, int]]]:
    """Where the words of a text are, the words, and (first word, words) of each of ``phrases`` in it, the longer first."""
    spans = [m.span() for m in _TOKENS.finditer(text)]
    words = [text[a:z].lower() for a, z in spans]
    found, i = [], 0
    while i < len(words):
        two = i + 1 < len(words) and f"{words[i]} {words[i + 1]}" in phrases and text[spans[i][1] : spans[i + 1][0]].isspace()
        n = 2 if two else int(words[i] in phrases)
        if n:
            found.append((i, n))
        i += n or 1
    return spans, words, found


def _fit_context(segments: DataFrame, pairs: DataFrame, phrases: tuple[str, ...], sure: frozenset[str], bound: int) -> tuple[float, ...] | None:
    """The weights of ``CONTEXT``, fitted on occurrences in at most ``bound`` segments: sure hesitations against ordinary words."""
    ordinary = frozenset(w for p in phrases for w in (p, *p.split()))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                spans, words, _ = _places(text, frozenset())
                for i, word in enumerate(words):
                    if word in sure or word not in ordinary and zlib.crc32(f"{word}{i}{len(text)}".encode()) % 8 == 0:
                        out.append((word in sure, *_context(text, spans, words, i, 1, sure)))
            columns = [pa.array([float(o[0]) for o in out], pa.float64()), pa.array([list(o[1]) for o in out], pa.list_(pa.float64())), pa.array([o[2] for o in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["filler", "context", "phrase"])

    texts = segments.where("content is not null and segment_id is not null")
    sample = hash_sample(texts, ["segment_id"], bound, segments.count()).select(without_marks(F.col("content")).alias("t"))
    found = sample.mapInArrow(seen, "filler double, context array<double>, phrase string")
    # All values are 0 or 1: what reaches the driver is one row a combination of them, with its count.
    seen_with = found.join(pairs.select("phrase", F.lit(1.0).alias("bridged")), "phrase", "left").select("filler", "context", F.coalesce("bridged", F.lit(0.0)).alias("bridged"))
    rows = sorted(seen_with.groupBy("filler", "context", "bridged").count().collect())
    target, times = (np.array([r[c] for r in rows], float) for c in ("filler", "count"))
    if len(set(target)) < 2:
        return None
    x = np.array([r.context for r in rows], float)
    x[:, CONTEXT.index("bridged")] = [r.bridged for r in rows]
    constant, *weights = (float(v) for v in _fit(x, target, steps=800, times=times))
    # Without any sign around it a word is no filler, however often it is one elsewhere.
    return (min(constant, -_MOST_PRIOR), *weights)


def learn_fillers(segments: DataFrame, bound: int = 20_000, least: int = 8) -> Fillers:
    """What may be a filler, and where it is one.

    Phrases of one or two words are counted over all segments and classified by
    a logistic regression on how often they stand between two commas inside a
    segment, how often before an ellipsis, and how long they are; hesitations
    are its positive examples, all other phrases its negative ones. It is fitted
    on the hesitations and at most ``bound`` phrases, chosen by a hash, and
    applied to all; a phrase seen fewer than ``least`` times stays unclassified,
    two words of which one is a filler itself make none. A second regression
    tells the places of fillers from those of ordinary words; it is fitted on
    the words of at most ``bound`` segments, chosen by a hash. Columns read:
    segment_id, content, language. An empty table gives the hesitations alone.
    """
    label = language_of(F.col("language")) if "language" in segments.columns else F.lit("")
    texts = segments.where("content is not null").select(F.lower(without_marks(F.col("content"))).alias("t"), label.alias("language"))
    parts = texts.mapInArrow(_phrase_counts, "language string, phrase string, total bigint, between bigint, trailing bigint, edge bigint")
    sums = [F.sum(c).alias(c) for c in ("total", "between", "trailing", "edge")]
    spoken = materialize(parts.groupBy("language", "phrase").agg(*sums), "phrases")
    counted = spoken.groupBy("phrase").agg(*sums).where("total >= 2")
    counted = materialize(counted, "phrases")
    usual = counted.where(F.col("total") >= least)
    hesitant = F.col("phrase").isin(*HESITATIONS)
    others = hash_sample(usual.where(~hesitant), ["phrase"], bound, usual.count())
    sample = sorted(usual.where(hesitant).unionByName(others).collect(), key=lambda r: r.phrase)
    known = np.array([r.phrase in HESITATIONS for r in sample], float)
    if not known.any():
        return Fillers()
    w = _fit(np.array([[8 * r.between / r.total, 8 * r.trailing / r.total, min(len(r.phrase), 20) / 20] for r in sample], float), known)
    value = F.lit(float(w[0])) + float(w[1]) * 8 * F.col("between") / F.col("total") + float(w[2]) * 8 * F.col("trailing") / F.col("total") + float(w[3]) * F.least(F.length("phrase"), F.lit(20)) / 20
    set_off = (F.col("between") + F.col("trailing")) / F.col("total")
    found = {r.phrase for r in usual.where((set_off >= 0.2) & (value >= 0)).select("phrase").collect()} | set(HESITATIONS)
    phrases = tuple(sorted(p for p in found if " " not in p or not found.intersection(p.split())))
    shares = {r.phrase: (r.between + r.trailing + r.edge) / r.total for r in sample if r.phrase in HESITATIONS}
    usual_share = float(np.median([s for s in shares.values() if s > 0] or [0.3]))
    sure = frozenset(p for p, s in shares.items() if s >= 0.8 * usual_share)
    # How often each phrase is a filler in each language: its share of places between marks against that of hesitations.
    held: dict[str, dict[str, tuple[int, int]]] = {}
    for r in spoken.where(F.col("phrase").isin(*phrases)).collect():
        held.setdefault(r.phrase, {})[r.language] = (r.total, r.between + r.trailing + r.edge)
    prior = {}
    for phrase, by in held.items():
        total, marked = (sum(v[j] for v in by.values()) for j in (0, 1))
        for code, (n, m) in [("", (total, marked)), *by.items()]:
            share = min(_MOST_SHARE, max(1 - _MOST_SHARE, (m + 4 * marked / total) / (n + 4) / usual_share))
            prior[phrase, code] = math.log(share / (1 - share))
    pairs = counted.where("phrase like '% %'").select("phrase", F.col("total").alias("n"))
    weights = _fit_context(segments, pairs, phrases, sure, bound)
    return Fillers(phrases, prior, weights or Fillers.weights, pairs)


def filler_places(texts: DataFrame, key: str, text: str, language: str, fillers: Fillers) -> DataFrame:
    """Rows (key, cuts): where each text's fillers begin and end, in order; texts without fillers have no row."""
    kind = texts.schema[key].dataType.simpleString()
    phrases, model = frozenset(fillers.phrases), Fillers(fillers.phrases, fillers.prior, fillers.weights)
    sure = frozenset(p for p in HESITATIONS if model.prior.get((p, ""), 0.0) > 0)
    bridged = model.weights[1 + CONTEXT.index("bridged")]
    trail = re.compile(r"\.\.\.|…|[,;.!?]+(?=\s*$)|,")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, t, code in zip(*(c.to_pylist() for c in batch.columns)):
                spans, words, places = _places(t, phrases)
                for i, n in places:
                    context, pair = _context(t, spans, words, i, n, sure)
                    a, z = spans[i][0], spans[i + n - 1][1]
                    after = trail.match(t, z)
                    # Between two commas, whose words follow each other without it, it takes both along.
                    wide = spans[i - 1][1] if i and context[0] and context[2] and t[spans[i - 1][1] : a].strip() == "," else a
                    out.append((own, a, after.end() if after else z, wide, model.score(" ".join(words[i : i + n]), code, context), pair or f"\0{own}{a}"))
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], k) for j, k in enumerate(kinds)], names=["key", "a", "z", "wide", "score", "phrase"])

    possible = F.lower(text).rlike(rf"(?U)(?<![\p{{L}}\p{{N}}'’-])(?:{_alternation(fillers.phrases)})(?![\p{{L}}\p{{N}}'’-])")
    rows = texts.where(possible).select(F.col(key).alias("key"), text, language)
    seen = rows.mapInArrow(found, f"key {kind}, a int, z int, wide int, score double, phrase string")
    if fillers.pairs is None:
        judged = seen.withColumn("n", F.lit(None).cast("bigint"))
    else:
        judged = seen.join(fillers.pairs, "phrase", "left")
    score = F.col("score") + F.when(F.col("n").isNotNull(), F.lit(float(bridged))).otherwise(0.0)
    cut = F.struct(F.when(F.col("n").isNotNull(), F.col("wide")).otherwise(F.col("a")).alias("a"), "z")
    return judged.where(score > 0).groupBy(F.col("key").alias(key)).agg(F.array_sort(F.collect_list(cut)).alias("cuts"))


def clean_texts(rows: DataFrame, key: str, content: str, language: str, fillers: Fillers) -> DataFrame:
    """``rows`` with ``text``: speech only, its white space single.

    ``key`` must be unique. A row whose content is null or nothing but marks
    and fillers has an empty text. Each occurrence of a possible filler is
    decided by itself: a word that is a filler elsewhere stays where it is an
    ordinary word.
    """
    bare = materialize(rows.withColumns({"__text": without_marks(F.col(content)), "__language": language_of(F.col(language))}), "bare")
    joined = bare.join(filler_places(bare, key, "__text", "__language", fillers), key, "left")
    edges = lambda cuts: F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["z"]))
    stops = lambda cuts: F.concat(F.transform(cuts, lambda c: c["a"]), F.array(F.length("__text")))
    kept = F.zip_with(edges(F.col("cuts")), stops(F.col("cuts")), lambda a, z: F.substring(F.col("__text"), a + 1, F.greatest(F.lit(0), z - a)))
    text = F.when(F.col("cuts").isNull(), F.col("__text")).otherwise(F.array_join(kept, " "))
    text = F.regexp_replace(text, r"(?U)(\b[\p{L}']+)(?:\s*[-—–]+|\.\.\.)\s+\1\b", "$1")
    text = F.regexp_replace(text, r"(?U)[\s]+", " ")
    text = F.trim(F.regexp_replace(text, r"^[ ,;.\-—–…]+|(?<=[.!?]) [.,;…]+$|[ ,;]+$", ""))
    return joined.withColumn("text", text).drop("__text", "__language", "cuts")
