"""Texts that lost their end.

Storage limits show as lengths at which a source has far more texts than at the
lengths around them, once lengths are computed as the source may have counted:
characters, bytes, UTF-16 units, escaped for HTML or JSON, with other line ends.
A text that stands at such a limit without a closing mark is cut. The endings of
the others are judged by how the corpus goes on: a text without a closing mark
is complete where its last two words end sentences (or list lines) elsewhere,
and broken where the corpus always goes on after them or never has them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.session import materialize

ENCODINGS = ("chars", "utf8", "utf16", "html", "html_utf8", "json", "json_utf8", "json_ascii", "crlf", "crlf_utf8")

_INVISIBLE = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff\ufe0f\U0001f3fb-\U0001f3ff]+")
_PICTURE = "[\U0001f000-\U0001faff\u2600-\u27bf\u2b00-\u2bff\ufe0f]"
#: What may follow a complete text.
_AFTER = re.compile(
    rf"(?:\s+|{_PICTURE}|[:;]-?[)(DP]|</?\w+[^<>]*>|\s*\|\s*\w+(?:\s+\w+){{0,2}}|(?:(?<=\s)|^)#\w+|(?:^|\n)\s*[—–-]+\s*[^\W\d_][\w'.-]*(?:\s+[^\W\d_][\w'.-]*){{1,3}}|(?:(?<=\s)|^)https?://[^\s/]+/[^\s/]+/[^\s/]{{5,}})$"
)
#: What was put after a break, or is itself broken.
_BREAK = re.compile(
    r"(?:[\[(](?:\.\.\.|…|cont\w*|more|mor?|read\s*m?\w*|see\s*m?\w*|suite|weiter\w*|m[áa]s|mais)[^\])\n]{0,20}[\])]?|<[a-zA-Z/][^<>\n]*|&#?\w{0,8}|�+|(?:(?<=\s)|^)https?://\S*)$", re.I
)
_CLOSED = re.compile(r"[.!?][\"'”’»)\]]*$")
_ELLIPSIS = re.compile(r"(?:…|\.\.\.)[\"'”’»)\]]*$")
_CHAPTER = re.compile(r"^\s*\d{1,4}:\d\d(?::\d\d)?\s")
_BULLET = re.compile(r"^\s*(?:[-*•–—]|\d+[.)])\s+")
_ACCENT = re.compile("[\u0300-\u036f]+")
_CONTROL = re.compile("[\x00-\x07\x0b\x0e-\x1f]")
_FOLLOWED = re.compile(r"([^\W_]+(?:['’-][^\W_]+)*)[\"'”’»)\]]*([.!?…,;:]*)")
_TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*|[.!?…]+|[,;:]")


def plain(text: str) -> str:
    """The text without markup, escapes, invisible marks and damaged encoding."""
    if "&" in text:
        text = html.unescape(text)
    if "Ã" in text or "â€" in text:
        try:
            text = text.encode("cp1252").decode("utf-8")
        except UnicodeError:
            text = re.sub("[\u00c2\u00c3\u00e2][\x80-\u00ff\u0152-\u0192\u02c6-\u02dc\u2013-\u203a\u20ac\u2122]{1,2}", _repair, text)
    return text if text.isascii() else _INVISIBLE.sub("", text)


def _repair(match: re.Match) -> str:
    for codec in ("cp1252", "latin-1"):
        try:
            return match.group().encode(codec).decode("utf-8")
        except UnicodeError:
            pass
    return match.group()


def folded(text: str) -> str:
    """Lower case without accents."""
    text = text.lower()
    return text if text.isascii() else _ACCENT.sub("", unicodedata.normalize("NFD", text))


def lengths(text: str) -> list[int]:
    """The text's length in each of ``ENCODINGS``."""
    n, raw = len(text), len(text.encode("utf-8", "surrogatepass"))
    breaks = text.count("\n")
    lone = breaks - text.count("\r\n")
    marks = 4 * text.count("&") + 3 * (text.count("<") + text.count(">")) + 5 * text.count('"') + 5 * text.count("'")
    escapes = breaks + sum(map(text.count, "\r\t\b\f\"\\"))
    if not text.isprintable():
        escapes += 5 * len(_CONTROL.findall(text))
    plain = text.isascii()
    wide = 0 if plain else len(text.encode("utf-16-le", "surrogatepass")) // 2 - n
    beyond = 0 if plain else n - len(text.encode("ascii", "ignore"))
    return [n, raw, n + wide, n + marks, raw + marks, n + escapes, raw + escapes, n + escapes + 5 * beyond + 6 * wide, n + lone, raw + lone]


def _tail_start(text: str, words: int = 12) -> int:
    """Where the last words of a text begin, or the tag that they are part of."""
    parts = text.rsplit(None, words)
    start = len(parts[0]) if len(parts) > words else 0
    tag = text.rfind("<")
    return min(start, tag) if tag >= 0 and (text[-1] == ">" or ">" not in text[tag:]) else start


def core(text: str) -> tuple[str, bool]:
    """A plain text without what may follow a complete one, and whether a mark of a break was met."""
    rest = text.rstrip()
    while rest:
        start = _tail_start(rest)
        tail = rest[start:]
        if m := _AFTER.search(tail):
            rest = rest[: start + m.start()].rstrip()
        else:
            return rest, bool(_BREAK.search(tail))
    return rest, False


def ending(text: str) -> tuple[str, str, str, str, str]:
    """(verdict, kind, last word but one, last word, last fragment) of a plain text.

    The verdict is ``complete``, ``broken``, or ``open`` and ``trailing`` (before
    an ellipsis) where the corpus must decide; the kind is ``chapter`` for a line
    of a chapter list, else ``prose``. The word before a fragment's first is ^.
    """
    nothing = ("prose", "", "", "")
    rest, marked = core(text)
    if marked:
        return "broken", *nothing
    if len(text.split(None, 3)) < 3:
        return "complete", *nothing
    if not rest:
        return "complete", *nothing
    line = rest[rest.rfind("\n") + 1 :]
    kind = "chapter" if _CHAPTER.match(line) else "prose"
    trailing = bool(_ELLIPSIS.search(rest))
    if not trailing and _CLOSED.search(rest):
        return "complete", kind, "", "", ""
    words = _words(_CHAPTER.sub("", line) if kind == "chapter" else _BULLET.sub("", line))
    while words and words[-1] in "…..." and trailing:
        words.pop()
    if not words:
        return ("complete" if trailing else "broken"), kind, "", "", ""
    if words[-1] in ",;:" or rest[-1] in "([{«“—–":
        return "broken", kind, "", "", ""
    start = len(words)
    while start and words[start - 1][0] not in ".!?…":
        start -= 1
    fragment = [w for w in words[start:] if w not in ",;:"]
    if not fragment:
        return "complete", kind, "", "", ""
    before = fragment[-2] if len(fragment) > 1 else "^"
    return ("trailing" if trailing else "open"), kind, before, fragment[-1], " ".join(fragment)


def _words(line: str) -> list[str]:
    return _TOKEN.findall(folded(line))


def continuations(text: str, held: Counter) -> None:
    """Add to ``held`` each (kind, word, next word, whether a sentence or list line ends there) of a plain text; its very end says nothing."""
    lines = core(text)[0].split("\n")
    last = len(lines) - 1
    for n, line in enumerate(lines):
        chapter = bool(_CHAPTER.match(line))
        listed = chapter or bool(_BULLET.match(line))
        pairs = _FOLLOWED.findall(folded(_CHAPTER.sub("", line) if chapter else line))
        if not pairs:
            continue
        kind = "chapter" if chapter else "prose"
        final, mark = pairs.pop()
        before, keys = "^", []
        for word, follows in pairs:
            if not follows or follows[0] in ",;:":
                keys.append((kind, before, word, False))
                before = word
            else:
                keys.append((kind, before, word, follows[0] != "…" and ".." not in follows))
                before = "^"
        if n < last and (mark or listed):
            keys.append((kind, before, final, listed and not mark or mark[:1] in (".", "!", "?") and ".." not in mark))
        held.update(keys)


_ENDING = ("id", "source", "copy", "verdict", "kind", "before", "word", "fragment", "lengths")


def _judged(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Each text's ending, and rows (kind, before, word, ends, n) of the continuations, added up before they leave the task."""
    held: Counter = Counter()
    kind_of_id: pa.DataType = pa.int64()

    def counts() -> pa.RecordBatch:
        keys = list(held)
        texts = {name: pa.array([k[j] for k in keys], pa.string()) for j, name in enumerate(("kind", "before", "word"))}
        nothing = {"id": kind_of_id, "source": pa.string(), "copy": pa.string(), "verdict": pa.string(), "fragment": pa.string(), "lengths": pa.list_(pa.int32())}
        columns = [texts[c] if c in texts else pa.nulls(len(keys), nothing[c]) for c in _ENDING]
        out = pa.RecordBatch.from_arrays([*columns, pa.array([k[3] for k in keys], pa.bool_()), pa.array(list(held.values()), pa.int64())], names=[*_ENDING, "ends", "n"])
        held.clear()
        return out

    for whole in batches:
        kind_of_id = whole.schema.field(0).type
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            texts = [t or "" for t in batch.column(2).to_pylist()]
            bare = [plain(t) for t in texts]
            ends = [ending(t) for t in bare]
            for t in bare:
                continuations(t, held)
            columns = [pa.array([e[k] for e in ends], pa.string()) for k in range(5)]
            sizes = pa.array([lengths(t) for t in texts], pa.list_(pa.int32()))
            empty = [pa.nulls(len(texts), pa.bool_()), pa.nulls(len(texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *columns, sizes, *empty], names=[*_ENDING, "ends", "n"])
            if len(held) > most:
                yield counts()
    if held:
        yield counts()


def source_key(source: Column) -> Column:
    """A source however spelt: lower case, its words joined by ``_``; null stays null."""
    return F.regexp_replace(F.lower(F.btrim(source, F.lit(" \t\n "))), r"(?U)[\s\-_.]+", "_")


def judge_endings(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(endings, continuations), found in one pass and written.

    The endings are one row a document: id, source, copy (a digest of the text,
    which copies share), verdict, kind, before, word, fragment, lengths. The
    continuations are the corpus: how often a word follows another (kind,
    before, word, n) and ends a sentence or list line there (ends).
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("id"), source_key(F.col(source)).alias("source"), F.col(text).alias("text"), F.sha2(text, 256).alias("copy"))
    judged = rows.mapInArrow(_judged, f"id {kind}, source string, copy string, verdict string, kind string, before string, word string, fragment string, lengths array<int>, ends boolean, n bigint")
    judged = materialize(judged, "endings")
    counts = judged.where("n is not null").groupBy("kind", "before", "word").agg(F.sum(F.when(F.col("ends"), F.col("n")).otherwise(0)).alias("ends"), F.sum("n").alias("n"))
    return judged.where("verdict is not null").drop("ends", "n"), materialize(counts, "continuations")


def hidden_limits(endings: DataFrame, least: int = 8, times: float = 6.0, around: int = 20, shortest: int = 60, lift: float = 1.2) -> DataFrame:
    """Rows (source, encoding, e, length, n, own, unclosed, lift, trailing): the storage limits of the sources.

    A length is a limit where at least ``least`` different texts of a source
    have it, ``times`` as many as the mean of the ``around`` lengths on either
    side, where two thirds of them lack a closing mark, and where the odds of
    that are ``lift`` times those elsewhere in the source. A limit in one encoding shows in the others,
    too; so each text counts for the limit that most texts share, and a length
    that isn't one by its own texts is left out. Texts that end in an ellipsis
    have limits of their own (``trailing``), as a source that cuts at a whole
    word doesn't fill them.
    """
    unclosed = F.col("verdict").isin("open", "broken")
    once = endings.where("source is not null").groupBy("source", "copy").agg(F.first("lengths").alias("lengths"), F.first("verdict").alias("verdict"))
    named = once.select("source", "copy", (F.col("verdict") == "trailing").alias("trailing"), unclosed.cast("int").alias("open"), F.posexplode("lengths").alias("e", "length"))
    where = ["source", "e", "trailing", "length"]
    counts = named.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.sum("open").alias("unclosed"))
    near = Window.partitionBy("source", "e", "trailing").orderBy("length").rangeBetween(-around, around)
    whole = Window.partitionBy("source", "e", "trailing")
    odds = lambda some, of: (some + 0.5) / (of - some + 0.5)
    elsewhere = odds(F.sum("unclosed").over(whole) - F.col("unclosed"), F.sum("n").over(whole) - F.col("n"))
    spikes = counts.withColumns({"background": (F.sum("n").over(near) - F.col("n")) / (2 * around), "lift": F.when(~F.col("trailing"), F.round(odds(F.col("unclosed"), F.col("n")) / elsewhere, 6))})
    stands_out = lambda n: (F.col(n) >= least) & (F.col(n) > times * F.greatest(F.lit(1.0), F.col("background")))
    spikes = spikes.where((F.col("length") >= shortest) & stands_out("n") & (F.col("trailing") | (F.col("lift") >= lift) & (3 * F.col("unclosed") >= 2 * F.col("n"))))
    spikes = materialize(spikes, "spikes")
    claims = named.join(spikes.select(*where, F.struct("n", (-F.col("e")).alias("e"), "length").alias("claim")), where)
    claimed = claims.groupBy("source", "trailing", "copy").agg(F.max("claim").alias("claim"))
    own = claimed.groupBy("source", "trailing", (-F.col("claim.e")).alias("e"), F.col("claim.length").alias("length")).agg(F.count(F.lit(1)).alias("own"))
    limits = spikes.join(own, where).where(stands_out("own"))
    names = F.array(*(F.lit(e) for e in ENCODINGS))
    return limits.select("source", F.get(names, F.col("e")).alias("encoding"), "e", "length", "n", "own", "unclosed", "lift", "trailing")


def _at_limits(endings: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows (source, copy): the texts without a closing mark that stand at a limit of their source."""
    # A byte limit leaves out a last character that doesn't fit; where a source cuts at a whole word and adds an
    # ellipsis, texts reach somewhat below its limit.
    back = F.when(F.col("trailing"), 24).when(F.col("encoding").contains("utf8"), 3).otherwise(0)
    reach = limits.select("source", "e", "trailing", F.explode(F.sequence(F.col("length") - back, F.col("length"))).alias("length")).distinct()
    sized = endings.where("verdict in ('open', 'trailing') and source is not null")
    sized = sized.select("source", "copy", (F.col("verdict") == "trailing").alias("trailing"), F.posexplode("lengths").alias("e", "length"))
    return sized.join(reach, ["source", "e", "trailing", "length"], "left_semi").select("source", "copy").distinct()


def truncated(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *, share: float = 0.05, closers: int = 3) -> DataFrame:
    """Rows (key, source, truncated, reason) of all documents; the reason is null for complete ones.

    Broken is, in this order,
    - ``mark``: a text that ends in a half mark, escape, link or byte sequence,
      in a comma, or in a mark put after a break;
    - ``limit``: one without a closing mark at a hidden limit of its source;
    - ``ending``: one whose last two words end no sentence elsewhere in the
      corpus (in less than ``share`` of their occurrences), or never occur
      elsewhere (before an ellipsis only if the last is the beginning of a
      more frequent word, else the text trails off);
    - ``copy``: a copy of a broken text.
    A phrase that at least ``closers`` different texts away from limits end in,
    and no fewer than have its words elsewhere, and that no longer word
    continues, is a closing or trails off on purpose: such texts are complete,
    except those at a limit without an ellipsis. So are texts with a closing
    mark, lists of complete items, texts of fewer than three words, null and
    blank ones. Rows with a null key stay; an empty table gives no rows.
    """
    endings, known = judge_endings(documents, key, text, source)
    limits = materialize(hidden_limits(endings), "limits")
    undecided = endings.where("verdict in ('open', 'trailing')").drop("lengths")
    at = materialize(_at_limits(endings, limits).withColumn("at_limit", F.lit(True)), "at")
    undecided = materialize(undecided.join(at, ["source", "copy"], "left").withColumn("at_limit", F.coalesce("at_limit", F.lit(False))), "undecided")
    pairs = undecided.select("kind", "before", "word").distinct().join(known, ["kind", "before", "word"], "left").fillna(0, ["ends", "n"])
    pairs = materialize(pairs, "last_words")
    # Pairs that hardly end a sentence elsewhere: is the last word the beginning of a longer, more frequent one?
    unseen = pairs.where(F.col("ends") <= share * F.col("n")).select("kind", "before", "word", "n")
    lengths_of = F.explode(F.when(F.length("word") > 1, F.sequence(F.lit(1), F.length("word") - 1)))
    prefixes = known.select("kind", "before", "word", F.col("n").alias("whole_n"), lengths_of.alias("size"))
    prefixes = prefixes.select("kind", "before", F.substring("word", F.lit(1), F.col("size")).alias("word"), "whole_n")
    longer = unseen.join(prefixes, ["kind", "before", "word"]).where("whole_n > n").select("kind", "before", "word").distinct().withColumn("cut", F.lit(True))
    # A pair of words that is new, as after odd insertions, is judged by its last word alone: whether it ends sentences,
    # and whether it is the beginning of a more frequent one.
    alone = known.groupBy("kind", "word").agg(F.sum("ends").alias("word_ends"), F.sum("n").alias("word_n"))
    alone = materialize(alone, "vocabulary")
    begun = alone.select("kind", F.col("word_n").alias("whole_n"), "word", lengths_of.alias("size")).select("kind", F.substring("word", F.lit(1), F.col("size")).alias("word"), "whole_n")
    lone = unseen.where("n = 0").select("kind", "word").distinct()
    begun = lone.join(begun, ["kind", "word"]).groupBy("kind", "word").agg(F.max("whole_n").alias("whole_n"))
    final = (F.col("word_n") >= 20) & (F.col("word_ends") >= 0.3 * F.col("word_n"))
    alone = lone.join(alone, ["kind", "word"], "left").join(begun, ["kind", "word"], "left").select("kind", "word", final.alias("final"), (F.col("whole_n") > F.coalesce("word_n", F.lit(0))).alias("begun"))
    repeated = undecided.where("not at_limit").groupBy("fragment").agg(F.count_distinct("copy").alias("texts"))
    full = (
        undecided.join(pairs, ["kind", "before", "word"], "left")
        .join(longer, ["kind", "before", "word"], "left")
        .join(alone, ["kind", "word"], "left")
        .join(repeated.where(F.col("texts") >= closers), "fragment", "left")
    )
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    closer = F.coalesce(~flag("cut") & (F.col("texts") >= F.col("n")), F.lit(False))
    ends_here = (F.col("n") > 0) & (F.col("ends") >= share * F.col("n")) | (F.col("n") == 0) & ~flag("cut") & flag("final")
    # An ellipsis after words that are new together, the last of them whole: nothing that the corpus goes on from.
    off = (F.col("verdict") == "trailing") & (F.col("n") == 0) & ~flag("cut") & ~flag("begun")
    limit = F.col("at_limit") & ~(closer & (F.col("verdict") == "trailing"))
    reason = F.when(limit, F.lit("limit")).when(~(closer | ends_here | off), F.lit("ending"))
    decided = full.select("id", "source", "copy", reason.alias("reason"))
    plainly = endings.where("verdict in ('complete', 'broken')").select("id", "source", "copy", F.when(F.col("verdict") == "broken", F.lit("mark")).alias("reason"))
    every = materialize(decided.unionByName(plainly), "verdicts")
    # A text posted again is broken if it is anywhere; only the digests of the broken are shuffled against all.
    copies = every.where("reason is not null and copy is not null").select("copy").distinct().withColumn("elsewhere", F.lit("copy"))
    out = every.join(copies, "copy", "left").withColumn("reason", F.coalesce("reason", "elsewhere"))
    return out.select(F.col("id").alias(key), "source", F.col("reason").isNotNull().alias("truncated"), "reason")


def truncation_rates(verdicts: DataFrame) -> DataFrame:
    """Rows (source, documents, truncated, at_limit, share): how often each source, however spelt, truncates; null for unknown sources."""
    counts = verdicts.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("truncated").alias("truncated"), F.count_if(F.col("reason") == "limit").alias("at_limit"))
    return counts.withColumn("share", F.round(F.col("truncated") / F.col("documents"), 6))
