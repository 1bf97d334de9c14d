"""Text columns: white space as Unicode defines it, token estimates, overlap words, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segloom.functions.binding import let

# White space as Unicode defines it: to be trimmed without a pattern, and as a class of characters.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
TOKENS_PER_WORD = 1.3

# Openings that mark a segment as the continuation of the one before it.
# They match at the very start, in any case, and without a word boundary after them.
CONTINUATION_OPENINGS = (
    "Par exemple|For example|For instance|Prenons",
    "C'est-à-dire|That is|In other words|Autrement dit",
    "Donc|So|Thus|Therefore|Alors",
    "Et |And |De plus|Furthermore|Also|En plus",
    "Mais|But|However|Cependant|Toutefois",
    "Parce que|Because|Car|Since|Puisque",
    "Ce qui|Which|That|Cela|Ça",
    r"\d+\.",
    "Deuxièmement|Troisièmement|Second|Third|Ensuite|Puis",
    "Ici|Here|Voici|Look|Regardez|On voit",
    "En fait|Actually|D'ailleurs|Moreover",
    "Cette|This|Ces|These",
)


def is_continuation(text: Column) -> Column:
    """Whether ``text`` opens like a continuation; null gives false."""
    return F.coalesce(text.rlike("(?iuU)^(?:" + "|".join(CONTINUATION_OPENINGS) + ")"), F.lit(False))


def strip(text: Column) -> Column:
    """``text`` without white space at its ends; null stays null."""
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """The words of ``text``; null and blank give an empty array."""
    none = F.array().cast("array<string>")
    return let(strip(F.coalesce(text, F.lit(""))), lambda bare: F.when(bare == "", none).otherwise(F.split(bare, SPACE)))


def word_count(text: Column) -> Column:
    """Number of words; null and blank give 0."""
    return F.size(words(text))


def token_estimate(count: Column) -> Column:
    """Estimated tokens of ``count`` words: floor(1.3 x words)."""
    return F.floor(count * F.lit(TOKENS_PER_WORD)).cast("int")


def token_count(text: Column) -> Column:
    """Estimated tokens of ``text``; null and blank give 0."""
    return token_estimate(word_count(text))


def overlap_words(n_tokens: int) -> int:
    """How many words stand for ``n_tokens`` tokens, at least one."""
    return max(1, int(n_tokens / TOKENS_PER_WORD))


def last_tokens(text: Column, n_tokens: int) -> Column:
    """The last words of ``text``; a text that is short enough comes back unchanged."""
    n = overlap_words(n_tokens)
    return let(words(text), lambda w: F.when(F.size(w) <= n, text).otherwise(F.array_join(F.slice(w, -n, n), " ")))


def first_tokens(text: Column, n_tokens: int) -> Column:
    """The first words of ``text``; a text that is short enough comes back unchanged."""
    n = overlap_words(n_tokens)
    return let(words(text), lambda w: F.when(F.size(w) <= n, text).otherwise(F.array_join(F.slice(w, 1, n), " ")))


def sanitize_title(title: Column, length: int = 100) -> Column:
    """A title as a file name: letters, digits and ``-_.`` stay, a blank becomes ``_``."""
    kept = F.regexp_replace(F.replace(title, F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}\-_.]", "")
    return F.substring(kept, 1, length)


def stem_id(stem: Column) -> Column:
    """The video id that a file stem stands for."""
    return F.replace(stem, F.lit(" "), F.lit("_"))


def stem_title(stem: Column) -> Column:
    """The video title that a file stem stands for."""
    return F.replace(F.replace(stem, F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" - "))


def numbered_id(prefix: Column, mark: str, index: Column) -> Column:
    """``prefix`` + ``mark`` + the index with at least three digits."""
    return F.format_string("%s" + mark + "%03d", prefix, index)


def deep_link(video: Column, start_seconds: Column) -> Column:
    """A link to the second at which a chunk starts."""
    return F.concat(
        F.lit("https://www.youtube.com/watch?v="), video, F.lit("&t="), start_seconds.cast("bigint").cast("string"), F.lit("s")
    )


# Media types of audio files by suffix.
MEDIA_TYPES = {".mp3": "audio/mpeg", ".m4a": "audio/mp4", ".webm": "audio/webm", ".opus": "audio/opus", ".ogg": "audio/ogg", ".wav": "audio/wav"}


def media_type(path: Column) -> Column:
    """The media type of a file by its suffix in any case; ``audio/webm`` where it is unknown."""
    types = F.create_map(*(F.lit(x) for pair in MEDIA_TYPES.items() for x in pair))
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return F.coalesce(F.try_element_at(types, suffix), F.lit("audio/webm"))


def hashed_words(text: Column, dimension: int = 64) -> Column:
    """An array of (bucket, sign) of the words of ``text`` in lower case, by their MD5: the terms of a hashed embedding."""
    digest = lambda w: F.md5(w)
    number = lambda w, at: F.conv(F.substring(digest(w), at, 8), 16, 10).cast("bigint")
    entry = lambda w: F.struct((number(w, 1) % dimension).cast("int").alias("bucket"), F.when(number(w, 9) % 2 == 0, 1).otherwise(-1).alias("sign"))
    return F.transform(words(F.lower(text)), entry)
