"""Speaker labels of transcripts, resolved to the speakers of a video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.functions.binding import let

from segloom.llm.fillers import ANNOTATION, TIME

# Words for an unnamed speaker, with a number after them.
SPEAKER_WORDS = (
    *("speaker", "spk", "spkr", "spkr.", "s", "person", "voice"),
    *("locuteur", "locutrice", "intervenant", "intervenante", "orateur", "oratrice"),
    *("sprecher", "sprecherin", "redner", "rednerin"),
    *("hablante", "orador", "oradora", "locutor", "locutora", "ponente", "falante"),
)
# Small numbers as words.
NUMBER_WORDS = {
    **{"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10},
    **{"un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5},
    **{"eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5},
    **{"uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5},
    **{"um": 1, "dois": 2, "três": 3, "quatro": 4},
}
# Entries that name nobody.
NOBODY = ("", "unknown", "unk", "n/a", "na", "none", "null", "noise", "music", "silence", "-", "--", "?", "??", "speaker", "inconnu", "unbekannt", "desconocido", "desconhecido")

_WORDS = "|".join(w.replace(".", r"\.") for w in sorted(SPEAKER_WORDS, key=len, reverse=True))
#: A numbered speaker with whatever brackets, marks and zeros surround it.
_NUMBERED = rf"(?i)^[\s\[(<>*-]*(?:{_WORDS})[\s_#.:\-]*(?:(?:no|nr|num)\.?|[n№][°º]?)?[\s_#\-]*0*([0-9]{{1,9}})[\s\])>:*-]*$"
_WORDED = rf"^(?:{_WORDS})\s+({'|'.join(sorted(NUMBER_WORDS, key=len, reverse=True))})$"
_FRONT = (
    rf"(?U)^(?:\s|{TIME}|(?!\[[^\]]*\]\s*\S){ANNOTATION})*"
    r"(?:>>\s*([^:\n]{1,60}?)\s*:|-\s+([^\n]{1,60}?)\s+-(?=\s|$)|\[([^\]\n]{1,60})\]|(\p{L}(?:[^:.!?\n]|(?<=\b\p{L}{1,2})\.){0,60}?)\s*:(?=\s|$)|((?:\p{Lu}|Dr)\.\s\p{L}+)\s*:(?=\s|$))"
)


def label_key(label: Column) -> Column:
    """A label's key: ``#n`` for a numbered speaker, else the bare name in lower case; null for nobody."""
    numbers = F.create_map(*(F.lit(x) for pair in NUMBER_WORDS.items() for x in pair))

    def bare(text: Column) -> Column:
        text = F.regexp_replace(F.lower(F.regexp_replace(text, r"(?U)[\s_]+", " ")), r"^[\s\[\](){}<>:*>-]+|[\s\[\]{}<>:*]+$", "")
        # A role after the name in brackets; a closing bracket whose opening is gone.
        return F.regexp_replace(text, r"(?<=\S)\s*\([^)]*\)$|\)$", "")

    def named(text: Column) -> Column:
        word = F.regexp_extract(text, _WORDED, 1)
        worded = lambda w: F.when(w != "", F.concat(F.lit("#"), F.element_at(numbers, w).cast("string"))).otherwise(text)
        return F.when(~text.isin(*NOBODY), let(word, worded))

    numbered = lambda n: F.when(n != "", F.concat(F.lit("#"), n.cast("int").cast("string"))).otherwise(let(bare(label), named))
    # The most usual label is spared the pattern.
    digit = F.substring(label, 9, 1)
    usual = label.startswith("Speaker ") & (F.length(label) == 9) & digit.between("1", "9")
    return F.when(usual, F.concat(F.lit("#"), digit)).otherwise(let(F.regexp_extract(label, _NUMBERED, 1), numbered))


def content_label(content: Column) -> Column:
    """What stands where a label stands in front of the text; null where nothing does."""
    # Without a colon a label begins with a mark, or follows one; most texts have neither and are spared the pattern.
    possible = content.contains(":") | content.rlike(r"^\W")
    found = F.regexp_replace(content, _FRONT + r"[\s\S]*", "$1$2$3$4$5")  # just one of them isn't empty
    return F.when(possible & content.rlike(_FRONT), found)


def aliases(speakers: DataFrame) -> DataFrame:
    """Rows (video_id, key, speaker_no): every form in which a video's speakers may be named, also those that several share.

    Speakers without a number are left out, those without a name keep their number.
    """
    distinct = speakers.where("speaker_no is not null").select("video_id", "speaker_no", "speaker_name", "speaker_role").distinct()
    name = F.regexp_replace(F.lower(F.trim("speaker_name")), r"(?U)\s+", " ")
    first, last = F.substring_index(name, " ", 1), F.regexp_extract(name, r" (.+)$", 1)
    forms = F.array(
        F.concat(F.lit("#"), F.col("speaker_no").cast("string")),
        name,
        F.concat(last, F.lit(", "), first),
        F.concat(last, F.lit(" "), first),
        first,
        last,
        F.concat(F.lit("dr. "), last),
        F.concat(F.substring(first, 1, 1), F.lit(". "), last),
        F.lower(F.trim("speaker_role")),
    )
    rows = distinct.select("video_id", "speaker_no", F.explode(F.array_distinct(forms)).alias("key"))
    return rows.where("key is not null and key <> ''").select("video_id", "key", "speaker_no").distinct()


#: Edits by which a form of at least 8 letters may differ (one less below that), and what stands for more.
MOST_EDITS, FAR = 2, 3


def near_forms(names: DataFrame, forms: DataFrame) -> DataFrame:
    """Rows (video_id, key, speaker_no, edits): the speakers of whom some form is within two edits of a key, the fewest edits each.

    A form and a key within two edits share one of the form's three parts, at
    a place that differs by two at most; so they are joined on the parts, and
    no key meets all forms of its video. That join is never a broadcast: a key
    makes up to 19 rows, of which the session's threshold knows nothing. Forms of fewer than 4 letters match
    exactly, those of fewer than 8 within one edit.
    """
    exact = names.join(forms.hint("merge"), ["video_id", "key"]).select("video_id", "key", "speaker_no", F.lit(0).alias("edits"))
    part = lambda n, i: F.floor(n * i / 3).cast("int")
    size, i, d = F.col("size"), F.col("i"), F.col("d")
    held = forms.where("key not like '#%' and length(key) >= 4").select("video_id", F.col("key").alias("form"), "speaker_no", F.length("key").alias("size"))
    held = held.withColumn("i", F.explode(F.array(*map(F.lit, range(3)))))
    held = held.withColumn("piece", F.substring("form", part(size, i) + 1, part(size, i + 1) - part(size, i)))
    asked = names.where("key not like '#%' and length(key) >= 4").withColumn("size", F.explode(F.sequence(F.greatest(F.lit(4), F.length("key") - MOST_EDITS), F.length("key") + MOST_EDITS)))
    asked = asked.withColumn("i", F.explode(F.array(*map(F.lit, range(3)))))
    # Some shared part has at most i edits before it and 2 - i behind it, which bounds its shift from either end.
    longer = F.length("key") - size
    least = F.greatest(-i, longer - (MOST_EDITS - i))
    most = F.least(i, longer + (MOST_EDITS - i))
    asked = asked.withColumn("d", F.explode(F.sequence(least, most)))
    asked = asked.where((part(size, i) + d >= 0) & (part(size, i + 1) + d <= F.length("key")))
    asked = asked.withColumn("piece", F.substring("key", part(size, i) + d + 1, part(size, i + 1) - part(size, i))).drop("d")
    # Adaptive execution would broadcast either side by its size before the rows are multiplied.
    met = asked.join(held.hint("merge"), ["video_id", "size", "i", "piece"]).select("video_id", "key", "form", "speaker_no").distinct()
    edits = met.withColumn("edits", F.levenshtein("key", "form")).where(F.col("edits") <= F.least(F.lit(MOST_EDITS), F.floor(F.length("form") / 4)))
    return exact.unionByName(edits.drop("form")).groupBy("video_id", "key", "speaker_no").agg(F.min("edits").cast("int").alias("edits"))


def nearest_two(near: DataFrame) -> DataFrame:
    """Rows (video_id, key, first_no, first_edits, second_no, second_edits): the two speakers nearest to a key; null where there is one alone."""
    order = Window.partitionBy("video_id", "key").orderBy("edits", "speaker_no")
    ranked = near.withColumn("place", F.row_number().over(order)).where("place <= 2")
    at = lambda c, n, name: F.max(F.when(F.col("place") == n, F.col(c))).alias(name)
    return ranked.groupBy("video_id", "key").agg(at("speaker_no", 1, "first_no"), at("edits", 1, "first_edits"), at("speaker_no", 2, "second_no"), at("edits", 2, "second_edits"))


def resolve_names(names: DataFrame, forms: DataFrame) -> DataFrame:
    """Rows (video_id, key, speaker_no) for the distinct (video_id, key) of ``names`` that one speaker is nearest to (``near_forms``)."""
    two = nearest_two(near_forms(names, forms))
    return two.where("second_no is null or first_edits < second_edits").select("video_id", "key", F.col("first_no").alias("speaker_no"))
