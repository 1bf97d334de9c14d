"""Language by compression: held-out accuracy, labels, mixed texts, edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from segloom.llm.language import classify, decide, label_code, mislabelled, passage_languages, passages, readable, record_languages, sample_languages, window_starts, word_spans
from segloom.session import table

EN = "The old lighthouse compares the water level with the help of two neighbours."
FR = "Le vieux phare compare le niveau de l'eau avec l'aide de deux voisins."


@pytest.fixture(scope="module")
def languages(spark, data):
    segments = table(spark, data, "transcript_segments").select(F.col("segment_id").alias("id"), F.col("language").alias("label"), F.col("content").alias("text"))
    return sample_languages(table(spark, data, "lang_samples"), segments)


@pytest.mark.parametrize(("label", "code"), [("en_GB", "en"), ("FR", "fr"), ("Port.", "pt"), ("castellano", "es"), ("de-AT", "de"), ("français", "fr"), ("und", None), ("", None), (None, None), ("??", None), ("auto", None)])
def test_label_code(label, code):
    assert label_code(label) == code


def test_held_out(spark, data):
    """Fitted on half of the sample sentences, tried on the other half."""
    samples = table(spark, data, "lang_samples")
    fitted = sample_languages(samples.where("sample_id % 2 = 0"))
    rest = samples.where("sample_id % 2 = 1").collect()
    best, margin = decide(fitted.sizes([r.text.lower().encode() for r in rest]))
    right = [fitted.codes[b] == r.lang for b, r in zip(best, rest)]
    clear = [ok for ok, m in zip(right, margin) if m >= 0.12]
    assert len(clear) > 0.6 * len(rest) and sum(clear) >= 0.97 * len(clear)


def test_agreement(spark, data, languages):
    documents = table(spark, data, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "text")
    rows = [r for r in record_languages(documents, languages).where("words >= 6 and not mixed").collect() if label_code(r.label)]
    assert sum(label_code(r.label) == r.language for r in rows) >= 0.9 * len(rows) > 50
    assert all(0 <= r.confidence <= 1 for r in rows)


def test_mislabelled(spark, languages):
    rows = [
        (1, "en", EN, "x"),
        (2, "fr", EN, "x"),
        (3, None, FR, "x"),
        (4, "en", f"{EN} {FR}", "x"),
        (4, "en", f"{EN} {FR}", "x"),
        (5, "en", FR.lower().rstrip(".") + " " + EN.lower().rstrip("."), "x"),
        (6, None, "Good point.", "x"),
        (7, None, None, "x"),
        (8, None, "", "x"),
        (9, "en-US", f"{EN} (le phare)", "x"),
        (10, "??", "[Music] Speaker 1: um, uh", "x"),
        (11, "und", f"Speaker 1: [00:01:02] {EN}", "x"),
        (12, "en", (EN + " ") * 3000, "x"),
    ]
    df = spark.createDataFrame(rows, "id bigint, label string, text string, language string")
    found = {tuple(r) for r in mislabelled(df, languages).collect()}
    assert found == {(2, "en"), (3, "fr"), (4, "en"), (4, "fr"), (5, "en"), (5, "fr"), (11, "en")}
    parts = [(r.passage_no, r.language) for r in passage_languages(df.where("id = 5"), languages).orderBy("passage_no").collect()]
    assert [p[1] for p in parts] == ["fr", "en"]
    assert mislabelled(df.limit(0), languages).count() == 0


def test_pieces(languages):
    assert readable("[Music] Hé&amp; ​Speaker") == "  hé& speaker"
    assert [t for _, _, t, _ in passages("one two. three four\nfive")] == ["one two.", "three four", "five"]
    long = " ".join(f"w{i}" for i in range(50))
    assert {w for _, _, t, _ in passages(long) for w in t.split()} == set(long.split())
    assert readable("- Speaker 1 - Oui") == " " + " oui"
    assert classify([None, ""], languages)[1] == []


def test_clear_passage_of_two_languages(spark, languages):
    """A sentence that is clearly in one language as a whole still shows a clause in another."""
    text = "the river gauge never forgets the whole procedure at the end of the week, because nobody wrote it down, ein geduldiger zuhörer misst die temperatur"
    _, margin = decide(languages.sizes([text.encode()]))
    assert margin[0] >= 0.3
    df = spark.createDataFrame([(1, "en", text)], "id bigint, label string, text string")
    assert {tuple(r) for r in mislabelled(df, languages).collect()} == {(1, "en"), (1, "de")}
    assert [r.language for r in passage_languages(df, languages).orderBy("passage_no").collect()] == ["en", "de"]


def test_windows_are_whole():
    """Windows hold six words, the last ones too, and five of any six words in a row."""
    for n in (4, 6, 7, 13, 35):
        starts = window_starts(n)
        assert starts[0] == 0 and starts[-1] == max(0, n - 6)
        assert all(any(abs(i - j) <= 1 for j in starts) for i in range(max(1, n - 5)))
    text = "  one  two\nthree "
    assert [text[a:z] for a, z in word_spans(text, 0, len(text))] == text.split()


def test_all_languages(spark, languages):
    """Each language with a clause of its own has a row, however many; samples are bounded for each language by itself."""
    de = "Ein geduldiger Zuhörer misst die Temperatur der Glasur am Ende der Woche."
    text = f"{EN} {FR} {de}"
    df = spark.createDataFrame([(1, "en", text), (2, None, None), (3, "en", "zzz qqq xxx vvv"), (4, "pt", "Um um quem decide quando um jardineiro? Um, hum...")], "id bigint, label string, text string")
    rows = record_languages(df, languages).collect()
    assert {r.language for r in rows if r.id == 1 and r.mixed} == {"en", "fr", "de"}
    assert {tuple(r) for r in mislabelled(df.where("id = 1"), languages).collect()} == {(1, "en"), (1, "fr"), (1, "de")}
    others = {r.id: r for r in rows if r.id > 1}
    assert others[2].language is None and others[2].confidence == 0 and others[2].words == 0
    assert others[3].language is None and 0 <= others[3].confidence < 0.12
    assert others[4].words == 7  # the article counts, the hesitations at the end don't


def test_samples_of_each_language(spark):
    rows = [(i, f"l{i % 3}" if i < 900 else "z", f"word{i} and{i} so on {i}") for i in range(910)]
    few = sample_languages(spark.createDataFrame(rows, "sample_id bigint, lang string, text string"), most=20)
    assert few.codes == ["l0", "l1", "l2", "z"] and all(0 < len(s.splitlines()) <= 40 for s in few.samples)
