"""What turns send to the driver is bounded, and the shared parts of labels miss no form."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import col, concat, lit

from segloom.llm import fillers, speakers
from segloom.llm.fillers import _fit
from segloom.llm.speakers import content_label, near_forms


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _names(spark):
    random.seed(5)
    forms = ["".join(random.choices("abn é", k=random.randint(4, 13))) for _ in range(60)]
    keys = set(forms[:20])
    for form in forms * 6:
        key = list(form)
        for _ in range(random.randint(1, 3)):
            at = random.randrange(len(key) + 1)
            key[at : at + random.randint(0, 1)] = random.choices("abn é", k=random.randint(0, 2))
        if key:
            keys.add("".join(key))
    return spark.createDataFrame([("v", k) for k in keys], "video_id string, key string"), spark.createDataFrame([("v", f, i) for i, f in enumerate(forms)], "video_id string, key string, speaker_no int"), keys, forms


def test_near_forms_against_all_pairs(spark):
    names, found_in, keys, forms = _names(spark)
    expected = set()
    for key in keys:
        for i, form in enumerate(forms):
            n = _edits(key, form)
            if n == 0 or len(key) >= 4 and n <= min(2, len(form) // 4):
                expected.add((key, i, n))
    got = {(r.key, r.speaker_no, r.edits) for r in near_forms(names, found_in).collect()}
    assert got == expected


def test_parts_of_labels_are_not_broadcast(spark):
    """A few names make many rows of parts; the driver must not gather them, whatever the threshold."""
    names, forms, _, _ = _names(spark)
    plan = near_forms(names.repartition(4), forms.repartition(4)).select("key", "edits")
    plan.collect()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and all("strategy=merge" in line for line in joins)


def test_fit_of_counted_rows(spark):
    """Rows given once with their count have the weights of the rows repeated."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (40, 3)).astype(float)
    y, times = (rng.random(40) < 0.4).astype(float), rng.integers(1, 9, 40)
    again = np.repeat(np.arange(40), times)
    assert np.allclose(_fit(x, y, times=times.astype(float)), _fit(x[again], y[again]), atol=1e-9)


def test_a_text_is_searched_for_a_label_at_most_twice(spark):
    df = spark.createDataFrame([("Hello",)], "x string").select(content_label(col("x")).alias("y"))
    text = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert text.count("regexp_extract") + text.count("regexp_replace") + text.count("rlike") <= 3


def test_words_are_read_once(monkeypatch):
    """A stretch of text that comes again isn't parted into words again; counts are those of the whole texts."""
    calls = []

    class Tokens:
        def findall(self, text, real=fillers._TOKENS):
            calls.append(text)
            return real.findall(text)

    monkeypatch.setattr(fillers, "_TOKENS", Tokens())
    batch = pa.RecordBatch.from_arrays([pa.array(["the old-kiln, um, is warm."] * 50), pa.array(["en"] * 50)], names=["t", "language"])
    (rows,) = fillers._phrase_counts(iter([batch]))
    assert len(calls) == 5
    got = {r["phrase"]: r for r in rows.to_pylist()}
    assert got["the old-kiln"]["total"] == got["um"]["total"] == got["um"]["between"] == 50 and "old" not in got


def test_usual_labels_and_texts_are_spared_the_patterns(spark, monkeypatch):
    """A usual label needs no pattern, nor does a text that ends with an ordinary word."""
    monkeypatch.setattr(speakers, "_NUMBERED", "^(never)$")
    monkeypatch.setattr(fillers, "without_marks", lambda content: lit(""))
    df = spark.createDataFrame([("Speaker 3", "Um: so we begin, uh, with the door.")], "label string, content string")
    assert tuple(df.select(speakers.label_key(col("label")), fillers.holds_speech(col("content"), fillers.Fillers(("um", "uh", "you know")))).first()) == ("#3", True)


def test_speech_as_by_the_patterns_alone(spark):
    found = fillers.Fillers(("um", "uh-huh", "you know", "hã", "er"), {})
    random.seed(8)
    parts = ["um", "Um,", "uh-huh", "you", "know", "You know.", "hã...", "ER!", "door", "l’été", "'um'", "[door", "door]", "(x", "y)", "*door", "door*", "<i>", "A:", ">> door:", "- door -", "01:02", "12", "♪", "?", "-", "'", "\n", "\t", "ſ", "K"]
    texts = [None, "", "um\n", "door\n", *(random.choice([" ", "  ", ", "]).join(random.choices(parts, k=random.randint(1, 5))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = fillers.without_phrases(fillers.without_marks(col("t")), found.in_silence("")).rlike(r"[\p{L}\p{N}]")
    rows = df.select("t", fillers.holds_speech(col("t"), found).alias("got"), slow.alias("slow")).collect()
    assert {r.got for r in rows} == {True, False}
    assert [(r.t, r.got) for r in rows if r.got != r.slow] == []


def test_usual_labels_as_by_the_pattern(spark):
    labels = [None, "", *(f"{a}{b}{c}" for a in ("Speaker ", "speaker ", "Speaker  ", "Speaker") for b in ("0", "1", "9", "a", "²", "٣", ":") for c in ("", "0", " ", ":"))]
    df = spark.createDataFrame([(x,) for x in labels], "x string").withColumn("y", concat(lit(" "), col("x")))
    assert [r for r in df.select("x", speakers.label_key(col("x")).alias("a"), speakers.label_key(col("y")).alias("b")).collect() if r.a != r.b] == []
