"""Speaker turns, labels and fillers against plain Python on small fixtures and whole tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from segloom.llm.fillers import CONTEXT, HESITATIONS, Fillers, clean_texts, holds_speech, learn_fillers
from segloom.llm.speakers import aliases, content_label, label_key, resolve_names
from segloom.llm.turns import FEATURES, boundary_chance, clean_turns, fit_boundary, spoken_segments, training_pairs, turn_starts
from segloom.session import materialize, table

SEGMENT = "segment_id bigint, video_id string, seg_index int, start_time string, end_time string, speaker string, language string, content string, seg_start double, received_at timestamp, bucket string, key int"
SPEAKER = "video_id string, speaker_no int, speaker_name string, speaker_role string"


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).collect()[0].y


@pytest.mark.parametrize(
    ("label", "key"),
    [
        *[(s, "#1") for s in ("Speaker 1", "SPEAKER_01", "S1", " spkr-1", "Speaker #1", "Speaker no. 1", "Speaker1:", "[Locuteur 1]", "Sprecherin 1", "Speaker One", "HABLANTE 1")],
        *[(s, None) for s in ("", "  ", "Unknown", "n/a", "?", "-", "[Music]", "Noise", None)],
        *[(s, "petra thalling") for s in ("Petra Thalling", "PETRA  THALLING:", "Petra Thalling (Host)", "[petra thalling]")],
        ("Dr. Thalling", "dr. thalling"),
        ("(Interpreter)", "interpreter"),
    ],
)
def test_label_key(spark, label, key):
    assert one(spark, label, label_key) == key


@pytest.mark.parametrize(
    ("content", "label"),
    [
        (">> Speaker 2: Hello", "Speaker 2"),
        ("- Anneke Mirigo - Hello", "Anneke Mirigo"),
        ("[Speaker 3] Hello", "Speaker 3"),
        ("SPEAKER 4: Hello", "SPEAKER 4"),
        ("Speaker no. 1: Hello", "Speaker no. 1"),
        ("[00:01:02] Speaker 1: Hello", "Speaker 1"),
        ("The night train counts. Nobody: knew", None),
        ("Hello", None),
        ("", None),
        (None, None),
    ],
)
def test_content_label(spark, content, label):
    assert one(spark, content, content_label) == label


@pytest.mark.parametrize(
    ("content", "speech"),
    [
        ("Good point.", True),
        ("Yes, exactly.", True),
        ("Um, like, yes", True),
        *[(s, False) for s in ("Uh, hmm.", "[Music] *coughs*", "♪ ♪", "...", " ", None, "(00:12) um", ">> Speaker 1: Er... um.", "[pause 3 s] {cough}", "<noise>", "Mm-hmm, uh.", "01:43:28,169 --> um")],
    ],
)
def test_holds_speech(spark, content, speech):
    assert one(spark, content, lambda x: holds_speech(x, Fillers())) is speech


def cleaned(spark, fillers, *texts):
    rows = spark.createDataFrame([(i, t, code, "x") for i, (t, code) in enumerate(texts)], "i int, content string, language string, phrase string")
    return [r.text for r in clean_texts(rows, "i", "content", "language", fillers).orderBy("i").collect()]


def test_clean_text(spark):
    content = "Speaker 1: [00:03:26] The, um, glass blower (laughter) counts the— the 72 seeds, uh... "
    assert cleaned(spark, Fillers(), (content, "en"), (None, "en"), ("", None), ("[Music] um...", "en")) == ["The, glass blower counts the 72 seeds", "", "", ""]


def test_words_that_are_fillers_elsewhere(spark, data):
    """An article, a pronoun and an adjective stay; the same words, set off or between words that follow each other without them, go."""
    rows = [(i, t, code) for i, (t, code) in enumerate(
        [("the old kiln is warm in the morning", "en"), ("the, um, kiln is er, warm", "en"), ("in um the morning, er, it is warm", "en"), ("quem decide quando um jardineiro vem", "pt"), ("um jardineiro bom decide", "pt"),
         ("wann kommt er aus dem haus", "de"), ("er kommt heute", "de"), ("cerca de la puerta este hay una fuente", "es"), ("la puerta este, este, es vieja", "es"), ("uh, the kiln is hmm, warm", "en")] * 40)]
    fillers = learn_fillers(spark.createDataFrame(rows, "segment_id bigint, content string, language string"))
    texts = [("Quem decide quando um jardineiro vem?", "pt"), ("Wann kommt er aus dem Haus?", "de"), ("Cerca de la puerta este hay una fuente.", "es"), ("Er kommt heute.", "de"), ("In um the morning, er, it is warm.", "en"), ("The, um, old kiln", "en")]
    assert cleaned(spark, fillers, *texts) == [*(t for t, _ in texts[:4]), "In the morning, it is warm.", "The old kiln"]
    assert len(fillers.weights) == len(CONTEXT) + 1


def test_boundary_model(spark, data):
    """On pairs held out, the classifier is no worse than nearest labels alone, and uses gap and context."""
    folder = data.replace("sf0.001", "sf0.01")
    segments, speakers = table(spark, folder, "transcript_segments"), table(spark, folder, "video_speakers")
    spoken = materialize(spoken_segments(segments, speakers), "spoken")
    pairs = materialize(training_pairs(spoken, aliases(speakers), segments.count()), "pairs")
    own = F.pmod(F.xxhash64("segment_id", F.lit(3)), F.lit(4)) == 0
    model = fit_boundary(pairs.where(~own))
    seen = boundary_chance(pairs.where(own), model).select("label", "by_rule", (F.col("p_boundary") >= 0.5).cast("double").alias("p")).toPandas()
    assert len(seen) > 1000 and (seen.p == seen.label).mean() >= (seen.by_rule == seen.label).mean() - 0.002 > 0.9
    weight = dict(zip(FEATURES, model.featureImportances.toArray()))
    assert weight["edits_prior"] + weight["edits_other"] < 0.99 and weight["gap_s"] + weight["words"] + weight["previous_words"] > 0.01


def test_names(spark):
    speakers = spark.createDataFrame([("v", 1, "Petra Thalling", "Host"), ("v", 2, "Ilvar Dreswick", "Guest"), ("v", 3, "Noemi Ostovar", "Guest"), ("v", 1, "Petra Thalling", "Host"), ("v", 4, None, None)], SPEAKER)
    forms = aliases(speakers)
    keys = {"petra thalling": 1, "thalling": 1, "petra": 1, "dr. dreswick": 2, "i. dreswick": 2, "dreswick, ilvar": 2, "host": 1, "guest": None, "peta thalling": 1, "ilvar dreswikk": 2, "somebody else": None, "#4": 4}
    names = spark.createDataFrame([("v", k) for k in keys], "video_id string, key string")
    got = {r.key: r.speaker_no for r in resolve_names(names, forms).collect()}
    assert got == {k: v for k, v in keys.items() if v is not None}


def fixture(spark):
    rows = []

    def add(i, start, speaker, content, video="v"):
        rows.append((i, video, i, start, "00:10:00,000", speaker, "en", content, None, None, "x", 1))

    add(1, "00:00:01,000", None, "I begin without a name.")
    add(2, "00:00:02,000", "Speaker 1", "And go on.")
    add(2, "00:00:02,000", "Speaker 1", "And go on.")
    add(3, "00:00:03,000", "Speaker 2", "[Music]")
    add(4, "00:00:04,000", "?", "I am still the first.")
    add(5, "00:00:05,000", "Unknown", ">> Ilvar Dreswick: My turn.")
    add(6, "00:00:07,000", "S1", "Mine again.")
    add(7, "00:00:06,000", "n/a", "Good point.")
    add(8, "00:50:00,000", "Spk 1", "Much later.")
    add(9, "00:51:00,000", "Nobody Known", "Still one.")
    add(10, "bad", "Speaker 2", "No start.")
    add(11, "00:00:01,000", None, "No speaker at all.", "w")
    add(12, "00:00:01,000", "Speaker 1", None, "u")
    return spark.createDataFrame(rows, SEGMENT), spark.createDataFrame([("v", 1, "Petra Thalling", None), ("v", 2, "Ilvar Dreswick", "Guest")], SPEAKER)


def test_turn_starts(spark):
    segments, speakers = fixture(spark)
    got = {tuple(r) for r in turn_starts(segments, speakers, Fillers()).select("video_id", "first_segment_id", "speaker_no").collect()}
    assert got == {("v", 1, 1), ("v", 5, 2), ("v", 6, 1)}
    texts = {r.segment_id: (r.turn_id, r.text) for r in clean_turns(segments, speakers).collect()}
    assert texts[4] == (1, "I am still the first.") and texts[5] == (5, "My turn.") and texts[8][0] == 6 and 3 not in texts


def test_empty(spark):
    segments, speakers = fixture(spark)
    assert turn_starts(segments.limit(0), speakers).count() == 0
    assert turn_starts(segments, speakers.limit(0)).where("speaker_no is null").count() == 0
    assert learn_fillers(segments.limit(0)).phrases == HESITATIONS


def test_whole_table(spark, data):
    segments, speakers = table(spark, data, "transcript_segments"), table(spark, data, "video_speakers")
    fillers = learn_fillers(segments)
    rows = spoken_segments(segments, speakers, fillers).toPandas().drop_duplicates("segment_id").sort_values(["video_id", "start_ms"])
    expected = set()
    for video, group in rows.groupby("video_id"):
        number = group.speaker_no.ffill().bfill()
        if number.notna().any():
            change = number != number.shift()
            expected |= {(video, int(i), int(n)) for i, n in zip(group.segment_id[change], number[change])}
    found = turn_starts(segments, speakers, fillers).select("video_id", "first_segment_id", "speaker_no").collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_rare_filler(spark):
    """A filler that is rare among the segments is counted in all of them, whatever the sample for the fit."""
    texts = ["the old kiln is warm today"] * 2000 + ["the kiln, um, is warm"] * 40 + ["the kiln, you know, is warm"] * 12
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "segment_id bigint, content string")
    assert "you know" in learn_fillers(df, bound=200).phrases
