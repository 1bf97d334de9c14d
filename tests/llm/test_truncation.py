"""Endings and hidden limits on small fixtures, planted cuts in whole texts."""

from __future__ import annotations

from collections import Counter

import pytest

from segloom.llm.truncation import ENCODINGS, continuations, core, ending, hidden_limits, judge_endings, lengths, plain, source_key, truncated, truncation_rates
from segloom.session import table

DOCUMENT = "doc_id bigint, text string, source string, truncated string, word int"


@pytest.mark.parametrize(
    ("text", "verdict"),
    [
        *[(t, "complete") for t in ("All is well here.", "Is all well here?", "It is done now! 👍", "Nothing more to say here. #tag", "", "  ", "n/a", "<p>All is well here.</p>", "All is well here.\n— Petra Thalling", "All is well. | via clipwire")],
        *[(t, "broken") for t in ("All is we [...]", "All is we (Read m", "The old lighthou&am", "The old lighthou�", "The old lighthou<a hre", "One, two, three,")],
        *[(t, "open") for t in ("The old lighthouse compares the wat", "00:00 one two\n01:00 three four", "The old light\n-- clipwire reader")],
        *[("https://x.y/" + "a" * 300 + " The old lighthouse compares the wat", "open"), (" " * 210 + "The old lighthouse compares the wat", "open")],
        *[("The old lighthouse waits, see https://x.y/" + "a" * 300, "broken"), ('The old light <a title="' + "one two " * 40, "broken")],
        *[("All is well here. https://x.y/z/" + "a" * 300, "complete"), ('All is well here. <a title="' + "one two " * 40 + '">', "complete")],
        *[(t, "trailing") for t in ("The old lighthouse compares the…", "All is well here. To be continued…")],
    ],
)
def test_ending(text, verdict):
    assert ending(plain(text))[0] == verdict


def test_plain():
    assert plain("cachÃ©e &amp; a​b") == "cachée & ab"
    assert core("Text here. 👍 #tag ")[0] == "Text here."
    held: Counter = Counter()
    continuations("One two. Three four\n- five six\n- seven", held)
    assert held["prose", "one", "two", True] == 1 and held["prose", "five", "six", True] == 1 and ("prose", "^", "seven", True) not in held


def test_lengths():
    text = 'é"<\n🌊&'
    got = dict(zip(ENCODINGS, lengths(text)))
    assert got == {"chars": 6, "utf8": 10, "utf16": 7, "html": 6 + 4 + 3 + 5, "html_utf8": 10 + 12, "json": 8, "json_utf8": 12, "json_ascii": 8 + 5 * 2 + 6, "crlf": 7, "crlf_utf8": 11}
    assert dict(zip(ENCODINGS, lengths("a\x01\t\\")))["json"] == 1 + 6 + 2 + 2


def test_planted(spark, data):
    whole = [r.text for r in table(spark, data, "documents").where("length(text) > 150").select("text").distinct().collect()]
    texts = [t for t in whole if t.rstrip().endswith(".")]
    rows = [(i, t, "Src One", "x", 1) for i, t in enumerate(texts)]
    cut = [(10_000 + i, t[:120], "src-one ", "x", 1) for i, t in enumerate(texts)]
    rows += [r for r in cut if r[1].rstrip()[-1] not in ".!?"]
    rows += [(20_000, None, None, "x", 1), (20_001, "", "other", "x", 1), (20_002, " \n", "other", "x", 1), (None, "All is well here.", "other", "x", 1), (20_003, "x" * 200_000 + ".", "other", "x", 1)]
    df = spark.createDataFrame(rows, DOCUMENT)
    got = {r.doc_id: r.truncated for r in truncated(df).collect()}
    assert len(got) == len(rows)
    planted = [r[0] for r in rows if r[0] is not None and 10_000 <= r[0] < 20_000]
    assert sum(got[i] for i in planted) >= 0.95 * len(planted) > 10
    assert not any(got[i] for i in (None, 20_000, 20_001, 20_002, 20_003)) and not any(got[i] for i in range(len(texts)))
    limits = {(r.source, r.encoding, r.length) for r in hidden_limits(judge_endings(df)[0]).collect()}
    assert ("src_one", "chars", 120) in limits
    reasons = Counter(r.reason for r in truncated(df).where("doc_id between 10000 and 19999").collect())
    assert set(reasons) == {"limit", "mark"} and reasons["limit"] > reasons["mark"]  # after a comma the mark tells
    rates = {r.source: (r.documents, r.truncated) for r in truncation_rates(truncated(df)).collect()}
    assert rates["other"] == (4, 0) and rates[None] == (1, 0) and rates["src_one"][0] == len(rows) - 5


def test_limits_alone(spark):
    """Cut where the corpus ends sentences, too: only the length tells; a spike of closed texts is no limit."""
    numbers = ("ash", "birch", "cedar", "elm", "fir", "hazel", "larch", "maple", "oak", "pine", "rowan", "yew")
    whole = [f"The {a} tree stands by the {b} tree." + " It is old now." * (n % 17 + 3) for n, (a, b) in enumerate((a, b) for a in numbers for b in numbers)]
    cut = [(f"The {a} tree stands by the {b} tree." + " It is old now." * 30)[: 120 - (len(a) + len(b))] for a in numbers for b in numbers if a != b]
    cut = [t + " It is old now"[: 120 - len(t)] for t in cut]
    rows = [(n, t, "Notes", "x", 1) for n, t in enumerate(whole)] + [(1000 + n, t, "wire", "x", 1) for n, t in enumerate(whole)]
    rows += [(2000 + n, t, "wire", "x", 1) for n, t in enumerate(cut)] + [(5000, "It is old now", "notes", "x", 1)] + [(6000 + n, t[:60].rsplit(" ", 1)[0].ljust(79, "x") + ".", "desk", "x", 1) for n, t in enumerate(whole)]
    df = spark.createDataFrame(rows, DOCUMENT)
    got = {r.doc_id: r.reason for r in truncated(df).collect()}
    at = [r[0] for r in rows if 2000 <= r[0] < 5000 and len(r[1]) == 120 and r[1][-1] not in ".!?"]
    assert len(at) > 20 and all(got[i] == "limit" for i in at)
    assert not any(got[r[0]] for r in rows if r[0] < 2000 or r[0] >= 6000)
    assert {r.source for r in hidden_limits(judge_endings(df)[0]).collect()} == {"wire"}


def test_trailing_off(spark):
    """What trails off on purpose is learned from the texts that end in it."""
    numbers = ("ash", "birch", "cedar", "elm", "fir", "hazel")
    rows = [(n, f"The {a} tree is old. Sooner or later...", "notes", "x", 1) for n, a in enumerate(numbers)]
    rows += [(100 + n, f"The {a} tree is old and tall. The bird sees it now and then.", "notes", "x", 1) for n, a in enumerate(numbers)]
    rows += [(200, "The elm tree is old and...", "notes", "x", 1)]
    got = {r.doc_id: r.truncated for r in truncated(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert [i for i, t in got.items() if t] == [200]


def test_sources_and_empty(spark):
    df = spark.createDataFrame([("Stage Notes ",), ("stage-notes",), ("STAGE_NOTES",), (None,)], "s string")
    assert [r.k for r in df.select(source_key(df.s).alias("k")).collect()] == ["stage_notes"] * 3 + [None]
    assert truncated(spark.createDataFrame([], DOCUMENT)).count() == 0
