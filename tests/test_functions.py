"""Scalar functions on small tables of expected values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.functions import timecode as tc
from segloom.functions import vectors as vx
from segloom.functions.binding import let


def values(spark, items, column, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parse_ms(spark):
    cases = {
        "00:06:582": 6582,
        "75:10:005": 4510005,
        "01:02:03,004": 3723004,
        "01:75:03:004": 8103004,
        "01:02:03": 62003,
        "00:06:5": 6005,
        "00:00:01,2345": 3345,
        " 00:00:01,000 ": 1000,
        "12:34": None,
        "aa:bb:ccc": None,
        "00:00:05.226": None,
        "-1:00:000": None,
        "+1:00:000": None,
        "1: 2:000": None,
        "::": None,
        "1:2:3:4:5": None,
        "0:0:99999999999999999999": None,
        "99999999999999999:0:0": None,
        "": None,
        None: None,
    }
    assert dict(zip(cases, values(spark, list(cases), tc.parse_ms))) == cases


def test_parse_seconds(spark):
    cases = {"00:06:582": 6.582, "75:10:005": 4510.005, "01:02:03,004": 3723.004, "01:75:03:004": 8103.004, "01:02:03": 62.003, "00:00:01,2345": 3.345, "12:34": 0.0, "aa:bb:ccc": None, None: 0.0}
    got = dict(zip(cases, values(spark, list(cases), tc.parse_seconds)))
    assert {k: v if v is None else round(v, 6) for k, v in got.items()} == cases


def test_normalize(spark):
    cases = {
        "00:06:582": "00:00:06,582",
        "75:10:005": "01:15:10,005",
        "01:02:03,004": "01:02:03,004",
        "01:75:03:004": "01:75:03,004",
        "01:02:03": "00:01:02,003",
        "00:06:5": "00:00:06,005",
        "00:00:01,2345": "00:00:01,2345",
        "12:34": "00:00:00,000",
        "aa:bb:ccc": "00:00:00,000",
        None: "00:00:00,000",
    }
    assert dict(zip(cases, values(spark, list(cases), tc.normalize))) == cases


def test_minutes_seconds(spark):
    assert values(spark, [0.0, 61.9, 3600.0], tc.minutes_seconds, "double") == ["0:00", "1:01", "60:00"]


@pytest.mark.parametrize(("words", "tokens"), [(0, 0), (1, 1), (3, 3), (10, 13), (98, 127), (99, 128), (197, 256), (198, 257)])
def test_token_count(spark, words, tokens):
    assert values(spark, [" ".join(["w"] * words)], tx.token_count) == [tokens]


def test_words_and_overlap(spark):
    assert values(spark, [" a b\x1cc \n", "", None, "　"], tx.words) == [["a", "b", "c"], [], [], []]
    assert tx.overlap_words(50) == 38
    long = "  ".join(str(i) for i in range(50))
    assert values(spark, [long, "a  b"], lambda x: tx.last_tokens(x, 50)) == [" ".join(str(i) for i in range(12, 50)), "a  b"]
    assert values(spark, [long], lambda x: tx.first_tokens(x, 50)) == [" ".join(str(i) for i in range(38))]


def test_continuation(spark):
    cases = {"So we": True, "Some": True, "And then": True, "ça va": True, "12. x": True, "This": True, "Carbon": True, "And": False, "Hello": False, " So": False, None: False}
    assert dict(zip(cases, values(spark, list(cases), tx.is_continuation))) == cases


def test_names(spark):
    titles = {"Hello, World! (2024)": "Hello_World_2024", "a  b": "a__b", "Été: l'eau": "Été_leau"}
    assert dict(zip(titles, values(spark, list(titles), tx.sanitize_title))) == titles
    assert values(spark, ["My_Talk-part 1"], tx.stem_id) == ["My_Talk-part_1"]
    assert values(spark, ["My_Talk-part 1"], tx.stem_title) == ["My Talk - part 1"]
    assert values(spark, [7, 1000], lambda n: tx.numbered_id(F.lit("v"), "_", n), "int") == ["v_007", "v_1000"]
    assert values(spark, [765.9], lambda s: tx.deep_link(F.lit("ID"), s), "double")[0].endswith("watch?v=ID&t=765s")
    assert values(spark, ["a.MP3", "b", None, "c.opus"], tx.media_type) == ["audio/mpeg", "audio/webm", "audio/webm", "audio/opus"]


def test_vectors(spark):
    rows = [([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]), ([3.0, 4.0], [3.0, 4.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [r.c for r in df.select(vx.cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got[:4] == [0.0, -1.0, 0.0, None] and abs(got[4] - 1) < 1e-12
    usable = [r.c for r in spark.createDataFrame([([1.0, 2.0],), ([0.0, 0.0],), ([float("nan"), 1.0],), ([1.0],), (None,), ([float("inf"), 1.0],)], "a array<float>").select(vx.usable(F.col("a"), 2).alias("c")).collect()]
    assert usable == [True, False, False, False, False, False]
    assert spark.createDataFrame([([0.5, -1.0, 0.0],), ([0.0],)], "a array<float>").select(vx.quantised(F.col("a")).alias("c")).collect()[0].c == [64, -127, 0]


def test_let(spark):
    assert values(spark, [2, None], lambda x: let(x + 1, lambda y: y * y), "int") == [9, None]
