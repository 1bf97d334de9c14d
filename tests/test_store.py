"""Store, search, ledger, sources, services and streams on small fixtures."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.config import StoreConfig
from segloom.operators import chunks as ch
from segloom.operators import ledger, search
from segloom.operators.segments import deliver_once, scan_segments
from segloom.operators.store import Store, child_rows, new_videos
from segloom.session import hash_sample, table
from segloom.sources import services, transcripts
from segloom.streaming.ingest import SEGMENTS, append_available, segment_stream, transcript_stream


def test_store(spark, data, tmp_path):
    store = Store(spark, StoreConfig(str(tmp_path / "store"), dimension=64, use_quantized=False))
    videos, parents, children = (table(spark, data, n) for n in ("videos", "parent_chunks", "child_chunks"))
    first = [r.video_id for r in videos.orderBy("video_id").limit(3).collect()]
    part = lambda df: df.where(F.col("video_id").isin(first))
    assert store.ingest(part(videos), part(parents), part(children)) == {"added": 3, "present": 0}
    before = store.stats().collect()[0]
    assert before.videos == 3
    assert store.ingest(videos, parents, children)["present"] == 3
    assert store.ingest(videos, parents, children)["added"] == 0
    full = store.stats().collect()[0]
    assert full.videos == videos.count() and full.child_chunks == children.select("chunk_id").distinct().count()
    assert store.list_videos().count() == full.videos
    query = search.usable_vectors(store.table("child_chunks"), "chunk_id", "embedding", 64).orderBy("key").limit(1)
    hits = store.search(query, 3).orderBy("place").collect()
    assert hits[0].query == hits[0].chunk_id and hits[0].distance == 0 and len(hits) == 3
    gone = hits[0].video_id
    assert store.delete(gone) and not store.delete(gone)
    left = store.stats().collect()[0]
    assert left.videos == full.videos - 1
    assert store.table("child_chunks").where(F.col("video_id") == gone).count() == 0
    # A delete that was cut off after its first rename: the part that was set aside comes back.
    part = next((tmp_path / "store" / "videos").glob("bucket=*"))
    (tmp_path / "store" / ".old-videos").mkdir(exist_ok=True)
    part.rename(tmp_path / "store" / ".old-videos" / part.name)
    assert store.table("videos").count() == left.videos


def test_child_rows_and_new_videos(spark):
    rows = spark.createDataFrame([("c", 0, "v", "", "t", 0.0, 1.0, 1, "l", None, None, [1.0])] * 2, "chunk_id string, chunk_index int, video_id string, parent_chunk_id string, text string, start_time double, end_time double, token_count int, youtube_link string, context_before string, context_after string, embedding array<double>")
    stored = child_rows(rows).collect()
    assert len(stored) == 1 and stored[0].parent_chunk_id is None and stored[0].context_before == ""
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "video_id string")
    assert [r.video_id for r in new_videos(ids("a", "b", "b", None), ids("a")).collect()] == ["b"]


@pytest.mark.parametrize("quantised", [False, True])
def test_nearest(spark, quantised):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(500, None), (501, [0.0] * 8), (502, [1.0]), (503, [float("nan")] * 8), (504, [float(v) for v in x[0]])]
    df = spark.createDataFrame(rows, "id int, e array<double>")
    corpus = search.usable_vectors(df, "id", "e", 8)
    queries = search.usable_vectors(df.where("id % 20 = 0"), "id", "e", 8)
    one = {(r.query, r.place): (r.key, r.distance) for r in search.nearest(corpus, queries, 5, 8, quantised=quantised).collect()}
    many = {(r.query, r.place): (r.key, r.distance) for r in search.nearest(corpus, queries, 5, 8, quantised=quantised, block=4, part_size=100).collect()}
    assert one == many and len(one) == 15 * 5
    assert one[0, 1][0] == 0 and one[0, 2][0] == 504  # equal vectors: the smaller key first
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = set(np.argsort(-(unit[20] @ unit.T), kind="stable")[:5].tolist())
    assert len(best & {one[20, p][0] for p in range(1, 6)}) >= (5 if not quantised else 4)
    assert search.nearest(corpus.limit(0), queries, 5, 8).count() == 0
    assert search.nearest(corpus, queries.limit(0), 5, 8).count() == 0


def test_ledger(spark):
    columns = "video_id string, url string, title string, status string, error string, processed_at string, input_tokens bigint, output_tokens bigint, cost_usd double"
    row = lambda v, s, at, n=None: (v, "u", "t", s, None, at, n, n, None)
    rows = spark.createDataFrame([row("a", "error", "2024-01-01T00:00:00"), row("a", "done", "2024-01-02T00:00:00", 5), row("b", "pending", None), row(None, "done", "x"), row("b", "pending", None)], columns)
    latest = {r.video_id: (r.status, r.input_tokens, r.cost_usd) for r in ledger.latest_rows(rows).collect()}
    assert latest == {"a": ("done", 5, 0.0), "b": ("pending", 0, 0.0)}
    entries = spark.createDataFrame([("a", "new title"), ("d", "fresh"), ("d", "fresh"), (None, "x")], "video_id string, title string")
    merged = {r.video_id: (r.title, r.status) for r in ledger.merged(rows, entries).collect()}
    assert merged == {"a": ("t", "done"), "b": ("t", "pending"), "d": ("fresh", "pending")}
    once = ledger.merged(rows, entries)
    assert ledger.merged(rows.limit(0), entries).count() == 2 and once.count() == 3
    assert [(r.n, r.tokens) for r in ledger.running_totals(ledger.latest_rows(rows)).collect()] == [(1, 10)]


def test_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    segment = {"start_time": "00:00:01,000", "end_time": "00:00:02,000", "content": " Hé \n"}
    (folder / "My Talk.json").write_text(json.dumps({"segments": [segment, {**segment, "content": " ", "speaker": "A"}]}))
    (folder / "empty.json").write_text("{}")
    (folder / "broken.json").write_text("{no json")
    (folder / "manifest.json").write_text("{}")
    chunk = {"chunk_id": "v_000", "chunk_index": 0, "video_id": "v", "text": "t", "start_time": 0.0, "end_time": 1.0, "token_count": 1}
    (folder / "v_chunks.json").write_text(json.dumps({"video_id": "v", "video_title": "V", "total_chunks": 1, "chunks": [chunk]}))
    segments, broken = transcripts.read_transcripts(spark, str(folder))
    assert {(r.video_id, r.seg_index, r.speaker) for r in segments.collect()} == {("My_Talk", 0, None), ("My_Talk", 1, "A")}
    assert [r.video_id for r in broken.collect()] == ["broken"]
    videos, children, parents = transcripts.read_chunked(spark, str(folder))
    assert videos.collect()[0].total_parent_chunks == 0 and children.collect()[0].parent_chunk_id == "" and parents.count() == 0
    ready = segments.withColumns({"segment_id": F.col("seg_index").cast("bigint"), "seg_start": F.lit(None).cast("double")})
    assert [r.text for r in scan_segments(ready).collect()] == ["Hé"]
    cues = transcripts.subtitle_cues(ready).orderBy("cue_no").collect()
    assert [c.cue_no for c in cues] == [1, 2] and cues[0].cue.startswith("1\n00:00:01,000 --> 00:00:02,000\n")
    transcripts.write_chunked(videos, children, parents, str(tmp_path / "chunked"))
    back = transcripts.read_chunked(spark, str(tmp_path / "chunked"))
    assert [sorted(map(str, x.collect())) for x in back] == [sorted(map(str, x.collect())) for x in (videos, children, parents)]
    transcripts.write_manifest(transcripts.manifest(videos.selectExpr("video_id", "video_title", "total_chunks as chunks", "total_parent_chunks as parent_chunks")), str(tmp_path / "manifest"))
    assert {(r.video_id, r.title, r.chunks) for r in transcripts.read_manifest(spark, str(tmp_path / "manifest")).collect()} == {("v", "V", 1), (None, "total", 1)}
    (tmp_path / "ledger.csv").write_text("video_id,url,title,status,error,processed_at,input_tokens,output_tokens,cost_usd\na,u,t,done,,2024,,x,1.5\n")
    rows = transcripts.read_ledger(spark, str(tmp_path / "ledger.csv"))
    assert [(r.input_tokens, r.output_tokens, r.cost_usd) for r in rows.collect()] == [(0, 0, 1.5)]
    transcripts.write_ledger(rows, str(tmp_path / "again"))
    assert transcripts.read_ledger(spark, str(tmp_path / "again")).collect() == rows.collect()


def test_written_files_are_read_back(spark, data, tmp_path):
    """All segments of the table, in order, in few files a video."""
    rows = deliver_once(table(spark, data, "transcript_segments")).where("video_id is not null and seg_index is not null")
    columns = ["video_id", "seg_index", "start_time", "end_time", "speaker", "language", "content"]
    for run in range(2):
        transcripts.write_transcripts(rows, str(tmp_path / "out"))
    segments, broken = transcripts.read_transcripts(spark, str(tmp_path / "out"))
    expected = sorted(tuple(r) for r in rows.select("video_id", "seg_index").collect())
    assert sorted(tuple(r) for r in segments.select("video_id", "seg_index").collect()) == expected
    assert segments.select(columns).exceptAll(rows.select(columns)).count() == 0 and broken.count() == 0
    for folder in (tmp_path / "out").glob("video_id=*"):
        parts = sorted(folder.glob("part-*"))
        places = [json.loads(line)["seg_index"] for f in parts for line in f.read_text().splitlines()]
        assert places == sorted(places) and len(parts) <= 5
    transcripts.write_subtitles(rows, str(tmp_path / "srt"))
    cues = {(r.video_id, r.cue_no): r for r in transcripts.read_subtitles(spark, str(tmp_path / "srt")).collect()}
    written = transcripts.subtitle_cues(rows).collect()
    assert set(cues) == {(r.video_id, r.cue_no) for r in written}
    first = next(r for r in written if r.cue_no == 1)
    assert f"{cues[first.video_id, 1].start_time} --> {cues[first.video_id, 1].end_time}" in first.cue
    one = tmp_path / "One Talk.json"
    one.write_text(json.dumps({"segments": [{"start_time": "0:0:1", "end_time": "0:0:2", "content": "x"}]}))
    assert [r.video_id for r in transcripts.read_transcripts(spark, str(one))[0].collect()] == ["One_Talk"]


def test_nearest_does_not_depend_on_partitions(spark):
    """Distances that differ beyond the sixth decimal rank as they are, however the rows are parted."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    rows = [(f"k{i % 300:03d}", [float(v) for v in x[i % 300] * (1 + i)]) for i in range(400)]
    rows += [("z", [1.0, 1e-4] + [0.0] * 6), ("a", [1.0, 1.0001e-4] + [0.0] * 6)]
    df = spark.createDataFrame(rows, "id string, e array<double>")
    queries = search.usable_vectors(spark.createDataFrame([("q", [1.0] + [0.0] * 7), ("p", rows[5][1])], df.schema), "id", "e", 8)
    for quantised in (False, True):
        found = []
        for parts in (1, 4, 16):
            corpus = search.usable_vectors(df.repartition(parts), "id", "e", 8)
            found.append(sorted((r.query, r.place, r.key, r.distance) for r in search.nearest(corpus, queries, 6, 8, quantised=quantised).collect()))
        assert found[0] == found[1] == found[2]
        if not quantised:
            assert [h[2] for h in found[0] if h[0] == "q"][:2] == ["z", "a"]


def test_running_totals_in_parts(spark):
    rows = [(f"v{i:03d}", "u", "t", "done", None, f"2024-01-01T00:00:{i % 7:02d}", i, 1, 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, "video_id string, url string, title string, status string, error string, processed_at string, input_tokens bigint, output_tokens bigint, cost_usd double")
    got = sorted((r.n, r.video_id, r.tokens, r.cost_usd) for r in ledger.running_totals(df, parts=5).collect())
    total, expected = 0, []
    for n, r in enumerate(sorted(rows, key=lambda r: (r[5], r[0])), 1):
        total += r[6] + 1
        expected.append((n, r[0], total, round(0.5 * n, 4)))
    assert got == expected and ledger.running_totals(df.limit(0)).count() == 0
    assert tuple(ledger.run_totals(df, "2024-01-01T00:00:06").first()) == (28, sum(r[6] for r in rows if r[5].endswith("06")), 28, 14.0)
    assert tuple(ledger.run_totals(df, "2025").first()) == (0, 0, 0, 0.0)


def test_shared_folder():
    """Without a named folder only a session in one machine gets a temporary one."""
    from types import SimpleNamespace

    from segloom.session import shared_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(far)
    far.sparkContext.master = "local[2]"
    assert shared_dir(far).startswith("file://")


def test_services(spark):
    waits = []

    class Client:
        calls = 0

        def embed(self, texts):
            self.calls += 1
            if self.calls == 1:
                raise services.Busy
            return np.array([[len(t), 1.0] for t in texts])

    client = Client()
    assert services.patiently(lambda: client.embed(["abc"]), sleep=waits.append).tolist() == [[3, 1]] and waits == [10.0]
    with pytest.raises(services.Busy):
        services.patiently(lambda: Client().embed([]), sleep=waits.append)
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id int, t string")

    class Plain:
        def embed(self, texts):
            return np.array([[len(t), 1.0] for t in texts])

    assert {r.id: r.embedding for r in services.embed_texts(df, "id", "t", Plain).collect()} == {1: [2.0, 1.0], 2: [0.0, 1.0]}

    class Reader:
        def transcribe(self, path):
            if path == "bad":
                raise OSError("no audio")
            return "{}", 3, 4

    got = {r.path: (r.input_tokens, r.error) for r in services.transcribe_files(spark.createDataFrame([("a",), ("bad",)], "path string"), Reader).collect()}
    assert got == {"a": (3, None), "bad": (0, "no audio")}
    hashed = {r.id: r.embedding for r in services.hash_embeddings(df, "id", "t").collect()}
    assert abs(sum(v * v for v in hashed[1]) - 1) < 1e-6 and set(hashed[2]) == {0.0}


def test_streams(spark, data, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    write = lambda n: (folder / f"{n}.json").write_text(json.dumps({"segments": [{"start_time": "0:0:1", "end_time": "0:0:2", "content": n}]}))
    for names in (("a", "b"), ("c",)):
        for n in names:
            write(n)
        append_available(transcript_stream(spark, str(folder)), out, str(tmp_path / "ck"))
    assert sorted(r.content for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    rows = table(spark, data, "transcript_segments").limit(200)
    source = str(tmp_path / "segments")
    typed = rows.withColumn("received_at", F.col("received_at").cast("timestamp")).select(*[c.split()[0] for c in SEGMENTS.split(", ")])
    typed.write.parquet(source)
    append_available(segment_stream(spark, source), str(tmp_path / "scanned"), str(tmp_path / "ck2"))
    assert spark.read.parquet(str(tmp_path / "scanned")).count() == scan_segments(deliver_once(spark.read.parquet(source))).count()


def test_edges(spark):
    empty = spark.createDataFrame([], "segment_id bigint, video_id string, seg_index int, start_time string, end_time string, speaker string, language string, content string, seg_start double")
    assert ch.child_assignment(ch.pause_boundaries(ch.positioned_segments(scan_segments(empty)))).count() == 0
    nulls = spark.createDataFrame([(None,) * 9, (1, "v", 0, None, None, None, None, "x " * 50_000, None)], empty.schema)
    rows = ch.pause_boundaries(ch.positioned_segments(scan_segments(deliver_once(nulls))))
    assigned = ch.child_assignment(rows)
    assert [(r.pos, r.chunk_index) for r in assigned.collect()] == [(0, 0)]
    chunks = ch.child_chunks(rows, assigned)
    assert chunks.collect()[0].token_count == 65_000 and ch.overlap_context(chunks).collect()[0].context_after == ""
    df = spark.range(10_000)
    sample = hash_sample(df, ["id"], 1000, 10_000)
    assert 800 < sample.count() <= 1000 and sample.exceptAll(hash_sample(df, ["id"], 1000, 10_000)).count() == 0
