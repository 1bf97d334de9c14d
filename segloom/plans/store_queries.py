"""Queries on stored chunks, videos and vectors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.functions import vectors as vx
from segloom.operators import chunks as ch
from segloom.operators import search, store
from segloom.operators.ordered import dense_position
from segloom.session import materialize, shared_dir, table
from segloom.sources import transcripts
from segloom.sources.transcripts import manifest as manifest_rows

DIMENSION = 64


def _children(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "child_chunks").dropDuplicates(["chunk_id"])


def _ordered(spark: SparkSession, directory: str) -> DataFrame:
    rows = _children(spark, directory).select("chunk_id", "video_id", "chunk_index", "start_time", "end_time", "embedding")
    return materialize(dense_position(rows, "video_id", "chunk_index", "pos"), "ordered")


def boundary_semantic(spark: SparkSession, directory: str) -> DataFrame:
    rows = _ordered(spark, directory).withColumn("embedding", F.when(vx.usable(F.col("embedding"), DIMENSION), F.col("embedding")))
    found = ch.semantic_boundaries(rows, "video_id", "pos", "embedding", 0.5)
    return found.select("chunk_id", F.round("similarity", 6).alias("similarity"), "boundary")


def boundaries(spark: SparkSession, directory: str) -> DataFrame:
    rows = _ordered(spark, directory).withColumn("embedding", F.when(vx.usable(F.col("embedding"), DIMENSION), F.col("embedding")))
    meaning = ch.semantic_boundaries(rows, "video_id", "pos", "embedding", 0.5).select("chunk_id", "video_id", "pos", F.col("boundary").alias("semantic"))
    timed = rows.withColumnsRenamed({"start_time": "start", "end_time": "end"})
    pause = ch.pause_boundaries(timed, 3.0).select("chunk_id", F.col("boundary").alias("pause"))
    both = meaning.join(pause, "chunk_id").where("semantic or pause")
    return both.select("video_id", "pos")


def child_rows(spark: SparkSession, directory: str) -> DataFrame:
    return store.child_rows(table(spark, directory, "child_chunks")).drop("embedding", "text", "created_at")


def deep_link(spark: SparkSession, directory: str) -> DataFrame:
    rows = _children(spark, directory)
    return rows.select("chunk_id", tx.deep_link(F.coalesce(F.nullif("video_id", F.lit("")), F.lit("")), F.col("start_time")).alias("link"))


def _rollup(spark: SparkSession, directory: str) -> DataFrame:
    return ch.video_rollup(table(spark, directory, "videos"), _children(spark, directory), table(spark, directory, "parent_chunks"))


def video_rollup(spark: SparkSession, directory: str) -> DataFrame:
    return _rollup(spark, directory)


def manifest(spark: SparkSession, directory: str) -> DataFrame:
    return manifest_rows(materialize(_rollup(spark, directory), "rollup"))


def stored_chunk_stats(spark: SparkSession, directory: str) -> DataFrame:
    return ch.token_stats(_children(spark, directory))


def stored_parent_stats(spark: SparkSession, directory: str) -> DataFrame:
    return ch.token_stats(table(spark, directory, "parent_chunks"))


def store_stats(spark: SparkSession, directory: str) -> DataFrame:
    return store.store_stats(table(spark, directory, "videos"), table(spark, directory, "parent_chunks"), _children(spark, directory))


def list_videos(spark: SparkSession, directory: str) -> DataFrame:
    return store.list_videos(table(spark, directory, "videos"))


def ingest_new_only(spark: SparkSession, directory: str) -> DataFrame:
    """What an ingest of all videos adds to a store that has those with chunks."""
    stored = _children(spark, directory).where("video_id is not null").select("video_id").distinct()
    return store.new_videos(table(spark, directory, "videos").select("video_id", "video_title"), stored)


def scan_chunks(spark: SparkSession, directory: str) -> DataFrame:
    """The chunks read from chunk files, which are written from the tables first."""
    path = f"{shared_dir(spark)}/segloom/chunk-files-{uuid.uuid4().hex}"
    parents = table(spark, directory, "parent_chunks")
    transcripts.write_chunked(table(spark, directory, "videos").drop("created_at"), _children(spark, directory), parents, path, by_video=False)
    return transcripts.read_chunked(spark, path)[1].select("chunk_id", "chunk_index", "video_id", "parent_chunk_id", "text", "start_time", "end_time", "token_count", "youtube_link", "context_before", "context_after")


SUFFIXES = (".mp3", ".M4A", ".webm", ".opus", ".Ogg", ".wav", ".flac", "")


def mime_lookup(spark: SparkSession, directory: str) -> DataFrame:
    """The media type of an audio file of each video, whose suffix follows from its number of chunks."""
    rows = table(spark, directory, "videos")
    suffix = F.element_at(F.array(*map(F.lit, SUFFIXES)), F.pmod(F.coalesce("total_chunks", F.lit(0)), F.lit(len(SUFFIXES))) + 1)
    return rows.select("video_id", F.concat("video_id", suffix).alias("file")).select("video_id", "file", tx.media_type(F.col("file")).alias("media_type"))


def delete_cascade(spark: SparkSession, directory: str) -> DataFrame:
    """What is left in each table when the videos without a date go."""
    videos = table(spark, directory, "videos")
    gone = videos.where("created_at is null").select("video_id")
    left = lambda df, name: store.without_videos(df, gone).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
    return left(videos, "videos").unionByName(left(table(spark, directory, "parent_chunks"), "parent_chunks")).unionByName(left(_children(spark, directory), "child_chunks"))


def stem_identity(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "videos")
    return rows.select("video_id", tx.stem_id(F.col("video_title")).alias("stem_id"), tx.stem_title(F.col("video_id")).alias("stem_title"))


def sanitize_title(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "videos").select("video_id", tx.sanitize_title(F.col("video_title")).alias("file_name"))


def vec_norm(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "embeddings")
    return rows.select("vec_id", F.round(vx.norm(F.col("embedding")), 6).alias("norm"))


def _neighbouring(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "embeddings").select("vec_id", "embedding")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    return rows.join(after, "vec_id")


def vec_dot(spark: SparkSession, directory: str) -> DataFrame:
    rows = _neighbouring(spark, directory)
    return rows.select("vec_id", F.round(vx.dot(F.col("embedding"), F.col("following")), 6).alias("dot"))


def cosine_pairs(spark: SparkSession, directory: str) -> DataFrame:
    rows = _neighbouring(spark, directory)
    return rows.select("vec_id", F.round(vx.cosine(F.col("embedding"), F.col("following")), 6).alias("similarity"))


def vec_cast(spark: SparkSession, directory: str) -> DataFrame:
    rows = _children(spark, directory).where(vx.usable(F.col("embedding"), DIMENSION))
    numbers = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.round(x, 6))
    return rows.select("chunk_id", F.element_at(numbers, 1).alias("first_number"), F.element_at(numbers, -1).alias("last_number"), F.size(numbers).alias("dimension"))


def quantize(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "embeddings")
    return rows.select("vec_id", F.array_join(vx.quantised(F.col("embedding")).cast("array<string>"), ",").alias("codes"))


def embed_hash(spark: SparkSession, directory: str) -> DataFrame:
    """The hashed embedding of every parent text, one row for each number that isn't 0."""
    rows = table(spark, directory, "parent_chunks").select("parent_chunk_id", F.explode(tx.hashed_words(F.col("text"), DIMENSION)).alias("w"))
    return rows.groupBy("parent_chunk_id", F.col("w.bucket").alias("bucket")).agg(F.sum("w.sign").alias("value")).where("value <> 0")


def _queries(spark: SparkSession, directory: str) -> DataFrame:
    """The stated query set: every vector whose id is divisible by 20."""
    return search.usable_vectors(table(spark, directory, "embeddings").where("vec_id % 20 = 0"), "vec_id", "embedding", DIMENSION)


def _hits(spark: SparkSession, directory: str, k: int, quantised: bool = False) -> DataFrame:
    corpus = search.usable_vectors(_children(spark, directory), "chunk_id", "embedding", DIMENSION)
    return search.nearest(corpus, _queries(spark, directory), k, DIMENSION, quantised=quantised)


def knn_exact(spark: SparkSession, directory: str) -> DataFrame:
    return _hits(spark, directory, 10)


def knn_quantized(spark: SparkSession, directory: str) -> DataFrame:
    return _hits(spark, directory, 10, quantised=True)


def knn_threshold(spark: SparkSession, directory: str) -> DataFrame:
    return _hits(spark, directory, 10).where("distance <= 0.7").select("query", "key", "distance")


def knn_batch(spark: SparkSession, directory: str) -> DataFrame:
    """The nearest other vectors of the embeddings table for each query."""
    corpus = search.usable_vectors(table(spark, directory, "embeddings"), "vec_id", "embedding", DIMENSION)
    return search.nearest(corpus, _queries(spark, directory), 5, DIMENSION)


def eval_metrics(spark: SparkSession, directory: str) -> DataFrame:
    labels = table(spark, directory, "embeddings").select(F.col("vec_id").alias("key"), "label")
    return search.hit_rates(knn_batch(spark, directory), labels, labels.withColumnsRenamed({"key": "query", "label": "query_label"}))


def _context(spark: SparkSession, directory: str) -> DataFrame:
    return search.with_context(_hits(spark, directory, 5), table(spark, directory, "child_chunks"), table(spark, directory, "videos"), table(spark, directory, "parent_chunks"))


def search_context(spark: SparkSession, directory: str) -> DataFrame:
    return _context(spark, directory)


def search_display(spark: SparkSession, directory: str) -> DataFrame:
    return search.rendered(_context(spark, directory))


QUERIES = {
    f.__name__: f
    for f in (
        *(boundary_semantic, boundaries, child_rows, deep_link, video_rollup, manifest, stored_chunk_stats, stored_parent_stats),
        *(store_stats, list_videos, ingest_new_only, scan_chunks, mime_lookup, delete_cascade, stem_identity, sanitize_title),
        *(vec_norm, vec_dot, cosine_pairs, vec_cast, quantize, embed_hash),
        *(knn_exact, knn_quantized, knn_threshold, knn_batch, eval_metrics, search_context, search_display),
    )
}

_ONCE = "once as (select distinct on (chunk_id) * from child_chunks)"
_OK = "(embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0)"


def _cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}::double[], {b}::double[])"


_SEMANTIC = f"""{_ONCE},
placed as (select chunk_id, video_id, start_time, end_time, row_number() over w - 1 as pos, case when {_OK} then embedding end as emb, lag(case when {_OK} then embedding end) over w as prev,
           lag(end_time) over w as prev_end, lag(chunk_id) over w as prev_id from once where video_id is not null and chunk_index is not null window w as (partition by video_id order by chunk_index)),
marked as (select *, case when prev_id is not null then coalesce({_cosine('emb', 'prev')}, 0.0) end as sim from placed)"""


def _knn(corpus: str, key: str, k: int, distance: str, extra: str = "") -> str:
    return f"""q as (select vec_id as query, embedding as qe from embeddings where vec_id % 20 = 0 and {_OK}),
ranked as (select query, {key} as key, round({distance}, 6) as distance, cast(row_number() over (partition by query order by round({distance}, 12), {key}) as integer) as place
           from q, (select * from {corpus} where {_OK} and {key} is not null {extra}))"""


_EXACT = "greatest(0.0, 1.0 - list_cosine_similarity(qe::double[], embedding::double[]))"
_CODES = "list_transform({0}, lambda x: floor(x::double * 127.0 / list_max(list_transform({0}, lambda y: abs(y::double))) + 0.5))"
_COARSE = f"greatest(0.0, 1.0 - list_cosine_similarity({_CODES.format('qe')}, {_CODES.format('embedding')}))"
_CHUNK_HITS = f"{_ONCE}, {_knn('once', 'chunk_id', 5, _EXACT)}"
_CONTEXT = f"""{_CHUNK_HITS},
context as (
  select query, place, distance, c.chunk_id, c.video_id, v.video_title, c.start_time, c.end_time, c.youtube_link, coalesce(c.parent_chunk_id, '') as parent_chunk_id,
         coalesce(nullif(p.text, ''), c.text, '') as context
  from ranked r join once c on r.key = c.chunk_id join videos v on v.video_id = c.video_id left join parent_chunks p on p.parent_chunk_id = c.parent_chunk_id
  where place <= 5)"""
_CLOCK = "printf('%d:%02d', cast(floor({0} / 60) as bigint), cast(floor({0}) as bigint) % 60)"
_ROLLUP = f"""{_ONCE}, rollup as (
  select v.video_id, v.video_title, coalesce(c.n, 0) as chunks, coalesce(p.n, 0) as parent_chunks from videos v
  left join (select video_id, count(*) as n from once group by 1) c on c.video_id = v.video_id
  left join (select video_id, count(*) as n from parent_chunks group by 1) p on p.video_id = v.video_id)"""
_STATS = "select video_id, count(*) as chunks, round(avg(token_count), 6) as avg_tokens, min(token_count) as min_tokens, max(token_count) as max_tokens"
_PAIRS = "select a.vec_id, {0} from embeddings a join embeddings b on b.vec_id = a.vec_id + 1"

SQL = {
    "boundary_semantic": f"with {_SEMANTIC} select chunk_id, round(sim, 6) as similarity, coalesce(round(sim, 6) < 0.5, false) as boundary from marked",
    "boundaries": f"with {_SEMANTIC} select video_id, pos from marked where coalesce(round(sim, 6) < 0.5, false) or coalesce(round(start_time - prev_end, 3) > 3.0, false)",
    "child_rows": f"with {_ONCE} select chunk_id, chunk_index, video_id, nullif(parent_chunk_id, '') as parent_chunk_id, start_time, end_time, token_count, youtube_link, coalesce(context_before, '') as context_before, coalesce(context_after, '') as context_after from once",
    "deep_link": f"with {_ONCE} select chunk_id, 'https://www.youtube.com/watch?v=' || coalesce(video_id, '') || '&t=' || cast(cast(trunc(start_time) as bigint) as varchar) || 's' as link from once",
    "video_rollup": f"with {_ROLLUP} select * from rollup",
    "manifest": f"with {_ROLLUP} select video_id, video_title as title, chunks, parent_chunks from rollup union all select null, 'total', coalesce(sum(chunks), 0)::bigint, coalesce(sum(parent_chunks), 0)::bigint from rollup",
    "stored_chunk_stats": f"with {_ONCE} {_STATS} from once group by video_id",
    "stored_parent_stats": f"{_STATS} from parent_chunks group by video_id",
    "store_stats": f"with {_ONCE} select (select count(*) from videos) as videos, (select count(*) from parent_chunks) as parent_chunks, count(*) as child_chunks, count(embedding) as chunks_with_embeddings from once",
    "list_videos": "select video_id, video_title, total_chunks, total_parent_chunks, created_at from videos",
    "ingest_new_only": "select video_id, video_title from videos where video_id is not null and video_id not in (select video_id from child_chunks where video_id is not null)",
    "scan_chunks": f"with {_ONCE} select chunk_id, chunk_index, video_id, coalesce(parent_chunk_id, '') as parent_chunk_id, text, start_time, end_time, token_count, coalesce(youtube_link, '') as youtube_link, coalesce(context_before, '') as context_before, coalesce(context_after, '') as context_after from once",
    "mime_lookup": """select video_id, file, case when ends_with(lower(file), '.mp3') then 'audio/mpeg' when ends_with(lower(file), '.m4a') then 'audio/mp4' when ends_with(lower(file), '.webm') then 'audio/webm'
  when ends_with(lower(file), '.opus') then 'audio/opus' when ends_with(lower(file), '.ogg') then 'audio/ogg' when ends_with(lower(file), '.wav') then 'audio/wav' else 'audio/webm' end as media_type
  from (select video_id, video_id || ['.mp3', '.M4A', '.webm', '.opus', '.Ogg', '.wav', '.flac', ''][coalesce(total_chunks, 0) % 8 + 1] as file from videos)""",
    "delete_cascade": f"""with {_ONCE}, gone as (select video_id from videos where created_at is null)
select 'videos' as table_name, count(*) as n from videos where video_id is null or video_id not in (select video_id from gone)
union all select 'parent_chunks', count(*) from parent_chunks where video_id is null or video_id not in (select video_id from gone)
union all select 'child_chunks', count(*) from once where video_id is null or video_id not in (select video_id from gone)""",
    "stem_identity": "select video_id, replace(video_title, ' ', '_') as stem_id, replace(replace(video_id, '_', ' '), '-', ' - ') as stem_title from videos",
    "sanitize_title": "select video_id, substring(regexp_replace(replace(video_title, ' ', '_'), '[^\\p{L}\\p{N}\\-_.]', '', 'g'), 1, 100) as file_name from videos",
    "vec_norm": "select vec_id, round(sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) as norm from embeddings",
    "vec_dot": _PAIRS.format("round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) as dot"),
    "cosine_pairs": _PAIRS.format(f"round({_cosine('a.embedding', 'b.embedding')}, 6) as similarity"),
    "vec_cast": f"with {_ONCE} select chunk_id, round(embedding[1]::double, 6) as first_number, round(embedding[-1]::double, 6) as last_number, cast(len(embedding) as integer) as dimension from once where {_OK}",
    "quantize": f"select vec_id, array_to_string(list_transform({_CODES.format('embedding')}, lambda x: cast(x as integer)), ',') as codes from embeddings",
    "embed_hash": r"""
select parent_chunk_id, bucket, cast(sum(sign) as bigint) as value from (
  select parent_chunk_id, cast(('0x' || substr(md5(w), 1, 8))::bigint % 64 as integer) as bucket, case when ('0x' || substr(md5(w), 9, 8))::bigint % 2 = 0 then 1 else -1 end as sign
  from (select parent_chunk_id, unnest(list_filter(regexp_split_to_array(lower(text), '[\s\x0b\x1c-\x1f\x85\p{Z}]+'), lambda w: w <> '')) as w from parent_chunks where text is not null))
group by 1, 2 having sum(sign) <> 0""",
    "knn_exact": f"with {_ONCE}, {_knn('once', 'chunk_id', 10, _EXACT)} select * from ranked where place <= 10",
    "knn_quantized": f"with {_ONCE}, {_knn('once', 'chunk_id', 10, _COARSE)} select * from ranked where place <= 10",
    "knn_threshold": f"with {_ONCE}, {_knn('once', 'chunk_id', 10, _EXACT)} select query, key, distance from ranked where place <= 10 and distance <= 0.7",
    "knn_batch": f"with {_knn('embeddings', 'vec_id', 5, _EXACT)} select * from ranked where place <= 5",
    "eval_metrics": f"""with {_knn('embeddings', 'vec_id', 5, _EXACT)},
per as (select r.query, max(case when place = 1 then cast(k.label = q.label as integer) end) as t1, min(case when place <= 3 then cast(k.label = q.label as integer) end) as t3, min(distance) as best
        from ranked r join embeddings k on k.vec_id = r.key join embeddings q on q.vec_id = r.query where place <= 5 group by 1)
select count(*) as queries, round(avg(t1), 6) as top1_rate, round(avg(t3), 6) as top3_rate, round(avg(best), 6) as avg_best, min(best) as min_best, max(best) as max_best from per""",
    "search_context": f"with {_CONTEXT} select * from context",
    "search_display": f"""with {_CONTEXT} select query, place, printf('[%.3f] %s (%s - %s)', distance, video_title, {_CLOCK.format('start_time')}, {_CLOCK.format('end_time')}) as header,
  case when length(context) > 200 then substring(context, 1, 200) || '...' else context end as snippet from context""",
}
