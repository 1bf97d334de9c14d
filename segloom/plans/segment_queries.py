"""Queries on transcript segments and the chunks made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.functions import timecode as tc
from segloom.operators import chunks as ch
from segloom.operators.segments import deliver_once, scan_segments
from segloom.session import materialize, table
from segloom.sources.services import hash_embeddings


def _segments(spark: SparkSession, directory: str) -> DataFrame:
    return deliver_once(table(spark, directory, "transcript_segments"))


def scanned(spark: SparkSession, directory: str) -> DataFrame:
    return scan_segments(_segments(spark, directory))


def token_count(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents")
    return rows.select("doc_id", tx.word_count(F.col("text")).alias("n_words"), tx.token_count(F.col("text")).alias("n_tokens"))


def parse_timestamp(spark: SparkSession, directory: str) -> DataFrame:
    seconds = lambda c: F.round(tc.parse_seconds(F.col(c)), 6)
    return _segments(spark, directory).select("segment_id", seconds("start_time").alias("start_s"), seconds("end_time").alias("end_s"))


def srt_timestamp(spark: SparkSession, directory: str) -> DataFrame:
    return _segments(spark, directory).select("segment_id", tc.normalize(F.col("start_time")).alias("srt_start"), tc.normalize(F.col("end_time")).alias("srt_end"))


def continuation_flag(spark: SparkSession, directory: str) -> DataFrame:
    return scanned(spark, directory).select("segment_id", tx.is_continuation(F.col("text")).alias("continues"))


def json_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    rows = _segments(spark, directory)
    fields = "start_time string, end_time string, speaker string, language string, content string"
    written = F.to_json(F.struct("start_time", "end_time", "speaker", "language", "content"), {"ignoreNullFields": "false"})
    return rows.select("segment_id", F.from_json(written, fields).alias("s")).select("segment_id", "s.*")


def srt_cues(spark: SparkSession, directory: str) -> DataFrame:
    """Every segment, blank ones too, as a numbered subtitle."""
    from segloom.sources.transcripts import subtitle_cues

    return subtitle_cues(_segments(spark, directory))


def bounded(spark: SparkSession, directory: str) -> DataFrame:
    return materialize(ch.pause_boundaries(ch.positioned_segments(scanned(spark, directory))), "bounded")


def boundary_pause(spark: SparkSession, directory: str) -> DataFrame:
    return bounded(spark, directory).select("video_id", "pos", "boundary")


def child_assign(spark: SparkSession, directory: str) -> DataFrame:
    return ch.child_assignment(bounded(spark, directory))


def built_children(spark: SparkSession, directory: str) -> DataFrame:
    rows = bounded(spark, directory)
    return ch.child_chunks(rows, ch.child_assignment(rows))


def child_chunks(spark: SparkSession, directory: str) -> DataFrame:
    return built_children(spark, directory)


def child_chunks_semantic(spark: SparkSession, directory: str) -> DataFrame:
    """The child chunks where topics, by the hashed embeddings of the segments, bound them as pauses do."""
    placed = ch.positioned_segments(scanned(spark, directory)).withColumn("at", F.struct("video_id", "pos"))
    embedded = hash_embeddings(placed, "at", "text").select("at.*", "embedding")
    rows = materialize(ch.detect_boundaries(placed.drop("at"), embedded), "bounded")
    return ch.child_chunks(rows, ch.child_assignment(rows))


def overlap_context(spark: SparkSession, directory: str) -> DataFrame:
    found = ch.overlap_context(materialize(built_children(spark, directory), "children"))
    return found.select("chunk_id", "context_before", "context_after")


def parent_assign(spark: SparkSession, directory: str) -> DataFrame:
    return ch.parent_assignment(materialize(built_children(spark, directory), "children"))


def built_parents(spark: SparkSession, directory: str) -> DataFrame:
    children = materialize(built_children(spark, directory), "children")
    return ch.parent_chunks(children, ch.parent_assignment(children))


def parent_chunks(spark: SparkSession, directory: str) -> DataFrame:
    return built_parents(spark, directory).drop("child_chunk_ids")


def parent_links(spark: SparkSession, directory: str) -> DataFrame:
    return built_parents(spark, directory).select("parent_chunk_id", F.array_join("child_chunk_ids", ",").alias("children"))


def chunk_stats(spark: SparkSession, directory: str) -> DataFrame:
    return ch.token_stats(built_children(spark, directory))


def parent_stats(spark: SparkSession, directory: str) -> DataFrame:
    return ch.token_stats(built_parents(spark, directory))


QUERIES = {
    "scan_segments": scanned,
    "token_count": token_count,
    "parse_timestamp": parse_timestamp,
    "srt_timestamp": srt_timestamp,
    "continuation_flag": continuation_flag,
    "json_roundtrip": json_roundtrip,
    "srt_cues": srt_cues,
    "boundary_pause": boundary_pause,
    "child_assign": child_assign,
    "child_chunks": child_chunks,
    "child_chunks_semantic": child_chunks_semantic,
    "overlap_context": overlap_context,
    "parent_assign": parent_assign,
    "parent_chunks": parent_chunks,
    "parent_links": parent_links,
    "chunk_stats": chunk_stats,
    "parent_stats": parent_stats,
}

_BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}|{_BLANK}$', '', 'g')"


def words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{_BLANK}'), lambda w: w <> '')"


def tokens_sql(x: str) -> str:
    return f"cast(floor(len({words_sql(x)}) * 1.3) as integer)"


def _once() -> str:
    return "once as (select distinct on (segment_id) segment_id, video_id, seg_index, start_time, end_time, speaker, language, content, seg_start from transcript_segments)"


def _scan() -> str:
    from segloom.plans.interval_queries import ms_sql

    return f"""{_once()},
scan as (
  select * from (
    select segment_id, video_id, seg_index, {strip_sql("coalesce(content, '')")} as text,
           {ms_sql('start_time')} as start_ms, {ms_sql('end_time')} as end_ms,
           coalesce(speaker, '') as speaker, coalesce(language, '') as language
    from once) where text <> '')"""


def _openings() -> str:
    joined = "|".join(tx.CONTINUATION_OPENINGS).replace(r"\d", r"\p{Nd}").replace("'", "''")
    return f"regexp_matches(text, '(?i)^(?:{joined})')"


def _bounded() -> str:
    return f"""{_scan()},
placed as (
  select video_id, cast(row_number() over (partition by video_id order by seg_index) - 1 as bigint) as pos, text,
         coalesce(start_ms / 1000.0::double, 0.0) as s, coalesce(end_ms / 1000.0::double, 0.0) as e, {tokens_sql('text')} as t, {_openings()} as c
  from scan),
bounded as (
  select *, coalesce(round(s - lag(e) over (partition by video_id order by pos), 3) > 3.0, false) as b from placed)"""


def _topics() -> str:
    """Adds to ``placed`` the similarity of a segment's words, hashed, to those of the one before."""
    number = lambda at: f"('0x' || substr(md5(w), {at}, 8))::bigint"
    return f"""{_bounded()},
terms as (
  select video_id, pos, {number(1)} % 64 as bucket, sum(case when {number(9)} % 2 = 0 then 1 else -1 end) as v
  from (select video_id, pos, unnest({words_sql('lower(text)')}) as w from placed) group by all),
norms as (select video_id, pos, sqrt(sum(v * v)) as n from terms group by all),
dots as (select a.video_id, a.pos, sum(a.v * b.v) as d from terms a join terms b on a.video_id = b.video_id and a.pos = b.pos + 1 and a.bucket = b.bucket group by all),
topics as (
  select p.video_id, p.pos, case when x.n > 0 and y.n > 0 then coalesce(d.d, 0) / (x.n * y.n) else 0 end as sim
  from placed p left join norms x on x.video_id = p.video_id and x.pos = p.pos left join norms y on y.video_id = p.video_id and y.pos = p.pos - 1
  left join dots d on d.video_id = p.video_id and d.pos = p.pos),
joint as (select * replace (b or pos > 0 and round(sim, 6) < 0.5 as b) from bounded join topics using (video_id, pos))"""


def _children(bounds: str = "bounded") -> str:
    return f"""{_bounded() if bounds == "bounded" else _topics()},
fold(video_id, pos, cur, idx) as (
  select video_id, pos, t, 0 from {bounds} where pos = 0
  union all
  select n.video_id, n.pos, case when n.split then n.t else n.cur + n.t end, case when n.split then n.idx + 1 else n.idx end
  from (
    select b.video_id, b.pos, b.t, f.cur, f.idx,
           case when f.cur + b.t > 256 and f.cur >= 128 then not (b.c and f.cur + b.t <= 300) else f.cur >= 200 and b.b end as split
    from fold f join {bounds} b on b.video_id = f.video_id and b.pos = f.pos + 1) n),
tail as (select video_id, max(idx) as last, max_by(cur, pos) as cur from fold group by video_id),
assigned as (
  select f.video_id, f.pos, case when f.idx = t.last and t.cur < 128 and t.last > 0 then f.idx - 1 else f.idx end as chunk_index
  from fold f join tail t using (video_id)),
children as (
  select printf('%s_%03d', video_id, chunk_index) as chunk_id, chunk_index, video_id, text, s as start_time, e as end_time, {tokens_sql('text')} as token_count,
         'https://www.youtube.com/watch?v=' || video_id || '&t=' || cast(cast(trunc(s) as bigint) as varchar) || 's' as youtube_link
  from (
    select video_id, chunk_index, string_agg(text, ' ' order by pos) as text, min_by(s, pos) as s, max_by(e, pos) as e
    from {bounds} join assigned using (video_id, pos) group by video_id, chunk_index))"""


def _parents() -> str:
    return f"""{_children()},
pfold(video_id, chunk_index, cur, n, idx) as (
  select video_id, chunk_index, token_count, 1, 0 from children where chunk_index = 0
  union all
  select x.video_id, x.chunk_index, case when x.split then x.t else x.cur + x.t end, case when x.split then 1 else x.n + 1 end, case when x.split then x.idx + 1 else x.idx end
  from (
    select c.video_id, c.chunk_index, c.token_count as t, f.cur, f.n, f.idx,
           (f.cur + c.token_count > 1000 and f.cur >= 512) or (f.cur >= 800 and f.n >= 2) as split
    from pfold f join children c on c.video_id = f.video_id and c.chunk_index = f.chunk_index + 1) x),
ptail as (select video_id, max(idx) as last, max_by(cur, chunk_index) as cur from pfold group by video_id),
passigned as (
  select f.video_id, f.chunk_index, case when f.idx = t.last and t.cur < 512 and t.last > 0 then f.idx - 1 else f.idx end as parent_index
  from pfold f join ptail t using (video_id)),
parents as (
  select printf('%s_P%03d', video_id, parent_index) as parent_chunk_id, parent_index, video_id, text, s as start_time, e as end_time, {tokens_sql('text')} as token_count, ids
  from (
    select video_id, parent_index, string_agg(text, ' ' order by chunk_index) as text, min_by(start_time, chunk_index) as s, max_by(end_time, chunk_index) as e,
           string_agg(chunk_id, ',' order by chunk_index) as ids
    from children join passigned using (video_id, chunk_index) group by video_id, parent_index))"""


def _integer(part: str) -> str:
    return f"case when regexp_matches({part}, '^\\s*[+-]?[0-9]+\\s*$') then try_cast(trim({part}) as bigint) end"


def _parse_sql(c: str) -> str:
    p = f"string_split(replace({c}, ',', ':'), ':')"
    n = lambda i: f"({_integer(f'{p}[{i}]')})"
    return (
        f"round(case when len({p}) = 3 then {n(1)} * 60 + {n(2)} + {n(3)} / 1000.0::double "
        f"when len({p}) = 4 then {n(1)} * 3600 + {n(2)} * 60 + {n(3)} + {n(4)} / 1000.0::double else 0.0::double end, 6)"
    )


def _srt_sql(c: str) -> str:
    p = f"string_split(replace({c}, ',', ':'), ':')"
    n = lambda i: f"({_integer(f'{p}[{i}]')})"
    ms = lambda i: f"case when length({p}[{i}]) < 3 then lpad({p}[{i}], 3, '0') else {p}[{i}] end"
    return (
        f"case when len({p}) = 3 and {n(1)} is not null and {n(2)} is not null then printf('%02d:%02d:%02d,%s', {n(1)} // 60, {n(1)} % 60, {n(2)}, {ms(3)}) "
        f"when len({p}) = 4 and {n(1)} is not null and {n(2)} is not null and {n(3)} is not null then printf('%02d:%02d:%02d,%s', {n(1)}, {n(2)}, {n(3)}, {ms(4)}) "
        f"else '00:00:00,000' end"
    )


def _first_last(side: str) -> str:
    w = words_sql("text")
    part = f"{w}[-38:]" if side == "last" else f"{w}[:38]"
    return f"case when len({w}) <= 38 then text else array_to_string({part}, ' ') end"


_STATS = "select video_id, count(*) as chunks, round(avg(token_count), 6) as avg_tokens, min(token_count) as min_tokens, max(token_count) as max_tokens"
SQL = {
    "scan_segments": f"with {_scan()} select * from scan",
    "token_count": f"select doc_id, cast(len({words_sql('text')}) as integer) as n_words, {tokens_sql('text')} as n_tokens from documents",
    "parse_timestamp": f"with {_once()} select segment_id, {_parse_sql('start_time')} as start_s, {_parse_sql('end_time')} as end_s from once",
    "srt_timestamp": f"with {_once()} select segment_id, {_srt_sql('start_time')} as srt_start, {_srt_sql('end_time')} as srt_end from once",
    "continuation_flag": f"with {_scan()} select segment_id, {_openings()} as continues from scan",
    "json_roundtrip": f"with {_once()} select segment_id, start_time, end_time, speaker, language, content from once",
    "srt_cues": f"""with {_once()} select segment_id, video_id, row_number() over (partition by video_id order by seg_index) as cue_no,
  cast(row_number() over (partition by video_id order by seg_index) as varchar) || chr(10) || ({_srt_sql('start_time')}) || ' --> ' || ({_srt_sql('end_time')}) || chr(10) || coalesce(content, '') || chr(10) as cue from once""",
    "boundary_pause": f"with {_bounded()} select video_id, pos, b as boundary from bounded",
    "child_assign": f"with recursive {_children()} select video_id, pos, chunk_index from assigned",
    "child_chunks": f"with recursive {_children()} select * from children",
    "child_chunks_semantic": f"with recursive {_children('joint')} select * from children",
    "overlap_context": f"""with recursive {_children()} select chunk_id,
  coalesce(lag({_first_last('last')}) over w, '') as context_before, coalesce(lead({_first_last('first')}) over w, '') as context_after
  from children window w as (partition by video_id order by chunk_index)""",
    "parent_assign": f"with recursive {_parents()} select * from passigned",
    "parent_chunks": f"with recursive {_parents()} select parent_chunk_id, parent_index, video_id, text, start_time, end_time, token_count from parents",
    "parent_links": f"with recursive {_parents()} select parent_chunk_id, ids as children from parents",
    "chunk_stats": f"with recursive {_children()} {_STATS} from children group by video_id",
    "parent_stats": f"with recursive {_parents()} {_STATS} from parents group by video_id",
}
