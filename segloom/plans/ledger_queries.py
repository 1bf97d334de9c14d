"""Queries on the ledger and its videos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.operators import ledger
from segloom.session import table


def _rows(spark: SparkSession, directory: str) -> DataFrame:
    return ledger.latest_rows(table(spark, directory, "playlist_progress"))


def ledger_scan(spark: SparkSession, directory: str) -> DataFrame:
    return _rows(spark, directory)


def ledger_merge(spark: SparkSession, directory: str) -> DataFrame:
    entries = table(spark, directory, "videos").select("video_id", F.col("video_title").alias("title"))
    return ledger.merged(table(spark, directory, "playlist_progress"), entries)


def ledger_summary(spark: SparkSession, directory: str) -> DataFrame:
    return ledger.totals(_rows(spark, directory))


def running_cost(spark: SparkSession, directory: str) -> DataFrame:
    return ledger.running_totals(_rows(spark, directory))


def run_totals(spark: SparkSession, directory: str) -> DataFrame:
    """The totals of the last day of processing."""
    rows = _rows(spark, directory)
    last = rows.agg(F.max(F.substring("processed_at", 1, 10))).first()[0]
    return ledger.run_totals(rows, last or "")


def playlist_entries(spark: SparkSession, directory: str) -> DataFrame:
    """The entries of a playlist: those with an id, with a default title and an address."""
    rows = table(spark, directory, "videos").where("video_id is not null and video_id <> ''")
    title = F.coalesce(F.nullif("video_title", F.lit("")), F.lit("Unknown"))
    return rows.select("video_id", F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id")).alias("url"), title.alias("title"))


def transcript_exists(spark: SparkSession, directory: str) -> DataFrame:
    """The ledger's rows whose title, as a file name, is that of a video with segments."""
    videos = table(spark, directory, "videos").join(table(spark, directory, "transcript_segments").select("video_id"), "video_id", "left_semi")
    files = videos.select(tx.sanitize_title(F.col("video_title")).alias("file_name")).where("file_name <> ''")
    return _rows(spark, directory).select("video_id", tx.sanitize_title(F.col("title")).alias("file_name")).join(files, "file_name", "left_semi").select("video_id", "file_name")


def audio_seconds(spark: SparkSession, directory: str) -> DataFrame:
    return _rows(spark, directory).select("video_id", F.expr("input_tokens div 32").alias("seconds"))


QUERIES = {f.__name__: f for f in (ledger_scan, ledger_merge, ledger_summary, running_cost, run_totals, playlist_entries, transcript_exists, audio_seconds)}

_COLUMNS = ("url", "title", "status", "error", "input_tokens", "output_tokens", "cost_usd")
_ORDER = ", ".join(f"{c} desc nulls last" for c in ("processed_at", *_COLUMNS))
_LATEST = f"""latest as (
  select video_id, url, title, status, error, processed_at, coalesce(input_tokens, 0) as input_tokens, coalesce(output_tokens, 0) as output_tokens, coalesce(cost_usd, 0.0) as cost_usd
  from (select *, row_number() over (partition by video_id order by {_ORDER}) as n from playlist_progress where video_id is not null) where n = 1)"""
_FILE = "substring(regexp_replace(replace({0}, ' ', '_'), '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g'), 1, 100)"
SQL = {
    "ledger_scan": f"with {_LATEST} select * from latest",
    "ledger_merge": f"""with {_LATEST}, fresh as (select video_id, min(video_title) as title from videos where video_id is not null group by 1)
select coalesce(l.video_id, f.video_id) as video_id, coalesce(l.url, 'https://www.youtube.com/watch?v=' || coalesce(l.video_id, f.video_id)) as url,
       case when l.video_id is not null then l.title else f.title end as title, case when l.video_id is not null then l.status else 'pending' end as status,
       coalesce(l.input_tokens, 0) as input_tokens, coalesce(l.output_tokens, 0) as output_tokens, coalesce(l.cost_usd, 0.0) as cost_usd
from latest l full join fresh f on l.video_id = f.video_id""",
    "ledger_summary": f"with {_LATEST} select status, count(*) as n, sum(input_tokens)::bigint as input_tokens, sum(output_tokens)::bigint as output_tokens, round(sum(cost_usd), 4) as cost_usd from latest group by status",
    "running_cost": f"""with {_LATEST} select video_id, count(*) over w as n, (sum(input_tokens + output_tokens) over w)::bigint as tokens, round(sum(cost_usd) over w, 4) as cost_usd
from latest where processed_at is not null window w as (order by processed_at, video_id rows unbounded preceding)""",
    "run_totals": f"""with {_LATEST} select count(*) as n, coalesce(sum(input_tokens), 0)::bigint as input_tokens, coalesce(sum(output_tokens), 0)::bigint as output_tokens, round(coalesce(sum(cost_usd), 0.0), 4) as cost_usd
from latest where processed_at >= (select max(substring(processed_at, 1, 10)) from latest)""",
    "playlist_entries": "select video_id, 'https://www.youtube.com/watch?v=' || video_id as url, coalesce(nullif(video_title, ''), 'Unknown') as title from videos where video_id is not null and video_id <> ''",
    "transcript_exists": f"""with {_LATEST} select video_id, {_FILE.format('title')} as file_name from latest where {_FILE.format('title')} in (
  select {_FILE.format('video_title')} from videos where video_id in (select video_id from transcript_segments) and {_FILE.format('video_title')} <> '')""",
    "audio_seconds": f"with {_LATEST} select video_id, input_tokens // 32 as seconds from latest",
}
