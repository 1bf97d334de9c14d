"""Queries on continuous audio and its gaps (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segloom.operators.intervals import interval_gaps, merge_intervals
from segloom.operators.segments import timed_segments
from segloom.session import table


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """The stretches of each video that no segment covers."""
    timed = timed_segments(table(spark, directory, "transcript_segments"))
    gaps = interval_gaps(timed, "video_id", "start_ms", "end_ms")
    return gaps.withColumnsRenamed({"gap_start": "gap_start_ms", "gap_end": "gap_end_ms"})


def p3_periods(spark: SparkSession, directory: str) -> DataFrame:
    """The continuous stretches of audio of each video."""
    timed = timed_segments(table(spark, directory, "transcript_segments"))
    periods = merge_intervals(timed, "video_id", "start_ms", "end_ms")
    return periods.withColumnsRenamed({"period_start": "period_start_ms", "period_end": "period_end_ms"})


QUERIES = {"p3_found": p3_found, "p3_periods": p3_periods}

_CODE = r"^(?:([0-9]+)[:,])?([0-9]+)[:,]([0-9]+)[:,]([0-9]+)$"


def ms_sql(column: str) -> str:
    """SQL of a time code's milliseconds."""
    bare = f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"
    part = lambda i: f"try_cast(regexp_extract({bare}, '{_CODE}', {i}) as bigint)"
    return (
        f"case when regexp_matches({bare}, '{_CODE}') then "
        f"coalesce({part(1)}, 0) * 3600000 + {part(2)} * 60000 + {part(3)} * 1000 + {part(4)} end"
    )


_TIMED = f"""
timed as (
  select video_id, s, e from (
    select video_id, coalesce({ms_sql('start_time')}, cast(round(seg_start * 1000) as bigint)) as s,
           {ms_sql('end_time')} as e
    from transcript_segments) where s < e),
swept as (
  select *, max(e) over (partition by video_id order by s, e rows between unbounded preceding and 1 preceding) as reach
  from timed)
"""

SQL = {
    "p3_found": f"with {_TIMED} select video_id, reach as gap_start_ms, s as gap_end_ms from swept where s > reach",
    "p3_periods": f"""
with {_TIMED},
numbered as (
  select *, sum(case when reach is null or s > reach then 1 else 0 end)
            over (partition by video_id order by s, e rows unbounded preceding) as n
  from swept)
select video_id, min(s) as period_start_ms, max(e) as period_end_ms from numbered group by video_id, n
""",
}
