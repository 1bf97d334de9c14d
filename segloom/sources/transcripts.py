"""Transcript and chunk files: JSON in and out, subtitles, manifest.

What is written here is read back here. A video may hold any share of all rows,
so its file is a folder (``video_id=...``) of parts with a row a line, in order
by the names of the parts; a reader takes such folders and single files alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions import text as tx
from segloom.functions import timecode as tc
from segloom.operators.ordered import dense_position
from segloom.session import file_system

SEGMENT = "struct<start_time:string,end_time:string,speaker:string,language:string,content:string>"
TRANSCRIPT = f"segments array<{SEGMENT}>, _corrupt_record string"
CHUNK = (
    "struct<chunk_id:string,chunk_index:int,video_id:string,video_title:string,text:string,start_time:double,end_time:double,token_count:int,"
    "section_type:string,context_before:string,context_after:string,youtube_link:string,parent_chunk_id:string,youtube_video_id:string>"
)
PARENT = "struct<parent_chunk_id:string,parent_index:int,video_id:string,video_title:string,text:string,start_time:double,end_time:double,token_count:int,child_chunk_ids:array<string>>"
CHUNKED = f"video_id string, video_title string, total_chunks int, chunks array<{CHUNK}>, total_parent_chunks int, parent_chunks array<{PARENT}>, _corrupt_record string"


def _stem() -> Column:
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))), r"\.json$", "")


def _holds(spark: SparkSession, path: str, pattern: str) -> bool:
    fs, at = file_system(spark, f"{path.rstrip('/')}/{pattern}")
    found = fs.globStatus(at)
    return found is not None and len(found) > 0


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """Parted by ranges of the order and sorted, so that each video is in few parts, whose names follow the order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def read_transcripts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(segments, broken files) of a transcript file ``X.json`` or a folder of them.

    A segment has the columns video_id, video_title, seg_index and those of the
    file; chunk files and manifests in the folder are passed over, folders that
    ``write_transcripts`` made are read, too. A file that is no JSON is a row
    (video_id, record) of the second result and fails nothing.
    """
    fields = ("start_time", "end_time", "speaker", "language", "content")
    files = spark.read.schema(TRANSCRIPT).option("multiLine", True).option("pathGlobFilter", "*.json").json(path).withColumn("stem", _stem())
    files = files.where(~F.col("stem").endswith("_chunks") & ~F.col("stem").startswith("part-") & (F.col("stem") != "manifest"))
    named = files.select(tx.stem_id(F.col("stem")).alias("video_id"), tx.stem_title(F.col("stem")).alias("video_title"), "segments", "_corrupt_record")
    segments = named.select("video_id", "video_title", F.posexplode("segments").alias("seg_index", "s")).select("video_id", "video_title", "seg_index", "s.*")
    if _holds(spark, path, "video_id=*"):
        lines = spark.read.schema(f"video_id string, seg_index int, {', '.join(f'{c} string' for c in fields)}").option("pathGlobFilter", "part-*.json").json(path)
        segments = segments.unionByName(lines.select("video_id", tx.stem_title(F.col("video_id")).alias("video_title"), "seg_index", *fields))
    return segments, named.where("_corrupt_record is not null and segments is null").select("video_id", F.col("_corrupt_record").alias("record"))


def write_transcripts(segments: DataFrame, path: str) -> None:
    """A folder a video, with one JSON object a segment and line, in order of ``seg_index``; ``read_transcripts`` reads it."""
    rows = segments.select("video_id", "seg_index", "start_time", "end_time", "speaker", "language", "content")
    _in_order(rows, "video_id", "seg_index").write.mode("overwrite").partitionBy("video_id").json(path)


def subtitle_cues(segments: DataFrame) -> DataFrame:
    """Rows (segment_id, video_id, cue_no, cue): each segment as a numbered subtitle, blank ones too.

    Numbers begin at 1 in each video, in the order of ``seg_index``. Written in
    that order and joined by line breaks, the cues of a video are its file.
    """
    placed = dense_position(segments, "video_id", "seg_index", "pos")
    number = F.col("pos") + 1
    cue = F.concat(number.cast("string"), F.lit("\n"), tc.normalize(F.col("start_time")), F.lit(" --> "), tc.normalize(F.col("end_time")), F.lit("\n"), F.coalesce("content", F.lit("")), F.lit("\n"))
    return placed.select("segment_id", "video_id", number.alias("cue_no"), cue.alias("cue"))


def write_subtitles(segments: DataFrame, path: str) -> None:
    """A folder a video of subtitle parts, in order; joined they are the video's ``.srt`` file. Blank lines in a text are left out, as they would end its cue."""
    whole = segments.withColumn("content", F.regexp_replace(tx.strip(F.col("content")), r"\s*\n\s*", "\n"))
    cues = subtitle_cues(whole).select("video_id", "cue_no", F.col("cue").alias("value"))
    _in_order(cues, "video_id", "cue_no").select("video_id", "value").write.mode("overwrite").partitionBy("video_id").text(path)


def read_subtitles(spark: SparkSession, path: str) -> DataFrame:
    """Rows (video_id, cue_no, start_time, end_time, content) of what ``write_subtitles`` wrote."""
    blocks = spark.read.schema("video_id string, value string").option("lineSep", "\n\n").text(path)
    head = r"^\s*(\d+)\n\s*(\S+)\s+-->\s+(\S+)[^\S\n]*\n?"
    part = lambda i: F.regexp_extract("value", head, i)
    content = F.regexp_replace(F.regexp_replace("value", head, ""), r"\n$", "")
    return blocks.where(part(1) != "").select("video_id", part(1).cast("bigint").alias("cue_no"), part(2).alias("start_time"), part(3).alias("end_time"), content.alias("content"))


_CHUNK_DEFAULTS = ("section_type", "context_before", "context_after", "youtube_link", "parent_chunk_id", "youtube_video_id")


def chunk_rows(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(videos, children, parents) of parsed chunk files; optional keys get their defaults."""
    number = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    videos = files.select("video_id", "video_title", number("total_chunks"), number("total_parent_chunks"))
    children = files.select(F.explode("chunks").alias("c")).select("c.*").fillna("", list(_CHUNK_DEFAULTS))
    return videos, children, files.select(F.explode("parent_chunks").alias("p")).select("p.*")


def read_chunked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(videos, children, parents) of a chunk file ``X_chunks.json`` or a folder of them, or of what ``write_chunked`` wrote."""
    files = spark.read.schema(CHUNKED).option("multiLine", True).option("pathGlobFilter", "*_chunks.json").json(path).where("_corrupt_record is null")
    videos, children, parents = chunk_rows(files)
    inner = lambda struct: struct[len("struct<") : -1].replace(":", " ")
    header = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in videos.schema)

    def with_lines(df: DataFrame, kind: str, fields: str) -> DataFrame:
        if not _holds(spark, path, f"kind={kind}"):
            return df
        return df.unionByName(spark.read.schema(fields).option("recursiveFileLookup", "true").json(f"{path.rstrip('/')}/kind={kind}"))

    videos, parents = with_lines(videos, "video", header), with_lines(parents, "parent", inner(PARENT))
    children = with_lines(children, "chunk", inner(CHUNK)).fillna("", list(_CHUNK_DEFAULTS))
    return videos, children, parents


def write_chunked(videos: DataFrame, children: DataFrame, parents: DataFrame, path: str, by_video: bool = True) -> None:
    """The chunked videos as JSON lines in a folder a kind (``video``, ``chunk``, ``parent``) and, ``by_video``, a video, in order; ``read_chunked`` reads them.

    A line is one header, chunk or parent, so that no video has to fit one
    value; keys without a value and embeddings are left out.
    """
    line = lambda df, kind, place: df.select(F.lit(kind).alias("kind"), F.col("video_id").alias("video"), F.expr(place).alias("place"), F.to_json(F.struct(*[c for c in df.columns if c != "embedding"])).alias("value"))
    parent_place = "parent_index" if "parent_index" in parents.columns else "0"
    rows = line(videos, "video", "0").unionByName(line(children, "chunk", "chunk_index")).unionByName(line(parents, "parent", parent_place))
    _in_order(rows, "kind", "video", "place").select("kind", *(["video"] if by_video else []), "value").write.mode("overwrite").partitionBy("kind", *(["video"] if by_video else [])).text(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    """The rows of ``manifest`` as JSON lines."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("video_id string, title string, chunks bigint, parent_chunks bigint").json(path)


def manifest(rollup: DataFrame) -> DataFrame:
    """Rows (video_id, title, chunks, parent_chunks) and a last one, with a null id, of the totals."""
    rows = rollup.select("video_id", F.col("video_title").alias("title"), "chunks", "parent_chunks")
    totals = rows.agg(F.lit(None).cast("string").alias("video_id"), F.lit("total").alias("title"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"), F.coalesce(F.sum("parent_chunks"), F.lit(0)).alias("parent_chunks"))
    return rows.unionByName(totals)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger file: header row, blank numbers are 0."""
    columns = "video_id string, url string, title string, status string, error string, processed_at string, input_tokens string, output_tokens string, cost_usd string"
    raw = spark.read.schema(columns).option("header", True).csv(path)
    number = lambda c, kind: F.coalesce(F.nullif(F.trim(c), F.lit("")).try_cast(kind), F.lit(0).cast(kind)).alias(c)
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("url", "title", "status", "error", "processed_at")]
    return raw.select("video_id", *text, number("input_tokens", "bigint"), number("output_tokens", "bigint"), number("cost_usd", "double"))


def write_ledger(ledger: DataFrame, path: str) -> None:
    """A new snapshot of the ledger."""
    ledger.write.mode("overwrite").option("header", True).csv(path)
