"""Command line: chunk transcripts, keep and search the store.

    python -m segloom chunk --input-dir DIR --output-dir DIR
    python -m segloom ingest --input FILE.json --store DIR

Chunks are embedded by hashed words; ``chunk_transcripts`` and ``embed_query``
take any embedder instead (role ``similarity`` for boundaries, ``document`` for
chunks, ``query`` for queries). Intermediate results are written to
``--shared-dir``, which all executors must share.
    python -m segloom search --store DIR "words to look for" -k 5 [--exact] [--with-context]
    python -m segloom search --store DIR --id CHUNK_ID
    python -m segloom stats|list --store DIR
    python -m segloom delete --store DIR VIDEO_ID
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.config import ChunkConfig, StoreConfig
from segloom.operators import chunks as ch
from segloom.operators import search
from segloom.operators.segments import scan_segments
from segloom.operators.store import Store
from segloom.session import CHECKPOINT_KEY, get_session, materialize, ship_package
from segloom.sources.services import hash_embeddings
from segloom.sources.transcripts import read_transcripts


#: (rows, key, text, role) -> rows (key, embedding)
Embedding = Callable[[DataFrame, str, str, str], DataFrame]


def hashed(rows: DataFrame, key: str, text: str, role: str) -> DataFrame:
    """The default embedding; the same for each role."""
    return hash_embeddings(rows, key, text)


def embed_query(spark: SparkSession, words: str, embed: Embedding = hashed) -> DataFrame:
    """The one row (key, vec) of a query text; none where it has no words."""
    rows = embed(spark.createDataFrame([(words, words)], "key string, text string"), "key", "text", "query")
    return rows.where(F.exists("embedding", lambda x: x != 0)).select("key", F.col("embedding").alias("vec"))


def chunk_transcripts(spark: SparkSession, path: str, config: ChunkConfig = ChunkConfig(), embed: Embedding = hashed) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(videos, parents, children, broken files) of transcript files, children with parents, overlap and embeddings."""
    segments, broken = read_transcripts(spark, path)
    segments = segments.withColumns({"segment_id": F.xxhash64("video_id", "seg_index"), "seg_start": F.lit(None).cast("double")})
    placed = ch.positioned_segments(scan_segments(segments)).withColumn("at", F.struct("video_id", "pos"))
    embedded = embed(placed, "at", "text", "similarity").select("at.*", "embedding")
    rows = materialize(ch.detect_boundaries(placed.drop("at"), embedded, config), "bounded")
    children = materialize(ch.child_chunks(rows, ch.child_assignment(rows, config)), "children")
    children = children.join(embed(children, "chunk_id", "text", "document"), "chunk_id")
    full = ch.overlap_context(children, config.overlap_tokens)
    videos = segments.select("video_id", "video_title").distinct()
    if config.parents:
        links = materialize(ch.parent_assignment(children, config), "links")
        parents = ch.parent_chunks(children, links)
        ids = ch.tx.numbered_id(F.col("video_id"), "_P", F.col("parent_index"))
        full = full.join(links, ["video_id", "chunk_index"]).withColumn("parent_chunk_id", ids).drop("parent_index")
    else:
        parents = ch.parent_chunks(children.limit(0), ch.parent_assignment(children.limit(0), config))
        full = full.withColumn("parent_chunk_id", F.lit(None).cast("string"))
    counted = ch.video_rollup(videos, children, parents).withColumnsRenamed({"chunks": "total_chunks", "parent_chunks": "total_parent_chunks"})
    return counted.withColumn("created_at", F.current_timestamp()), parents, full, broken.count()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="segloom", description="Transcript chunks on Spark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("chunk", "ingest", "search", "stats", "list", "delete"):
        command = commands.add_parser(name)
        if name in ("chunk", "ingest"):
            source = command.add_mutually_exclusive_group(required=True)
            source.add_argument("--input", help="one transcript file")
            source.add_argument("--input-dir", help="a folder of transcript files")
        command.add_argument("--output-dir" if name == "chunk" else "--store", dest="store", required=True)
        if name in ("chunk", "ingest"):
            command.add_argument("--no-parents", action="store_true")
            command.add_argument("--similarity-threshold", type=float, default=ChunkConfig.similarity_threshold, help="a topic changes where neighbours are less alike")
            for option in ("child_target", "child_min", "child_max", "parent_target", "parent_min", "parent_max"):
                command.add_argument("--" + option.replace("_", "-"), type=int, default=getattr(ChunkConfig, option))
        if name == "search":
            asked = command.add_mutually_exclusive_group(required=True)
            asked.add_argument("query", nargs="?", help="the words to look for")
            asked.add_argument("--id", help="the chunk whose neighbours are sought")
            command.add_argument("--with-context", action="store_true", help="show the text of the parent chunk")
            command.add_argument("-k", type=int, default=5)
            command.add_argument("--exact", action="store_true")
        command.add_argument("--shared-dir", help="a folder for intermediate results that all executors share")
        if name == "delete":
            command.add_argument("video_id")
    args = parser.parse_args(argv)
    spark = get_session(**({CHECKPOINT_KEY: args.shared_dir} if args.shared_dir else {}))
    ship_package(spark)
    store = Store(spark, StoreConfig(args.store, dimension=64))
    if args.command in ("chunk", "ingest"):
        sizes = {k: getattr(args, k) for k in ("child_target", "child_min", "child_max", "parent_target", "parent_min", "parent_max")}
        config = ChunkConfig(parents=not args.no_parents, similarity_threshold=args.similarity_threshold, **sizes)
        videos, parents, children, broken = chunk_transcripts(spark, args.input or args.input_dir, config)
        counts = store.ingest(videos, parents, children)
        print(f"{sum(counts.values())} succeeded ({counts['present']} already there), {broken} failed")
        store.stats().show()
    elif args.command == "search":
        if args.id:
            query = search.usable_vectors(store.table("child_chunks").where(F.col("chunk_id") == args.id), "chunk_id", "embedding", 64)
        else:
            query = embed_query(spark, args.query)
        hits = store.search(query, args.k, use_quantized=not args.exact)
        if not args.with_context:
            own = store.table("child_chunks").select("chunk_id", F.col("text").alias("context")).dropDuplicates(["chunk_id"])
            hits = hits.drop("context").join(own, "chunk_id")
        search.rendered(hits).orderBy("place").show(args.k, truncate=False)
    elif args.command == "stats":
        store.stats().show()
    elif args.command == "list":
        store.list_videos().show(truncate=False)
    else:
        print("deleted" if store.delete(args.video_id) else "not found")


if __name__ == "__main__":
    main()
