"""The ledger of processed items: reading, merging, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.session import materialize

NUMBERS = ("input_tokens", "output_tokens", "cost_usd")


def latest_rows(ledger: DataFrame) -> DataFrame:
    """One row a video: the last one by the time of processing (ties by the whole row); missing numbers are 0."""
    order = F.struct(*(F.col(c) for c in ("processed_at", *(c for c in ledger.columns if c not in ("processed_at", "video_id")))))
    last = ledger.where("video_id is not null").groupBy("video_id").agg(F.max(order).alias("row"))
    rows = last.select("video_id", *(F.col(f"row.{c}").alias(c) for c in ledger.columns if c != "video_id"))
    return rows.fillna(0, list(NUMBERS))


def merged(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """The ledger with the entries (video_id, title) that it lacks: existing rows stay as they are, new ones are ``pending``."""
    known = latest_rows(ledger).withColumn("known", F.lit(True))
    fresh = entries.where("video_id is not null").groupBy("video_id").agg(F.min("title").alias("new_title"))
    joined = known.join(fresh, "video_id", "full_outer")
    return joined.select(
        "video_id",
        F.coalesce("url", F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id"))).alias("url"),
        F.when(F.col("known"), F.col("title")).otherwise(F.col("new_title")).alias("title"),
        F.when(F.col("known"), F.col("status")).otherwise(F.lit("pending")).alias("status"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in NUMBERS),
    )


def totals(ledger: DataFrame) -> DataFrame:
    """Per state: rows, tokens, cost."""
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.round(F.sum("cost_usd"), 4).alias("cost_usd")
    )


def running_totals(ledger: DataFrame, parts: int | None = None) -> DataFrame:
    """Each processed video with the number, tokens and cost up to it, in order of processing (ties by video_id).

    The rows are parted by ranges of that order and written with the number of
    their part; sums run within a part, and one row a part carries them on. So
    a day, or any other time, may hold any share of the rows. Rows that weren't
    processed are left out.
    """
    amounts = {"tokens": F.col("input_tokens") + F.col("output_tokens"), "cost": F.col("cost_usd")}
    rows = ledger.where("processed_at is not null").select("video_id", "processed_at", *(v.alias(k) for k, v in amounts.items()))
    order = ("processed_at", "video_id")
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    placed = materialize(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    sums = {"n": F.count(F.lit(1)), **{k: F.sum(k) for k in amounts}}
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(*(v.alias(f"part_{k}") for k, v in sums.items()))
    starts = totals.select("part", *(F.coalesce(F.sum(f"part_{k}").over(before), F.lit(0)).alias(f"start_{k}") for k in sums))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(F.broadcast(starts), "part")  # one row a partition
    upto = {k: F.col(f"start_{k}") + v.over(within) for k, v in sums.items()}
    return out.select("video_id", upto["n"].alias("n"), upto["tokens"].alias("tokens"), F.round(upto["cost"], 4).alias("cost_usd"))


def run_totals(ledger: DataFrame, since: str) -> DataFrame:
    """One row: how many items were processed at or after ``since``, with their tokens and cost; zeros where none was."""
    rows = ledger.where(F.col("processed_at") >= since)
    total = lambda c, kind: F.coalesce(F.sum(c), F.lit(0).cast(kind)).alias(c)
    return rows.agg(F.count(F.lit(1)).alias("n"), total("input_tokens", "bigint"), total("output_tokens", "bigint"), F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 4).alias("cost_usd"))
