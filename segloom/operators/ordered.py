"""Ordered operators that don't put a whole key into one task.

A window over a key sends all rows of a hot key to one task. Here a key is
parted into buckets along the order; windows run within (key, bucket), and one
small row a bucket carries values from bucket to bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_value(
    df: DataFrame, key: str, bucket: str, order: list[str], values: dict[str, Column], *, following: bool = False
) -> DataFrame:
    """Add, for each of ``values``, its last non-null value in the rows before (after, if ``following``).

    ``bucket`` must grow with the order within a key. ``df`` is read twice, so
    the caller writes it first if it is costly. Rows without such a value get
    null; rows with a null key see only their own bucket; an empty table gives
    an empty one. Ties in the order are broken arbitrarily, so it should be
    unique within a key.
    """
    turn = (lambda c: F.col(c).desc()) if following else (lambda c: F.col(c).asc())
    df = df.withColumns({f"__v_{name}": value for name, value in values.items()})
    inside = Window.partitionBy(key, bucket).orderBy(*map(turn, order)).rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(key).orderBy(turn(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    pick = F.min_by if following else F.max_by
    carried = (
        df.groupBy(key, bucket)
        .agg(*(pick(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), place)).alias(f"__b_{n}") for n in values))
        .select(key, bucket, *(F.last(f"__b_{n}", ignorenulls=True).over(along).alias(f"__c_{n}") for n in values))
    )
    local = df.withColumns({f"__l_{n}": F.last(f"__v_{n}", ignorenulls=True).over(inside) for n in values})
    # Both sides are parted by (key, bucket) already, so the join moves neither.
    out = local.join(carried, [key, bucket], "left")
    out = out.withColumns({n: F.coalesce(f"__l_{n}", f"__c_{n}") for n in values})
    return out.drop(*(f"__{p}_{n}" for n in values for p in "vlc"))


def dense_position(df: DataFrame, key: str, order: str, out: str, block: int = 4096) -> DataFrame:
    """Add the 0-based place of each row within its key by the integer column ``order``.

    Blocks of ``order`` values are counted first; a block's place starts where
    the blocks before it end. Rows whose key or order is null are left out.
    """
    df = df.where(F.col(key).isNotNull() & F.col(order).isNotNull()).withColumn("__block", F.floor(F.col(order) / block))
    along = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(key, "__block").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select(key, "__block", F.coalesce(F.sum("__n").over(along), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, "__block").orderBy(order)
    placed = df.withColumn("__row", F.row_number().over(inside))
    joined = placed.join(starts, [key, "__block"])
    return joined.withColumn(out, F.col("__start") + F.col("__row") - 1).drop("__block", "__row", "__start")
