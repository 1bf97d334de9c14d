"""Vector columns: norms, products, cosine, quantisation. All sums are in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def usable(vector: Column, dimension: int) -> Column:
    """Whether a vector has ``dimension`` finite numbers that aren't all zero; null gives false."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimension) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dot(a: Column, b: Column) -> Column:
    """The dot product; null where a vector is null or the lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), _total(products))


def norm(a: Column) -> Column:
    """The Euclidean length; null for null."""
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """The cosine similarity; 0 where a vector is all zeros, null where one is null."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).when(lengths.isNotNull(), F.lit(0.0))


def quantised(vector: Column) -> Column:
    """A vector as whole numbers from -127 to 127, by its largest absolute number; all zeros stay so."""
    top = F.aggregate(vector, F.lit(0.0), lambda acc, x: F.greatest(acc, F.abs(x.cast("double"))))
    return F.transform(vector, lambda x: F.when(top > 0, F.floor(x.cast("double") * 127.0 / top + 0.5).cast("int")).otherwise(F.lit(0)))
