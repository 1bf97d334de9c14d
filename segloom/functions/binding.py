"""Binding of a value that an expression uses more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body uses it.

    Columns are expressions: one that is used in several branches is evaluated
    in each of them. A lambda's argument is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
