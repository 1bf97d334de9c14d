"""Media time codes: reading, normalising and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segloom.functions.binding import let
from segloom.functions.text import strip


def parse_ms(code: Column) -> Column:
    """Whole milliseconds of a time code, or null where it can't be read.

    Three parts are minutes, seconds and milliseconds, four also have hours in
    front; colons and commas part them, each part is digits only and white
    space around the code is ignored. Numbers beyond 64 bits can't be read.
    """
    bare = strip(code)

    def read(parts: Column) -> Column:
        number = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
        total = lambda *terms: F.try_add(F.try_add(F.try_multiply(terms[0], F.lit(60_000)), F.try_multiply(terms[1], F.lit(1000))), terms[2])
        three = total(number(0), number(1), number(2))
        four = F.try_add(F.try_multiply(number(0), F.lit(3_600_000)), total(number(1), number(2), number(3)))
        return F.when(F.size(parts) == 3, three).when(F.size(parts) == 4, four)

    # Anything but digits and the two marks makes the code unreadable.
    digits = F.when(F.translate(bare, "0123456789:,", "") == "", F.translate(bare, ",", ":"))
    at = lambda i, n: F.substring(code, i, n).cast("bigint")
    usual = at(1, 2) * 3_600_000 + at(4, 2) * 60_000 + at(7, 2) * 1000 + at(10, 3)
    # The usual form needs no parts; the when's order spares all others the casts.
    return F.when(code.rlike(r"^[0-9]{2}:[0-9]{2}:[0-9]{2}[,:][0-9]{3}\z"), usual).otherwise(let(F.split(digits, ":"), read))


def parse_seconds(code: Column) -> Column:
    """Seconds of a time code as a double.

    A code with neither three nor four parts is 0.0; one of the right shape
    whose parts are no integers is null (a bad row must not fail the job).
    """
    parts = F.split(F.replace(code, F.lit(","), F.lit(":")), ":")
    whole = F.transform(parts, lambda p: strip(p).try_cast("bigint"))
    at = lambda i: F.get(whole, F.lit(i - 1))
    three = at(1) * 60 + at(2) + at(3) / F.lit(1000.0)
    four = at(1) * 3600 + at(2) * 60 + at(3) + at(4) / F.lit(1000.0)
    return F.when(F.size(parts) == 3, three).when(F.size(parts) == 4, four).otherwise(F.lit(0.0))


def _pad_ms(part: Column) -> Column:
    return F.when(F.length(part) < 3, F.lpad(part, 3, "0")).otherwise(part)


def normalize(code: Column) -> Column:
    """A time code as ``HH:MM:SS,mmm``.

    Minutes beyond 59 become hours where the code has three parts; four parts
    are only padded. What can't be read, null too, is ``00:00:00,000``.
    """
    parts = F.split(F.replace(code, F.lit(","), F.lit(":")), ":")
    number = F.transform(parts, lambda p: strip(p).try_cast("bigint"))
    at = lambda i: F.get(number, F.lit(i - 1))
    ms = lambda i: _pad_ms(F.get(parts, F.lit(i - 1)))
    three = F.format_string("%02d:%02d:%02d,%s", F.floor(at(1) / 60), at(1) % 60, at(2), ms(3))
    four = F.format_string("%02d:%02d:%02d,%s", at(1), at(2), at(3), ms(4))
    return (
        F.when((F.size(parts) == 3) & at(1).isNotNull() & at(2).isNotNull(), three)
        .when((F.size(parts) == 4) & at(1).isNotNull() & at(2).isNotNull() & at(3).isNotNull(), four)
        .otherwise(F.lit("00:00:00,000"))
    )


def minutes_seconds(seconds: Column) -> Column:
    """Seconds as ``m:ss``, minutes unbounded."""
    whole = F.floor(seconds)
    return F.format_string("%d:%02d", F.floor(whole / 60), whole % 60)
