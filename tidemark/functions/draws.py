"""Repeatable draws.

A draw depends only on a digest of the row's own key, so the same seed gives the
same rows however Spark partitions the work (``rand(seed)`` does not).  One md5
digest per row feeds several draws, each from its own hex digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(seed: int, *key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part.cast("string") for part in key]))


def _digits(digest: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def draw_integer(digest: Column, start: int, length: int, low: int, high: int) -> Column:
    """An integer in ``low..high``, both included, from ``length`` hex digits."""
    return _digits(digest, start, length) % F.lit(high - low + 1) + F.lit(low)


def draw_item(digest: Column, start: int, length: int, items: Sequence[str]) -> Column:
    position = draw_integer(digest, start, length, 1, len(items)).cast("int")
    return F.element_at(F.array(*[F.lit(item) for item in items]), position)


def draw_decimal(
    digest: Column, start: int, length: int, low: float, high: float, places: int
) -> Column:
    """A double in ``low..high`` with at most ``places`` decimals.

    Drawn as a whole number of the last decimal place and divided once, so the
    result is the nearest double and needs no rounding.
    """
    unit = 10**places
    drawn = draw_integer(digest, start, length, round(low * unit), round(high * unit))
    return drawn.cast("double") / F.lit(float(unit))
