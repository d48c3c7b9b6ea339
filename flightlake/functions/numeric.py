"""Lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightlake.functions.text import strip

# Spark's own parser also takes 1d, 1f, hex floats, NaN and Infinity. None of these can be
# spelled with the characters of a plain decimal number, so the alphabet is check enough;
# the grammar is left to try_cast, for which the empty text of a mismatch is no number.
DECIMAL_ALPHABET = r"^[0-9+\-.eE]+$"


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def infinity_to_null(c: Column) -> Column:
    """nullif, unlike when, computes its argument once."""
    infinity = float("inf")
    return F.nullif(F.nullif(c, F.lit(infinity)), F.lit(-infinity))


def to_double(c: Column) -> Column:
    """Number or null, never an error and never NaN or infinity. Mentions `c` as few times
    as possible: a filter on a result is pushed down as a copy of the whole expression."""
    plain = F.regexp_extract(strip(c), DECIMAL_ALPHABET, 0)
    return infinity_to_null(plain.try_cast("double"))


def non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def count_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")
