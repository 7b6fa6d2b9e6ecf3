"""Distinct values of a whole-number column kept as bitmaps, so that exact counts add up.

A distinct count of days cannot be summed to one of years. Bitmaps can be united: a table of them
holds, for each group, one row per range of 32,768 values with a bit for each value that occurs.
A blank is a value too, and has a row without a range. Both steps combine on the map side, and a
row has at most four kilobytes, however many rows of the fact it stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

RANGE, BITS = "_range", "_bits"


def distinct_bitmaps(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """The values of ``column`` that occur in each group."""
    if not isinstance(df.schema[column].dataType, IntegralType):
        raise TypeError(f"bitmaps count whole numbers, and {column} is none")
    value = F.col(column).cast("long")
    within = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITS)
    return df.groupBy(*by, F.bitmap_bucket_number(value).alias(RANGE)).agg(within)


def united_bitmaps(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of groups by fewer columns."""
    return stored.groupBy(*by, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_bitmaps(stored: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The exact distinct count of each group, in which a blank counts as one value."""
    held = F.when(F.col(RANGE).isNull(), 1).otherwise(F.bitmap_count(BITS))
    return united_bitmaps(stored, by).groupBy(*by).agg(F.sum(held).alias(name))
