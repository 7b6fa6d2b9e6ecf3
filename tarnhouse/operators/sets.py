"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from tarnhouse.operators.filters import Mark, filter_date_range


def union_ranges(
    parts: Sequence[tuple[DataFrame, Mark, Mark]], column: str
) -> DataFrame:
    """Parts cut to their half-open date ranges and stacked; duplicates stay."""
    cut = [filter_date_range(df, column, low, high) for df, low, high in parts]
    return reduce(DataFrame.unionByName, cut)


def union_distinct(*parts: DataFrame) -> DataFrame:
    """Parts stacked by position, each different row once."""
    return reduce(DataFrame.union, parts).distinct()
