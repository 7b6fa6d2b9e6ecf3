"""Predicates, written so that Parquet and database scans can evaluate them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Mark = date | datetime | str


def mark_literal(df: DataFrame, column: str, value: Mark) -> Column:
    """``value`` as a constant of the column's own type.

    Comparing like with like keeps the cast off the column, and so keeps the
    predicate in the scan.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DateType) and isinstance(value, datetime) and value.time() != datetime.min.time():
        dtype = T.TimestampNTZType()
    return F.lit(str(value)).cast(dtype)


def window_predicate(
    df: DataFrame, column: str, start: Mark | None = None, end: Mark | None = None
) -> Column:
    """``column >= start and column < end``; a window without start or end is open there."""
    predicate = F.lit(True)
    if start is not None:
        predicate = F.col(column) >= mark_literal(df, column, start)
    if end is not None:
        before = F.col(column) < mark_literal(df, column, end)
        predicate = before if start is None else predicate & before
    return predicate


def filter_date_range(df: DataFrame, column: str, low: Mark, high: Mark) -> DataFrame:
    """Rows in the half-open range from ``low`` up to ``high``."""
    return df.filter(window_predicate(df, column, low, high))


def filter_between(df: DataFrame, column: str, low: Mark, high: Mark) -> DataFrame:
    """Rows in the closed range."""
    return df.filter(
        F.col(column).between(mark_literal(df, column, low), mark_literal(df, column, high))
    )


def filter_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows of one calendar year, as a range because ``year(column)`` is not pushed down."""
    return filter_date_range(df, column, date(year, 1, 1), date(year + 1, 1, 1))


def filter_flag(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column))


def filter_enabled(control: DataFrame, stage: int | bool = 1) -> DataFrame:
    """Control rows not marked to be skipped; none at all while their stage is off."""
    return control.filter(~F.col("skipload") & F.lit(bool(stage)))
