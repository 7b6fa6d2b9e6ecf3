"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def combine_text(sep: str, *columns: str | Column) -> Column:
    """Join texts with ``sep``; null parts are skipped."""
    return F.concat_ws(sep, *columns)


def split_part(column: str | Column, sep: str, index: int) -> Column:
    """The part at ``index``, counted from 0, or null when there are fewer parts."""
    return F.get(F.split(column, re.escape(sep)), F.lit(index))


def first_three(column: str | Column) -> Column:
    """The first three characters, or the whole text when it is shorter."""
    return F.substring(column, 1, 3)


def area_code(phone: str | Column) -> Column:
    """Characters 2 to 4 of a phone number such as ``(308) 555-0100``."""
    return F.substring(phone, 2, 3)


def null_default(column: str | Column, default: str) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value, F.lit(default))
