"""Column shaping: rename, keep, drop, combine, replace, split and cast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.functions.text import combine_text, split_part


def drop_unsupported(df: DataFrame, *columns: str) -> DataFrame:
    """The table without columns that have no column type here, such as geography."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def remove_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns by name; an unknown name is an error."""
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.drop(*columns)


def combine_columns(df: DataFrame, columns: Sequence[str], name: str, sep: str = " ") -> DataFrame:
    """Join text columns into ``name``, put where the first of them was, and drop them."""
    combined = combine_text(sep, *columns).alias(name)
    out = []
    for c in df.columns:
        if c == columns[0]:
            out.append(combined)
        elif c not in columns:
            out.append(F.col(c))
    return df.select(*out)


def replace_text(df: DataFrame, column: str, *pairs: tuple[str, str]) -> DataFrame:
    """Case-sensitive substring replacements, applied one after the other."""
    value = F.col(column)
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return df.withColumn(column, value)


def split_column(df: DataFrame, column: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Split text into the named columns, put in place of ``column``.

    A missing part is null; parts beyond the named ones are not kept.
    """
    out = []
    for c in df.columns:
        if c == column:
            out += [split_part(column, sep, i).alias(n) for i, n in enumerate(names)]
        else:
            out.append(F.col(c))
    return df.select(*out)


def cast_columns(df: DataFrame, types: dict[str, str], tolerant: bool = False) -> DataFrame:
    """Cast the listed columns; ``tolerant`` turns unreadable text into null."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) if tolerant else F.col(c).cast(t) for c, t in types.items()}
    )
