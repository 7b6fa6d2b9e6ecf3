"""Grouped measures over a fact and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.operators.joins import Keys, is_small, join_on, key_pair


def count_all(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def calculate_sum(df: DataFrame, column: str, name: str) -> DataFrame:
    """A measure over all rows; null when there are none."""
    return df.agg(F.sum(column).alias(name))


def max_mark(df: DataFrame, column: str, default: str = "2013-01-01", name: str = "max_mark") -> DataFrame:
    """The newest value of a date column, or ``default`` for an empty table."""
    dtype = df.schema[column].dataType
    return df.agg(F.coalesce(F.max(column), F.lit(default).cast(dtype)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column; a blank is a value too."""
    return df.select(column).distinct()


def sum_by(df: DataFrame, by: Sequence[str | Column], sums: dict[str, str | Column]) -> DataFrame:
    """Sums grouped by columns or expressions, named as in ``sums``."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def count_by(df: DataFrame, by: Column, column: str, name: str) -> DataFrame:
    """Non-null values of a column per group."""
    return df.groupBy(by).agg(F.count(column).alias(name))


def summarize_columns(
    fact: DataFrame,
    dim: DataFrame,
    key: Keys,
    by: Sequence[str],
    sums: dict[str, str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Sums of fact columns by dimension columns, and by the fact columns in ``keep``.

    Fact rows without a dimension row form a blank group, and groups whose sums are all
    null are left out. A small dimension is joined where the fact lies, and only the
    group sums of each task are shuffled. For a large one the fact is summed per key
    first, on the map side, which shrinks hot keys before the shuffle of the join. Either
    way a sum has the type that Spark gives to the sum of the fact column.
    """
    types = {f.name: f.dataType for f in sum_by(fact, [], sums).schema}
    if not is_small(dim):
        fact_key, _ = key_pair(key)
        fact = sum_by(fact, [fact_key, *keep], sums)
        sums = {n: n for n in sums}
    grouped = sum_by(join_on(fact, dim, [key], "left"), [*by, *keep], sums)
    some = None
    for n in sums:
        filled = F.col(n).isNotNull()
        some = filled if some is None else some | filled
    return grouped.filter(some).select(*by, *keep, *[F.col(n).cast(types[n]).alias(n) for n in sums])


def distinct_count(
    fact: DataFrame, dim: DataFrame, key: Keys, by: Sequence[str], column: str, name: str
) -> DataFrame:
    """Distinct values of a fact column by dimension columns; a blank counts as a value.

    Duplicates go before the values are counted, with a map-side pass, so no task holds
    the values of a whole group. With a large dimension they also go before its join.
    """
    fact_key, _ = key_pair(key)
    pairs = fact.select(fact_key, column)
    if not is_small(dim):
        pairs = pairs.distinct()
    values = join_on(pairs, dim, [key], "left").select(*by, column).distinct()
    return values.groupBy(*by).agg(F.count("*").alias(name))


def rollup_subtotal(
    df: DataFrame, column: str, measure: str, name: str, flag: str = "IsGrandTotalRowTotal"
) -> DataFrame:
    """Group totals plus the grand total; ``flag`` tells it from a group that is blank.

    A rollup repeats each input row once per level, so it runs on the group totals.
    """
    totals = sum_by(df, [column], {name: measure})
    return totals.rollup(column).agg(
        (F.grouping(column) == 1).alias(flag), F.sum(name).alias(name)
    )
