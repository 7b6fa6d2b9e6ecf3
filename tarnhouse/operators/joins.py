"""Equi-joins of facts, headers and lookups.

No join carries a broadcast hint: Spark broadcasts a side only when its size is below
``spark.sql.autoBroadcastJoinThreshold``, by file statistics or by the size measured at
run time, and otherwise shuffles, where adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keys = str | tuple[str, str]


def key_pair(key: Keys) -> tuple[str, str]:
    return (key, key) if isinstance(key, str) else key


def is_small(df: DataFrame) -> bool:
    """Whether Spark expects the rows to be small enough to broadcast.

    This is the planner's own estimate and limit; nothing is computed.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[Keys], how: str = "inner") -> DataFrame:
    """Join on pairs of column names; each pair leaves only the left side's column."""
    condition = None
    renamed = {}
    for i, key in enumerate(keys):
        a, b = key_pair(key)
        renamed[b] = f"_k{i}"
        equal = F.col(a) == F.col(f"_k{i}")
        condition = equal if condition is None else condition & equal
    return left.join(right.withColumnsRenamed(renamed), condition, how).drop(*renamed.values())


def join_lookups(
    fact: DataFrame, lookups: Sequence[tuple[DataFrame, Keys, str]]
) -> DataFrame:
    """Join lookups one after the other; a later one may use columns of an earlier one.

    Each lookup is (rows, key or (left key, right key), "left" or "inner").
    """
    for rows, key, how in lookups:
        fact = join_on(fact, rows, [key], how)
    return fact


def join_header_line(header: DataFrame, line: DataFrame, key: str) -> DataFrame:
    """Lines with the columns of their header."""
    return line.join(header, key, "inner")


def anti_join_new(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def join_composite(left: DataFrame, right: DataFrame, key: str, key2: str | None = None) -> DataFrame:
    """Match on one key, or on two when the second is given."""
    return left.join(right, [key] if key2 is None else [key, key2], "inner")


def join_mixed_type(
    left: DataFrame, right: DataFrame, number_key: str, text_key: str, how: str = "inner"
) -> DataFrame:
    """Whole-number key against text key; text that is no number matches nothing."""
    keyed = right.withColumn("_key", F.col(text_key).try_cast(left.schema[number_key].dataType))
    return left.join(keyed, F.col(number_key) == F.col("_key"), how).drop("_key")


def related_lookup(line: DataFrame, header: DataFrame, key: str, *columns: str) -> DataFrame:
    """Header columns fetched onto each line; a line without header keeps nulls."""
    return line.join(header.select(key, *columns), key, "left")


def related_rows(header: DataFrame, line: DataFrame, key: str, **aggregates) -> DataFrame:
    """Aggregates over the lines of each header; a header without lines keeps nulls.

    The lines are aggregated before the join, so a header with very many lines is
    reduced on the map side and each header meets at most one row.
    """
    totals = line.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])
    return header.join(totals, key, "left")
