"""Windowed reads from a source database, or from Parquet in its place."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from tarnhouse.operators.filters import Mark, window_predicate

Value = int | float | Decimal | date | datetime


def sql_literal(value: Mark | Value) -> str:
    """A number, or a date or time in quotes, which databases compare by the column's type."""
    if isinstance(value, (date, datetime, str)):
        return "'{}'".format(str(value).replace("'", "''"))
    return str(value)


def window_sql(column: str | None, start: Mark | None, end: Mark | None) -> str:
    """The load window in SQL: its start is inside, its end is not; nothing where it is open."""
    parts = [f"{column} {sign} {sql_literal(x)}" for sign, x in ((">=", start), ("<", end)) if x is not None]
    return " AND ".join(parts) if column else ""


def cut_points(low: Value, high: Value, parts: int) -> list[Value]:
    """Up to ``parts - 1`` different values that cut the range into equal steps."""
    if isinstance(low, datetime):
        step = (high - low) / parts
        points = [low + step * k for k in range(1, parts)]
    elif isinstance(low, date):
        days = (high - low).days
        points = [low + timedelta(days=days * k // parts) for k in range(1, parts)]
    else:
        first, last = math.floor(low), math.ceil(high)
        points = [first + (last - first) * k // parts for k in range(1, parts)]
    return [p for p in dict.fromkeys(points) if low < p <= high]


def split_predicates(column: str, points: Sequence[Value]) -> list[str]:
    """One predicate for each range between the points: every row meets one, and only one.

    Blanks and whatever lies below go with the first range, what lies above with the last.
    """
    if not points:
        return ["1 = 1"]
    texts = [sql_literal(p) for p in points]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:], strict=False)]
    return [f"{column} < {texts[0]} OR {column} IS NULL", *inner, f"{column} >= {texts[-1]}"]


def _as_time(value: Mark) -> datetime:
    return datetime.fromisoformat(str(value))


@dataclass(frozen=True)
class JdbcSource:
    """Connection settings plus how to split one table over parallel connections."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    partitions: int = 16
    fetch_size: int = 10_000

    def options(
        self, schema: str, table: str, split: tuple[str, object, object] | None = None
    ) -> dict[str, str]:
        """Reader options; ``split`` is (column, lower, upper) for a parallel read."""
        opts = {
            "url": self.url,
            "dbtable": f"{schema}.{table}",
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
            **self.properties,
        }
        if split:
            column, lower, upper = split
            opts |= {
                "partitionColumn": column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(self.partitions),
            }
        return opts

    def load(self, spark: SparkSession, schema: str, table: str, predicates: Sequence[str]) -> DataFrame:
        """The table, over one connection for each predicate."""
        options = self.options(schema, table)
        url, name = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, name, predicates=list(predicates), properties=options)

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """What the database answers to a query."""
        options = self.options("", "")
        del options["dbtable"]
        return spark.read.format("jdbc").options(**options, query=sql).load()

    def bounds(self, spark: SparkSession, schema: str, table: str, column: str, where: str = "") -> tuple:
        """The least and the greatest value of a column, which the database looks up."""
        sql = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {schema}.{table}"
        return tuple(self.query(spark, f"{sql} WHERE {where}" if where else sql).first())

    def predicates(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        mark: str | None = None,
        start: Mark | None = None,
        end: Mark | None = None,
        key: str | None = None,
    ) -> list[str]:
        """How one read is dealt over the connections.

        A closed window is cut into equal times by its own ends. A window that is open, and a
        table without one, is cut by the key between the bounds that the window leaves, or by
        the mark where there is no key or the key is neither number nor date. What holds no such
        column is read over one connection.
        """
        if mark and start is not None and end is not None:
            return split_predicates(mark, cut_points(_as_time(start), _as_time(end), self.partitions))
        window = window_sql(mark, start, end)
        for column in filter(None, (key, mark)):
            low, high = self.bounds(spark, schema, table, column, window)
            if low is None:
                return split_predicates(column, [])  # nothing but blanks to read
            if isinstance(low, Value):
                return split_predicates(column, cut_points(low, high, self.partitions))
        return split_predicates("", [])

    def read(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        mark: str | None = None,
        start: Mark | None = None,
        end: Mark | None = None,
        key: str | None = None,
    ) -> DataFrame:
        return self.load(spark, schema, table, self.predicates(spark, schema, table, mark, start, end, key))


@dataclass(frozen=True)
class ParquetSource:
    """``schema.table`` resolved to a Parquet path by ``locate``."""

    locate: Callable[[str, str], str]

    def read(
        self,
        spark: SparkSession,
        schema: str,
        table: str,
        mark: str | None = None,
        start: Mark | None = None,
        end: Mark | None = None,
        key: str | None = None,
    ) -> DataFrame:
        """The whole files: Spark splits them, and prunes them by the window's filter."""
        return spark.read.parquet(self.locate(schema, table))


class Source(Protocol):
    """What reads a table of a database by window and key."""

    def read(
        self, spark: SparkSession, schema: str, table: str, mark: str | None, start: Mark | None, end: Mark | None,
        key: str | None,
    ) -> DataFrame: ...


def scan_source_query(
    spark: SparkSession,
    source: Source,
    schema: str,
    table: str,
    date_column: str | None = None,
    start: Mark | None = None,
    end: Mark | None = None,
    key: str | None = None,
) -> DataFrame:
    """All columns of ``schema.table`` whose date lies in the load window, which may be open.

    The predicate is a column expression, so it reaches the database or the Parquet
    row groups. A database is read over many connections; ``key`` helps where the window
    is open, see ``JdbcSource.predicates``.
    """
    df = source.read(spark, schema, table, date_column, start, end, key)
    if date_column is None:
        return df
    return df.filter(window_predicate(df, date_column, start, end))
