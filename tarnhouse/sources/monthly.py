"""Tables of dated rows as plain Parquet, one folder per month, found by Spark itself.

An increment replaces the folders of the months it touches, by dynamic partition overwrite, and
leaves the files of all others alone. An append adds files. There is no list of files beside the
folders: whatever reads Parquet with partition folders reads these tables.

Replacing several months is not one step. A load that dies between them leaves some replaced and
some not; run again with the same rows, it ends in the same state. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnhouse.operators.filters import window_predicate
from tarnhouse.session import child_names, folder_exists, remove_folder
from tarnhouse.sources.lake import conform

MONTH = "_month"
NO_MONTH = 0  # rows without a date


def month_of(column: str) -> Column:
    """Year and month as one number, such as 201306."""
    day = F.col(column).cast("date")
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(NO_MONTH)).alias(MONTH)


def month_number(day: date | str) -> int:
    year, month = str(day).split("-")[:2]
    return int(year) * 100 + int(month)


@dataclass(frozen=True)
class MonthlyTable:
    """A table by path. ``date`` deals its rows to months, ``keys`` and ``mark`` are as for other tables.

    The columns are declared, so that a table without rows has them, and no file is opened to learn them.
    """

    spark: SparkSession
    path: str
    schema: StructType | str
    date: str
    keys: tuple[str, ...] = ()
    mark: str | None = None

    @property
    def columns(self) -> StructType:
        return StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema

    def exists(self) -> bool:
        return folder_exists(self.spark, self.path)

    def months(self) -> list[int]:
        """The months that have a folder."""
        names = child_names(self.spark, self.path)
        return sorted(int(n.removeprefix(f"{MONTH}=")) for n in names if n.startswith(f"{MONTH}="))

    def by_month(self) -> DataFrame:
        """The rows with their month, by which folders are pruned."""
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        return self.spark.read.schema(StructType([*self.columns, *StructType.fromDDL(f"{MONTH} int")])).parquet(self.path)

    def read(self, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
        """All rows, or those dated from ``start`` up to ``end``, of which only the months are read."""
        rows = self.by_month()
        if start is not None:
            rows = rows.filter(F.col(MONTH) >= month_number(start))
        if end is not None:
            rows = rows.filter(F.col(MONTH).between(NO_MONTH + 1, month_number(end)))
        return rows.filter(window_predicate(rows, self.date, start, end)).drop(MONTH)

    def row_count(self) -> int:
        return self.read().count()

    def max_mark(self) -> datetime | None:
        """Newest value of the mark column, read from that column alone.

        Where the mark is the date, from the newest month alone.
        """
        if not self.mark or not self.exists():
            return None
        rows = self.by_month()
        if self.mark == self.date:
            rows = rows.filter(F.col(MONTH) == max(self.months(), default=NO_MONTH))
        return rows.agg(F.max(F.col(self.mark).cast("timestamp_ntz"))).first()[0]

    # -- writing -----------------------------------------------------------

    def _write(
        self, df: DataFrame, mode: str, metrics: Sequence[Column] = (), helpers: Sequence[str] = (), **options: str
    ) -> dict[str, Any]:
        """Write rows into the folders of their months; rows and ``metrics`` are observed behind the last shuffle."""
        seen = Observation()
        rows = df.withColumn(MONTH, month_of(self.date)).hint("rebalance", MONTH)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).drop(*helpers)
        rows.write.mode(mode).options(**options).partitionBy(MONTH).parquet(self.path)
        return seen.get

    def _write_all(self, df: DataFrame, mode: str) -> int:
        return self._write(conform(df, self.columns), mode).get("rows", 0)

    def create(self, df: DataFrame) -> int:
        """First save of a table; an existing table is an error."""
        if self.exists():
            raise FileExistsError(f"table exists at {self.path}")
        return self._write_all(df, "errorifexists")

    def overwrite(self, df: DataFrame) -> int:
        """Replace the whole table, by rows that are not read from it."""
        return self._write_all(df, "overwrite")

    def truncate_load(self, df: DataFrame) -> int:
        """Replace all rows of a table that exists."""
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        return self.overwrite(df)

    def append(self, df: DataFrame) -> int:
        """Add rows as files of their months; nothing already stored is read or moved."""
        return self._write_all(df, "append")

    def replace_months(self, df: DataFrame, metrics: Sequence[Column], helpers: Sequence[str]) -> dict[str, Any]:
        """Replace the months that ``df`` has rows of; it may be read from them.

        Spark moves the new files into place after all of them are written. ``metrics`` are
        observed on the way, and ``helpers`` are columns for them that are not stored.
        """
        return self._write(df, "overwrite", metrics, helpers, partitionOverwriteMode="dynamic")

    def remove_month(self, month: int) -> None:
        remove_folder(self.spark, f"{self.path}/{MONTH}={month}")
