"""Keyed upsert into a lake table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.operators.filters import filter_between
from tarnhouse.sources.lake import BUCKET, LakeTable, bucket_of, conform
from tarnhouse.sources.monthly import MONTH, MonthlyTable, month_of

FIRST_MARK = datetime(2013, 1, 1)
LAST_MARK = datetime(9999, 12, 31)


@dataclass(frozen=True)
class UpsertResult:
    """Rows the source held, and what became of them in the target."""

    rows: int
    inserted: int
    updated: int
    max_mark: datetime | None


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """One row per key, the greatest by ``order`` and then by the remaining columns.

    The maximum of a struct combines on the map side, so a key that holds a large
    share of the rows shrinks to one row per task before anything is shuffled. Rows with
    a null key belong to no other row, so all of them stay.
    """
    whole = None
    for k in keys:
        present = F.col(f"`{k}`").isNotNull()
        whole = present if whole is None else whole & present
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    picked = df.filter(whole).groupBy(*keys).agg(newest)
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_newest.`{c}`").alias(c) for c in df.columns]
    ).unionByName(df.filter(~whole))


def _same_keys(left: str, right: str, keys: Sequence[str]):
    condition = F.col(f"{left}.`{keys[0]}`") == F.col(f"{right}.`{keys[0]}`")
    for k in keys[1:]:
        condition &= F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`")
    return condition


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate lets it broadcast the rows."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _null_apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null key match nothing; a hash of the row spreads them over the tasks."""
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    spread = F.when(whole, F.lit(0).cast("long")).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select("*", F.lit(True).alias("_present"), spread.alias("_spread"))


def merged_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the target after an upsert, with ``_change`` saying how they came about.

    Matching target rows take the source's values, the other source rows are added. A
    null key matches nothing, so such source rows are always added.

    A source that Spark can broadcast is joined twice, so that the target is not shuffled. Beyond
    that, one full outer join reads and shuffles the target once: a pair is an update, a source
    row alone an insert. The rows of one key then meet in one task, as keys identify rows.
    """
    columns = target.columns
    if not fits_broadcast(source):
        t, s = _null_apart(target, keys).alias("t"), _null_apart(source.select(*columns), keys).alias("s")
        both = t.join(s, _same_keys("t", "s", [*keys, "_spread"]), "full_outer")
        new, old = F.col("s._present"), F.col("t._present")
        change = F.when(new & old, "update").when(new, "insert")
        values = [F.when(new, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in columns]
        return both.select(*values, change.alias("_change"))
    flagged = source.select(*columns, F.lit(True).alias("_present"))
    updated = (
        target.alias("t")
        .join(flagged.alias("s"), _same_keys("t", "s", keys), "left")
        .select(
            *[
                F.when(F.col("s._present"), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
                for c in columns
            ],
            F.when(F.col("s._present"), F.lit("update")).alias("_change"),
        )
    )
    known = target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()
    inserted = source.join(known, list(keys), "left_anti").select(
        *columns, F.lit("insert").alias("_change")
    )
    return updated.unionByName(inserted)


CHANGE_COUNTS = ("insert", "update")


def change_counts() -> list[Column]:
    return [F.count_if(F.col("_change") == kind).alias(kind) for kind in CHANGE_COUNTS]


def several_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any target row has several source rows of its key."""
    again = source.select(*keys).dropna().groupBy(*keys).count().filter("count > 1")
    if again.isEmpty():
        return False  # most often: the increment alone says so
    return not target.select(*keys).join(again, list(keys), "left_semi").isEmpty()


def touched_months(table: MonthlyTable, source: DataFrame) -> tuple[set[int], set[int]]:
    """The months that source rows belong to, and those that hold the rows they match."""
    new = {r[0] for r in source.select(month_of(table.date)).distinct().collect()}
    stored = table.by_month().select(*table.keys, MONTH)
    matched = stored.join(source.select(*table.keys), list(table.keys), "left_semi")
    return new, {r[0] for r in matched.select(MONTH).distinct().collect()}


def upsert_months(table: MonthlyTable, source: DataFrame) -> UpsertResult:
    """Replace the months that the source touches and leave the files of all others alone.

    A row whose date moves to another month touches both; a month left without rows goes. To
    find the months, only keys are read of the whole target. A table without rows takes the source
    as it is, read once, as none of its rows can match. See ``upsert`` for the rest.
    """
    if not table.exists():
        raise FileNotFoundError(f"no table at {table.path}")
    source = conform(source, table.columns)
    if not table.months():
        rows = table.append(source)
        return UpsertResult(rows, rows, 0, table.max_mark())
    new, old = touched_months(table, source)
    if not new:
        return UpsertResult(0, 0, 0, table.max_mark())
    target = table.by_month().filter(F.col(MONTH).isin(*(new | old))).drop(MONTH)
    if several_match(target, source, table.keys):
        raise ValueError("several source rows match the same target row")
    left = sorted(old - new)
    rows = [F.count_if(F.col(MONTH) == month).alias(f"rows_{month}") for month in left]
    seen = table.replace_months(merged_rows(target, source, table.keys), [*change_counts(), *rows], ["_change"])
    for month in left:
        if not seen.get(f"rows_{month}"):
            table.remove_month(month)
    inserted, updated = (seen.get(kind, 0) for kind in CHANGE_COUNTS)
    return UpsertResult(inserted + updated, inserted, updated, table.max_mark())


def upsert(table: LakeTable | MonthlyTable, source: DataFrame) -> UpsertResult:
    """Update the rows of ``table`` that ``source`` matches and add the others.

    Several source rows that match one target row are an error, since it is undefined
    which of them wins; the table then stays as it was. ``source`` is read several
    times, so pass stored rows rather than a long plan.
    """
    if isinstance(table, MonthlyTable):
        return upsert_months(table, source)
    keys = list(table.keys)
    base = table.snapshot()
    if base is None:
        raise FileNotFoundError(f"no table at {table.path}")
    source = conform(source, base.schema)

    touched, kept = base.folders, []
    if base.layout:
        bucket = bucket_of(base.layout, keys).alias(BUCKET)
        buckets = {row[0] for row in source.select(bucket).distinct().collect()}
        touched = [f for f in base.folders if f.bucket in buckets]
        kept = [f for f in base.folders if f.bucket not in buckets]

    target = table.read_folders(touched, base.schema)
    written, changes = table.write_data(
        merged_rows(target, source, keys),
        base.layout,
        helpers=["_change"],
        metrics=change_counts(),
    )
    inserted, updated = (changes.get(kind, 0) for kind in CHANGE_COUNTS)
    # Every target row appears once, unless several source rows matched it.
    if sum(f.rows for f in written) - inserted > sum(f.rows for f in touched):
        raise ValueError("several source rows match the same target row")
    done = table.publish(base, kept + written, base.layout, base.schema)
    return UpsertResult(inserted + updated, inserted, updated, done.max_mark)


def create_or_upsert(table: LakeTable | MonthlyTable, source: DataFrame) -> UpsertResult:
    """Create the table on its first load, upsert into it afterwards.

    The first load stores the rows as they are, also several for one key, as no target row
    is there to match; run ``latest_per_key`` before where a source may hold them.
    """
    if table.exists():
        return upsert(table, source)
    rows = table.create(source)
    return UpsertResult(rows, rows, 0, table.max_mark())


def update_then_insert(
    table: LakeTable | MonthlyTable,
    source: DataFrame,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> UpsertResult:
    """Upsert the source rows whose mark lies in the closed window.

    Without a start the window begins at the newest mark stored, and without an end it
    stays open. The result carries the newest mark after the load, ready to be the
    next start.
    """
    start = start or table.max_mark() or FIRST_MARK
    window = filter_between(source, table.mark, start, end or LAST_MARK)
    return upsert(table, window)
