"""Full and incremental loads, their run log, and the run over a control table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, replace
from datetime import UTC, date, datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tarnhouse.operators.filters import filter_enabled, window_predicate
from tarnhouse.operators.upsert import create_or_upsert, update_then_insert
from tarnhouse.plans.control import CONTROL_KEYS, FULL
from tarnhouse.plans.warehouse import warehouse_fact
from tarnhouse.session import local_rows
from tarnhouse.sources.database import Source, scan_source_query
from tarnhouse.sources.files import write_staging
from tarnhouse.sources.lake import LakeTable
from tarnhouse.sources.monthly import MonthlyTable

# Tables loaded at the same time.
PARALLEL_LOADS = 4

Table = LakeTable | MonthlyTable
TableFunction = Callable[[str, str], DataFrame]

SUCCEEDED, FAILED = "Succeeded", "Failed"


@dataclass(frozen=True)
class LoadResult:
    """What one load read, wrote and left as the newest mark."""

    rows_read: int = 0
    rows_copied: int = 0
    inserted: int = 0
    updated: int = 0
    max_mark: datetime | None = None
    status: str = SUCCEEDED
    started: datetime | None = None
    ended: datetime | None = None
    error: str | None = None


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def load_full(
    source: DataFrame,
    table: Table,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> LoadResult:
    """Overwrite ``table`` with the source rows in the window.

    The window applies to full loads too. Row count and newest mark come from the
    table's own bookkeeping, so the table is not scanned again.
    """
    begun = _now()
    if table.mark and (start is not None or end is not None):
        source = source.filter(window_predicate(source, table.mark, start, end))
    rows = table.overwrite(source)
    return LoadResult(rows, rows, rows, 0, table.max_mark(), SUCCEEDED, begun, _now())


def load_incremental(
    source: DataFrame,
    table: Table,
    staging_root: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> LoadResult:
    """Land the source rows in the window and upsert them into ``table``.

    Rows at the start mark are read again; the upsert makes that harmless. The landed
    increment is what the upsert reads, so the source is queried once. It lands in a folder
    of its own for each run, under the last two parts of the table's path: schema and table.
    """
    begun = _now()
    window = source
    if start is not None or end is not None:
        window = source.filter(window_predicate(source, table.mark, start, end))
    name = "/".join(table.path.rstrip("/").rsplit("/", 2)[-2:])
    seen = Observation()
    observed = window.observe(seen, F.count(F.lit(1)).alias("rows"))
    path = write_staging(observed, staging_root, name, uuid.uuid4().hex)
    landed = seen.get["rows"]
    done = create_or_upsert(table, table.spark.read.schema(window.schema).parquet(path))
    return LoadResult(
        landed, landed, done.inserted, done.updated, done.max_mark, SUCCEEDED, begun, _now()
    )


def load_gold_full(view: DataFrame, table: Table) -> LoadResult:
    """Copy a silver view whole."""
    return load_full(view, table)


def load_gold_incremental(
    view: DataFrame,
    table: Table,
    staging_root: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> LoadResult:
    """Upsert the window of a silver view, usually on two keys."""
    return load_incremental(view, table, staging_root, start, end)


def load_warehouse(
    view: DataFrame,
    table: Table,
    load_type: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> LoadResult:
    """Into a table that exists: replace its rows, or update and insert in a closed window."""
    begun = _now()
    if load_type == FULL:
        rows = table.truncate_load(view)
        return LoadResult(rows, rows, rows, 0, table.max_mark(), SUCCEEDED, begun, _now())
    done = update_then_insert(table, view, start, end)
    return LoadResult(
        done.rows, done.rows, done.inserted, done.updated, done.max_mark, SUCCEEDED, begun, _now()
    )


def run_log(control: LakeTable, batch: datetime, results: Sequence[tuple[Row, LoadResult]]) -> None:
    """Write status, counts, times and marks back to the control rows.

    An incremental load that succeeded moves its row's start to the newest mark. A load
    that failed keeps its marks, so the next run repeats it. The control table is small and
    has one writer at a time, so it is written anew from its rows.
    """
    if not results:
        return
    updated = {}
    for row, r in results:
        new = row.asDict() | {
            "batchloaddatetime": batch,
            "loadstatus": r.status,
            "pipelinestarttime": r.started,
            "pipelineendtime": r.ended,
        }
        if r.status == SUCCEEDED:
            new |= {
                "rowsread": r.rows_read,
                "rowscopied": r.rows_copied,
                "rowsinserted": r.inserted,
                "rowsupdated": r.updated,
            }
            if r.max_mark is not None:
                new["maxdatetime"] = r.max_mark
                if row["loadtype"] != FULL:
                    new["startdate"] = r.max_mark
        updated[control_key(row)] = new
    stored = control.read()
    merged = [updated.get(control_key(row), row.asDict()) for row in stored.collect()]
    names = stored.schema.names
    control.overwrite(local_rows(control.spark, [tuple(r[c] for c in names) for r in merged], stored.schema))


def no_table(row: Row, path: str) -> None:
    return None


def control_key(row: Row) -> tuple:
    return tuple(row[c] for c in CONTROL_KEYS)


def sink_name(row: Row) -> str:
    """The target as schema and table, or the table alone where it has no schema."""
    return ".".join(part for part in (row["sinkschema"], row["sinktable"]) if part)


def _attempt(load: Callable[[], LoadResult]) -> LoadResult:
    begun = _now()
    try:
        return load()
    except Exception as error:  # noqa: BLE001 - one failed table must not stop the others
        return LoadResult(status=FAILED, started=begun, ended=_now(), error=str(error))


def run_loads(
    spark: SparkSession,
    control: LakeTable,
    source: Source | TableFunction,
    root: str,
    stage: int = 1,
    warehouse: bool = False,
    batch: datetime | None = None,
    layouts: Mapping[str, str] | None = None,
    table_of: Callable[[Row, str], Table | None] | None = None,
) -> dict[str, LoadResult]:
    """Load every active control row and write the outcome back.

    ``source`` is a database or Parquet source, which is told the mark column, the window and
    the key of each table and so reads it in parts, or a function of schema and table that gives
    the rows to load. Tables go to ``<root>/Tables`` and
    increments to ``<root>/Files``. ``layouts`` gives the bucket layout of target tables,
    so that an increment rewrites only the buckets it touches; ``table_of`` may give a table of
    another kind for a control row and its path, such as one in months, or None. The facts of the
    warehouse lie in months. Up to four loads run at
    once, each in its own scheduler pool, so under the fair scheduler they share the
    cluster. Each outcome is logged as soon as its load is done, so a run that stops midway
    keeps the marks of the finished tables. Results are named by ``sink_name``; two rows
    with the same target are an error.
    """
    rows = filter_enabled(control.read(), stage).collect()
    names = [sink_name(row) for row in rows]
    if twice := {n for n in names if names.count(n) > 1}:
        raise ValueError(f"several control rows load {', '.join(sorted(twice))}")

    def load(row: Row) -> LoadResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", sink_name(row))
        keys = tuple(k for k in (row["tablekey"], row["tablekey2"]) if k)
        parts = [root, "Tables", row["sinkschema"], row["sinktable"]]
        path = "/".join(p for p in parts if p)
        layout = (layouts or {}).get(row["sinktable"])
        table = LakeTable(spark, path, keys, row["datecolumn"], layout)
        if given := (table_of or no_table)(row, path):
            table = given
        elif warehouse and (fact := warehouse_fact(spark, path, row["sinktable"])):
            table = replace(fact, keys=keys, mark=row["datecolumn"])
        window = (row["startdate"], row["enddate"])
        name = (row["sourceschema"], row["sourcetable"])
        if hasattr(source, "read"):
            rows_in = scan_source_query(spark, source, *name, row["datecolumn"], *window, row["tablekey"])
        else:
            rows_in = source(*name)
        if warehouse:
            return load_warehouse(rows_in, table, row["loadtype"], *window)
        if row["loadtype"] == FULL:
            return load_full(rows_in, table, *window)
        return load_incremental(rows_in, table, f"{root}/Files", *window)

    batch = batch or _now()
    done = {}
    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        running = {pool.submit(_attempt, partial(load, row)): row for row in rows}
        for finished in as_completed(running):
            row, result = running[finished], finished.result()
            run_log(control, batch, [(row, result)])
            done[sink_name(row)] = result
    return done


def control_lake_table(spark: SparkSession, path: str, rows: DataFrame) -> LakeTable:
    """Store control rows as a table keyed by source and target."""
    table = LakeTable(spark, path, CONTROL_KEYS)
    table.create(rows.coalesce(1))
    return table
