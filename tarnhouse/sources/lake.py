"""Lake tables: Parquet folders plus a small manifest of the folders that are current.

``<path>/data/<folder>/`` holds Parquet files and is never changed once written.
``<path>/manifest/<n>/`` holds one small JSON file; each row of the newest version names
one live folder. A load writes its data first and the manifest last, so a load that
fails part-way leaves the previous version in place, and a plan may read the table it
replaces.

A table can be split into buckets by its keys. An upsert then reads and rewrites only
the buckets its source touches and carries the other folders over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from tarnhouse.session import child_names, local_rows, remove_folder

BUCKET = "_bucket"
ENTRY = "bucket long, folder string, rows long, mark string, layout string, schema string"


def hash_layout(buckets: int) -> str:
    """Spread the keys evenly over a fixed number of buckets."""
    return f"hash:{buckets}"


def range_layout(width: int) -> str:
    """Bucket a whole-number key by ranges, so new keys touch only the last buckets."""
    return f"range:{width}"


def bucket_of(layout: str, keys: list[str]) -> Column:
    kind, size = layout.split(":")
    if kind == "hash":
        return F.pmod(F.xxhash64(*keys), F.lit(int(size)))
    return F.coalesce(F.expr(f"`{keys[0]}` div {size}"), F.lit(-1)).cast("long")


@dataclass(frozen=True)
class Folder:
    """One live folder of a table version."""

    bucket: int | None
    folder: str
    rows: int
    mark: str | None


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its folders, bucket layout and columns."""

    version: int
    folders: list[Folder]
    layout: str | None
    schema: StructType

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.folders)

    @property
    def max_mark(self) -> datetime | None:
        marks = [datetime.fromisoformat(f.mark) for f in self.folders if f.mark is not None]
        return max(marks, default=None)


@dataclass(frozen=True)
class LakeTable:
    """A table by path. ``keys`` are the upsert keys, ``mark`` the high-water column."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ()
    mark: str | None = None
    layout: str | None = None

    # -- reading -----------------------------------------------------------

    def snapshot(self) -> Snapshot | None:
        """The newest complete version, or none before the first write.

        Only the newest manifest is read; its rows are one per live folder.
        """
        newest = self._newest()
        return self._version(newest) if newest else None

    def _version(self, version: int) -> Snapshot:
        rows = self.spark.read.schema(ENTRY).json(f"{self.path}/manifest/{version}").collect()
        folders = [
            Folder(r["bucket"], r["folder"], r["rows"], r["mark"]) for r in rows if r["folder"]
        ]
        schema = StructType.fromJson(json.loads(rows[0]["schema"]))
        return Snapshot(version, folders, rows[0]["layout"], schema)

    def _versions(self) -> list[int]:
        names = child_names(self.spark, f"{self.path}/manifest")
        return [int(name) for name in names if name.isdigit()]

    def _newest(self) -> int:
        """Number of the newest version whose manifest is complete, 0 without one."""
        for version in sorted(self._versions(), reverse=True):
            if self._complete(version):
                return version
        return 0

    def _complete(self, version: int) -> bool:
        return "_SUCCESS" in child_names(self.spark, f"{self.path}/manifest/{version}")

    def _stored(self) -> Snapshot:
        snapshot = self.snapshot()
        if snapshot is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return snapshot

    def exists(self) -> bool:
        return self._newest() > 0

    def read(self) -> DataFrame:
        snapshot = self._stored()
        return self.read_folders(snapshot.folders, snapshot.schema)

    def read_folders(self, folders: list[Folder], schema: StructType) -> DataFrame:
        """The rows of some folders. The stored schema spares a look into the files."""
        if not folders:
            return local_rows(self.spark, [], schema)
        paths = [f"{self.path}/data/{f.folder}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths)

    def row_count(self) -> int:
        return self._stored().rows

    def max_mark(self) -> datetime | None:
        """Newest value of the mark column, from the manifest and without a scan."""
        snapshot = self.snapshot()
        return snapshot.max_mark if snapshot else None

    # -- writing -----------------------------------------------------------

    def write_data(
        self,
        df: DataFrame,
        layout: str | None,
        helpers: Sequence[str] = (),
        metrics: Sequence[Column] = (),
    ) -> tuple[list[Folder], dict[str, Any]]:
        """Write rows below a new data folder and describe what was written.

        Rows, newest mark and ``metrics`` are observed in the writing stage, behind the
        last shuffle: Spark counts each of its tasks once, however often it is tried.
        ``helpers`` are columns the metrics need; they are not stored. For a table in
        buckets the counts per bucket come from the files, reading the mark column alone.
        """
        folder = uuid.uuid4().hex
        target = f"{self.path}/data/{folder}"
        if layout:
            if layout.startswith("range") and not isinstance(df.schema[self.keys[0]].dataType, IntegralType):
                raise ValueError(f"a range layout needs a whole-number key, and {self.keys[0]} is none")
            df = df.withColumn(BUCKET, bucket_of(layout, list(self.keys))).hint("rebalance", BUCKET)
        rows = F.count(F.lit(1)).alias("rows")
        mark = F.max(F.col(self.mark).cast("timestamp_ntz")) if self.mark else F.max(F.lit(None))
        mark = mark.cast("string").alias("mark")
        seen = Observation()
        df = df.observe(seen, rows, mark, *metrics).drop(*helpers)
        if not layout:
            df.write.parquet(target)
            observed = seen.get
            entry = Folder(None, folder, observed.get("rows", 0), observed.get("mark"))
            return [entry], observed
        df.write.partitionBy(BUCKET).parquet(target)
        stored = df.select(*([self.mark] if self.mark else [])).schema.add(BUCKET, "long")
        stats = self.spark.read.schema(stored).parquet(target).groupBy(BUCKET).agg(rows, mark)
        entries = [
            Folder(r[BUCKET], f"{folder}/{BUCKET}={r[BUCKET]}", r["rows"], r["mark"])
            for r in stats.collect()
        ]
        return entries, seen.get

    def publish(
        self, base: Snapshot | None, folders: list[Folder], layout: str | None, schema: StructType
    ) -> Snapshot:
        """Make ``folders`` the current version, provided ``base`` still is.

        A table has one writer at a time; a version that appeared since ``base`` was
        read is an error. Numbers left behind by a writer that died are passed over.
        """
        known = base.version if base else 0
        if self._newest() != known:
            raise RuntimeError(f"another writer changed {self.path}")
        version = max([known, *self._versions()]) + 1
        # A table without rows still has a manifest row to carry its schema.
        listed = folders or [Folder(None, "", 0, None)]
        rows = [(f.bucket, f.folder, f.rows, f.mark, layout, schema.json()) for f in listed]
        entries = local_rows(self.spark, rows, ENTRY).coalesce(1)
        entries.write.json(f"{self.path}/manifest/{version}")
        return Snapshot(version, folders, layout, schema)

    def remove_old(self, keep: int = 2) -> int:
        """Delete data that none of the newest ``keep`` versions holds; returns how much.

        Replaced versions and failed loads leave their folders behind. Run this while no
        load writes the table and no query still reads an older version.
        """
        complete = [v for v in sorted(self._versions(), reverse=True) if self._complete(v)]
        if keep < 1 or not complete:
            raise ValueError("keep at least one complete version")
        live = {f.folder for v in complete[:keep] for f in self._version(v).folders}
        removed = 0
        for name in child_names(self.spark, f"{self.path}/data"):
            inside = child_names(self.spark, f"{self.path}/data/{name}")
            buckets = [f"{name}/{b}" for b in inside if b.startswith(f"{BUCKET}=")]
            for folder in buckets or [name]:
                if folder not in live:
                    remove_folder(self.spark, f"{self.path}/data/{folder}")
                    removed += 1
        return removed

    def overwrite(self, df: DataFrame) -> int:
        """Replace the whole table; returns the number of rows written."""
        return self._replace(self.snapshot(), df)

    def _replace(self, base: Snapshot | None, df: DataFrame) -> int:
        folders, _ = self.write_data(df, self.layout)
        return self.publish(base, folders, self.layout, df.schema).rows

    def create(self, df: DataFrame) -> int:
        """First save of a table; an existing table is an error."""
        if self.exists():
            raise FileExistsError(f"table exists at {self.path}")
        return self._replace(None, df)

    def truncate_load(self, df: DataFrame) -> int:
        """Replace all rows and keep the stored columns, their order and their types."""
        base = self._stored()
        return self._replace(base, conform(df, base.schema))

    def append(self, df: DataFrame) -> int:
        """Add rows in a new folder; nothing already stored is read or moved."""
        base = self._stored()
        added, _ = self.write_data(conform(df, base.schema), base.layout)
        self.publish(base, base.folders + added, base.layout, base.schema)
        return sum(f.rows for f in added)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name, cast to its types."""
    missing = set(schema.names) - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    return df.select(*[F.col(c.name).cast(c.dataType) for c in schema])
