"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.scheduler.mode": "FAIR",
}


# Shuffled bytes per task to aim for before adaptive execution merges small partitions.
SHUFFLE_TASK_BYTES = 128 << 20


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for inputs of this size: about 800,000 for 100 TB.

    Adaptive execution merges partitions that turn out small, so too many cost little,
    while too few would spill.
    """
    return max(200, -(-input_bytes // SHUFFLE_TASK_BYTES))


def get_session(
    app_name: str = "tarnhouse",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the library is written for.

    ``input_bytes``, the size of the largest input, sets the number of shuffle
    partitions. ``conf`` adds or overrides settings; write dots as double underscores,
    so ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tarnhouse-")
    return _local_root


_session_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; nothing exists there yet.

    All scratch paths of an application lie in one folder, which is removed when the
    application ends.
    """
    application = spark.sparkContext.applicationId
    if application not in _session_folders:
        path = f"{scratch_root(spark)}/tarnhouse/{application}-{uuid.uuid4().hex[:8]}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        _session_folders[application] = path
    return f"{_session_folders[application]}/{name}-{uuid.uuid4().hex}"


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few rows held by the driver as a DataFrame.

    They go over as one Arrow table, which starts no Python worker and leaves Spark
    knowing their size.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrow = to_arrow_schema(fields)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none when it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
