"""Reading the tables, stored intermediate steps, and vocabulary files."""

from __future__ import annotations

import gc
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.session import remove_folder, scratch_path

# A join's smaller side is sent to all executors up to this size, and shuffled beyond.
BROADCAST_BYTES = 64 << 20

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Workers import this package from where the driver found it, if it is not installed there.
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stored:
    """A step written to the shared folder, so that a lost executor costs no recomputation.

    Rows of packed values are not compressed again, as large values take much memory for it.
    """

    def __init__(self, df: DataFrame, name: str, packed: bool = False):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.options(**({"compression": "none"} if packed else {})).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        remove_folder(self.spark, self.path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not at some later time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def are_whole_files(docs: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, each once, so that file and place identify a row."""
    if "_metadata" in (c.lower() for c in docs.columns):
        return False
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return False
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a number of their row in column ``name``.

    The number is the same whenever the result is scanned, however the files are cut into tasks by
    then: it is made of a hash of the file, tested to tell all files apart, and the row's place in
    it. Rows that are not simply those of Parquet files are numbered once and stored. So number
    once and hand the result on.
    """
    if are_whole_files(docs):
        last = F.max("_metadata.row_index").alias("last")
        files = Stored(docs.groupBy(F.col("_metadata.file_path").alias("file")).agg(last), "row-files")
        found = files.df.agg(F.count("*").alias("n"), F.max("last").alias("last")).first()
        bits = max(1, int(found["last"] or 0).bit_length())
        for seed in range(8):
            hashed = lambda file: F.pmod(F.xxhash64(F.lit(seed), file), F.lit(1 << (63 - bits)))  # noqa: B023, E731
            if files.df.agg(F.count_distinct(hashed(F.col("file")))).first()[0] == found["n"]:
                files.remove()
                high = F.shiftleft(hashed(F.col("_metadata.file_path")), bits)
                return docs.withColumn(name, high.bitwiseOR(F.col("_metadata.row_index")))
        files.remove()
    return Stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered-rows").df


def measured(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows, to be broadcast if their measured size allows it; else Spark picks the join.

    ``df`` is measured by a job of its own, so pass stored rows.
    """
    size = df.agg(F.sum(F.lit(0).cast("long") + row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
