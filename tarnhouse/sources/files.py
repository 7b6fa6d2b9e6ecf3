"""CSV and Parquet scans, exports and seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Quotes inside a quoted value are doubled.
QUOTES = {"quote": '"', "escape": '"'}

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# The columns of the trip files.
TRIP_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count int, trip_distance decimal(10,2), RateCodeID int, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type int, fare_amount decimal(10,2), "
    "extra decimal(10,2), mta_tax decimal(10,2), tip_amount decimal(10,2), "
    "tolls_amount decimal(10,2), improvement_surcharge decimal(10,2), "
    "total_amount decimal(10,2), congestion_surcharge decimal(10,2)"
)


def scan_csv_typed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType,
    sep: str = ",",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Header CSV read with a declared schema, so no inference pass over the files.

    The header must name the declared columns in their order. A value that does not fit
    its type is an error; with ``mode`` PERMISSIVE it is null.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, sep=sep, mode=mode, enforceSchema=False, **QUOTES)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def scan_csv_text(spark: SparkSession, path: str | Sequence[str], sep: str = "|") -> DataFrame:
    """Header CSV with every column a string; ``path`` may be a glob such as ``dir/*/*.csv``.

    The first file's header names the columns, and a file with another header is an error.
    """
    names = spark.read.options(header=True, sep=sep, **QUOTES).csv(path).schema
    return spark.read.schema(names).options(header=True, sep=sep, enforceSchema=False, **QUOTES).csv(path)


def scan_csv_entity(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """UTF-8 header CSV whose line breaks always end the row, even inside quotes."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .option("multiLine", False)
        .options(**QUOTES)
        .csv(path)
    )


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan with the schema of the files."""
    return spark.read.parquet(*paths)


def seed_dates(spark: SparkSession, path: str, column: str = "full_moon_date") -> DataFrame:
    """One-column date seed. A value that is no date, and another header, are errors.

    ``scan_csv_checked`` with the same column sets such rows aside instead.
    """
    return scan_csv_typed(spark, path, f"{column} date")


def export_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Materialise a query as UTF-8 delimited text with a header row in each file."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .options(**QUOTES)
        .csv(path)
    )


def export_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Materialise a query as snappy Parquet."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_staging(df: DataFrame, root: str, table: str, run: str | None = None) -> str:
    """Land an increment below ``root`` and return its path.

    ``table`` may have folders for its schema; ``run`` keeps loads apart that land the same
    table at the same time.
    """
    name = table.rsplit("/", 1)[-1]
    path = f"{root}/incremental/{table}/{f'{run}/' if run else ''}{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Store a fact in one folder per partition value.

    The rebalance gathers each partition value into few files and splits a value
    that holds a large share of the rows over several tasks.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def reload_partition(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions present in ``df``; the others stay as they are."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def ctas(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Save a query as a catalog table and return the table."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def define_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
