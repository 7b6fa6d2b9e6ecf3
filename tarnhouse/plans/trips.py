"""Trip views over CSV and Parquet files, their union and the daily aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.operators.aggregates import sum_by
from tarnhouse.operators.filters import Mark
from tarnhouse.operators.sets import union_ranges
from tarnhouse.sources.files import TRIP_SCHEMA, scan_csv_typed, scan_parquet

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def trip_view(trips: DataFrame) -> DataFrame:
    """The five report columns, with dates for times."""
    return trips.select(
        "VendorID",
        F.col(PICKUP).cast("date").alias(PICKUP),
        F.col(DROPOFF).cast("date").alias(DROPOFF),
        "passenger_count",
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
    )


def trips_csv(spark: SparkSession, path: str) -> DataFrame:
    return trip_view(scan_csv_typed(spark, path, TRIP_SCHEMA))


def trips_parquet(spark: SparkSession, path: str) -> DataFrame:
    return trip_view(scan_parquet(spark, path))


def trips_union(months: Sequence[tuple[DataFrame, Mark, Mark]]) -> DataFrame:
    """Several months, each cut to its days."""
    return union_ranges(months, PICKUP)


def daily_amount(trips: DataFrame) -> DataFrame:
    return sum_by(trips, [PICKUP], {"total_amount": "total_amount"})
