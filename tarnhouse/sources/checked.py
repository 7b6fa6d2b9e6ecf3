"""CSV scans that set aside what does not fit, with its text, file and reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnhouse.sources.files import QUOTES, TIMESTAMP_FORMAT

BAD = "_bad"


@dataclass(frozen=True)
class Checked:
    """The rows that fit, and ``rejects``: text, file and reason of every other row."""

    rows: DataFrame
    rejects: DataFrame


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file")


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file and header of each file.

    A line's number rises within the piece of a file that a task reads, and the first line lies
    in the piece that starts the file, so it is the one with the least number there.
    """
    lines = spark.read.text(path).select(
        "value", _file(), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    return lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _names(header: Column, fields: T.StructType, sep: str) -> Column:
    """The names in a header line, in lower case; as many as there are columns, and one more if it has more."""
    text = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(fields) + 1)])
    values = F.from_csv(F.regexp_replace(header, "^﻿", ""), text.simpleString()[7:-1].replace(":", " "), {"sep": sep, **QUOTES})
    return F.array(*[F.lower(F.trim(values[f"c{k}"])) for k in range(len(fields) + 1)])


def _reason(fields: T.StructType, sep: str) -> Column:
    """The columns whose value is there but has no value of the type; else the row has another shape."""
    text = ", ".join(f"c{k} string" for k in range(len(fields)))
    values = F.from_csv(F.col(BAD), text, {"sep": sep, **QUOTES})
    wrong = [
        F.when(
            F.col(f"`{f.name}`").isNull() & values[f"c{k}"].isNotNull(),
            F.concat(F.lit(f"{f.name}: "), values[f"c{k}"], F.lit(f" is no {f.dataType.simpleString()}")),
        )
        for k, f in enumerate(fields)
    ]
    named = F.array_join(F.array_compact(F.array(*wrong)), "; ")
    return F.when(named != "", named).otherwise(F.lit(f"not {len(fields)} values"))


def scan_csv_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    sep: str = ",",
    header: bool = True,
) -> Checked:
    """CSV read with a declared schema; rows that do not fit are set aside, none becomes null.

    A value that does not fit its type, or too few or too many values, set a row aside. A file
    whose header does not name the declared columns in their order is set aside whole, for its
    values cannot be told apart. Looking at the headers reads the files as text once more.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = spark.read.schema(T.StructType([*fields, T.StructField(BAD, T.StringType())])).options(
        header=header, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, columnPruning=False, **QUOTES
    )
    rows = read.option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path).select("*", _file())
    # Spark tells a bad row by the columns it parses, so both sides ask for all of them.
    parsed = F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in fields])) >= 0
    good, bad = rows.filter(F.col(BAD).isNull() & parsed), rows.filter(F.col(BAD).isNotNull() & parsed)
    rejects = bad.select(F.col(BAD).alias("text"), "file", _reason(fields, sep).alias("reason"))
    if header:
        names = F.array(*[F.lit(f.name.lower()) for f in fields], F.lit(None).cast("string"))
        told = first_lines(spark, path)
        other = told.filter(~_names(F.col("header"), fields, sep).eqNullSafe(names))
        lines = spark.read.text(path).select(F.col("value").alias("text"), _file()).filter("text <> ''")
        whole = lines.join(other, "file").filter("text <> header")
        reason = F.concat(F.lit("header: "), "header")
        good = good.join(other, "file", "left_anti")
        rejects = rejects.join(other, "file", "left_anti").select("text", "file", "reason")
        rejects = rejects.unionByName(whole.select("text", "file", reason.alias("reason")))
    return Checked(good.select(*[F.col(f"`{f.name}`") for f in fields]), rejects)
