"""Entities described by a model file: attributes give the schema, partitions the files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarnhouse.sources.checked import Checked, scan_csv_checked
from tarnhouse.sources.files import QUOTES

ATTRIBUTE_TYPES = {
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "dateTime": T.TimestampNTZType(),
    "decimal": T.DecimalType(19, 4),
    "double": T.DoubleType(),
    "int64": T.LongType(),
    "string": T.StringType(),
}


def read_model(spark: SparkSession, path: str) -> dict:
    """The model file as a dictionary. It is metadata, a few kilobytes whatever the data."""
    rows = spark.read.text(path, wholetext=True).collect()
    return json.loads("".join(row["value"] for row in rows).lstrip("﻿"))


def entity_schema(entity: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(a["name"], ATTRIBUTE_TYPES[a["dataType"]]) for a in entity["attributes"]]
    )


def _entity(spark: SparkSession, model_path: str, name: str) -> tuple[T.StructType, list[str]]:
    """The columns of one entity and where its files lie."""
    entities = {e["name"]: e for e in read_model(spark, model_path)["entities"]}
    entity = entities[name]
    return entity_schema(entity), [p["location"] for p in entity["partitions"]]


def scan_entity(spark: SparkSession, model_path: str, name: str, header: bool = False) -> DataFrame:
    """Read the CSV files of one entity with the schema its attributes declare.

    A value that does not fit its attribute is an error, and so is a header with other names
    or another order.
    """
    schema, locations = _entity(spark, model_path, name)
    options = {"header": header, "mode": "FAILFAST", "enforceSchema": not header, **QUOTES}
    return spark.read.schema(schema).options(**options).csv(locations)


def scan_entity_checked(spark: SparkSession, model_path: str, name: str, header: bool = False) -> Checked:
    """As ``scan_entity``, with the rows that do not fit set aside."""
    schema, locations = _entity(spark, model_path, name)
    return scan_csv_checked(spark, locations, schema, header=header)
