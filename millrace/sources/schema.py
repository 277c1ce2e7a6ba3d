"""Declared table schemas, read from JSON documents."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The type names a schema document may use.
TYPE_NAMES = {
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
}


def schema_from_json(document: str) -> T.StructType:
    """``{"schema": {"fields": [{"name", "type", "mode"}, ..]}}`` as a
    ``StructType``.  Raises on a type it does not know."""
    fields = []
    for entry in json.loads(document)["schema"]["fields"]:
        kind = entry["type"]
        if kind not in TYPE_NAMES:
            raise ValueError(f"column {entry['name']}: unknown type {kind}")
        nullable = entry["mode"].lower() == "nullable"
        fields.append(T.StructField(entry["name"], TYPE_NAMES[kind], nullable))
    return T.StructType(fields)


def load_schema(spark: SparkSession, folder: str, event: str) -> T.StructType:
    """The schema of an event, from ``<folder>/<event>_schema.json``.  Read through
    Spark, so the folder may lie on any file system the cluster knows; a missing
    document raises."""
    row = spark.read.text(f"{folder}/{event}_schema.json", wholetext=True).first()
    return schema_from_json(row["value"])
