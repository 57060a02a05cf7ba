"""Declared table schemas: JSON field lists to and from ``StructType``."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import types as T

TAG_KEY = "policyTags"

# Warehouse type names and their Spark types.
_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "DECIMAL": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "BYTES": T.BinaryType(),
}
_NAMES = {
    T.StringType: "STRING",
    T.LongType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.ShortType: "INTEGER",
    T.DoubleType: "FLOAT",
    T.FloatType: "FLOAT",
    T.DecimalType: "NUMERIC",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "DATETIME",
    T.DateType: "DATE",
    T.BinaryType: "BYTES",
}


def _field(entry: dict) -> T.StructField:
    kind = entry["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        dtype: T.DataType = T.StructType([_field(f) for f in entry.get("fields", [])])
    else:
        dtype = _TYPES[kind]
    mode = entry.get("mode", "NULLABLE").upper()
    if mode == "REPEATED":
        dtype = T.ArrayType(dtype)
    metadata = {}
    if entry.get(TAG_KEY):
        metadata[TAG_KEY] = list(entry[TAG_KEY].get("names", []))
    if entry.get("description"):
        metadata["comment"] = entry["description"]
    return T.StructField(entry["name"], dtype, mode != "REQUIRED", metadata)


def schema_from_json(text: str, drop: Iterable[str] = ()) -> T.StructType:
    """Spark schema of a JSON field list, without the (partition) columns in ``drop``."""
    return drop_fields(T.StructType([_field(e) for e in json.loads(text)]), drop)


def drop_fields(schema: T.StructType, names: Iterable[str]) -> T.StructType:
    unwanted = {n.strip() for n in names}
    return T.StructType([f for f in schema.fields if f.name not in unwanted])


def tag_of(field: T.StructField) -> list[str]:
    return list(field.metadata.get(TAG_KEY, []))


def _entry(field: T.StructField) -> dict:
    dtype, mode = field.dataType, "NULLABLE" if field.nullable else "REQUIRED"
    if isinstance(dtype, T.ArrayType):
        dtype, mode = dtype.elementType, "REPEATED"
    entry: dict = {"name": field.name, "mode": mode}
    if isinstance(dtype, T.StructType):
        entry["type"] = "RECORD"
        entry["fields"] = [_entry(f) for f in dtype.fields]
    else:
        entry["type"] = _NAMES[type(dtype)]
    if tag_of(field):
        entry[TAG_KEY] = {"names": tag_of(field)}
    if field.metadata.get("comment"):
        entry["description"] = field.metadata["comment"]
    return entry


def schema_to_json(schema: T.StructType) -> str:
    """JSON field list of a schema, tags included."""
    return json.dumps([_entry(f) for f in schema.fields], indent=2)
