"""Declared schemas: config (dict / YAML / JSON file) -> ``StructType``.

Config layout: ``{layer: {table: {"fields": {column: type, ...}}}}``. Field
order is the mapping order and every field is nullable. A type is either one
of the short names below or any Spark DDL type string (``decimal(12,2)``,
``array<string>``, ``struct<a:int>``, ``timestamp_ntz`` ...).
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import types as T

# Short type names accepted in configs and their Spark types.
SHORT_NAMES = {
    "string": T.StringType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal": T.DecimalType(10, 0),
    "null": T.NullType(),
}


def parse_type(name: str) -> T.DataType:
    """Short name or Spark DDL type string -> ``DataType``; ``ValueError`` if unknown.

    Short names need no session; DDL strings are parsed by the active session.
    """
    short = SHORT_NAMES.get(name.strip().lower())
    if short is not None:
        return short
    try:
        return T.DataType.fromDDL(name)
    except Exception as e:  # ParseException / no active session
        raise ValueError(f"Invalid data type in schema configuration: {name!r}") from e


def schema_from_fields(fields: Mapping[str, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(col, parse_type(str(t)), True) for col, t in fields.items()]
    )


def read_config(path: str) -> dict:
    """Load a YAML (``.yaml``/``.yml``) or JSON config file: a local path, or a URI that
    the active session's Hadoop file systems read."""
    if "://" in path:
        from pyspark.sql import SparkSession

        from . import storage

        spark = SparkSession.active()
        if not storage.exists(spark, path):
            raise FileNotFoundError(f"Configuration file not found: {path}")
        text = storage.read_text(spark, path)
    else:
        if not os.path.exists(path):
            raise FileNotFoundError(f"Configuration file not found: {path}")
        with open(path) as fh:
            text = fh.read()
    if path.endswith((".yaml", ".yml")):
        import yaml  # optional dependency

        return yaml.safe_load(text)
    return json.loads(text)


def load_schema(config: Mapping | str, layer: str, table: str) -> T.StructType:
    """Schema of ``layer.table``; ``KeyError`` when the layer or table is missing."""
    cfg = read_config(config) if isinstance(config, str) else config
    return schema_from_fields(cfg[layer][table]["fields"])


def with_field(schema: T.StructType, name: str, dtype: T.DataType | str = "string") -> T.StructType:
    """Schema plus one nullable field (no-op if already declared)."""
    if name in schema.fieldNames():
        return schema
    dt = parse_type(dtype) if isinstance(dtype, str) else dtype
    return T.StructType([*schema.fields, T.StructField(name, dt, True)])
