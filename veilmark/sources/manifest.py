"""Manifests: which files feed which table, and how they are read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Landing, scan_csv, scan_ndjson
from .schema import drop_fields, schema_from_json

# Columns of a manifest line, in order, and format names.
MANIFEST_COLUMNS = ("table_name", "uri", "max_bad_records", "file_format", "field_delimiter")
CSV_FORMAT = "CSV"
JSON_FORMAT = "NEWLINE_DELIMITED_JSON"

_MANIFEST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MANIFEST_COLUMNS])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest lines as rows; every field is trimmed and 'None' means absent."""
    rows = spark.read.schema(_MANIFEST_SCHEMA).option("mode", "PERMISSIVE").csv(path)
    trimmed = rows.select(*[F.trim(F.col(c)).alias(c) for c in MANIFEST_COLUMNS])
    return trimmed.select(
        "table_name",
        "uri",
        F.col("max_bad_records").cast("int").alias("max_bad_records"),
        "file_format",
        F.when(F.col("field_delimiter") != "None", F.col("field_delimiter")).alias("field_delimiter"),
    ).filter(F.col("table_name").isNotNull())


def scan_manifest(
    spark: SparkSession,
    manifest_path: str,
    schemas: str | Mapping[str, T.StructType],
    partition_columns: Mapping[str, list[str]] | None = None,
    header: bool = True,
) -> dict[str, Landing]:
    """One landing per manifest line, with the line's budget; only the manifest and schemas are read here.

    ``schemas`` is a folder of ``<table>_schema.json`` files or a mapping.
    Tables named in ``partition_columns`` are Hive partitioned: those columns
    come from the folder names and leave the declared schema.
    """
    tables = {}
    for line in read_manifest(spark, manifest_path).collect():
        if isinstance(schemas, str):
            text = spark.read.text(f"{schemas}/{line.table_name}_schema.json", wholetext=True).first()[0]
            schema = schema_from_json(text)
        else:
            schema = schemas[line.table_name]
        parts = (partition_columns or {}).get(line.table_name, [])
        schema = drop_fields(schema, parts)
        base = line.uri.rstrip("*").rstrip("/")
        path, base_path = (base, base) if parts else (line.uri, None)
        budget = line.max_bad_records or 0
        if line.file_format == CSV_FORMAT:
            sep = line.field_delimiter or ","
            landing = scan_csv(spark, path, schema, sep=sep, header=header, max_bad=budget, base_path=base_path)
        else:
            landing = scan_ndjson(spark, path, schema, max_bad=budget, base_path=base_path)
        tables[line.table_name] = landing
    return tables


def load_manifest(
    spark: SparkSession,
    manifest_path: str,
    schemas: str | Mapping[str, T.StructType],
    into: str,
    partition_columns: Mapping[str, list[str]] | None = None,
    header: bool = True,
) -> dict[str, DataFrame]:
    """Land every table of a manifest as the next version of ``into/<table>``; each file is read once."""
    landings = scan_manifest(spark, manifest_path, schemas, partition_columns, header)
    return {name: landing.land(f"{into.rstrip('/')}/{name}") for name, landing in landings.items()}


def manifest_from_ddl(df: DataFrame, from_bucket: str, to_bucket: str, scheme: str = "gs") -> DataFrame:
    """Manifest rows from ``(table_name, ddl)``: first uri, budget, format, delimiter."""
    # The patterns follow the text format of the definitions.
    ddl = F.col("ddl")
    uri = F.regexp_extract(ddl, scheme + r'://[^"\[\],]+', 0)
    moved = F.replace(uri, F.lit(f"{scheme}://{from_bucket}"), F.lit(f"{scheme}://{to_bucket}"))

    def option(pattern: str):
        found = F.regexp_extract(ddl, pattern, 1)
        return F.when(ddl.rlike(pattern), found)

    return df.filter(ddl.contains(f"{scheme}://{from_bucket}/") & F.col("table_name").endswith("_r")).select(
        "table_name",
        F.when(moved.contains("*"), moved).otherwise(F.concat(moved, F.lit("*"))).alias("uri"),
        F.coalesce(option(r"max_bad_records\s*=\s*(\d+)").cast("int"), F.lit(0)).alias("max_bad_records"),
        option(r'format\s*=\s*"([^"]+)"').alias("file_format"),
        option(r'field_delimiter\s*=\s*"([^"]+)"').alias("field_delimiter"),
    )
