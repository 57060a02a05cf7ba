"""Landing-file scans with declared schemas, refused unknown fields and a bad-record budget, in one read of the files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versioned

CORRUPT, UNKNOWN = "_corrupt_record", "_undeclared"


class BadRecordBudgetExceeded(ValueError):
    """More unreadable records than the table allows."""


class UnknownFields(ValueError):
    """Files hold fields the declared schema does not know."""


@dataclass
class Landing:
    """Rows of landing files, read and checked in one pass.

    Nothing runs before ``land`` or an action on ``rows``.  ``rows`` holds the good rows only; an action that reads them
    all also counts the bad ones, and ``check`` then holds the counts against the budget.
    """

    rows: DataFrame
    path: str
    max_bad: int
    seen: Observation

    def check(self) -> dict[str, int]:
        """Counts of the first action on ``rows``; raises when they are beyond what the table allows."""
        found = self.seen.get
        if found["unknown"]:
            raise UnknownFields(f"{self.path}: undeclared fields in {found['unknown']} rows, {found['first']} to {found['last']}")
        if found["bad"] > self.max_bad:
            raise BadRecordBudgetExceeded(f"{self.path}: {found['bad']} bad records, {self.max_bad} allowed")
        return {"rows": found["rows"], "bad": found["bad"]}

    def land(self, target: str) -> DataFrame:
        """Write the good rows as the next version of the table at ``target``; commit only what passes the check."""
        spark, target = self.rows.sparkSession, target.rstrip("/")
        last = versioned.version(spark, target)
        staged = versioned.stage(self.rows, target, last, last.bucket if last else None)
        try:
            self.check()
            versioned.commit(spark, target, last, staged)
        except Exception:
            versioned.discard(spark, staged)
            raise
        return versioned.read(spark, target, staged.number)


def _landing(df: DataFrame, max_bad: int, path: str) -> Landing:
    """Good rows of ``df``, whose last two columns are the corrupt record and the undeclared paths."""
    seen, columns = Observation(f"landing-{uuid.uuid4().hex}"), [c for c in df.columns if c not in (CORRUPT, UNKNOWN)]
    bad, strange = F.col(CORRUPT).isNotNull(), F.size(UNKNOWN) > 0
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("bad"),
        F.count_if(strange).alias("unknown"),
        F.min(F.array_min(UNKNOWN)).alias("first"),
        F.max(F.array_max(UNKNOWN)).alias("last"),
        # Keeps a declared column in every plan; a scan of the corrupt record alone is not allowed.
        F.count(F.col(f"`{columns[0]}`")).alias("filled"),
    )
    return Landing(counted.filter(~bad).select(*[f"`{c}`" for c in columns]), path, max_bad, seen)


def _refusing(df: DataFrame, path: str) -> DataFrame:
    """Rows of ``df`` that fail the query at the first bad record or undeclared field."""
    columns = [c for c in df.columns if c not in (CORRUPT, UNKNOWN)]
    unknown = F.concat(F.lit(f"{path}: undeclared fields "), F.array_join(UNKNOWN, ", "))
    bad = F.concat(F.lit(f"{path}: malformed record "), F.left(CORRUPT, F.lit(200)))
    fault = F.when(F.col(CORRUPT).isNotNull(), bad).when(F.size(UNKNOWN) > 0, unknown)
    first = F.col(f"`{columns[0]}`")
    sound = F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(first.isNull() | first.isNotNull())
    return df.filter(sound).select(*[f"`{c}`" for c in columns])


def _undeclared_in(schema: T.StructType, prefix: str):
    return lambda element: undeclared(element, schema, prefix)


def undeclared(value: Column, schema: T.StructType, prefix: str = "") -> Column:
    """Paths of a variant that the schema does not declare, at any depth; array elements share their array's path."""
    members = F.try_variant_get(value, "$", "map<string,variant>")
    names = [f.name.lower() for f in schema.fields]
    strange = F.filter(F.coalesce(F.map_keys(members), F.array().cast("array<string>")), lambda k: ~F.lower(k).isin(names))
    found = [F.transform(strange, lambda k: F.concat(F.lit(prefix), k))]
    for field in schema.fields:
        dtype, inner = field.dataType, F.try_element_at(members, F.lit(field.name))
        path = f"{prefix}{field.name}."
        if isinstance(dtype, T.StructType):
            found.append(undeclared(inner, dtype, path))
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            items = F.try_variant_get(inner, "$", "array<variant>")
            each = F.flatten(F.transform(items, _undeclared_in(dtype.elementType, path)))
            found.append(F.coalesce(each, F.array().cast("array<string>")))
    return F.concat(*found)


def _ndjson(spark: SparkSession, path: str, schema: T.StructType, strict: bool, base_path: str | None) -> DataFrame:
    """Declared columns, partition columns, corrupt record and undeclared paths of every line.

    Parsed from text with the whole schema: the JSON scan would only parse the selected columns, and which rows count as
    bad would depend on the query.
    """
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = reader.text(path).filter(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parts = [c for c in lines.columns if c != "value"]
    nothing = F.array().cast("array<string>")
    unknown = undeclared(F.try_parse_json("value"), schema) if strict else nothing
    rows = lines.select(*parts, F.from_json("value", wide, options).alias("row"), unknown.alias(UNKNOWN))
    return rows.select("row.*", *parts, UNKNOWN)


def scan_ndjson(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_bad: int = 0,
    strict: bool = True,
    base_path: str | None = None,
) -> Landing:
    """Newline-delimited JSON (gzip by suffix) with a declared schema, to be landed with a budget of bad records."""
    return _landing(_ndjson(spark, path, schema, strict, base_path), max_bad, path)


def read_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = True, base_path: str | None = None
) -> DataFrame:
    """Newline-delimited JSON without a budget: the first bad record or undeclared field fails the query."""
    return _refusing(_ndjson(spark, path, schema, strict, base_path), path)


def _csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool, quote: str, strict: bool, base_path: str | None
) -> DataFrame:
    """Declared and partition columns and corrupt record of every line.

    Column pruning is off in the parser, so a row counts as bad for any of its columns and not only for the selected ones.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("columnPruning", False)
        # Check header names against the schema instead of trusting positions.
        .option("enforceSchema", not (strict and header))
    )
    if base_path:
        reader = reader.option("basePath", base_path)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    others = [c for c in rows.columns if c != CORRUPT]
    return rows.select(*[f"`{c}`" for c in others], CORRUPT, F.array().cast("array<string>").alias(UNKNOWN))


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    max_bad: int = 0,
    strict: bool = True,
    base_path: str | None = None,
) -> Landing:
    """Delimited text with a declared schema, to be landed with a budget; Hive partitions below ``base_path``."""
    return _landing(_csv(spark, path, schema, sep, header, quote, strict, base_path), max_bad, path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    strict: bool = True,
    base_path: str | None = None,
) -> DataFrame:
    """Delimited text without a budget: the first bad record fails the query."""
    return _refusing(_csv(spark, path, schema, sep, header, quote, strict, base_path), path)


def with_file_path(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Source file of every row."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_partition_date(df: DataFrame, src: str, name: str = "date_partition") -> DataFrame:
    """Physical partition column under its published name."""
    return df.withColumn(name, F.col(src))


def union_by_name(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union of sources by column name; schema drift only where asked for."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
