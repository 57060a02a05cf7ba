"""Table sinks on plain parquet: replace, append, update, copy, register."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import absent


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write parquet, optionally partitioned and clustered.

    Partitioned writes are rebalanced on the partition columns: adaptive
    execution splits an oversized partition value over several files instead of
    sending it to one task, and merges tiny ones.  Sorting inside the files
    gives min/max skipping on the clustering columns.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def copy_table(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Copy a table, replacing the target."""
    spark.read.parquet(src).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def insert_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows plus the new rows whose key is not there yet."""
    return existing.unionByName(absent(new, existing, keys))


def update_where(df: DataFrame, cond: Column, values: Mapping[str, Column]) -> DataFrame:
    """SQL UPDATE as a projection; rows where the condition is NULL stay as they are."""
    hit = F.coalesce(cond, F.lit(False))
    return df.select(
        *[
            F.when(hit, values[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def view_id(dataset: str, table: str, suffixes: Mapping[str, str] | None = None) -> str:
    """Registered name of a published view; market datasets add their suffix."""
    endings = suffixes if suffixes is not None else {"_fi": "_fi", "_no": "_no"}
    for ending, suffix in endings.items():
        if dataset.endswith(ending):
            return f"view_{table}{suffix}"
    return f"view_{table}"


def register_views(frames: Mapping[tuple[str, str] | str, DataFrame], suffix_by_dataset=None) -> list[str]:
    """Register one lazily evaluated view per table; returns the names."""
    names = []
    for key, frame in frames.items():
        dataset, table = key if isinstance(key, tuple) else ("", key)
        name = view_id(dataset, table, suffix_by_dataset)
        frame.createOrReplaceTempView(name)
        names.append(name)
    return names


def list_tables(
    tables: DataFrame, suffix: str | None = None, pattern: str | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Tables of a listing by name suffix, regular expression and exclusions."""
    name = F.col("table_name")
    if suffix:
        tables = tables.filter(name.endswith(suffix))
    if pattern:
        tables = tables.filter(name.rlike(pattern))
    if exclude:
        tables = tables.filter(~name.isin(list(exclude)))
    return tables


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_seed_columns(spark: SparkSession, path: str, column: str = "legacy column name") -> DataFrame:
    """Seed column names of a sensitive-field sheet, without blanks and 'null'."""
    name = F.trim(F.col(f"`{column}`"))
    rows = spark.read.option("header", True).csv(path).select(name.alias("column_name"))
    return rows.filter((F.col("column_name") != "") & (F.lower("column_name") != "null"))


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """Excluded column names, one per line, lower-cased."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("column_name")).distinct()


def read_config_json(spark: SparkSession, path: str) -> DataFrame:
    """``{canonical: [aliases]}`` as rows ``(canonical, alias, ordinal)``."""
    mapping = F.from_json("value", "map<string,array<string>>")
    rows = spark.read.text(path, wholetext=True).select(F.explode(mapping).alias("canonical", "aliases"))
    return rows.select("canonical", F.posexplode("aliases").alias("ordinal", "alias"))
