"""Layout of a table's files along a space-filling curve over several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import row_hash

# Cells per column are 2**BITS; text is placed by its first bytes, as many as fit a long.
BITS = 6
TEXT_BYTES = 7
QUANTILE_ACCURACY = 10_000


def _position(df: DataFrame, name: str) -> Column:
    """A number that rises with the column; NULL stays NULL."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"column {name} of type {kind.simpleString()} has no place on the curve")


def curve_position(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Place of a row on the Z-order curve over the columns' quantiles.

    One aggregate over the table finds ``2**bits - 1`` approximate quantiles per column, so skewed columns are cut into
    cells of like size.  NULL lies in the first cell.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("one column at least, and no more bits than a long has")
    shares = [(i + 1) / 2**bits for i in range(2**bits - 1)]
    places = [_position(df, c) for c in columns]
    cuts = df.agg(*[F.percentile_approx(p, shares, QUANTILE_ACCURACY).alias(f"q{i}") for i, p in enumerate(places)]).first()
    bits_of = []
    for i, place in enumerate(places):
        bounds = F.array(*[F.lit(float(q)) for q in sorted(set(cuts[i] or [0.0]))])
        below = F.coalesce(F.size(F.filter(bounds, lambda q: q < place)), F.lit(0)).cast("bigint")  # noqa: B023
        for bit in range(bits):
            one = F.shiftright(below, bit).bitwiseAND(F.lit(1))
            bits_of.append(F.shiftleft(one, bit * len(places) + i))
    return reduce(lambda a, b: a.bitwiseOR(b), bits_of)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS, mode: str = "overwrite"
) -> None:
    """Write about ``files`` files of like size, each with a narrow range of every one of ``columns``.

    Rows are range-partitioned by their place on the curve, then by the columns and a hash of the row, so that a cell
    or value with a third of all rows spreads over several files; only rows equal in all columns stay together.
    Filters on any of the columns skip files and, as rows are sorted inside, row groups.
    The table is read for the quantiles, for Spark's sample of the ranges and for the write.  Columns named ``__curve``
    or ``__spread`` are refused; an empty table gives an empty one.
    """
    if {"__curve", "__spread"} & set(df.columns):
        raise ValueError("columns __curve and __spread are taken")
    placed = df.withColumns({"__curve": curve_position(df, columns, bits), "__spread": row_hash(df)})
    order = ["__curve", *[f"`{c}`" for c in columns], "__spread"]
    ranged = placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranged.drop("__curve", "__spread").write.mode(mode).parquet(path)


def file_ranges(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``(file, n, min_<column>, max_<column>...)``: what a filter can skip by."""
    bounds = [f(f"`{c}`").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    rows = spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *bounds)
