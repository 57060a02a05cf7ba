"""Joins against a lookup with one row per key, safe for hot and missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .latest import row_hash


def hot_keys(df: DataFrame, key: Column, share: float) -> list:
    """Keys that may hold at least ``share`` of the rows (one pass, no shuffle by key).

    The frequent-items sketch keeps at most ``1 / share`` items, so the list is
    bounded.  It is taken once, here: both sides of a salted join must agree on
    it, and evaluating the sketch twice could give two answers.
    """
    items = df.select(key.alias("k")).filter(F.col("k").isNotNull()).stat.freqItems(["k"], share)
    return sorted(items.first()[0] or [])


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[Column | str, str]],
    hot_share: float | None = None,
    salts: int = 64,
) -> DataFrame:
    """Left join to a lookup that has one row per key; keeps every left row once.

    * Rows without a key cannot match.  They meet in one partition, which the
      adaptive skew join splits like that of any hot key, so the join reads no
      column but its keys and those that are selected.
    * ``hot_share`` salts keys holding at least that share of rows, and rows
      without a key, by a hash of the whole row: only those few lookup rows are
      copied ``salts`` times.
    * A key given by its column's name is compared as it is.  The rows then stay
      dealt by that column, and a later join on it moves them no more.
    """
    made = {f"__k{i}": expr for i, (expr, _) in enumerate(on) if not isinstance(expr, str)}
    names = [expr if isinstance(expr, str) else f"__k{i}" for i, (expr, _) in enumerate(on)]
    values = [c for c in lookup.columns if c not in {col for _, col in on}]
    probe = df.withColumns(made) if made else df
    missing = reduce(lambda a, b: a | b, [_named(n).isNull() for n in names])
    build = lookup.select(*[F.col(c).alias(f"__b{i}") for i, (_, c) in enumerate(on)], *values)
    build = build.dropna(subset=[f"__b{i}" for i in range(len(on))])
    build_hash = F.xxhash64(*[F.col(f"__b{i}") for i in range(len(on))])

    if hot_share is None:
        probe = probe.withColumn("__salt", F.lit(0).cast("bigint"))
        # Always 0, but not a literal, so the optimizer keeps it as a join key.
        build = build.withColumn("__bsalt", F.pmod(build_hash, F.lit(1)).cast("bigint"))
    else:
        key_hash = F.when(~missing, F.xxhash64(*[_named(n) for n in names]))
        hot = hot_keys(probe, key_hash, hot_share)
        salt_of = F.pmod(row_hash(df), F.lit(salts))
        probe = probe.withColumn(
            "__salt",
            F.when(missing | key_hash.isin(hot), salt_of).otherwise(F.lit(0)).cast("bigint"),
        )
        copies = F.when(build_hash.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        build = build.withColumn("__bsalt", F.explode(copies.cast("array<bigint>")))

    condition = F.col("__salt") == F.col("__bsalt")
    for i, n in enumerate(names):
        condition = condition & (_named(n) == F.col(f"__b{i}"))
    joined = probe.join(build, condition, "left")
    return joined.drop("__salt", "__bsalt", *made, *[f"__b{i}" for i in range(len(on))])


def absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key does not occur in ``existing``."""
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def union_keys(frames: Sequence[DataFrame], columns: Sequence[str], name: str, spark=None) -> DataFrame:
    """Distinct values of one column per frame; typed empty result for no frames."""
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType())]))
    parts = [f.select(F.col(c).cast("string").alias(name)) for f, c in zip(frames, columns)]
    return reduce(DataFrame.unionByName, parts).filter(F.col(name).isNotNull()).distinct()
