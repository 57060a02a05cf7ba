"""One row per key: latest, largest, first and last match.

Row-number filters plan as ``WindowGroupLimit``: every input partition keeps one
row per key before the shuffle, so a key holding a third of the table still
sends at most one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str
EPOCH_FLOOR = "1990-01-01"


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def latest_by(
    df: DataFrame,
    keys: Sequence[ColumnLike],
    order: Sequence[Column],
    tiebreak: Sequence[Column] = (),
    where: Column | None = None,
    keep_rn: bool = False,
    rn_name: str = "rn",
) -> DataFrame:
    """First row per key in the given order; ``where`` applies before ranking."""
    source = df if where is None else df.filter(where)
    window = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order, *tiebreak)
    ranked = source.withColumn(rn_name, F.row_number().over(window)).filter(F.col(rn_name) == 1)
    return ranked if keep_rn else ranked.drop(rn_name)


@dataclass(frozen=True)
class Pick:
    """Values taken from the row with the greatest ``order``; rows where it is NULL do not stand.

    A struct as order compares member by member and NULL members come last.
    """

    order: Column
    values: Mapping[str, Column]

    @staticmethod
    def newest(order: Sequence[Column], values: Mapping[str, Column], where: Column | None = None) -> Pick:
        """Greatest in several columns, among the rows that satisfy ``where``."""
        key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
        return Pick(key if where is None else F.when(where, key), values)


def pick_by(df: DataFrame, keys: Mapping[str, Column], picks: Sequence[Pick]) -> DataFrame:
    """One row per key with the values of several greatest rows, from one scan and one shuffle.

    Every task reduces its rows to one per key before the shuffle, so a hot key sends one row per task.  Each value is
    an aggregate of its own: the optimizer drops those that nobody reads, down to the scan.  All values of a pick
    compare the same orders in the same sequence, so they come from the same row even where orders tie.
    """
    # Orders and values are columns of their own first, so that no aggregate evaluates them again.
    orders = {f"__order{i}": pick.order for i, pick in enumerate(picks)}
    values = {name: value for pick in picks for name, value in pick.values.items()}
    rows = df.select(*[c.alias(name) for name, c in {**keys, **orders, **values}.items()])
    found = [F.max_by(F.col(f"`{v}`"), f"__order{i}").alias(v) for i, pick in enumerate(picks) for v in pick.values]
    return rows.groupBy(*keys).agg(*found)


def version_key(version: str = "__v", updated: str = "updatedAt", archived: str = "time_archived") -> list[Column]:
    """The order of ``version_order`` as values of which the greatest is the newest."""
    floor = F.lit(EPOCH_FLOOR).cast("timestamp")
    return [F.col(version), F.coalesce(F.col(updated), floor), F.coalesce(F.col(archived), floor)]


def flat_hash(df: DataFrame) -> Column:
    """Hash of a row's flat columns: a compact tiebreak that reads no nested value."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)]
    return F.xxhash64(*values) if values else F.lit(0).cast("bigint")


def version_order(version: str = "__v", updated: str = "updatedAt", archived: str = "time_archived") -> list[Column]:
    """Newest document version first; missing times count as the floor date."""
    floor = F.lit(EPOCH_FLOOR).cast("timestamp")
    return [
        F.col(version).desc(),
        F.coalesce(F.col(updated), floor).desc(),
        F.coalesce(F.col(archived), floor).desc(),
    ]


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def row_hash(df: DataFrame) -> Column:
    """Hash of a row, nested values included: a stable last tiebreak.  Maps have no order and are left out."""
    values = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return F.xxhash64(*values) if values else F.lit(0).cast("bigint")


def largest_array_by(df: DataFrame, keys: Sequence[str], array_col: str) -> DataFrame:
    """Key and the longest value of an array column over all rows of the key.

    Among equally long arrays the greatest one is taken, so the choice does not
    depend on arrival order.
    """
    size = F.size(F.coalesce(F.col(array_col), F.array()))
    return latest_by(df.select(*keys, array_col), keys, [size.desc()], [F.col(array_col).desc()])


def first_match(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """First claim wins: the row with the lowest ordinal per key."""
    return latest_by(df, keys, [F.col(ordinal).asc()], [row_hash(df)])


def last_match(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Last claim wins: the row with the highest ordinal per key."""
    return latest_by(df, keys, [F.col(ordinal).desc()], [row_hash(df)])


#: A key with more rows than this meets its value in several tasks, if it is one of the so many largest.
HOT_ROWS, HOT_KEYS = 100_000, 1_000


def _attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Join one row per key back onto its rows; NULL keys meet each other.

    ``per_key`` has the keys as ``__<key>`` and their rows as ``__rows``.  Of the largest keys, at most ``HOT_KEYS``,
    every ``hot_rows`` rows get a copy of the value: a hash of the row says which.  So a task reads about as much
    whatever the number of keys; a key that is not among the largest holds at most a thousandth of the table.
    """
    tags = [f"__{k}" for k in keys]

    def same(left: Sequence[str], right: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"`{x}`").eqNullSafe(F.col(f"`{y}`")) for x, y in zip(left, right)])

    largest = per_key.filter(F.col("__rows") > hot_rows).orderBy(F.col("__rows").desc(), *[F.col(f"`{t}`") for t in tags])
    copies = F.ceil(F.col("__rows") / hot_rows).cast("bigint").alias("__copies")
    hot = largest.limit(HOT_KEYS).select(*[F.col(f"`{t}`").alias(f"__hot{t}") for t in tags], copies)
    # Bounded by construction, so both sides learn the hot keys by broadcast.
    hot, names = F.broadcast(hot), [f"__hot{t}" for t in tags]
    spread = df.join(hot, same(keys, names), "left").drop(*names)
    spread = spread.withColumn("__salt", F.coalesce(F.pmod(row_hash(df), "__copies"), F.lit(0).cast("bigint"))).drop("__copies")
    first = F.lit(0).cast("bigint")
    every = F.explode(F.sequence(first, F.coalesce("__copies", F.lit(1)) - 1)).alias("__bsalt")
    values = [F.col(f"`{c}`") for c in per_key.columns if c != "__rows"]
    copied = per_key.join(hot, same(tags, names), "left").select(*values, every)
    condition = same(keys, tags) & (F.col("__salt") == F.col("__bsalt"))
    return spread.join(copied, condition, "left").drop("__salt", "__bsalt", *tags)


def partition_count(
    df: DataFrame, keys: Sequence[str], col: str, name: str = "n", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Non-null count of ``col`` per key on every row.

    Counted with a map-side aggregate and joined back instead of a window: a
    window would hold the whole group of a hot key in one task, while the join
    only meets one counted row per key, and the rows of a hot key are dealt over
    several tasks.
    """
    counts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.count(col).alias(name), F.count(F.lit(1)).alias("__rows")
    )
    return _attach(df, counts, keys, hot_rows)


def collect_over(
    df: DataFrame, keys: Sequence[str], col: str, name: str = "values", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Sorted distinct values of ``col`` per key on every row.

    Values are made distinct before they are collected, so the array grows with
    the number of different values (columns of a table, say) and not with rows.
    """
    tags = [f"__{k}" for k in keys]
    distinct = df.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(col).alias("__value"))
    distinct = distinct.groupBy(*tags, "__value").agg(F.count(F.lit(1)).alias("__rows"))
    lists = distinct.groupBy(*tags).agg(
        F.array_sort(F.collect_list("__value")).alias(name), F.sum("__rows").alias("__rows")
    )
    return _attach(df, lists, keys, hot_rows)


def distinct_list(df: DataFrame, keys: Sequence[str], col: str, name: str, separator: str | None = None) -> DataFrame:
    """One row per key with its sorted distinct values, as an array or joined text."""
    distinct = df.select(*keys, F.col(col).alias("__value")).distinct()
    values = F.array_sort(F.collect_list("__value"))
    if separator is not None:
        values = F.array_join(values, separator)
    return distinct.groupBy(*keys).agg(values.alias(name))
