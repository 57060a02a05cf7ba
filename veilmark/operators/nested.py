"""Arrays and structs: unnest, re-nest, flatten, rebuild."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def type_at(schema: T.StructType, path: str) -> T.DataType:
    """Type of a dotted path, looking through arrays; names compare without case."""
    current: T.DataType = schema
    for part in path.split("."):
        if isinstance(current, T.ArrayType):
            current = current.elementType
        match = [f for f in current.fields if f.name.lower() == part.lower()]
        if not match:
            raise KeyError(path)
        current = match[0].dataType
    return current


def has_path(schema: T.StructType, path: str) -> bool:
    try:
        type_at(schema, path)
    except (KeyError, AttributeError):
        return False
    return True


def leaves(schema: T.StructType, path: str) -> list[str]:
    """Paths of all members below a path that are no structs themselves; an array is one member."""
    dtype = type_at(schema, path)
    if not isinstance(dtype, T.StructType):
        return [path]
    return [leaf for f in dtype.fields for leaf in leaves(schema, f"{path}.{f.name}")]


def member(schema: T.StructType, path: str) -> Column:
    """Column at a path, or a NULL text column when the schema lacks it."""
    return F.col(path) if has_path(schema, path) else F.lit(None).cast("string")


def unnest(
    df: DataFrame,
    path: str,
    how: str = "inner",
    on: Callable[[Column], Column] | None = None,
    alias: str = "item",
) -> DataFrame:
    """One row per array element in column ``alias``.

    ``how='left'`` keeps parents without a matching element; ``on`` filters the
    elements first, so a parent whose elements all fail still appears once.
    """
    array = F.col(path)
    if on is not None:
        array = F.filter(array, on)
    generator = F.explode if how == "inner" else F.explode_outer
    return df.withColumn(alias, generator(array))


def expand(df: DataFrame, struct: str, prefix: str = "", drop: Sequence[str] = ()) -> DataFrame:
    """Replace a struct column by its members."""
    dtype = df.schema[struct].dataType
    skipped = {d.lower() for d in drop}
    members = [
        F.col(struct).getField(f.name).alias(prefix + f.name) for f in dtype.fields if f.name.lower() not in skipped
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != struct], *members)


def flatten_struct(df: DataFrame, path: str, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Append the members of a (nested) struct; ``rename`` picks and names them."""
    dtype = type_at(df.schema, path)
    wanted = rename or {f.name: f.name for f in dtype.fields}
    return df.select("*", *[F.col(f"{path}.{m}").alias(name) for m, name in wanted.items()])


def star_except(df: DataFrame, *names: str) -> DataFrame:
    """All columns but the named ones; unknown names are an error."""
    known = {c.lower() for c in df.columns}
    unknown = [n for n in names if n.lower() not in known]
    if unknown:
        raise ValueError(f"columns not found: {unknown}")
    return df.drop(*names)


def renest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """Group rows back into one sorted array of structs per key.

    The array is the result itself: a document with that many children.  Sorting
    makes it independent of arrival order.
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def map_array(array: Column, fn: Callable[[Column], Column]) -> Column:
    """Array comprehension; a NULL array gives an empty one."""
    return F.coalesce(F.transform(array, fn), F.array())


def empty_for_null(df: DataFrame) -> DataFrame:
    """Repeated fields are never NULL in the source system: make them empty arrays."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({a: F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)) for a in arrays})


def largest(a: Column, b: Column) -> Column:
    """``a`` when it is strictly longer than ``b``; NULL counts as empty."""
    return F.when(F.size(F.coalesce(a, F.array())) > F.size(F.coalesce(b, F.array())), a).otherwise(b)
