"""Tag tree to masking rules, and masking rules onto data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crypto import sha256_hex
from .detect import ALWAYS_NULL, DEFAULT_MASK, SHA256

LEVELS = ("high", "medium", "low")
# Default rule of a level.
LEVEL_DEFAULTS = {"high": SHA256, "medium": DEFAULT_MASK, "low": DEFAULT_MASK}

_CHILD = "struct<sensitivity:string,masking_rule:string,type:string>"
_PARENT = f"struct<children:map<string,{_CHILD}>,sensitivity:string,masking_rule:string,type:string,category:string>"
_LEVEL = f"map<string,map<string,{_PARENT}>>"


def tree_key(level: str, suffix: str = "") -> str:
    return f"{level}_sensitivity_tags{suffix}"


def flatten_tree(df: DataFrame, col: str = "tree", suffix: str = "", keep_empty: bool = False) -> DataFrame:
    """Tag-tree JSON to rows ``(level, category, parent, child, masking_rule, type, ...)``.

    ``keep_empty`` retains categories without parents and parents without children.
    """
    schema = ", ".join(f"`{tree_key(level, suffix)}` {_LEVEL}" for level in LEVELS)
    others = [c for c in df.columns if c != col]
    generator = F.explode_outer if keep_empty else F.explode
    parsed = df.select(*others, F.from_json(F.col(col), schema).alias("__t"))
    levels = F.array(
        *[F.struct(F.lit(level).alias("level"), F.col(f"__t.`{tree_key(level, suffix)}`").alias("tags")) for level in LEVELS]
    )
    by_level = parsed.select(*others, F.inline(levels))
    by_category = by_level.select(*others, "level", generator("tags").alias("category", "parents"))
    by_parent = by_category.select(*others, "level", "category", generator("parents").alias("parent", "p"))
    by_child = by_parent.select(
        *others,
        "level",
        "category",
        "parent",
        F.col("p.masking_rule").alias("parent_masking_rule"),
        F.col("p.type").alias("parent_type"),
        generator("p.children").alias("child", "c"),
    )
    return by_child.select(
        *others,
        "level",
        "category",
        "parent",
        "parent_masking_rule",
        "parent_type",
        "child",
        F.col("c.masking_rule").alias("masking_rule"),
        F.col("c.type").alias("type"),
    )


def level_default(level: Column) -> Column:
    rule = F.lit(DEFAULT_MASK)
    for name, default in LEVEL_DEFAULTS.items():
        rule = F.when(level == name, F.lit(default)).otherwise(rule)
    return rule


def rules_with_default(tags: DataFrame, rows: DataFrame) -> DataFrame:
    """Masking rule per created tag ``(level, display_name)``: by child name, else the level default."""
    by_child = rows.groupBy("level", F.col("child").alias("display_name")).agg(F.max("masking_rule").alias("__rule"))
    joined = tags.join(by_child, ["level", "display_name"], "left")
    return joined.withColumn("masking_rule", F.coalesce("__rule", level_default(F.col("level")))).drop("__rule")


def sha256_rules(rows: DataFrame) -> DataFrame:
    """Parents and children whose rule is SHA256, as ``(level, category, field_name)``."""
    parents = rows.filter(F.col("parent_masking_rule") == SHA256).select(
        "level", "category", F.col("parent").alias("field_name")
    )
    children = rows.filter(F.col("masking_rule") == SHA256).select(
        "level", "category", F.col("child").alias("field_name")
    )
    return parents.unionByName(children).distinct()


def default_for(dtype: T.DataType) -> Column:
    """Neutral value shown in place of a masked one."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit("0001-01-01").cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("0001-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.array().cast(dtype)
    return F.lit(None).cast(dtype)


def masked(column: Column, dtype: T.DataType, rule: str) -> Column:
    if rule == ALWAYS_NULL:
        return F.lit(None).cast(dtype)
    if rule == SHA256:
        if not isinstance(dtype, (T.StringType, T.BinaryType)):
            raise ValueError(f"SHA256 needs text or bytes, not {dtype.simpleString()}")
        return sha256_hex(column)
    if rule == DEFAULT_MASK:
        return default_for(dtype)
    raise ValueError(f"unknown masking rule {rule}")


def apply(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Mask columns by rule; other columns pass through."""
    return df.select(
        *[
            masked(F.col(f.name), f.dataType, rules[f.name]).alias(f.name) if f.name in rules else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rules_of(rows: Sequence) -> dict[str, str]:
    """Rules collected from classified metadata rows (column_name, masking_rule)."""
    return {r.column_name: r.masking_rule for r in rows}
