"""Reports over snapshots, tag trees and model manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import name_key, path_name_key
from . import latest
from .detect import bare

# Cells and labels of the comparison report.
MISSING, CHANGED, UNCHANGED = "N/A", "Changed", "No Change"
ID_NAMES = ("ssn", "nationalid", "customerssn", "foreignerssn", "ssnid", "sotu", "yvsotu", "nationalidsensitive")


def snapshot_diff(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Field-level comparison ``(key..., field, before, after, comparison)``.

    The snapshots are joined wide, one full outer join on the key, and turned
    into one row per field afterwards, so the shuffle carries rows, not cells.
    """
    fields = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in key]

    def side(df: DataFrame, tag: str) -> DataFrame:
        cells = [F.col(c).cast("string").alias(f"{tag}_{c}") for c in df.columns if c not in key]
        return df.select(*[F.col(k).alias(f"{tag}_key_{k}") for k in key], *cells, F.lit(True).alias(f"{tag}_here"))

    left, right = side(before, "b"), side(after, "a")
    condition = F.lit(True)
    for i, k in enumerate(key):
        same = F.col(f"b_key_{k}") == F.col(f"a_key_{k}")
        condition = same if i == 0 else condition & same
    joined = left.join(right, condition, "full_outer")

    def cell(tag: str, field: str, df: DataFrame) -> Column:
        if field not in df.columns:
            return F.lit(MISSING)
        return F.when(F.col(f"{tag}_here"), F.col(f"{tag}_{field}")).otherwise(F.lit(MISSING))

    def exists(field: str) -> Column:
        in_before = F.col("b_here").isNotNull() & F.lit(field in before.columns)
        in_after = F.col("a_here").isNotNull() & F.lit(field in after.columns)
        return in_before | in_after

    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                cell("b", f, before).alias("before"),
                cell("a", f, after).alias("after"),
                exists(f).alias("exists"),
            )
            for f in fields
        ]
    )
    keys = [F.coalesce(f"b_key_{k}", f"a_key_{k}").alias(k) for k in key]
    rows = joined.select(*keys, F.inline(cells)).filter("exists").drop("exists")
    same_value = F.col("before").eqNullSafe(F.col("after"))
    return rows.withColumn("comparison", F.when(same_value, F.lit(UNCHANGED)).otherwise(F.lit(CHANGED)))


def conformance(actual: DataFrame, expected: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Does the value of every actual row equal the expected one?  Yes/No per row."""
    wanted = expected.select(*key, F.col(value).alias("expected"))
    joined = actual.join(wanted, list(key), "left")
    match = F.when(F.col(value).eqNullSafe(F.col("expected")), F.lit("Yes")).otherwise(F.lit("No"))
    return joined.withColumn("match", match)


def tag_counts(rows: DataFrame) -> DataFrame:
    """Categories, parents and children per sensitivity level.

    ``rows`` come from the tag tree flattened with ``keep_empty``.
    """
    counted = rows.groupBy("level").agg(
        F.count_distinct("category").alias("categories"),
        F.count_distinct("category", "parent").alias("parents"),
        F.count_distinct("category", "parent", "child").alias("children"),
    )
    return counted.withColumn("total", F.col("categories") + F.col("parents") + F.col("children"))


def edge_cases(paths: DataFrame, tags: DataFrame) -> DataFrame:
    """Sensitive leaf names whose type is not text (and not a container)."""
    kind = F.col("data_type")
    leaves = paths.filter(~kind.startswith("STRUCT") & ~kind.startswith("ARRAY") & (kind != "STRING"))
    names = tags.select(name_key(F.col("field_name")).alias("__key")).distinct()
    leaf = name_key(F.substring_index("field_path", ".", -1))
    return leaves.join(names, leaf == F.col("__key"), "left_semi")


# Fixed value: the form of a source call in the code of a model.
SOURCE_CALL = r"\{\{source\('([^']+)',\s*'([^']+)'\)\}\}"


def source_usage(models: DataFrame, tables: DataFrame, paths: DataFrame) -> DataFrame:
    """Per table: the models that read it and the id columns it holds.

    ``models`` has ``model, raw_code`` and may have ``sources``, an array of
    ``(table_catalog, table_schema)`` structs that the model declares; a call in
    the code names catalog and schema, too.  ``tables`` has ``table_catalog,
    table_schema, table_name``.  Models are listed per schema before they meet
    its tables, so no row per table and model is made.
    """
    calls = models.select("model", F.explode(F.regexp_extract_all("raw_code", F.lit(SOURCE_CALL), F.lit(0))).alias("call"))
    pairs = calls.select(
        "model",
        F.regexp_extract("call", SOURCE_CALL, 1).alias("table_catalog"),
        F.regexp_extract("call", SOURCE_CALL, 2).alias("table_schema"),
    )
    if "sources" in models.columns:
        declared = models.select("model", F.explode("sources").alias("s"))
        pairs = pairs.unionByName(declared.select("model", "s.table_catalog", "s.table_schema"))
    schema = ["table_catalog", "table_schema"]
    readers = latest.distinct_list(pairs, schema, "model", "models", ", ")
    models_of = tables.distinct().join(readers, schema)
    ids = paths.filter(path_name_key(F.col("field_path")).isin(list(ID_NAMES)))
    ids_of = latest.distinct_list(ids, ["table_schema", "table_name"], "field_path", "id_columns", ", ")
    return models_of.join(ids_of, ["table_schema", "table_name"], "left").withColumn(
        "id_columns", F.coalesce("id_columns", F.lit("None"))
    )


def tag_groups(rows: DataFrame, template: str = "gdpr_{}_tag") -> DataFrame:
    """Tag group per parent: the parent first, then its children in order.

    ``rows`` has ``parent, child, child_pos``.
    """
    head, tail = template.split("{}")
    group = F.concat(F.lit(head), F.lower("parent"), F.lit(tail)).alias("tag_group")
    children = F.array_sort(F.collect_list(F.when(F.col("child").isNotNull(), F.struct("child_pos", "child"))))
    grouped = rows.groupBy("parent").agg(children.alias("c"))
    return grouped.select(group, F.concat(F.array("parent"), F.col("c.child")).alias("columns"))


def lineage_names(edges: DataFrame) -> DataFrame:
    """Distinct bare column names of a lineage."""
    return edges.select(bare(F.col("target_column")).alias("column_name")).distinct()
