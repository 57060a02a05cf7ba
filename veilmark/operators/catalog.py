"""Catalog of column paths, policy tags, and how they meet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import name_key, path_name_key
from ..sources.schema import TAG_KEY, tag_of
from . import latest, textmatch

# Normalised column names that identify a person, by kind of key.
SSN_NAMES = (
    "ssn",
    "customerssn",
    "foreignerssn",
    "ssnid",
    "nationalid",
    "sotu",
    "yvsotu",
    "identify",
    "contactdetail",
    "nationalidsensitive",
)
EMAIL_NAMES = ("email", "emailaddress", "contactdetail")
MOBILE_NAMES = ("phone", "contactdetail", "mobilephone", "phonenumber", "puhelin")
APP_ID_NAMES = ("applicationid", "loanapplicationoid", "loanapplicationid")
# 'foreignerssn' marks a table as holding ids but is never the join key itself.
SSN_KEY_NAMES = tuple(n for n in SSN_NAMES if n != "foreignerssn")
# Parent tags whose children are personal data, and the parents counted themselves.
PII_PARENTS_OF_CHILDREN = (
    "employer",
    "email",
    "phone",
    "ssn",
    "first_name",
    "last_name",
    "bank_account_number",
    "address",
    "post_code",
    "data",
    "business_organization_number",
    "attributes_raw_json",
    "PII",
)
PII_PARENTS = tuple(p for p in PII_PARENTS_OF_CHILDREN if p not in ("employer", "PII"))
PII_FORCING_CHILD = "last_application_employer_name"
# Types that are not tagged for masking.
NON_MASKABLE = ("NUMERIC", "BOOL", "INT64", "FLOAT64")

PATH_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("field_path", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
)


def type_name(dtype: T.DataType) -> str:
    """Warehouse name of a type."""
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{type_name(dtype.elementType)}>"
    if isinstance(dtype, T.StructType):
        return "STRUCT<" + ", ".join(f"{f.name} {type_name(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.StringType):
        return "STRING"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INT64"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "FLOAT64"
    if isinstance(dtype, T.DecimalType):
        return "NUMERIC"
    if isinstance(dtype, T.BooleanType):
        return "BOOL"
    if isinstance(dtype, T.BinaryType):
        return "BYTES"
    return {"date": "DATE", "timestamp_ntz": "DATETIME"}.get(dtype.simpleString(), "TIMESTAMP")


def walk(schema: T.StructType, prefix: str = "") -> Iterable[tuple[str, T.StructField]]:
    """Every field path of a schema, depth first; members of arrays are dotted too."""
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        yield path, field
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            yield from walk(inner, path)


def column_paths(spark: SparkSession, tables: Mapping[tuple[str, str] | str, DataFrame | T.StructType]) -> DataFrame:
    """One row per column path of the given tables; reads schemas only."""
    rows = []
    for key, table in tables.items():
        dataset, name = key if isinstance(key, tuple) else ("", key)
        schema = table.schema if isinstance(table, DataFrame) else table
        for i, (path, field) in enumerate(walk(schema)):
            rows.append((dataset, name, path.split(".")[0], path, type_name(field.dataType), i))
    return spark.createDataFrame(rows, PATH_SCHEMA)


def catalog_scan(paths: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Column paths of several datasets, each under its own table-name condition."""
    wanted = F.lit(False)
    for dataset, condition in rules:
        wanted = wanted | ((F.col("table_schema") == dataset) & condition)
    return paths.filter(wanted)


def pii_tags(
    tags: DataFrame,
    taxonomies: Sequence[str] | None = None,
    parents_of_children: Sequence[str] = PII_PARENTS_OF_CHILDREN,
    parents: Sequence[str] = PII_PARENTS,
    forcing_child: str = PII_FORCING_CHILD,
) -> DataFrame:
    """Children of listed parent tags plus the distinct listed parents that have children."""
    if taxonomies is not None:
        tags = tags.filter(F.col("taxonomy_id").isin(list(taxonomies)))
    child, parent = tags.alias("c"), tags.alias("p")
    pairs = child.join(parent, F.col("c.parent_policy_tag_id") == F.col("p.policy_tag_id")).select(
        F.col("c.display_name").alias("child"), F.col("p.display_name").alias("parent")
    )
    children = pairs.filter(F.col("parent").isin(list(parents_of_children))).select(F.col("child").alias("display_name"))
    own = (
        pairs.filter(F.col("parent").isin(list(parents)) | (F.col("child") == forcing_child))
        .select(F.col("parent").alias("display_name"))
        .distinct()
    )
    return children.unionByName(own)


def with_parent_type(paths: DataFrame) -> DataFrame:
    """Parent path and its type within the same table (equi-join on the derived parent)."""
    last = F.length("field_path") - F.length(F.substring_index("field_path", ".", -1)) - 1
    parent = F.when(F.instr("field_path", ".") > 0, F.substring(F.col("field_path"), F.lit(1), last))
    children = paths.withColumn("parent_path", parent)
    parents = paths.select(
        F.col("table_schema").alias("__s"),
        F.col("table_name").alias("__t"),
        F.col("field_path").alias("__p"),
        F.col("data_type").alias("parent_type"),
    )
    same = (
        (F.col("table_schema") == F.col("__s"))
        & (F.col("table_name") == F.col("__t"))
        & (F.col("parent_path") == F.col("__p"))
    )
    return children.join(parents, same, "left").drop("__s", "__t", "__p")


def match(
    paths: DataFrame,
    tags: DataFrame,
    mode: str = "exact",
    exclude: Column | None = None,
) -> DataFrame:
    """Column paths with their matching tag.

    ``exact`` compares normalised names and keeps unmatched columns, with the
    nested flag and the number of matches per table and column.  ``substring``
    keeps columns whose name contains a tag name; the last tag in ``ordinal``
    order wins.
    """
    if exclude is not None:
        paths = paths.filter(~F.coalesce(exclude, F.lit(False)))
    if mode == "substring":
        return _substring_match(paths, tags)
    keyed = paths.withColumn("normalized_column", path_name_key(F.col("field_path"))).withColumn(
        "is_nested", F.instr("field_path", ".") > 0
    )
    names = tags.select("display_name", name_key(F.col("display_name")).alias("__tag_key"))
    joined = keyed.join(names, F.col("normalized_column") == F.col("__tag_key"), "left").drop("__tag_key")
    return latest.partition_count(joined, ["table_schema", "table_name", "column_name"], "display_name", "match_count")


def _substring_match(paths: DataFrame, tags: DataFrame) -> DataFrame:
    keyed = paths.filter(F.col("data_type") != "BOOL").withColumn("__name", F.lower("column_name"))
    words = tags.select(F.lower("display_name").alias("word"), "ordinal", F.col("policy_tag_id"))
    hits = textmatch.containment(keyed.select(F.col("__name").alias("name")), words).join(words, "word")
    chosen = hits.groupBy("name").agg(
        F.max_by("policy_tag_id", "ordinal").alias("policy_tag_id"), F.max_by("word", "ordinal").alias("tag_name")
    )
    return keyed.join(chosen, F.col("__name") == F.col("name")).drop("__name", "name")


def assign_tags(
    paths: DataFrame,
    tags: DataFrame,
    exclude_types: Sequence[str] = ("INT64", "BOOL"),
    exclude_tables: Sequence[str] = (),
    exclude_tags: Sequence[str] = ("name", "postal_code_id", "data"),
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """One tag per (table, column): first match by ``ordinal``; exceptions override."""
    columns = paths.filter(~F.col("data_type").isin(list(exclude_types)))
    if exclude_tables:
        columns = columns.filter(~F.col("table_name").isin(list(exclude_tables)))
    usable = tags.filter(~F.col("display_name").isin(list(exclude_tags)))
    pairs = columns.join(
        usable.select("policy_tag_id", F.col("ordinal").alias("tag_ordinal"), "display_name"),
        name_key(F.col("column_name")) == name_key(F.col("display_name")),
    )
    chosen = pairs.groupBy("table_name", "column_name").agg(F.min_by("policy_tag_id", "tag_ordinal").alias("policy_tag_id"))
    if exceptions is None:
        return chosen
    forced = exceptions.select("table_name", "column_name", "policy_tag_id")
    return chosen.join(forced, ["table_name", "column_name"], "left_anti").unionByName(forced)


def join_key_flags(matched: DataFrame) -> DataFrame:
    """Per table: does any column identify a person by ssn, email, phone or application?"""
    key = F.col("normalized_column")

    def any_of(names: Sequence[str]) -> Column:
        return F.coalesce(F.bool_or(key.isin(list(names))), F.lit(False))

    return matched.groupBy("table_schema", "table_name").agg(
        any_of(SSN_NAMES).alias("has_ssn"),
        any_of(EMAIL_NAMES).alias("has_email"),
        any_of(MOBILE_NAMES).alias("has_mobile"),
        any_of(APP_ID_NAMES).alias("has_app_id"),
    )


def join_keys(matched: DataFrame) -> DataFrame:
    """Columns usable as a join key, one row per (column, kind)."""
    key = F.col("normalized_column")
    kinds = {"ssn": SSN_KEY_NAMES, "email": EMAIL_NAMES, "mobile": MOBILE_NAMES, "app_id": APP_ID_NAMES}
    found = F.filter(
        F.array(*[F.when(key.isin(list(names)), F.lit(kind)) for kind, names in kinds.items()]),
        lambda k: k.isNotNull(),
    )
    return matched.select("table_schema", "table_name", "field_path", F.explode(found).alias("kind")).distinct()


def market_of(dataset: Column, mapping: Mapping[str, str], otherwise: str = "OTHER") -> Column:
    """Market of a dataset."""
    result = F.lit(otherwise)
    for name, market in mapping.items():
        result = F.when(dataset == name, F.lit(market)).otherwise(result)
    return result


def apply_tags(
    schema: T.StructType,
    tags: Mapping[str, str],
    id_tag: str | None = None,
    phone_tag: str | None = None,
    keep_existing: bool = False,
) -> T.StructType:
    """Write tags onto the leaves of a (nested) schema as field metadata.

    ``tags`` maps normalised names to tag ids.  National ids that are neither
    text nor boolean, and phone numbers that are not text, take ``id_tag`` and
    ``phone_tag`` instead.
    """

    def tag_for(field: T.StructField) -> str | None:
        key = field.name.lower().replace("_", "")
        kind = type_name(field.dataType)
        if id_tag and key in ("ssn", "nationalid", "validnationalid") and kind not in ("STRING", "BOOL"):
            return id_tag
        if phone_tag and key == "phonenumber" and kind != "STRING":
            return phone_tag
        return tags.get(key)

    def visit(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(visit(dtype.elementType), dtype.containsNull)
        if isinstance(dtype, T.StructType):
            return T.StructType([tagged(f) for f in dtype.fields])
        return dtype

    def tagged(field: T.StructField) -> T.StructField:
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            return T.StructField(field.name, visit(field.dataType), field.nullable, field.metadata)
        tag = tag_for(field)
        if tag is None or (keep_existing and tag_of(field)):
            return field
        return T.StructField(field.name, field.dataType, field.nullable, {**field.metadata, TAG_KEY: [tag]})

    return T.StructType([tagged(f) for f in schema.fields])


def tagged_columns(schema: T.StructType) -> list[tuple[str, list[str]]]:
    """Dotted names of tagged fields with their tags."""
    return [(path, tag_of(field)) for path, field in walk(schema) if tag_of(field)]


def maskable(paths: DataFrame, non_maskable: Sequence[str] = NON_MASKABLE) -> DataFrame:
    """Paths whose type can carry a masking tag."""
    return paths.filter(~F.col("data_type").isin(list(non_maskable)))


def needs_tagging(paths: DataFrame, raw_suffix: str = "_r", target_suffix: str = "_p") -> DataFrame:
    """Downstream tables whose raw table has any tagged field (``tagged`` flag per path)."""
    raw = paths.filter(F.col("table_name").endswith(raw_suffix))
    per_table = raw.groupBy("table_name").agg(F.bool_or("tagged").alias("has_tags"))
    base = F.regexp_replace("table_name", raw_suffix + "$", "")
    return per_table.filter("has_tags").select("table_name", F.concat(base, F.lit(target_suffix)).alias("target_table"))


