"""Column catalogs, tags, lineage, detection, masking and reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark import catalog, clean, detect, io, mask, report
from veilmark.operators import latest, textmatch
from veilmark.session import scratch_dir

from . import fixtures as fx
from .registry import query

# Tables that are profiled, with their columns and warehouse types.
PROFILED = {
    "customer": "c_custkey INT64, c_name STRING, c_nationkey INT64, c_acctbal FLOAT64, c_mktsegment STRING",
    "supplier": "s_suppkey INT64, s_name STRING, s_nationkey INT64, s_acctbal FLOAT64",
    "events": "event_id INT64, ts DATETIME, user_id INT64, event_type STRING, value FLOAT64, props STRING",
}
PROFILE_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS field_path, '{k}' AS data_type, count({c}) AS filled FROM {t}"
    for t, columns in PROFILED.items()
    for c, k in (item.split() for item in columns.split(", "))
)


@query("catalog_paths", PROFILE_SQL)
def catalog_paths(spark, sf):
    """Column paths of tables with the number of filled cells per column."""
    tables = {("shop", name): fx.table(spark, sf, name) for name in PROFILED}
    paths = catalog.column_paths(spark, tables)
    counted = None
    for (_, name), df in tables.items():
        one = df.agg(*[F.count(c).alias(c) for c in df.columns])
        cells = F.inline(F.array(*[F.struct(F.lit(c).alias("fp"), F.col(c).alias("filled")) for c in df.columns]))
        long = one.select(F.lit(name).alias("tn"), cells)
        counted = long if counted is None else counted.unionByName(long)
    joined = paths.join(counted, (F.col("tn") == F.col("table_name")) & (F.col("fp") == F.col("field_path")))
    return joined.select("table_name", "field_path", "data_type", "filled")


@query(
    "catalog_scan",
    """
SELECT table_schema, table_name, field_path, ordinal FROM part_columns WHERE (table_schema = 'ds0' AND table_name LIKE '%_r')
  OR table_schema = 'ds1' OR (table_schema = 'ds2' AND table_name NOT LIKE '%_p' AND table_name <> 'tblbrand1_r')""",
    "part_columns",
)
def catalog_scan(spark, sf):
    """Several datasets of one catalog, each under its own name condition."""
    name = F.col("table_name")
    rules = [
        ("ds0", name.like("%_r")),
        ("ds1", F.lit(True)),
        ("ds2", ~name.like("%_p") & (name != "tblbrand1_r")),
    ]
    return catalog.catalog_scan(fx.part_columns(spark, sf), rules).select(
        "table_schema", "table_name", "field_path", "ordinal"
    )


@query(
    "listing",
    """
SELECT DISTINCT table_name FROM part_columns
WHERE table_name LIKE '%\\_r' ESCAPE '\\' AND regexp_matches(table_name, 'brand1') AND table_name NOT IN ('tblbrand1_r')""",
    "part_columns",
)
def listing(spark, sf):
    """Table listing by suffix, pattern and exclusion."""
    tables = fx.part_columns(spark, sf).select("table_name").distinct()
    return io.list_tables(tables, suffix="_r", pattern="brand1", exclude=["tblbrand1_r"])


MATCH_KEY = "lower(replace(leaf, '_', ''))"


@query(
    "tag_match",
    f"""
SELECT c.table_schema, c.table_name, c.field_path, c.ordinal, t.display_name, contains(c.field_path, '.') AS is_nested,
  count(t.display_name) OVER (PARTITION BY c.table_schema, c.table_name, c.column_name) AS match_count
FROM part_columns c LEFT JOIN tag_list t ON {MATCH_KEY} = lower(replace(t.display_name, '_', ''))
WHERE NOT (c.table_name = 'tblbrand2_r' AND c.column_name = 'payload')""",
    "part_columns tag_list",
)
def tag_match(spark, sf):
    """Columns with their matching tags and match counts."""
    excluded = (F.col("table_name") == "tblbrand2_r") & (F.col("column_name") == "payload")
    rows = catalog.match(fx.part_columns(spark, sf), fx.tag_list(spark), exclude=excluded)
    return rows.select(
        "table_schema", "table_name", "field_path", "ordinal", "display_name", "is_nested", "match_count"
    )


@query(
    "name_join",
    f"""
SELECT c.ordinal, t.policy_tag_id FROM part_columns c JOIN tag_list t ON {MATCH_KEY} = lower(replace(display_name, '_', ''))""",
    "part_columns tag_list",
)
def name_join(spark, sf):
    """Equi-join on normalised names."""
    columns = fx.part_columns(spark, sf).select(F.col("ordinal").alias("o"), clean.path_name_key(F.col("field_path")).alias("key"))
    tags = fx.tag_list(spark).select("policy_tag_id", clean.name_key(F.col("display_name")).alias("tk"))
    return columns.join(tags, F.col("key") == F.col("tk")).select(F.col("o").alias("ordinal"), "policy_tag_id")


@query(
    "path_parent",
    """
SELECT table_schema, table_name, field_path, ordinal,
  CASE WHEN contains(field_path, '.') THEN 'payload' END AS parent_path,
  CASE WHEN contains(field_path, '.') THEN 'STRUCT<x STRING>' END AS parent_type
FROM part_columns UNION ALL SELECT DISTINCT table_schema, table_name, 'payload', -1, NULL, NULL FROM part_columns""",
    "part_columns",
)
def path_parent(spark, sf):
    """Parent path and type within the same table."""
    columns = fx.part_columns(spark, sf).select("table_schema", "table_name", "field_path", "data_type", "ordinal")
    structs = columns.select("table_schema", "table_name").distinct().select(
        "*",
        F.lit("payload").alias("field_path"),
        F.lit("STRUCT<x STRING>").alias("data_type"),
        F.lit(-1).cast("bigint").alias("ordinal"),
    )
    rows = catalog.with_parent_type(columns.unionByName(structs))
    return rows.select("table_schema", "table_name", "field_path", "ordinal", "parent_path", "parent_type")


KEY_SQL = """
SELECT table_schema, table_name, bool_or(leaf = 'ssn') AS has_ssn, bool_or(leaf = 'Email_Address') AS has_email,
  bool_or(leaf = 'mobile_phone') AS has_mobile, bool_or(leaf = 'loan_application_id') AS has_app_id
FROM part_columns GROUP BY 1, 2"""


@query("join_key_flags", KEY_SQL, "part_columns")
def join_key_flags(spark, sf):
    """Which keys does a table hold?"""
    matched = catalog.match(fx.part_columns(spark, sf), fx.tag_list(spark))
    return catalog.join_key_flags(matched)


@query(
    "join_keys",
    """
SELECT DISTINCT table_schema, table_name, field_path, CASE leaf WHEN 'ssn' THEN 'ssn' WHEN 'Email_Address' THEN 'email'
  WHEN 'mobile_phone' THEN 'mobile' ELSE 'app_id' END AS kind,
  CASE table_schema WHEN 'ds0' THEN 'SE' WHEN 'ds1' THEN 'FI' ELSE 'OTHER' END AS market
FROM part_columns WHERE leaf IN ('ssn', 'Email_Address', 'mobile_phone', 'loan_application_id')""",
    "part_columns",
)
def join_keys(spark, sf):
    """Columns usable as join keys, with the market of their dataset."""
    matched = catalog.match(fx.part_columns(spark, sf), fx.tag_list(spark))
    market = catalog.market_of(F.col("table_schema"), {"ds0": "SE", "ds1": "FI"})
    return catalog.join_keys(matched).withColumn("market", market)


PARENTS = ("small ring", "blue bolt", "red widget")


@query(
    "parent_child_join",
    """
WITH pairs AS (SELECT c.p_name AS child, p.p_name AS parent FROM part c JOIN part p ON c.p_partkey // 10 = p.p_partkey
    WHERE c.p_partkey > 0)
SELECT child AS display_name FROM pairs WHERE parent IN ('small ring', 'blue bolt', 'red widget')
UNION ALL (SELECT DISTINCT parent FROM pairs WHERE parent IN ('small ring', 'blue bolt') OR child = 'green nut')""",
)
def parent_child_join(spark, sf):
    """Sensitive tags: children of listed parents and the listed parents themselves."""
    p = F.col("p_partkey")
    tags = fx.table(spark, sf, "part").filter(p > 0).select(
        fx.text(p).alias("policy_tag_id"),
        F.col("p_name").alias("display_name"),
        fx.text(F.floor(p / 10)).alias("parent_policy_tag_id"),
    )
    root = fx.table(spark, sf, "part").filter(p == 0).select(
        F.lit("0").alias("policy_tag_id"),
        F.col("p_name").alias("display_name"),
        F.lit(None).cast("string").alias("parent_policy_tag_id"),
    )
    return catalog.pii_tags(tags.unionByName(root), None, PARENTS, PARENTS[:2], "green nut")


@query(
    "tag_assign",
    f"""
SELECT table_name, column_name, arg_min(t.policy_tag_id, t.ordinal) AS policy_tag_id
FROM part_columns c JOIN tag_list t ON lower(replace(column_name, '_', '')) = lower(replace(display_name, '_', ''))
WHERE data_type NOT IN ('INT64', 'BOOL') AND table_name <> 'tblbrand3_r' AND display_name <> 'blue_bolt'
GROUP BY 1, 2 HAVING NOT (table_name = 'tblbrand4_r' AND column_name = 'small_ring')
UNION ALL SELECT 'tblbrand4_r', 'small_ring', 'forced'""",
    "part_columns tag_list",
)
def tag_assign(spark, sf):
    """First matching tag per column with exclusions and forced exceptions."""
    forced = spark.createDataFrame(
        [("tblbrand4_r", "small_ring", "forced")], "table_name string, column_name string, policy_tag_id string"
    )
    return catalog.assign_tags(
        fx.part_columns(spark, sf),
        fx.tag_list(spark),
        exclude_tables=("tblbrand3_r",),
        exclude_tags=("blue_bolt",),
        exceptions=forced,
    )


SUBSTRING_SQL = """
SELECT c.ordinal, c.column_name, arg_max(t.policy_tag_id, t.ordinal) AS policy_tag_id
FROM part_columns c JOIN tag_list t ON contains(lower(c.column_name), lower(t.display_name))
WHERE c.data_type <> 'BOOL' GROUP BY 1, 2"""


@query("tag_substring", SUBSTRING_SQL, "part_columns tag_list")
def tag_substring(spark, sf):
    """Tag whose name occurs inside the column name; the last one wins."""
    rows = catalog.match(fx.part_columns(spark, sf), fx.tag_list(spark), mode="substring")
    return rows.select("ordinal", "column_name", "policy_tag_id")


@query(
    "substring_pairs",
    """
SELECT DISTINCT a.column_name AS name, b.p_name AS word FROM part_columns a JOIN (SELECT DISTINCT split_part(p_name, ' ', 2)
  || (p_partkey % 7) AS p_name FROM part) b ON contains(a.column_name, b.p_name)""",
    "part_columns",
)
def substring_pairs(spark, sf):
    """Containment against a larger vocabulary."""
    names = fx.part_columns(spark, sf).select(F.col("column_name").alias("name"))
    second = F.split("p_name", " ").getItem(1)
    words = fx.table(spark, sf, "part").select(F.concat(second, fx.text(F.col("p_partkey") % 7)).alias("word"))
    return textmatch.containment(names, words)


@query(
    "maskable_types",
    """
SELECT table_name, count(*) AS columns FROM part_columns WHERE data_type NOT IN ('NUMERIC', 'BOOL', 'INT64', 'FLOAT64')
GROUP BY 1""",
    "part_columns",
)
def maskable_types(spark, sf):
    """Columns whose type can be masked."""
    return catalog.maskable(fx.part_columns(spark, sf)).groupBy("table_name").agg(F.count(F.lit(1)).alias("columns"))


@query(
    "needs_tagging",
    """
SELECT table_name, regexp_replace(table_name, '_r$', '') || '_p' AS target_table FROM part_columns
WHERE table_name LIKE '%\\_r' ESCAPE '\\' GROUP BY table_name HAVING bool_or(leaf = 'ssn')""",
    "part_columns",
)
def needs_tagging(spark, sf):
    """Downstream tables of raw tables with any tagged field."""
    columns = fx.part_columns(spark, sf)
    return catalog.needs_tagging(columns.withColumn("tagged", F.col("leaf") == "ssn"))


@query(
    "tag_flatten",
    """
SELECT 'lines.partkey' AS field, 'tag-part' AS tag, count(*) AS filled FROM order_lines
UNION ALL SELECT 'o_orderpriority', 'tag-priority', count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_totalprice', 'tag-price', count(o_totalprice) FROM orders""",
    "order_lines",
)
def tag_flatten(spark, sf):
    """Tags on a nested schema, flattened, with the number of filled cells."""
    rows = fx.nested_orders(spark, sf)
    tags = {"partkey": "tag-part", "oorderpriority": "tag-priority", "ototalprice": "tag-price"}
    tagged = catalog.tagged_columns(catalog.apply_tags(rows.schema, tags))

    def filled(path):
        if path.startswith("lines."):
            inner = F.filter("lines", lambda e: e.getField(path.split(".")[1]).isNotNull())
            return F.sum(F.size(F.coalesce(inner, F.array()))).cast("bigint")
        return F.count(path)

    cells = [filled(p).alias(f"n{i}") for i, (p, _) in enumerate(tagged)]
    shown = [
        F.struct(F.lit(p).alias("field"), F.lit(t[0]).alias("tag"), F.col(f"n{i}").alias("filled"))
        for i, (p, t) in enumerate(tagged)
    ]
    return rows.agg(*cells).select(F.inline(F.array(*shown)))


@query(
    "tag_branches",
    """
SELECT unnest([{'field': 'ssn', 'tag': 'tag-id', 'filled': count(c_custkey)},
  {'field': 'national_id', 'tag': 'tag-national', 'filled': count(c_custkey)},
  {'field': 'person.valid_national_id', 'tag': 'tag-valid', 'filled': count(c_custkey)},
  {'field': 'person.phone_number', 'tag': 'tag-phone', 'filled': count(c_custkey)},
  {'field': 'phone_number', 'tag': 'tag-text', 'filled': count(c_custkey)},
  {'field': 'name', 'tag': 'tag-old', 'filled': count(c_name)},
  {'field': 'segment', 'tag': 'tag-new', 'filled': count(c_mktsegment)}], recursive := true) FROM customer
UNION ALL SELECT 'name, replaced', 'tag-new', 1""",
)
def tag_branches(spark, sf):
    """Ids and phones that are no text take their own tags; an existing tag is kept or replaced."""
    k = F.col("c_custkey")
    rows = fx.table(spark, sf, "customer").select(
        k.alias("ssn"),
        fx.text(k).alias("national_id"),
        F.struct((k > 0).alias("valid_national_id"), k.alias("phone_number")).alias("person"),
        fx.text(k).alias("phone_number"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    tags = {"nationalid": "tag-national", "validnationalid": "tag-valid", "phonenumber": "tag-text"}
    schema = catalog.apply_tags(rows.select("name").schema, {"name": "tag-old"})
    old = T.StructType([schema[f.name] if f.name == "name" else f for f in rows.schema.fields])
    tags |= {"ssn": "tag-ssn", "name": "tag-new", "segment": "tag-new"}
    branches = {"id_tag": "tag-id", "phone_tag": "tag-phone"}
    kept = catalog.tagged_columns(catalog.apply_tags(old, tags, keep_existing=True, **branches))
    replaced = dict(catalog.tagged_columns(catalog.apply_tags(old, tags, **branches)))
    cells = [F.struct(F.lit(p).alias("field"), F.lit(t[0]).alias("tag"), F.count(p).alias("filled")) for p, t in kept]
    again = F.struct(F.lit("name, replaced").alias("field"), F.lit(replaced["name"][0]).alias("tag"), F.lit(1).cast("bigint").alias("filled"))
    return rows.agg(F.array(*cells, again).alias("cells")).select(F.inline("cells"))


# ---------------------------------------------------------------- lineage


@query("lineage_edges", "SELECT model, target_column, source_model, source_column, data_type FROM edges", "edges")
def lineage_edges(spark, sf):
    """Column lineage from select lists, stars and raw models."""
    return detect.lineage_edges(*fx.lineage_inputs(spark, sf))


@query(
    "lineage_components",
    """
SELECT c AS node, c AS component FROM model_columns UNION ALL SELECT 'x' || pk, c FROM model_columns
WHERE pk % 2 = 0 AND pk % 10 <> 3 UNION ALL SELECT 'id', 'id'""",
    "model_columns",
)
def lineage_components(spark, sf):
    """Names connected through lineage."""
    return detect.components(detect.name_graph(detect.lineage_edges(*fx.lineage_inputs(spark, sf))))


@query(
    "chain_components",
    """
SELECT o_orderkey AS node, CASE WHEN (o_orderkey // 50) % 3 = 0 THEN -1 ELSE o_orderkey - o_orderkey % 50 END AS component
FROM orders UNION ALL SELECT -1, -1""",
)
def chain_components(spark, sf):
    """Long chains, a third of which hang on one hub."""
    o = F.col("o_orderkey")
    orders = fx.table(spark, sf, "orders").select(o)
    chain = orders.filter(o % 50 != 0).select(o.alias("src"), (o - 1).alias("dst"))
    hub = orders.filter((o % 50 == 0) & (F.floor(o / 50) % 3 == 0)).select(o.alias("src"), F.lit(-1).cast("bigint").alias("dst"))
    return detect.components(chain.unionByName(hub))


@query(
    "extended_components",
    """
SELECT o_orderkey AS node, CASE WHEN (o_orderkey // 50) % 3 = 0 THEN -1 ELSE o_orderkey - o_orderkey % 50 END AS component
FROM orders UNION ALL SELECT -1, -1""",
)
def extended_components(spark, sf):
    """The same components in two days: chains cut in pieces of ten are stored, the links between them and the hub come later."""
    o = F.col("o_orderkey")
    orders = fx.table(spark, sf, "orders").select(o)
    chain = orders.filter(o % 50 != 0).select(o.alias("src"), (o - 1).alias("dst"))
    hub = orders.filter((o % 50 == 0) & (F.floor(o / 50) % 3 == 0)).select(o.alias("src"), F.lit(-1).cast("bigint").alias("dst"))
    path = scratch_dir(spark, "components")
    detect.components(chain.filter(F.col("src") % 10 != 0)).write.parquet(path)
    return detect.extend_components(spark.read.parquet(path), chain.filter(F.col("src") % 10 == 0).unionByName(hub))


GROUPS_SQL = """
SELECT DISTINCT seed, column_name FROM (
  SELECT 'c' || pk AS seed, 'c' || pk AS column_name FROM seeds
  UNION ALL SELECT 'c' || pk, 'x' || pk FROM seeds WHERE pk % 2 = 0 AND pk % 10 <> 3
  UNION ALL SELECT 'c' || s.pk, n.name FROM seeds s JOIN (SELECT c AS name FROM model_columns
    UNION SELECT 'x' || pk FROM model_columns WHERE pk % 2 = 0 AND pk % 10 <> 3 UNION SELECT 'id') n
    ON contains(n.name, 'c' || s.pk) OR (s.pk % 2 = 0 AND s.pk % 10 <> 3 AND contains(n.name, 'x' || s.pk)))"""


@query(
    "keyword_groups",
    "WITH seeds AS (SELECT pk FROM model_columns)" + GROUPS_SQL,
    "model_columns",
)
def keyword_groups(spark, sf):
    """Connected names of every column, widened by every name that contains one of them."""
    stored = scratch_dir(spark, "lineage")
    detect.lineage_edges(*fx.lineage_inputs(spark, sf)).write.parquet(stored)
    edges = spark.read.parquet(stored)
    parts = detect.components(detect.name_graph(edges))
    seeds = fx.model_columns(spark, sf).select(
        F.col("c").alias("column_name"), F.col("pk").alias("ordinal")
    )
    groups = detect.reachable(parts, seeds)
    names = report.lineage_names(edges)
    return detect.keyword_groups(groups, names).select("seed", "column_name").distinct()


# -------------------------------------------------------------- detection

DETECT_NAME = """CASE p_partkey % 11 WHEN 0 THEN 'num_' || p_partkey WHEN 1 THEN 'x_hashed_' || p_partkey
  WHEN 2 THEN 'email_' || p_partkey WHEN 3 THEN 'employer_' || p_partkey WHEN 4 THEN 'education_' || p_partkey
  WHEN 5 THEN 'First_Name_' || p_partkey WHEN 6 THEN 'is_pep' || CASE WHEN p_size % 2 = 0 THEN '' ELSE '_x' END
  ELSE replace(p_name, ' ', '_') || p_partkey END"""
DETECT_TYPE = """CASE p_size % 6 WHEN 0 THEN 'STRING' WHEN 1 THEN 'INT64' WHEN 2 THEN 'BOOL' WHEN 3 THEN 'TIMESTAMP'
  WHEN 4 THEN 'STRUCT<flagged STRING, other INT64>' ELSE 'ARRAY<STRUCT<other INT64>>' END"""


def detect_columns(spark, sf):
    p, size = F.col("p_partkey"), F.col("p_size")
    number = fx.text(p)
    heads = ["num_", "x_hashed_", "email_", "employer_", "education_", "First_Name_"]
    name = F
    for i, head in enumerate(heads):
        name = name.when(p % 11 == i, F.concat(F.lit(head), number))
    name = name.when(p % 11 == 6, F.concat(F.lit("is_pep"), F.when(size % 2 == 0, "").otherwise("_x")))
    name = name.otherwise(F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), number))
    kinds = ["STRING", "INT64", "BOOL", "TIMESTAMP", "STRUCT<flagged STRING, other INT64>"]
    kind = F
    for i, value in enumerate(kinds):
        kind = kind.when(size % 6 == i, F.lit(value))
    return fx.table(spark, sf, "part").select(
        p.alias("pk"), name.alias("column_name"), kind.otherwise("ARRAY<STRUCT<other INT64>>").alias("data_type")
    )


@query(
    "classify_columns",
    f"""
WITH c AS (SELECT p_partkey AS pk, {DETECT_NAME} AS column_name, {DETECT_TYPE} AS data_type FROM part)
SELECT pk, column_name, data_type,
  CASE WHEN regexp_matches(lower(column_name), 'ssn|email|phone|national_|name|etunimi|address|bank_account_number')
    THEN 'high' ELSE 'medium' END AS sensitivity,
  CASE WHEN regexp_matches(lower(column_name),
    'ssn|email|phone|national_|name|etunimi|address|bank_account_number|json_col|business_id|employer|post_code')
    THEN 'PII' ELSE 'restricted' END AS category,
  CASE WHEN data_type = 'INT64' THEN 'ALWAYS_NULL' WHEN regexp_matches(lower(column_name),
    'ssn|email|phone|national_|name|etunimi|address|bank_account_number') THEN 'SHA256' ELSE 'DEFAULT_MASKING_VALUE' END
    AS masking_rule
FROM c WHERE NOT starts_with(lower(column_name), 'num_') AND NOT contains(lower(column_name), 'hashed_')
  AND (lower(column_name) = 'is_pep' OR NOT (data_type IN ('BOOL', 'TIMESTAMP') OR starts_with(data_type, 'STRUCT')))
  AND NOT (pk % 13 = 0 AND NOT starts_with(column_name, 'is_pep'))""",
)
def classify_columns(spark, sf):
    """Exclusion rules, then sensitivity, category and masking rule."""
    columns = detect_columns(spark, sf)
    types = spark.createDataFrame([("flagged", "bool"), ("other", "INT64")], "key string, data_type string")
    listed = columns.filter("pk % 13 = 0").select("column_name")
    # 'is_pep' is shared by many columns and must not be excluded by name.
    listed = listed.filter(~F.col("column_name").startswith("is_pep"))
    rows = detect.classify(detect.exclude(columns, types, listed))
    return rows.select("pk", "column_name", "data_type", "sensitivity", "category", "masking_rule")


@query(
    "classify_mask",
    """
SELECT c_custkey, sha256(c_name) AS c_name, NULL::INT AS c_nationkey, NULL::DOUBLE AS c_acctbal, '' AS c_mktsegment
FROM customer""",
)
def classify_mask(spark, sf):
    """Rules classified from the schema and applied to the whole table."""
    customers = fx.table(spark, sf, "customer")
    paths = catalog.column_paths(spark, {"customer": customers}).filter("column_name <> 'c_custkey'")
    rules = mask.rules_of(detect.classify(paths.select("column_name", "data_type")).collect())
    return mask.apply(customers, rules)


TREE_SQL = """
WITH g AS (SELECT DISTINCT 's' || (p_size % 8) AS seed, p_size % 8 AS ordinal,
    replace(p_name, ' ', '_') || CASE WHEN p_partkey % 3 = 0 THEN '_email' ELSE '' END || (p_partkey % 40) AS column_name
    FROM part),
  lone AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 40 = 9),
  claimed AS (SELECT column_name, min(ordinal) AS ordinal FROM g GROUP BY 1),
  parents AS (SELECT ordinal, min(column_name) AS parent FROM claimed GROUP BY 1)
SELECT 's' || c.ordinal AS seed, parent, column_name AS child,
  CASE WHEN contains(parent, 'email') THEN 'high' ELSE 'medium' END AS sensitivity,
  CASE WHEN contains(column_name, 'email') THEN 'SHA256' ELSE 'DEFAULT_MASKING_VALUE' END AS child_masking_rule
FROM claimed c JOIN parents USING (ordinal) WHERE column_name <> parent
UNION ALL SELECT 't' || k, 'lone_email_' || k, NULL, 'high', NULL FROM lone"""


def name_groups(spark, sf):
    """Column names of every part, in eight groups."""
    p = F.col("p_partkey")
    tail = F.when(p % 3 == 0, F.lit("_email")).otherwise(F.lit(""))
    name = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), tail, fx.text(p % 40))
    group = F.col("p_size") % 8
    parts = fx.table(spark, sf, "part")
    return parts.select(
        F.concat(F.lit("s"), fx.text(group)).alias("seed"), group.cast("bigint").alias("ordinal"), name.alias("column_name")
    ).distinct()


def tree_groups(spark, sf):
    p = F.col("p_partkey")
    # Groups of one column: parents without children.
    lone = fx.table(spark, sf, "part").filter(p % 40 == 9).select(
        F.concat(F.lit("t"), fx.text(p)).alias("seed"),
        (p + 100).cast("bigint").alias("ordinal"),
        F.concat(F.lit("lone_email_"), fx.text(p)).alias("column_name"),
    )
    return name_groups(spark, sf).unionByName(lone)


def tag_rows(spark, sf):
    types = spark.createDataFrame([("none", "STRING")], "key string, data_type string")
    return detect.tag_tree(tree_groups(spark, sf), types)


@query("tag_tree", TREE_SQL)
def tag_tree(spark, sf):
    """First claim of every column; parents and their children."""
    return tag_rows(spark, sf).select(
        "seed", "parent", "child", "sensitivity", "child_masking_rule"
    )


@query(
    "parent_promotion",
    "SELECT sensitivity, coalesce(promoted, parent) AS parent, CASE WHEN child = promoted THEN parent ELSE child END AS child\n"
    "FROM (SELECT *, min(CASE WHEN child IN ('blue_bolt1', 'red_widget2', 'small_ring4') THEN child END)\n"
    "  OVER (PARTITION BY sensitivity, parent) AS promoted FROM (" + TREE_SQL + "))",
)
def parent_promotion(spark, sf):
    """Canonical children become parents."""
    tree = tag_rows(spark, sf)
    return detect.promote_parents(tree, ("blue_bolt1", "red_widget2", "small_ring4")).select(
        "sensitivity", "parent", "child"
    )


# ------------------------------------------------------- trees and masking


@query(
    "tag_tree_flatten",
    "SELECT s_suppkey, level, category, parent, child, masking_rule, parent_masking_rule FROM tree_rows",
    "tree_rows",
)
def tag_tree_flatten(spark, sf):
    """Tag trees in JSON to one row per child."""
    return mask.flatten_tree(fx.tag_trees(spark, sf)).select(
        "s_suppkey", "level", "category", "parent", "child", "masking_rule", "parent_masking_rule"
    )


@query(
    "tag_counts",
    """
SELECT 'high' AS level, 2 AS categories, (SELECT count(*) FROM supplier) AS parents, count(*) AS children,
  2 + (SELECT count(*) FROM supplier) + count(*) AS total FROM tree_rows WHERE level = 'high'
UNION ALL SELECT 'medium', 1, (SELECT count(*) FROM supplier), count(*), 1 + (SELECT count(*) FROM supplier) + count(*)
  FROM tree_rows WHERE level = 'medium'
UNION ALL SELECT 'low', 0, 0, 0, 0""",
    "tree_rows",
)
def tag_counts(spark, sf):
    """Categories, parents and children per level, empty ones included."""
    return report.tag_counts(mask.flatten_tree(fx.tag_trees(spark, sf), keep_empty=True))


@query(
    "sha256_rules",
    """
SELECT DISTINCT level, category, parent AS field_name FROM tree_rows WHERE parent_masking_rule = 'SHA256'
UNION SELECT level, category, child FROM tree_rows WHERE masking_rule = 'SHA256'
UNION SELECT 'high', 'PII', 'p' || s_suppkey FROM supplier""",
    "tree_rows",
)
def sha256_rules(spark, sf):
    """Fields that are hashed."""
    return mask.sha256_rules(mask.flatten_tree(fx.tag_trees(spark, sf), keep_empty=True))


@query(
    "masking_lookup",
    """
SELECT level, display_name, coalesce(rule, CASE level WHEN 'high' THEN 'SHA256' ELSE 'DEFAULT_MASKING_VALUE' END)
  AS masking_rule
FROM (SELECT level, 'c' || s_suppkey || '_' || i AS display_name FROM supplier, (VALUES ('high'), ('low')) l(level),
    (VALUES (1), (2)) t(i))
LEFT JOIN (SELECT level, child AS display_name, masking_rule AS rule FROM tree_rows) USING (level, display_name)""",
    "tree_rows",
)
def masking_lookup(spark, sf):
    """Rule per created tag, by child name or level default."""
    s = fx.text(F.col("s_suppkey"))
    names = F.array(*[F.concat(F.lit("c"), s, F.lit(f"_{i}")) for i in (1, 2)])
    tags = fx.table(spark, sf, "supplier").select(F.explode(names).alias("display_name")).withColumn(
        "level", F.explode(F.array(F.lit("high"), F.lit("low")))
    )
    return mask.rules_with_default(tags, mask.flatten_tree(fx.tag_trees(spark, sf)))


# ---------------------------------------------------------------- reports


@query(
    "snapshot_diff",
    """
WITH b AS (SELECT c_custkey AS k, c_name, c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 17 <> 0),
  a AS (SELECT c_custkey AS k, c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END::VARCHAR AS c_acctbal,
    c_nationkey::VARCHAR AS c_nationkey FROM customer WHERE c_custkey % 11 <> 0),
  j AS (SELECT coalesce(b.k, a.k) AS k, b.k IS NOT NULL AS hb, a.k IS NOT NULL AS ha, b.c_name AS bn, a.c_name AS an,
    b.c_acctbal AS bb, a.c_acctbal AS ab, b.c_mktsegment AS bs, a.c_nationkey AS ac FROM b FULL JOIN a ON a.k = b.k),
  r AS (SELECT k, 'c_name' AS field, CASE WHEN hb THEN bn ELSE 'N/A' END AS before, CASE WHEN ha THEN an ELSE 'N/A' END
      AS after FROM j
    UNION ALL SELECT k, 'c_acctbal', CASE WHEN hb THEN bb ELSE 'N/A' END, CASE WHEN ha THEN ab ELSE 'N/A' END FROM j
    UNION ALL SELECT k, 'c_mktsegment', bs, 'N/A' FROM j WHERE hb
    UNION ALL SELECT k, 'c_nationkey', 'N/A', ac FROM j WHERE ha)
SELECT *, CASE WHEN before IS NOT DISTINCT FROM after THEN 'No Change' ELSE 'Changed' END AS comparison FROM r""",
)
def snapshot_diff(spark, sf):
    """Field-level comparison of two snapshots."""
    customers = fx.table(spark, sf, "customer").withColumnRenamed("c_custkey", "k")
    k = F.col("k")
    before = customers.filter(k % 17 != 0).select("k", "c_name", "c_acctbal", "c_mktsegment")
    after = customers.filter(k % 11 != 0).select(
        "k", "c_name", F.when(k % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_nationkey"
    )
    return report.snapshot_diff(before, after, ["k"])


@query(
    "conformance",
    """
SELECT table_schema, table_name, CASE WHEN count(*) % 3 = 0 THEN 'retained' ELSE 'other' END AS tag,
  CASE WHEN table_name LIKE '%1%' THEN 'retained' END AS expected,
  CASE WHEN count(*) % 3 = 0 AND table_name LIKE '%1%' THEN 'Yes' ELSE 'No' END AS match
FROM part_columns GROUP BY 1, 2""",
    "part_columns",
)
def conformance(spark, sf):
    """Does every table carry the expected tag?  A declared list names only some of them."""
    sizes = fx.part_columns(spark, sf).groupBy("table_schema", "table_name").agg(F.count(F.lit(1)).alias("n"))
    tag = F.when(F.col("n") % 3 == 0, F.lit("retained")).otherwise(F.lit("other"))
    actual = sizes.select("table_schema", "table_name", tag.alias("tag"))
    listed = fx.part_columns(spark, sf).filter(F.col("table_name").contains("1"))
    expected = listed.select("table_schema", "table_name", F.lit("retained").alias("tag")).distinct()
    return report.conformance(actual, expected, ["table_schema", "table_name"], "tag")


@query(
    "edge_cases",
    f"""
SELECT ordinal, field_path, data_type FROM part_columns c WHERE data_type <> 'STRING'
  AND {MATCH_KEY} IN (SELECT lower(replace(display_name, '_', '')) FROM tag_list)""",
    "part_columns tag_list",
)
def edge_cases(spark, sf):
    """Sensitive names whose type is not text."""
    tags = fx.tag_list(spark).select(F.col("display_name").alias("field_name"))
    return report.edge_cases(fx.part_columns(spark, sf), tags).select("ordinal", "field_path", "data_type")


@query(
    "source_usage",
    """
WITH uses AS (SELECT s_name AS model, 'cat' AS table_catalog, 'ds' || (s_suppkey % 3) AS table_schema FROM supplier
    UNION SELECT s_name, 'cat', 'ds' || ((s_suppkey + 1) % 3) FROM supplier WHERE s_suppkey % 2 = 0
    UNION SELECT s_name, 'cat', 'ds2' FROM supplier WHERE s_suppkey % 5 = 0),
  tables AS (SELECT DISTINCT table_schema, table_name FROM part_columns),
  ids AS (SELECT table_schema, table_name, string_agg(DISTINCT field_path, ', ' ORDER BY field_path) AS id_columns
    FROM part_columns WHERE leaf = 'ssn' GROUP BY 1, 2)
SELECT t.table_schema, t.table_name, 'cat' AS table_catalog, string_agg(DISTINCT model, ', ' ORDER BY model) AS models,
  coalesce(any_value(id_columns), 'None') AS id_columns
FROM tables t JOIN uses u ON u.table_schema = t.table_schema
LEFT JOIN ids i ON i.table_schema = t.table_schema AND i.table_name = t.table_name GROUP BY 1, 2""",
    "part_columns",
)
def source_usage(spark, sf):
    """Models reading a table and the id columns it holds."""
    s = F.col("s_suppkey")

    def call(k):
        return F.concat(F.lit("{{source('cat', 'ds"), fx.text(k % 3), F.lit("')}}"))

    code = F.concat(
        F.lit("select * from "), call(s), F.when(s % 2 == 0, F.concat(F.lit(" join "), call(s + 1))).otherwise("")
    )
    declared = F.struct(F.lit("cat").alias("table_catalog"), F.lit("ds2").alias("table_schema"))
    models = fx.table(spark, sf, "supplier").select(
        F.col("s_name").alias("model"),
        code.alias("raw_code"),
        F.when(s % 5 == 0, F.array(declared)).alias("sources"),
    )
    paths = fx.part_columns(spark, sf)
    tables = paths.select("table_schema", "table_name").distinct().withColumn("table_catalog", F.lit("cat"))
    return report.source_usage(models, tables, paths)


@query(
    "tag_groups",
    """
SELECT 'gdpr_' || lower(p_brand) || '_tag' AS tag_group, p_brand || ',' || string_agg(p_name, ',' ORDER BY first, p_name)
  AS columns
FROM (SELECT p_brand, p_name, min(p_partkey) AS first FROM part GROUP BY 1, 2) GROUP BY p_brand""",
)
def tag_groups(spark, sf):
    """Parents with their children as tag groups."""
    rows = fx.table(spark, sf, "part").groupBy(F.col("p_brand").alias("parent"), F.col("p_name").alias("child")).agg(
        F.min("p_partkey").alias("child_pos")
    )
    return report.tag_groups(rows).withColumn("columns", F.array_join("columns", ","))


@query("resource_id", "SELECT page_id, list_extract(string_split(url, '/'), -1) AS resource FROM pages")
def resource_id(spark, sf):
    """Last segment of a resource path."""
    return fx.table(spark, sf, "pages").select("page_id", clean.last_segment(F.col("url")).alias("resource"))


@query(
    "distinct_names",
    """
SELECT seed, string_agg(column_name, '|' ORDER BY column_name) AS names FROM (SELECT DISTINCT 's' || (p_size % 8) AS seed,
  replace(p_name, ' ', '_') || CASE WHEN p_partkey % 3 = 0 THEN '_email' ELSE '' END || (p_partkey % 40) AS column_name
  FROM part) GROUP BY seed""",
)
def distinct_names(spark, sf):
    """Sorted distinct names of a group."""
    return latest.distinct_list(name_groups(spark, sf), ["seed"], "column_name", "names", "|")
