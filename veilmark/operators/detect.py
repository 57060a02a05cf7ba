"""Sensitive-column detection: lineage, connected names, grouping, classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import latest, textmatch
from .joins import lookup_join

# Classification keywords, first hit wins in this order.
HIGH_PII = ("ssn", "email", "phone", "national_", "name", "etunimi", "address", "bank_account_number")
MEDIUM_PII = ("json_col", "business_id", "employer", "post_code")
# Kept although boolean; types that are dropped; name prefixes that are dropped.
ALWAYS_KEEP = ("is_pep", "birth_date", "politicallyexposedperson", "is_politically_exposed", "politically_exposed")
DROPPED_TYPES = ("bool", "boolean", "timestamp")
# Canonical parents of the tag tree.
CANONICAL = (
    "ssn",
    "first_name",
    "last_name",
    "email",
    "phone",
    "bank_account_number",
    "dob",
    "amount",
    "business_id",
    "citizenship",
    "employer",
    "gross_income",
    "post_code",
    "profession",
    "address",
    "education",
    "marital_status",
    "business_organization_number",
)
ALWAYS_NULL, SHA256, DEFAULT_MASK = "ALWAYS_NULL", "SHA256", "DEFAULT_MASKING_VALUE"


def bare(column: Column) -> Column:
    """Last path segment in lower case."""
    return F.lower(F.substring_index(column, ".", -1))


# ---------------------------------------------------------------- lineage


def lineage_edges(models: DataFrame, columns: DataFrame) -> DataFrame:
    """Column lineage ``(model, target_column, source_model, source_column, data_type)``.

    ``models`` has ``model, resource_type, sql, depends_on``; ``columns`` has
    ``model, column_name, data_type``.  A select list is read as plain names and
    ``a AS b`` pairs; the last item wins for a repeated alias and the last
    dependency wins when several offer the column.  Raw and source models map
    every column to itself.
    """
    # The forms of a select list that a lineage is read from.
    is_star = F.col("sql").rlike(r"(?is)SELECT\s+\*\s+FROM")
    select_list = F.regexp_extract("sql", r"(?is)SELECT\s+(.*?)\s+FROM", 1)
    derived = models.filter((F.col("resource_type") == "model") & F.col("sql").isNotNull())

    item = F.regexp_replace("item", r"^\s+|\s+$", "")
    pair = r"(?i)^(\w+)\s+AS\s+(\w+)"
    listed = (
        derived.filter(~is_star)
        .select("model", F.posexplode(F.split(select_list, ",")).alias("pos", "item"))
        .filter(item != "")
        .select(
            "model",
            "pos",
            F.when(item.rlike(pair), F.regexp_extract(item, pair, 2)).otherwise(item).alias("target_column"),
            F.when(item.rlike(pair), F.regexp_extract(item, pair, 1)).otherwise(item).alias("original"),
        )
    )
    chosen = latest.last_match(listed, ["model", "target_column"], "pos").drop("pos")
    star_models = derived.filter(is_star).select("model").distinct()
    starred = columns.join(star_models, "model", "left_semi").select(
        "model", F.col("column_name").alias("target_column"), F.col("column_name").alias("original")
    )
    mappings = chosen.unionByName(starred)

    upstream = derived.select("model", F.posexplode("depends_on").alias("dep_pos", "source_model"))
    offered = columns.select(
        F.col("model").alias("source_model"), F.col("column_name").alias("original"), "data_type"
    )
    candidates = mappings.join(upstream, "model").join(offered, ["source_model", "original"])
    derived_edges = (
        latest.last_match(candidates, ["model", "target_column"], "dep_pos")
        .withColumn("priority", F.lit(1))
        .select(
            "model", "target_column", "source_model", F.col("original").alias("source_column"), "data_type", "priority"
        )
    )

    declared_sources = models.filter(F.col("resource_type") == "source").select("model").distinct()
    by_name = columns.filter(F.col("model").endswith("_r") | F.col("model").startswith("source."))
    by_type = columns.join(declared_sources, "model", "left_semi")
    own = (
        by_name.unionByName(by_type)
        .distinct()
        .select(
            "model",
            F.col("column_name").alias("target_column"),
            F.col("model").alias("source_model"),
            F.col("column_name").alias("source_column"),
            "data_type",
            F.lit(0).alias("priority"),
        )
    )
    return latest.last_match(derived_edges.unionByName(own), ["model", "target_column"], "priority").drop("priority")


def name_graph(edges: DataFrame) -> DataFrame:
    """Undirected graph over bare names, one row ``(src, dst)`` per direction."""
    one_way = edges.select(bare(F.col("target_column")).alias("src"), bare(F.col("source_column")).alias("dst"))
    return one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def _stars(edges: DataFrame, large: bool, hot_share: float | None) -> DataFrame:
    """One star round: re-hang neighbours on the smallest node around each centre.

    The larger end of an edge is its ``src``, before and after.  So the smallest node around a centre is its least
    ``dst``, or itself without one, and no edge has to be read in both directions.
    """
    smallest = edges.groupBy(F.col("src").alias("centre")).agg(F.min("dst").alias("low"))
    if large:
        # The larger neighbours of a centre move; the number of edges stays.
        joined = lookup_join(edges, smallest, [("dst", "centre")], hot_share=hot_share)
        return joined.select("src", F.coalesce("low", "dst").alias("dst"))
    # The smaller neighbours and the centre itself move; repeats go once per round, here.
    joined = lookup_join(edges, smallest, [("src", "centre")], hot_share=hot_share)
    neighbours = joined.filter(F.col("dst") != F.col("low")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return neighbours.unionByName(smallest.select(F.col("centre").alias("src"), F.col("low").alias("dst"))).distinct()


def components(edges: DataFrame, hot_share: float | None = None) -> DataFrame:
    """Connected components ``(node, component)``; the component is its smallest node.

    Alternating star contraction: every round costs two aggregations with
    map-side combine and two joins, and the number of rounds grows with the
    logarithm of the graph, not with its diameter.  Each round is checkpointed
    to the shared folder, so a lost executor repeats one round at most.  Stars
    pile up on the smallest nodes by design: the adaptive skew join splits such
    hubs at run time, and ``hot_share`` salts them beforehand.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    plain = edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    nodes = plain.select(F.col("src").alias("node")).unionByName(plain.select(F.col("dst").alias("node"))).distinct()
    current = (
        plain.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
        .checkpoint()
    )

    def fingerprint(df: DataFrame) -> tuple:
        hashed = F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        return tuple(df.agg(F.count(F.lit(1)), hashed).first())

    seen = fingerprint(current)
    while True:
        current = _stars(_stars(current, True, hot_share), False, hot_share).checkpoint()
        now = fingerprint(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def extend_components(stored: DataFrame, edges: DataFrame, hot_share: float | None = None) -> DataFrame:
    """Components after adding ``edges`` to a stored result ``(node, component)``; equal to a run over all edges.

    New edges are contracted first: each end becomes its stored component, a new node stays itself.  The star rounds
    run on these few edges only and their number grows with the logarithm of the contracted graph, however large or
    deep the stored one is.  The stored table is read twice, once to look up the ends and once to rename components
    that merged; a giant component is one key of the second join, which ``hot_share`` salts.
    Edges with a NULL end are ignored; an empty ``edges`` returns the stored rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    plain = edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()
    ends = plain.select(F.col("src").alias("end")).unionByName(plain.select(F.col("dst").alias("end"))).distinct()
    known = stored.select("node", F.col("component").alias("own"))
    # Written, since three later plans read it.
    placed = ends.join(known, ends["end"] == known["node"], "left").select(
        "end", F.coalesce("own", "end").alias("own"), F.col("own").isNull().alias("fresh")
    )
    placed = placed.checkpoint()

    def contract(df: DataFrame, column: str) -> DataFrame:
        return lookup_join(df, placed.select("end", F.col("own").alias(f"__{column}")), [(F.col(column), "end")], hot_share)

    contracted = contract(contract(plain, "src"), "dst").select(F.col("__src").alias("src"), F.col("__dst").alias("dst"))
    merged = components(contracted.distinct(), hot_share).select("node", F.col("component").alias("__into")).checkpoint()
    rows = stored.select("node", "component").unionByName(
        placed.filter("fresh").select(F.col("end").alias("node"), F.col("own").alias("component"))
    )
    renamed = lookup_join(rows, merged, [(F.col("component"), "node")], hot_share)
    return renamed.select("node", F.coalesce("__into", "component").alias("component"))


def seed_components(component_rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(seed, ordinal, component)``: where each seed column lies; its names are the members of that component.

    With the component table this is all that ``reachable`` says, in one row per seed.
    ``seeds`` has ``column_name, ordinal``.  A seed that is not in the graph is an error, as it points to a misspelt
    column.
    """
    wanted = seeds.select(F.col("column_name").alias("seed"), "ordinal", bare(F.col("column_name")).alias("node"))
    unknown = wanted.join(component_rows, "node", "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"columns not in the lineage graph: {sorted(r.seed for r in unknown)}")
    return wanted.join(component_rows, "node").select("seed", "ordinal", "component")


def reachable(component_rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(seed, ordinal, column_name)``: every name connected to each seed column (see ``seed_components``)."""
    members = component_rows.select("component", F.col("node").alias("column_name"))
    return seed_components(component_rows, seeds).join(members, "component").select("seed", "ordinal", "column_name")


# ---------------------------------------------------------------- grouping


def keyword_groups(groups: DataFrame, columns: DataFrame) -> DataFrame:
    """Add to every group all columns whose name contains a member's name.

    ``groups`` has ``seed, ordinal, column_name``; ``columns`` has ``column_name``.
    """
    keyed = groups.select("seed", "ordinal", bare(F.col("column_name")).alias("word")).distinct()
    named = columns.select("column_name", bare(F.col("column_name")).alias("name")).distinct()
    hits = textmatch.containment(named.select("name"), keyed.select("word"))
    added = hits.join(keyed, "word").join(named, "name").select("seed", "ordinal", "column_name")
    return groups.select("seed", "ordinal", "column_name").unionByName(added).distinct()


def column_types(edges: DataFrame) -> DataFrame:
    """``(key, data_type)``: type of a bare column name from its first lineage entry."""
    keyed = edges.select(bare(F.col("target_column")).alias("key"), "data_type", "model", "target_column")
    order = F.struct("model", "target_column")
    return keyed.groupBy("key").agg(F.min_by("data_type", order).alias("data_type"))


def exclude(columns: DataFrame, types: DataFrame, exclusions: DataFrame | None = None) -> DataFrame:
    """Drop columns that are never tagged; adds ``data_type`` where it was missing.

    Dropped: names on the exclusion list, ``num_*``, anything ``hashed_``, boolean
    and timestamp columns (unless always kept) and containers with such a member.
    """
    df = columns
    if exclusions is not None:
        listed = exclusions.select(F.col("column_name").alias("__listed")).distinct()
        df = df.join(listed, F.col("column_name") == F.col("__listed"), "left_anti")
    if "data_type" not in df.columns:
        known = types.select("key", "data_type")
        df = lookup_join(df, known, [(bare(F.col("column_name")), "key")])
    name, kind = F.lower("column_name"), F.col("data_type")
    by_name = name.startswith("num_") | name.contains("hashed_")
    kept = kind.isNull() | name.isin(list(ALWAYS_KEEP))
    is_container = kind.startswith("STRUCT") | kind.startswith("ARRAY<STRUCT")
    body = F.regexp_extract(kind, r"^(?:ARRAY<)?STRUCT<(.*)>$", 1)
    inner = F.transform(F.split(body, ","), lambda m: F.lower(F.substring_index(F.trim(m), " ", 1)))

    containers = df.filter(is_container & ~kept & ~by_name).select("data_type").distinct()
    members = containers.select("data_type", F.explode(inner).alias("key"))
    lowered = types.filter(F.col("data_type").isin(list(DROPPED_TYPES))).select("key")
    flagged = members.join(lowered, "key", "left_semi").select(F.col("data_type").alias("__flagged")).distinct()

    df = df.filter(~by_name & (kept | ~F.lower(kind).isin(list(DROPPED_TYPES))))
    protected = F.coalesce(kept, F.lit(True))
    return df.join(flagged, (kind == F.col("__flagged")) & ~protected, "left_anti")


def _contains_any(column: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | column.contains(word)
    return hit


def sensitivity(column: Column) -> Column:
    return F.when(_contains_any(F.lower(column), HIGH_PII), F.lit("high")).otherwise(F.lit("medium"))


def category(column: Column) -> Column:
    return F.when(_contains_any(F.lower(column), HIGH_PII + MEDIUM_PII), F.lit("PII")).otherwise(F.lit("restricted"))


def masking_rule(column: Column, data_type: Column) -> Column:
    """Numbers become NULL, highly sensitive text is hashed, the rest is defaulted."""
    return (
        F.when(data_type.isin("INT64", "FLOAT64"), F.lit(ALWAYS_NULL))
        .when(sensitivity(column) == "high", F.lit(SHA256))
        .otherwise(F.lit(DEFAULT_MASK))
    )


def classify(columns: DataFrame) -> DataFrame:
    """Add sensitivity, category and masking rule to ``column_name, data_type``."""
    name = F.col("column_name")
    return columns.withColumns(
        {
            "sensitivity": sensitivity(name),
            "category": category(name),
            "masking_rule": masking_rule(name, F.col("data_type")),
        }
    )


# ---------------------------------------------------------------- tag tree


def tag_tree(
    groups: DataFrame,
    types: DataFrame,
    mapping: DataFrame | None = None,
    exclusions: DataFrame | None = None,
) -> DataFrame:
    """Parent/child tag rows: a column belongs to the first group that claims it.

    Within a group names are taken in sorted order, mapped extras last; the
    first claimed name is the parent.  Rows with a NULL child are parents alone.
    """
    members = groups.select("seed", "ordinal", "column_name", F.lit(0).alias("extra"), F.lit(0).alias("extra_pos"))
    if mapping is not None:
        seeds = groups.select("seed", "ordinal").distinct()
        extras = mapping.select(
            F.col("canonical").alias("seed"), F.col("alias").alias("column_name"), F.col("ordinal").alias("extra_pos")
        ).join(seeds, "seed")
        members = members.unionByName(
            extras.select("seed", "ordinal", "column_name", F.lit(1).alias("extra"), "extra_pos")
        )
    kept = exclude(members, types, exclusions)
    order = F.struct("ordinal", "seed", "extra", "extra_pos")
    claimed = kept.groupBy("column_name").agg(
        F.min(order).alias("claim"), F.min("data_type").alias("data_type")
    )
    rows = classify(claimed.select("column_name", "data_type", "claim.*"))
    position = F.struct("extra", F.when(F.col("extra") == 1, F.col("extra_pos")), "column_name")
    parents = rows.groupBy("ordinal", "seed").agg(
        F.min_by(F.struct("column_name", "sensitivity", "category", "masking_rule", "data_type"), position).alias("p")
    )
    children = rows.select(
        "ordinal",
        "seed",
        F.col("column_name").alias("child"),
        F.col("sensitivity").alias("child_sensitivity"),
        F.col("masking_rule").alias("child_masking_rule"),
        F.col("data_type").alias("child_type"),
    )
    tree = parents.select(
        "ordinal",
        "seed",
        F.col("p.column_name").alias("parent"),
        F.col("p.sensitivity").alias("sensitivity"),
        F.col("p.category").alias("category"),
        F.col("p.masking_rule").alias("masking_rule"),
        F.col("p.data_type").alias("type"),
    )
    same = ["ordinal", "seed"]
    pairs = tree.join(children, same, "left").filter(F.col("child") != F.col("parent"))
    alone = tree.join(pairs.select(*same).distinct(), same, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def promote_parents(tree: DataFrame, canonical: Sequence[str] = CANONICAL) -> DataFrame:
    """Make the first canonical child the parent; the old parent becomes a child.

    Works on ``(sensitivity, category, parent, masking_rule, type, child, ...)``
    rows.  The group keeps the attributes of its old parent.
    """
    keys = ["sensitivity", "category", "parent"]
    is_canonical = F.col("child").isin(list(canonical))
    chosen = tree.filter(is_canonical).groupBy(*keys).agg(F.min("child").alias("promoted"))
    joined = tree.join(chosen, keys, "left")
    swapped = F.col("child") == F.col("promoted")
    return joined.select(
        "sensitivity",
        "category",
        F.coalesce("promoted", "parent").alias("parent"),
        F.col("masking_rule"),
        F.col("type"),
        F.when(swapped, F.col("parent")).otherwise(F.col("child")).alias("child"),
        F.when(swapped, F.col("sensitivity")).otherwise(F.col("child_sensitivity")).alias("child_sensitivity"),
        F.when(swapped, F.col("masking_rule")).otherwise(F.col("child_masking_rule")).alias("child_masking_rule"),
        F.when(swapped, F.col("type")).otherwise(F.col("child_type")).alias("child_type"),
    )
