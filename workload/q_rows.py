"""Unnesting, joins, aggregations, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import joins, latest, nested
from veilmark.plans import cdc

from . import fixtures as fx
from .registry import query

LINE = ("linenumber", "partkey", "quantity")


def line_columns(alias: str = "item"):
    return [F.col(f"{alias}.{m}").alias(m) for m in LINE]


@query("explode_inner", "SELECT k AS o_orderkey, linenumber, partkey, quantity FROM order_lines", "order_lines")
def explode_inner(spark, sf):
    """Unnest; orders without lines disappear."""
    return nested.unnest(fx.nested_orders(spark, sf), "lines").select("o_orderkey", *line_columns())


@query(
    "explode_left_on",
    """
SELECT o_orderkey, linenumber, partkey, quantity
FROM orders LEFT JOIN order_lines ON k = o_orderkey AND linenumber = o_orderkey % 7""",
    "order_lines",
)
def explode_left_on(spark, sf):
    """Left unnest with a condition on parent and element; every parent stays."""
    wanted = F.col("o_orderkey") % 7
    rows = nested.unnest(fx.nested_orders(spark, sf), "lines", "left", lambda e: e.linenumber == wanted)
    return rows.select("o_orderkey", *line_columns())


@query(
    "explode_left",
    "SELECT o_orderkey, linenumber, partkey, quantity FROM orders LEFT JOIN order_lines ON k = o_orderkey",
    "order_lines",
)
def explode_left(spark, sf):
    """Left unnest without a condition."""
    return nested.unnest(fx.nested_orders(spark, sf), "lines", "left").select("o_orderkey", *line_columns())


@query(
    "double_explode",
    """
SELECT o_orderkey, a.linenumber AS first_line, b.linenumber AS second_line
FROM orders LEFT JOIN order_lines a ON a.k = o_orderkey AND a.linenumber <= 2
LEFT JOIN order_lines b ON b.k = o_orderkey AND b.linenumber >= 6""",
    "order_lines",
)
def double_explode(spark, sf):
    """Two left unnests: all combinations of two arrays of a row."""
    first = nested.unnest(fx.nested_orders(spark, sf), "lines", "left", lambda e: e.linenumber <= 2, "a")
    both = nested.unnest(first, "lines", "left", lambda e: e.linenumber >= 6, "b")
    return both.select(
        "o_orderkey", F.col("a.linenumber").alias("first_line"), F.col("b.linenumber").alias("second_line")
    )


@query(
    "renest",
    """
SELECT k AS o_orderkey, count(*) AS n,
  string_agg(linenumber || ':' || partkey || ':' || quantity::BIGINT, ',' ORDER BY linenumber, partkey, quantity) AS lines
FROM order_lines GROUP BY k""",
    "order_lines",
)
def renest(spark, sf):
    """Rows grouped back into a sorted array of structs."""
    flat = nested.unnest(fx.nested_orders(spark, sf), "lines").select("o_orderkey", *line_columns())
    grouped = nested.renest(flat, ["o_orderkey"], LINE, "lines")
    shown = F.transform(
        "lines",
        lambda e: F.concat_ws(":", e.linenumber.cast("string"), e.partkey.cast("string"), e.quantity.cast("bigint").cast("string")),
    )
    return grouped.select("o_orderkey", F.size("lines").alias("n"), F.array_join(shown, ",").alias("lines"))


@query(
    "array_comprehension",
    """
SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(doubled, '') AS doubled, coalesce(n, 0) >= 4 AS long FROM orders
LEFT JOIN (SELECT k, count(*) AS n,
  string_agg((quantity * 2)::BIGINT::VARCHAR, ',' ORDER BY linenumber, partkey, quantity) AS doubled
  FROM order_lines GROUP BY k) ON k = o_orderkey""",
    "order_lines",
)
def array_comprehension(spark, sf):
    """Transform array elements; NULL arrays give empty ones."""
    doubled = nested.map_array(F.col("lines"), lambda e: (e.quantity * 2).cast("bigint").cast("string"))
    rows = fx.nested_orders(spark, sf).withColumn("d", doubled)
    n = F.size("d").cast("bigint")
    return rows.select("o_orderkey", n.alias("n"), F.array_join("d", ",").alias("doubled"), (n >= 4).alias("long"))


@query(
    "cdc_changes",
    """
SELECT "table", xid, xoffset, ts, source FROM change_events
QUALIFY row_number() OVER (PARTITION BY xid, xoffset, ts ORDER BY source DESC) = 1""",
    "change_events",
)
def cdc_changes(spark, sf):
    """One row per change key over the whole log."""
    return cdc.dedupe_changes(fx.change_events(spark, sf)).select("table", "xid", "xoffset", "ts", "source")


@query(
    "latest_version",
    "SELECT _id, __v, amount, operationType AS operation FROM current_docs",
    "current_docs",
)
def latest_version(spark, sf):
    """Newest live version per document."""
    live = F.col("operationType") != "delete"
    rows = latest.latest_by(fx.plain_versions(spark, sf), ["_id"], latest.version_order(), where=live)
    return rows.select("_id", "__v", "amount", F.col("operationType").alias("operation"))


@query(
    "latest_contact",
    """
SELECT email, k, loan_application_oid AS oid FROM contacts WHERE email <> ''
QUALIFY row_number() OVER (PARTITION BY email ORDER BY created_at DESC, o_orderkey DESC) = 1""",
    "contacts",
)
def latest_contact(spark, sf):
    """Newest use of every email address; shared addresses are hot keys."""
    rows = latest.latest_by(
        fx.contacts(spark, sf),
        ["email"],
        [F.col("created_at").desc()],
        [F.col("o_orderkey").desc()],
        where=F.col("email") != "",
    )
    return rows.select("email", "k", F.col("loan_application_oid").alias("oid"))


@query(
    "largest_array",
    """
SELECT k::VARCHAR AS _id, max(n) AS n FROM (
  SELECT v.k, v.__v, count(l.k) AS n FROM versions v LEFT JOIN version_lines l ON l.k = v.k AND l.__v = v.__v
  GROUP BY v.k, v.__v) GROUP BY k""",
    "version_lines",
)
def largest_array(spark, sf):
    """Longest line array over all versions of a document."""
    rows = latest.largest_array_by(fx.documents(spark, sf), ["_id"], "loans")
    return rows.select("_id", F.size(F.coalesce("loans", F.array())).cast("bigint").alias("n"))


@query(
    "latest_qualifying",
    """
SELECT _id, __v, strftime(accepted_at, '%Y-%m-%d') AS accepted FROM live_versions
WHERE accepted_at <= paid_at AND paid_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC, coalesce(updatedAt, TIMESTAMP '1990-01-01') DESC) = 1""",
    "live_versions",
)
def latest_qualifying(spark, sf):
    """Newest live version that satisfies a condition."""
    qualifies = (F.col("operationType") != "delete") & (F.col("accepted_at") <= F.col("paid_at"))
    rows = latest.latest_by(fx.plain_versions(spark, sf), ["_id"], latest.version_order(), where=qualifies)
    return rows.select("_id", "__v", F.date_format("accepted_at", "yyyy-MM-dd").alias("accepted"))


@query(
    "partition_count",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  count(CASE WHEN l_quantity > 10 THEN l_quantity END) OVER (PARTITION BY l_returnflag) AS n FROM lineitem""",
)
def partition_count(spark, sf):
    """Count per partition on every row; three partitions hold the whole table."""
    big = F.when(F.col("l_quantity") > 10, F.col("l_quantity"))
    rows = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", big.alias("big")
    )
    return latest.partition_count(rows, ["l_returnflag"], "big").drop("l_returnflag", "big")


@query(
    "windowed_collect",
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, flags
FROM lineitem l JOIN (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
  FROM lineitem GROUP BY l_orderkey) f USING (l_orderkey)""",
)
def windowed_collect(spark, sf):
    """Distinct values of a group on every row."""
    rows = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    collected = latest.collect_over(rows, ["l_orderkey"], "l_returnflag", "flags")
    return collected.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("flags", ",").alias("flags"))


@query("first_match", "SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY p_name")
def first_match(spark, sf):
    """First claim wins."""
    return latest.first_match(fx.table(spark, sf, "part").select("p_name", "p_partkey"), ["p_name"], "p_partkey")


@query("last_match", "SELECT p_name, max(p_partkey) AS p_partkey FROM part GROUP BY p_name")
def last_match(spark, sf):
    """Last claim wins."""
    return latest.last_match(fx.table(spark, sf, "part").select("p_name", "p_partkey"), ["p_name"], "p_partkey")


@query(
    "top1_per_group",
    """
SELECT p_brand, p_partkey, p_retailprice, 1 AS rn FROM part
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""",
)
def top1_per_group(spark, sf):
    """Top row per group with its row number."""
    rows = fx.table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return latest.latest_by(
        rows, ["p_brand"], [F.col("p_retailprice").desc()], [F.col("p_partkey").asc()], keep_rn=True
    )


@query("limited", "SELECT p_partkey, p_name FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100")
def limited(spark, sf):
    """Development limit after a total order."""
    ordered = fx.table(spark, sf, "part").orderBy(F.col("p_retailprice").desc(), "p_partkey")
    return ordered.limit(100).select("p_partkey", "p_name")


@query(
    "vault_events_join",
    """
SELECT p.k, p.market, e.compliance_event AS event FROM clean_people p
LEFT JOIN events_of e ON p.ssn = e.national_id AND p.market = e.market AND p.k % 2 = 0""",
    "events_of",
)
def vault_events_join(spark, sf):
    """Left join on a composite key."""
    people = fx.clean_people(spark, sf).select("k", "ssn", F.col("market").alias("m"), (F.col("k") % 2).alias("odd"))
    events = fx.compliance_events(spark, sf).select("national_id", "market", "compliance_event")
    even = F.when(F.col("odd") == 0, F.col("ssn"))
    joined = joins.lookup_join(people, events, [(even, "national_id"), (F.col("m"), "market")])
    return joined.select("k", F.col("m").alias("market"), F.col("compliance_event").alias("event"))


@query(
    "salted_lookup",
    """
SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem LEFT JOIN part
  ON p_partkey = CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 3 = 1 THEN NULL ELSE l_partkey END""",
)
def salted_lookup(spark, sf):
    """Lookup join where one key and the missing key hold a third of the rows each."""
    o = F.col("l_orderkey")
    skewed = F.when(o % 3 == 0, F.lit(7)).when(o % 3 == 2, F.col("l_partkey"))
    probe = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    joined = joins.lookup_join(probe, parts, [(skewed, "p_partkey")], hot_share=0.05, salts=16)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@query(
    "keys_contacts_join",
    """
SELECT c.k, count(*) AS contacts FROM contacts c JOIN vault_people v ON v.k = c.k GROUP BY c.k""",
    "vault_contacts",
)
def keys_contacts_join(spark, sf):
    """Inner join of keys and contacts, counted before the join."""
    per_person = fx.contacts(spark, sf).groupBy("k", F.col("ssn").alias("cs")).agg(F.count(F.lit(1)).alias("contacts"))
    keys = fx.key_vault(spark, sf).select("ssn")
    return per_person.join(keys, F.col("cs") == F.col("ssn")).select("k", "contacts")


@query("anti_absent", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def anti_absent(spark, sf):
    """Rows whose key is absent elsewhere."""
    big = fx.table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.absent(fx.table(spark, sf, "customer").select("c_custkey"), big, ["c_custkey"])


@query(
    "semi_union",
    """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000
  UNION ALL SELECT user_id FROM events WHERE event_type = 'error')""",
)
def semi_union(spark, sf):
    """Semi join on keys gathered from several tables."""
    big = fx.table(spark, sf, "orders").filter("o_totalprice > 480000")
    errors = fx.table(spark, sf, "events").filter("event_type = 'error'")
    keys = joins.union_keys([big, errors], ["o_custkey", "user_id"], "key")
    people = fx.table(spark, sf, "customer").select("c_custkey")
    return people.join(keys, F.col("c_custkey").cast("string") == F.col("key"), "left_semi")


@query(
    "brand_join",
    """
SELECT i.o_orderkey, d.domain, i.o_custkey FROM orders i LEFT JOIN current_docs d ON d.k = i.o_custkey""",
    "current_docs",
)
def brand_join(spark, sf):
    """Left join of rows to the current document they name."""
    live = F.col("operationType") != "delete"
    docs = latest.latest_by(fx.plain_versions(spark, sf), ["_id"], latest.version_order(), where=live)
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    joined = joins.lookup_join(orders, docs.select("_id", "domain"), [(F.col("o_custkey").cast("string"), "_id")])
    return joined.select("o_orderkey", "domain", "o_custkey")


@query(
    "distinct_array_agg",
    """
SELECT o_custkey, o_orderstatus,
  string_agg(DISTINCT coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END, 'null'), '|'
    ORDER BY coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END, 'null')) AS priorities
FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def distinct_array_agg(spark, sf):
    """Distinct values with a substitute for NULL, as joined text."""
    value = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    rows = fx.table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", F.coalesce(value, F.lit("null")).alias("priority")
    )
    return latest.distinct_list(rows, ["o_custkey", "o_orderstatus"], "priority", "priorities", "|")


@query(
    "group_by_seven",
    """
SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey % 5 AS s, l_partkey % 3 AS p, l_discount, l_tax, count(*) AS n
FROM lineitem GROUP BY ALL""",
)
def group_by_seven(spark, sf):
    """Grouping by seven columns."""
    rows = fx.table(spark, sf, "lineitem")
    return rows.groupBy(
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        (F.col("l_suppkey") % 5).alias("s"),
        (F.col("l_partkey") % 3).alias("p"),
        "l_discount",
        "l_tax",
    ).agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    """Whole-row distinct."""
    return fx.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "any_flags",
    """
SELECT l_orderkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_linestatus = 'O') AS open FROM lineitem GROUP BY 1""",
)
def any_flags(spark, sf):
    """Is any row of the group …"""
    return fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_linestatus") == "O").alias("open")
    )


@query(
    "group_to_list",
    """
SELECT p_brand, p_type, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names FROM part GROUP BY 1, 2""",
)
def group_to_list(spark, sf):
    """Groups to sorted lists."""
    return latest.distinct_list(fx.table(spark, sf, "part"), ["p_brand", "p_type"], "p_name", "names", ", ")


@query(
    "union_distinct",
    "SELECT l_partkey AS partkey FROM lineitem UNION SELECT p_partkey FROM part",
)
def union_distinct(spark, sf):
    """UNION DISTINCT."""
    used = fx.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"))
    return used.unionByName(fx.table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"))).distinct()


@query(
    "union_all",
    """
SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def union_all(spark, sf):
    """UNION ALL by name."""
    customers = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    suppliers = fx.table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return customers.unionByName(suppliers)
