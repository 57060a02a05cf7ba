"""Landing files, manifests and table sinks: written to a scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark import io
from veilmark.session import scratch_dir

from . import fixtures as fx
from .registry import query

CUSTOMER_JSON = """[
  {"name": "c_custkey", "type": "INTEGER", "mode": "NULLABLE"},
  {"name": "c_name", "type": "STRING", "mode": "NULLABLE", "policyTags": {"names": ["tag/name"]}},
  {"name": "c_acctbal", "type": "FLOAT", "mode": "NULLABLE"},
  {"name": "country", "type": "STRING", "mode": "NULLABLE"},
  {"name": "kind", "type": "INTEGER", "mode": "NULLABLE"}]"""
PARTITIONS = ["country", "kind"]
CUSTOMER_SQL = """
SELECT c_custkey, c_name, c_acctbal, CASE c_nationkey % 4 WHEN 0 THEN 'SE' WHEN 1 THEN 'NO' WHEN 2 THEN 'FI' ELSE 'DK' END
  AS country, c_custkey % 2 AS kind
FROM customer"""


def customers(spark, sf):
    return fx.table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        fx.market_of(F.col("c_nationkey")).alias("country"),
        (F.col("c_custkey") % 2).cast("int").alias("kind"),
    )


def flat_schema():
    return io.schema_from_json(CUSTOMER_JSON)


@query("ndjson_scan", CUSTOMER_SQL)
def ndjson_scan(spark, sf):
    """Newline-delimited JSON, gzip, declared schema, strict about fields."""
    root = scratch_dir(spark, "json")
    customers(spark, sf).write.option("compression", "gzip").json(root)
    return io.read_ndjson(spark, root, flat_schema())


@query("json_budget", CUSTOMER_SQL + " WHERE c_custkey % 100 NOT IN (3, 4)")
def json_budget(spark, sf):
    """Broken JSON lines and wrong types within the budget are dropped."""
    root = scratch_dir(spark, "badjson")
    key, line = F.col("c_custkey"), F.to_json(F.struct(*flat_schema().names))
    wrong = F.regexp_replace(line, '"c_acctbal":[-0-9.]+', '"c_acctbal":"much"')
    value = F.when(key % 100 == 3, F.left(line, F.lit(20))).when(key % 100 == 4, wrong).otherwise(line)
    customers(spark, sf).select(value.alias("value")).write.text(root)
    landing = io.scan_ndjson(spark, root, flat_schema(), max_bad=100_000, strict=False)
    return landing.land(scratch_dir(spark, "landed"))


@query("csv_roundtrip", CUSTOMER_SQL + " UNION ALL " + CUSTOMER_SQL)
def csv_roundtrip(spark, sf):
    """Delimited text with a header, and gzip text without one under an unusual delimiter."""
    root = scratch_dir(spark, "csv")
    customers(spark, sf).write.option("header", True).option("sep", ";").csv(f"{root}/semicolon")
    customers(spark, sf).write.option("sep", "þ").option("compression", "gzip").csv(f"{root}/thorn")
    plain = io.read_csv(spark, f"{root}/semicolon", flat_schema(), sep=";")
    packed = io.read_csv(spark, f"{root}/thorn", flat_schema(), sep="þ", header=False)
    return plain.unionByName(packed)


@query("hive_partitions", CUSTOMER_SQL)
def hive_partitions(spark, sf):
    """Partition columns from folder names; they leave the declared schema."""
    root = scratch_dir(spark, "hive")
    customers(spark, sf).write.partitionBy(*PARTITIONS).option("header", True).csv(root)
    schema = io.schema_from_json(CUSTOMER_JSON, drop=PARTITIONS)
    return io.read_csv(spark, root, schema, base_path=root)


@query("bad_record_budget", CUSTOMER_SQL + " WHERE c_custkey % 100 <> 3")
def bad_record_budget(spark, sf):
    """Unreadable rows within the budget are dropped."""
    root = scratch_dir(spark, "bad")
    key = F.col("c_custkey")
    good = F.concat_ws(",", *[F.col(c).cast("string") for c in ("c_custkey", "c_name", "c_acctbal", "country", "kind")])
    broken = F.concat(F.lit("broken,"), F.col("c_name"))
    rows = customers(spark, sf).select(F.when(key % 100 == 3, broken).otherwise(good).alias("value"))
    rows.write.text(root)
    return io.scan_csv(spark, root, flat_schema(), header=False, max_bad=100_000).land(scratch_dir(spark, "landed"))


NESTED_JSON = """[
  {"name": "id", "type": "INTEGER"},
  {"name": "person", "type": "RECORD", "fields": [
    {"name": "name", "type": "STRING"},
    {"name": "address", "type": "RECORD", "fields": [{"name": "country", "type": "STRING"}]}]},
  {"name": "accounts", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "balance", "type": "FLOAT"}]}]"""


def outcome(landing, target: str) -> tuple[str, int]:
    """What became of a landing: its rows, or the kind of refusal."""
    try:
        return "landed", landing.land(target).count()
    except (io.BadRecordBudgetExceeded, io.UnknownFields) as refused:
        return type(refused).__name__, 0


@query(
    "landing_outcomes",
    """
SELECT 'budget met' AS landing, 'landed' AS outcome, count(*) FILTER (c_custkey % 100 <> 3) AS n FROM customer
UNION ALL SELECT 'budget exceeded', CASE WHEN count(*) FILTER (c_custkey % 100 = 3) > 0 THEN 'BadRecordBudgetExceeded'
  ELSE 'landed' END, 0 FROM customer
UNION ALL SELECT 'unknown in a struct', 'UnknownFields', 0
UNION ALL SELECT 'unknown in an array', 'UnknownFields', 0
UNION ALL SELECT 'unknown, not strict', 'landed', count(*) FROM customer
UNION ALL SELECT 'after a refusal', 'landed', count(*) FROM customer""",
)
def landing_outcomes(spark, sf):
    """Nested JSON with bad lines that meet and exceed the budget, and with undeclared members at two depths."""
    root, key = scratch_dir(spark, "outcomes"), F.col("c_custkey")
    schema = io.schema_from_json(NESTED_JSON)
    rows = customers(spark, sf)
    good = F.to_json(
        F.struct(
            key.alias("id"),
            F.struct(F.col("c_name").alias("name"), F.struct("country").alias("address")).alias("person"),
            F.array(F.struct(F.col("c_acctbal").alias("balance"))).alias("accounts"),
        )
    )
    lines = {
        "bad": F.when(key % 100 == 3, F.left(good, F.lit(20))).otherwise(good),
        "struct": F.when(key % 50 == 1, F.replace(good, F.lit('"country"'), F.lit('"city":"x","country"'))).otherwise(good),
        "array": F.when(key % 50 == 1, F.replace(good, F.lit('"balance"'), F.lit('"owner":1,"balance"'))).otherwise(good),
        "good": good,
    }
    for name, value in lines.items():
        rows.select(value.alias("value")).write.text(f"{root}/{name}")
    bad = rows.filter(key % 100 == 3).count()

    def scan(name, **options):
        return io.scan_ndjson(spark, f"{root}/{name}", schema, **options)

    results = {
        "budget met": outcome(scan("bad", max_bad=bad), f"{root}/met"),
        "budget exceeded": outcome(scan("bad", max_bad=bad - 1), f"{root}/exceeded"),
        "unknown in a struct": outcome(scan("struct"), f"{root}/refused"),
        "unknown in an array": outcome(scan("array", max_bad=bad), f"{root}/refused"),
        "unknown, not strict": outcome(scan("struct", strict=False), f"{root}/lenient"),
        "after a refusal": outcome(scan("good"), f"{root}/refused"),
    }
    return spark.createDataFrame([(k, *v) for k, v in results.items()], "landing string, outcome string, n long")


@query("file_path", "SELECT c_custkey, CASE c_custkey % 2 WHEN 0 THEN 'kind=0' ELSE 'kind=1' END AS folder FROM customer")
def file_path(spark, sf):
    """Source file of every row."""
    root = scratch_dir(spark, "paths")
    customers(spark, sf).select("c_custkey", "kind").write.partitionBy("kind").parquet(root)
    rows = io.with_file_path(spark.read.parquet(root))
    return rows.select("c_custkey", F.regexp_extract("file_name", "/(kind=[0-9])/", 1).alias("folder"))


@query(
    "manifest_load",
    "SELECT 'plain_r' AS source, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer UNION ALL\n"
    "SELECT 'parted_r', count(*), sum(c_custkey)::BIGINT FROM customer UNION ALL\n"
    "SELECT 'lines_r', count(*), sum(c_custkey)::BIGINT FROM customer",
)
def manifest_load(spark, sf):
    """Several tables from one manifest: CSV, Hive-partitioned CSV and JSON."""
    root = scratch_dir(spark, "manifest")
    rows = customers(spark, sf)
    rows.write.option("header", True).option("sep", ";").csv(f"{root}/plain")
    rows.write.partitionBy(*PARTITIONS).option("header", True).csv(f"{root}/parted")
    rows.write.json(f"{root}/lines")
    lines = [
        (f"plain_r,{root}/plain/*,0, CSV, ; ",),
        (f"parted_r,{root}/parted/*,100, CSV, , ".replace(", , ", ", None "),),
        (f"lines_r,{root}/lines/*,0,NEWLINE_DELIMITED_JSON, None ",),
    ]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{root}/list")
    schemas = {name: flat_schema() for name in ("plain_r", "parted_r", "lines_r")}
    tables = io.load_manifest(spark, f"{root}/list", schemas, f"{root}/tables", {"parted_r": PARTITIONS})
    counted = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")).select(F.lit(name).alias("source"), "n", "keys")
        for name, df in sorted(tables.items())
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "ddl_manifest",
    """
SELECT 't' || p_partkey || '_r' AS table_name, 'gs://sink/data/' || p_partkey || '/*' AS uri,
  CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END AS max_bad_records, 'CSV' AS file_format,
  CASE WHEN p_partkey % 5 = 0 THEN ';' END AS field_delimiter
FROM part WHERE p_partkey % 7 <> 0""",
)
def ddl_manifest(spark, sf):
    """Manifest rows out of table definitions; those over another bucket are left out."""
    p = F.col("p_partkey")
    bucket = F.when(p % 7 == 0, F.lit("other")).otherwise(F.lit("landing"))
    star = F.when(p % 3 == 0, F.lit("*")).otherwise(F.lit(""))
    ddl = F.concat(
        F.lit("CREATE EXTERNAL TABLE x OPTIONS(format=\"CSV\", uris=[\"gs://"),
        bucket,
        F.lit("/data/"),
        fx.text(p),
        F.lit("/"),
        star,
        F.lit('", "gs://'),
        bucket,
        F.lit('/second/*"]'),
        F.when(p % 2 == 0, F.concat(F.lit(", max_bad_records = "), fx.text(F.col("p_size")))).otherwise(F.lit("")),
        F.when(p % 5 == 0, F.lit(', field_delimiter=";"')).otherwise(F.lit("")),
        F.lit(")"),
    )
    rows = fx.table(spark, sf, "part").select(F.concat(F.lit("t"), fx.text(p), F.lit("_r")).alias("table_name"), ddl.alias("ddl"))
    return io.manifest_from_ddl(rows, "landing", "sink")


@query(
    "config_inputs",
    """
SELECT lower(replace(p_name, ' ', '_')) AS column_name FROM part WHERE p_partkey % 10 = 1
  AND lower(replace(p_name, ' ', '_')) NOT IN (SELECT lower(replace(p_name, ' ', '_')) FROM part WHERE p_partkey % 250 = 7)""",
)
def config_inputs(spark, sf):
    """Seed columns without blanks, minus an exclusion list."""
    root = scratch_dir(spark, "config")
    p = F.col("p_partkey")
    name = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    parts = fx.table(spark, sf, "part")
    label = F.when(p % 10 == 1, name).when(p % 10 == 2, F.lit("NULL")).when(p % 10 == 3, F.lit(" "))
    parts.select(p.alias("legacy model"), label.alias("legacy column name")).write.option("header", True).csv(f"{root}/seeds")
    parts.filter(p % 250 == 7).select(F.concat(F.upper(name), F.lit(" "))).write.text(f"{root}/exclusions")
    seeds = io.read_seed_columns(spark, f"{root}/seeds")
    return seeds.join(io.read_exclusions(spark, f"{root}/exclusions"), "column_name", "left_anti")


@query(
    "column_mapping",
    """
SELECT p_brand AS canonical, name AS alias, row_number() OVER (PARTITION BY p_brand ORDER BY name) - 1 AS ordinal
FROM (SELECT DISTINCT p_brand, replace(p_name, ' ', '_') AS name FROM part)""",
)
def column_mapping(spark, sf):
    """A mapping file of canonical columns and their aliases, as rows in the file's order."""
    root = scratch_dir(spark, "mapping")
    names = F.array_sort(F.collect_set(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))))
    brands = fx.table(spark, sf, "part").groupBy("p_brand").agg(names.alias("names"))
    mapping = brands.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("p_brand", "names")))).alias("value"))
    mapping.coalesce(1).write.text(root)
    return io.read_config_json(spark, root).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query("write_partitioned", CUSTOMER_SQL)
def write_partitioned(spark, sf):
    """Partitioned, clustered write, then a replacement that reads its own table."""
    root = scratch_dir(spark, "write")
    io.write_table(customers(spark, sf).filter("c_custkey % 2 = 0"), f"{root}/plain", ["country"], ["c_custkey"])
    table = f"{root}/versions"
    io.versioned.replace(spark.read.parquet(f"{root}/plain"), table)
    odd = customers(spark, sf).filter("c_custkey % 2 = 1")
    return io.versioned.replace(io.versioned.read(spark, table).unionByName(odd), table)


@query(
    "write_clustered",
    """
SELECT 'o_custkey' AS filter, count(*) AS n, TRUE AS skips_half FROM orders WHERE o_custkey <= (SELECT max(o_custkey) // 50 FROM orders)
UNION ALL
SELECT 'o_orderdate', count(*), TRUE FROM orders WHERE o_orderdate < (SELECT min(o_orderdate) FROM orders) + INTERVAL 30 DAY""",
)
def write_clustered(spark, sf):
    """Files along a curve over two columns: a filter on either one skips at least half of them."""
    path = scratch_dir(spark, "clustered")
    orders = fx.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    ends = orders.agg(F.max("o_custkey").alias("most"), F.min("o_orderdate").alias("first")).first()
    io.write_clustered(orders, path, ["o_custkey", "o_orderdate"], files=16)
    until = F.lit(ends.first) + F.expr("INTERVAL 30 DAYS")
    filters = {"o_custkey": lambda c: c <= ends.most // 50, "o_orderdate": lambda c: c < until}
    files = io.file_ranges(spark, path, list(filters))
    rows = spark.read.parquet(path)
    parts = []
    for column, holds in filters.items():
        skipped = files.agg((F.count_if(~holds(F.col(f"min_{column}"))) * 2 >= F.count(F.lit(1))).alias("skips_half"))
        counted = rows.filter(holds(F.col(column))).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(column).alias("filter"), "n", skipped.scalar().alias("skips_half")))
    return parts[0].unionByName(parts[1])


@query("copy_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def copy_table(spark, sf):
    """Table copy."""
    return io.copy_table(spark, f"{sf}/supplier.parquet", f"{scratch_dir(spark, 'copy')}/supplier")


@query(
    "insert_absent",
    "SELECT o_custkey AS key, 'order' AS origin FROM orders GROUP BY 1 UNION ALL\n"
    "SELECT c_custkey, 'customer' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def insert_absent(spark, sf):
    """Only unknown keys are added."""
    known = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("key")).distinct().withColumn("origin", F.lit("order"))
    new = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.lit("customer").alias("origin"))
    return io.insert_absent(known, new, ["key"])


@query(
    "update_where",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def update_where(spark, sf):
    """Conditional update as a projection."""
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    closed = F.when(F.col("o_orderkey") >= 0, F.col("o_orderstatus") == "F")
    return io.update_where(orders, closed, {"o_orderstatus": F.lit("closed"), "o_totalprice": F.lit(0.0)})


BUCKETS = 16


@query(
    "update_buckets",
    f"""
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderkey % {BUCKETS} AS bucket,
    o_orderstatus = 'F' AND o_orderkey % {BUCKETS} IN (3, 5) AS hit FROM orders)
SELECT o_orderkey, CASE WHEN hit THEN 'closed' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN hit THEN 0 ELSE o_totalprice END AS o_totalprice, bool_or(hit) OVER (PARTITION BY bucket) AS rewritten
FROM t""",
)
def update_buckets(spark, sf):
    """Conditional update that writes only the buckets with a hit; every row tells whether its file is new."""
    path = scratch_dir(spark, "buckets")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = io.versioned.replace(orders, path, f"o_orderkey % {BUCKETS}")
    old = set(io.versioned.version(spark, path).folders.values())
    hit = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % BUCKETS).isin(3, 5)
    new = io.versioned.update(spark, path, hit, {"o_orderstatus": F.lit("closed"), "o_totalprice": F.lit(0.0)})
    assert first.columns == orders.columns
    fresh = [folder for folder in new.folders.values() if folder not in old]
    name = F.col("_metadata.file_path")
    is_new = F.lit(False)
    for folder in fresh:
        is_new = is_new | name.contains(folder.split("/data-")[1] + "/")
    return io.versioned.read(spark, path).withColumn("rewritten", is_new)


@query("export_csv", "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, c_name FROM nation JOIN customer ON c_nationkey = n_nationkey")
def export_csv(spark, sf):
    """Report export and its re-read."""
    root = scratch_dir(spark, "export")
    customers_of = fx.table(spark, sf, "customer").select("c_nationkey", "c_name")
    nations = fx.table(spark, sf, "nation").select("n_nationkey", "n_name")
    report = nations.join(customers_of, F.col("n_nationkey") == F.col("c_nationkey")).drop("c_nationkey")
    io.export_csv(report, root)
    return spark.read.option("header", True).csv(root)


@query(
    "schema_export",
    "SELECT 'c_name' AS field, 'tag/name' AS tag, count(c_name) AS filled FROM customer",
)
def schema_export(spark, sf):
    """Tagged schema to JSON and back, and the cells behind each tag."""
    again = io.schema_from_json(io.schema_to_json(flat_schema()))
    tagged = [(f.name, io.tag_of(f)[0]) for f in again.fields if io.tag_of(f)]
    rows = customers(spark, sf).agg(*[F.count(name).alias(name) for name, _ in tagged])
    cells = [
        F.struct(F.lit(name).alias("field"), F.lit(tag).alias("tag"), F.col(name).alias("filled")) for name, tag in tagged
    ]
    return rows.select(F.inline(F.array(*cells)))
