"""Projections, predicates, cleaning and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark import clean, crypto, jsonx, nested
from veilmark.functions.jsonx import JsonField
from veilmark.plans import cdc, events

from . import fixtures as fx
from .registry import query


@query(
    "flatten_star_except",
    """
SELECT o_orderkey, 'orders' AS origin, o_orderpriority AS priority, o_totalprice AS total, o_orderkey AS ref,
  o_orderstatus AS status_code
FROM orders""",
)
def flatten_star_except(spark, sf):
    """Struct members, struct expansion, renames, constants and star-except."""
    inner = F.struct(
        F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("ref")).alias("money"),
        F.col("o_orderpriority").alias("priority"),
    )
    orders = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.lit("orders").alias("origin"),
        inner.alias("d"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("status"),
    )
    flat = nested.flatten_struct(orders, "d", {"priority": "priority", "money.total": "total", "money.ref": "ref"})
    return nested.expand(nested.star_except(flat, "d"), "status", prefix="status_")


@query(
    "soft_delete_filter",
    "SELECT _id, __v, operationType AS operation FROM live_versions",
    "live_versions",
)
def soft_delete_filter(spark, sf):
    """Deletions and unknown operations are dropped."""
    rows = fx.plain_versions(spark, sf).filter(F.col("operationType") != "delete")
    return rows.select("_id", "__v", F.col("operationType").alias("operation"))


@query(
    "null_safe_filter",
    """
SELECT _id, __v FROM versions
WHERE (CASE WHEN operationType IS NULL THEN NULL ELSE operationType = 'delete' END) IS DISTINCT FROM TRUE""",
    "versions",
)
def null_safe_filter(spark, sf):
    """IS DISTINCT FROM TRUE keeps NULLs."""
    deleted = F.col("operationType") == "delete"
    return fx.plain_versions(spark, sf).filter(~deleted.eqNullSafe(True)).select("_id", "__v")


@query(
    "routed_events",
    """
SELECT xoffset, xid, source FROM change_events
WHERE "table" = 'purchase' AND CAST(make_timestamp(ts * 1000000) AS DATE) >= DATE '2024-01-10'""",
    "change_events",
)
def routed_events(spark, sf):
    """Envelope routing and a date floor."""
    day = clean.epoch_date(F.col("ts"))
    rows = fx.change_events(spark, sf).filter((F.col("table") == "purchase") & (day >= F.lit("2024-01-10").cast("date")))
    return rows.select("xoffset", "xid", "source")


@query(
    "pred_suite",
    """
SELECT o_orderkey,
  o_orderpriority LIKE '_-%' AS liked, o_orderpriority NOT LIKE '%LOW' AS not_low,
  o_orderstatus IN ('F', 'P') AS listed, o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS solvent,
  list_contains([o_orderstatus, 'O'], 'F') AS member,
  CASE WHEN o_totalprice > 400000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'small' END AS size,
  coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END, 'none') AS filled,
  o_orderkey <> 0 AS number_filled, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'x' END <> '' AS text_filled
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 8760 HOURS""",
)
def pred_suite(spark, sf):
    """LIKE, IN, anti-list, array membership, CASE, COALESCE, emptiness, relative time."""
    poor = fx.table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("pk"))
    o = F.col("o_orderkey")
    recent = F.col("o_orderdate") >= F.lit("2001-08-01 00:00:00").cast("timestamp_ntz") - F.expr("interval 8760 hours")
    rows = fx.table(spark, sf, "orders").filter(recent).join(poor, F.col("o_custkey") == F.col("pk"), "left")
    blank = F.when(o % 5 == 0, F.lit("")).otherwise(F.lit("x"))
    return rows.select(
        "o_orderkey",
        F.col("o_orderpriority").like("_-%").alias("liked"),
        (~F.col("o_orderpriority").like("%LOW")).alias("not_low"),
        F.col("o_orderstatus").isin("F", "P").alias("listed"),
        F.col("pk").isNull().alias("solvent"),
        F.array_contains(F.array("o_orderstatus", F.lit("O")), "F").alias("member"),
        F.when(F.col("o_totalprice") > 400000, "big").when(F.col("o_totalprice") > 100000, "mid").otherwise("small").alias("size"),
        clean.default_value(F.when(o % 3 != 0, F.col("o_orderstatus")), "none").alias("filled"),
        clean.not_blank(o, T.LongType()).alias("number_filled"),
        clean.not_blank(blank, T.StringType()).alias("text_filled"),
    )


@query(
    "national_id_clean",
    """
SELECT k, market, ssn, CASE WHEN TRY_CAST(national_id AS BIGINT) = 0 THEN NULL ELSE
  CASE WHEN market = 'DK' THEN regexp_replace(national_id, '[^0-9]', '', 'g') ELSE ssn END END AS lenient
FROM clean_people""",
    "clean_people",
)
def national_id_clean(spark, sf):
    """National ids by market, strict and lenient."""
    known = F.when(F.col("market") == "DK", F.lit("XX")).otherwise(F.col("market"))
    lenient = clean.national_id(F.col("national_id"), known, zero_to_null=True, fallback_digits=True)
    return fx.clean_people(spark, sf).select("k", "market", "ssn", lenient.alias("lenient"))


@query("phone_clean", "SELECT k, market, mobile FROM clean_people", "clean_people")
def phone_clean(spark, sf):
    """Phone numbers by market."""
    return fx.clean_people(spark, sf).select("k", "market", "mobile")


FLAG = "CASE event_id % 4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN NULL ELSE '2' END"


@query(
    "flag_decode",
    f"""
SELECT event_id, coalesce({FLAG} = '1', FALSE) AS is_one, coalesce({FLAG} <> '0', TRUE) AS not_zero,
  coalesce({FLAG} <> '0', FALSE) AS not_zero_or_null
FROM events""",
)
def flag_decode(spark, sf):
    """Three flag decoders that differ on NULL."""
    e = F.col("event_id")
    flag = F.when(e % 4 == 0, "0").when(e % 4 == 1, "1").when(e % 4 == 3, "2")
    return fx.table(spark, sf, "events").select(
        "event_id",
        clean.flag_is_one(flag).alias("is_one"),
        clean.flag_not_zero(flag).alias("not_zero"),
        clean.flag_not_zero_or_null(flag).alias("not_zero_or_null"),
    )


@query(
    "zero_date",
    """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN '1900-01-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS floor,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS cleared
FROM orders""",
)
def zero_date(spark, sf):
    """All-zero dates become a floor date or NULL before the cast."""
    shown = "yyyy-MM-dd HH:mm:ss"
    dirty = F.when(F.col("o_orderkey") % 17 == 0, F.lit("0000-00-00 00:00:00")).otherwise(
        F.date_format("o_orderdate", shown)
    )
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(clean.zero_date(dirty, clean.ZERO_DATE_REPLACEMENT).cast("timestamp"), shown).alias("floor"),
        F.date_format(clean.zero_date(dirty).cast("timestamp"), shown).alias("cleared"),
    )


@query(
    "click_ids",
    """
SELECT _id, __v,
  CASE WHEN originReference LIKE '%gclid=%' THEN regexp_extract(originReference, 'gclid=([^&]*)', 1) END AS gclid,
  CASE WHEN originReference LIKE '%fbclid=%' THEN regexp_extract(originReference, 'fbclid=([^&]*)', 1) END AS fbclid,
  CASE WHEN originReference LIKE '%scid=%' THEN regexp_extract(originReference, 'scid=([^&]*)', 1) END AS scid,
  CASE WHEN domain LIKE '%second%' THEN 'second' ELSE 'first' END AS brand
FROM versions""",
    "versions",
)
def click_ids(spark, sf):
    """Tracking parameters of a URL; an empty one stays empty."""
    url = F.col("originReference")
    return fx.plain_versions(spark, sf).select(
        "_id",
        "__v",
        *[clean.click_id(url, p).alias(p) for p in ("gclid", "fbclid", "scid")],
        clean.brand(F.col("domain"), "second", "second", "first").alias("brand"),
    )


@query(
    "path_date",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS by_segment, strftime(ts, '%Y-%m-%d') AS by_pattern FROM events""",
)
def path_date(spark, sf):
    """Dates from file paths, by segment and by pattern."""
    path = F.concat(
        F.lit("gs://bucket/events/"), F.date_format("ts", "yyyy/M/d"), F.lit("/part-"), F.col("event_id").cast("string")
    )
    rows = fx.table(spark, sf, "events").select("event_id", path.alias("path"))
    return rows.select(
        "event_id",
        clean.date_from_path(F.col("path")).cast("string").alias("by_segment"),
        clean.date_from_path_pattern(F.col("path")).cast("string").alias("by_pattern"),
    )


@query(
    "string_suite",
    """
SELECT k, regexp_replace(phone, '[^0-9]', '', 'g') AS digits, len(regexp_extract_all(phone, '0+')) AS zero_runs,
  name || '|' || k AS joined, left(name, 4) AS head, substring(name, 5, 3) AS middle, length(name) AS size,
  replace(name, '#', '_') AS swapped, upper(segment) AS loud, lower(segment) AS quiet, instr(name, '#') AS place,
  split_part(name, '#', 2) AS tail, coalesce(segment, 'private') AS filled
FROM people""",
    "people",
)
def string_suite(spark, sf):
    """String functions over whole columns."""
    name, k = F.col("name"), F.col("k")
    return fx.people(spark, sf).select(
        "k",
        F.regexp_replace("phone", "[^0-9]", "").alias("digits"),
        F.size(F.regexp_extract_all("phone", F.lit("0+"), F.lit(0))).alias("zero_runs"),
        F.concat(name, F.lit("|"), k.cast("string")).alias("joined"),
        F.left(name, F.lit(4)).alias("head"),
        F.substring(name, 5, 3).alias("middle"),
        F.length(name).alias("size"),
        F.replace(name, F.lit("#"), F.lit("_")).alias("swapped"),
        F.upper("segment").alias("loud"),
        F.lower("segment").alias("quiet"),
        F.instr(name, "#").alias("place"),
        F.split(name, "#").getItem(1).alias("tail"),
        clean.default_value(F.col("segment"), "private").alias("filled"),
    )


@query(
    "cast_suite",
    """
SELECT k, CAST(replace(name, 'Customer#', '') AS BIGINT) AS number, TRY_CAST(national_id AS BIGINT) AS maybe,
  CAST(CAST(balance AS DECIMAL(38, 9)) AS DOUBLE) AS exact, CAST(k AS VARCHAR) AS shown,
  CAST(balance > 0 AS BOOLEAN) AS positive
FROM people""",
    "people",
)
def cast_suite(spark, sf):
    """Strict and safe casts."""
    return fx.people(spark, sf).select(
        "k",
        F.replace("name", F.lit("Customer#"), F.lit("")).cast("bigint").alias("number"),
        F.col("national_id").try_cast("bigint").alias("maybe"),
        F.col("balance").cast("decimal(38,9)").cast("double").alias("exact"),
        F.col("k").cast("string").alias("shown"),
        (F.col("balance") > 0).cast("boolean").alias("positive"),
    )


@query(
    "date_suite",
    """
SELECT xoffset, source, CAST(make_timestamp(ts * 1000000) AS DATE)::VARCHAR AS day,
  strftime(make_timestamp(ts * 1000000) - INTERVAL 12 HOURS, '%Y-%m-%d %H:%M:%S') AS earlier,
  strftime(strptime(strftime(make_timestamp(ts * 1000000), '%Y/%m/%d'), '%Y/%m/%d'), '%Y-%m-%d') AS parsed
FROM change_events""",
    "change_events",
)
def date_suite(spark, sf):
    """Epoch seconds, parsing and interval arithmetic."""
    at = F.timestamp_seconds("ts")
    return fx.change_events(spark, sf).select(
        "xoffset",
        "source",
        clean.epoch_date(F.col("ts")).cast("string").alias("day"),
        F.date_format(at - F.expr("interval 12 hours"), "yyyy-MM-dd HH:mm:ss").alias("earlier"),
        F.to_date(F.date_format(at, "yyyy/MM/dd"), "yyyy/M/d").cast("string").alias("parsed"),
    )


@query(
    "hash_ids",
    "SELECT k, sha256(national_id) AS digest, name AS opened FROM people",
    "people",
)
def hash_ids(spark, sf):
    """SHA-256 of an id, and an encryption that opens again."""
    key = crypto.derive_key(fx.MASTER_KEY, F.col("national_id"))
    uuid = crypto.derive_uuid(fx.MASTER_KEY, F.col("national_id"))
    rows = fx.people(spark, sf).withColumns({"key": key, "uuid": uuid})
    sealed = rows.withColumn("sealed", crypto.det_encrypt(F.col("name"), F.col("key"), F.col("uuid")))
    return sealed.select(
        "k",
        crypto.sha256_hex(F.col("national_id")).alias("digest"),
        crypto.det_decrypt(F.col("sealed"), F.col("key"), F.col("uuid")).alias("opened"),
    )


@query(
    "encrypt_roundtrip",
    """
SELECT market, count(*) AS people, count(DISTINCT name) AS texts, count(*) AS opened, 0 AS opened_by_others
FROM people GROUP BY market""",
    "people",
)
def encrypt_roundtrip(spark, sf):
    """Every ciphertext opens with its key and none opens under another label."""
    key = crypto.derive_key(fx.MASTER_KEY, F.col("market"))
    rows = fx.people(spark, sf).withColumn("key", key)
    rows = rows.withColumn("sealed", crypto.det_encrypt(F.col("name"), F.col("key"), F.col("market")))
    opened = crypto.det_decrypt(F.col("sealed"), F.col("key"), F.col("market"))
    other = crypto.det_decrypt(F.col("sealed"), F.col("key"), F.lit("someone else"))
    return rows.groupBy("market").agg(
        F.count(F.lit(1)).alias("people"),
        F.count_distinct("sealed").alias("texts"),
        F.count_if(opened == F.col("name")).alias("opened"),
        F.count_if(other.isNotNull()).alias("opened_by_others"),
    )


@query(
    "key_uniqueness",
    """
SELECT market, count(DISTINCT ssn) AS people, count(DISTINCT ssn) AS keys, count(DISTINCT ssn) AS uuids, 32 AS key_bytes,
  36 AS uuid_chars
FROM clean_people GROUP BY market""",
    "clean_people",
)
def key_uniqueness(spark, sf):
    """One key and one uuid per person."""
    rows = fx.clean_people(spark, sf).select(
        "market",
        "ssn",
        crypto.derive_key(fx.MASTER_KEY, F.col("ssn")).alias("key"),
        crypto.derive_uuid(fx.MASTER_KEY, F.col("ssn")).alias("uuid"),
    )
    return rows.groupBy("market").agg(
        F.count_distinct("ssn").alias("people"),
        F.count_distinct("key").alias("keys"),
        F.count_distinct("uuid").alias("uuids"),
        F.max(F.octet_length("key")).alias("key_bytes"),
        F.max(F.length("uuid")).alias("uuid_chars"),
    )


@query(
    "json_typed",
    """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract_string(props, '$.k')::DOUBLE AS amount,
  NULL::VARCHAR AS missing, NULL::VARCHAR AS container, 'ok' AS label, event_id % 2 = 1 AS flag
FROM events""",
)
def json_typed(spark, sf):
    """Typed members from one parse; containers and missing members are NULL."""
    body = F.concat(
        F.lit('{"k": "'),
        F.get_json_object("props", "$.k"),
        F.lit('", "nested": '),
        F.col("props"),
        F.lit(', "label": "ok", "flag": "'),
        (F.col("event_id") % 2).cast("string"),
        F.lit('"}'),
    )
    rows = fx.table(spark, sf, "events").select("event_id", body.alias("data"))
    spec = [
        JsonField("k", "bigint"),
        JsonField("amount", "double", key="k"),
        JsonField("missing"),
        JsonField("container", key="nested"),
        JsonField("label"),
        JsonField("flag", "boolean", cleaner=clean.flag_is_one),
    ]
    return jsonx.parse_typed(rows, "data", spec, keep=["event_id"])


def concatenated(spark, sf):
    """Files of up to fifty change events written back to back, as a raw table."""
    member = F.to_json(
        F.struct(
            F.lit("shop").alias("database"),
            F.col("event_type").alias("table"),
            F.lit("insert").alias("type"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
            F.col("user_id").alias("xid"),
            F.col("event_id").alias("xoffset"),
            F.from_json("props", "struct<k:bigint>").alias("data"),
        )
    )
    chunk = F.floor(F.col("event_id") / 50)
    rows = fx.table(spark, sf, "events").select(F.to_date("ts").alias("day"), chunk.alias("chunk"), member.alias("m"))
    name = F.concat(
        F.lit("gs://bucket/raw/"), F.date_format("day", "yyyy/M/d"), F.lit("/"), F.col("chunk").cast("string")
    )
    return rows.groupBy("day", "chunk").agg(F.array_join(F.collect_list("m"), "").alias("raw_data")).select(
        "raw_data", name.alias("file_name")
    )


@query(
    "json_split",
    """
SELECT event_id AS xoffset, user_id AS xid, json_extract_string(props, '$.k')::BIGINT AS k,
  strftime(ts, '%Y/%-m/%-d') AS file_day FROM events""",
)
def json_split(spark, sf):
    """Objects written without separators, one row each."""
    items = jsonx.split_concatenated(concatenated(spark, sf), "raw_data")
    day = F.regexp_extract("file_name", r"raw/(\d+/\d+/\d+)/", 1)
    return items.select(
        F.get_json_object("item", "$.xoffset").cast("bigint").alias("xoffset"),
        F.get_json_object("item", "$.xid").cast("bigint").alias("xid"),
        F.get_json_object("item", "$.data.k").cast("bigint").alias("k"),
        day.alias("file_day"),
    )


@query(
    "report_flatten",
    """
SELECT l_orderkey AS id, 'r' || l_orderkey AS report_name, l_returnflag AS grp_key, l_linenumber::VARCHAR AS term_id,
  l_partkey::VARCHAR AS term_text
FROM lineitem""",
)
def report_flatten(spark, sf):
    """Namespaced report envelope to one row per term."""
    term = F.struct(
        F.col("l_linenumber").cast("string").alias("ns2:id"), F.col("l_partkey").cast("string").alias("text")
    )
    terms = fx.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(term).alias("ns2:term"))
    group = F.struct(F.col("l_returnflag").alias("ns2:key"), F.col("`ns2:term`"))
    groups = terms.groupBy("l_orderkey").agg(F.collect_list(group).alias("g"))
    level = F.struct(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("ns2:name"), F.col("g").alias("ns2:group")
    )
    for name in reversed(jsonx.REPORT_PATH):
        level = F.struct(level.alias(name))
    rows = groups.select(F.col("l_orderkey").alias("id"), F.to_json(level).alias("json_col"))
    flat = jsonx.flatten_report(rows, "json_col")
    return flat.select("id", "report_name", "grp_key", "term_id", "term_text")


@query(
    "event_log_union",
    """
WITH log AS (
  SELECT user_id AS xid, event_id AS xoffset, event_type AS "table", floor(epoch(ts))::BIGINT AS ts,
    CAST(ts AS DATE)::VARCHAR AS event_date, 'files' AS source, '2' AS column_check,
    json_extract_string(props, '$.k') AS k FROM events
  UNION ALL
  SELECT user_id, event_id, event_type, floor(epoch(ts))::BIGINT, CAST(ts AS DATE)::VARCHAR, 'history', '1',
    json_extract_string(props, '$.k') FROM events WHERE event_id % 5 = 0 AND CAST(ts AS DATE) >= DATE '2024-01-05')
SELECT * FROM log WHERE CAST(make_timestamp(ts * 1000000) AS DATE) <= DATE '2024-01-25'""",
)
def event_log_union(spark, sf):
    """Raw files and the history export in one envelope, with floor and ceiling."""
    history = fx.change_events(spark, sf).filter("source = 'replica'")
    log = cdc.event_log(
        concatenated(spark, sf), history, raw_source="files", floor="2024-01-05", ceiling="2024-01-25"
    )
    return log.select(
        "xid",
        "xoffset",
        "table",
        "ts",
        F.col("event_date").cast("string").alias("event_date"),
        "source",
        "column_check",
        F.get_json_object("data", "$.k").alias("k"),
    )


PURCHASE = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("amount", T.DecimalType(38, 9)),
        T.StructField("ts", T.LongType()),
        T.StructField("rn", T.LongType()),
    ]
)


@query(
    "cdc_dedupe",
    """
SELECT json_extract_string(data, '$.k')::BIGINT AS k, json_extract_string(data, '$.k')::DOUBLE AS amount, ts,
  CAST(make_timestamp(ts * 1000000) AS DATE)::VARCHAR AS timestamp_ts, 1 AS rn, source, xid, xoffset,
  concat(xid, xoffset, ts) AS natural_key
FROM change_events WHERE "table" = 'purchase'
QUALIFY row_number() OVER (PARTITION BY xid, xoffset, ts ORDER BY xid DESC, source DESC) = 1""",
    "change_events",
)
def cdc_dedupe(spark, sf):
    """Parsed change table: one row per change key, typed from JSON."""
    rule = cdc.TableRule(table="purchase", natural_key=True, keys={"amount": "k"})
    spec = cdc.spec_from_schema("purchases", PURCHASE, rule)
    rows = cdc.parsed_table(fx.change_events(spark, sf), spec)
    return rows.withColumns(
        {"amount": F.col("amount").cast("double"), "timestamp_ts": F.col("timestamp_ts").cast("string")}
    )


@query(
    "message_roundtrip",
    """
SELECT ssn AS national_id, k AS customer_id, email || ',' || coalesce(mobile, 'null') AS emails, market,
  segment AS last_brand_interaction, mobile AS latest_mobile
FROM clean_people""",
    "clean_people",
)
def message_roundtrip(spark, sf):
    """Event to union-tagged JSON and back."""
    rows = fx.clean_people(spark, sf).select(
        F.col("ssn").alias("national_id"),
        F.col("k").alias("customer_id"),
        F.array("email", F.coalesce("mobile", F.lit("null"))).alias("emails"),
        "market",
        F.col("segment").alias("last_brand_interaction"),
        F.col("mobile").alias("latest_mobile"),
    )
    back = events.read_messages(events.to_messages(rows))
    return back.select(
        "national_id",
        "customer_id",
        F.array_join("emails", ",").alias("emails"),
        "market",
        "last_brand_interaction",
        "latest_mobile",
    )
