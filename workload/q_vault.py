"""Key vault, encrypted views, anonymisation events and their delivery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark import crypto, events, io, joins, vault, views
from veilmark.session import scratch_dir, ship_package
from veilmark.streaming import consume_stream, dedupe_stream, settled, write_canonical

from . import fixtures as fx
from .registry import query


@query(
    "vault_build",
    """
SELECT v.national_id AS ssn, v.market, v.is_valid_national_id, FALSE AS is_anonymized, coalesce(n, 0) AS history,
  v.national_id AS opened, '2024-01-01 00:00:00' AS at
FROM vault_people v LEFT JOIN (SELECT k, count(*) AS n FROM contacts GROUP BY k) c ON c.k = v.k""",
    "vault_people contacts",
)
def vault_build(spark, sf):
    """One vault row per person and market; the encrypted id opens with its key."""
    rows = fx.fresh_vault(spark, sf)
    return rows.select(
        "ssn",
        "market",
        "is_valid_national_id",
        "is_anonymized",
        F.size("history").cast("bigint").alias("history"),
        crypto.det_decrypt(F.col("encrypted_ssn"), F.col("aead_key"), F.col("uuid")).alias("opened"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


@query(
    "vault_insert_absent",
    """
SELECT national_id AS ssn, CASE WHEN k % 10 <> 0 THEN '2024-01-01' ELSE '2024-06-01' END AS day
FROM events_of WHERE k % 19 <> 0 AND k % 13 <> 0""",
    "events_of",
)
def vault_insert_absent(spark, sf):
    """A second batch adds only people the vault does not know."""
    batch = vault.build(
        fx.compliance_events(spark, sf).drop("k"), fx.MASTER_KEY, F.lit("2024-06-01 00:00:00").cast("timestamp")
    )
    grown = vault.insert_absent(fx.key_vault(spark, sf), batch)
    return grown.select("ssn", F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("day"))


LATER = "2024-03-01 00:00:00"


def published_views(spark, sf):
    """One view keyed by id, one keyed by market, one without a key."""
    keys = fx.key_vault(spark, sf)

    def view(rows):
        return views.encrypted_view(rows, "people", F.col("market"), TAGS, keys, expose_join_key=True)

    return {
        "by_id": view(fx.people(spark, sf).filter("k % 4 = 0")),
        "by_market": view(fx.people(spark, sf).filter("market = 'DK'")).select(F.col("market").alias("secondary_column")),
        "no_key": fx.clean_people(spark, sf).select("segment"),
    }


def flagged_vault(spark, sf):
    """Vault after an update from the published views."""
    later = F.lit(LATER).cast("timestamp")
    return vault.mark_anonymised(fx.key_vault(spark, sf), published_views(spark, sf), as_of=later, keyless={"no_key"})


@query(
    "vault_flag_update",
    """
SELECT national_id AS ssn, k % 4 = 0 OR market = 'DK' AS is_anonymized,
  CASE WHEN k % 4 = 0 OR market = 'DK' THEN '2024-03-01' ELSE '2024-01-01' END AS day
FROM vault_people""",
    "vault_people",
)
def vault_flag_update(spark, sf):
    """People that occur in published views are flagged."""
    rows = flagged_vault(spark, sf)
    return rows.select("ssn", "is_anonymized", F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("day"))


@query(
    "vault_flag_stored",
    """
SELECT national_id AS ssn, k % 4 = 0 OR market = 'DK' AS is_anonymized,
  CASE WHEN k % 4 = 0 OR market = 'DK' THEN '2024-03-01' ELSE '2024-01-01' END AS day,
  bool_or(k % 4 = 0 OR market = 'DK') OVER (PARTITION BY right(national_id, 2)) AS rewritten
FROM vault_people""",
    "vault_people",
)
def vault_flag_stored(spark, sf):
    """The same update on a vault kept in buckets; every row tells whether its bucket was written."""
    path = scratch_dir(spark, "vault-versions")
    io.versioned.replace(fx.key_vault(spark, sf), path, "right(ssn, 2)")
    old = io.versioned.version(spark, path).folders
    later = F.lit(LATER).cast("timestamp")
    new = vault.mark_stored(spark, path, published_views(spark, sf), as_of=later, keyless={"no_key"}).folders
    written = [name for name, folder in new.items() if old[name] != folder]
    day = F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("day")
    rewritten = F.right("ssn", F.lit(2)).isin(written).alias("rewritten")
    return io.versioned.read(spark, path).select("ssn", "is_anonymized", day, rewritten)


# ------------------------------------------------------------------ views

TAGS = {"ssn", "national_id", "email", "phone", "name", "notes", "contact_detail", "comments", "quantity"}


def reopened(view, lookup, key, columns):
    """Decrypt columns of a view: ``<c>`` clear again and ``<c>_sealed`` whether it was encrypted."""
    keys = lookup.select(F.col("key").alias("__key"), F.col("uuid").alias("__u"), F.col("cipher_key").alias("__c"))
    joined = view.join(keys, F.col(key) == F.col("__key"), "left")
    clear = {c: crypto.det_decrypt_with(F.col(c), F.col("__c"), F.col("__u")) for c in columns}
    return joined.select(
        *[c for c in view.columns if c not in columns],
        *[F.coalesce(expr, F.col(c)).alias(c) for c, expr in clear.items()],
        *[expr.isNotNull().alias(f"{c}_sealed") for c, expr in clear.items()],
    )


@query(
    "view_ssn",
    """
WITH v AS (SELECT p.*, p.k IN (SELECT k FROM vault_people) AS hit FROM clean_people p)
SELECT k, market, balance, segment, national_id, hit AND national_id <> '' AS national_id_sealed, email,
  hit AND email <> '' AS email_sealed, phone, hit AS phone_sealed, name, hit AS name_sealed,
  (national_id NOT IN ('', '0') AND hit) OR lower(national_id) = 'anonymized' AS is_anonymised
FROM v""",
    "vault_people",
)
def view_ssn(spark, sf):
    """Encrypted view joined by national id, decrypted again for comparison."""
    people, keys = fx.people(spark, sf), fx.key_vault(spark, sf)
    view = views.encrypted_view(people, "people", F.col("market"), TAGS, keys, expose_join_key=True)
    opened = reopened(view, vault.lookup(keys, "ssn"), "ssn_clean", ["national_id", "email", "phone", "name"])
    return opened.drop("ssn_clean")


@query(
    "view_ssn_published",
    """
SELECT market, count(*) AS rows, count_if((national_id NOT IN ('', '0') AND k IN (SELECT k FROM vault_people))
  OR lower(national_id) = 'anonymized') AS anonymised,
  count(DISTINCT CASE WHEN k IN (SELECT k FROM vault_people) THEN name END) AS sealed_names
FROM clean_people GROUP BY market""",
    "vault_people",
)
def view_ssn_published(spark, sf):
    """The view as published: row counts, flags and distinct ciphertexts per market."""
    people, keys = fx.people(spark, sf), fx.key_vault(spark, sf)
    view = views.encrypted_view(people, "people", F.col("market"), TAGS, keys)
    return view.groupBy("market").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_anonymised").alias("anonymised"),
        F.count_distinct(F.when(F.col("name").rlike("^[0-9a-f]{56,}$"), F.col("name"))).alias("sealed_names"),
    )


def app_id():
    o = F.col("o_orderkey")
    return F.when(o % 23 == 0, F.lit("")).when(o % 29 == 0, F.lit("ANONYMIZED")).otherwise(fx.text(o))


def orders_with_app_id(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", app_id().alias("application_id"), F.col("o_orderpriority").alias("notes")
    )


APP_VIEW = """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN 'ANONYMIZED'
    ELSE o_orderkey::VARCHAR END AS application_id, o_orderpriority AS notes FROM orders),
  hits AS (SELECT DISTINCT loan_application_oid AS oid FROM vault_contacts WHERE stack = 'alpha')"""


@query(
    "view_app_id",
    APP_VIEW
    + """
SELECT o_orderkey, application_id, notes, oid IS NOT NULL AS notes_sealed,
  oid IS NOT NULL OR lower(application_id) = 'anonymized' AS is_anonymised
FROM a LEFT JOIN hits ON oid = application_id""",
    "vault_contacts",
)
def view_app_id(spark, sf):
    """Encrypted view joined by application id within one stack."""
    keys = fx.key_vault(spark, sf)
    view = views.encrypted_view(orders_with_app_id(spark, sf), "applications", "SE", TAGS, keys, stack=fx.STACK)
    return reopened(view, vault.lookup(keys, "app", fx.STACK), "application_id", ["notes"])


@query(
    "view_email",
    """
SELECT o_orderkey, email, key IS NOT NULL AS email_sealed, key IS NOT NULL AS is_anonymised
FROM contacts c LEFT JOIN email_keys e ON e.key = c.email""",
    "email_keys",
)
def view_email(spark, sf):
    """Encrypted view joined by email; shared addresses are hot keys."""
    keys = fx.key_vault(spark, sf)
    rows = fx.contacts(spark, sf).select("o_orderkey", "email", F.col("email").alias("ref"))
    view = views.encrypted_view(rows, "mails", "SE", TAGS, keys, hot_share=0.05)
    return reopened(view, vault.lookup(keys, "email"), "ref", ["email"]).drop("ref")


@query(
    "view_phone",
    """
SELECT k, phone, key IS NOT NULL AS phone_sealed, key IS NOT NULL AS is_anonymised
FROM clean_people LEFT JOIN mobile_keys ON key = mobile""",
    "mobile_keys clean_people",
)
def view_phone(spark, sf):
    """Encrypted view joined by normalised phone."""
    keys = fx.key_vault(spark, sf)
    rows = fx.people(spark, sf).select("k", "phone", "market")
    view = views.encrypted_view(rows, "phones", F.col("market"), TAGS, keys, expose_join_key=True)
    opened = reopened(view, vault.lookup(keys, "mobile"), "mobile_clean", ["phone"])
    return opened.drop("mobile_clean", "market")


@query(
    "view_double",
    """
WITH v AS (SELECT p.*, e.key IS NOT NULL AS by_email, m.key IS NOT NULL AS by_mobile FROM clean_people p
  LEFT JOIN email_keys e ON e.key = p.email LEFT JOIN mobile_keys m ON m.key = p.mobile)
SELECT k, (by_email OR by_mobile) AND name <> '' AS name_sealed, (by_email OR by_mobile) AND email <> '' AS email_sealed,
  coalesce((by_email OR by_mobile) OR lower(email) = 'anonymized', FALSE) AS is_anonymised
FROM v""",
    "email_keys mobile_keys clean_people",
)
def view_double(spark, sf):
    """Encrypted view joined by email first, then phone."""
    keys = fx.key_vault(spark, sf)
    rows = fx.people(spark, sf).select("k", "email", "phone", "name", "market")
    view = views.encrypted_view(rows, "people", F.col("market"), TAGS, keys)
    sealed = "^[0-9a-f]{56,}$"
    return view.select(
        "k",
        F.col("name").rlike(sealed).alias("name_sealed"),
        F.col("email").rlike(sealed).alias("email_sealed"),
        "is_anonymised",
    )


@query(
    "view_triple",
    """
WITH blocks AS (SELECT p.*, t.type, CASE t.type WHEN 'post' THEN national_id WHEN 'email' THEN email ELSE phone END
    AS contact FROM clean_people p, (VALUES ('post'), ('email'), ('mobile_phone')) t(type)),
  v AS (SELECT b.k, b.type, b.contact, b.segment, CASE b.type
    WHEN 'post' THEN b.ssn IN (SELECT national_id FROM vault_people) AND b.ssn <> ''
    WHEN 'email' THEN b.contact IN (SELECT key FROM email_keys)
    ELSE coalesce(b.mobile IN (SELECT key FROM mobile_keys), FALSE) END AS hit FROM blocks b)
SELECT k, type, contact, hit AND contact <> '' AS contact_sealed, segment, hit AS notes_sealed,
  '2024-05-06' AS date_partition, coalesce(contact NOT IN ('', '0') AND hit, FALSE) AS is_anonymised
FROM v""",
    "vault_people email_keys mobile_keys clean_people",
)
def view_triple(spark, sf):
    """Contact blocks whose type decides which key is tried; struct members encrypted."""
    keys = fx.key_vault(spark, sf)
    kinds = {"post": "national_id", "email": "email", "mobile_phone": "phone"}
    payloads = F.array(
        *[
            F.struct(F.lit(t).alias("type"), F.col(c).alias("contact_detail"), F.col("segment").alias("notes"))
            for t, c in kinds.items()
        ]
    )
    rows = fx.people(spark, sf).select("k", "market", F.lit("2024-05-06").alias("ingest_day"), F.explode(payloads).alias("payload"))
    rows = io.with_partition_date(rows, "ingest_day").drop("ingest_day")
    view = views.encrypted_view(
        rows, "contact_blocks", F.col("market"), TAGS, keys, gate="payload.type", expose_join_key=True
    )
    kind = F.col("payload.type")
    # Open with the lookup the type selects.  The three are joined as one: every row has a key in it, while three joins
    # would each send the rows of the other types, which have none, to one task.
    email_of = fx.people(spark, sf).select(F.col("k").alias("ek"), F.col("email").alias("clear_email"))
    opened = view.join(email_of, F.col("k") == F.col("ek"))
    wanted = {"post": F.col("ssn_clean"), "email": F.col("clear_email"), "mobile_phone": F.col("mobile_clean")}
    parts = [
        vault.lookup(keys, by).select("key", "uuid", "cipher_key", F.lit(value).alias("type"))
        for by, value in (("ssn", "post"), ("email", "email"), ("mobile", "mobile_phone"))
    ]
    found = reduce(DataFrame.unionByName, parts)
    key = F.coalesce(*[F.when(kind == value, column) for value, column in wanted.items()])
    opened = joins.lookup_join(opened, found, [(key, "key"), (kind, "type")])

    def clear(member):
        return crypto.det_decrypt_with(F.col(f"payload.{member}"), F.col("cipher_key"), F.col("uuid"))

    contact, notes = clear("contact_detail"), clear("notes")
    return opened.select(
        "k",
        kind.alias("type"),
        F.coalesce(contact, F.col("payload.contact_detail")).alias("contact"),
        contact.isNotNull().alias("contact_sealed"),
        F.coalesce(notes, F.col("payload.notes")).alias("segment"),
        notes.isNotNull().alias("notes_sealed"),
        "date_partition",
        "is_anonymised",
    )


@query(
    "view_passthrough",
    "SELECT s_suppkey, s_name, s_acctbal, FALSE AS is_anonymised FROM supplier UNION ALL SELECT k, name, balance, FALSE FROM people",
    "people",
)
def view_passthrough(spark, sf):
    """Tables without tagged columns, and excluded ones, only get the flag."""
    keys = fx.key_vault(spark, sf)
    suppliers = fx.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    untagged = views.encrypted_view(suppliers, "suppliers", "SE", TAGS, keys)
    people = fx.people(spark, sf).select(
        F.col("k").alias("s_suppkey"), F.col("name").alias("s_name"), F.col("balance").alias("s_acctbal")
    )
    excluded = views.encrypted_view(people, "people", "SE", TAGS | {"s_name"}, keys, exclude={"people"})
    return untagged.unionByName(excluded)


@query(
    "view_dataset_passthrough",
    "SELECT k, name, email, FALSE AS is_anonymised FROM people",
    "people",
)
def view_dataset_passthrough(spark, sf):
    """All tables of an excluded dataset only get the flag, tagged or not."""
    people = fx.people(spark, sf).select("k", "name", "email")
    return views.encrypted_view(
        people, "people", "SE", TAGS, fx.key_vault(spark, sf), dataset="open", exclude_datasets={"open"}
    )


@query(
    "view_array_key",
    """
SELECT k, segment, k IN (SELECT k FROM vault_people) AND national_id <> '' AS sealed FROM clean_people""",
    "vault_people clean_people",
)
def view_array_key(spark, sf):
    """An email inside an array is encrypted by the row's own key and never chosen as one."""
    contact = F.struct(F.col("name").alias("email"), F.lit("x").alias("notes"))
    people = fx.people(spark, sf).select("k", "segment", "market", "national_id", F.array(contact).alias("contacts"))
    view = views.encrypted_view(people, "people", F.col("market"), TAGS, fx.key_vault(spark, sf))
    cell = F.col("contacts").getItem(0).getField("email")
    return view.select("k", "segment", (cell.rlike("^[0-9a-f]{56,}$")).alias("sealed"))


@query("view_plain", "SELECT n_nationkey, n_name, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def view_plain(spark, sf):
    """Registered views read lazily, published unchanged."""
    names = io.register_views(
        {
            ("shop_fi", "nation"): views.plain(fx.table(spark, sf, "nation")),
            ("shop", "supplier"): views.plain(fx.table(spark, sf, "supplier")),
        }
    )
    nation, supplier = (spark.table(n) for n in names)
    return nation.join(supplier, F.col("s_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name", "s_name")


@query(
    "encrypt_arrays",
    APP_VIEW.replace("o_orderpriority AS notes", "o_orderpriority AS word, o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS bare")
    + """
SELECT o_orderkey, oid IS NOT NULL AS hit, word || ',' AS comments,
  CASE WHEN bare THEN '' ELSE coalesce(quantities, '') END AS quantities,
  CASE WHEN bare THEN 0 WHEN oid IS NULL THEN 0 ELSE coalesce(n, 0) END AS sealed_quantities,
  CASE WHEN bare THEN '' ELSE coalesce(partkeys, '') END AS partkeys
FROM a LEFT JOIN hits ON oid = application_id
LEFT JOIN (SELECT l_orderkey, count(*) AS n,
  string_agg(l_quantity::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_quantity) AS quantities,
  string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey, l_quantity) AS partkeys
  FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""",
    "vault_contacts",
)
def encrypt_arrays(spark, sf):
    """Arrays of text and of structs encrypted element by element, then opened again."""
    keys = fx.key_vault(spark, sf)
    rows = fx.nested_orders(spark, sf).select(
        "o_orderkey", F.array("o_orderpriority", F.lit("")).alias("comments"), "lines", app_id().alias("application_id")
    )
    view = views.encrypted_view(rows, "applications", "SE", TAGS, keys, stack=fx.STACK)
    found = vault.lookup(keys, "app", fx.STACK).select("key", "uuid", "cipher_key")
    opened = view.join(found, F.col("application_id") == F.col("key"), "left")

    def clear(e):
        return F.coalesce(crypto.det_decrypt_with(e, F.col("cipher_key"), F.col("uuid")), e)

    sealed = F.filter("lines", lambda e: e.quantity.rlike("^[0-9a-f]{56,}$"))
    return opened.select(
        "o_orderkey",
        F.col("uuid").isNotNull().alias("hit"),
        F.array_join(F.transform("comments", clear), ",").alias("comments"),
        F.array_join(F.transform("lines", lambda e: clear(e.quantity)), ",").alias("quantities"),
        F.size(sealed).cast("bigint").alias("sealed_quantities"),
        F.array_join(F.transform("lines", lambda e: e.partkey.cast("string")), ",").alias("partkeys"),
    )


@query(
    "encrypt_structs",
    """
WITH v AS (SELECT p.*, p.k IN (SELECT k FROM vault_people) AS hit FROM clean_people p)
SELECT k, national_id, email, hit AND email <> '' AS email_sealed, hit AS email_sealed_blank, segment,
  (national_id NOT IN ('', '0') AND hit) OR lower(national_id) = 'anonymized' AS is_anonymised
FROM v""",
    "vault_people",
)
def encrypt_structs(spark, sf):
    """Members of a struct encrypted in place; the older rule encrypts blanks as well."""
    keys = fx.key_vault(spark, sf)
    payload = F.struct("national_id", "segment", "email")
    rows = fx.people(spark, sf).select("k", "market", payload.alias("payload"))
    market = F.col("market")
    view = views.encrypted_view(rows, "payloads", market, TAGS, keys, expose_join_key=True)
    older = views.encrypted_view(rows, "payloads", market, TAGS, keys, encrypt_blank=True)
    older = older.select(F.col("k").alias("ok"), F.col("payload.email").alias("older_email"))
    found = vault.lookup(keys, "ssn").select("key", "uuid", "cipher_key")
    opened = view.join(found, F.col("ssn_clean") == F.col("key"), "left").join(older, F.col("k") == F.col("ok"))

    def clear(column):
        return crypto.det_decrypt_with(F.col(column), F.col("cipher_key"), F.col("uuid"))

    return opened.select(
        "k",
        F.coalesce(clear("payload.national_id"), F.col("payload.national_id")).alias("national_id"),
        F.coalesce(clear("payload.email"), F.col("payload.email")).alias("email"),
        clear("payload.email").isNotNull().alias("email_sealed"),
        clear("older_email").isNotNull().alias("email_sealed_blank"),
        F.col("payload.segment").alias("segment"),
        "is_anonymised",
    )


# ----------------------------------------------------------------- events

EVENT_SQL = """
WITH listed AS (SELECT k, string_agg(DISTINCT coalesce(email, 'null'), ',' ORDER BY coalesce(email, 'null')) AS emails,
    string_agg(DISTINCT coalesce(mobile_phone, 'null'), ',' ORDER BY coalesce(mobile_phone, 'null')) AS mobiles
  FROM contacts GROUP BY k)"""
EVENT_ROWS = """
FROM vault_people v LEFT JOIN listed l ON l.k = v.k WHERE v.k % 4 = 0 OR v.market = 'DK'"""


def fixture_events(spark, sf):
    as_of = F.lit("2024-03-01 06:00:00").cast("timestamp")
    return events.build(flagged_vault(spark, sf), fx.compliance_events(spark, sf), as_of)


@query(
    "anonymisation_events",
    EVENT_SQL
    + """
SELECT national_id, customer_id, coalesce(emails, 'null') AS emails, coalesce(mobiles, 'null') AS mobile_phones, market,
  last_brand_interaction, email AS latest_email, mobile_phone AS latest_mobile, compliance_event"""
    + EVENT_ROWS,
    "vault_people contacts",
)
def anonymisation_events(spark, sf):
    """Events of people flagged within the last twelve hours."""
    rows = fixture_events(spark, sf)
    joined = {c: F.array_join(c, ",") for c in ("emails", "mobile_phones")}
    return rows.withColumns(joined)


MARKETS = {"SE": ["se_one", "se_two"], "NO": ["no_one"], "FI": "fi_one", "DK": None}


@query(
    "route_and_hash",
    """
SELECT v.customer_id, p.project, sha256(national_id) AS ssn, nullif(email, '') AS registered, mobile_phone AS phone
FROM vault_people v LEFT JOIN (VALUES ('SE', 'se_one'), ('SE', 'se_two'), ('NO', 'no_one'), ('FI', 'fi_one')) p(m, project)
  ON p.m = v.market WHERE v.k % 4 = 0 OR v.market = 'DK'""",
    "vault_people",
)
def route_and_hash(spark, sf):
    """Messages read back, hashed and routed; markets without projects stay unrouted."""
    messages = events.to_messages(fixture_events(spark, sf))
    typed = events.read_messages(messages)
    routed = events.route(typed, MARKETS)
    ids = F.from_json("payload", "customer_ids struct<SSN:string,registered:string,phone:string>")
    opened = routed.withColumn("ids", ids)
    back = typed.select("message_id", "customer_id")
    return opened.join(back, "message_id").select(
        "customer_id",
        "project",
        F.col("ids.customer_ids.SSN").alias("ssn"),
        F.col("ids.customer_ids.registered").alias("registered"),
        F.col("ids.customer_ids.phone").alias("phone"),
    )


def flaky_transport():
    """Receiver whose answer depends on the phone number in the payload only."""

    def send(payload: str, project: str) -> int:
        import json

        phone = json.loads(payload)["customer_ids"].get("phone", "0")
        if int(phone[-1]) % 3 == 0 and project == "se_one":
            return 503
        if int(phone[-1]) % 5 == 0:
            return 404
        if int(phone[-2:]) % 7 == 0:
            raise ConnectionError("line is down")
        return 200

    return send


def outcome_sql(select: str) -> str:
    return (
        """
WITH sent AS (SELECT v.k, p.project, CASE WHEN p.project IS NULL THEN FALSE
    WHEN coalesce(right(mobile_phone, 1), '0')::INT % 3 = 0 AND p.project = 'se_one' THEN FALSE
    WHEN coalesce(right(mobile_phone, 1), '0')::INT % 5 = 0 THEN FALSE
    WHEN coalesce(right(mobile_phone, 2), '0')::INT % 7 = 0 THEN FALSE ELSE TRUE END AS ok
  FROM vault_people v
  LEFT JOIN (VALUES ('SE', 'se_one'), ('SE', 'se_two'), ('NO', 'no_one'), ('FI', 'fi_one')) p(m, project)
    ON p.m = v.market WHERE v.k % 4 = 0 OR v.market = 'DK'),
  messages AS (SELECT k, bool_or(ok) AS ok FROM sent GROUP BY k)
"""
        + select
    )


COUNTS = """SELECT project, count(*) AS succeeded, 0 AS failed FROM sent WHERE ok GROUP BY project
UNION ALL SELECT NULL, count_if(ok), count_if(NOT ok) FROM messages"""


@query("delivery_counts", outcome_sql(COUNTS), "vault_people")
def delivery_counts(spark, sf):
    """Delivery outcomes counted per project and per message."""
    ship_package(spark)
    typed = events.read_messages(events.to_messages(fixture_events(spark, sf)))
    delivered, dead = events.deliver(events.route(typed, MARKETS), flaky_transport(), attempts=2, backoff=0.0, senders=8)
    return events.counts(delivered.unionByName(dead))


@query(
    "deliver_dead_letter",
    """
SELECT CASE WHEN k % 5 = 0 THEN 'dead' ELSE 'sent' END AS outcome, CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS attempts,
  count(*) AS n FROM vault_people WHERE k % 4 = 0 OR market = 'DK' GROUP BY 1, 2""",
    "vault_people",
)
def deliver_dead_letter(spark, sf):
    """Publishing with two attempts; what fails twice lands in the dead-letter table."""
    ship_package(spark)

    def topic(payload: str, project: str) -> int:
        import json

        if json.loads(payload)["customer_id"]["long"] % 5 == 0:
            raise ConnectionError("topic unavailable")
        return 200

    sent, dead = events.publish(fixture_events(spark, sf), topic, backoff=0.0)
    labelled = sent.withColumn("outcome", F.lit("sent")).unionByName(dead.withColumn("outcome", F.lit("dead")))
    return labelled.groupBy("outcome", "attempts").agg(F.count(F.lit(1)).alias("n"))


@query("stream_consume", outcome_sql(COUNTS), "vault_people")
def stream_consume(spark, sf):
    """The same deliveries from a drained message stream."""
    ship_package(spark)
    root = scratch_dir(spark, "consume")
    events.to_messages(fixture_events(spark, sf)).write.json(f"{root}/in")
    consume_stream(
        spark, f"{root}/in", MARKETS, flaky_transport(), f"{root}/out", f"{root}/state", attempts=2, backoff=0.0
    ).awaitTermination()
    return events.counts(spark.read.schema(events.RESULT_SCHEMA).parquet(f"{root}/out").select(*events.RESULT_SCHEMA.names))


@query("stream_dedupe", "SELECT DISTINCT xid, xoffset, ts FROM change_events", "change_events")
def stream_dedupe(spark, sf):
    """Change stream without repeats inside the watermark."""
    root = scratch_dir(spark, "dedupe")
    changes = fx.change_events(spark, sf)
    changes.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(changes.schema).parquet(f"{root}/in")
    unique = dedupe_stream(stream).select("xid", "xoffset", "ts")
    unique.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").option(
        "path", f"{root}/out"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(
    "stream_canonical",
    """
SELECT xid, xoffset, ts, source, data
FROM (SELECT xid, xoffset, ts, source, CASE WHEN source = 'replica' THEN NULL ELSE data END AS data FROM change_events)
QUALIFY row_number() OVER (PARTITION BY xid, xoffset, ts ORDER BY source DESC, data DESC NULLS LAST) = 1""",
    "change_events",
)
def stream_canonical(spark, sf):
    """Differing repeats over two drains of a stream: in time, out of order and after the watermark, as the batch form."""
    ship_package(spark)
    root = scratch_dir(spark, "canonical")
    changes = fx.change_events(spark, sf).select(
        "xid", "xoffset", "ts", "source", F.when(F.col("source") != "replica", F.col("data")).alias("data")
    )
    # Two thirds of the repeats from the replica come with the second drain, when the watermark has passed most of them.
    second = (F.col("source") == "replica") & (F.col("xoffset") % 3 != 0)
    for part in (changes.filter(~second), changes.filter(second)):
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(changes.schema).parquet(f"{root}/in")
        write_canonical(stream, f"{root}/out", f"{root}/state", delay="1 day").awaitTermination()
    return settled(spark, f"{root}/out", f"{root}/state", changes.schema)
