"""SQL form of the fixtures in ``fixtures.py`` (DuckDB dialect), independent of Spark."""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "people": (
        (),
        """
SELECT c_custkey AS k,
  CASE c_nationkey % 4 WHEN 0 THEN 'SE' WHEN 1 THEN 'NO' WHEN 2 THEN 'FI' ELSE 'DK' END AS market,
  CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 29 = 0 THEN '0' WHEN c_custkey % 31 = 0 THEN 'anonymized'
    WHEN c_nationkey % 4 = 2 THEN lpad(c_custkey::VARCHAR, 8, '0') || '-' || (c_custkey * 7 % 10)::VARCHAR || 'a'
    ELSE lpad(c_custkey::VARCHAR, 8, '0') || '-' || lpad((c_custkey * 7 % 10000)::VARCHAR, 4, '0') END AS national_id,
  CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 37 = 0 THEN 'Anonymized'
    ELSE 'user' || c_custkey || '@example.com' END AS email,
  CASE c_custkey % 8
    WHEN 0 THEN '0' || lpad(c_custkey::VARCHAR, 9, '0')
    WHEN 1 THEN '358' || lpad(c_custkey::VARCHAR, 8, '0')
    WHEN 2 THEN '+46 ' || lpad(c_custkey::VARCHAR, 8, '0')
    WHEN 3 THEN lpad(c_custkey::VARCHAR, 8, '0')
    WHEN 4 THEN '047' || lpad(c_custkey::VARCHAR, 8, '0')
    WHEN 5 THEN '0047' || lpad(c_custkey::VARCHAR, 8, '0')
    WHEN 6 THEN ' +45' || lpad(c_custkey::VARCHAR, 8, '0')
    ELSE '46' || lpad(c_custkey::VARCHAR, 8, '0') END AS phone,
  c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
FROM customer""",
    ),
    "clean_people": (
        ("people",),
        """
SELECT *,
  CASE market
    WHEN 'SE' THEN left(regexp_replace(national_id, '[^0-9]', '', 'g'), 12)
    WHEN 'NO' THEN left(regexp_replace(national_id, '[^0-9]', '', 'g'), 11)
    WHEN 'DK' THEN left(regexp_replace(national_id, '[^0-9]', '', 'g'), 10)
    ELSE left(regexp_replace(upper(national_id), '[^0-9+A-Z-]', '', 'g'), 11) END AS ssn,
  regexp_replace(phone, '[^0-9 ]', '', 'g') AS d,
  CASE WHEN left(phone, 2) = ' +' THEN substring(phone, 2)
    WHEN phone LIKE '%+%' THEN
      CASE WHEN length(replace(phone, ' ', '')) BETWEEN 7 AND 17 THEN replace(phone, ' ', '') END
    WHEN market = 'FI' THEN CASE
      WHEN left(phone, 3) = '358' THEN CASE WHEN length(d) BETWEEN 9 AND 15 THEN '+' || d END
      WHEN left(phone, 1) = '0' THEN CASE WHEN length(d) BETWEEN 7 AND 13 THEN '+358' || substring(d, 2) END
      WHEN length(d) BETWEEN 6 AND 12 THEN '+358' || d END
    WHEN market IN ('SE', 'DK') THEN CASE
      WHEN left(phone, 2) = CASE market WHEN 'SE' THEN '46' ELSE '45' END THEN '+' || phone
      WHEN left(phone, 3) = CASE market WHEN 'SE' THEN '046' ELSE '045' END THEN '+' || substring(phone, 2)
      WHEN left(phone, 4) = CASE market WHEN 'SE' THEN '0046' ELSE '0045' END THEN '+' || substring(phone, 3)
      WHEN left(phone, 1) = '0' THEN CASE market WHEN 'SE' THEN '+46' ELSE '+45' END || substring(phone, 2)
      ELSE CASE market WHEN 'SE' THEN '+46' ELSE '+45' END || phone END
    ELSE CASE
      WHEN left(phone, 2) = '47' THEN CASE WHEN length(d) = 10 THEN '+' || d END
      WHEN left(phone, 3) = '047' AND length(d) = 11 THEN '+' || substring(d, 2)
      WHEN left(phone, 4) = '0047' AND length(d) = 12 THEN '+' || substring(d, 3)
      WHEN left(phone, 1) = '0' THEN CASE WHEN length(d) = 9 THEN '+47' || substring(d, 2) END
      WHEN length(d) = 8 THEN '+47' || d END
  END AS mobile
FROM people""",
    ),
    "contacts": (
        ("clean_people",),
        """
SELECT k, ssn, market, o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN 'shared' || (o_custkey % 50) || '@example.com'
    WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'user' || o_custkey || '@example.com' END AS email,
  mobile AS mobile_phone,
  CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'alpha' ELSE 'beta' END AS stack,
  o_orderdate AS created_at, o_orderkey::VARCHAR AS loan_application_oid
FROM orders JOIN clean_people ON k = o_custkey""",
    ),
    "events_of": (
        ("clean_people",),
        """
SELECT k, ssn AS national_id, k AS customer_id, market, email, mobile AS mobile_phone,
  segment AS last_brand_interaction,
  CASE WHEN k % 19 = 0 THEN 'flag_gdpr_5_year_complaint' ELSE 'flag_retention' END AS compliance_event,
  CASE WHEN k % 13 = 0 THEN 'invalid' ELSE 'valid' END AS is_valid_national_id
FROM clean_people WHERE k % 23 <> 0 AND k % 29 <> 0 AND k % 31 <> 0""",
    ),
    "vault_people": (
        ("events_of",),
        """
SELECT * FROM events_of WHERE k % 10 <> 0 AND k % 19 <> 0 AND k % 13 <> 0""",
    ),
    "vault_contacts": (
        ("contacts", "vault_people"),
        """
SELECT c.* FROM contacts c WHERE c.k IN (SELECT k FROM vault_people)""",
    ),
    "email_keys": (
        ("vault_contacts",),
        """
SELECT email AS key, k FROM vault_contacts WHERE email <> ''
QUALIFY row_number() OVER (PARTITION BY email ORDER BY created_at DESC, k) = 1""",
    ),
    "mobile_keys": (
        ("vault_contacts",),
        """
SELECT DISTINCT mobile_phone AS key FROM vault_contacts WHERE mobile_phone <> ''""",
    ),
    "change_events": (
        (),
        """
SELECT event_type AS "table", user_id AS xid, event_id AS xoffset, floor(epoch(ts))::BIGINT AS ts, 'history' AS source,
  'insert' AS type, 'shop' AS database, props AS data FROM events
UNION ALL
SELECT event_type, user_id, event_id, floor(epoch(ts))::BIGINT, 'replica', 'insert', 'shop', props FROM events
WHERE event_id % 5 = 0""",
    ),
    "versions": (
        (),
        """
SELECT o_orderkey AS k, v AS __v, o_orderkey::VARCHAR AS _id, o_custkey,
  CASE WHEN v = 3 AND o_orderkey % 7 = 0 THEN 'delete' WHEN v = 1 AND o_orderkey % 97 = 0 THEN NULL
    ELSE 'update' END AS operationType,
  CASE WHEN v = 2 AND o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate + to_days(v) END AS updatedAt,
  o_orderdate + to_days(v * 2) AS time_archived, o_orderdate AS createdAt, o_totalprice * v AS amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'SE' WHEN 1 THEN 'NO' WHEN 2 THEN 'FI' ELSE 'DK' END AS market,
  CASE o_orderkey % 3
    WHEN 0 THEN 'https://x.example.com/?gclid=g' || o_orderkey || '&fbclid=f' || v
    WHEN 1 THEN 'https://x.example.com/?scid=&msclkid=m' || o_orderkey END AS originReference,
  CASE WHEN o_orderkey % 6 = 0 THEN 'www.second.example' WHEN o_orderkey % 6 = 1 THEN NULL
    ELSE 'www.first.example' END AS domain,
  v = 2 AS sent,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + to_days(v) END AS accepted_at,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate - to_days(v) END AS bid_date,
  CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate + to_days(2) WHEN o_orderkey % 4 = 2 THEN o_orderdate END AS paid_at,
  CASE WHEN v = 1 AND o_orderkey % 9 = 0 THEN o_orderdate + to_days(30) END AS letter_date,
  o_orderkey % 2 = 0 AS has_co_applicant
FROM orders, (VALUES (1), (2), (3)) t(v)""",
    ),
    "live_versions": (
        ("versions",),
        """
SELECT * FROM versions WHERE operationType <> 'delete'""",
    ),
    "current_docs": (
        ("live_versions",),
        """
SELECT * FROM live_versions QUALIFY row_number() OVER (PARTITION BY _id
  ORDER BY __v DESC, coalesce(updatedAt, TIMESTAMP '1990-01-01') DESC, time_archived DESC) = 1""",
    ),
    "version_lines": (
        ("versions",),
        """
SELECT k, __v, l_linenumber AS linenumber, l_partkey AS partkey, l_quantity AS quantity
FROM versions JOIN lineitem ON l_orderkey = k
WHERE k % 11 <> 0 AND k % 13 <> 0 AND (__v = 1 OR l_linenumber <= __v)""",
    ),
    "order_lines": (
        (),
        """
SELECT l_orderkey AS k, l_linenumber AS linenumber, l_partkey AS partkey, l_quantity AS quantity FROM lineitem
WHERE l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0""",
    ),
    "tag_list": (
        (),
        """
SELECT * FROM (VALUES (1, 'ring', 't1', 'email'), (2, 'widget', 't2', 'email'), (3, 'blue', 't3', 'phone'),
  (4, 'blue_bolt', 't4', 'ssn'), (5, 'red', 't5', 'name'), (6, 'Small_Ring', 't6', 'ssn'), (7, 'red_widget', 't7', 'phone'),
  (8, 'smallring', 't8', 'ssn')) v(ordinal, display_name, policy_tag_id, parent)""",
    ),
    "part_columns": (
        (),
        """
SELECT 'ds' || (p_partkey % 3) AS table_schema, 'tbl' || lower(replace(p_brand, '#', '')) ||
  CASE p_size % 2 WHEN 0 THEN '_r' ELSE '_p' END AS table_name,
  CASE WHEN p_partkey % 6 = 0 THEN 'payload' ELSE leaf END AS column_name,
  CASE WHEN p_partkey % 6 = 0 THEN 'payload.' || leaf ELSE leaf END AS field_path, leaf,
  CASE p_size % 4 WHEN 0 THEN 'STRING' WHEN 1 THEN 'INT64' WHEN 2 THEN 'BOOL' ELSE 'STRING' END AS data_type,
  p_partkey AS ordinal
FROM (SELECT *, CASE WHEN p_partkey % 97 = 0 THEN 'ssn' WHEN p_partkey % 89 = 1 THEN 'Email_Address'
    WHEN p_partkey % 83 = 2 THEN 'mobile_phone' WHEN p_partkey % 79 = 3 THEN 'loan_application_id'
    ELSE replace(p_name, ' ', '_') || CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '_no'
      ELSE (p_partkey % 7)::VARCHAR END END AS leaf FROM part)""",
    ),
    "tree_rows": (
        (),
        """
SELECT s_suppkey, 'high' AS level, 'PII' AS category, 'p' || s_suppkey AS parent, 'c' || s_suppkey || '_' || i AS child,
  CASE WHEN i = 1 THEN 'SHA256' ELSE 'DEFAULT_MASKING_VALUE' END AS masking_rule, 'SHA256' AS parent_masking_rule
FROM supplier, (VALUES (1), (2)) t(i) WHERE i <= s_suppkey % 3
UNION ALL
SELECT s_suppkey, 'medium', 'restricted', 'q' || s_suppkey, 'd' || s_suppkey, 'ALWAYS_NULL', 'DEFAULT_MASKING_VALUE'
FROM supplier WHERE s_suppkey % 2 = 0""",
    ),
    "model_columns": (
        (),
        """
SELECT 'm' || (p_partkey // 20) AS m, p_partkey AS pk, 'c' || p_partkey AS c,
  CASE p_size % 3 WHEN 0 THEN 'STRING' WHEN 1 THEN 'INT64' ELSE 'TIMESTAMP' END AS data_type FROM part""",
    ),
    "edges": (
        ("model_columns",),
        """
SELECT m || '_r' AS model, c AS target_column, m || '_r' AS source_model, c AS source_column, data_type FROM model_columns
UNION ALL SELECT DISTINCT m || '_r', 'id', m || '_r', 'id', 'INT64' FROM model_columns
UNION ALL SELECT m || '_p', CASE WHEN pk % 2 = 0 THEN 'x' || pk ELSE c END, m || '_r', c, data_type FROM model_columns
  WHERE pk % 10 <> 3
UNION ALL SELECT DISTINCT a.m || '_p', 'id', coalesce(b.m, a.m) || '_r', 'id', 'INT64' FROM model_columns a
  LEFT JOIN (SELECT DISTINCT m FROM model_columns) b ON b.m = 'm' || (substring(a.m, 2)::INT + 1)
UNION ALL SELECT m || '_s', c, m || '_p', c, data_type FROM model_columns""",
    ),
}


def compose(needs: list[str], sql: str) -> str:
    """``WITH`` the named fixtures and what they build on, then the query."""
    order: list[str] = []

    def add(name: str) -> None:
        for inner in CTES[name][0]:
            add(inner)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return sql.strip()
    body = ",\n".join(f"{name} AS ({CTES[name][1]}\n)" for name in order)
    text = sql.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {body},\n{text[5:]}"
    return f"WITH {body}\n{text}"
