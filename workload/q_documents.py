"""Versioned documents and loan records."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilmark.plans import documents, loans

from . import fixtures as fx
from .registry import query

BRANDS = documents.Brands("second", "second", "first")


def stamp(column, fmt="yyyy-MM-dd"):
    return F.date_format(column, fmt)


def current(spark, sf):
    """Current documents.  Every query reads a few of their columns, and only those are built."""
    return documents.latest_documents(fx.documents(spark, sf), BRANDS)


@query(
    "latest_documents",
    """
SELECT d._id AS application_id, d.__v AS versions, d.sent AS is_status_sent, 'mongodb' AS source_database,
  CASE WHEN d.domain LIKE '%second%' THEN 'second' ELSE 'first' END AS brand, coalesce(n, 0) AS loans
FROM current_docs d LEFT JOIN (SELECT k, max(n) AS n FROM (SELECT k, __v, count(*) AS n FROM version_lines GROUP BY 1, 2)
  GROUP BY k) l ON l.k = d.k""",
    "current_docs version_lines",
)
def latest_documents(spark, sf):
    """Current documents with the longest loan array of any version."""
    return current(spark, sf).select(
        "application_id",
        "versions",
        "is_status_sent",
        "source_database",
        "brand",
        F.size("loans").cast("bigint").alias("loans"),
    )


@query(
    "applications",
    """
WITH fixed AS (SELECT _id, accepted_at, bid_date, paid_at FROM live_versions
    WHERE accepted_at <= paid_at QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC) = 1),
  letters AS (SELECT _id, letter_date FROM live_versions WHERE letter_date IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC) = 1)
SELECT d._id AS application_id, d.__v AS versions, d.amount, d.amount AS "acceptedBidamount", d.market,
  d.k % 3 = 0 AS payslip, d.sent AS statussent, 's' || d.__v AS text, d.domain, 'mail' AS medium,
  lpad(d.o_custkey::VARCHAR, 10, '0') AS national_id,
  strftime(CASE WHEN f._id IS NOT NULL THEN f.accepted_at WHEN d.accepted_at > d.paid_at THEN d.paid_at
    ELSE d.accepted_at END, '%Y-%m-%d') AS "acceptedAt",
  strftime(CASE WHEN f._id IS NOT NULL THEN f.bid_date ELSE d.bid_date END, '%Y-%m-%d') AS "acceptedBidDate",
  strftime(CASE WHEN f._id IS NOT NULL THEN f.paid_at ELSE d.paid_at END, '%Y-%m-%d') AS "paymentStatusDate",
  strftime(coalesce(d.letter_date, l.letter_date), '%Y-%m-%d') AS "debtLetterDate",
  CASE WHEN originReference LIKE '%gclid=%' THEN regexp_extract(originReference, 'gclid=([^&]*)', 1) END AS gclid,
  CASE WHEN originReference LIKE '%scid=%' THEN regexp_extract(originReference, 'scid=([^&]*)', 1) END AS snapchat_id,
  CASE WHEN originReference LIKE '%msclkid=%' THEN regexp_extract(originReference, 'msclkid=([^&]*)', 1) END
    AS microsoft_click_id
FROM current_docs d LEFT JOIN fixed f ON f._id = d._id LEFT JOIN letters l ON l._id = d._id""",
    "current_docs",
)
def applications(spark, sf):
    """Flat applications with rectified dates and click ids."""
    rows = documents.applications(fx.documents(spark, sf), "Owner", BRANDS)
    dates = [stamp(c).alias(c) for c in ("acceptedAt", "acceptedBidDate", "paymentStatusDate", "debtLetterDate")]
    return rows.select(
        "application_id",
        "versions",
        "amount",
        "acceptedBidamount",
        "market",
        "payslip",
        "statussent",
        "text",
        "domain",
        "medium",
        "national_id",
        *dates,
        "gclid",
        "snapchat_id",
        "microsoft_click_id",
    )


@query(
    "all_versions",
    """
SELECT _id AS application_id, __v AS versions, amount, market, sent AS statussent, domain,
  CASE WHEN domain LIKE '%second%' THEN 'second' ELSE 'first' END AS brand,
  CASE WHEN originReference LIKE '%fbclid=%' THEN regexp_extract(originReference, 'fbclid=([^&]*)', 1) END AS fbclid
FROM live_versions""",
    "live_versions",
)
def all_versions(spark, sf):
    """Every live version, flat."""
    rows = documents.all_versions(fx.documents(spark, sf), brands=BRANDS)
    return rows.select("application_id", "versions", "amount", "market", "statussent", "domain", "brand", "fbclid")


def member_sql(members: dict[str, str], row: str, skip: tuple[str, ...] = ()) -> str:
    """Every published member of a fixture row, as a select list."""
    parts = []
    for name, path in members.items():
        name, path = name.format(owner="Owner"), path.format(owner="Owner")
        if name in skip:
            continue
        real = fx.REAL_MEMBERS.get(path)
        parts.append((f"{row}.{real}" if real else f"'{path}-' || {row}.k || '-' || {row}.__v") + f' AS "{name}"')
    return ", ".join(parts)


OUTER_SQL = """{row}.__v, {row}.operationType AS "operationType", strftime({row}.updatedAt, '%Y-%m-%d') AS "updatedAt",
  strftime({row}.time_archived, '%Y-%m-%d') AS time_archived, strftime({row}.createdAt, '%Y-%m-%d') AS "createdAt",
  {row}.amount, {row}.market, {row}.originReference AS "originReference", {row}._id AS application_id,
  {row}.__v AS versions, CASE WHEN {row}.domain LIKE '%second%' THEN 'second' ELSE 'first' END AS brand,
  'mongodb' AS source_database"""


def click_sql(row: str, names: tuple[str, ...]) -> str:
    return ", ".join(
        f"CASE WHEN {row}.originReference LIKE '%{p}=%' THEN regexp_extract({row}.originReference, '{p}=([^&]*)', 1) END AS {n}"
        for n, p in documents.CLICK_IDS.items()
        if n in names
    )


def all_paths() -> list[str]:
    return [p.format(owner="Owner") for p in (documents.MEMBERS | documents.HISTORY_MEMBERS).values()]


def stamped(df):
    """Times as dates, so that both engines show them alike."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: stamp(c) for c in times})


@query(
    "applications_full",
    f"""
WITH fixed AS (SELECT _id, accepted_at, bid_date, paid_at FROM live_versions
    WHERE accepted_at <= paid_at QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC) = 1),
  letters AS (SELECT _id, letter_date FROM live_versions WHERE letter_date IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC) = 1)
SELECT {OUTER_SQL.format(row="d")}, strftime(d.updatedAt, '%Y-%m-%d') AS updated_at,
  {member_sql(documents.MEMBERS, "d")}, {click_sql("d", tuple(documents.CLICK_IDS))},
  strftime(CASE WHEN f._id IS NOT NULL THEN f.accepted_at WHEN d.accepted_at > d.paid_at THEN d.paid_at
    ELSE d.accepted_at END, '%Y-%m-%d') AS "acceptedAt",
  strftime(CASE WHEN f._id IS NOT NULL THEN f.bid_date ELSE d.bid_date END, '%Y-%m-%d') AS "acceptedBidDate",
  strftime(CASE WHEN f._id IS NOT NULL THEN f.paid_at ELSE d.paid_at END, '%Y-%m-%d') AS "paymentStatusDate",
  strftime(coalesce(d.letter_date, l.letter_date), '%Y-%m-%d') AS "debtLetterDate"
FROM current_docs d LEFT JOIN fixed f ON f._id = d._id LEFT JOIN letters l ON l._id = d._id""",
    "current_docs",
)
def applications_full(spark, sf):
    """Every column of the flat applications, all published members present."""
    return stamped(documents.applications(fx.member_versions(spark, sf, all_paths(), ranges=True), "Owner", BRANDS))


@query(
    "all_versions_full",
    f"""
SELECT {OUTER_SQL.format(row="v")}, {member_sql(documents.HISTORY_MEMBERS | documents.MEMBERS, "v", documents.CURRENT_ONLY)},
  {click_sql("v", ("gclid", "fbclid"))}
FROM live_versions v""",
    "live_versions",
)
def all_versions_full(spark, sf):
    """Every column of every live version, all published members present."""
    return stamped(documents.all_versions(fx.member_versions(spark, sf, all_paths(), ranges=True), brands=BRANDS))


@query(
    "all_versions_slim",
    """
SELECT DISTINCT _id AS application_id, amount, strftime(createdAt, '%Y-%m-%d') AS created,
  strftime(updatedAt, '%Y-%m-%d') AS updated, sent AS statussent, strftime(time_archived, '%Y-%m-%d') AS archived
FROM live_versions""",
    "live_versions",
)
def all_versions_slim(spark, sf):
    """Six columns of every live version without repeats."""
    rows = documents.all_versions(fx.documents(spark, sf), slim=True)
    return rows.select(
        "application_id",
        "amount",
        stamp("createdAt").alias("created"),
        stamp("updated_at").alias("updated"),
        "statussent",
        stamp("time_archived").alias("archived"),
    )


@query(
    "child_loans",
    """
SELECT d._id AS application_id, d.__v AS versions, d.sent AS is_status_sent, l.linenumber, l.partkey, l.quantity
FROM current_docs d JOIN version_lines l ON l.k = d.k AND l.__v = 1""",
    "current_docs version_lines",
)
def child_loans(spark, sf):
    """Loans of the repaired arrays (the first version always holds all lines)."""
    rows = documents.child_table(current(spark, sf), "loans")
    return rows.select("application_id", "versions", "is_status_sent", "linenumber", "partkey", "quantity")


@query(
    "child_tables",
    """
SELECT d._id AS application_id, d.__v AS versions, l.partkey AS bank, l.quantity AS interest, l.linenumber = 1 AS payslip,
  l.linenumber > 2 AS "taxReturn", 'u' || l.partkey AS "user", 'agent' AS name
FROM current_docs d JOIN version_lines l ON l.k = d.k AND l.__v = d.__v""",
    "current_docs version_lines",
)
def child_tables(spark, sf):
    """Bids with two inner structs expanded."""
    rows = documents.child_table(current(spark, sf), "bids", expand=("requiredDocs", "placedBy"))
    return rows.select("application_id", "versions", "bank", "interest", "payslip", "taxReturn", "user", "name")


@query(
    "child_estates",
    """
SELECT d._id AS application_id, d.market, l.partkey AS "estateId", l.quantity AS value
FROM current_docs d JOIN version_lines l ON l.k = d.k AND l.__v = d.__v""",
    "current_docs version_lines",
)
def child_estates(spark, sf):
    """Estates with their document's market."""
    rows = documents.child_table(current(spark, sf), "estates", extra=("market",))
    return rows.select("application_id", "market", "estateId", "value")


@query(
    "child_nested_path",
    """
SELECT d._id AS application_id, l.linenumber AS step FROM current_docs d
JOIN version_lines l ON l.k = d.k AND l.__v = d.__v""",
    "current_docs version_lines",
)
def child_nested_path(spark, sf):
    """Array inside a struct."""
    return documents.child_table(current(spark, sf), "utm.history").select("application_id", "step")


@query(
    "person_partner_union",
    """
SELECT _id || '|' || CASE WHEN k % 5 <> 0 THEN 'person' || o_custkey ELSE lpad(o_custkey::VARCHAR, 10, '0') END
    AS application_applicant_id,
  CASE WHEN k % 5 <> 0 THEN 'person' || o_custkey END AS applicant_id,
  'person' || o_custkey || '@example.com' AS email, 'person' AS applicant_type, market
FROM current_docs
UNION ALL
SELECT _id || '|' || CASE WHEN k % 5 <> 0 THEN 'partner' || (o_custkey + 1) ELSE lpad((o_custkey + 1)::VARCHAR, 10, '0') END,
  CASE WHEN k % 5 <> 0 THEN 'partner' || (o_custkey + 1) END,
  'partner' || (o_custkey + 1) || '@example.com', 'partner', market
FROM current_docs WHERE has_co_applicant""",
    "current_docs",
)
def person_partner_union(spark, sf):
    """Applicants; a person without id falls back to the id number."""
    rows = documents.applicants(current(spark, sf))
    return rows.select("application_applicant_id", "applicant_id", "email", "applicant_type", "market")


REPORTS = """
SELECT d.*, r.role, r.shift, l.linenumber, l.partkey, l.quantity
FROM current_docs d JOIN version_lines l ON l.k = d.k AND l.__v = d.__v,
  (VALUES ('person', 0), ('partner', 1)) r(role, shift)
WHERE r.role = 'person' OR d.k % 2 = 0"""


@query(
    "credit_reports",
    f"""
SELECT CASE WHEN k % 5 <> 0 THEN _id || '|' || role || (o_custkey + shift) END AS customer_id,
  lpad((o_custkey + shift)::VARCHAR, 10, '0') AS id_number,
  _id || '|' || role[1] || linenumber || '/' || partkey AS credit_report_id, quantity AS score, partkey AS income, market
FROM ({REPORTS})""",
    "current_docs version_lines",
)
def credit_reports(spark, sf):
    """Credit reports of person and partner."""
    rows = documents.credit_reports(current(spark, sf))
    return rows.select(
        "customer_id",
        F.col("idNumber").alias("id_number"),
        "credit_report_id",
        F.col("creditScore").alias("score"),
        F.col("lastYeartaxableIncome").alias("income"),
        "market",
    )


@query(
    "two_level_explode",
    f"""
SELECT _id || '|' || role[1] || linenumber || '/' || partkey AS credit_report_id, 'asker' || n AS name, n AS day,
  linenumber || '-' || n AS request_id
FROM ({REPORTS}), (VALUES (1), (2)) t(n) WHERE linenumber <> 2""",
    "current_docs version_lines",
)
def two_level_explode(spark, sf):
    """Past requests inside credit reports."""
    rows = documents.past_requests(current(spark, sf))
    return rows.select(
        "credit_report_id",
        F.col("past_report_requests_name").alias("name"),
        F.col("past_report_requests_date").alias("day"),
        F.col("past_report_requests_id").alias("request_id"),
    )


@query(
    "invitations",
    """
SELECT 'i' || o_orderkey AS invite_id, o.o_custkey AS application, 2 AS versions,
  CASE WHEN d._id IS NOT NULL THEN CASE WHEN d.domain LIKE '%second%' THEN 'second' ELSE 'first' END END AS brand
FROM orders o LEFT JOIN current_docs d ON d.k = o.o_custkey WHERE o.o_orderkey % 8 NOT IN (0, 1)""",
    "current_docs",
)
def invitations(spark, sf):
    """Live invitations with the brand of their application."""
    o = F.col("o_orderkey")
    invites = fx.table(spark, sf, "orders").select(
        F.concat(F.lit("i"), fx.text(o)).alias("_id"),
        fx.text(F.col("o_custkey")).alias("application"),
        F.lit(2).alias("__v"),
        F.when(o % 8 == 0, F.lit("delete")).when(o % 8 != 1, F.lit("insert")).alias("operationType"),
    )
    rows = documents.invitations(invites, current(spark, sf))
    return rows.select("invite_id", F.col("application").cast("bigint").alias("application"), "versions", "brand")


@query(
    "passthrough_latest",
    """
SELECT _id, __v, amount FROM live_versions WHERE createdAt < TIMESTAMP '1999-01-01'
QUALIFY row_number() OVER (PARTITION BY _id ORDER BY __v DESC, time_archived DESC) = 1""",
    "live_versions",
)
def passthrough_latest(spark, sf):
    """Backlog before a date, newest version only."""
    raw = fx.plain_versions(spark, sf).select("_id", "__v", "amount", "operationType", "createdAt", "time_archived")
    return documents.unsubscriptions(raw, before="1999-01-01").select("_id", "__v", "amount")


@query("passthrough_live", "SELECT _id, __v, amount, market FROM live_versions", "live_versions")
def passthrough_live(spark, sf):
    """Live rows as they are."""
    return documents.passthrough(fx.plain_versions(spark, sf)).select("_id", "__v", "amount", "market")


# ------------------------------------------------------------------ loans


def loan_raw(spark, sf):
    """Loan applications with nested applicants; two applications share an applicant id."""
    o = F.col("o_orderkey")
    person = F.floor(o / 2).cast("bigint")

    def job(n: int):
        owner = F.when((o % 5 == 0) & F.lit(n == 2), F.lit(-1)).otherwise(person)
        return F.struct(
            (o * 10 + n).alias("id"),
            owner.cast("bigint").alias("applicant_id"),
            F.concat(F.lit("firm"), fx.text(o % 9)).alias("employer"),
            F.lit("2020-01-02 03:04:05").alias("created_at"),
            F.lit(n).alias("profession"),
        )

    def house(n: int):
        return F.struct((o * 100 + n).alias("id"), person.alias("applicant_id"), F.lit("flat").alias("property_type"))

    def card(n: int):
        owner = F.when(o % 3 == 0, F.lit(-1)).otherwise(person)
        return F.struct(
            (o * 1000 + n).alias("id"),
            owner.cast("bigint").alias("applicant_id"),
            F.lit("2021-01-02 03:04:05").alias("created_at"),
            F.lit("bank").alias("issuer"),
            F.lit(n * 5).alias("debt"),
        )

    jobs = F.when(o % 7 == 0, F.array().cast(f"array<{job_type}>")).otherwise(F.array(job(1), job(2)))
    applicant = F.struct(
        F.when(o % 17 == 0, o + 1).otherwise(o).alias("data_id"),
        person.alias("id"),
        F.lit("2019-05-06 07:08:09").alias("created_at"),
        F.concat(F.lit("ssn"), fx.text(o)).alias("ssn"),
        F.concat(F.lit("mail"), fx.text(o)).alias("email"),
        F.lit("Main Street").alias("address"),
        F.struct(F.lit(9).alias("salary_monthly_net")).alias("spouse"),
        jobs.alias("employments"),
        F.array(house(1), house(2)).alias("housings"),
        F.array(card(1), card(2)).alias("cards"),
        F.array(
            F.struct(
                o.alias("id"), person.alias("applicant_id"), F.lit("marketing").alias("consent_type")
            )
        ).alias("consents"),
        F.array(
            F.struct(o.alias("id"), F.lit(-1).cast("bigint").alias("applicant_id"), F.lit(1.5).alias("amount"))
        ).alias("financials"),
    )
    commission = F.sequence(F.lit(1), (o % 3).cast("int"))
    items = F.when(o % 3 == 0, F.array().cast("array<int>")).otherwise(commission)
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return fx.table(spark, sf, "orders").select(
        o.alias("data_id"),
        at.alias("timestamp"),
        F.when(o % 10 == 0, F.lit("not a date")).otherwise(at).alias("processed_datetime"),
        F.col("o_totalprice").alias("loanamount"),
        F.col("o_orderstatus").alias("status"),
        F.struct(fx.text(o % 4).alias("subid"), F.lit("spring").alias("campaign")).alias("visit"),
        F.struct((o % 2).alias("id"), F.lit("first").alias("brand"), F.lit("x.example").alias("domain")).alias("brand"),
        F.transform(
            items,
            lambda n: F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_date"),
                (n * 10).alias("value"),
                n.alias("bank_id"),
                F.lit("cpl").alias("type"),
            ),
        ).alias("commissions"),
        F.array(applicant).alias("applicants"),
    )


job_type = "struct<id:bigint,applicant_id:bigint,employer:string,created_at:string,profession:int>"


@query(
    "loan_applicants",
    """
WITH rows AS (SELECT o_orderkey AS o, o_orderkey // 2 AS person FROM orders WHERE o_orderkey % 17 <> 0),
  jobs AS (SELECT person, o * 10 + n AS id, 'firm' || (o % 9) AS employer FROM rows, (VALUES (1), (2)) t(n)
    WHERE o % 7 <> 0 AND NOT (n = 2 AND o % 5 = 0)),
  lists AS (SELECT person, string_agg(id || '=' || employer, ',' ORDER BY id) AS jobs FROM jobs GROUP BY person)
SELECT person AS id, 'ssn' || o AS ssn, 'Main Street' AS address, jobs FROM rows LEFT JOIN lists USING (person)
UNION ALL SELECT NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 17 = 0""",
)
def loan_applicants(spark, sf):
    """Applicants out of applications with employments re-nested per applicant."""
    rows = loans.applicants(loan_raw(spark, sf))
    shown = F.transform("employments", lambda e: F.concat_ws("=", fx.text(e.id), e.employer))
    return rows.select("id", "ssn", "address", F.array_join(shown, ",").alias("jobs"))


def applicant_rows(spark, sf):
    return loan_raw(spark, sf).select(F.explode("applicants").alias("a")).select("a.*")


@query(
    "applicant_tables",
    """
WITH a AS (SELECT o_orderkey AS o, o_orderkey // 2 AS person FROM orders)
SELECT CASE WHEN o % 17 = 0 THEN o + 1 ELSE o END::VARCHAR AS data_id, person AS applicant_id,
  '2019-05-06 07:08:09' AS created, 9 AS spouse_salary_monthly_net, o * 100 + h AS housing_id,
  CASE WHEN n IS NOT NULL THEN o * 10 + n END AS employment_id, CASE WHEN n IS NOT NULL THEN 'firm' || (o % 9) END AS employer
FROM a CROSS JOIN (VALUES (1), (2)) hs(h)
LEFT JOIN (VALUES (1), (2)) js(n) ON o % 7 <> 0 AND NOT (n = 2 AND o % 5 = 0)""",
)
def applicant_tables(spark, sf):
    """Applicants by housing and employment."""
    rows = loans.applicant_table(applicant_rows(spark, sf))
    return rows.select(
        "data_id",
        "applicant_id",
        stamp("applicant_created_at", "yyyy-MM-dd HH:mm:ss").alias("created"),
        "spouse_salary_monthly_net",
        "housing_id",
        "employment_id",
        "employer",
    )


@query(
    "applicant_children",
    """
WITH a AS (SELECT o_orderkey AS o, o_orderkey // 2 AS person FROM orders)
SELECT person AS applicant_id, 'card' AS kind, CASE WHEN n IS NOT NULL THEN o * 1000 + n END AS child_id
FROM a LEFT JOIN (VALUES (1), (2)) t(n) ON o % 3 <> 0
UNION ALL SELECT person, 'consent', o FROM a
UNION ALL SELECT person, 'financial', NULL FROM a""",
)
def applicant_children(spark, sf):
    """Cards, consents and financials of applicants."""
    rows = applicant_rows(spark, sf)
    parts = []
    for array, kind in (("cards", "card"), ("consents", "consent"), ("financials", "financial")):
        child = loans.applicant_child(rows, array)
        parts.append(child.select("applicant_id", F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("child_id")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "loan_applications",
    """
SELECT o_orderkey::VARCHAR AS data_id, strftime(o_orderdate, '%Y-%m-%d') AS created,
  CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS processed,
  o_totalprice AS loan_amount, o_orderstatus AS status, (o_orderkey % 4)::VARCHAR AS visit_subid,
  'spring' AS visit_campaign, o_orderkey % 2 AS brand_id, 'first' AS brand, 'x.example' AS brand_domain
FROM orders""",
)
def loan_applications(spark, sf):
    """Applications with visit and brand flattened; unreadable times become NULL."""
    rows = loans.applications(loan_raw(spark, sf))
    return rows.select(
        "data_id",
        stamp("application_created_at").alias("created"),
        stamp("application_processed_at").alias("processed"),
        "loan_amount",
        "status",
        "visit_subid",
        "visit_campaign",
        "brand_id",
        "brand",
        "brand_domain",
    )


@query("drop_child", "SELECT o_orderkey AS data_id, o_totalprice AS loanamount, 7 AS columns FROM orders")
def drop_child(spark, sf):
    """Applications minus their applicants."""
    rows = loans.drop_applicants(loan_raw(spark, sf)).drop("commissions")
    return rows.select("data_id", "loanamount", F.lit(len(rows.columns)).alias("columns"))


@query(
    "commissions",
    """
SELECT o_orderkey::VARCHAR AS data_id, strftime(o_orderdate, '%Y-%m-%d') AS effective, n * 10 AS commission_value,
  n AS commission_bank_id
FROM orders JOIN (VALUES (1), (2)) t(n) ON n <= o_orderkey % 3""",
)
def commissions(spark, sf):
    """Commissions of applications."""
    rows = loans.commissions(loan_raw(spark, sf))
    return rows.select(
        "data_id",
        F.col("effective_date").cast("string").alias("effective"),
        "commission_value",
        "commission_bank_id",
    )


def offer_raw(spark, sf):
    """Offers: one per line, times as text and sometimes unreadable."""
    p, n = F.col("l_partkey"), F.col("l_linenumber")
    day = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    state = F.struct(p.alias("id"), F.col("l_orderkey").alias("data_id"), n.alias("state"))
    none = F.array().cast("array<struct<id:bigint,data_id:bigint,state:int>>")
    return fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("data_id"),
        F.col("l_suppkey").alias("bank_id"),
        F.col("l_discount").alias("apr"),
        F.when(n % 2 == 0, day).alias("paid_datetime"),
        F.when(n % 3 == 0, F.lit("0000")).when(n % 3 == 1, F.lit("1999-01-01 00:00:00")).alias("approved_datetime"),
        F.lit("1998-01-01 00:00:00").alias("api_approved_datetime"),
        F.when(n == 7, none).otherwise(F.array(state)).alias("states"),
    )


OFFER_TIME = """CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
    WHEN l_linenumber % 3 = 1 THEN '1999-01-01' ELSE '1998-01-01' END"""


@query(
    "offers_incremental",
    f"""
SELECT DISTINCT l_orderkey::VARCHAR AS data_id, l_suppkey::VARCHAR AS bank_id, l_discount AS apr, {OFFER_TIME} AS incremental,
  CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS paid,
  CASE WHEN l_linenumber % 3 = 1 THEN '1999-01-01' END AS approved
FROM lineitem""",
)
def offers_incremental(spark, sf):
    """Distinct offers with the first of three times."""
    rows = loans.offers(offer_raw(spark, sf))
    return rows.select(
        "data_id",
        "bank_id",
        "apr",
        stamp("incremental_datetime").alias("incremental"),
        stamp("paid_datetime").alias("paid"),
        stamp("approved_datetime").alias("approved"),
    )


@query(
    "offer_states",
    f"""
SELECT DISTINCT l_orderkey::VARCHAR AS data_id, {OFFER_TIME} AS incremental,
  CASE WHEN l_linenumber <> 7 THEN l_partkey END AS id, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS state
FROM lineitem""",
)
def offer_states(spark, sf):
    """Distinct states of offers."""
    rows = loans.offer_states(offer_raw(spark, sf))
    return rows.select("data_id", stamp("incremental_datetime").alias("incremental"), "id", "state")


@query(
    "clients_clean",
    """
SELECT email, name, k % 2 = 0 AS marketing, k % 3 = 0 AS analytics, CASE WHEN TRY_CAST(national_id AS BIGINT) = 0 THEN NULL
  ELSE left(regexp_replace(upper(national_id), '[^0-9+A-Z-]', '', 'g'), 11) END AS national_id
FROM people""",
    "people",
)
def clients_clean(spark, sf):
    """Clients with consents expanded and ids cleaned."""
    k = F.col("k")
    raw = fx.people(spark, sf).select(
        "email",
        "name",
        F.col("national_id").alias("ssn"),
        F.struct((k % 2 == 0).alias("marketing"), (k % 3 == 0).alias("analytics")).alias("consents"),
    )
    return loans.clients(raw, "FI")


def provider_raw(spark, sf):
    s = F.col("s_suppkey")
    files = F.explode(F.array(F.lit("2024/1/9"), F.lit("2024/1/10"), F.lit("2023/12/31")))
    rows = fx.table(spark, sf, "supplier").withColumn("day", files)
    rules = F.when(s % 3 == 0, F.array(F.lit("approved"), F.lit("paid"))).when(s % 3 == 1, F.array(F.lit("APIapproved")))
    return rows.select(
        s.alias("id"),
        F.concat(F.col("s_name"), F.lit("@"), F.col("day")).alias("name"),
        rules.alias("cpl_rules"),
        F.when(s % 2 == 0, F.array(F.struct(s.alias("fee"), F.lit("x").alias("kind")))).alias("commissions"),
        F.concat(F.lit("gs://bucket/providers/"), F.col("day"), F.lit("/data.json")).alias("file_name"),
    )


@query(
    "providers_latest",
    """
SELECT s_suppkey % 3 = 0 AS cpl_approved, s_suppkey % 3 = 1 AS cpl_api_approved, s_suppkey % 3 = 0 AS cpl_paid,
  s_suppkey AS id, s_name || '@2024/1/10' AS name, '2024-01-10' AS dedupe_date
FROM supplier""",
)
def providers_latest(spark, sf):
    """Provider from its newest file with rule flags."""
    rows = loans.providers(provider_raw(spark, sf))
    return rows.withColumn("dedupe_date", F.col("dedupe_date").cast("string"))


@query(
    "provider_commissions",
    """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS fee, CASE WHEN s_suppkey % 2 = 0 THEN 'x' END AS kind
FROM supplier, (VALUES (1), (2), (3)) t(n)""",
)
def provider_commissions(spark, sf):
    """Commission members, NULLs for providers without."""
    return loans.provider_commissions(provider_raw(spark, sf))


@query(
    "credit_remarks",
    """
SELECT national_id AS ssn_id, name, k AS bisnode_id, k % 2 = 0 AS payment_remark_latest, k % 5 AS payment_remarks_count,
  k % 7 AS other_remarks_count, FALSE AS is_under_guardianship, FALSE AS is_banned_on_business_operations,
  '2024-02-03' AS last_check FROM people""",
    "people",
)
def credit_remarks(spark, sf):
    """Credit remarks with a typed check time."""
    k = F.col("k")
    raw = fx.people(spark, sf).select(
        F.col("national_id").alias("ssn_id"),
        "name",
        k.alias("bisnode_id"),
        (k % 2 == 0).alias("payment_remark_latest"),
        (k % 5).alias("payment_remarks_count"),
        (k % 7).alias("other_remarks_count"),
        F.lit(False).alias("is_under_guardianship"),
        F.lit(False).alias("is_banned_on_business_operations"),
        F.lit("2024-02-03 04:05:06").alias("last_check"),
    )
    return loans.credit_remarks(raw).withColumn("last_check", stamp("last_check"))
