"""The change tables as data: every table's keys, cleaners, floor and layout, from one log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.plans import cdc
from veilmark.session import scratch_dir

from . import fixtures as fx
from .registry import query

# Per change table some of its columns, each with its type, the JSON key and, in SQL, what cleans it.
ONE = "coalesce({v} = '1', false)"
NOT_ZERO = "coalesce({v} <> '0', true)"
NOT_ZERO_OR_NULL = "coalesce({v} <> '0', false)"
FIRST_DATE = "CASE WHEN {v} = '0000-00-00 00:00:00' THEN '1900-01-01 00:00:00' ELSE {v} END"
NULL_DATE = "nullif({v}, '0000-00-00 00:00:00')"
PLAIN = "{v}"
APPLICANT = {
    "id": ("bigint", "id", PLAIN),
    "citizenship": ("string", "country", PLAIN),
    "is_politically_exposed": ("boolean", "is_politically_exposed", ONE),
    "employment_since": ("timestamp", "employment_since", FIRST_DATE),
    "birth_date": ("date", "birth_date", FIRST_DATE),
}
CREATED = {"id": ("bigint", "id", PLAIN), "created_at": ("timestamp", "created_at", PLAIN)}
TRANSFER = {**CREATED, "transfer": ("boolean", "transfer", NOT_ZERO)}
NEWSLETTER = {**CREATED, "accept_newsletter": ("boolean", "accept_newsletter", NOT_ZERO)}
TABLES = {
    "applicant_drafts": APPLICANT,
    "applicants": APPLICANT,
    "bid_accepts": CREATED,
    "bid_additional_requirements": CREATED,
    "bid_logs": CREATED,
    "bids": {
        **CREATED,
        "debt_letter_received": ("boolean", "debt_letter_received", ONE),
        "require_consolidation_specification": ("boolean", "require_consolidation_specification", ONE),
        "debt_letter_sent": ("boolean", "debt_letter_sent", ONE),
        "accepted": ("boolean", "accepted", ONE),
    },
    "cookie_mappings": CREATED,
    "cookies": CREATED,
    "credit_report_latest_inquiries": CREATED,
    "credit_reports": {
        **CREATED,
        "country": ("string", "country", PLAIN),
        "temporary_address": ("string", "temporary_address", "CASE WHEN coalesce({v} <> '0', true) THEN '1' ELSE '0' END"),
    },
    "creditor_products": {
        "id": ("bigint", "id", PLAIN),
        "created_at": ("timestamp", "zero_date", NULL_DATE),
        "updated_at": ("timestamp", "updated_at", NULL_DATE),
        "deactivated_at": ("timestamp", "deactivated_at", NULL_DATE),
        "application_type": ("string", "application_type", "coalesce({v}, 'private')"),
    },
    "creditors": CREATED,
    "current_loan_drafts": TRANSFER,
    "current_loans": TRANSFER,
    "customers": {
        **CREATED,
        "marked_for_delete": ("boolean", "marked_for_delete", NOT_ZERO),
        "valid_national_id": ("boolean", "valid_national_id", NOT_ZERO),
        "birth_date": ("timestamp", "birth_date", FIRST_DATE),
    },
    "invite_logs": CREATED,
    "invites": {**CREATED, "rejected": ("boolean", "rejected", ONE), "declined": ("boolean", "declined", ONE)},
    "loan_application_drafts": NEWSLETTER,
    "loan_application_versions": NEWSLETTER,
    "loan_applications": {
        **CREATED,
        "canceled": ("boolean", "canceled", NOT_ZERO_OR_NULL),
        "self_service": ("boolean", "self_service", NOT_ZERO),
    },
    "pageviews": {**CREATED, "dummy": ("boolean", "dummy", NOT_ZERO)},
    "policies": CREATED,
    "query_params": CREATED,
    "sent_events": CREATED,
}
FLOORED = ("bid_accepts", "bid_additional_requirements", "bid_logs", "bids", "invite_logs", "invites", "loan_application_versions")
WITHOUT_RN = ("bid_accepts", "bid_logs", "credit_report_latest_inquiries")
IN_LOG = {"cookie_mappings": "application_cookie_mappings"}
FLAGS = sorted({key for columns in TABLES.values() for t, key, _ in columns.values() if t == "boolean"} | {"temporary_address"})
DATES = ("employment_since", "birth_date", "updated_at", "deactivated_at", "zero_date")


def declared(name: str) -> T.StructType:
    columns = TABLES[name]
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, (t, _, _) in columns.items()))


def specs() -> list[cdc.TableSpec]:
    return [cdc.spec_from_schema(name, declared(name), rule(name)) for name in TABLES]


def rule(name: str) -> cdc.TableRule:
    """The published rule; one date key is renamed so that it can hold zeros where other tables' must not."""
    published = cdc.TABLE_RULES[name]
    if name != "creditor_products":
        return published
    return cdc.TableRule(published.table, published.keep_rn, published.floor, published.natural_key, published.cleaners, {"created_at": "zero_date"})


def change_log(spark, sf):
    """Events as changes of all tables: flags of four kinds, zero dates, old and new rows, repeats from a second source."""
    e = F.col("event_id")
    names = [IN_LOG.get(n, n) for n in TABLES]
    dates = [F.lit("0000-00-00 00:00:00"), F.lit("2022-03-04 05:06:07"), F.lit(None).cast("string")]

    def one_of(values, shift):
        return F.get(F.array(*values), (e + shift) % len(values))

    flags = [F.lit("1"), F.lit("0"), F.lit("2"), F.lit(None).cast("string")]
    members = [
        e.cast("string").alias("id"),
        F.when(F.floor(e / 25) % 5 == 0, "2020-06-01 00:00:00").otherwise("2022-01-02 03:04:05").alias("created_at"),
        one_of([F.lit("SE"), F.lit("NO"), F.lit('{"code":"FI"}')], 0).alias("country"),
        one_of([F.lit("company"), F.lit(None).cast("string")], 0).alias("application_type"),
        *[one_of(flags, i).alias(name) for i, name in enumerate(FLAGS)],
        *[one_of(dates, i).alias(name) for i, name in enumerate(DATES)],
    ]
    sources = F.when(e % 7 < 2, F.array(F.lit("history"), F.lit("replica"))).otherwise(F.array(F.lit("history")))
    changes = fx.table(spark, sf, "events").select(
        F.get(F.array(*[F.lit(n) for n in [*names, "unknown"]]), e % (len(names) + 1)).alias("table"),
        F.col("user_id").alias("xid"),
        e.alias("xoffset"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        sources.alias("sources"),
        F.to_json(F.struct(*members)).alias("data"),
    )
    return changes.withColumn("source", F.explode("sources")).drop("sources")


def log_sql() -> str:
    def one_of(values: list[str], shift: int) -> str:
        cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
        return f"CASE (event_id + {shift}) % {len(values)} {cases} END"

    names = [IN_LOG.get(n, n) for n in TABLES]
    members = [
        "'id': event_id::VARCHAR",
        "'created_at': CASE WHEN event_id // 25 % 5 = 0 THEN '2020-06-01 00:00:00' ELSE '2022-01-02 03:04:05' END",
        "'country': " + one_of(["'SE'", "'NO'", "'{\"code\":\"FI\"}'"], 0),
        "'application_type': " + one_of(["'company'", "NULL"], 0),
        *[f"'{n}': " + one_of(["'1'", "'0'", "'2'", "NULL"], i) for i, n in enumerate(FLAGS)],
        *[f"'{n}': " + one_of(["'0000-00-00 00:00:00'", "'2022-03-04 05:06:07'", "NULL"], i) for i, n in enumerate(DATES)],
    ]
    listed = ", ".join(f"'{n}'" for n in [*names, "unknown"])
    return f"""SELECT ([{listed}])[event_id % {len(names) + 1} + 1] AS "table", user_id AS xid, event_id AS xoffset,
  floor(epoch(ts))::BIGINT AS ts, CASE WHEN event_id % 7 < 2 THEN 'replica' ELSE 'history' END AS source,
  {{{", ".join(members)}}} AS d FROM events"""


def table_sql(name: str) -> str:
    cells = []
    for column, (kind, key, cleaner) in TABLES[name].items():
        value = f"CAST({cleaner.format(v=f'd.{key}')} AS VARCHAR)"
        cells.append((column, f"left({value}, 10)" if kind == "date" else value))
    cells.append(("source", "source"))
    cells.append(("timestamp_ts", "CAST(make_timestamp(ts * 1000000) AS DATE)::VARCHAR"))
    if name not in WITHOUT_RN:
        cells.append(("rn", "'1'"))
    if name == "bids":
        cells.append(("natural_key", "concat(xid, xoffset, ts)"))
    rows = ", ".join(f"{{'field': '{c}', 'value': {v}}}" for c, v in cells)
    floor = " AND d.created_at >= '2021-01-01'" if name in FLOORED else ""
    return f"""SELECT "table", xoffset, unnest([{rows}], recursive := true) FROM log
WHERE "table" = '{IN_LOG.get(name, name)}'{floor}"""


@query("change_tables", f"WITH log AS ({log_sql()}) " + " UNION ALL ".join(table_sql(n) for n in TABLES))
def change_tables(spark, sf):
    """All tables written from one read of the log and read back, cell by cell."""
    path, wanted = scratch_dir(spark, "change-tables"), specs()
    cdc.write_change_tables(change_log(spark, sf), wanted, path)
    found = []
    for spec in wanted:
        rows = cdc.read_change_table(spark, path, spec)
        fields = [c for c in rows.columns if c not in ("ts", "xid", "xoffset")]
        cells = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields]
        found.append(rows.select(F.lit(spec.table).alias("table"), "xoffset", F.inline(F.array(*cells))))
    result = found[0]
    for rows in found[1:]:
        result = result.unionByName(rows)
    return result
