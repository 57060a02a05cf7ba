"""Change events: one event log from two sources, and typed tables from the log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean, jsonx
from ..functions.jsonx import JsonField
from ..operators import latest
from ..sources import tables

ENVELOPE = ("database", "table", "type", "ts", "xid", "xoffset", "data", "event_date", "source", "file_name")
# Time limits of the history, and the label of the history source.
HISTORY_FLOOR = "2021-01-01"
LOG_CEILING = "2022-07-02"
HISTORY_SOURCE = "history"
CREATED_FLOOR = "2021-01-01"


def event_log(
    raw: DataFrame,
    history: DataFrame,
    raw_source: str,
    history_source: str = HISTORY_SOURCE,
    floor: str = HISTORY_FLOOR,
    ceiling: str = LOG_CEILING,
) -> DataFrame:
    """Union of concatenated-JSON files ``(raw_data, file_name)`` and the history export."""
    files = raw.select(
        "raw_data",
        "file_name",
        clean.date_from_path_pattern(F.col("file_name")).alias("event_date"),
    )
    items = jsonx.split_concatenated(files, "raw_data", "item")
    keys = ("database", "table", "type", "ts", "xid", "xoffset", "data")
    parsed = items.withColumn("e", jsonx.text_fields(F.col("item"), keys))
    from_files = parsed.select(
        F.col("e.database").alias("database"),
        F.col("e.table").alias("table"),
        F.col("e.type").alias("type"),
        F.col("e.ts").cast("bigint").alias("ts"),
        F.col("e.xid").cast("bigint").alias("xid"),
        F.col("e.xoffset").cast("bigint").alias("xoffset"),
        F.col("e.data").alias("data"),
        "event_date",
        F.lit(raw_source).alias("source"),
        "file_name",
        F.lit(str(len(raw.columns))).alias("column_check"),
    )
    day = clean.epoch_date(F.col("ts"))
    from_history = history.filter(day >= F.lit(floor).cast("date")).select(
        "database",
        "table",
        "type",
        F.col("ts").cast("bigint").alias("ts"),
        F.col("xid").cast("bigint").alias("xid"),
        F.col("xoffset").cast("bigint").alias("xoffset"),
        "data",
        day.alias("event_date"),
        F.lit(history_source).alias("source"),
        F.lit(None).cast("string").alias("file_name"),
        F.lit("1").alias("column_check"),
    )
    return from_files.unionByName(from_history).filter(day <= F.lit(ceiling).cast("date"))


CHANGE_KEY = ("xid", "xoffset", "ts")


def dedupe_changes(
    events: DataFrame, keep_rn: bool = False, tiebreak: Sequence[Column] = (), within: Sequence[str] = ()
) -> DataFrame:
    """One row per change key ``(xid, xoffset, ts)``, per table with ``within``; the greatest source name wins."""
    ties = tiebreak or ([F.col("data").desc()] if "data" in events.columns else [])
    return latest.latest_by(events, [*within, *CHANGE_KEY], [F.col("source").desc()], ties, keep_rn=keep_rn)


@dataclass(frozen=True)
class TableSpec:
    """How one parsed table is cut from the event log."""

    table: str
    fields: tuple[JsonField, ...]
    keep_rn: bool = True
    floor: str | None = None
    natural_key: bool = False
    separator: str = ""


@dataclass(frozen=True)
class TableRule:
    """Departures of a table from the plain rule 'column = JSON key cast to its type'."""

    table: str | None = None
    keep_rn: bool = True
    floor: bool = False
    natural_key: bool = False
    cleaners: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)


def _first_zero_date(value: Column) -> Column:
    return clean.zero_date(value, clean.ZERO_DATE_REPLACEMENT)


def _null_zero_date(value: Column) -> Column:
    return clean.zero_date(value)


def _private(value: Column) -> Column:
    return clean.default_value(value, "private")


def _not_zero_text(value: Column) -> Column:
    return F.when(clean.flag_not_zero(value), F.lit("1")).otherwise(F.lit("0"))


_APPLICANT = TableRule(
    cleaners={
        "is_politically_exposed": clean.flag_is_one,
        "employment_since": _first_zero_date,
        "birth_date": _first_zero_date,
    },
    keys={"citizenship": "country"},
)
# Table names of the change stream and what differs in them.
TABLE_RULES: dict[str, TableRule] = {
    "applicant_drafts": _APPLICANT,
    "applicants": _APPLICANT,
    "bid_accepts": TableRule(keep_rn=False, floor=True),
    "bid_additional_requirements": TableRule(floor=True),
    "bid_logs": TableRule(keep_rn=False, floor=True),
    "bids": TableRule(
        floor=True,
        natural_key=True,
        cleaners={
            "debt_letter_received": clean.flag_is_one,
            "require_consolidation_specification": clean.flag_is_one,
            "debt_letter_sent": clean.flag_is_one,
            "accepted": clean.flag_is_one,
        },
    ),
    "cookie_mappings": TableRule(table="application_cookie_mappings"),
    "cookies": TableRule(),
    "credit_report_latest_inquiries": TableRule(keep_rn=False),
    "credit_reports": TableRule(cleaners={"temporary_address": _not_zero_text}),
    "creditor_products": TableRule(
        cleaners={
            "updated_at": _null_zero_date,
            "deactivated_at": _null_zero_date,
            "created_at": _null_zero_date,
            "application_type": _private,
        }
    ),
    "creditors": TableRule(),
    "current_loan_drafts": TableRule(cleaners={"transfer": clean.flag_not_zero}),
    "current_loans": TableRule(cleaners={"transfer": clean.flag_not_zero}),
    "customers": TableRule(
        cleaners={
            "marked_for_delete": clean.flag_not_zero,
            "valid_national_id": clean.flag_not_zero,
            "birth_date": _first_zero_date,
        }
    ),
    "invite_logs": TableRule(floor=True),
    "invites": TableRule(floor=True, cleaners={"rejected": clean.flag_is_one, "declined": clean.flag_is_one}),
    "loan_application_drafts": TableRule(cleaners={"accept_newsletter": clean.flag_not_zero}),
    "loan_application_versions": TableRule(floor=True, cleaners={"accept_newsletter": clean.flag_not_zero}),
    "loan_applications": TableRule(
        cleaners={"canceled": clean.flag_not_zero_or_null, "self_service": clean.flag_not_zero}
    ),
    "pageviews": TableRule(cleaners={"dummy": clean.flag_not_zero}),
    "policies": TableRule(),
    "query_params": TableRule(),
    "sent_events": TableRule(),
}
_NOT_FROM_JSON = {"ts", "timestamp_ts", "rn", "source", "xid", "xoffset", "natural_key"}


def spec_from_schema(name: str, schema: T.StructType, rule: TableRule | None = None) -> TableSpec:
    """Spec of a parsed table from its declared schema and its rule.

    The declared output schema already lists every column and its type; only the
    cleaners, renamed keys and filters have to be stated.
    """
    rule = rule or TABLE_RULES[name]
    fields = tuple(
        JsonField(f.name, f.dataType.simpleString(), rule.keys.get(f.name), rule.cleaners.get(f.name))
        for f in schema.fields
        if f.name not in _NOT_FROM_JSON
    )
    return TableSpec(
        rule.table or name, fields, rule.keep_rn, CREATED_FLOOR if rule.floor else None, rule.natural_key
    )


def _layout(spec: TableSpec) -> tuple[list[str], list[str]]:
    """Columns before and after those from the JSON."""
    tail = ["ts", "timestamp_ts", *(["rn"] if spec.keep_rn else []), "source", *CHANGE_KEY[:2]]
    return ["natural_key"] if spec.natural_key else [], tail


def _keyed(rows: DataFrame, specs: Sequence[TableSpec]) -> DataFrame:
    rows = rows.withColumn("timestamp_ts", clean.epoch_date(F.col("ts")))
    separators = {s.separator for s in specs if s.natural_key}
    if len(separators) > 1:
        raise ValueError("tables of one log share the separator of their natural keys")
    for sep in separators:
        parts = [F.col(c).cast("string") for c in CHANGE_KEY]
        rows = rows.withColumn("natural_key", F.concat(parts[0], F.lit(sep), parts[1], F.lit(sep), parts[2]))
    return rows


def parsed_table(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows of one source table, one per change.

    Duplicates go first, on the narrow envelope, so that only surviving rows are
    parsed.
    """
    needed = [*CHANGE_KEY, "source", "data"]
    rows = dedupe_changes(events.filter(F.col("table") == spec.table).select(*needed), keep_rn=True)
    head, tail = _layout(spec)
    parsed = jsonx.parse_typed(_keyed(rows, [spec]), "data", spec.fields, keep=[*head, *tail])
    if spec.floor is not None:
        parsed = parsed.filter(F.to_date("created_at") >= F.lit(spec.floor).cast("date"))
    return parsed.select(*head, *[f.name for f in spec.fields], *tail)


def change_tables(events: DataFrame, specs: Sequence[TableSpec]) -> DataFrame:
    """All parsed tables from one scan and one shuffle of the log: ``table`` and a struct column per table.

    Duplicates go over all tables at once.  A row is parsed by the rule of its own table only and fills that table's
    struct; the others are NULL, which costs nothing in parquet.  Rows of other tables and below a table's floor are
    left out.
    """
    if len({s.table for s in specs}) != len(specs):
        raise ValueError("one spec per table of the log")
    names = [s.table for s in specs]
    rows = events.filter(F.col("table").isin(names)).select("table", *CHANGE_KEY, "source", "data")
    rows = _keyed(dedupe_changes(rows, keep_rn=True, within=["table"]), specs)
    # One parse per row; the structs on top read it member by member.
    own = {s.table: F.col("table") == s.table for s in specs}
    parsed = {f"__{s.table}": F.when(own[s.table], jsonx.text_fields(F.col("data"), [f.json_key for f in s.fields])) for s in specs}
    rows = rows.withColumns(parsed)
    structs = []
    for spec in specs:
        head, tail = _layout(spec)
        columns = jsonx.typed_columns(f"__{spec.table}", F.col("data"), spec.fields)
        row = F.when(own[spec.table], F.struct(*head, *columns, *tail))
        structs.append(row.alias(spec.table))
    typed = rows.select("table", *structs)
    kept = F.lit(False)
    for spec in specs:
        floor = F.lit(True)
        if spec.floor is not None:
            floor = F.to_date(F.col(f"{spec.table}.created_at")) >= F.lit(spec.floor).cast("date")
        kept = F.when(F.col("table") == spec.table, floor).otherwise(kept)
    return typed.filter(kept)


def write_change_tables(events: DataFrame, specs: Sequence[TableSpec], path: str) -> None:
    """Parse the log once and write every table's rows to its own partition of ``path``."""
    tables.write_table(change_tables(events, specs), path, partition_by=["table"])


def read_change_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """One parsed table of ``write_change_tables``; reads its own partition and column only."""
    return spark.read.parquet(path).filter(F.col("table") == spec.table).select(F.col(f"`{spec.table}`.*"))
