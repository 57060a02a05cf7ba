"""JSON parsing: one parse per row, scalar rules applied afterwards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class JsonField:
    """One output column: JSON key, target type and an optional text cleaner."""

    name: str
    type: str = "string"
    key: str | None = None
    cleaner: Callable[[Column], Column] | None = None

    @property
    def json_key(self) -> str:
        return self.key or self.name


def parse_array(text: Column) -> Column:
    """JSON array text to an array whose elements stay JSON text."""
    return F.from_json(text, "array<string>")


def split_concatenated(df: DataFrame, col: str, alias: str = "item") -> DataFrame:
    """One row per object of a text holding objects written back to back."""
    joined = F.concat(F.lit("["), F.replace(F.col(col), F.lit("}{"), F.lit("},{")), F.lit("]"))
    return df.withColumn(alias, F.explode(parse_array(joined))).drop(col)


def text_fields(text: Column, keys: Sequence[str]) -> Column:
    """Struct of top-level members as text, from a single parse."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in dict.fromkeys(keys)])
    return F.from_json(text, schema)


def scalar_only(member: Column, document: Column, key: str) -> Column:
    """NULL for members that are objects or arrays.

    Only text that looks like a container is inspected again, so plain values
    keep the cost of the one parse.
    """
    looks_nested = member.startswith("{") | member.startswith("[")
    found = F.try_variant_get(F.try_parse_json(document), f'$["{key}"]', "variant")
    kind = F.schema_of_variant(found)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(looks_nested, F.when(~nested, member)).otherwise(member)


def typed_columns(parsed: str, document: Column, spec: Sequence[JsonField]) -> list[Column]:
    """Columns of a spec from the struct ``parsed`` that ``text_fields`` made of ``document``.

    The parse is all text because sources quote numbers inconsistently; casts
    follow ANSI rules, so dirty values fail unless their field has a cleaner.
    """
    columns = []
    for field in spec:
        value = scalar_only(F.col(f"{parsed}.`{field.json_key}`"), document, field.json_key)
        if field.cleaner is not None:
            value = field.cleaner(value)
        columns.append(value.cast(field.type).alias(field.name))
    return columns


def parse_typed(df: DataFrame, col: str, spec: Sequence[JsonField], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from a JSON text column, followed by the columns in ``keep``."""
    parsed = "__parsed"
    rows = df.withColumn(parsed, text_fields(F.col(col), [f.json_key for f in spec]))
    return rows.select(*typed_columns(parsed, F.col(col), spec), *[F.col(c) for c in keep])


# Where the report list sits in the envelope, and its member names.
REPORT_PATH = (
    "soap:Envelope",
    "soap:Body",
    "ns2:ucReply",
    "ns2:ucReport",
    "ns2:xmlReply",
    "ns2:reports",
    "ns2:report",
)
REPORT_MEMBERS = {
    "report_index": "ns2:index",
    "report_styp": "ns2:styp",
    "report_name": "ns2:name",
    "report_pid": "ns2:id",
}
GROUP_MEMBERS = {"grp_name": "ns2:name", "grp_key": "ns2:key", "grp_index": "ns2:index", "grp_id": "ns2:id"}
TERM_MEMBERS = {"term_id": "ns2:id", "term_text": "text"}


def flatten_report(df: DataFrame, col: str, path: Sequence[str] = REPORT_PATH) -> DataFrame:
    """Report envelope to one row per term (report, group and term members)."""

    def texts(members: dict[str, str]) -> list[T.StructField]:
        return [T.StructField(key, T.StringType()) for key in members.values()]

    term = T.StructType(texts(TERM_MEMBERS))
    group = T.StructType([*texts(GROUP_MEMBERS), T.StructField("ns2:term", T.ArrayType(term))])
    level = T.StructType([*texts(REPORT_MEMBERS), T.StructField("ns2:group", T.ArrayType(group))])
    for name in reversed(path):
        level = T.StructType([T.StructField(name, level)])
    report = F.from_json(F.col(col), level)
    for name in path:
        report = report.getField(name)

    def pick(source: str, members: dict[str, str]) -> list[Column]:
        return [F.col(source).getField(key).alias(name) for name, key in members.items()]

    others = [F.col(c) for c in df.columns if c != col]
    with_group = df.select(*others, report.alias("__report")).select(
        *others, *pick("__report", REPORT_MEMBERS), F.explode(F.col("__report").getField("ns2:group")).alias("__group")
    )
    with_term = with_group.select(
        *[F.col(c) for c in with_group.columns if c != "__group"],
        *pick("__group", GROUP_MEMBERS),
        F.explode(F.col("__group").getField("ns2:term")).alias("__term"),
    )
    return with_term.select(
        *[F.col(c) for c in with_term.columns if c != "__term"], *pick("__term", TERM_MEMBERS)
    )


@dataclass(frozen=True)
class MessageField:
    """Member of a message record; a nullable member is written as a tagged union."""

    name: str
    type: str
    nullable: bool = True

    @property
    def tag(self) -> str:
        return "array" if self.type.startswith("array") else "long" if self.type == "bigint" else self.type


def wrap_union(fields: Sequence[MessageField], available: Sequence[str]) -> Column:
    """JSON text of a message: ``{"tag": value}`` for present nullable members, else null."""
    members = []
    for field in fields:
        if field.name in available:
            value = F.col(field.name).cast(field.type)
        else:
            value = F.lit(None).cast(field.type)
        if field.nullable:
            value = F.when(value.isNotNull(), F.struct(value.alias(field.tag)))
        members.append(value.alias(field.name))
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def unwrap_union(member: Column) -> Column:
    """Value of a member that may or may not be wrapped in a one-entry object."""
    entries = F.map_values(F.from_json(member, "map<string,string>"))
    wrapped = member.startswith("{") & (F.size(entries) == 1)
    return F.when(wrapped, entries.getItem(0)).otherwise(member)


def read_message(df: DataFrame, col: str, fields: Sequence[MessageField]) -> DataFrame:
    """Typed message members from JSON text, wrapped or bare."""
    parsed = df.withColumn("__message", text_fields(F.col(col), [f.name for f in fields]))
    columns = []
    for field in fields:
        text = unwrap_union(F.col(f"__message.{field.name}"))
        value = F.from_json(text, field.type) if field.type.startswith("array") else text.cast(field.type)
        columns.append(value.alias(field.name))
    return parsed.select(*[F.col(c) for c in df.columns if c != col], *columns)
