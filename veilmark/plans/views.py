"""Encrypted views: pick the join to the vault, encrypt every tagged field, flag rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean, crypto
from ..operators import catalog
from ..operators.joins import lookup_join
from . import vault as vaults

# Payload types that gate the keys of a contact block.
GATED_TYPES = {"ssn": "post", "email": "email", "mobile": "mobile_phone"}
FLAG = "is_anonymised"


@dataclass(frozen=True)
class JoinPlan:
    """Join strategy and key columns of one table, and its tagged paths."""

    kind: str
    keys: dict[str, str]
    tagged: frozenset[str]
    encrypted: tuple[str, ...]
    gate: str | None = None


def _key(path: str) -> str:
    """Comparable name of a path; the first segment is dropped when nested."""
    return path.split(".", 1)[-1].lower().replace("_", "")


def _first(paths: Sequence[str], names: Sequence[str]) -> str | None:
    return next((p for p in paths if _key(p) in names), None)


def _outside_arrays(schema: T.StructType, path: str) -> bool:
    """Whether a row has one value at the path; a path below an array has many and cannot be a key."""
    dtype: T.DataType = schema
    for name in path.split("."):
        if not isinstance(dtype, T.StructType):
            return False
        dtype = dtype[name].dataType
    return not isinstance(dtype, T.ArrayType)


def classify(
    df: DataFrame | T.StructType,
    tags: Collection[str],
    table: str | None = None,
    exclude: Collection[str] = (),
    gate: str | None = None,
    ignore_columns: Collection[str] = (),
    dataset: str | None = None,
    exclude_datasets: Collection[str] = (),
) -> JoinPlan:
    """Strategy from the schema: gated triple, ssn, app id, mobile+email, email, mobile.

    ``tags`` are normalised sensitive names.  Tables in ``exclude`` and all tables
    of ``exclude_datasets`` pass through, as do tables without tagged columns.  A
    tagged table without a key outside arrays is ``unkeyed``: it cannot be
    encrypted per person.
    """
    schema = df if isinstance(df, T.StructType) else df.schema
    known = {t.lower().replace("_", "") for t in tags}
    paths = [(p, f) for p, f in catalog.walk(schema) if p.split(".")[0] not in ignore_columns]
    names = [p for p, _ in paths if _outside_arrays(schema, p)]
    leaves = {p for p, f in paths if not _contains_struct(f.dataType)}
    tagged = frozenset(p for p in leaves if _key(p) in known)
    top = [f.name for f in schema.fields if any(p.split(".")[0] == f.name for p in tagged)]
    keys = {
        "ssn": _first(names, catalog.SSN_KEY_NAMES),
        "app": _first(names, catalog.APP_ID_NAMES),
        "email": _first(names, catalog.EMAIL_NAMES),
        "mobile": _first(names, catalog.MOBILE_NAMES),
    }
    found = {k: v for k, v in keys.items() if v}
    if table in exclude or dataset in exclude_datasets or not tagged:
        kind = "passthrough"
    elif gate is not None:
        kind = "triple"
    elif "ssn" in found:
        kind = "ssn"
    elif "app" in found:
        kind = "app"
    elif "mobile" in found and "email" in found:
        kind = "double"
    elif "email" in found:
        kind = "email"
    elif "mobile" in found:
        kind = "mobile"
    else:
        kind = "unkeyed"
    return JoinPlan(kind, found, tagged, tuple(top), gate)


def _contains_struct(dtype: T.DataType) -> bool:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return isinstance(dtype, T.StructType)


@dataclass(frozen=True)
class Person:
    """Columns that identify and encrypt for the person of a row."""

    uuid: Column
    cipher: Column
    nonce: Column

    def seal(self, value: Column, dtype: T.DataType, encrypt_blank: bool) -> Column:
        """Ciphertext when there is something to hide and a key, else the plain text."""
        text = value.cast("string")
        wanted = self.uuid.isNotNull()
        if not encrypt_blank:
            wanted = clean.not_blank(value, dtype) & wanted
        return F.when(wanted, crypto.det_encrypt_with(text, self.cipher, self.nonce, self.uuid)).otherwise(text)


def encrypt_column(
    name: str, dtype: T.DataType, tagged: Collection[str], person: Person, encrypt_blank: bool = False
) -> Column:
    """Rebuild a column with its tagged members encrypted; everything else keeps its place.

    Works on plain columns, structs, arrays of text and arrays of structs; a
    NULL array becomes an empty one.
    """

    def visit(value: Column, kind: T.DataType, path: str) -> Column:
        if isinstance(kind, T.ArrayType):
            if not _touched(path):
                return value
            inner = F.transform(value, lambda e: visit(e, kind.elementType, path))
            return F.coalesce(inner, F.array())
        if isinstance(kind, T.StructType):
            members = [
                visit(value.getField(f.name), f.dataType, f"{path}.{f.name}").alias(f.name) for f in kind.fields
            ]
            return F.when(value.isNotNull(), F.struct(*members))
        return person.seal(value, kind, encrypt_blank) if path in tagged else value

    def _touched(path: str) -> bool:
        return any(t == path or t.startswith(path + ".") for t in tagged)

    return visit(F.col(f"`{name}`"), dtype, name).alias(name)


def _usable(key: Column) -> Column:
    """Key for the join: blanks and '0' match nobody."""
    return F.when((key != "") & (key != "0"), key)


def _filled(key: Column) -> Column:
    return key.isNotNull() & (key != "") & (key != "0")


def _said_anonymised(key: Column) -> Column:
    return F.lower(key) == clean.ANONYMISED_WORD


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).alias(FLAG)


def _attach(df: DataFrame, lookup: DataFrame, key: Column | str, tag: str, hot_share: float | None) -> DataFrame:
    """Join a lookup, which has usable keys only; a column given by its name leaves the rows dealt by that column."""
    renamed = lookup.select(*[F.col(c).alias(f"__{tag}_{c}") for c in lookup.columns])
    if isinstance(key, str) and hot_share is None:
        return lookup_join(df, renamed, [(key, f"__{tag}_key")])
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    return lookup_join(df, renamed, [(_usable(key), f"__{tag}_key")], hot_share=hot_share)


def _person(tags: Sequence[str]) -> Person:
    def pick(column: str) -> Column:
        return F.coalesce(*[F.col(f"__{t}_{column}") for t in tags])

    return Person(pick("uuid"), pick("cipher_key"), pick("nonce_key"))


def encrypted_view(
    df: DataFrame,
    table: str,
    market: Column | str,
    tags: Collection[str],
    vault: DataFrame,
    exclude: Collection[str] = (),
    expose_join_key: bool = False,
    stack: str | None = None,
    gate: str | None = None,
    flag_on_clean_phone: bool = True,
    encrypt_blank: bool = False,
    hot_share: float | None = None,
    key: str | None = None,
    dataset: str | None = None,
    exclude_datasets: Collection[str] = (),
) -> DataFrame:
    """The published form of a table: encrypted columns, the other columns, the flag.

    Every input row appears exactly once: lookups hold one row per key.  The
    vault side is reduced to key, uuid and sub-keys before the join.  A table
    with tagged columns and no usable key is refused, as it would be published
    in clear; exclude it by name where that is meant.
    """
    plan = classify(df, tags, table, exclude, gate, dataset=dataset, exclude_datasets=exclude_datasets)
    if plan.kind == "passthrough":
        return passthrough(df)
    if plan.kind == "unkeyed":
        raise ValueError(f"{table}: tagged columns {sorted(plan.tagged)} and no key outside arrays to encrypt them by")
    if key is not None:
        plan = replace(plan, keys={**plan.keys, plan.kind: key})
    raw = {k: F.col(p).cast("string") for k, p in plan.keys.items()}
    # A key that is a text column of the table itself is joined by its name.
    flat = {f.name for f in df.schema.fields if f.dataType == T.StringType()}
    by_name = {k: p if p in flat else raw[k] for k, p in plan.keys.items()}
    exposed: list[Column] = []

    if plan.kind == "ssn":
        work = df.withColumn("ssn_clean", clean.national_id(F.col(plan.keys["ssn"]), market))
        joined = _attach(work, vaults.lookup(vault, "ssn"), "ssn_clean", "s", hot_share)
        person, exposed = _person(["s"]), [F.col("ssn_clean")]
        flag = (_filled(raw["ssn"]) & person.uuid.isNotNull()) | _said_anonymised(raw["ssn"])
    elif plan.kind == "app":
        joined = _attach(df, vaults.lookup(vault, "app", stack), by_name["app"], "a", hot_share)
        person, exposed = _person(["a"]), [F.lit(stack).alias("stack")]
        flag = (_filled(raw["app"]) & person.uuid.isNotNull()) | _said_anonymised(raw["app"])
    elif plan.kind == "email":
        joined = _attach(df, vaults.lookup(vault, "email"), by_name["email"], "e", hot_share)
        person = _person(["e"])
        flag = (_filled(raw["email"]) & person.uuid.isNotNull()) | _said_anonymised(raw["email"])
    elif plan.kind == "mobile":
        work = df.withColumn("mobile_clean", clean.phone(raw["mobile"], market))
        joined = _attach(work, vaults.lookup(vault, "mobile"), "mobile_clean", "m", hot_share)
        person, exposed = _person(["m"]), [F.col("mobile_clean")]
        seen = F.col("mobile_clean") if flag_on_clean_phone else raw["mobile"]
        flag = (_filled(seen) & person.uuid.isNotNull()) | _said_anonymised(seen)
    elif plan.kind == "double":
        work = df.withColumn("mobile_clean", clean.phone(raw["mobile"], market))
        joined = _attach(work, vaults.lookup(vault, "email"), by_name["email"], "e", hot_share)
        joined = _attach(joined, vaults.lookup(vault, "mobile"), "mobile_clean", "m", hot_share)
        person, exposed = _person(["e", "m"]), [F.col("mobile_clean")]
        known = (_filled(F.col("mobile_clean")) | _filled(raw["email"])) & person.uuid.isNotNull()
        flag = _or(known, _said_anonymised(F.col("mobile_clean")), _said_anonymised(raw["email"]))
    else:
        contact = raw.get("ssn", raw.get("email"))
        kind = F.col(plan.gate)
        work = df.withColumns(
            {
                "ssn_clean": clean.national_id(contact, market),
                "mobile_clean": clean.phone(contact, market),
            }
        )
        # A row has one type and so one key: the lookups together are one, and the rows move once.
        keys = {"ssn": F.col("ssn_clean"), "email": contact, "mobile": F.col("mobile_clean")}
        parts = [vaults.lookup(vault, by).withColumn("type", F.lit(value)) for by, value in GATED_TYPES.items()]
        lookup = reduce(DataFrame.unionByName, parts)
        lookup = lookup.select(*[F.col(c).alias(f"__g_{c}") for c in lookup.columns])
        gated = F.coalesce(*[F.when(kind == value, keys[by]) for by, value in GATED_TYPES.items()])
        on = [(_usable(gated), "__g_key"), (F.when(_usable(gated).isNotNull(), kind), "__g_type")]
        joined = lookup_join(work, lookup, on, hot_share=hot_share)
        person, exposed = _person(["g"]), [F.col("ssn_clean"), F.col("mobile_clean")]
        flag = _filled(contact) & person.uuid.isNotNull()

    encrypted = [
        encrypt_column(c, df.schema[c].dataType, plan.tagged, person, encrypt_blank) for c in plan.encrypted
    ]
    others = [F.col(f"`{c}`") for c in df.columns if c not in plan.encrypted]
    return joined.select(*encrypted, *others, *(exposed if expose_join_key else []), _flag(flag))


def _or(*conditions: Column) -> Column:
    """Disjunction in which an unknown part counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def passthrough(df: DataFrame) -> DataFrame:
    """Nothing to encrypt: the table and a false flag."""
    return df.withColumn(FLAG, F.lit(False))


def plain(df: DataFrame) -> DataFrame:
    """Published unchanged."""
    return df


def decrypt_text(ciphertext: Column, aead_key: Column, uuid: Column) -> Column:
    """Clear text of an encrypted cell; a cell that was never encrypted comes back as it is."""
    return F.coalesce(crypto.det_decrypt(ciphertext, aead_key, uuid), ciphertext)
