"""Key vault: one deterministic key per person, insert-if-absent, flag updates."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crypto
from ..operators import latest
from ..operators.joins import absent, union_keys
from ..sources import versioned
from ..sources.tables import update_where

# Event kept out of the vault, mark of an unusable id, key columns of published views.
RETAINED_EVENT = "flag_gdpr_5_year_complaint"
INVALID_ID = "invalid"
PLACEHOLDER_IDS = ("", "0")
KEY_CANDIDATES = ("ssn_clean", "secondary_column", "secondary_column_v2")
VAULT_COLUMNS = (
    "uuid",
    "ssn",
    "history",
    "market",
    "aead_key",
    "encrypted_ssn",
    "is_anonymized",
    "is_valid_national_id",
    "ingestion_timestamp",
)


def build(events: DataFrame, master_key: str, as_of: Column | None = None) -> DataFrame:
    """Vault rows of a batch of compliance events, one per ``(ssn, market)``.

    Only people with at least one valid id get a key.  Key and uuid are derived
    from the person and a master secret, so a retried task writes the same key;
    no random value has to be carried from one stage to the next.  Histories of
    the same person and market are merged.  A blank or placeholder id stands for
    nobody in particular: its events, which may be a large share of all, leave no
    history to look anyone up by.
    """
    contacts = events.filter(F.col("compliance_event") != RETAINED_EVENT).withColumnRenamed("national_id", "ssn")
    valid = contacts.filter(F.col("is_valid_national_id") != INVALID_ID).select("ssn").distinct()
    own = F.when(~F.trim("ssn").isin(*PLACEHOLDER_IDS), F.col("history"))
    # The semi join leaves the rows hashed by ssn, which also serves the grouping.
    people = (
        contacts.join(valid, "ssn", "left_semi")
        .groupBy("ssn", "market")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(own)))).alias("history"),
            F.max("is_valid_national_id").alias("is_valid_national_id"),
        )
    )
    keyed = people.withColumn("uuid", crypto.derive_uuid(master_key, F.col("ssn"))).withColumn(
        "aead_key", crypto.derive_key(master_key, F.col("ssn"))
    )
    return keyed.select(
        "uuid",
        "ssn",
        "history",
        "market",
        "aead_key",
        crypto.det_encrypt(F.col("ssn"), F.col("aead_key"), F.col("uuid")).alias("encrypted_ssn"),
        F.lit(False).alias("is_anonymized"),
        "is_valid_national_id",
        (as_of if as_of is not None else F.current_timestamp()).alias("ingestion_timestamp"),
    )


def insert_absent(vault: DataFrame, new: DataFrame) -> DataFrame:
    """Vault plus the batch rows of people it does not know yet."""
    return vault.unionByName(absent(new, vault, ["ssn"]))


def key_column(view: DataFrame, candidates: Sequence[str] = KEY_CANDIDATES) -> str | None:
    """First candidate key column a published view has."""
    return next((c for c in candidates if c in view.columns), None)


def _to_flag(
    vault: DataFrame,
    views: Mapping[str, DataFrame],
    key_candidates: Sequence[str],
    join_keys: Mapping[str, str] | None,
    keyless: Collection[str],
) -> DataFrame:
    """The vault with ``__flag``: people of the views who are not flagged yet."""
    chosen = {n: (join_keys or {}).get(n) or key_column(v, key_candidates) for n, v in views.items()}
    unknown = sorted(n for n, k in chosen.items() if not k and n not in keyless)
    if unknown:
        raise ValueError(f"views without a key column: {unknown}; publish them with expose_join_key")
    by_ssn = [n for n, k in chosen.items() if k == key_candidates[0]]
    by_other = [n for n, k in chosen.items() if k and k != key_candidates[0]]
    spark = vault.sparkSession
    ssns = union_keys([views[n] for n in by_ssn], [chosen[n] for n in by_ssn], "__ssn", spark)
    marked = vault.join(ssns.withColumn("__hit_ssn", F.lit(True)), F.col("ssn") == F.col("__ssn"), "left")
    by_market = F.lit(False)
    if by_other:
        others = union_keys([views[n] for n in by_other], [chosen[n] for n in by_other], "__market", spark)
        hits = others.withColumn("__hit_market", F.lit(True))
        marked = marked.join(hits, F.col("market") == F.col("__market"), "left")
        by_market = F.coalesce("__hit_market", F.lit(False))
    hit = F.coalesce("__hit_ssn", F.lit(False)) | by_market
    unflagged = ~F.col("is_anonymized").eqNullSafe(True)
    return marked.select(*vault.columns, (unflagged & hit).alias("__flag"))


def mark_anonymised(
    vault: DataFrame,
    views: Mapping[str, DataFrame],
    key_candidates: Sequence[str] = KEY_CANDIDATES,
    as_of: Column | None = None,
    join_keys: Mapping[str, str] | None = None,
    keyless: Collection[str] = (),
) -> DataFrame:
    """Flag people that occur in published views; already flagged rows keep their time.

    Views keyed by the cleaned national id match on ssn, the others on market.  A
    view without a key column is an error unless it is named in ``keyless``:
    nobody in it could be flagged.
    """
    marked = _to_flag(vault, views, key_candidates, join_keys, keyless)
    stamp = as_of if as_of is not None else F.current_timestamp()
    updated = update_where(marked, F.col("__flag"), {"is_anonymized": F.lit(True), "ingestion_timestamp": stamp})
    return updated.select(*vault.columns)


def mark_stored(
    spark: SparkSession,
    path: str,
    views: Mapping[str, DataFrame],
    key_candidates: Sequence[str] = KEY_CANDIDATES,
    as_of: Column | None = None,
    join_keys: Mapping[str, str] | None = None,
    keyless: Collection[str] = (),
) -> versioned.Version:
    """``mark_anonymised`` on a vault kept in versions: only buckets with a person to flag are written."""

    def touched(vault: DataFrame) -> DataFrame:
        return _to_flag(vault, views, key_candidates, join_keys, keyless).filter("__flag").drop("__flag")

    def change(vault: DataFrame) -> DataFrame:
        return mark_anonymised(vault, views, key_candidates, as_of, join_keys, keyless)

    return versioned.rewrite(spark, path, touched, change)


def lookup(vault: DataFrame, by: str, stack: str | None = None) -> DataFrame:
    """One row per lookup key with the person's uuid and sub-keys.

    ``by`` is ``ssn``, ``app`` (application id within ``stack``), ``email`` or
    ``mobile``; the latest contact wins.  Blanks and the placeholder '0' stand for
    nobody and are no keys.  Sub-keys are derived here, once per person, and not
    per encrypted field.
    """
    material = ["uuid", "aead_key"]
    usable = F.col("key").isNotNull() & ~F.col("key").isin(*PLACEHOLDER_IDS)
    if by == "ssn":
        rows = vault.select(F.col("ssn").alias("key"), *material, "ingestion_timestamp").filter(usable)
        keyed = latest.latest_by(rows, ["key"], [F.col("ingestion_timestamp").asc(), F.col("uuid").asc()])
    else:
        column = {"app": "loan_application_oid", "email": "email", "mobile": "mobile_phone"}[by]
        entries = vault.select(*material, F.explode("history").alias("h"))
        if by == "app":
            if stack is None:
                raise ValueError("application id lookups need the stack label of the table")
            entries = entries.filter(F.col("h.stack") == stack)
        rows = entries.select(F.col(f"h.{column}").cast("string").alias("key"), *material, F.col("h.created_at").alias("__at"))
        rows = rows.filter(usable)
        keyed = latest.latest_by(rows, ["key"], [F.col("__at").desc(), F.col("uuid").asc()])
    return keyed.select(
        "key",
        "uuid",
        crypto.cipher_key(F.col("aead_key")).alias("cipher_key"),
        crypto.nonce_key(F.col("aead_key"), F.col("uuid")).alias("nonce_key"),
    )
