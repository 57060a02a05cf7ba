"""Anonymisation events: build, publish, route, deliver, count."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import crypto, jsonx
from ..functions.jsonx import MessageField
from ..session import scratch_dir
from .vault import PLACEHOLDER_IDS

# The message record.
MESSAGE_FIELDS = (
    MessageField("national_id", "string", nullable=False),
    MessageField("customer_id", "bigint"),
    MessageField("emails", "array<string>"),
    MessageField("mobile_phones", "array<string>"),
    MessageField("market", "string"),
    MessageField("last_brand_interaction", "string"),
    MessageField("latest_email", "string"),
    MessageField("latest_mobile", "string"),
    MessageField("compliance_event", "string"),
)
NULL_TEXT = "null"
ALL_MARKETS = "ALL"
# Delivery behaviour.
PUBLISH_ATTEMPTS = 2
#: Messages sent between two entries in a ledger.
CHUNK_ROWS = 100_000
HTTP_ATTEMPTS = 6
RETRY_STATUSES = (500, 502, 503, 504)
OK_STATUS = 200

Transport = Callable[[str, str], int]


def build(vault: DataFrame, compliance_events: DataFrame, as_of: Column, hours: int = 12) -> DataFrame:
    """One event per person, market and compliance row of recently anonymised people.

    The history is already an array per person, so distinct contacts are taken
    inside the row; nothing is exploded and regrouped by contact.
    """
    recent = F.col("ingestion_timestamp") >= as_of - F.expr(f"interval {hours} hours")
    people = vault.filter(recent & F.col("is_anonymized"))

    def contacts(member: str) -> Column:
        values = F.transform(F.col("history"), lambda h: F.coalesce(h.getField(member), F.lit(NULL_TEXT)))
        filled = F.when(F.size(F.coalesce(values, F.array())) > 0, values).otherwise(F.array(F.lit(NULL_TEXT)))
        return F.array_distinct(filled)

    people = people.select(
        F.col("ssn").alias("national_id"),
        "market",
        contacts("email").alias("emails"),
        contacts("mobile_phone").alias("mobile_phones"),
    )
    known = compliance_events.select(
        F.col("national_id").alias("__id"),
        F.col("market").alias("__market"),
        "customer_id",
        "last_brand_interaction",
        F.col("email").alias("latest_email"),
        F.col("mobile_phone").alias("latest_mobile"),
        "compliance_event",
    )
    # A placeholder stands for nobody: all events of such ids would meet in one key.
    known = known.filter(~F.col("__id").isin(*PLACEHOLDER_IDS))
    same = (F.col("national_id") == F.col("__id")) & (F.col("market") == F.col("__market"))
    joined = people.join(known, same, "left")
    keys = [
        "national_id",
        "customer_id",
        "market",
        "last_brand_interaction",
        "latest_email",
        "latest_mobile",
        "compliance_event",
    ]
    merged = joined.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("emails")))).alias("emails"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("mobile_phones")))).alias("mobile_phones"),
    )
    return merged.select(*[f.name for f in MESSAGE_FIELDS])


def to_messages(events: DataFrame, key: Sequence[str] = ("national_id", "market", "customer_id")) -> DataFrame:
    """``(message_id, message)``: JSON text per event under a reproducible id."""
    body = jsonx.wrap_union(MESSAGE_FIELDS, events.columns)
    identity = F.to_json(F.struct(*[F.col(c) for c in key if c in events.columns]))
    return events.select(F.sha2(F.concat(identity, body), 256).alias("message_id"), body.alias("message"))


def read_messages(messages: DataFrame) -> DataFrame:
    """Typed members of ``(message_id, message)`` rows."""
    return jsonx.read_message(messages, "message", MESSAGE_FIELDS)


def route(messages: DataFrame, market_projects: Mapping[str, Sequence[str] | str | None]) -> DataFrame:
    """One row per message and project with the payload to send.

    Messages without a market go to every project.  Messages of a market without
    projects keep one row with a NULL project, so they can be counted as failed.
    """
    listed = {m: [p] if isinstance(p, str) else list(p or []) for m, p in market_projects.items()}
    everywhere = list(dict.fromkeys(p for projects in listed.values() for p in projects))

    def literal(projects: Sequence[str]) -> Column:
        return F.array(*[F.lit(p) for p in projects]).cast("array<string>")

    projects = F.when(F.col("market").isNull() | (F.upper("market") == ALL_MARKETS), literal(everywhere))
    for market, names in listed.items():
        projects = projects.when(F.col("market") == market, literal(names))

    def present(value: Column) -> Column:
        return F.when(value != "", value)

    ids = F.struct(
        crypto.sha256_hex(present(F.col("national_id"))).alias("SSN"),
        present(F.col("latest_email")).alias("registered"),
        present(F.col("latest_mobile")).alias("phone"),
    )
    payload = F.to_json(F.struct(ids.alias("customer_ids")))
    return messages.select("message_id", "market", F.explode_outer(projects).alias("project"), payload.alias("payload"))


RESULT_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


def send_once(
    transport: Transport, payload: str, project: str, attempts: int, backoff: float
) -> tuple[bool, int, int | None, str | None]:
    """Send one payload; retry exceptions and server errors with doubling waits."""
    status, error = None, None
    for attempt in range(1, attempts + 1):
        try:
            status, error = transport(payload, project), None
        except Exception as problem:  # the transport decides what it raises
            status, error = None, str(problem)
        if status == OK_STATUS:
            return True, attempt, status, None
        if status is not None and status not in RETRY_STATUSES:
            return False, attempt, status, f"status {status}"
        if attempt < attempts and backoff:
            time.sleep(backoff * 2 ** (attempt - 1))
    return False, attempts, status, error or f"status {status}"


def send_all(
    df: DataFrame, transport: Transport, attempts: int, backoff: float = 1.0, senders: int | None = None
) -> DataFrame:
    """Delivery results of ``(message_id, project, payload)`` rows, partition by partition.

    Rows without a project fail at once.  ``senders`` sets how many tasks send at
    a time; sending waits on the receiver, so few small partitions would be slow.
    Delivery is at least once: a retried task sends again, so receivers must
    accept a message id twice.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            rows = []
            for message_id, project, payload in zip(batch["message_id"], batch["project"], batch["payload"]):
                if project is None:
                    outcome = (False, 0, None, "no project")
                else:
                    outcome = send_once(transport, payload, project, attempts, backoff)
                rows.append((message_id, project, payload, *outcome))
            out = pd.DataFrame(rows, columns=RESULT_SCHEMA.fieldNames())
            out["attempts"] = out["attempts"].astype("Int32")
            out["status"] = out["status"].astype("Int32")
            yield out

    rows = df.select("message_id", "project", "payload")
    if senders is not None:
        rows = rows.repartition(senders, "message_id", "project")
    return rows.mapInPandas(run, RESULT_SCHEMA)


def deliver(
    df: DataFrame,
    transport: Transport,
    attempts: int = HTTP_ATTEMPTS,
    backoff: float = 1.0,
    path: str | None = None,
    senders: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Send everything once and return ``(delivered, dead_letter)``.

    Results are written before they are split, so that reading both halves does
    not send the messages twice.
    """
    target = path or scratch_dir(df.sparkSession, "delivery")
    send_all(df, transport, attempts, backoff, senders).write.mode("overwrite").parquet(target)
    results = df.sparkSession.read.schema(RESULT_SCHEMA).parquet(target)
    return results.filter("ok"), results.filter(~F.col("ok"))


def _committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was completed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def delivered(spark: SparkSession, ledger: str) -> DataFrame:
    """All results of a ledger, one row per (message, project) sent or refused."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(ledger).select(*RESULT_SCHEMA.names)


def _send_chunk(rows: DataFrame, path: str, transport: Transport, attempts: int, backoff: float, senders: int | None) -> None:
    send_all(rows, transport, attempts, backoff, senders).write.mode("overwrite").parquet(path)


def deliver_batch(
    routed: DataFrame,
    transport: Transport,
    ledger: str,
    batch: int,
    attempts: int = HTTP_ATTEMPTS,
    backoff: float = 1.0,
    senders: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> None:
    """Send a batch under a ledger: what is to be sent is written before, the results after, chunk by chunk.

    The batch is opened once: one row per (message, project) that no earlier batch delivered, dealt into chunks by a hash
    of that key.  A chunk with a completed results folder is never sent again, so a batch that is replayed after a
    failure sends only what is open; at most one chunk is in doubt, and its messages carry the ids they had before.
    Failed deliveries count as done; replaying those is a separate step.
    """
    spark, ledger = routed.sparkSession, ledger.rstrip("/")
    opened, results = f"{ledger}/_opened/batch_id={batch}", f"{ledger}/batch_id={batch}"
    if not _committed(spark, opened):
        before = delivered(spark, ledger).filter("ok").select(F.col("message_id").alias("__m"), F.col("project").alias("__p"))
        same = (F.col("message_id") == F.col("__m")) & (F.col("project") == F.col("__p"))
        new = routed.select("message_id", "project", "payload").dropDuplicates(["message_id", "project"])
        new.join(before, same, "left_anti").write.mode("overwrite").parquet(opened)
    rows = spark.read.schema(routed.select("message_id", "project", "payload").schema).parquet(opened)
    chunks = -(-rows.count() // chunk_rows)
    # The number of chunks follows from the opened rows, so a replay deals them out alike.
    chunk = F.pmod(F.xxhash64("message_id", "project"), F.lit(max(chunks, 1)))
    for number in range(chunks):
        path = f"{results}/chunk={number}"
        if not _committed(spark, path):
            _send_chunk(rows.filter(chunk == number), path, transport, attempts, backoff, senders)


def publish(
    events: DataFrame, transport: Transport, topic: str = "events", backoff: float = 1.0, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Publish events as messages: two attempts, then the dead-letter table."""
    rows = to_messages(events).select("message_id", F.lit(topic).alias("project"), F.col("message").alias("payload"))
    return deliver(rows, transport, PUBLISH_ATTEMPTS, backoff, path)


def message_outcomes(results: DataFrame) -> DataFrame:
    """A message succeeds when at least one project accepted it."""
    return results.groupBy("message_id").agg(F.bool_or("ok").alias("ok"))


def counts(results: DataFrame) -> DataFrame:
    """Accepted messages per project, and message totals under NULL project."""
    per_project = results.filter("ok").groupBy("project").agg(
        F.count(F.lit(1)).alias("succeeded"), F.lit(0).cast("bigint").alias("failed")
    )
    totals = message_outcomes(results).agg(
        F.count_if(F.col("ok")).alias("succeeded"), F.count_if(~F.col("ok")).alias("failed")
    )
    return per_project.unionByName(totals.withColumn("project", F.lit(None).cast("string")))
