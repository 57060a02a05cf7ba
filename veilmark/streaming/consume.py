"""Structured Streaming consumer: drain what is there, deliver, record outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import events


def message_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages from files of ``{"message_id", "message"}`` JSON lines."""
    return (
        spark.readStream.schema("message_id string, message string")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def consume_stream(
    spark: SparkSession,
    path: str,
    market_projects: Mapping[str, Sequence[str] | str | None],
    transport: events.Transport,
    out: str,
    checkpoint: str,
    attempts: int = events.HTTP_ATTEMPTS,
    backoff: float = 1.0,
    files_per_batch: int = 1000,
    senders: int | None = None,
    chunk_rows: int = events.CHUNK_ROWS,
):
    """Drain the message folder and stop; results land in ``out`` by batch.

    ``out`` is a ledger (``events.deliver_batch``): a batch that is replayed after a lost driver sends only what has no
    result yet, and a message that an earlier batch delivered is not sent again.  Failed deliveries stay in the results
    table; replaying them is a separate step.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = events.route(events.read_messages(batch), market_projects)
        events.deliver_batch(routed, transport, out, batch_id, attempts, backoff, senders, chunk_rows)

    return (
        message_stream(spark, path, files_per_batch)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(changes: DataFrame, delay: str = "1 hour", time_column: str = "event_time") -> DataFrame:
    """Change stream without repeats of ``(xid, xoffset, ts)`` inside the watermark.

    Keeps the first arrival, which equals the batch form when repeats are
    identical; state is bounded by the watermark.
    """
    timed = changes
    if time_column not in changes.columns:
        timed = changes.withColumn(time_column, F.timestamp_seconds("ts"))
    return timed.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["xid", "xoffset", "ts"])
