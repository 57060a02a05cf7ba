"""Deduplication of a change stream that settles on the same row as the batch form.

``dedupe_stream`` keeps the first arrival.  Here a key's canonical repeat is kept: its best row so far waits
until the watermark passes the change, then it is published.  What arrives after that goes to a side
table.  Published, late and still waiting rows together give what ``cdc.dedupe_changes`` gives for the whole log.

``canonical_stream`` holds the waiting rows in Spark's state store, with a few calls per change from Python.
``write_canonical`` drains a stream of any size: it deduplicates whole micro-batches and holds the waiting rows as files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans import cdc

# Fixed value: the state store that has timers and several variables per key.
STORE_CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
VARIABLE = "best"
PREFERENCE = ("source", "data")
# Folders of the drain.
BATCH = "__batch"
WAITING = "waiting"


def _rank(row: Row | tuple, places: list[int]) -> tuple:
    """Sort key of a repeat, greatest first in batch terms; NULL is below every value."""
    return tuple((row[i] is not None, row[i] if row[i] is not None else "") for i in places)


class CanonicalRepeat(StatefulProcessor):
    """Best repeat of one change: state from its first arrival until the watermark passes its time."""

    def __init__(self, names: list[str], types: str):
        self.names, self.types = names, types
        self.places = [names.index(c) for c in PREFERENCE]
        self.time = names.index("ts")
        self.out = Row(*names, "late")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState(VARIABLE, self.types)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.best.get() if self.best.exists() else None
        best = known
        for row in rows:
            if known is None and self._late(row[self.time], timerValues.getCurrentWatermarkInMs()):
                yield self.out(*row, True)
            elif best is None or _rank(row, self.places) > _rank(best, self.places):
                best = tuple(row)
        if best is not known:
            self.best.update(tuple(best))
            if known is None:
                self.handle.registerTimer(best[self.time] * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self.out(*self.best.get(), False)
        self.best.clear()

    @staticmethod
    def _late(seconds: int | None, watermark: int) -> bool:
        return seconds is None or seconds * 1000 <= watermark

    def close(self) -> None:
        pass


def _one_per_batch(places: list[int], keys: list[str]):
    """Repeats inside one Arrow batch go before the shuffle, but for the best: a hot change sends few rows."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            order = [(names[i], "descending") for i in places]
            ranked = pa.Table.from_batches([batch]).sort_by(order)
            repeats = ranked.select(keys).to_pandas(integer_object_nulls=True).duplicated().to_numpy()
            yield from ranked.filter(pa.array(~repeats)).to_batches()

    return reduce


def canonical_stream(changes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Change stream with one canonical row per ``(xid, xoffset, ts)``, and ``late``.

    A change is published once, when the watermark (newest ``ts`` less ``delay``) has passed its time: the repeat with
    the greatest source name, then the greatest ``data``, NULL below all values, as in the batch form.  Rows that
    arrive later come out with ``late`` set; so do rows without ``ts`` or with one before 1970, which have no time.
    Columns of any name and type are carried; the stream must have no column ``late``.

    State holds one row per change inside the delay.  Before the shuffle repeats of a change are reduced to the best
    one of their Arrow batch, late ones too.
    """
    if "late" in changes.columns:
        raise ValueError("the change stream has a column named late")
    changes.sparkSession.conf.set(STORE_SETTING, STORE_CLASS)
    names, keys = changes.columns, list(cdc.CHANGE_KEY)
    places = [names.index(c) for c in PREFERENCE]
    reduced = changes.mapInArrow(_one_per_batch(places, keys), changes.schema)
    # The column with the watermark ends here: with it Spark would drop late rows before the processor sees them.
    timed = reduced.withColumn("__time", F.timestamp_seconds("ts")).withWatermark("__time", delay).drop("__time")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema.fields)
    return timed.groupBy(*keys).transformWithState(
        CanonicalRepeat(names, types), f"{types}, late boolean", "Append", "EventTime"
    )


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _states(spark: SparkSession, checkpoint: str) -> list[tuple[int, int, str]]:
    """``(batch, watermark in seconds, folder)`` of the waiting rows kept, oldest first."""
    fs, folder = _file_system(spark, f"{checkpoint}/{WAITING}")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    found = [(n.split("-"), n) for n in names if n.startswith("batch-")]
    return sorted((int(batch), int(until), f"{checkpoint}/{WAITING}/{n}") for (_, batch, until), n in found)


def _write_once(rows: DataFrame, target: str, *partitions: str) -> None:
    """A folder that appears whole; one that a replayed batch finds is left as it is."""
    spark = rows.sparkSession
    fs, path = _file_system(spark, target)
    if fs.exists(path):
        return
    staging = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_writing-{path.getName().replace('=', '-')}")
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(staging.toString())
    if not fs.rename(staging, path):
        raise RuntimeError(f"could not rename {staging} to {path}")


def _best(rows: DataFrame) -> DataFrame:
    return cdc.dedupe_changes(rows, tiebreak=[F.col(c).desc() for c in PREFERENCE[1:]])


def settle_batch(batch: DataFrame, batch_id: int, out: str, checkpoint: str, delay: str) -> None:
    """Publish what the watermark passes with this batch, write its late rows and what waits after it.

    Rows are late by the watermark before the batch, as in ``canonical_stream``.  A change is published or waits by its
    own time, so a batch that is replayed after either write gives the other one as it would have been.
    """
    if "late" in batch.columns:
        raise ValueError("the change stream has a column named late")
    spark = batch.sparkSession
    earlier = [s for s in _states(spark, checkpoint) if s[0] < batch_id]
    _, watermark, folder = earlier[-1] if earlier else (None, 0, None)
    behind = F.unix_seconds(F.timestamp_seconds("ts") - F.expr(f"INTERVAL {delay}"))
    reached = max(watermark, batch.agg(F.max(behind)).first()[0] or 0)
    in_time = F.coalesce(F.col("ts") > watermark, F.lit(False))
    rows = batch.filter(in_time)
    if folder:
        rows = rows.unionByName(spark.read.schema(batch.schema).parquet(folder))
    closed = _best(rows.filter(F.col("ts") <= reached)).withColumn("late", F.lit(False))
    late = _best(batch.filter(~in_time)).withColumn("late", F.lit(True))
    _write_once(closed.unionByName(late), f"{out}/{BATCH}={batch_id}", "late")
    _write_once(_best(rows.filter(F.col("ts") > reached)), f"{checkpoint}/{WAITING}/batch-{batch_id}-{reached}")
    for _, _, old in earlier[:-1]:
        fs, path = _file_system(spark, old)
        fs.delete(path, True)


def write_canonical(changes: DataFrame, out: str, checkpoint: str, delay: str = "1 hour"):
    """Drain the stream into ``out``, by batch and ``late``; what ``canonical_stream`` publishes, without Python rows.

    A batch costs one shuffle of its rows and of the rows inside the delay, which are written anew below ``checkpoint``.
    Its folders appear whole and once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        settle_batch(batch, batch_id, out, checkpoint, delay)

    return (
        changes.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _partition(spark: SparkSession, out: str, schema: T.StructType, late: bool) -> DataFrame:
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("late", T.BooleanType())])).parquet(out)
    return rows.filter(F.col("late") == late).select(*[F.col(f"`{c}`") for c in schema.names])


def published(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Changes the watermark has passed, one row each; ``schema`` is the stream's."""
    return _partition(spark, out, schema, False)


def late_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Side table: rows that came after their change was published, or without a time."""
    return _partition(spark, out, schema, True)


def waiting(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Best rows so far of changes the watermark has not passed, after the stream's last batch."""
    return spark.read.parquet(_states(spark, checkpoint)[-1][2])


def settled(spark: SparkSession, out: str, checkpoint: str, schema: T.StructType) -> DataFrame:
    """What the batch form gives for everything that has arrived: published, late and waiting rows, deduplicated."""
    rows = published(spark, out, schema).unionByName(late_rows(spark, out, schema))
    return _best(rows.unionByName(waiting(spark, checkpoint)))
