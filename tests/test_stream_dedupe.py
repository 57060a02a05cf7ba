"""The stateful change deduplication against its batch form."""

from __future__ import annotations

from pyspark.sql import types as T

from veilmark.plans import cdc
from veilmark.streaming import late_rows, published, settled, waiting, write_canonical
from veilmark.streaming.canonical import _one_per_batch

ROW = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("xid", "xoffset", "ts")],
        *[T.StructField(c, T.StringType()) for c in ("source", "data")],
        T.StructField("extra", T.ArrayType(T.IntegerType())),
    ]
)
HOUR = 3600
BASE = 1_700_000_000


def deliver(spark, root, rows):
    """One file arrives and the stream drains it."""
    batch = spark.createDataFrame(rows, ROW).coalesce(1)
    batch.write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(ROW).parquet(f"{root}/in")
    write_canonical(stream, f"{root}/out", f"{root}/state").awaitTermination()


def found(df):
    return sorted(((r.xid, r.ts, r.source, r.data) for r in df.collect()), key=str)


def test_late_out_of_order_and_differing_repeats(spark, tmp_path):
    root = str(tmp_path)
    first = (1, 1, BASE, "history", "a", [1])
    deliver(spark, root, [first, (2, 1, BASE + HOUR // 2, "replica", None, None)])
    assert published(spark, f"{root}/out", ROW).count() == 0 and waiting(spark, f"{root}/state").count() == 2
    # A better repeat of a waiting change, a worse one, one that ties in source, and one older than all so far.
    deliver(
        spark,
        root,
        [
            (1, 1, BASE, "replica", "b", None),
            (2, 1, BASE + HOUR // 2, "history", "z", None),
            (2, 1, BASE + HOUR // 2, "replica", "c", [2, 3]),
            (3, 1, BASE - HOUR // 4, "history", "older", []),
        ],
    )
    assert late_rows(spark, f"{root}/out", ROW).count() == 0
    deliver(spark, root, [(4, 1, BASE + 10 * HOUR, "history", "now", None)])
    closed = [(1, BASE, "replica", "b"), (2, BASE + HOUR // 2, "replica", "c"), (3, BASE - HOUR // 4, "history", "older")]
    assert found(published(spark, f"{root}/out", ROW)) == sorted(closed, key=str)
    assert found(waiting(spark, f"{root}/state")) == [(4, BASE + 10 * HOUR, "history", "now")]
    # After the watermark: a better repeat of a published change, a change never seen, rows without time or key.
    after = [
        (1, 1, BASE, "zulu", "late", None),
        (5, 1, BASE, "history", "new but late", None),
        (6, 1, None, "history", "no time", None),
        (None, None, BASE + 10 * HOUR, None, None, None),
        (None, None, BASE + 10 * HOUR, None, "x", None),
    ]
    deliver(spark, root, after)
    assert found(published(spark, f"{root}/out", ROW)) == sorted(closed, key=str)
    assert {r.data for r in late_rows(spark, f"{root}/out", ROW).collect()} == {"late", "new but late", "no time"}
    whole = cdc.dedupe_changes(spark.read.schema(ROW).parquet(f"{root}/in"))
    assert found(settled(spark, f"{root}/out", f"{root}/state", ROW)) == found(whole)
    arrays = settled(spark, f"{root}/out", f"{root}/state", ROW).filter("xid = 2").first()
    assert arrays.extra == [2, 3]


def test_a_hot_change_is_published_once(spark, tmp_path):
    root = str(tmp_path)
    hot = [(1, 1, BASE, f"s{i:05d}", str(i), None) for i in range(20_000)]
    deliver(spark, root, [*hot, *[(i, 2, BASE + i, "history", "x", None) for i in range(2, 200)]])
    deliver(spark, root, [(1, 3, BASE + 5 * HOUR, "history", "end", None)])
    rows = published(spark, f"{root}/out", ROW)
    assert rows.count() == 199 and rows.filter("xid = 1").first().source == "s19999"
    assert late_rows(spark, f"{root}/out", ROW).count() == 0


def test_repeats_inside_a_batch_go_first():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"xid": [1, 1, None, None, 2], "ts": [5] * 5, "source": ["b", "c", None, "a", None], "data": ["x", None, "y", None, "z"]}
    )
    left = [b.to_pylist() for b in _one_per_batch([2, 3], ["xid", "ts"])(iter([batch]))]
    assert sorted(((r["xid"], r["source"]) for rows in left for r in rows), key=str) == [(1, "c"), (2, None), (None, "a")]


def test_an_empty_stream(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, root, [])
    deliver(spark, root, [(1, 1, BASE, "history", "a", None), (1, 1, BASE + 5 * HOUR, "history", "b", None)])
    assert found(settled(spark, f"{root}/out", f"{root}/state", ROW)) == [
        (1, BASE, "history", "a"),
        (1, BASE + 5 * HOUR, "history", "b"),
    ]
    assert late_rows(spark, f"{root}/out", ROW).count() == 0


def test_a_drain_calls_no_python_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    from veilmark.streaming import canonical

    root = str(tmp_path)
    deliver(spark, root, [(i, 1, BASE + i, "history", "a", None) for i in range(100)])
    deliver(spark, root, [(i, 1, BASE + i, "replica", "b", None) for i in range(50)] + [(7, 7, BASE + 9 * HOUR, "x", "y", None)])
    deliver(spark, root, [(1, 1, BASE + 1, "zulu", "late", None), (1, 1, BASE + 1, "zulu", "later", None)])
    states = canonical._states(spark, f"{root}/state")
    assert [s[:2] for s in states] == [(1, BASE + 8 * HOUR), (2, BASE + 8 * HOUR)]
    seen = found(settled(spark, f"{root}/out", f"{root}/state", ROW))
    assert found(late_rows(spark, f"{root}/out", ROW)) == [(1, BASE + 1, "zulu", "later")]
    replay = spark.createDataFrame([(1, 1, BASE + 1, "zulu", "later", None)], ROW)
    canonical.settle_batch(replay, 2, f"{root}/out", f"{root}/state", "1 hour")
    assert found(settled(spark, f"{root}/out", f"{root}/state", ROW)) == seen
    assert published(spark, f"{root}/out", ROW).count() == 100 and len(seen) == 101
    plan = waiting(spark, f"{root}/state")._jdf.queryExecution().toString()
    assert "statestore" not in plan.lower()


def test_the_drain_equals_the_stateful_stream(spark, tmp_path):
    from veilmark.streaming import canonical_stream

    root = str(tmp_path)
    for rows in (
        [(i, 1, BASE + 60 * i, "history", "a", None) for i in range(200)],
        [(i, 1, BASE + 60 * i, "replica", "b", None) for i in range(0, 300, 3)] + [(1, 1, None, "history", None, None)],
    ):
        deliver(spark, root, rows)
        stream = canonical_stream(spark.readStream.schema(ROW).parquet(f"{root}/in"))
        stream.writeStream.format("parquet").option("path", f"{root}/plain").option(
            "checkpointLocation", f"{root}/plain-state"
        ).trigger(availableNow=True).start().awaitTermination()
    plain = spark.read.parquet(f"{root}/plain")
    assert found(published(spark, f"{root}/out", ROW)) == found(plain.filter("NOT late"))
    assert found(late_rows(spark, f"{root}/out", ROW)) == found(plain.filter("late"))
