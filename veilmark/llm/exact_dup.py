"""Exact duplicates by 128-bit content hash, with the bytes compared inside every group.  DataFrame functions only.

Runs of white space count as one space and null as empty.  A first pass over the texts groups them by hash *and* bytes
(copies are combined before the shuffle); a hash with two different byte strings is a collision, and its rows are then
told apart by their bytes.  All other rows find their group by the hash alone, so no text travels twice.

Rows without an id never stand for a group that has an id; a group of such rows only has a null ``keep_id`` and all of
them are ``kept``.  Rows that repeat id and text are the same document: each carries the same decision.  Texts of any
length are hashed whole.  The smallest id decides, so nothing depends on ties.  An empty table gives no rows.  Columns
other than ``doc_id`` and ``text`` are not read; ``keep_first`` returns them all, whatever their names (of rows that
repeat id and text but differ in other columns, any one stays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import fresh, stored

WHITE = r"[\x20\x09-\x0D]+"
BITS = 128


def normalised(text: Column) -> Column:
    """Text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_duplicates(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``documents``.

    ``bits``, a multiple of 4, is the length of the grouping hash; the result does not depend on it.
    """
    texts = documents.select(F.col("doc_id"), normalised(F.col("text")).alias("body"))
    hashed = texts.select("doc_id", "body", F.sha2("body", 256).alias("text_sha256"))
    hashed = hashed.withColumn("hash", F.substring("text_sha256", 1, bits // 4))
    by_bytes = hashed.groupBy("hash", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(
        by_bytes.groupBy("hash").agg(
            F.count(F.lit(1)).alias("variants"),
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        ),
        "groups",
    )
    rows = hashed.select("doc_id", "text_sha256", "hash")
    result = rows.join(groups.filter("variants = 1"), "hash")
    if not groups.filter("variants > 1").isEmpty():
        collided = groups.filter("variants > 1").select("hash")
        apart = hashed.join(collided, "hash", "left_semi").join(by_bytes, ["hash", "body"])
        columns = ["doc_id", "text_sha256", "keep_id", "group_size"]
        result = result.select(columns).unionByName(apart.select(columns))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return result.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` without copies, all columns; of rows that repeat id and text one stays."""
    own, kept_id, kept_hash, times = fresh(documents.columns, "own_hash", "kept_id", "kept_hash", "times")
    decisions = exact_duplicates(documents).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    decisions = stored(decisions, "kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_hash), F.col("n").alias(times))
    rows = documents.withColumn(own, F.sha2(normalised(F.col("text")), 256))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_hash))
    stays = rows.join(decisions.filter(F.col(times) == 1), same, "left_semi")
    if not decisions.filter(F.col(times) > 1).isEmpty():
        again = rows.join(decisions.filter(F.col(times) > 1), same, "left_semi").dropDuplicates(["doc_id", own])
        stays = stays.unionByName(again)
    return stays.drop(own)
