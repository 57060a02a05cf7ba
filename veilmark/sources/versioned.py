"""Parquet tables as versions: readers see one whole version, writers commit by one small file.

Below a table's folder lie data folders, each written once, and ``_log`` with one numbered file per version that names
the data folders of that version.  A commit writes the file aside and renames it to the next number; the rename refuses
a number that exists, so of two writers that started from the same version one fails and leaves nothing behind that a
reader could see.  That needs a file system whose rename does so (HDFS and local ones; object stores need a connector
with conditional writes).

A table may be cut into buckets by an expression over its rows.  An update then writes only the buckets that hold a hit
anew; the new version names the old folders of all others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import update_where

LOG = "_log"
BUCKET = "__bucket"


class ConcurrentCommit(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Version:
    """What a commit names: the schema, the bucket expression and the folder of every bucket ('' without buckets)."""

    number: int
    schema: str
    folders: Mapping[str, str]
    bucket: str | None = None

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema, "folders": dict(self.folders), "bucket": self.bucket})


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    as_path = jvm.org.apache.hadoop.fs.Path
    return as_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), as_path


def _entries(spark: SparkSession, path: str) -> list[int]:
    fs, as_path = _filesystem(spark, path)
    log = as_path(f"{path}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; None for a table that has none."""
    known = _entries(spark, path)
    if not known:
        return None
    number = known[-1] if number is None else number
    if number not in known:
        raise ValueError(f"{path} has no version {number}")
    text = spark.read.text(f"{path}/{LOG}/{number:020d}.json", wholetext=True).first()[0]
    return Version(number, **json.loads(text))


def commit(spark: SparkSession, path: str, after: Version | None, new: Version) -> Version:
    """Make ``new`` the version after ``after``; fails if another writer did so first."""
    fs, as_path = _filesystem(spark, path)
    jvm = spark.sparkContext._jvm
    target = as_path(f"{path}/{LOG}/{new.number:020d}.json")
    aside = as_path(f"{path}/{LOG}/.{uuid.uuid4().hex}.tmp")
    if new.number != (after.number if after else 0) + 1:
        raise ValueError("versions are numbered one by one")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(new.to_json().encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, target, nothing)
    except Exception as refused:
        fs.delete(aside, False)
        if fs.exists(target):
            raise ConcurrentCommit(f"{path}: version {new.number} was committed by another writer") from refused
        raise
    return new


def _buckets_below(spark: SparkSession, folder: str) -> dict[str, str]:
    fs, as_path = _filesystem(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(as_path(folder))]
    return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}


def stage(df: DataFrame, path: str, after: Version | None, bucket: str | None = None) -> Version:
    """Write ``df`` below ``path`` without committing it; nobody sees the result before ``commit``."""
    spark = df.sparkSession
    folder = f"{path}/data-{uuid.uuid4().hex}"
    number = (after.number if after else 0) + 1
    schema = df.schema.json()
    if bucket is None:
        df.write.parquet(folder)
        return Version(number, schema, {"": folder})
    rows = df.withColumn(BUCKET, F.expr(bucket).cast("string")).hint("rebalance", BUCKET)
    rows.write.partitionBy(BUCKET).parquet(folder)
    return Version(number, schema, _buckets_below(spark, folder), bucket)


def discard(spark: SparkSession, staged: Version, keep: Version | None = None) -> None:
    """Delete the data of a staged version that is not going to be committed, or of an old one."""
    kept = set(keep.folders.values()) if keep else set()
    for folder in set(staged.folders.values()) - kept:
        fs, as_path = _filesystem(spark, folder)
        fs.delete(as_path(folder), True)


def replace(df: DataFrame, path: str, bucket: str | None = None) -> DataFrame:
    """Write ``df`` as the next version of the table; the plan may read the table itself.

    ``bucket`` is a SQL expression over the columns, kept for later updates; by default that of the last version.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    last = version(spark, path)
    new = stage(df, path, last, bucket or (last.bucket if last else None))
    _commit_or_discard(spark, path, last, new)
    return read(spark, path, new.number)


def _commit_or_discard(spark: SparkSession, path: str, after: Version | None, new: Version) -> None:
    try:
        commit(spark, path, after, new)
    except ConcurrentCommit:
        discard(spark, new, after)
        raise


def _read(spark: SparkSession, found: Version, buckets: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(found.schema))
    folders = [folder for name, folder in sorted(found.folders.items()) if buckets is None or name in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version's rows, by default the newest at the time of the call; later commits do not change them."""
    found = version(spark, path.rstrip("/"), number)
    if found is None:
        raise ValueError(f"{path} holds no table")
    return _read(spark, found)


def rewrite(spark: SparkSession, path: str, touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> Version:
    """Replace the buckets that hold a row of ``touched(table)`` by ``change`` of their rows.

    ``change`` must keep every row in its bucket.  The names of the hit buckets, at most as many as the table has, come
    to the driver.
    """
    path = path.rstrip("/")
    last = version(spark, path)
    if last is None:
        raise ValueError(f"{path} holds no table")
    whole = _read(spark, last)
    if last.bucket is None:
        hit = [""] if touched(whole).limit(1).count() else []
    else:
        name = F.expr(last.bucket).cast("string").alias(BUCKET)
        hit = [r[0] or "__HIVE_DEFAULT_PARTITION__" for r in touched(whole).select(name).distinct().collect()]
    if not hit:
        return last
    new = stage(change(_read(spark, last, hit)), path, last, last.bucket)
    strangers = set(new.folders) - set(hit)
    if strangers:
        discard(spark, new)
        raise ValueError(f"{path}: the change moves rows to buckets {sorted(strangers)[:5]}")
    others = {name: folder for name, folder in last.folders.items() if name not in hit}
    new = Version(new.number, last.schema, {**others, **new.folders}, last.bucket)
    _commit_or_discard(spark, path, last, new)
    return new


def update(spark: SparkSession, path: str, cond: Column, values: Mapping[str, Column]) -> Version:
    """SQL UPDATE that writes only the buckets with a row to change."""
    return rewrite(spark, path, lambda t: t.filter(F.coalesce(cond, F.lit(False))), lambda t: update_where(t, cond, values))


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions and the data that only they name; returns how many went.

    Readers of an expired version fail; choose ``keep`` by the longest running reader.  Data that was staged and never
    committed is not known to any version and stays.
    """
    path = path.rstrip("/")
    if keep < 1:
        raise ValueError("the newest version cannot expire")
    numbers = _entries(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    named = {folder for n in kept for folder in version(spark, path, n).folders.values()}
    fs, as_path = _filesystem(spark, path)
    for number in old:
        for folder in set(version(spark, path, number).folders.values()) - named:
            fs.delete(as_path(folder), True)
        fs.delete(as_path(f"{path}/{LOG}/{number:020d}.json"), False)
    return len(old)
