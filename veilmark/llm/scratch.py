"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from veilmark.session import scratch_dir

_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def folder(spark: SparkSession, label: str) -> str:
    """Fresh folder below the shared one, deleted by ``clear``."""
    path = scratch_dir(spark, f"llm-{label}")
    if not _WRITTEN:
        atexit.register(clear)
    _WRITTEN.append((spark, path))
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start here, also after a lost executor."""
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def clear() -> None:
    """Delete every stored table; results that still read them must have been written before."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        context = spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            continue
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
