"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Semantics, not tuning: results depend on these.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Run-time re-planning: split skewed join partitions, merge small ones.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
# Driver speed, fixed when the session starts: without it PySpark walks the Python stack for every column expression,
# which takes longer than planning for tables with many columns.
DRIVER = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in {**REQUIRED, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for an input size, so that one fits a task's memory share."""
    partitions = max(200, -(-input_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def local_session(cpus: int | str = "*", app: str = "veilmark", memory: str = "12g") -> SparkSession:
    """Session for tests and local benchmarks; clusters bring their own."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in DRIVER.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a local one only where unset."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="veilmark-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared checkpoint folder for tables written by a job."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python tasks (the job's ``--py-files``)."""
    import shutil
    from pathlib import Path

    context = spark.sparkContext
    if any("veilmark" in str(f) for f in context.listFiles):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="veilmark-ship-")) / "veilmark"
    context.addPyFile(shutil.make_archive(str(target), "zip", root.parent, root.name))
