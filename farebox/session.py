"""Spark session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on. They only switch on what Spark offers; nothing here depends on data size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # overwriting a partitioned table replaces the folders written to and no others
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # sessions of one key are merged inside a task before its rows are shuffled, which keeps a hot key small
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_local_scratch: tempfile.TemporaryDirectory | None = None
_scratch_paths: list[str] = []


def build_session(
    app_name: str = "farebox",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or fetch a session with the settings above.

    On a cluster pass ``shuffle_partitions`` as shuffled bytes / 128 MB; adaptive execution merges what turns out to
    be too small. Long-lived streams with much state are better off with the RocksDB state store (``extra`` takes
    ``spark.sql.streaming.stateStore.providerClass``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in BASE_CONF.items():
        spark.conf.set(key, value)
    return spark


def use_footer_counts(spark: SparkSession, enabled: bool = True) -> SparkSession:
    """Let ``count(*)``, ``min`` and ``max`` over bare parquet tables be answered from file footers."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", str(enabled).lower())
    if enabled:
        spark.conf.set("spark.sql.sources.useV1SourceList", "")
    else:
        spark.conf.unset("spark.sql.sources.useV1SourceList")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one under a local master only."""
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="farebox-")
    return f"file:{_local_scratch.name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; two calls never return the same one."""
    path = f"{shared_dir(spark)}/farebox/{name}-{uuid.uuid4().hex}"
    _scratch_paths.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete what lies at the scratch paths this process was given so far; returns how many there were.

    For the end of a run: frames that still read from them, and tables in databases there, are gone after it.
    """
    removed = 0
    while _scratch_paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_paths.pop())
        removed += place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return removed
