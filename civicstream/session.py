"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB state store provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # Remove checkpoint files of intermediates once they are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "civicstream", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per shuffle partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store; the provider is fixed for a
    checkpoint's life, so it is set before a stateful query first starts."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    # a batch commits its changes instead of a snapshot of every store
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


#: Rows delivered to a stream that one partition of its state is made for.
STATE_ROWS = 1_000_000
#: The same if rows are kept as Arrow batches, none of them as an object.
PACKED_STATE_ROWS = 8_000_000


@contextmanager
def state_partitions(spark: SparkSession, rows: int, each: int = STATE_ROWS) -> Iterator[None]:
    """Queries first started inside keep their state in as many partitions as the cores can use and
    ``rows`` need at ``each`` a partition. Each partition of each stateful operator opens its stores, and
    each detector a Python worker, in every micro-batch, however few rows it has, and nothing merges
    small ones later."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(max(spark.sparkContext.defaultParallelism, -(-rows // each))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode, where all tasks share the driver's disk, is a private folder created
    when the setting is absent.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="civicstream-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables
    and streaming checkpoints (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def unique_scratch_path(spark: SparkSession, name: str) -> str:
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def env_root(default: str) -> str:
    """Output root from ``CIVICSTREAM_OUTPUT_ROOT`` (SNK-9)."""
    return os.environ.get("CIVICSTREAM_OUTPUT_ROOT", default)
