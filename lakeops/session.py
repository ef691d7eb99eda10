"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Bytes of shuffle input one reducer should get: small enough to sort in memory, large enough to keep task overhead low.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def build_session(app: str = "lakeops", master: str | None = None, shuffle_bytes: int | None = None, **conf) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE with skew handling, RocksDB state).

    ``shuffle_bytes`` is the expected size of the largest shuffle; AQE starts from enough partitions for it and merges the
    small ones at run time, so the same job runs on a laptop and on 100 TB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_bytes:
        partitions = max(200, -(-shuffle_bytes // TARGET_PARTITION_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster it would not be visible to the executors.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lakeops-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder."""
    return f"{_checkpoint_dir(spark)}/lakeops-{uuid.uuid4().hex}"


def computed_once(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, for a derived frame that is read more than once."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()
