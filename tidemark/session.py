"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INT96 timestamps carry no row-group statistics, so nothing can be skipped by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Values of a list that reach the reader one by one, and so its Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # State of all keys on disk with each executor, and its changes in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    # A batch commits its changes only; whole states are written in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set, a session on one machine uses its warehouse; on a cluster that is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def new_scratch(spark: SparkSession, label: str = "work", root: str | None = None) -> str:
    return f"{root or shared_dir(spark)}/_stage/{label}-{uuid.uuid4().hex[:12]}"


class Stage:
    """Intermediate results written as Parquet, so that lineage ends there and sizes are known."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = new_scratch(spark, "stage", root)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, root: str | None = None):
    """A folder for intermediate results, under ``root`` (a table's own folder is shared by
    definition) or the shared folder, removed at the end."""
    from tidemark.sources.fs import Fs

    stage = Stage(spark, root)
    try:
        yield stage
    finally:
        Fs(spark, stage.root).delete(stage.root)
