"""Session construction, shared scratch space and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants; anything site specific comes from the caller or the environment.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole pages and documents go through the Arrow functions: keep a batch of them small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # first-seen state outgrows the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}

# environment variable -> Spark setting, for tables kept in an object store
STORAGE_ENV = {
    "JOBMELD_S3_ENDPOINT": "spark.hadoop.fs.s3a.endpoint",
    "JOBMELD_S3_ACCESS_KEY": "spark.hadoop.fs.s3a.access.key",
    "JOBMELD_S3_SECRET_KEY": "spark.hadoop.fs.s3a.secret.key",
    "JOBMELD_S3_PATH_STYLE": "spark.hadoop.fs.s3a.path.style.access",
}


def build_session(
    app: str = "jobmeld", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """Session with the base settings, storage settings from the environment, then `conf`."""
    settings = dict(BASE_CONF)
    settings.update({k: os.environ[e] for e, k in STORAGE_ENV.items() if e in os.environ})
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="jobmeld-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/jobmeld-scratch/{label}-{uuid.uuid4().hex}"


def expire_scratch(spark: SparkSession, age_seconds: float) -> int:
    """Delete scratch tables last written `age_seconds` ago or earlier; returns how many went.

    Never called by a query. The age must exceed the longest time a frame over one stays in use.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/jobmeld-scratch")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    limit = (time.time() - age_seconds) * 1000
    old = [s.getPath() for s in fs.listStatus(base) if s.getModificationTime() <= limit]
    for path in old:
        fs.delete(path, True)
    return len(old)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str, partition_by: str) -> DataFrame:
    """The frame as a table in the shared folder, so that a filter on `partition_by` reads its share only."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
