"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on. Executor counts, memory and the number of
# shuffle partitions belong to the cluster, not to the library.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state (a row per run, per trial seen within the watermark) lives on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "tracewell", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder for intermediate tables.

    On a cluster it lies below the shared folder named in ``spark.checkpoint.dir``; a
    machine-local folder is used only in local mode with that setting missing (tests).
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if "local" not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH["local"] = tempfile.mkdtemp(prefix="tracewell-")
        shared = _LOCAL_SCRATCH["local"]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the scratch folder: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
