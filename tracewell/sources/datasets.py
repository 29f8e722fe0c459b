"""Conversation datasets, metric scrapes and task corpora."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import schemas
from tracewell.functions.parsing import parse_metrics
from tracewell.operators.corpus import snapshot_tasks, split_snapshot_path, task_names
from tracewell.sources.artifacts import _plain, list_files


def read_conversations(
    spark: SparkSession,
    path: str,
    config: str | None = None,
    split: str | None = None,
    fmt: str = "parquet",
    schema: str = schemas.CONVERSATIONS,
) -> DataFrame:
    """Conversations of one config and split; both are partition columns of the folder, so
    other partitions are not read."""
    wanted = {"config": config, "split": split}
    named = {k: v for k, v in wanted.items() if v is not None}
    full = ", ".join([schema, *[f"{k} STRING" for k in named]])
    df = spark.read.schema(full).format(fmt).load(path)
    for column, value in named.items():
        df = df.filter(F.col(column) == value)
    return df.drop(*named)


def read_metric_scrapes(spark: SparkSession, path: str) -> DataFrame:
    """Text files of scraped metrics -> name, labels, value and the file's time."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_modification_time").alias("scraped_at"),
    )
    return parse_metrics(lines).drop("line")


def valid_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Task folders directly below ``root``."""
    return task_names(list_files(spark, root, "instruction.md"), _plain(F.lit(root)))


def find_dataset(spark: SparkSession, hub: str, repo_id: str) -> DataFrame:
    """``path, n_tasks`` of a repository's latest snapshot; no row when the repository is not
    there or its latest snapshot holds no valid task."""
    base = f"{hub.rstrip('/')}/datasets--{repo_id.replace('/', '--')}"
    try:
        found = latest_snapshots(spark, base)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path STRING, n_tasks BIGINT")
    path = F.concat(F.lit(f"{base}/snapshots/"), F.col("latest_snapshot"))
    return found.filter("usable").select(path.alias("path"), "n_tasks")


def latest_snapshots(spark: SparkSession, hub: str) -> DataFrame:
    """Latest usable snapshot of every repository below a cache folder. Snapshots are known
    from the files in them, as on any object store; one without files does not exist."""
    files = list_files(spark, hub)
    parts = split_snapshot_path(F.col("path"))
    return snapshot_tasks(
        files.select(*[c.alias(n) for n, c in parts.items()]).filter(F.col("folder") != ""),
        ["folder"],
    )
