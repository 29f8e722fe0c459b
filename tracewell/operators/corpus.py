"""Task corpora: valid task folders and the latest snapshot, from path tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = "instruction.md"        # fixed value: the file a task folder must hold
VERSION_CONTROL = ".git"         # fixed value: names starting so are no tasks


def not_version_control(name: Column) -> Column:
    return ~F.startswith(name, F.lit(VERSION_CONTROL))


def relative_parts(path: Column, root: Column) -> Column:
    """Components below ``root``; null for paths elsewhere."""
    prefix = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"))
    below = F.startswith(path, prefix)
    rest = F.substring(path, F.char_length(prefix) + 1, F.char_length(path))
    return F.when(below, F.split(rest, "/"))


def task_names(files: DataFrame, root: Column | str, path: str = "path") -> DataFrame:
    """Direct child folders of ``root`` that hold the marker file."""
    root = F.lit(root) if isinstance(root, str) else root
    parts = files.select(relative_parts(F.col(path), root).alias("p"))
    return (
        parts.filter((F.size("p") == 2) & (F.get("p", 1) == MARKER))
        .select(F.get("p", 0).alias("task_name"))
        .filter(not_version_control(F.col("task_name")))
        .distinct()
    )


def keep_valid(tasks: DataFrame, valid: DataFrame, key: str = "task_name") -> DataFrame:
    return tasks.join(valid, key, "left_semi")


def snapshot_tasks(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per repository: latest snapshot by name, its number of valid tasks, and whether it
    is usable. Only the newest snapshot is looked at. One grouping: the struct maximum
    carries the snapshot, tasks are counted per snapshot before.

    ``files`` holds the keys, ``snapshot`` and ``rest`` (path below the snapshot).
    """
    parts = F.split("rest", "/")
    task = F.when(
        (F.size(parts) == 2)
        & (F.get(parts, 1) == MARKER)
        & not_version_control(F.get(parts, 0)),
        F.get(parts, 0),
    )
    tasks = files.select(*keys, "snapshot", task.alias("task")).distinct()
    per_snapshot = tasks.groupBy(*keys, "snapshot").agg(F.count("task").alias("n_tasks"))
    newest = per_snapshot.groupBy(*keys).agg(F.max(F.struct("snapshot", "n_tasks")).alias("s"))
    return newest.select(
        *keys,
        F.col("s.snapshot").alias("latest_snapshot"),
        F.col("s.n_tasks").alias("n_tasks"),
        (F.col("s.n_tasks") > 0).alias("usable"),
    )


def split_snapshot_path(path: Column) -> dict[str, Column]:
    """``<hub>/<folder>/snapshots/<snapshot>/<rest>`` -> its parts."""
    pattern = r"^(?:.*/)?([^/]+)/snapshots/([^/]+)/(.*)$"
    return {
        name: F.regexp_extract(path, pattern, i)
        for i, name in enumerate(("folder", "snapshot", "rest"), start=1)
    }
