"""Training logs: best loss, early stop, checkpoints, rewards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.text import py_strip
from tracewell.operators.blocks import ordered

LOSS_THRESHOLD = 0.1  # fixed value: default stop threshold, reached when loss <= it


def best_loss(log: DataFrame, **cutting) -> DataFrame:
    """Running minimum of the loss; entries without a loss are ignored."""
    rows = log.filter(F.col("loss").isNotNull())
    runs = ordered(rows, ["run_id"], ["step"], **cutting)
    return runs.running(best_loss=(F.col("loss"), "min")).rows()


def stop_aggregates(threshold: float = LOSS_THRESHOLD) -> dict[str, Column]:
    """Aggregates that decide the early stop of a run. They combine before any shuffle and
    also run on a stream. All losses before the stop lie above the threshold, so the best
    loss up to the stop is the loss at the stop itself."""
    hit = F.when(F.col("loss") <= threshold, F.struct("step", "loss"))
    return {"n_logged": F.count("loss"), "best_loss": F.min("loss"), "_hit": F.min(hit)}


def stop_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "run_id",
        "n_logged",
        F.col("_hit.step").alias("stop_step"),
        "best_loss",
        F.coalesce("_hit.loss", "best_loss").alias("best_loss_to_stop"),
    )


def early_stop(log: DataFrame, threshold: float = LOSS_THRESHOLD) -> DataFrame:
    """Per run: first step at or below the threshold (null when never) and best losses."""
    aggs = stop_aggregates(threshold)
    return stop_columns(log.groupBy("run_id").agg(*[c.alias(n) for n, c in aggs.items()]))


def trained_rows(log: DataFrame, threshold: float = LOSS_THRESHOLD) -> DataFrame:
    """Log rows up to and including the stop of their run."""
    stops = early_stop(log, threshold).select("run_id", "stop_step")
    return (
        log.join(stops, "run_id", "left")
        .filter(F.col("stop_step").isNull() | (F.col("step") <= F.col("stop_step")))
        .drop("stop_step")
    )


def newest_checkpoints(checkpoints: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` highest steps per run; Spark cuts each group to ``keep`` rows before
    the shuffle (window group limit)."""
    newest = Window.partitionBy("run_id").orderBy(F.desc("step"))
    return (
        checkpoints.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= keep)
        .drop("_rank")
    )


def exact_reward(completion: Column, answer: Column) -> Column:
    """1.0 when both texts agree after stripping, else 0.0."""
    return (py_strip(completion).eqNullSafe(py_strip(answer))).cast("double")


def group_advantage(
    rows: DataFrame, keys: Sequence[str], reward: str = "reward", epsilon: float = 1e-4
) -> DataFrame:
    """(reward - mean) / (population deviation + epsilon) within each group; 0 when all
    rewards of the group agree. Group figures come from partial aggregates."""
    stats = rows.groupBy(*keys).agg(
        F.avg(reward).alias("_mean"), F.stddev_pop(reward).alias("_std")
    )
    score = (F.col(reward) - F.col("_mean")) / (F.col("_std") + F.lit(epsilon))
    return (
        rows.join(stats, list(keys), "left")
        .withColumn("advantage", F.when(F.col("_std") == 0, F.lit(0.0)).otherwise(score))
        .drop("_mean", "_std")
    )
