"""Sinks: training text, run results, previews, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracewell.functions.text import is_blank, preview
from tracewell.operators.conversations import DROP_REASONS, training_text


def write_training_text(formatted: DataFrame, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write the texts and return the sizes before and after and the drops per reason,
    counted during the write. Drops are seen only when ``formatted`` still holds them."""
    reason = F.col("drop_reason")
    sizes = Observation()
    counted = formatted.observe(
        sizes,
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(reason.isNull() & ~is_blank(F.col("text"))).alias("n_after"),
        *[F.count_if(reason.eqNullSafe(r)).alias(f"n_{r}") for r in DROP_REASONS],
    )
    training_text(counted).write.mode("errorifexists").format(fmt).save(path)
    return sizes.get


def write_results(
    rows: DataFrame, path: str, run_ts: Column, job_name: Column, fmt: str = "parquet"
) -> None:
    """Append below ``run_ts=.../job_name=...``, the layout later reads prune on. Rows are
    gathered by job before writing, so a job gets few files; a very large job is split
    again by adaptive execution."""
    placed = rows.withColumns({"run_ts": run_ts, "job_name": job_name})
    layout = ["run_ts", "job_name"]
    gathered = placed.hint("rebalance", *layout)
    gathered.write.mode("append").partitionBy(*layout).format(fmt).save(path)


def first_row_preview(formatted: DataFrame, key: str, limit: int | None = 500) -> DataFrame:
    """First row by key; ``limit`` characters and dots, or the whole text for None."""
    first = formatted.orderBy(key).limit(1)
    return first if limit is None else first.withColumn("text", preview(F.col("text"), limit))


def summary_document(summary: DataFrame, out: str = "document") -> DataFrame:
    """Each summary row as one JSON text."""
    return summary.select(F.to_json(F.struct(*summary.columns)).alias(out))


def first_lines(text: Column, n: int) -> Column:
    return F.substring_index(text, "\n", n)
