"""The same answers, kept up to date while files arrive.

Answers are built-in streaming aggregations, stateless projections, or small tables of partial
results (``runs.RunStore``) that every batch adds to. Update-mode results can name a key several
times; ``UpsertTable`` reads the newest version. ``SuccessCounts`` and ``ActivityTable`` need no bound on
how late a file may come: what arrives for a closed window is added as a correction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.parsing import is_adapter_metric, parse_metrics
from tracewell.functions.templates import CHATML, Template
from tracewell.operators.conversations import format_nested
from tracewell.operators.training_log import LOSS_THRESHOLD, stop_aggregates, stop_columns
from tracewell.schemas import TRIAL_RESULT
from tracewell.sources.artifacts import RESULT
from tracewell.streaming.runs import RunStore, Table, start


def metric_stream(spark: SparkSession, path: str) -> DataFrame:
    """Scraped metric files as they land: ``line, scraped_at`` (time of the file)."""
    return spark.readStream.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_modification_time").alias("scraped_at"),
    )


def result_stream(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """Trial results as their files land below ``<root>/<trial>/``."""
    documents = (
        spark.readStream.schema(TRIAL_RESULT).option("multiLine", True)
        .option("pathGlobFilter", RESULT).option("maxFilesPerTrigger", files_per_batch)
        .json(f"{root.rstrip('/')}/*")
    )
    return documents.select(
        "id", "task_name", "trial_name", "finished_at",
        F.col("verifier_result.rewards")["reward"].alias("reward"),
    )


def live_early_stop(log: DataFrame, threshold: float = LOSS_THRESHOLD) -> DataFrame:
    """Stop step and best losses per run; every update restates the whole answer of a run."""
    aggs = stop_aggregates(threshold)
    return stop_columns(log.groupBy("run_id").agg(*[c.alias(n) for n, c in aggs.items()]))


def live_success(
    results: DataFrame,
    finished: Column,
    watermark: str = "1 hour",
    width: str = "10 minutes",
) -> DataFrame:
    """Finished and passing trials per time window; a trial file seen twice counts once.
    Trials later than the watermark are left out; ``SuccessCounts`` takes them in."""
    timed = results.withColumn("finished_at", finished.cast("timestamp"))
    once = timed.withWatermark("finished_at", watermark).dropDuplicatesWithinWatermark(["id"])
    return (
        once.groupBy(F.window("finished_at", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_finished"),
            F.count_if(F.col("reward") >= 1).alias("n_passes"),
        )
        .select(F.col("w.start").alias("bucket_start"), "n_finished", "n_passes")
    )


def adapter_activity(scrapes: DataFrame, label: str, width: str = "1 minute") -> DataFrame:
    """Highest value and number of lines per window, metric and label value, from ``line, scraped_at``."""
    parsed = parse_metrics(scrapes.filter(is_adapter_metric(F.col("line"))))
    return (
        parsed.groupBy(
            F.window("scraped_at", width).alias("w"), "name",
            F.coalesce(F.col("labels")[label], F.lit("")).alias("label"),
        )
        .agg(F.max("value").alias("max_value"), F.count(F.lit(1)).alias("n_lines"))
        .select(F.col("w.start").alias("bucket_start"), "name", "label", "max_value", "n_lines")
    )


def live_adapter_activity(
    scrapes: DataFrame, label: str, watermark: str = "10 minutes", width: str = "1 minute"
) -> DataFrame:
    """``adapter_activity`` as a streaming aggregation; scrapes later than the watermark are left out."""
    return adapter_activity(scrapes.withWatermark("scraped_at", watermark), label, width)


def live_format(nested: DataFrame, template: Template = CHATML) -> DataFrame:
    """Format conversations as they arrive: stateless, append only."""
    return format_nested(nested, template)


@dataclass(frozen=True)
class UpsertTable:
    """Update-mode sink: the newest version of every key. Batches are sorted runs that are merged as they
    become many, and a batch that runs again after a lost executor or driver counts once."""

    spark: SparkSession
    path: str
    keys: Sequence[str]

    @property
    def store(self) -> RunStore:
        return RunStore(self.spark, self.path)

    @property
    def table(self) -> Table:
        return Table("rows", tuple(self.keys))

    def start(self, stream: DataFrame, checkpoint: str):
        store, table = self.store, self.table

        def take(batch: DataFrame, batch_id: int, _: dict) -> None:
            store.commit(batch_id, [(table, store.write_run(table, batch_id, batch))])

        return start(stream, store.each_batch(take), checkpoint, "update")

    def read(self) -> DataFrame:
        """Newest version of every key."""
        return self.store.read(self.table)


# --- late rows -------------------------------------------------------------------


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def _span_us(spark: SparkSession, length: str) -> int:
    return spark.range(1).select(_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {length}"))).first()[0]


@dataclass(frozen=True)
class SuccessCounts:
    """Finished and passing trials per time window, whatever the order in which their files land.

    The watermark is the latest finish of all earlier batches less ``delay``. A window that ends at or before
    it is closed, and a trial that arrives for it is late: it is kept in a table of its own, and unless it was counted
    before it is added to its window as a correction. A trial is known by its id and window, so a file
    that lands again counts once, however late. Rows without an id or a time are no finished trials.

    State is files, not memory: ids are looked up only from the earliest window of a batch on.
    """

    spark: SparkSession
    path: str
    delay: str = "1 hour"
    width: str = "10 minutes"
    counts: Table = field(default=Table(
        "counts", ("bucket_start",), {"n_finished": "sum", "n_passes": "sum", "n_corrected": "sum"}))
    trials: Table = field(default=Table("trials", ("bucket_start", "id")))
    late: Table = field(default=Table("late", ("batch", "bucket_start", "id")))

    @property
    def store(self) -> RunStore:
        return RunStore(self.spark, self.path)

    def start(self, results: DataFrame, finished: Column, checkpoint: str):
        """``results`` has id and reward; ``finished`` is its time."""
        store = self.store
        delay = _span_us(self.spark, self.delay)

        def take(batch: DataFrame, batch_id: int, now: dict) -> None:
            high = now["notes"].get("high")
            closed = F.lit(None if high is None else high - delay).cast("long")
            landed = (
                batch.select("id", finished.cast("timestamp").alias("finished_at"), F.col("reward").cast("double").alias("reward"))
                .filter("id is not null and finished_at is not null")
                .withColumn("w", F.window("finished_at", self.width))
                .select("id", "reward", "finished_at", F.col("w.start").alias("bucket_start"),
                        F.coalesce(_micros(F.col("w.end")) <= closed, F.lit(False)).alias("late"))
            )
            once = landed.groupBy("bucket_start", "id").agg(
                F.min(F.struct("finished_at", "reward")).alias("v"), F.max("late").alias("late"), F.count(F.lit(1)).alias("n_landed"))
            arrived = store.write_run(
                Table("arrived", ("bucket_start", "id")), batch_id, once.select("bucket_start", "id", "v.*", "late", "n_landed"))
            first, last = arrived.agg(F.min("bucket_start"), F.max(_micros(F.col("finished_at")))).first()
            if first is None:
                store.commit(batch_id, [])
                return
            known = store.rows("trials", "bucket_start TIMESTAMP, id STRING, late BOOLEAN").filter(F.col("bucket_start") >= F.lit(first))
            seen = known.select("bucket_start", "id", F.lit(True).alias("again"))
            marked = arrived.join(seen, ["bucket_start", "id"], "left").withColumn("again", F.coalesce("again", F.lit(False)))
            new = store.write_run(self.trials, batch_id, marked.filter("not again").select("bucket_start", "id", "late", "reward"))
            deltas = new.groupBy("bucket_start").agg(
                F.count(F.lit(1)).alias("n_finished"), F.count_if(F.col("reward") >= 1).alias("n_passes"),
                F.count_if("late").alias("n_corrected"))
            late = marked.filter("late").select(
                F.lit(batch_id).cast("long").alias("batch"), "bucket_start", "id", "finished_at", "reward", "n_landed",
                (~F.col("again")).alias("corrects"))
            store.commit(
                batch_id,
                [(self.trials, new), (self.counts, store.write_run(self.counts, batch_id, deltas)),
                 (self.late, store.write_run(self.late, batch_id, late))],
                high=last if high is None else max(high, last))

        return start(results, store.each_batch(take), checkpoint)

    def read(self) -> DataFrame:
        """bucket_start, n_finished, n_passes and how many of the finished came as corrections."""
        return self.store.read(self.counts)

    def late_trials(self) -> DataFrame:
        """Every late arrival: batch, window, id, finish, reward, files landed, and whether it corrected a count."""
        return self.store.read(self.late)

    def late_counts(self) -> DataFrame:
        """Per batch with late rows: files that landed late, and trials they added."""
        return self.late_trials().groupBy("batch").agg(
            F.sum("n_landed").alias("n_late"), F.count_if("corrects").alias("n_corrected"))


@dataclass(frozen=True)
class ActivityTable:
    """Highest value and number of lines per window, metric and label. Both combine in any order, so every
    batch adds its own figures and a scrape may come at any time."""

    spark: SparkSession
    path: str
    label: str
    width: str = "1 minute"
    table: Table = field(default=Table(
        "activity", ("bucket_start", "name", "label"), {"max_value": "max", "n_lines": "sum"}))

    @property
    def store(self) -> RunStore:
        return RunStore(self.spark, self.path)

    def start(self, scrapes: DataFrame, checkpoint: str):
        """``scrapes`` has line and scraped_at."""
        store = self.store

        def take(batch: DataFrame, batch_id: int, _: dict) -> None:
            own = adapter_activity(batch, self.label, self.width)
            store.commit(batch_id, [(self.table, store.write_run(self.table, batch_id, own))])

        return start(scrapes, store.each_batch(take), checkpoint)

    def read(self) -> DataFrame:
        return self.store.read(self.table)


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Append-mode file sink with exactly-once files."""
    return (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
