"""Checked streams: derived tables written to files, read as a stream until all files are
taken in, and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell import schemas
from tracewell.functions.text import micros, parse_iso
from tracewell.operators import conversations as C
from tracewell.operators import trials as B
from tracewell.plans import views as V
from tracewell.plans.agent_runs import LOSSES
from tracewell.plans.catalog import ctes, query
from tracewell.plans.names_and_lines import METRICS, metric_table
from tracewell.plans.training_data import KEEP, NOISY, formatted_sql
from tracewell.session import scratch_dir
from tracewell.streaming import live

FILES_PER_BATCH = 1000


def _file_stream(spark, rows, fmt: str, schema: str):
    path = scratch_dir(spark, "stream-in")
    rows.write.format(fmt).save(path)
    stream = spark.readStream.schema(schema).format(fmt)
    return stream.option("maxFilesPerTrigger", FILES_PER_BATCH).load(path)


def _upserted(spark, stream, keys):
    table = live.UpsertTable(spark, scratch_dir(spark, "stream-out"), keys)
    table.start(stream, scratch_dir(spark, "stream-state")).awaitTermination()
    return table.read()


@query("stream_early_stop", ctes(loss_log=LOSSES, stops="""
SELECT run_id, count(loss) AS n_logged, min(step) FILTER (WHERE loss <= 0.1) AS stop_step,
  min(loss) AS best_loss FROM loss_log GROUP BY run_id""") + """
SELECT s.run_id, s.n_logged, s.stop_step, s.best_loss, min(l.loss) AS best_loss_to_stop
FROM stops s JOIN loss_log l ON l.run_id = s.run_id AND (s.stop_step IS NULL OR l.step <= s.stop_step)
GROUP BY s.run_id, s.n_logged, s.stop_step, s.best_loss""")
def stream_early_stop(spark, sf):
    log = _file_stream(spark, V.loss_log(spark, sf), "parquet", schemas.LOSS_LOG)
    return _upserted(spark, live.live_early_stop(log), ["run_id"])


RATED = ctes(trials=V.SQL["trials"], rewards=V.SQL["rewards"], rated="""
SELECT t.trial_id, epoch_us(started_at) + duration_us AS finished_us, reward
FROM trials t LEFT JOIN rewards r ON r.trial_id = t.trial_id""")
#: Trials land in three waves; the second and third repeat trials of the first.
WAVES = ("id % 10 < 5", "id % 10 between 5 and 7 or id % 20 = 0", "id % 10 >= 8 or id % 30 = 0")


def _rated(spark, sf):
    rated = B.trial_table(V.trials(spark, sf), "trial_id", V.rewards(spark, sf))
    finished = F.timestamp_micros(micros(F.col("started_at")) + F.col("duration_us"))
    return rated.select(
        F.col("trial_id").cast("string").alias("id"),
        F.date_format(finished, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("finished_at"),
        F.col("reward").cast("double").alias("reward"),
    )


def _landed(spark, waves) -> live.SuccessCounts:
    """Counts over files that land wave after wave, at the default watermark."""
    counts = live.SuccessCounts(spark, scratch_dir(spark, "stream-out"))
    path, state = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-state")
    for wave in waves:
        wave.write.mode("append").json(path)
        stream = spark.readStream.schema("id STRING, finished_at STRING, reward DOUBLE").json(path)
        counts.start(stream, parse_iso(F.col("finished_at")), state).awaitTermination()
    return counts


@query("stream_success", RATED + """
SELECT finished_us // 600000000 * 600 AS bucket_sec,
  count(*) AS n_finished, count(*) FILTER (WHERE reward >= 1) AS n_passes
FROM rated GROUP BY 1""")
def stream_success(spark, sf):
    rows = _rated(spark, sf)
    # Every tenth trial lands twice.
    twice = rows.unionByName(rows.filter(F.col("id").cast("long") % 10 == 0))
    out = _landed(spark, [twice]).read()
    return out.select(F.unix_seconds("bucket_start").alias("bucket_sec"), "n_finished", "n_passes")


LATE = f"""
WITH landed AS ({" UNION ALL ".join(
    f"SELECT trial_id AS id, finished_us, reward, {n} AS wave FROM rated WHERE {w.replace('id %', 'trial_id %')}"
    for n, w in enumerate(WAVES))}
), highs AS (
  SELECT w.n AS wave, max(finished_us) - 3600000000 AS closed FROM landed, range(1, 3) w(n) WHERE wave < w.n GROUP BY 1
), marked AS (
  SELECT l.*, finished_us // 600000000 * 600 AS bucket_sec,
    coalesce((finished_us // 600000000 + 1) * 600000000 <= closed, false) AS late,
    row_number() OVER (PARTITION BY id ORDER BY l.wave) = 1 AS counts
  FROM landed l LEFT JOIN highs h ON h.wave = l.wave
)"""


@query("stream_success_late", RATED + f"""SELECT * FROM ({LATE}
SELECT bucket_sec, count(*) FILTER (WHERE counts) AS n_finished,
  count(*) FILTER (WHERE counts AND reward >= 1) AS n_passes, count(*) FILTER (WHERE counts AND late) AS n_corrected
FROM marked GROUP BY 1) t""")
def stream_success_late(spark, sf):
    rows = _rated(spark, sf).withColumn("n", F.col("id").cast("long"))
    waves = [rows.filter(w.replace("id %", "n %")).drop("n") for w in WAVES]
    out = _landed(spark, waves).read()
    return out.select(F.unix_seconds("bucket_start").alias("bucket_sec"), "n_finished", "n_passes", "n_corrected")


@query("stream_late_counts", RATED + f"""SELECT * FROM ({LATE}
SELECT CAST(wave AS BIGINT) AS batch, count(*) AS n_late, count(*) FILTER (WHERE counts) AS n_corrected
FROM marked WHERE late GROUP BY 1) t""")
def stream_late_counts(spark, sf):
    rows = _rated(spark, sf).withColumn("n", F.col("id").cast("long"))
    return _landed(spark, [rows.filter(w.replace("id %", "n %")).drop("n") for w in WAVES]).late_counts()


@query("stream_format", formatted_sql(NOISY, f"SELECT conv_id, text, n_turns {KEEP}"))
def stream_format(spark, sf):
    nested = C.nest_turns(V.noisy_conversations(spark, sf))
    stream = _file_stream(spark, nested, "json", schemas.CONVERSATIONS)
    path = scratch_dir(spark, "stream-out")
    formatted = live.live_format(stream).drop("drop_reason")
    live.append_to(formatted, path, scratch_dir(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)


@query("stream_adapter_activity", ctes(m=METRICS) + """
SELECT epoch_us(ts) // 60000000 * 60 AS bucket_sec, 'vllm:lora_requests_info' AS name,
  regexp_extract(line, 'running_lora_adapters="([^"]*)"', 1) AS label,
  max(CAST(regexp_extract(line, '([0-9.]+)$', 1) AS DOUBLE)) AS max_value, count(*) AS n_lines
FROM m WHERE line LIKE 'vllm:lora%running%' GROUP BY ALL""")
def stream_adapter_activity(spark, sf):
    lines = metric_table(spark, sf).select("line", F.col("ts").cast("timestamp").alias("scraped_at"))
    stream = _file_stream(spark, lines, "parquet", "line STRING, scraped_at TIMESTAMP")
    table = live.ActivityTable(spark, scratch_dir(spark, "stream-out"), "running_lora_adapters")
    table.start(stream, scratch_dir(spark, "stream-state")).awaitTermination()
    return table.read().select(
        F.unix_seconds("bucket_start").alias("bucket_sec"), "name", "label", "max_value", "n_lines"
    )
