"""Checked scans: artifacts rendered from the derived tables, written to a packed table in
the scratch folder, and read back by the readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.text import micros, parse_iso
from tracewell.operators import trials as B
from tracewell.plans import views as V
from tracewell.plans.agent_runs import FAILING
from tracewell.plans.catalog import ctes, query
from tracewell.plans.names_and_lines import CONSOLES, METRICS, consoles, metric_table
from tracewell.session import scratch_dir
from tracewell.sources import artifacts as A
from tracewell.sources.datasets import read_metric_scrapes

TRIALS, REWARDS = V.SQL["trials"], V.SQL["rewards"]
NAME_SQL = "concat(task_name, '__', CAST(trial_id AS VARCHAR))"
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _named(df: DataFrame) -> DataFrame:
    name = F.concat("task_name", F.lit("__"), F.col("trial_id").cast("string"))
    return df.withColumn("trial_name", name)


def _trial_names(spark, sf) -> DataFrame:
    return _named(V.trials(spark, sf)).select("trial_id", "trial_name")


def packed(spark, **files: DataFrame) -> A.PackedRun:
    """Write ``trial_name, body`` tables under their file names, in one job."""
    path = scratch_dir(spark, "run")
    parts = [
        rows.select("trial_name", "body", F.lit(getattr(A, constant)).alias("file"))
        for constant, rows in files.items()
    ]
    A.write_packed(reduce(DataFrame.unionByName, parts), path)
    return A.PackedRun(spark, path)


def render_transcript(
    prompt: Column, instruction: Column, turns: Column, status: Column, messages: Column,
    signal: Column,
) -> Column:
    """Text in the format of a recorded transcript, to have something to parse."""

    def shown(reply: Column, i: Column) -> Column:
        head = F.concat(
            F.lit(f"\n{A._NARROW}\nITERATION "), (i + 1).cast("string"), F.lit(f"\n{A._NARROW}\n\n")
        )
        said = F.concat(F.lit(A._REPLY_MARK), reply, F.lit("\n\n"))
        return F.concat(head, F.coalesce(said, F.lit("")))

    return F.concat(
        F.lit(A._PROMPT_HEAD), prompt, F.lit(A._TASK_HEAD), instruction, F.lit(A._LOG_HEAD),
        F.array_join(F.transform(turns, shown), ""),
        F.lit(A._END_HEAD),
        F.lit("Status: "), status,
        F.lit("\nTotal iterations: "), F.size(turns).cast("string"),
        F.lit("\nTotal messages in conversation: "), messages.cast("string"),
        F.lit("\nTask complete signal detected: "), F.initcap(signal.cast("string")),
        F.lit(f"\n{A._WIDE}\n"),
    )


def config_files(spark, sf) -> DataFrame:
    agent = F.struct(
        F.lit("agents:Shell").alias("import_path"), F.col("model_name"),
        F.create_map(F.lit("api_base"), F.concat(F.lit("http://host-"), "model_name"))
        .alias("kwargs"),
    )
    body = F.to_json(
        F.struct(
            F.struct(F.col("task_name").alias("path"), F.lit(False).alias("overwrite"))
            .alias("task"),
            F.col("trial_name"), F.lit(1.0).alias("timeout_multiplier"), agent.alias("agent"),
            F.concat(F.lit("job-"), "model_name").alias("job_id"),
        )
    )
    return _named(V.trials(spark, sf)).select("trial_name", body.alias("body"))


def result_files(spark, sf) -> DataFrame:
    started = F.col("started_at")
    finished = F.timestamp_micros(micros(started) + F.col("duration_us"))
    rated = B.trial_table(
        V.trials(spark, sf).filter("has_result"), "trial_id", V.rewards(spark, sf)
    )
    span = F.struct(
        F.date_format(started, STAMP).alias("started_at"),
        F.date_format(finished, STAMP).alias("finished_at"),
    )
    reward = F.when(
        F.col("reward").isNotNull(),
        F.struct(F.create_map(F.lit("reward"), F.col("reward").cast("double")).alias("rewards")),
    )
    meta = F.struct("iterations", "conversation_length")
    body = F.to_json(
        F.struct(
            F.md5(F.col("trial_id").cast("string")).alias("id"), F.col("task_name"),
            F.col("trial_name"), F.struct(meta.alias("metadata")).alias("agent_result"),
            reward.alias("verifier_result"), span["started_at"].alias("started_at"),
            span["finished_at"].alias("finished_at"), span.alias("agent_execution"),
        ),
        {"ignoreNullFields": "false"},
    )
    return _named(rated).select("trial_name", body.alias("body"))


def reward_files(spark, sf) -> DataFrame:
    rows = V.rewards(spark, sf).join(_trial_names(spark, sf), "trial_id")
    return rows.select(
        "trial_name", F.concat(F.col("reward").cast("string"), F.lit("\n")).alias("body")
    )


def exception_files(spark, sf) -> DataFrame:
    return V.trial_exceptions(spark, sf).join(_trial_names(spark, sf), "trial_id").select(
        "trial_name", F.concat("body", F.lit("\n")).alias("body")
    )


def log_files(spark, sf) -> DataFrame:
    return V.failure_lines(spark, sf).join(_trial_names(spark, sf), "trial_id").select(
        "trial_name", F.concat("line", F.lit("\n")).alias("body")
    )


def report_files(spark, sf) -> DataFrame:
    """One report per order; failing tests carry a message, others do not."""
    test = F.struct(
        F.concat(F.lit("t.py::"), "test_name").alias("name"), "status",
        F.when(F.col("status") == "failed", "assertion").alias("message"),
    )
    tests = V.test_results(spark, sf).groupBy("trial_id").agg(F.collect_list(test).alias("tests"))
    body = F.to_json(F.struct(F.struct("tests").alias("results")))
    return tests.select(F.col("trial_id").cast("string").alias("trial_name"), body.alias("body"))


@query("scan_configs", ctes(trials=TRIALS) + f"""
SELECT {NAME_SQL} AS trial_name, task_name AS task, model_name,
  concat('http://host-', model_name) AS api_base, concat('job-', model_name) AS job_id
FROM trials""")
def scan_configs(spark, sf):
    return A.trial_configs(packed(spark, CONFIG=config_files(spark, sf))).select(
        "trial_name", F.col("task.path").alias("task"), "agent.model_name",
        F.col("agent.kwargs")["api_base"].alias("api_base"), "job_id",
    )


@query("scan_job_configs", ctes(trials=TRIALS) + """
SELECT task_name AS job_name, CAST(count(*) AS INT) AS n_attempts,
  CAST(count(*) % 5 AS INT) AS n_concurrent, 'AgentTimeoutError,OSError' AS excluded,
  CAST(NULL AS VARCHAR) AS included
FROM trials GROUP BY task_name""")
def scan_job_configs(spark, sf):
    retry = F.struct(
        F.lit(None).cast("array<string>").alias("include_exceptions"),
        F.array(F.lit("AgentTimeoutError"), F.lit("OSError")).alias("exclude_exceptions"),
    )
    orchestrator = F.struct(
        (F.col("n") % 5).cast("int").alias("n_concurrent_trials"), retry.alias("retry")
    )
    jobs = V.trials(spark, sf).groupBy("task_name").agg(F.count(F.lit(1)).alias("n"))
    body = F.to_json(
        F.struct(
            F.col("task_name").alias("job_name"), F.col("n").cast("int").alias("n_attempts"),
            orchestrator.alias("orchestrator"),
        )
    )
    path = scratch_dir(spark, "run")
    A.write_packed(
        jobs.select(
            F.lit(None).cast("string").alias("trial_name"), F.lit("job/config.json").alias("file"),
            body.alias("body"),
        ),
        path,
    )
    return A.job_config(A.PackedRun(spark, path)).select(
        "job_name", "n_attempts",
        F.col("orchestrator.n_concurrent_trials").alias("n_concurrent"),
        F.array_join("orchestrator.retry.exclude_exceptions", ",").alias("excluded"),
        F.array_join("orchestrator.retry.include_exceptions", ",").alias("included"),
    )


@query("scan_results", ctes(trials=TRIALS, rewards=REWARDS) + f"""
SELECT md5(CAST(t.trial_id AS VARCHAR)) AS id, task_name,
  concat(task_name, '__', CAST(t.trial_id AS VARCHAR)) AS trial_name,
  iterations, conversation_length, CAST(r.reward AS DOUBLE) AS reward,
  epoch_us(started_at) AS started_us, duration_us
FROM trials t LEFT JOIN rewards r ON r.trial_id = t.trial_id WHERE has_result""")
def scan_results(spark, sf):
    found = A.results(packed(spark, RESULT=result_files(spark, sf)))
    started = micros(parse_iso(F.col("started_at")))
    finished = micros(parse_iso(F.col("agent_execution.finished_at")))
    return found.select(
        "id", "task_name", "trial_name", "agent_result.metadata.iterations",
        "agent_result.metadata.conversation_length",
        F.col("verifier_result.rewards")["reward"].alias("reward"),
        started.alias("started_us"), (finished - started).alias("duration_us"),
    )


@query("scan_rewards", ctes(trials=TRIALS, rewards=REWARDS) + f"""
SELECT concat(task_name, '__', CAST(t.trial_id AS VARCHAR)) AS trial_name,
  CAST(r.reward AS DOUBLE) AS reward
FROM trials t JOIN rewards r ON r.trial_id = t.trial_id""")
def scan_rewards(spark, sf):
    return A.rewards(packed(spark, REWARD=reward_files(spark, sf)))


@query("scan_reports", ctes(test_results=V.SQL["test_results"]) + """
SELECT CAST(trial_id AS VARCHAR) AS trial_name, concat('t.py::', test_name) AS test_name, status,
  CASE WHEN status = 'failed' THEN 'assertion' END AS message FROM test_results""")
def scan_reports(spark, sf):
    return A.tests(packed(spark, REPORT=report_files(spark, sf))).select(
        "trial_name", "test_name", "status", "message"
    )


@query("scan_exceptions", ctes(trials=TRIALS, trial_exceptions=V.SQL["trial_exceptions"]) + """
SELECT concat(task_name, '__', CAST(t.trial_id AS VARCHAR)) AS trial_name,
  'AgentTimeoutError' AS exc_type, regexp_extract(body, 'AgentTimeoutError: (.*)$', 1) AS exc_message,
  CAST(regexp_extract(body, 'after ([0-9.]+) seconds', 1) AS DOUBLE) AS timeout_sec
FROM trials t JOIN trial_exceptions e ON e.trial_id = t.trial_id""")
def scan_exceptions(spark, sf):
    return A.exceptions(packed(spark, EXCEPTION=exception_files(spark, sf)))


@query("scan_stdout", ctes(c=CONSOLES) + """
SELECT CAST(trial_id AS VARCHAR) AS trial_name,
  CASE WHEN trial_id % 7 <> 0 THEN n_passed END AS n_passed,
  CASE WHEN trial_id % 7 <> 0 THEN n_failed END AS n_failed,
  CASE WHEN trial_id % 7 <> 0 THEN n_errors END AS n_errors,
  CAST(CASE WHEN trial_id % 7 <> 0 THEN trial_id % 60 + 0.25 END AS DOUBLE) AS seconds FROM c""")
def scan_stdout(spark, sf):
    files = consoles(spark, sf).withColumn("trial_name", F.col("trial_id").cast("string"))
    return A.consoles(packed(spark, CONSOLE=files))


@query("scan_logs", ctes(failure_lines=V.SQL["failure_lines"]) + """
SELECT split_part(line, ' ', 2) AS trial_name, 'trial_failed' AS kind, CAST(1 AS BIGINT) AS line_no,
  split_part(line, ' failed: ', 2) AS message FROM failure_lines""")
def scan_logs(spark, sf):
    return A.trial_logs(packed(spark, TRIAL_LOG=log_files(spark, sf))).select(
        "trial_name", "kind", "line_no", "message"
    )


@query("scan_job_log", ctes(failure_lines=V.SQL["failure_lines"]) + """
SELECT 'trial_failed' AS kind, split_part(line, ' ', 2) AS trial_name, CAST(NULL AS VARCHAR) AS exc_type
FROM failure_lines
UNION ALL SELECT 'excluded', NULL, 'AgentTimeoutError' FROM events WHERE event_type = 'error'""")
def scan_job_log(spark, sf):
    excluded = V.table(spark, sf, "events").filter("event_type = 'error'").select(
        F.lit("Exception AgentTimeoutError is in exclude_exceptions, not retrying").alias("body")
    )
    lines = V.failure_lines(spark, sf).select(F.col("line").alias("body")).unionByName(excluded)
    path = scratch_dir(spark, "run")
    A.write_packed(
        lines.select(F.lit(None).cast("string").alias("trial_name"), "body",
                     F.lit("job/job.log").alias("file")),
        path,
    )
    return A.job_log(A.PackedRun(spark, path)).select("kind", "trial_name", "exc_type")


@query("scan_transcripts", ctes(replies=FAILING, sizes="""
SELECT trial_id, count(*) AS n FROM replies GROUP BY trial_id""") + """
SELECT CAST(r.trial_id AS VARCHAR) AS trial_name,
  concat('Work in', chr(10), chr(10), '/app') AS system_prompt,
  concat('Solve ', CAST(r.trial_id AS VARCHAR)) AS instruction, r.iteration, r.reply,
  'completed_with_signal' AS status, s.n AS n_iterations, 2 + 2 * s.n AS n_messages, true AS signal
FROM replies r JOIN sizes s ON s.trial_id = r.trial_id""")
def scan_transcripts(spark, sf):
    failing = (F.col("trial_id") + F.col("iteration")) % 6 == 0
    said = V.agent_replies(spark, sf).withColumn("reply", F.when(~failing, F.col("reply")))
    trials = said.groupBy("trial_id").agg(
        F.sort_array(F.collect_list(F.struct("iteration", "reply"))).alias("r")
    )
    name = F.col("trial_id").cast("string")
    turns = F.transform("r", lambda x: x["reply"])
    body = render_transcript(
        F.lit("Work in\n\n/app"), F.concat(F.lit("Solve "), name), turns,
        F.lit("completed_with_signal"), 2 + 2 * F.size("r"), F.lit(True),
    )
    files = trials.select(name.alias("trial_name"), body.alias("body"))
    return A.transcript_turns(A.transcripts(packed(spark, TRANSCRIPT=files)))


@query("scan_metrics", ctes(m=METRICS) + """
SELECT split_part(split_part(line, '{', 1), ' ', 1) AS name,
  nullif(regexp_extract(line, 'running_lora_adapters="([^"]*)"', 1), '') AS running,
  CAST(regexp_extract(line, '([0-9.]+)$', 1) AS DOUBLE) AS value
FROM m WHERE line NOT LIKE '#%' AND line NOT LIKE '%max_lora%max_lora%'""")
def scan_metrics(spark, sf):
    path = scratch_dir(spark, "metrics")
    metric_table(spark, sf).select("line").write.text(path)
    return read_metric_scrapes(spark, path).select(
        "name", F.col("labels")["running_lora_adapters"].alias("running"), "value"
    )


def _whole_run(spark, sf) -> A.PackedRun:
    reports = report_files(spark, sf).withColumnRenamed("trial_name", "_order")
    names = _trial_names(spark, sf).withColumn("_order", F.col("trial_id").cast("string"))
    return packed(
        spark,
        CONFIG=config_files(spark, sf), RESULT=result_files(spark, sf),
        REWARD=reward_files(spark, sf), EXCEPTION=exception_files(spark, sf),
        TRIAL_LOG=log_files(spark, sf), REPORT=reports.join(names, "_order"),
    )


WHOLE = """
SELECT t.task_name, concat(t.task_name, '__', CAST(t.trial_id AS VARCHAR)) AS trial_name,
  CAST(t.trial_id AS VARCHAR) AS suffix, t.model_name, t.has_result, CAST(r.reward AS DOUBLE) AS reward,
  s.n_tests, s.n_tests_passed, e.timeout_sec,
  CASE WHEN r.reward >= 1 THEN 'pass' WHEN f.trial_id IS NOT NULL THEN 'verifier_timeout'
       WHEN e.trial_id IS NOT NULL THEN 'agent_timeout'
       WHEN r.reward IS NOT NULL THEN 'fail' ELSE 'no_result' END AS outcome
FROM trials t LEFT JOIN rewards r ON t.trial_id = r.trial_id
LEFT JOIN (SELECT trial_id, CAST(regexp_extract(body, 'after ([0-9.]+) seconds', 1) AS DOUBLE)
    AS timeout_sec FROM trial_exceptions) e ON t.trial_id = e.trial_id
LEFT JOIN (SELECT trial_id, count(*) AS n_tests,
    count(*) FILTER (WHERE status = 'passed') AS n_tests_passed
  FROM test_results GROUP BY trial_id) s ON t.trial_id = s.trial_id
LEFT JOIN failure_lines f ON t.trial_id = f.trial_id"""
WHOLE_VIEWS = dict(
    trials=TRIALS, rewards=REWARDS, trial_exceptions=V.SQL["trial_exceptions"],
    test_results=V.SQL["test_results"], failure_lines=V.SQL["failure_lines"], whole=WHOLE,
)


@query("scan_trial_table", ctes(**WHOLE_VIEWS) + "SELECT * FROM whole")
def scan_trial_table(spark, sf):
    return A.run_trials(_whole_run(spark, sf)).select(
        "task_name", "trial_name", "suffix", "model_name", "has_result", "reward", "n_tests",
        "n_tests_passed", "timeout_sec", "outcome",
    )


@query("scan_coverage", ctes(**WHOLE_VIEWS) + """
SELECT concat_ws('+', 'config.json', CASE WHEN timeout_sec IS NOT NULL THEN 'exception.txt' END,
  CASE WHEN has_result THEN 'result.json' END,
  CASE WHEN trial_name IN (SELECT split_part(line, ' ', 2) FROM failure_lines) THEN 'trial.log' END,
  CASE WHEN n_tests IS NOT NULL THEN 'verifier/ctrf.json' END,
  CASE WHEN reward IS NOT NULL THEN 'verifier/reward.txt' END) AS files, count(*) AS n_trials
FROM whole GROUP BY 1""")
def scan_coverage(spark, sf):
    run = _whole_run(spark, sf)
    return B.coverage_of_files(run.presence())
