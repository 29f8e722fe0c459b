"""Checked queries over benchmark trials."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions.parsing import parse_exceptions, parse_log_lines
from tracewell.functions.text import micros, micros_between, parse_epoch, parse_iso
from tracewell.operators import trials as B
from tracewell.plans import views as V
from tracewell.plans.catalog import ctes, query
from tracewell.session import scratch_dir
from tracewell.sources.writers import first_lines, summary_document, write_results

TRIALS, REWARDS = V.SQL["trials"], V.SQL["rewards"]
TESTS = V.SQL["test_results"]

RATED = "SELECT t.*, r.reward FROM trials t LEFT JOIN rewards r ON t.trial_id = r.trial_id"
TABLE = """
SELECT t.trial_id, t.task_name, t.model_name, t.has_result, r.reward, e.exc_type, e.timeout_sec,
  s.n_tests, s.n_tests_passed, f.failure,
  CASE WHEN r.reward >= 1 THEN 'pass'
       WHEN f.failure LIKE 'Verifier execution timed out%' THEN 'verifier_timeout'
       WHEN e.exc_type = 'AgentTimeoutError' THEN 'agent_timeout'
       WHEN r.reward IS NOT NULL THEN 'fail' ELSE 'no_result' END AS outcome
FROM trials t LEFT JOIN rewards r ON t.trial_id = r.trial_id
LEFT JOIN (SELECT trial_id, 'AgentTimeoutError' AS exc_type,
    CAST(regexp_extract(body, 'after ([0-9.]+) seconds', 1) AS DOUBLE) AS timeout_sec
  FROM trial_exceptions) e ON t.trial_id = e.trial_id
LEFT JOIN (SELECT trial_id, count(*) AS n_tests,
    count(*) FILTER (WHERE status = 'passed') AS n_tests_passed
  FROM test_results GROUP BY trial_id) s ON t.trial_id = s.trial_id
LEFT JOIN (SELECT trial_id, split_part(line, ' failed: ', 2) AS failure FROM failure_lines) f
  ON t.trial_id = f.trial_id"""


def trials_sql(tail: str, **more: str) -> str:
    return ctes(trials=TRIALS, rewards=REWARDS, rated=RATED, **more) + tail


def table_sql(tail: str, **more: str) -> str:
    return ctes(
        trials=TRIALS, rewards=REWARDS, trial_exceptions=V.SQL["trial_exceptions"],
        failure_lines=V.SQL["failure_lines"], test_results=TESTS, trial_table=TABLE, **more
    ) + tail


def rated_trials(spark, sf):
    return B.trial_table(V.trials(spark, sf), "trial_id", V.rewards(spark, sf))


def full_table(spark, sf):
    exceptions = parse_exceptions(V.trial_exceptions(spark, sf))
    failures = parse_log_lines(V.failure_lines(spark, sf)).filter("kind = 'trial_failed'")
    tests = B.test_rollup(V.test_results(spark, sf))
    table = B.trial_table(
        V.trials(spark, sf), "trial_id", V.rewards(spark, sf),
        exceptions.select("trial_id", "exc_type", "timeout_sec"),
        tests.select("trial_id", "n_tests", "n_tests_passed"),
        failures.select("trial_id", F.col("message").alias("failure")),
    )
    return table.withColumn(
        "outcome", B.outcome(F.col("reward"), F.col("exc_type"), F.col("failure"))
    )


def rounded(df, *columns, digits: int = 9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("trial_table", table_sql("SELECT * FROM trial_table"))
def trial_table(spark, sf):
    return full_table(spark, sf).drop(
        "started_at", "duration_us", "iterations", "conversation_length"
    )


@query("trial_outcomes", table_sql(
    "SELECT outcome, count(*) AS n_trials FROM trial_table GROUP BY outcome"))
def trial_outcomes(spark, sf):
    return B.outcome_counts(full_table(spark, sf))


RATES = """
count(*) AS n_trials, count(reward) AS n_rewarded, count(DISTINCT task_name) AS n_tasks,
count(*) FILTER (WHERE reward >= 1) AS n_passes,
count(DISTINCT CASE WHEN reward >= 1 THEN task_name END) AS n_tasks_solved,
round(count(*) FILTER (WHERE reward >= 1) / count(*), 9) AS passes_per_trial,
round(count(*) FILTER (WHERE reward >= 1) / nullif(count(reward), 0), 9)
  AS passes_per_rewarded_trial,
round(count(*) FILTER (WHERE reward >= 1) / count(DISTINCT task_name), 9) AS passes_per_task,
round(count(DISTINCT CASE WHEN reward >= 1 THEN task_name END) / count(DISTINCT task_name), 9)
  AS solved_tasks_per_task"""
RATE_COLUMNS = (
    "passes_per_trial", "passes_per_rewarded_trial", "passes_per_task", "solved_tasks_per_task",
    "mean_task_reward",
)


@query("success_rates", trials_sql(f"""
SELECT {RATES}, (SELECT round(avg(m), 9) FROM (
  SELECT avg(coalesce(reward, 0)) AS m FROM rated GROUP BY task_name) t) AS mean_task_reward
FROM rated"""))
def success_rates(spark, sf):
    return rounded(B.success_rates(rated_trials(spark, sf)), *RATE_COLUMNS)


@query("success_by_model", trials_sql(f"""
SELECT r.model_name, {RATES}, max(g.mean_task_reward) AS mean_task_reward
FROM rated r JOIN (SELECT model_name, round(avg(m), 9) AS mean_task_reward FROM (
  SELECT model_name, avg(coalesce(reward, 0)) AS m FROM rated GROUP BY model_name, task_name) t
  GROUP BY model_name) g ON g.model_name = r.model_name
GROUP BY r.model_name"""))
def success_by_model(spark, sf):
    return rounded(B.success_rates(rated_trials(spark, sf), ["model_name"]), *RATE_COLUMNS)


SUMMARY = """
SELECT task_name, count(*) AS n_attempts, count(reward) AS n_rewarded,
  count(*) FILTER (WHERE reward >= 1) AS n_passes,
  count(*) FILTER (WHERE reward >= 1) > 0 AS solved, round(avg(reward), 9) AS mean_reward,
  round(avg(coalesce(reward, 0)), 9) AS mean_with_missing
FROM rated GROUP BY task_name"""


@query("task_summary", trials_sql(SUMMARY))
def task_summary(spark, sf):
    return rounded(B.task_summary(rated_trials(spark, sf)), "mean_reward", "mean_with_missing")


@query("pass_at_k", trials_sql("""
SELECT CAST(k AS BIGINT) AS k, count(score) AS n_tasks, round(avg(score), 9) AS pass_at_k FROM (
  SELECT k, CASE WHEN n < k THEN NULL WHEN c = 0 THEN 0.0 WHEN n - c < k THEN 1.0
    ELSE 1.0 - list_product(list_transform(range(CAST(n - c + 1 AS BIGINT), CAST(n + 1 AS BIGINT)),
      lambda i: 1.0::DOUBLE - k::DOUBLE / i)) END AS score
  FROM (SELECT n_attempts AS n, n_passes AS c FROM summary) s, (SELECT unnest([1, 5, 10, 100]) AS k) ks
) t GROUP BY k""", summary=SUMMARY))
def pass_at_k(spark, sf):
    tasks = B.task_summary(rated_trials(spark, sf))
    return rounded(B.pass_at_k(tasks, [1, 5, 10, 100]), "pass_at_k")


@query("attempts", trials_sql("""
SELECT trial_id, task_name, row_number() OVER (
  PARTITION BY task_name ORDER BY started_at, trial_id) AS attempt_no FROM trials"""))
def attempts(spark, sf):
    return B.number_attempts(V.trials(spark, sf)).select("trial_id", "task_name", "attempt_no")


PLANNED = """
SELECT DISTINCT concat('task-', CAST(c_custkey % 120 AS VARCHAR)) AS task_name FROM customer"""


@query("missing_attempts", ctes(
    trials=TRIALS, planned=PLANNED,
    numbered="""SELECT task_name, row_number() OVER (PARTITION BY task_name ORDER BY started_at,
  trial_id) AS attempt_no FROM trials""",
) + """
SELECT p.task_name, CAST(a.attempt_no AS BIGINT) AS attempt_no
FROM planned p, (SELECT unnest(range(1, 71)) AS attempt_no) a
WHERE NOT EXISTS (SELECT 1 FROM numbered n WHERE n.task_name = p.task_name
  AND n.attempt_no = a.attempt_no)""")
def missing_attempts(spark, sf):
    number = (F.col("c_custkey") % 120).cast("string")
    planned = V.table(spark, sf, "customer").select(
        F.concat(F.lit("task-"), number).alias("task_name")
    )
    return B.missing_attempts(V.trials(spark, sf), planned, 70)


@query("no_result", trials_sql("""
SELECT trial_id, task_name FROM trials t WHERE NOT EXISTS (
  SELECT 1 FROM rewards r WHERE r.trial_id = t.trial_id)"""))
def no_result(spark, sf):
    configs = V.trials(spark, sf).select("trial_id", "task_name")
    return B.without_result(configs, V.rewards(spark, sf), "trial_id")


@query("artifact_coverage", table_sql("""
SELECT concat_ws('+', 'config', CASE WHEN has_result THEN 'result' END,
  CASE WHEN reward IS NOT NULL THEN 'reward' END, CASE WHEN n_tests IS NOT NULL THEN 'report' END,
  CASE WHEN exc_type IS NOT NULL THEN 'exception' END) AS files, count(*) AS n_trials
FROM trial_table GROUP BY 1"""))
def artifact_coverage(spark, sf):
    table = full_table(spark, sf).select(
        F.lit(True).alias("config"), F.col("has_result").alias("result"),
        F.col("reward").isNotNull().alias("reward"), F.col("n_tests").isNotNull().alias("report"),
        F.col("exc_type").isNotNull().alias("exception"),
    )
    return B.artifact_coverage(table, table.columns)


@query("run_compare", trials_sql("""
SELECT coalesce(b.task_name, a.task_name) AS task_name, b.solved AS solved_before,
  a.solved AS solved_after,
  CASE WHEN coalesce(b.solved, false) AND coalesce(a.solved, false) THEN 'both'
       WHEN coalesce(a.solved, false) THEN 'gained' WHEN coalesce(b.solved, false) THEN 'lost'
       ELSE 'neither' END AS change
FROM (SELECT task_name, max(coalesce(reward, 0)) >= 1 AS solved FROM rated
      WHERE model_name = 'base' GROUP BY 1) b
FULL OUTER JOIN (SELECT task_name, max(coalesce(reward, 0)) >= 1 AS solved FROM rated
      WHERE model_name = 'tuned' GROUP BY 1) a
ON a.task_name = b.task_name"""))
def run_compare(spark, sf):
    rated = rated_trials(spark, sf)
    runs = B.stack_runs(
        base=rated.filter("model_name = 'base'"),
        tuned=rated.filter("model_name = 'tuned'"),
    )
    return B.compare_runs(runs, "base", "tuned")


@query("run_uplift", trials_sql("""
SELECT round(b, 9) AS rate_before, round(a, 9) AS rate_after, round(a / nullif(b, 0), 9) AS ratio,
  round(a - b, 9) AS difference
FROM (SELECT count(*) FILTER (WHERE model_name = 'base' AND reward >= 1)
          / count(*) FILTER (WHERE model_name = 'base') AS b,
        count(*) FILTER (WHERE model_name = 'tuned' AND reward >= 1)
          / count(*) FILTER (WHERE model_name = 'tuned') AS a FROM rated) t"""))
def run_uplift(spark, sf):
    stacked = rated_trials(spark, sf).withColumn("run_id", F.col("model_name"))
    return rounded(
        B.run_uplift(stacked, "base", "tuned"), "rate_before", "rate_after", "ratio", "difference"
    )


@query("reconcile", trials_sql("""
SELECT reward_agrees, tests_agree, config_agrees, count(*) AS n_trials FROM (
  SELECT r.reward IS NOT DISTINCT FROM (CASE WHEN r.trial_id % 50 = 0 THEN 1 ELSE r.reward END)
      AS reward_agrees,
    (r.reward >= 1) IS NOT DISTINCT FROM s.all_passed AS tests_agree,
    r.model_name IS NOT DISTINCT FROM (CASE WHEN r.trial_id % 70 = 0 THEN 'other'
      ELSE r.model_name END) AS config_agrees
  FROM rated r LEFT JOIN (SELECT trial_id, min(status) = 'passed' AS all_passed
    FROM test_results GROUP BY trial_id) s ON s.trial_id = r.trial_id) t
GROUP BY ALL""", test_results=TESTS))
def reconcile(spark, sf):
    tests = B.test_rollup(V.test_results(spark, sf)).select("trial_id", "all_passed")
    rated = rated_trials(spark, sf).join(tests, "trial_id", "left")
    in_result = F.when(F.col("trial_id") % 50 == 0, 1).otherwise(F.col("reward"))
    nested = F.when(F.col("trial_id") % 70 == 0, "other").otherwise(F.col("model_name"))
    flags = B.reconcile(
        {"reward_agrees": (F.col("reward"), in_result),
         "tests_agree": (F.col("reward") >= 1, F.col("all_passed")),
         "config_agrees": (F.col("model_name"), nested)}
    )
    return (
        rated.select(*[c.alias(n) for n, c in flags.items()])
        .groupBy(*flags).agg(F.count(F.lit(1)).alias("n_trials"))
    )


@query("retry_plan", ctes(trial_exceptions=V.SQL["trial_exceptions"], typed="""
SELECT trial_id, trial_id % 3 AS retries_used,
  CASE WHEN trial_id % 5 = 0 THEN 'AgentTimeoutError' WHEN trial_id % 5 = 1 THEN 'OSError'
       WHEN trial_id % 5 = 2 THEN 'KeyError' WHEN trial_id % 5 = 3 THEN 'RewardFileEmptyError' END
  AS exc_type FROM trial_exceptions""") + """
SELECT trial_id, exc_type, CASE WHEN exc_type IS NULL THEN 'no_exception'
  WHEN exc_type IN ('RewardFileNotFoundError', 'RewardFileEmptyError', 'VerifierTimeoutError',
    'AgentTimeoutError', 'VerifierOutputParseError') THEN 'excluded'
  WHEN exc_type <> 'OSError' THEN 'not_included'
  WHEN retries_used >= 2 THEN 'no_retries_left' ELSE 'retry' END AS decision FROM typed""")
def retry_plan(spark, sf):
    kind = F.col("trial_id") % 5
    rows = V.trial_exceptions(spark, sf).withColumn(
        "exc_type",
        F.when(kind == 0, "AgentTimeoutError").when(kind == 1, "OSError")
        .when(kind == 2, "KeyError").when(kind == 3, "RewardFileEmptyError"),
    )
    policy = B.RetryPolicy(max_retries=2, include=("OSError",))
    decision = B.retry_decision(F.col("exc_type"), F.col("trial_id") % 3, policy)
    return rows.select("trial_id", "exc_type", decision.alias("decision"))


@query("test_rollup", ctes(test_results=TESTS) + """
SELECT trial_id, count(*) AS n_tests, count(*) FILTER (WHERE status = 'passed') AS n_tests_passed,
  round(count(*) FILTER (WHERE status = 'passed') / count(*), 9) AS partial_credit,
  min(status) = 'passed' AS all_passed
FROM test_results GROUP BY trial_id""")
def test_rollup(spark, sf):
    return rounded(B.test_rollup(V.test_results(spark, sf)), "partial_credit")


@query("failure_patterns", ctes(test_results=TESTS) + """
SELECT test_name, message, count(*) AS n FROM (
  SELECT test_name, concat('failed at step ', CAST(trial_id % 7 AS VARCHAR)) AS message
  FROM test_results WHERE status = 'failed') t
GROUP BY ALL ORDER BY n DESC, test_name, message LIMIT 20""")
def failure_patterns(spark, sf):
    step = (F.col("trial_id") % 7).cast("string")
    failed = V.test_results(spark, sf).filter("status = 'failed'").withColumn(
        "message", F.concat(F.lit("failed at step "), step)
    )
    return B.failure_patterns(failed, ["test_name", "message"], 20)


@query("failure_exceptions", ctes(trial_exceptions=V.SQL["trial_exceptions"]) + """
SELECT 'AgentTimeoutError' AS exc_type,
  CAST(regexp_extract(body, 'after ([0-9.]+) seconds', 1) AS DOUBLE) AS timeout_sec,
  count(*) AS n FROM trial_exceptions GROUP BY ALL ORDER BY n DESC, timeout_sec LIMIT 10""")
def failure_exceptions(spark, sf):
    parsed = parse_exceptions(V.trial_exceptions(spark, sf))
    return B.failure_patterns(parsed, ["exc_type", "timeout_sec"], 10)


# Phase lengths: fixed shares of the trial.
PHASE_SHARES = {"environment_setup": 7, "agent_setup": 1, "agent_execution": 72, "verifier": 10}


def _phases():
    shares = {n: F.floor(F.col("duration_us") * s / 100) for n, s in PHASE_SHARES.items()}
    return {**shares, "total": F.col("duration_us")}


PHASES = " UNION ALL ".join(
    [f"SELECT '{n}' AS phase, CAST(floor(duration_us * {s} / 100) AS BIGINT) AS us FROM trials"
     for n, s in PHASE_SHARES.items()] + ["SELECT 'total', duration_us FROM trials"]
)


def stats_sql(value: str, scale: str = "1") -> str:
    parts = {"mean": f"avg({value})", "median": f"quantile_cont({value}, 0.5)",
             "min": f"min({value})", "max": f"max({value})"}
    return f"count({value}) AS n, " + ", ".join(
        f"round({e} / {scale}, 6) AS {n}" for n, e in parts.items()
    )


@query("phase_stats", ctes(trials=TRIALS, phases=PHASES) + f"""
SELECT phase, {stats_sql('us', '1e6')} FROM phases GROUP BY phase""")
def phase_stats(spark, sf):
    long = B.unpivot_phases(V.trials(spark, sf), _phases())
    stats = B.number_stats(long, ["phase"], "us", scale=1e6)
    return rounded(stats, "mean", "median", "min", "max", digits=6)


@query("phase_durations", ctes(trials=TRIALS) + """
SELECT trial_id, strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f') AS started_text,
  epoch_us(started_at) AS started_us, epoch_us(started_at) + duration_us AS finished_us,
  epoch_us(started_at) // 1000 AS epoch_ms,
  duration_us, round(duration_us / 1e6, 6) AS seconds FROM trials""")
def phase_durations(spark, sf):
    trials = V.trials(spark, sf)
    text = F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    started = parse_iso(F.col("started_text"))
    finished = F.timestamp_micros(F.col("started_us") + F.col("duration_us"))
    timed = (
        trials.withColumn("started_text", text)
        .withColumn("started_us", micros(started))
        .withColumn("finished", finished)
        .withColumn("finished_us", micros(F.col("finished")))
    )
    length = micros_between(started, F.col("finished"))
    # Test reports give epoch seconds as doubles; these hold whole milliseconds.
    epoch = parse_epoch(F.floor(F.col("started_us") / 1000) / 1000)
    return timed.select(
        "trial_id", "started_text", "started_us", "finished_us", length.alias("duration_us"),
        F.round(micros(epoch) / 1000).cast("long").alias("epoch_ms"),
        F.round(length / 1e6, 6).alias("seconds"),
    )


@query("iteration_stats", trials_sql(f"""
SELECT coalesce(reward, 0) >= 1 AS passed, {stats_sql('iterations')},
  CAST(sum(2 * iterations + 1 - conversation_length) AS BIGINT) AS failed_turns
FROM rated GROUP BY 1"""))
def iteration_stats(spark, sf):
    rated = rated_trials(spark, sf).withColumn(
        "passed", F.coalesce(F.col("reward"), F.lit(0)) >= 1
    )
    stats = rounded(
        B.number_stats(rated, ["passed"], "iterations"), "mean", "median", "min", "max", digits=6
    )
    failed = rated.groupBy("passed").agg(
        F.sum(B.failed_turns(F.col("iterations"), F.col("conversation_length")))
        .alias("failed_turns")
    )
    return stats.join(failed, "passed")


@query("token_totals", ctes(trials=TRIALS, counted="""
SELECT model_name, CASE WHEN trial_id % 3 <> 0 THEN iterations * 100 END AS n_input_tokens,
  CASE WHEN trial_id % 4 = 0 THEN iterations * 7 END AS n_output_tokens FROM trials""") + """
SELECT model_name, count(*) AS n_trials,
  CAST(sum(n_input_tokens) AS BIGINT) AS n_input_tokens_total,
  count(n_input_tokens) AS n_input_tokens_known,
  CAST(sum(n_output_tokens) AS BIGINT) AS n_output_tokens_total,
  count(n_output_tokens) AS n_output_tokens_known
FROM counted GROUP BY model_name""")
def token_totals(spark, sf):
    counted = V.trials(spark, sf).withColumns(
        {"n_input_tokens": F.when(F.col("trial_id") % 3 != 0, F.col("iterations") * 100),
         "n_output_tokens": F.when(F.col("trial_id") % 4 == 0, F.col("iterations") * 7)}
    )
    return B.token_totals(counted, ["n_input_tokens", "n_output_tokens"], ["model_name"])


# Trials a few hundred times longer than the recorded ones, so that they overlap.
CHANGES = """
SELECT model_name, us, sum(d) AS change FROM (
  SELECT model_name, epoch_us(started_at) AS us, 1 AS d FROM trials
  UNION ALL SELECT model_name, epoch_us(started_at) + duration_us * 100, -1 FROM trials) e
GROUP BY model_name, us"""
TIMELINE = """
SELECT model_name, us, CAST(sum(change) OVER (PARTITION BY model_name ORDER BY us) AS BIGINT)
  AS n_running FROM changes"""


def _overlapping(spark, sf):
    start = micros(F.col("started_at"))
    return V.trials(spark, sf), start, start + F.col("duration_us") * 100


@query("concurrency_timeline", ctes(trials=TRIALS, changes=CHANGES) + TIMELINE)
def concurrency_timeline(spark, sf):
    trials, start, stop = _overlapping(spark, sf)
    return B.concurrency(trials, ["model_name"], start, stop)


@query("concurrency", ctes(trials=TRIALS, changes=CHANGES, timeline=TIMELINE) + """
SELECT model_name, max(n_running) AS peak, arg_max(us, (n_running, -us)) AS peak_us,
  min(us) AS first_us, max(us) AS last_us, max(n_running) > 4 AS over_configured
FROM timeline GROUP BY model_name""")
def concurrency(spark, sf):
    trials, start, stop = _overlapping(spark, sf)
    return B.peak_concurrency(trials, ["model_name"], start, stop, configured=4)


@query("throughput", ctes(trials=TRIALS) + """
SELECT (epoch_us(started_at) + duration_us) // 600000000 * 600 AS bucket_sec,
  count(*) AS n_finished FROM trials GROUP BY 1""")
def throughput(spark, sf):
    finished = F.timestamp_micros(micros(F.col("started_at")) + F.col("duration_us"))
    buckets = B.throughput(V.trials(spark, sf), finished)
    return buckets.select(F.unix_seconds("bucket_start").alias("bucket_sec"), "n_finished")


@query("hardest_tasks", trials_sql("""
SELECT task_name, count(*) AS n_attempts, round(avg(coalesce(reward, 0)), 9) AS mean_reward,
  round(avg(duration_us), 3) AS mean_us
FROM rated GROUP BY task_name
ORDER BY avg(coalesce(reward, 0)), avg(duration_us) DESC, task_name LIMIT 10"""))
def hardest_tasks(spark, sf):
    hardest = B.hardest_tasks(rated_trials(spark, sf), 10)
    return rounded(rounded(hardest, "mean_reward"), "mean_us", digits=3)


@query("task_filter", trials_sql("""
SELECT trial_id, task_name FROM trials
WHERE task_name IN (SELECT concat('task-', CAST(s_suppkey % 50 AS VARCHAR)) FROM supplier)
  AND task_name NOT IN ('task-3', 'task-7')"""))
def task_filter(spark, sf):
    number = (F.col("s_suppkey") % 50).cast("string")
    wanted = V.table(spark, sf, "supplier").select(
        F.concat(F.lit("task-"), number).alias("task_name")
    )
    kept = B.select_tasks(V.trials(spark, sf), include=wanted, exclude=["task-3", "task-7"])
    return kept.select("trial_id", "task_name")


@query("metric_registry", trials_sql("""
SELECT model_name, count(*) AS trials, count(reward) AS rewarded,
  round(avg(reward), 9) AS mean_reward, max(iterations) AS max_iterations
FROM rated GROUP BY model_name"""))
def metric_registry(spark, sf):
    metrics = {
        "trials": F.count(F.lit(1)),
        "rewarded": F.count("reward"),
        "mean_reward": F.round(F.avg("reward"), 9),
        "max_iterations": F.max("iterations"),
    }
    return B.metric_registry(rated_trials(spark, sf), metrics, ["model_name"])


@query("summary_json", trials_sql("""
SELECT concat('{"n_trials":', CAST(count(*) AS VARCHAR), ',"n_rewarded":',
  CAST(count(reward) AS VARCHAR), ',"n_tasks":', CAST(count(DISTINCT task_name) AS VARCHAR),
  ',"n_passes":', CAST(count(*) FILTER (WHERE reward >= 1) AS VARCHAR), '}') AS document
FROM rated"""))
def summary_json(spark, sf):
    path = scratch_dir(spark, "summary")
    rates = B.success_rates(rated_trials(spark, sf))
    summary = rates.select("n_trials", "n_rewarded", "n_tasks", "n_passes")
    summary_document(summary).write.text(path)
    written = spark.read.text(path, wholetext=True)
    shown = first_lines(F.col("value"), 30)
    return written.select(F.regexp_replace(shown, r"\n\z", "").alias("document")).filter(
        "document <> ''"
    )


@query("partitioned_write", ctes(trials=TRIALS) + """
SELECT trial_id, task_name, iterations, model_name AS job_name FROM trials
WHERE model_name = 'tuned'""")
def partitioned_write(spark, sf):
    path = scratch_dir(spark, "results")
    rows = V.trials(spark, sf).select("trial_id", "task_name", "iterations", "model_name")
    write_results(rows, path, F.lit("20260111-224952"), F.col("model_name"))
    schema = "trial_id BIGINT, task_name STRING, iterations BIGINT, run_ts STRING, job_name STRING"
    back = spark.read.schema(schema).parquet(path)
    wanted = (F.col("run_ts") == "20260111-224952") & (F.col("job_name") == "tuned")
    return back.filter(wanted).drop("run_ts")
