"""Trial, log and trajectory tables derived from the given tables.

``SQL`` holds the definitions for the SQL twins; the functions build the same rows on
Spark. Row numbers come from ordered groups that are cut where hot, since one user or
conversation may own a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators.blocks import ordered

_EVENT_NUMBER = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"

_NOISY_ROLE = """CASE WHEN (conv_id * 7 + turn) % 11 = 0 THEN 'tool'
    WHEN role = 'user' AND conv_id % 3 = 1 THEN 'Human'
    WHEN role = 'assistant' AND conv_id % 3 = 1 THEN 'GPT'
    WHEN role = 'assistant' AND conv_id % 3 = 2 THEN 'bot'
    ELSE role END"""
_NOISY_TEXT = """CASE WHEN (conv_id * 5 + turn) % 7 = 0
    THEN concat(' ', chr(9), chr(10)) ELSE text END"""
_REPLY = """CASE (conv_id + turn) % 5
    WHEN 0 THEN concat('Plan: ', text)
    WHEN 1 THEN concat('```bash', chr(10), 'ls -1', chr(10), '```', chr(10), 'then', chr(10),
        '  ```sh', chr(10), text, chr(10), '```')
    WHEN 2 THEN concat('```bash', chr(10), 'lost', chr(10), '```bash', chr(10), 'cat file.txt',
        chr(10), ' ``` ', chr(10), text)
    WHEN 3 THEN concat(text, chr(10), 'Task Complete', chr(10), '```bash', chr(10), 'never run',
        chr(10), '```')
    ELSE concat('```shell', chr(10), 'unclosed', chr(10), text) END"""
_RETURN_CODE = "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END"
_STDOUT = "repeat(props, CAST(event_id % 150 AS INT))"
_STDERR = "CASE WHEN event_type = 'error' THEN repeat('err ', CAST(event_id % 300 AS INT)) ELSE '' END"
_TASK = "concat('task-', CAST(user_id % 89 AS VARCHAR(10)))"
_MODEL = "CASE WHEN event_id % 2 = 0 THEN 'base' ELSE 'tuned' END"
_BODY = """concat('Traceback (most recent call last):', chr(10),
    CASE WHEN event_id % 3 = 0 THEN 'harness.errors.' ELSE '' END,
    'AgentTimeoutError: Agent execution timed out after ',
    CAST(900 * (1 + event_id % 4) AS VARCHAR(10)), '.0 seconds')"""
_FAILURE = """concat('Trial task-', CAST(user_id % 89 AS VARCHAR(10)), '__',
    CAST(event_id AS VARCHAR(20)), ' failed: Verifier execution timed out after 900.0 seconds')"""

SQL = {
    "noisy_conversations": f"""
SELECT conv_id, turn, {_NOISY_ROLE} AS role, {_NOISY_TEXT} AS text FROM conversations""",
    "agent_replies": f"""
SELECT conv_id AS trial_id,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS iteration,
  {_REPLY} AS reply
FROM conversations WHERE role = 'assistant'""",
    "executions": f"""
SELECT user_id AS trial_id, {_EVENT_NUMBER} AS cmd_seq,
  concat('run ', event_type) AS cmd, {_RETURN_CODE} AS return_code,
  {_STDOUT} AS stdout, {_STDERR} AS stderr
FROM events""",
    "loss_log": f"""
SELECT run_id, rn * 10 AS step, value / (rn * 10) AS loss FROM (
  SELECT user_id AS run_id, value, {_EVENT_NUMBER} AS rn FROM events) t""",
    "trials": f"""
SELECT event_id AS trial_id, {_TASK} AS task_name, {_MODEL} AS model_name,
  ts AS started_at, CAST(floor(value * 1000000) AS BIGINT) AS duration_us,
  1 + event_id % 159 AS iterations, 3 + 2 * (event_id % 159) - event_id % 3 AS conversation_length,
  event_type <> 'error' AS has_result
FROM events""",
    "rewards": """
SELECT event_id AS trial_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS reward
FROM events WHERE event_type <> 'signup'""",
    "trial_exceptions": f"""
SELECT event_id AS trial_id, {_BODY} AS body FROM events WHERE event_type = 'error'""",
    "failure_lines": f"""
SELECT event_id AS trial_id, {_FAILURE} AS line
FROM events WHERE event_type IN ('signup', 'error')""",
    "test_results": """
SELECT l_orderkey AS trial_id, l_linenumber AS test_no,
  concat('test_', CAST(l_linenumber AS VARCHAR(10))) AS test_name,
  CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'passed' END AS status
FROM lineitem""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def noisy_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{_NOISY_ROLE} AS role", f"{_NOISY_TEXT} AS text"
    )


def agent_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    talks = ordered(said, ["conv_id"], ["turn"])
    return talks.number("iteration").rows().selectExpr("conv_id AS trial_id", "iteration", f"{_REPLY} AS reply")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    users = ordered(events, ["user_id"], ["ts", "event_id"])
    return users.number("rn").rows()


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_events(spark, sf_dir).selectExpr(
        "user_id AS trial_id", "rn AS cmd_seq", "concat('run ', event_type) AS cmd",
        f"{_RETURN_CODE} AS return_code", f"{_STDOUT} AS stdout", f"{_STDERR} AS stderr",
    )


def loss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_events(spark, sf_dir).selectExpr(
        "user_id AS run_id", "rn * 10 AS step", "value / (rn * 10) AS loss"
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS trial_id", f"{_TASK} AS task_name", f"{_MODEL} AS model_name",
        "ts AS started_at", "CAST(floor(value * 1000000) AS BIGINT) AS duration_us",
        "1 + event_id % 159 AS iterations",
        "3 + 2 * (event_id % 159) - event_id % 3 AS conversation_length",
        "event_type <> 'error' AS has_result",
    )


def rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type <> 'signup'").selectExpr(
        "event_id AS trial_id", "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS reward"
    )


def trial_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'error'").selectExpr(
        "event_id AS trial_id", f"{_BODY} AS body"
    )


def failure_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter("event_type IN ('signup', 'error')")
        .selectExpr("event_id AS trial_id", f"{_FAILURE} AS line")
    )


def test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS trial_id", "l_linenumber AS test_no",
        "concat('test_', CAST(l_linenumber AS VARCHAR(10))) AS test_name",
        "CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'passed' END AS status",
    )
