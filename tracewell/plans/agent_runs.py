"""Checked queries over trajectories and training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import sql
from tracewell.functions import templates as T
from tracewell.functions.text import clip_for_console
from tracewell.operators import conversations as C
from tracewell.operators import trajectories as J
from tracewell.operators import training_log as L
from tracewell.plans import views as V
from tracewell.plans.catalog import ctes, query
from tracewell.plans.training_data import CHECKED, KEEP, KEPT, MESSAGES, SPACE_SQL

STRIPPED = (
    f"regexp_replace(regexp_replace(line, '^{SPACE_SQL}+', ''), '{SPACE_SQL}+$', '')"
)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


REPLIES = V.SQL["agent_replies"]

# Commands: lines with their marks, then the lines between an opening mark and the next
# mark, when that one closes.
LINES = """
SELECT trial_id, iteration, pos, line FROM (
  SELECT trial_id, iteration, unnest(string_split(reply, chr(10))) AS line,
    generate_subscripts(string_split(reply, chr(10)), 1) AS pos FROM replies) t"""
MARKS = f"""
SELECT *, lead(pos) OVER w AS next_pos, lead(opens) OVER w AS next_opens FROM (
  SELECT trial_id, iteration, pos,
    starts_with({STRIPPED}, '```bash') OR starts_with({STRIPPED}, '```sh') AS opens
  FROM lines
  WHERE {STRIPPED} = '```' OR starts_with({STRIPPED}, '```bash') OR starts_with({STRIPPED}, '```sh')
) m WINDOW w AS (PARTITION BY trial_id, iteration ORDER BY pos)"""
FOUND = """
SELECT m.trial_id, m.iteration, m.pos AS opened, string_agg(l.line, chr(10) ORDER BY l.pos) AS cmd
FROM marks m JOIN lines l ON l.trial_id = m.trial_id AND l.iteration = m.iteration
  AND l.pos > m.pos AND l.pos < m.next_pos
WHERE m.opens AND NOT m.next_opens
GROUP BY m.trial_id, m.iteration, m.pos"""
# The loop stops at the first completion: later turns never happened.
CLASSED = """
SELECT r.*, coalesce(n.n, 0) AS n_commands,
  CASE WHEN r.reply IS NULL THEN 'error'
       WHEN upper(r.reply) LIKE '%TASK COMPLETE%' THEN 'complete'
       WHEN r.error IS NOT NULL THEN 'error'
       WHEN coalesce(n.n, 0) = 0 THEN 'no_command' ELSE 'execute' END AS turn_class
FROM replies r LEFT JOIN (
  SELECT trial_id, iteration, count(*) AS n FROM found GROUP BY 1, 2) n
ON r.trial_id = n.trial_id AND r.iteration = n.iteration
WHERE NOT EXISTS (SELECT 1 FROM replies e WHERE e.trial_id = r.trial_id
  AND e.iteration < r.iteration AND upper(e.reply) LIKE '%TASK COMPLETE%')"""
# Turns in which the model call failed, and others in which the commands did.
FAILING = f"""
SELECT trial_id, iteration, CASE WHEN (trial_id + iteration) % 6 <> 0 THEN reply END AS reply,
  CASE WHEN (trial_id + iteration) % 6 IN (0, 2) THEN 'refused' END AS error FROM ({REPLIES}) r"""


def failing_replies(spark, sf):
    kind = (F.col("trial_id") + F.col("iteration")) % 6
    return V.agent_replies(spark, sf).withColumns(
        {"reply": F.when(kind != 0, F.col("reply")), "error": F.when(kind.isin(0, 2), F.lit("refused"))}
    )


RUN_ALL = """
SELECT f.trial_id, f.iteration, f.cmd, row_number() OVER (
  PARTITION BY f.trial_id, f.iteration ORDER BY f.opened) AS cmd_idx
FROM found f JOIN classed c ON c.trial_id = f.trial_id AND c.iteration = f.iteration
WHERE c.turn_class <> 'complete'"""
RUN = """
SELECT f.trial_id, f.iteration, f.cmd, row_number() OVER (
  PARTITION BY f.trial_id, f.iteration ORDER BY f.opened) AS cmd_idx
FROM found f JOIN classed c ON c.trial_id = f.trial_id AND c.iteration = f.iteration
WHERE c.turn_class = 'execute'"""


def replies_sql(
    tail: str, replies: str = f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({REPLIES}) r", **more: str
) -> str:
    return ctes(
        replies=replies, lines=LINES, marks=MARKS, found=FOUND, classed=CLASSED, run=RUN, **more
    ) + tail


@query("bash_commands", replies_sql("SELECT trial_id, iteration, cmd_idx, cmd FROM run"))
def bash_commands(spark, sf):
    return J.command_rows(V.agent_replies(spark, sf))


@query("bash_commands_sql", replies_sql("SELECT trial_id, iteration, cmd_idx, cmd FROM run"))
def bash_commands_sql(spark, sf):
    sql.register(spark)
    return spark.sql("""
        WITH stops AS (
          SELECT trial_id, min(iteration) AS stop FROM {replies} WHERE signals_completion(reply) GROUP BY trial_id),
        executed AS (
          SELECT r.trial_id, r.iteration, fenced_commands(r.reply) AS own
          FROM {replies} r LEFT JOIN stops s ON s.trial_id = r.trial_id
          WHERE (stop IS NULL OR r.iteration <= stop) AND turn_class(r.reply, NULL) = 'execute')
        SELECT trial_id, iteration, CAST(at + 1 AS BIGINT) AS cmd_idx, cmd FROM executed LATERAL VIEW posexplode(own) AS at, cmd""",
        replies=V.agent_replies(spark, sf))


@query("turn_classes", replies_sql(
    "SELECT trial_id, iteration, n_commands, turn_class FROM classed"))
def turn_classes(spark, sf):
    return J.classify_turns(V.agent_replies(spark, sf)).select(
        "trial_id", "iteration", "n_commands", "turn_class"
    )


@query("command_stats", replies_sql("""
SELECT trial_id, count(*) AS n_iterations,
  CAST(sum(CASE WHEN turn_class = 'execute' THEN n_commands ELSE 0 END) AS BIGINT) AS n_commands,
  round(avg(CASE WHEN turn_class = 'execute' THEN n_commands ELSE 0 END), 9)
    AS commands_per_iteration,
  max(CASE WHEN turn_class = 'execute' THEN n_commands ELSE 0 END) AS max_commands
FROM classed GROUP BY trial_id"""))
def command_stats(spark, sf):
    return J.command_stats(V.agent_replies(spark, sf)).withColumn(
        "commands_per_iteration", F.round("commands_per_iteration", 9)
    )


@query("trial_status", replies_sql("""
SELECT trial_id, max(iteration) AS iterations,
  CAST(2 + 2 * count(*) - count(*) FILTER (WHERE turn_class = 'complete' OR reply IS NULL) AS BIGINT)
    AS conversation_length,
  bool_or(turn_class = 'complete') AS task_complete_signal,
  CASE WHEN bool_or(turn_class = 'complete') THEN 'completed_with_signal' ELSE 'completed' END
    AS status
FROM classed GROUP BY trial_id""", replies=FAILING))
def trial_status(spark, sf):
    return J.trial_status(failing_replies(spark, sf))


def _stream_sql(title: str, column: str) -> str:
    return (
        f"CASE WHEN coalesce({column}, '') = '' THEN '' "
        f"ELSE concat('{title}:', chr(10), CASE WHEN length({column}) > 1000 "
        f"THEN concat(substring({column}, 1, 1000), chr(10), '... [truncated ', "
        f"CAST(length({column}) - 1000 AS VARCHAR), ' chars]') ELSE {column} END, chr(10)) END"
    )


def feedback_sql(number: str) -> str:
    return (
        f"concat('Command ', CAST({number} AS VARCHAR), ': ', cmd, chr(10), 'Exit code: ', "
        f"CAST(return_code AS VARCHAR), chr(10), {_stream_sql('STDOUT', 'stdout')}, "
        f"{_stream_sql('STDERR', 'stderr')})"
    )


EXECUTIONS = V.SQL["executions"]


@query("exec_feedback", ctes(executions=EXECUTIONS) + f"""
SELECT trial_id, cmd_seq, {feedback_sql('cmd_seq')} AS feedback FROM executions""")
def exec_feedback(spark, sf):
    return J.with_feedback(V.executions(spark, sf), "cmd_seq").select(
        "trial_id", "cmd_seq", "feedback"
    )


@query("exit_stats", ctes(executions=EXECUTIONS) + """
SELECT trial_id, count(*) AS n_executed, count(*) FILTER (WHERE return_code <> 0) AS n_failing,
  round(avg(CASE WHEN return_code <> 0 THEN 1.0 ELSE 0.0 END), 9) AS failing_share
FROM executions GROUP BY trial_id""")
def exit_stats(spark, sf):
    return J.exit_stats(V.executions(spark, sf)).withColumn(
        "failing_share", F.round("failing_share", 9)
    )


@query("console_clip", ctes(executions=EXECUTIONS) + """
SELECT trial_id, cmd_seq, concat(substring(stdout, 1, 300), '...',
  CASE WHEN length(stdout) > 300 THEN concat(chr(10), '... [', CAST(length(stdout) - 300 AS VARCHAR),
    ' more characters]') ELSE '' END) AS shown FROM executions""")
def console_clip(spark, sf):
    return V.executions(spark, sf).select(
        "trial_id", "cmd_seq", clip_for_console(F.col("stdout")).alias("shown")
    )


PER_ITERATION = """
SELECT *, CAST((cmd_seq - 1) // 3 + 1 AS BIGINT) AS iteration,
  CAST((cmd_seq - 1) % 3 + 1 AS BIGINT) AS cmd_idx FROM executions"""


def combined_sql(source: str) -> str:
    return f"""
SELECT trial_id, iteration, concat(string_agg({feedback_sql('cmd_idx')},
  concat(chr(10), '---', chr(10)) ORDER BY cmd_idx), {literal(T.FEEDBACK_TAIL)}) AS content
FROM {source} GROUP BY trial_id, iteration"""


@query("iteration_feedback", ctes(executions=EXECUTIONS, numbered=PER_ITERATION)
       + combined_sql("numbered"))
def iteration_feedback(spark, sf):
    numbered = V.executions(spark, sf).withColumns(
        {"iteration": F.floor((F.col("cmd_seq") - 1) / 3).cast("long") + 1,
         "cmd_idx": (F.col("cmd_seq") - 1) % 3 + 1}
    )
    return J.iteration_feedback(numbered)


@query("command_loops", ctes(
    executions=EXECUTIONS,
    flagged="""
SELECT *, CASE WHEN lag(cmd) OVER (PARTITION BY trial_id ORDER BY cmd_seq) = cmd
  THEN 0 ELSE 1 END AS starts FROM executions""",
    numbered="SELECT *, sum(starts) OVER (PARTITION BY trial_id ORDER BY cmd_seq) AS isl FROM flagged",
) + """
SELECT trial_id, min(cmd_seq) AS first_seq, min(cmd) AS cmd, max(cmd_seq) AS last_seq,
  count(*) AS n_repeats
FROM numbered GROUP BY trial_id, isl HAVING count(*) >= 3""")
def command_loops(spark, sf):
    return J.command_loops(V.executions(spark, sf), at_least=3)


# What the commands of the replies returned, also where the run broke off later.
RAN = f"""
SELECT r.*, CAST(cmd_idx % 2 AS INT) AS return_code,
  CASE WHEN cmd_idx = 1 THEN repeat(cmd, 40) ELSE '' END AS stdout,
  CASE WHEN cmd_idx % 2 = 1 THEN 'warned' ELSE '' END AS stderr FROM ({RUN_ALL}) r"""
SEEDS = """
SELECT DISTINCT trial_id, concat('Solve task ', CAST(trial_id AS VARCHAR)) AS instruction
FROM replies"""
ALL_MESSAGES = f"""
SELECT trial_id, 0 AS iteration, 0 AS part, 'system' AS role, 'Work in /app' AS content FROM seeds
UNION ALL SELECT trial_id, 0, 1, 'user', instruction FROM seeds
UNION ALL SELECT trial_id, iteration, 2, 'assistant', reply FROM classed WHERE reply IS NOT NULL
UNION ALL SELECT trial_id, iteration, 3, 'user', {literal(T.NO_COMMAND_TEXT)} FROM classed
  WHERE turn_class = 'no_command'
UNION ALL SELECT trial_id, iteration, 3, 'user',
  concat('An error occurred: refused', chr(10), 'Please try a different approach.')
  FROM classed WHERE turn_class = 'error'
UNION ALL SELECT c.trial_id, c.iteration, 3, 'user', f.content FROM feedback f
  JOIN classed c ON c.trial_id = f.trial_id AND c.iteration = f.iteration WHERE c.turn_class = 'execute'"""
TRAJECTORY = """
SELECT trial_id, row_number() OVER (PARTITION BY trial_id ORDER BY iteration, part) - 1 AS msg_idx,
  role, content FROM everything"""


def _trajectory_parts(spark, sf):
    replies = failing_replies(spark, sf)
    seeds = replies.select("trial_id").distinct().select(
        "trial_id", F.lit("Work in /app").alias("system_prompt"),
        F.concat(F.lit("Solve task "), F.col("trial_id").cast("string")).alias("instruction"),
    )
    odd = F.col("cmd_idx") % 2 == 1
    ran = J.command_rows(replies.drop("error")).withColumns(
        {"return_code": (F.col("cmd_idx") % 2).cast("int"),
         "stdout": F.when(F.col("cmd_idx") == 1, F.repeat("cmd", F.lit(40))).otherwise(""),
         "stderr": F.when(odd, F.lit("warned")).otherwise("")}
    )
    return seeds, replies, ran


def trajectory_sql(tail: str, **more: str) -> str:
    return replies_sql(
        tail, FAILING, ran=RAN, feedback=combined_sql("ran"), seeds=SEEDS,
        everything=ALL_MESSAGES, trajectory=TRAJECTORY, **more,
    )


@query("trajectory_messages", trajectory_sql("SELECT * FROM trajectory"))
def trajectory_messages(spark, sf):
    return J.trajectory_messages(*_trajectory_parts(spark, sf))


@query("trajectory_training_text", trajectory_sql(
    f"SELECT conv_id, text, n_turns {KEEP}",
    src="SELECT trial_id AS conv_id, msg_idx AS turn, role, content AS text FROM trajectory",
    kept=KEPT, messages=MESSAGES, checked=CHECKED,
))
def trajectory_training_text(spark, sf):
    messages = J.trajectory_messages(*_trajectory_parts(spark, sf))
    return C.format_conversations(J.messages_as_turns(messages)).drop("drop_reason")


PROMPT = "You are in:\n{current_directory}\n\n{file_listing_header}\n{file_listing}\n\nBegin."


@query("dir_prompt", ctes(
    files="""
SELECT p_brand AS env, p_name AS name FROM part WHERE p_size > 2
UNION ALL SELECT DISTINCT p_type, CAST(NULL AS VARCHAR) FROM part""",
    ranked="""
SELECT env, name, row_number() OVER (PARTITION BY env ORDER BY name NULLS LAST) AS i,
  count(name) OVER (PARTITION BY env) AS n FROM files""",
    listed="""
SELECT env, max(n) AS n, coalesce(string_agg(concat(CAST(i AS VARCHAR), '. ', name), chr(10)
  ORDER BY i) FILTER (WHERE i <= 10 AND name IS NOT NULL), '') AS listing
FROM ranked GROUP BY env""",
    headed="""
SELECT env, listing, CASE WHEN n = 0 THEN 'Current directory is empty.'
  WHEN n <= 10 THEN concat('Files in current directory (', CAST(n AS VARCHAR), ' files):')
  ELSE concat('Files in current directory (showing first 10 of ', CAST(n AS VARCHAR), '):')
  END AS header FROM listed""",
) + """
SELECT env, header, listing, concat('You are in:', chr(10),
  CASE WHEN starts_with(env, 'Brand') THEN concat('/srv/', env) ELSE '/app' END,
  chr(10), chr(10), header, chr(10), listing, chr(10), chr(10), 'Begin.') AS system_prompt
FROM headed""")
def dir_prompt(spark, sf):
    part = V.table(spark, sf, "part")
    files = part.filter("p_size > 2").select(
        F.col("p_brand").alias("env"), F.col("p_name").alias("name")
    ).unionByName(
        part.select(F.col("p_type").alias("env"), F.lit(None).cast("string").alias("name")).distinct()
    )
    pwd = F.when(
        F.startswith("env", F.lit("Brand")), F.concat(F.lit("/srv/"), "env", F.lit("\n"))
    )
    return J.system_prompts(J.directory_listing(files), pwd, PROMPT).drop("n")


# --- training logs -----------------------------------------------------------------

LOSSES = V.SQL["loss_log"]
STOPS = """
SELECT run_id, count(loss) AS n_logged, min(step) FILTER (WHERE loss <= 0.1) AS stop_step,
  min(loss) AS best_loss FROM loss_log GROUP BY run_id"""


@query("loss_best", ctes(loss_log=LOSSES) + """
SELECT run_id, step, loss, min(loss) OVER (PARTITION BY run_id ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_loss FROM loss_log""")
def loss_best(spark, sf):
    return L.best_loss(V.loss_log(spark, sf))


@query("loss_stop", ctes(loss_log=LOSSES, stops=STOPS) + """
SELECT s.run_id, s.n_logged, s.stop_step, s.best_loss, min(l.loss) AS best_loss_to_stop
FROM stops s JOIN loss_log l ON l.run_id = s.run_id AND (s.stop_step IS NULL OR l.step <= s.stop_step)
GROUP BY s.run_id, s.n_logged, s.stop_step, s.best_loss""")
def loss_stop(spark, sf):
    return L.early_stop(V.loss_log(spark, sf))


@query("loss_trained_rows", ctes(loss_log=LOSSES, stops=STOPS) + """
SELECT l.run_id, l.step, l.loss FROM loss_log l JOIN stops s ON l.run_id = s.run_id
WHERE s.stop_step IS NULL OR l.step <= s.stop_step""")
def loss_trained_rows(spark, sf):
    return L.trained_rows(V.loss_log(spark, sf))


@query("checkpoint_keep", ctes(loss_log=LOSSES) + """
SELECT run_id, step FROM (SELECT run_id, step, row_number() OVER (
  PARTITION BY run_id ORDER BY step DESC) AS r FROM loss_log WHERE step % 50 = 0) t WHERE r <= 3""")
def checkpoint_keep(spark, sf):
    saved = V.loss_log(spark, sf).filter("step % 50 = 0").select("run_id", "step")
    return L.newest_checkpoints(saved, keep=3)


@query("exact_reward", ctes(src=V.SQL["noisy_conversations"]) + f"""
SELECT conv_id, turn, CAST(CASE WHEN regexp_replace(regexp_replace(text, '^{SPACE_SQL}+', ''),
    '{SPACE_SQL}+$', '') = role THEN 1
  WHEN regexp_full_match(text, '{SPACE_SQL}*') THEN 1 ELSE 0 END AS DOUBLE) AS reward
FROM src""")
def exact_reward(spark, sf):
    wanted = F.when(F.rlike("text", F.lit(r"^[ \t\n]*$")), F.lit(" ")).otherwise(F.col("role"))
    return V.noisy_conversations(spark, sf).select(
        "conv_id", "turn", L.exact_reward(F.col("text"), wanted).alias("reward")
    )


@query("group_advantage", ctes(trials=V.SQL["trials"], rewards=V.SQL["rewards"]) + """
SELECT t.trial_id, round(CASE WHEN sd = 0 THEN 0.0 ELSE (r.reward - mu) / (sd + 1e-4) END, 6)
  AS advantage
FROM trials t JOIN rewards r ON t.trial_id = r.trial_id JOIN (
  SELECT task_name, avg(reward) AS mu, stddev_pop(reward) AS sd
  FROM trials t2 JOIN rewards r2 ON t2.trial_id = r2.trial_id GROUP BY task_name) g
ON g.task_name = t.task_name""")
def group_advantage(spark, sf):
    rated = V.trials(spark, sf).join(V.rewards(spark, sf), "trial_id")
    rated = rated.select("trial_id", "task_name", "reward")
    return L.group_advantage(rated, ["task_name"]).select(
        "trial_id", F.round("advantage", 6).alias("advantage")
    )
