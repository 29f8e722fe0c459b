"""Checked scans of real folders: a trial folder for each task and model, task folders and snapshots, laid out as
files from the given tables, listed once and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.operators import trials as B
from tracewell.operators.corpus import MARKER
from tracewell.plans import views as V
from tracewell.plans.catalog import ctes, query
from tracewell.session import scratch_dir, written_table
from tracewell.sources import artifacts as A
from tracewell.sources import datasets

JOBS = """
SELECT concat(t.task_name, '__', t.model_name) AS trial_name, t.task_name, t.model_name,
  CAST(split_part(t.task_name, '-', 2) AS INT) AS k, sum(iterations) AS iterations, count(*) AS n_messages,
  count(*) FILTER (WHERE r.reward >= 1) % 2 AS reward
FROM trials t LEFT JOIN rewards r ON r.trial_id = t.trial_id GROUP BY ALL"""
#: What the files of a folder are like, by the number in its task's name.
NO_RESULT, CUT_CONFIG, LIST_RESULT, CUT_RESULT = "k % 7 = 0", "k % 11 = 5", "k % 13 = 4", "k % 13 = 5"
BLANK_REWARD, TIMED_OUT, OTHER_MODEL, NO_JOB = "k % 17 = 3", "k % 9 = 2", "k % 4 = 1", "k % 4 = 2"
SOUND = f"NOT ({NO_RESULT}) AND NOT ({LIST_RESULT}) AND NOT ({CUT_RESULT})"
VIEWS = dict(trials=V.SQL["trials"], rewards=V.SQL["rewards"], jobs=JOBS)


def lay_out(spark, files: DataFrame, root: str) -> str:
    """Write ``path, body`` rows as files below ``root``, one after the other: a few files for each task, as a harness
    leaves them."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for path, body in files.select("path", "body").toLocalIterator():
        out = system.create(place(f"{root}/{path}"), True)
        out.write(body.encode())
        out.close()
    return root


def _jobs(spark, sf) -> DataFrame:
    rated = B.trial_table(V.trials(spark, sf), "trial_id", V.rewards(spark, sf))
    name = F.concat("task_name", F.lit("__"), "model_name")
    jobs = rated.groupBy(name.alias("trial_name"), "task_name", "model_name").agg(
        F.sum("iterations").alias("iterations"), F.count(F.lit(1)).alias("n_messages"),
        (F.count_if(F.col("reward") >= 1) % 2).alias("reward"),
    )
    return written_table(jobs.withColumn("k", F.split_part("task_name", F.lit("-"), F.lit(2)).cast("int")), "jobs")


def _file(jobs: DataFrame, name: str, body) -> DataFrame:
    return jobs.select(F.concat("trial_name", F.lit(f"/{name}")).alias("path"), body.alias("body"))


def _config(model, job):
    return F.struct(F.struct(F.col("task_name").alias("path")).alias("task"), "trial_name",
                    F.struct(model.alias("model_name")).alias("agent"), job.alias("job_id"))


def _half(body):
    return F.substring(body, F.lit(1), F.floor(F.length(body) / 2).cast("int"))


def config_files(jobs: DataFrame) -> DataFrame:
    body = F.to_json(_config(F.col("model_name"), F.concat(F.lit("job-"), "k")))
    return _file(jobs, A.CONFIG, F.when(F.expr(CUT_CONFIG), _half(body)).otherwise(body))


def result_files(jobs: DataFrame) -> DataFrame:
    nested = _config(
        F.when(F.expr(OTHER_MODEL), "other").otherwise(F.col("model_name")),
        F.when(~F.expr(NO_JOB), F.concat(F.lit("job-"), "k")))
    meta = F.struct("iterations", F.col("n_messages").alias("conversation_length"))
    body = F.to_json(F.struct(
        F.md5("trial_name").alias("id"), "task_name", "trial_name", nested.alias("config"),
        F.struct(meta.alias("metadata")).alias("agent_result"),
        F.when(F.expr(TIMED_OUT), F.struct(F.lit("harness.trial.AgentTimeoutError").alias("exception_type"))).alias("exception_info"),
    ))
    wrong = F.when(F.expr(LIST_RESULT), "[]").when(F.expr(CUT_RESULT), _half(body)).otherwise(body)
    return _file(jobs.filter(f"NOT ({NO_RESULT})"), A.RESULT, wrong)


def reward_files(jobs: DataFrame) -> DataFrame:
    return _file(jobs, A.REWARD, F.when(F.expr(BLANK_REWARD), " \n").otherwise(F.concat(F.col("reward").cast("string"), F.lit("\n"))))


def exception_files(jobs: DataFrame) -> DataFrame:
    """Chains of one to three links: a cancelled call, a timeout caused by it, the class that ended the trial."""
    def link(frames: int, ending):
        lines = [F.concat(F.lit(f'  File "/lib/step{n}.py", line '), (F.col("k") + n).cast("string"), F.lit(f", in step{n}\n    await part()\n"))
                 for n in range(1, frames + 1)]
        return F.concat(F.lit("Traceback (most recent call last):\n"), *lines, ending)

    cause, context = (F.lit(f"\n\n{t}\n\n") for t in (
        "The above exception was the direct cause of the following exception:",
        "During handling of the above exception, another exception occurred:"))
    last = link(2, F.concat(F.lit("harness.trial.AgentTimeoutError: "), "task_name", F.lit(" timed out\nafter "), F.col("k").cast("string"), F.lit(" turns")))
    body = F.concat(
        F.when(F.col("k") % 2 == 0, F.concat(link(3, F.lit("asyncio.exceptions.CancelledError")), context)).otherwise(F.lit("")),
        F.when(F.col("k") % 4 < 2, F.concat(link(1, F.lit("TimeoutError")), cause)).otherwise(F.lit("")), last, F.lit("\n"))
    return _file(jobs.filter(f"{TIMED_OUT} AND model_name = 'base'"), A.EXCEPTION, body)


def _folder(spark, sf, *kinds) -> A.RunFolder:
    jobs = _jobs(spark, sf)
    files = kinds[0](jobs)
    for kind in kinds[1:]:
        files = files.unionByName(kind(jobs))
    return A.RunFolder(spark, lay_out(spark, files, scratch_dir(spark, "folder")))


OUTCOME = f"""
SELECT *, {SOUND} AS has_result, CASE WHEN NOT ({BLANK_REWARD}) THEN CAST(reward AS DOUBLE) END AS rated,
  CASE WHEN ({TIMED_OUT}) AND (model_name = 'base' OR ({SOUND})) THEN 'AgentTimeoutError' END AS exc_type FROM jobs"""


@query("folder_trials", ctes(**VIEWS, seen=OUTCOME) + f"""
SELECT trial_name, task_name, CASE WHEN NOT ({CUT_CONFIG}) THEN model_name END AS model_name, has_result,
  CASE WHEN has_result THEN CAST(iterations AS BIGINT) END AS iterations, rated AS reward, exc_type,
  CAST(({CUT_CONFIG})::INT + ({BLANK_REWARD})::INT + (NOT ({NO_RESULT}) AND NOT ({SOUND}))::INT AS BIGINT) AS broken,
  CASE WHEN rated >= 1 THEN 'pass' WHEN exc_type IS NOT NULL THEN 'agent_timeout' WHEN rated IS NOT NULL THEN 'fail'
       ELSE 'no_result' END AS outcome
FROM seen""")
def folder_trials(spark, sf):
    run = _folder(spark, sf, config_files, result_files, reward_files, exception_files)
    return A.run_trials(run).select(
        "trial_name", "task_name", "model_name", "has_result", "iterations", "reward", "exc_type", "broken", "outcome")


@query("folder_broken", ctes(**VIEWS) + f"""
SELECT trial_name, 'config.json' AS file, 'cut_off' AS reason FROM jobs WHERE {CUT_CONFIG}
UNION ALL SELECT trial_name, 'result.json', 'not_an_object' FROM jobs WHERE {LIST_RESULT} AND NOT ({NO_RESULT})
UNION ALL SELECT trial_name, 'result.json', 'cut_off' FROM jobs WHERE {CUT_RESULT} AND NOT ({NO_RESULT})
UNION ALL SELECT trial_name, 'verifier/reward.txt', 'empty' FROM jobs WHERE {BLANK_REWARD}""")
def folder_broken(spark, sf):
    run = _folder(spark, sf, config_files, result_files, reward_files)
    return A.broken(run).select("trial_name", "file", "reason")


@query("folder_config_differences", ctes(**VIEWS) + f"""
SELECT trial_name, '$.agent.model_name' AS path, concat('"', model_name, '"') AS in_file, '"other"' AS in_result, 'changed' AS kind
FROM jobs WHERE {OTHER_MODEL} AND {SOUND} AND NOT ({CUT_CONFIG})
UNION ALL SELECT trial_name, '$.job_id', concat('"job-', CAST(k AS VARCHAR), '"'), NULL, 'only_in_file'
FROM jobs WHERE {NO_JOB} AND {SOUND} AND NOT ({CUT_CONFIG})""")
def folder_config_differences(spark, sf):
    return A.config_differences(_folder(spark, sf, config_files, result_files))


@query("folder_exception_links", ctes(**VIEWS, links=f"""
SELECT trial_name, k, 0 AS place, CAST(NULL AS VARCHAR) AS after, 'CancelledError' AS exc_type,
  'asyncio.exceptions.CancelledError' AS exc_class, CAST(NULL AS VARCHAR) AS message, 3 AS n FROM jobs WHERE k % 2 = 0 AND {TIMED_OUT} AND model_name = 'base'
UNION ALL SELECT trial_name, k, 1, 'context', 'TimeoutError', 'TimeoutError', NULL, 1 FROM jobs WHERE k % 4 < 2 AND {TIMED_OUT} AND model_name = 'base'
UNION ALL SELECT trial_name, k, 2, CASE WHEN k % 4 < 2 THEN 'cause' ELSE 'context' END, 'AgentTimeoutError', 'harness.trial.AgentTimeoutError',
  concat(task_name, ' timed out', chr(10), 'after ', CAST(k AS VARCHAR), ' turns'), 2 FROM jobs WHERE {TIMED_OUT} AND model_name = 'base'""") + """
SELECT trial_name, link, CASE WHEN link > 1 THEN after END AS led_by, exc_type, exc_class, message, CAST(n AS BIGINT) AS n_frames,
  concat('/lib/step', CAST(n AS VARCHAR), '.py') AS file, CAST(k + n AS BIGINT) AS line_no, concat('step', CAST(n AS VARCHAR)) AS function
FROM (SELECT *, row_number() OVER (PARTITION BY trial_name ORDER BY place) AS link FROM links) t""")
def folder_exception_links(spark, sf):
    return A.exception_links(_folder(spark, sf, exception_files))


@query("folder_sync", ctes(**VIEWS) + f"""
SELECT trial_name, {SOUND} AND k % 10 <> 3 AS has_result,
  CASE WHEN k % 6 = 0 THEN 1.0::DOUBLE WHEN NOT ({BLANK_REWARD}) THEN CAST(reward AS DOUBLE) END AS reward FROM jobs""")
def folder_sync(spark, sf):
    """A first half of the folders, then the others, some rewards written anew and some results taken away."""
    jobs, root = _jobs(spark, sf), scratch_dir(spark, "folder")
    run = A.SyncedRun(spark, root, scratch_dir(spark, "synced"))
    for half in ("k < 45", "k >= 45"):
        own = jobs.filter(half)
        lay_out(spark, config_files(own).unionByName(result_files(own)).unionByName(reward_files(own)), root)
        run.sync()
    lay_out(spark, _file(jobs.filter("k % 6 = 0"), A.REWARD, F.lit("1\n")), root)
    system = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for (path,) in result_files(jobs.filter("k % 10 = 3")).select("path").toLocalIterator():
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{path}"), False)
    run.sync()
    return A.run_trials(run).select("trial_name", "has_result", "reward")


NATIONS = "SELECT c_nationkey AS k, concat('n', CAST(c_nationkey AS VARCHAR)) AS name, c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY ALL"


def _nations(spark, sf) -> DataFrame:
    return V.table(spark, sf, "customer").groupBy(
        F.col("c_nationkey").alias("k"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("name"),
        F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))


@query("folder_valid_tasks", ctes(nations=NATIONS) + "SELECT DISTINCT name AS task_name FROM nations WHERE k % 3 <> 0")
def folder_valid_tasks(spark, sf):
    rows = _nations(spark, sf).select("k", "name").distinct()
    folder = F.when(F.col("k") % 6 == 3, F.concat(F.lit(".git"), "name")).otherwise(F.col("name"))
    marker = F.when(F.col("k") % 6 == 0, "README.md").otherwise(MARKER)
    files = rows.select(F.concat(folder, F.lit("/"), marker).alias("path"), F.col("name").alias("body"))
    deep = rows.select(F.concat("name", F.lit("/old/"), F.lit(MARKER)).alias("path"), F.col("name").alias("body"))
    return datasets.valid_tasks(spark, lay_out(spark, files.unionByName(deep), scratch_dir(spark, "tasks")))


@query("folder_snapshots", ctes(nations=NATIONS, tasks="""
SELECT concat('datasets--x--', name) AS folder, segment, CASE WHEN (k + length(segment)) % 3 <> 0 THEN n % 4 ELSE 0 END AS n_tasks FROM nations""") + """
SELECT folder, max(segment) AS latest_snapshot, CAST(max_by(n_tasks, segment) AS BIGINT) AS n_tasks, max_by(n_tasks, segment) > 0 AS usable
FROM tasks GROUP BY folder""")
def folder_snapshots(spark, sf):
    base = F.concat(F.lit("datasets--x--"), "name", F.lit("/snapshots/"), "segment", F.lit("/"))
    rows = _nations(spark, sf).withColumn("base", base)
    tasks = F.when((F.col("k") + F.length("segment")) % 3 != 0, F.col("n") % 4).otherwise(F.lit(0))
    some = rows.withColumn("t", F.explode(F.sequence(F.lit(0), tasks.cast("int")))).select(
        F.concat("base", F.when(F.col("t") == 0, "README.md").otherwise(
            F.concat(F.lit("t"), F.col("t").cast("string"), F.lit(f"/{MARKER}")))).alias("path"), F.col("name").alias("body"))
    return datasets.latest_snapshots(spark, lay_out(spark, some, scratch_dir(spark, "hub")))
