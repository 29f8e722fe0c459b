"""Trial artifacts: from run folders, or from a packed table of them.

A run folder holds one folder per trial with up to seven small files. That is fine for
one run; for many, ``pack`` copies all of them once into a Parquet table with one row per
file (``trial_name, body``), partitioned by file name, and every reader takes either form.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell import schemas
from tracewell.functions import parsing
from tracewell.functions.names import trial_suffix, trial_task
from tracewell.functions.pin import pin
from tracewell.functions.text import py_strip
from tracewell.operators.blocks import join_by
from tracewell.operators.documents import tree_differences
from tracewell.operators.corpus import relative_parts
from tracewell.operators.trials import outcome, trial_table
from tracewell.streaming.runs import SEQ, RunStore, Table

# File names inside a trial folder and inside a job folder.
RESULT, CONFIG = "result.json", "config.json"
REWARD, REPORT, CONSOLE = "verifier/reward.txt", "verifier/ctrf.json", "verifier/test-stdout.txt"
EXCEPTION, TRIAL_LOG, TRANSCRIPT = "exception.txt", "trial.log", "response.txt"
JOB_LOG = "job.log"
JOB = "job/"  # before the names of job files in tables
TRIAL_FILES = (RESULT, CONFIG, REWARD, REPORT, CONSOLE, EXCEPTION, TRIAL_LOG, TRANSCRIPT)


def _plain(path: Column) -> Column:
    """Path without scheme, so listed and given paths compare."""
    return F.regexp_replace(path, "^[A-Za-z0-9]+:/+", "/")


def file_tree(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """All files below ``root``, listed once, when this is called: ``path, modificationTime, length`` and
    ``content``. A file is opened only by a plan that uses its content, and filters on ``length``, ``modificationTime``
    and ``_metadata.file_name`` leave other files closed. Spark packs files into tasks by size, and takes files without a byte for missing."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(root)
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths below ``root``; contents are not read."""
    return file_tree(spark, root, pattern).select(_plain(F.col("path")).alias("path"))


@dataclass(frozen=True)
class RunFolder:
    """Artifacts as files: ``<root>/<trial>/...`` with job files directly in ``root``.

    The tree is listed once, on first use, so all readers of one ``RunFolder`` see the same files; make a new
    one to see later files, or keep a ``SyncedRun``, which reads only what changed.
    """

    spark: SparkSession
    root: str

    @cached_property
    def tree(self) -> DataFrame:
        return file_tree(self.spark, self.root)

    def _below(self, files: DataFrame) -> DataFrame:
        """``files`` with ``parts``, the path components below the root."""
        return files.withColumn("parts", relative_parts(_plain(F.col("path")), _plain(F.lit(self.root))))

    def _named(self, name: str) -> DataFrame:
        """``parts, body`` of all files of that name; others stay closed."""
        return self._below(self.tree.filter(F.col("_metadata.file_name") == name)).select(
            "parts", F.col("content").cast("string").alias("body"))

    def described(self, files: DataFrame, *more: Column) -> DataFrame:
        """``trial_name`` (null for job files), ``file`` (path within), size and time of files of the tree."""
        return self._below(files).select(
            F.when(F.size("parts") > 1, F.get("parts", 0)).alias("trial_name"),
            F.when(F.size("parts") > 1, F.array_join(F.slice("parts", 2, F.size("parts")), "/"))
            .otherwise(F.concat(F.lit(JOB), F.get("parts", 0))).alias("file"),
            F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *more,
        )

    def inventory(self) -> DataFrame:
        """Every file as ``described``; nothing is opened."""
        return self.described(self.tree)

    def bodies(self, name: str) -> DataFrame:
        """``trial_name, body`` of one kind of trial file."""
        wanted = name.split("/")
        return self._named(wanted[-1]).filter(
            F.slice("parts", 2, F.size("parts")) == F.array(*[F.lit(w) for w in wanted])
        ).select(F.get("parts", 0).alias("trial_name"), "body")

    def job_bodies(self, name: str) -> DataFrame:
        return self._named(name).filter(F.size("parts") == 1).select("body")

    def job_lines(self, name: str) -> DataFrame:
        """Lines of a job file; a long log is read in splits, so lines carry no number."""
        try:
            lines = self.spark.read.text(f"{self.root.rstrip('/')}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "line STRING")
        return lines.select(F.col("value").alias("line"))

    def presence(self) -> DataFrame:
        """One row per trial and file kind present."""
        return self.inventory().filter(F.col("file").isin(*TRIAL_FILES) & F.col("trial_name").isNotNull()).select(
            "trial_name", "file")


@dataclass(frozen=True)
class PackedRun:
    """Artifacts as a table partitioned by file kind; one kind is read per scan."""

    spark: SparkSession
    path: str

    def _rows(self) -> DataFrame:
        schema = "trial_name STRING, body STRING, file STRING"
        return self.spark.read.schema(schema).parquet(self.path)

    def bodies(self, name: str) -> DataFrame:
        return self._rows().filter(F.col("file") == name).select("trial_name", "body")

    def job_bodies(self, name: str) -> DataFrame:
        return self.bodies(f"{JOB}{name}").select("body")

    def job_lines(self, name: str) -> DataFrame:
        """Job files kept by line have one row per line."""
        return self.bodies(f"{JOB}{name}").select(F.col("body").alias("line"))

    def presence(self) -> DataFrame:
        return self._rows().filter(F.col("file").isin(*TRIAL_FILES)).select("trial_name", "file")


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_packed(rows: DataFrame, path: str) -> None:
    """``trial_name, file, body`` -> packed table.

    A task keeps a file open for each kind that it meets, so that Spark need not sort its rows by kind, which would hold
    all bodies of a task in memory; a task that meets more kinds than there are sorts the rest.
    """
    conf = rows.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, str(len(TRIAL_FILES) + 2))  # and the two job files
    try:
        rows.write.mode("append").partitionBy("file").parquet(path)
    finally:
        conf.set(_WRITERS, before)


def pack(spark: SparkSession, root: str, path: str) -> PackedRun:
    """Copy a run folder into a packed table, once."""
    folder = RunFolder(spark, root)
    inside = F.array_join(F.slice("parts", 2, F.size("parts")), "/")
    is_job = F.size("parts") == 1
    names = sorted({name.rsplit("/", 1)[-1] for name in TRIAL_FILES})
    wanted = folder._below(folder.tree.filter(F.col("_metadata.file_name").isin(*names)))
    named = wanted.select(
        F.when(~is_job, F.get("parts", 0)).alias("trial_name"),
        F.when(is_job, F.concat(F.lit(JOB), F.get("parts", 0))).otherwise(inside).alias("file"),
        F.col("content").cast("string").alias("body"),
    ).filter(F.col("file").isin(*TRIAL_FILES, f"{JOB}{CONFIG}"))
    log = folder.job_lines(JOB_LOG).select(
        F.lit(None).cast("string").alias("trial_name"), F.lit(f"{JOB}{JOB_LOG}").alias("file"),
        F.col("line").alias("body"),
    )
    write_packed(named.unionByName(log), path)
    return PackedRun(spark, path)


@dataclass(frozen=True)
class SyncedRun:
    """A run folder that still grows, kept as a table of files with their bodies.

    ``sync`` lists the tree once and compares it with what the table holds. Only files that are new, or differ
    in size or time, are opened; files that are gone leave a mark. Runs are sorted by kind of file, so a reader of one
    kind skips the others' row groups.
    """

    spark: SparkSession
    root: str
    path: str
    table: Table = field(default=Table("files", ("file", "trial_name")))

    @property
    def store(self) -> RunStore:
        return RunStore(self.spark, self.path)

    def _known(self) -> DataFrame:
        rows = self.store.rows("files", _FILES)
        return self.table.combined(rows.select("file", "trial_name", "size", "modified", "gone", SEQ)).filter("not gone")

    def sync(self) -> dict[str, int]:
        """Take in what changed: how many files were ``read`` and how many were ``gone``."""
        store, folder = self.store, RunFolder(self.spark, self.root)
        listed, known = folder.inventory(), self._known()
        same = ["file", "trial_name", "size", "modified"]
        changed = join_by(listed, known.select(*same), same, "left_anti")
        gone = join_by(known.select("file", "trial_name"), listed, ["file", "trial_name"], "left_anti")
        found = changed.agg(F.count(F.lit(1)).alias("n"), F.min("modified").alias("since")).first()
        n_gone = gone.count()
        if not found.n and not n_gone:
            return {"read": 0, "gone": 0}
        recent = folder.tree.filter(F.col("modificationTime") >= F.lit(found.since))
        bodies = folder.described(recent, F.col("content").cast("string").alias("body"))
        rows = join_by(bodies, changed.select("file", "trial_name"), ["file", "trial_name"], "left_semi").withColumn(
            "gone", F.lit(False))
        marks = gone.select("trial_name", "file", F.lit(None).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified"),
                            F.lit(None).cast("string").alias("body"), F.lit(True).alias("gone"))
        batch = store.manifest()["batch"] + 1
        store.commit(batch, [(self.table, store.write_run(self.table, batch, rows.unionByName(marks)))])
        return {"read": found.n, "gone": n_gone}

    def _rows(self, kind: Column) -> DataFrame:
        return self.table.combined(self.store.rows("files", _FILES).filter(kind)).filter("not gone")

    def bodies(self, name: str) -> DataFrame:
        return self._rows(F.col("file") == name).select("trial_name", "body")

    def job_bodies(self, name: str) -> DataFrame:
        return self.bodies(f"{JOB}{name}").select("body")

    def job_lines(self, name: str) -> DataFrame:
        return _lines(self.job_bodies(name)).select("line")

    def presence(self) -> DataFrame:
        return self._known().filter(F.col("file").isin(*TRIAL_FILES)).select("trial_name", "file")


_FILES = "trial_name STRING, file STRING, size BIGINT, modified TIMESTAMP, body STRING, gone BOOLEAN"


# --- typed readers ---------------------------------------------------------------


CORRUPT = "_corrupt"
DOCUMENTS = {RESULT: schemas.TRIAL_RESULT, CONFIG: schemas.TRIAL_CONFIG, REPORT: schemas.TEST_REPORT}


def _parsed(rows: DataFrame, schema: str) -> DataFrame:
    """``rows`` with the document ``d`` and ``reason``, null for a sound one: empty, not_an_object, cut_off (the text ends
    within the document), malformed, or wrong_type (a value does not fit its field)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = py_strip(F.coalesce("body", F.lit("")))
    reason = (
        F.when(text == "", "empty")
        .when(~F.startswith(text, F.lit("{")), "not_an_object")
        .when(F.col("d").isNotNull() & F.col(f"d.{CORRUPT}").isNull(), F.lit(None))
        .when(F.try_parse_json("body").isNotNull(), "wrong_type")
        .when(F.endswith(text, F.lit("}")), "malformed")
        .otherwise("cut_off")
    )
    read = pin(rows, d=F.from_json("body", f"{schema}, {CORRUPT} STRING", options))
    return read.withColumn("reason", reason)


def _sound(rows: DataFrame, schema: str) -> DataFrame:
    return _parsed(rows, schema).filter("reason is null").withColumnRenamed("trial_name", "_folder").withColumn(
        "d", F.col("d").dropFields(CORRUPT))


def broken(run) -> DataFrame:
    """Files that no typed reader takes: ``trial_name`` (the folder), ``file``, ``reason``, ``size`` and the whole ``body``."""
    parts = [
        _parsed(run.bodies(name), schema).filter("reason is not null")
        .select("trial_name", F.lit(name).alias("file"), "reason", "body")
        for name, schema in DOCUMENTS.items()
    ]
    job = run.job_bodies(CONFIG).select(F.lit(None).cast("string").alias("trial_name"), "body")
    parts.append(_parsed(job, schemas.JOB_CONFIG).filter("reason is not null").select(
        "trial_name", F.lit(f"{JOB}{CONFIG}").alias("file"), "reason", "body"))
    text = py_strip(F.coalesce("body", F.lit("")))
    reward = F.when(text == "", "empty").when(text.try_cast("double").isNull(), "wrong_type")
    parts.append(run.bodies(REWARD).select("trial_name", F.lit(REWARD).alias("file"), reward.alias("reason"), "body")
                 .filter("reason is not null"))
    return reduce(DataFrame.unionByName, parts).select(
        "trial_name", "file", "reason", F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("size"), "body")


def broken_counts(run) -> DataFrame:
    """Broken files per kind and reason."""
    return broken(run).groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n_files"))


def results(run) -> DataFrame:
    """Trial results; broken documents are in ``broken``."""
    return _sound(run.bodies(RESULT), schemas.TRIAL_RESULT).select("d.*")


def trial_configs(run) -> DataFrame:
    return _sound(run.bodies(CONFIG), schemas.TRIAL_CONFIG).select("d.*")


def job_config(run) -> DataFrame:
    rows = run.job_bodies(CONFIG).select(F.lit(None).cast("string").alias("trial_name"), "body")
    return _sound(rows, schemas.JOB_CONFIG).select("d.*")


def rewards(run) -> DataFrame:
    return run.bodies(REWARD).select(
        "trial_name", py_strip(F.col("body")).try_cast("double").alias("reward")
    )


def reports(run) -> DataFrame:
    return _sound(run.bodies(REPORT), schemas.TEST_REPORT).select(
        F.col("_folder").alias("trial_name"), "d.results.tool", "d.results.summary",
        "d.results.tests",
    )


def tests(run) -> DataFrame:
    """One row per reported test; a report without tests keeps one row of nulls."""
    return reports(run).select("trial_name", F.explode_outer("tests").alias("t")).select(
        "trial_name",
        F.col("t.name").alias("test_name"),
        *[f"t.{c}" for c in ("status", "raw_status", "duration", "start", "stop", "retries",
                             "file_path", "trace", "message", "tags")],
    )


def exceptions(run) -> DataFrame:
    return parsing.parse_exceptions(run.bodies(EXCEPTION)).drop("body")


def exception_links(run) -> DataFrame:
    """One row per link of each trial's exception, from the first cause to the one that ended the trial."""
    return parsing.exception_links(run.bodies(EXCEPTION))


def config_differences(run) -> DataFrame:
    """Where a trial's config file and the config inside its result differ: ``trial_name``, ``path``, both
    values as JSON, and ``kind``. Trials that lack one of the two, or whose files are broken, are not compared."""
    whole = [_parsed(run.bodies(name), DOCUMENTS[name]).filter("reason is null") for name in (CONFIG, RESULT)]
    config, result = (rows.select("trial_name", "body") for rows in whole)
    nested = result.select("trial_name", F.try_parse_json("body").alias("v")).select(
        "trial_name", F.variant_get("v", "$.config", "variant").alias("v")).filter("v is not null")
    given = config.select("trial_name", F.try_parse_json("body").alias("v"))
    both = given.select("trial_name").join(nested.select("trial_name"), "trial_name")
    return tree_differences(
        given.join(both, "trial_name", "left_semi"), nested.join(both, "trial_name", "left_semi"), "trial_name", "in_file", "in_result")


def consoles(run) -> DataFrame:
    return parsing.parse_console(run.bodies(CONSOLE)).drop("body")


def console_tests(run) -> DataFrame:
    return parsing.console_tests(run.bodies(CONSOLE))


def _lines(rows: DataFrame) -> DataFrame:
    others = [c for c in rows.columns if c != "body"]
    lines = F.split(F.regexp_replace("body", "\n+$", ""), "\n")
    return rows.select(*others, F.posexplode(lines).alias("_at", "line")).select(
        *others, (F.col("_at") + 1).cast("long").alias("line_no"), "line"
    )


def trial_logs(run) -> DataFrame:
    lines = _lines(run.bodies(TRIAL_LOG)).withColumnRenamed("trial_name", "folder")
    return parsing.parse_log_lines(lines)


def job_log(run) -> DataFrame:
    return parsing.parse_log_lines(run.job_lines(JOB_LOG))


def trial_failures(run) -> DataFrame:
    """One failure message per trial, from trial logs and the job log together."""
    rows = trial_logs(run).select("trial_name", "kind", "message").unionByName(
        job_log(run).select("trial_name", "kind", "message")
    )
    return (
        rows.filter(F.col("kind") == "trial_failed")
        .groupBy("trial_name").agg(F.max("message").alias("failure"))
    )


# --- transcripts ---------------------------------------------------------------------

_REST = 1 << 30  # "up to the end" for slice and substring

# Layout of a transcript.
_WIDE, _NARROW = "=" * 80, "=" * 60
_PROMPT_HEAD = f"{_WIDE}\nSYSTEM PROMPT\n{_WIDE}\n\n"
_TASK_HEAD = f"\n\n{_WIDE}\nTASK INSTRUCTION\n{_WIDE}\n\n"
_LOG_HEAD = f"\n\n{_WIDE}\nAGENT EXECUTION LOG\n{_WIDE}\n\n"
_TURN_HEAD = f"\n{_NARROW}\nITERATION [0-9]+\n{_NARROW}\n\n"
_REPLY_MARK = "[ASSISTANT RESPONSE]\n"
_END_HEAD = f"\n{_WIDE}\nTASK COMPLETED\n{_WIDE}\n"


def parse_transcripts(rows: DataFrame) -> DataFrame:
    """``trial_name, body`` -> prompt, instruction, ``turns`` and the closing summary.

    ``turns`` is an array of replies, one per iteration; a failed model call is null. A
    transcript that was cut off has a null summary.
    """
    halves = F.split("body", _LOG_HEAD, 2)
    seed = F.split(F.get("_halves", 0), _TASK_HEAD, 2)
    ending = F.split(F.get("_halves", 1), _END_HEAD, 2)
    chunks = F.slice(F.split(F.get("_ending", 0), _TURN_HEAD), 2, _REST)
    end = F.get("_ending", 1)

    def reply(chunk: Column) -> Column:
        said = F.substring(chunk, len(_REPLY_MARK) + 1, _REST)
        return F.when(
            F.startswith(chunk, F.lit(_REPLY_MARK)), F.regexp_replace(said, r"\n\n\z", "")
        )

    def closing(label: str) -> Column:
        value = F.regexp_extract(end, rf"(?m)^{label}: (.*)$", 1)
        return F.when(value != "", value)

    return (
        rows.withColumn("_halves", halves)
        .withColumn("_seed", seed)
        .withColumn("_ending", ending)
        .select(
            "trial_name",
            F.substring(F.get("_seed", 0), len(_PROMPT_HEAD) + 1, _REST)
            .alias("system_prompt"),
            F.get("_seed", 1).alias("instruction"),
            F.transform(chunks, reply).alias("turns"),
            closing("Status").alias("status"),
            closing("Total iterations").cast("long").alias("n_iterations"),
            closing("Total messages in conversation").cast("long").alias("n_messages"),
            (closing("Task complete signal detected") == "True").alias("signal"),
        )
    )


def transcripts(run) -> DataFrame:
    return parse_transcripts(run.bodies(TRANSCRIPT))


def transcript_turns(parsed: DataFrame) -> DataFrame:
    """One row per iteration; header and summary columns are repeated."""
    others = [c for c in parsed.columns if c != "turns"]
    return parsed.select(*others, F.posexplode("turns").alias("_at", "reply")).select(
        *others, (F.col("_at") + 1).cast("long").alias("iteration"), "reply"
    )


# --- the whole run --------------------------------------------------------------------


def run_trials(run) -> DataFrame:
    """One row per trial folder with a config, and everything recorded about it.

    A trial goes by its folder, so one whose config is broken is there with its name alone. ``broken`` counts the
    broken files of a trial; a broken result is no result. ``exception_info`` is the result's own record of an exception, whose class counts
    where there is no exception file.
    """
    def sound(field: str) -> Column:
        return F.when(F.col("reason").isNull(), F.col(f"d.{field}"))

    bad = F.col("reason").isNotNull().cast("long")
    spine = _parsed(run.bodies(CONFIG), schemas.TRIAL_CONFIG).select(
        "trial_name",
        F.coalesce(trial_task(F.col("trial_name")), sound("task.path")).alias("task_name"),
        trial_suffix(F.col("trial_name")).alias("suffix"),
        sound("agent.model_name").alias("model_name"), sound("job_id").alias("job_id"), bad.alias("_config"),
    )
    names = ("id", "started_at", "finished_at", "environment_setup", "agent_setup", "agent_execution", "verifier", "exception_info")
    found = _parsed(run.bodies(RESULT), schemas.TRIAL_RESULT).select(
        "trial_name", *[sound(c).alias(c) for c in names],
        *[sound(f"agent_result.metadata.{c}").alias(c) for c in ("iterations", "conversation_length")],
        sound("verifier_result.rewards")["reward"].alias("result_reward"),
        F.col("reason").isNull().alias("has_result"), bad.alias("_result"),
    )
    known = F.filter(sound("results.tests"), lambda t: t["name"].isNotNull())
    tested = pin(_parsed(run.bodies(REPORT), schemas.TEST_REPORT).select("trial_name", "reason", "d"), t=known)
    n, passed = F.size("t"), F.size(F.filter("t", lambda t: t["status"] == "passed"))
    some = lambda c: F.when(n > 0, c)
    rollup = tested.select(
        "trial_name", some(n.cast("long")).alias("n_tests"), some(passed.cast("long")).alias("n_tests_passed"),
        some(passed / n).alias("partial_credit"), some(passed == n).alias("all_passed"), bad.alias("_report"))
    rated = rewards(run).withColumn("_reward", F.col("reward").isNull().cast("long"))
    failed = exceptions(run).select("trial_name", "exc_type", "timeout_sec")
    table = trial_table(spine, "trial_name", found, rated, rollup, failed, trial_failures(run))
    recorded = F.get_json_object("exception_info", "$.exception_type")
    counts = ("_config", "_result", "_report", "_reward")
    table = table.withColumns({
        "has_result": F.coalesce("has_result", F.lit(False)),
        "broken": sum((F.coalesce(c, F.lit(0).cast("long")) for c in counts[1:]), F.col(counts[0])),
        "exc_type": F.coalesce("exc_type", F.element_at(F.split(recorded, "[.]"), -1)),
    }).drop(*counts)
    return table.withColumn("outcome", outcome(F.col("reward"), F.col("exc_type"), F.col("failure")))
