"""Scans over small run folders that hold every mix of files a trial can leave behind."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tracewell.operators import trials as B
from tracewell.plans.run_files import render_transcript
from tracewell.sources import artifacts as A
from tracewell.sources import datasets, writers

STAMP = "2026-01-11T22:50:0{}.000001"
TIMEOUT = (
    "Traceback (most recent call last):\n  File \"t.py\", line 1, in run\n"
    "harness.trial.AgentTimeoutError: Agent execution timed out after 900.0 seconds\n"
)
CONSOLE = "PASSED t.py::a\nFAILED t.py::b - x\n=== 1 failed, 1 passed in 0.09s ===\n"
CUT_CONSOLE = "=== test session starts ===\ncollected 1 item\n"

# Mixes of files: result, reward, report, console, exception, log.
SHAPES = ["r w", "r w t", "r w t c", "e w", "e w t", "", "w", "e w c", "e l c", "e l"]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def result(name, reward):
    phase = {"started_at": STAMP.format(0), "finished_at": STAMP.format(3)}
    return {
        "id": f"id-{name}", "task_name": name.split("__")[0], "trial_name": name,
        "config": {"trial_name": name, "agent": {"model_name": "m", "kwargs": {"api_base": "u"}}},
        "agent_result": {"n_input_tokens": None, "cost_usd": None,
                         "metadata": {"iterations": 3, "conversation_length": 7,
                                      "status": "completed_with_signal", "task_complete_signal": True}},
        "verifier_result": {"rewards": {"reward": reward}}, "exception_info": None,
        "started_at": STAMP.format(0), "finished_at": STAMP.format(9),
        "environment_setup": phase, "agent_setup": phase, "agent_execution": phase, "verifier": phase,
    }


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("job") / "job-1")
    put(f"{base}/config.json", json.dumps(
        {"job_name": "job-1", "n_attempts": 5, "metrics": [], "tasks": [],
         "orchestrator": {"n_concurrent_trials": 4, "retry": {
             "max_retries": 0, "include_exceptions": None, "exclude_exceptions": ["AgentTimeoutError"]}},
         "agents": [{"model_name": "m", "kwargs": {"api_base": "u"}}]}, indent=4))
    put(f"{base}/job.log",
        "Exception AgentTimeoutError is in exclude_exceptions, not retrying\n"
        "Not retrying trial because no retries are left\n"
        "Trial task-8__s8 failed: Verifier execution timed out after 900.0 seconds\n")
    for i, shape in enumerate(SHAPES):
        name, kinds = f"task-{i}__s{i}", shape.split()
        folder = f"{base}/{name}"
        put(f"{folder}/config.json", json.dumps(
            {"trial_name": name, "task": {"path": f"task-{i}"}, "job_id": "j",
             "agent": {"model_name": "m", "kwargs": {"api_base": "u"}}}, indent=4))
        reward = 1.0 if i == 1 else 0.0
        if "r" in kinds:
            put(f"{folder}/result.json", json.dumps(result(name, reward), indent=4))
        if "w" in kinds:
            put(f"{folder}/verifier/reward.txt", f"{int(reward)}\n")
        if "t" in kinds:
            tests = [{"name": "t.py::a", "status": "passed", "retries": 0}]
            if i != 1:
                tests.append({"name": "t.py::b", "status": "failed", "message": "boom", "tags": ["x"]})
            put(f"{folder}/verifier/ctrf.json", json.dumps(
                {"results": {"tool": {"name": "t"}, "summary": {"tests": len(tests)}, "tests": tests}}, indent=4))
        if "c" in kinds:
            put(f"{folder}/verifier/test-stdout.txt", CONSOLE if i == 2 else CUT_CONSOLE)
        if "e" in kinds:
            put(f"{folder}/exception.txt", TIMEOUT)
        if "l" in kinds and i == 9:
            put(f"{folder}/trial.log", f"Trial {name} failed: Verifier execution timed out after 900.0 seconds")
    return base


@pytest.fixture(scope="module", params=["folder", "packed"])
def run(request, spark, root, tmp_path_factory):
    if request.param == "folder":
        return A.RunFolder(spark, root)
    return A.pack(spark, root, str(tmp_path_factory.mktemp("packed") / "p"))


def test_configs_by_depth(run):
    assert A.trial_configs(run).count() == 10
    job = A.job_config(run).collect()
    assert len(job) == 1 and job[0].n_attempts == 5
    assert job[0].orchestrator.retry.include_exceptions is None
    assert job[0].orchestrator.retry.exclude_exceptions == ["AgentTimeoutError"]


def test_results_rewards_reports(run):
    assert A.results(run).count() == 3
    assert A.results(run).filter("exception_info IS NULL").count() == 3
    rewards = A.rewards(run).groupBy("reward").count().orderBy("reward").collect()
    assert [tuple(r) for r in rewards] == [(0.0, 6), (1.0, 1)]
    tests = A.tests(run).collect()
    assert len(tests) == 5 and sum(t.status == "passed" for t in tests) == 3
    assert {t.message for t in tests} == {None, "boom"} and any(t.tags == ["x"] for t in tests)


def test_text_files(run):
    assert {(r.exc_type, r.timeout_sec) for r in A.exceptions(run).collect()} == {
        ("AgentTimeoutError", 900.0)}
    assert A.exceptions(run).count() == 5
    consoles = {r.trial_name: r for r in A.consoles(run).collect()}
    assert (consoles["task-2__s2"].n_passed, consoles["task-2__s2"].seconds) == (1, 0.09)
    assert consoles["task-8__s8"].n_passed is None and len(consoles) == 3
    assert A.console_tests(run).count() == 2
    assert sorted(r.kind for r in A.job_log(run).collect()) == ["excluded", "not_retrying", "trial_failed"]
    assert A.trial_failures(run).count() == 2


def test_whole_table(run):
    rows = {r.trial_name: r for r in A.run_trials(run).collect()}
    assert len(rows) == 10 and sum(r.has_result for r in rows.values()) == 3
    assert [rows[f"task-{i}__s{i}"].outcome for i in range(10)] == [
        "fail", "pass", "fail", "agent_timeout", "agent_timeout", "no_result", "fail",
        "agent_timeout", "verifier_timeout", "verifier_timeout"]
    assert rows["task-1__s1"].all_passed and not rows["task-2__s2"].all_passed
    assert rows["task-0__s0"].n_tests is None
    found = B.reconcile({"same": (F.col("reward"), F.col("result_reward"))})["same"]
    assert A.run_trials(run).filter("has_result").filter(~found).count() == 0


def test_coverage(run):
    shapes = {r.files: r.n_trials for r in B.coverage_of_files(run.presence()).collect()}
    assert shapes["config.json"] == 1 and sum(shapes.values()) == 10
    assert shapes["config.json+result.json+verifier/reward.txt"] == 1


def test_transcript_round_trip(spark):
    replies = ["plan\n\n", None, "```sh\nls\n```", "TASK COMPLETE"]
    df = spark.createDataFrame([("t", replies)], "trial_name string, r array<string>")
    body = render_transcript(F.lit("P\n\nQ"), F.lit("I"), F.col("r"), F.lit("completed_with_signal"),
                               F.lit(9), F.lit(True))
    parsed = A.parse_transcripts(df.select("trial_name", body.alias("body")))
    row = parsed.first()
    assert (row.system_prompt, row.instruction, row.turns) == ("P\n\nQ", "I", replies)
    assert (row.status, row.n_iterations, row.n_messages, row.signal) == ("completed_with_signal", 4, 9, True)
    cut = df.select("trial_name", F.substring(body, 1, 700).alias("body"))
    assert A.parse_transcripts(cut).first().status is None
    assert [r.iteration for r in A.transcript_turns(parsed).orderBy("iteration").collect()] == [1, 2, 3, 4]


def test_conversations_by_split(spark, tmp_path):
    path = str(tmp_path / "c")
    message = "array<struct<role:string,`from`:string,content:string>>"
    df = spark.createDataFrame([(1, [("user", None, "a")], "train"), (2, None, "test")],
                               f"conv_id long, conversations {message}, split string")
    df.write.partitionBy("split").parquet(path)
    rows = datasets.read_conversations(spark, path, split="train").collect()
    assert [r.conv_id for r in rows] == [1] and rows[0].asDict().keys() == {"conv_id", "conversations"}


def test_task_folders(spark, tmp_path):
    base = tmp_path / "root"
    for name in ("a/instruction.md", "b/instruction.md", "b/x.txt", "c/x.txt", "d/e/instruction.md",
                 ".github/instruction.md", "instruction.md"):
        put(str(base / name), "x")
    assert sorted(r.task_name for r in datasets.valid_tasks(spark, str(base)).collect()) == ["a", "b"]
    assert datasets.valid_tasks(spark, f"file://{base}/").count() == 2


def test_latest_snapshot(spark, tmp_path):
    hub = tmp_path / "hub"
    for name in ("datasets--a--b/snapshots/01/t/instruction.md", "datasets--a--b/snapshots/02/t/instruction.md",
                 "datasets--a--b/snapshots/02/u/instruction.md", "datasets--c--d/snapshots/f/t/instruction.md",
                 "datasets--c--d/snapshots/g/README.md", "datasets--c--d/blobs/x"):
        put(str(hub / name), "x")
    rows = {r.folder: r for r in datasets.latest_snapshots(spark, str(hub)).collect()}
    assert (rows["datasets--a--b"].latest_snapshot, rows["datasets--a--b"].n_tasks) == ("02", 2)
    assert rows["datasets--c--d"].latest_snapshot == "g" and not rows["datasets--c--d"].usable
    found = datasets.find_dataset(spark, str(hub), "a/b").collect()
    assert [(r.path, r.n_tasks) for r in found] == [(f"{hub}/datasets--a--b/snapshots/02", 2)]
    assert datasets.find_dataset(spark, str(hub), "c/d").count() == 0
    assert datasets.find_dataset(spark, str(hub), "no/where").count() == 0


def test_scrapes(spark, tmp_path):
    put(str(tmp_path / "s" / "1.txt"), 'm{a="b"} 2\n# c\n')
    (row,) = datasets.read_metric_scrapes(spark, str(tmp_path / "s")).collect()
    assert (row.name, row.labels, row.value) == ("m", {"a": "b"}, 2.0) and row.scraped_at is not None


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "i int, job string")
    writers.write_results(rows, str(tmp_path / "r"), F.lit("t0"), F.col("job"))
    writers.write_results(rows, str(tmp_path / "r"), F.lit("t1"), F.col("job"))
    assert os.path.isdir(tmp_path / "r" / "run_ts=t0" / "job_name=x")
    assert spark.read.parquet(str(tmp_path / "r")).filter("run_ts = 't1'").count() == 2
    text = spark.createDataFrame([("b", "z" * 600), ("a", "hi")], "k string, text string")
    assert writers.first_row_preview(text, "k").first().text == "hi..."
    assert writers.first_row_preview(text, "k", None).first().text == "hi"
    doc = spark.createDataFrame([("1\n2\n3",)], "t string").select(writers.first_lines(F.col("t"), 2)).first()[0]
    assert doc == "1\n2"


def ruined(root):
    """Every way in which a file of a run can be of no use."""
    good = json.dumps(result("a__1", 1.0), indent=4)
    config = json.dumps({"trial_name": "x", "task": {"path": "a"}, "agent": {"model_name": "m"}, "job_id": "j"})
    for n, body in enumerate([good, good[:200], " \n", "[]", good.replace('"iterations": 3', '"iterations": "many"'), good[:-3] + "]}", None]):
        put(f"{root}/a__{n}/config.json", config if n != 2 else config[:30])
        if body is not None:
            put(f"{root}/a__{n}/result.json", body)
    put(f"{root}/a__0/verifier/reward.txt", "1\n")
    put(f"{root}/a__1/verifier/reward.txt", " ")
    put(f"{root}/a__2/verifier/reward.txt", "one")
    put(f"{root}/a__3/verifier/ctrf.json", '{"results": {"tests": [{"name": "t", "sta')
    put(f"{root}/config.json", '{"job_name": "j"')
    return root


def test_broken_files_by_folder_name(spark, tmp_path):
    run = A.RunFolder(spark, ruined(str(tmp_path / "run")))
    got = {(r.trial_name, r.file): r.reason for r in A.broken(run).collect()}
    assert got == {
        ("a__2", "config.json"): "cut_off", ("a__1", "result.json"): "cut_off", ("a__2", "result.json"): "empty",
        ("a__3", "result.json"): "not_an_object", ("a__4", "result.json"): "wrong_type", ("a__5", "result.json"): "malformed",
        ("a__1", "verifier/reward.txt"): "empty", ("a__2", "verifier/reward.txt"): "wrong_type",
        ("a__3", "verifier/ctrf.json"): "cut_off", (None, "job/config.json"): "cut_off"}
    bodies = {(r.trial_name, r.file): (r.size, r.body) for r in A.broken(run).collect()}
    assert bodies["a__2", "verifier/reward.txt"] == (3, "one") and bodies["a__1", "result.json"][0] == 200
    assert {(r.file, r.reason): r.n_files for r in A.broken_counts(run).collect()}["result.json", "cut_off"] == 1
    assert [r.id for r in A.results(run).collect()] == ["id-a__1"] and A.job_config(run).count() == 0
    rows = {r.trial_name: r for r in A.run_trials(run).collect()}
    assert len(rows) == 7 and {n for n, r in rows.items() if r.has_result} == {"a__0"}
    assert {n: r.broken for n, r in rows.items()} == {"a__0": 0, "a__1": 2, "a__2": 3, "a__3": 2, "a__4": 1, "a__5": 1, "a__6": 0}
    assert (rows["a__2"].task_name, rows["a__2"].model_name, rows["a__1"].model_name) == ("a", None, "m")
    assert rows["a__4"].iterations is None and rows["a__0"].iterations == 3


def test_recorded_exception_counts_without_a_file(spark, tmp_path):
    root = str(tmp_path / "run")
    put(f"{root}/a__1/config.json", '{"trial_name": "a__1"}')
    put(f"{root}/a__1/result.json", json.dumps({**result("a__1", None), "exception_info": {"exception_type": "x.AgentTimeoutError"}}))
    (row,) = A.run_trials(A.RunFolder(spark, root)).collect()
    assert row.exc_type == "AgentTimeoutError" and row.outcome == "agent_timeout" and "exception_type" in row.exception_info


def test_a_folder_is_listed_once_and_only_what_is_asked_for_is_opened(spark, root, monkeypatch):
    listed = []
    real = A.file_tree
    monkeypatch.setattr(A, "file_tree", lambda *a: (listed.append(a), real(*a))[1])
    run = A.RunFolder(spark, root)
    A.run_trials(run).collect(), run.presence().collect(), A.broken(run).collect(), A.trial_logs(run).collect()
    assert len(listed) == 1
    frame = run.bodies(A.RESULT)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 3


def test_sync_reads_only_what_changed(spark, tmp_path):
    root = ruined(str(tmp_path / "run"))
    run = A.SyncedRun(spark, root, str(tmp_path / "synced"))
    files = sum(len(f) for _, _, f in os.walk(root))
    assert run.sync() == {"read": files, "gone": 0} and run.sync() == {"read": 0, "gone": 0}
    plain = lambda r: sorted(map(tuple, A.run_trials(r).select("trial_name", "has_result", "reward", "broken", "outcome").collect()))
    assert plain(run) == plain(A.RunFolder(spark, root))
    put(f"{root}/a__1/result.json", json.dumps(result("a__1", 0.0)))
    put(f"{root}/b__1/config.json", "{}")
    os.remove(f"{root}/a__0/result.json")
    assert run.sync() == {"read": 2, "gone": 1}
    assert plain(run) == plain(A.RunFolder(spark, root)) and A.results(run).count() == 1
    old = os.stat(f"{root}/a__3/config.json").st_mtime - 5000
    put(f"{root}/c__1/config.json", "{}")
    os.utime(f"{root}/c__1/config.json", (old, old))  # copied with its time
    put(f"{root}/a__0/result.json", json.dumps(result("a__0", 0.0)))
    assert run.sync() == {"read": 2, "gone": 0}
    assert plain(run) == plain(A.RunFolder(spark, root)) and A.results(run).count() == 2
    assert sorted(map(tuple, run.presence().collect())) == sorted(map(tuple, A.RunFolder(spark, root).presence().collect()))
    assert A.job_log(run).count() == 0 and A.job_log(A.RunFolder(spark, root)).count() == 0


def test_packed_rows_are_not_sorted_by_kind(spark, tmp_path):
    """Tasks may keep a file open for each kind, so that no task sorts all its bodies; the setting ends with the write."""
    from pyspark import TaskContext

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    seen = F.udf(lambda _: TaskContext.get().getLocalProperty(setting) or "0", "string")
    kinds = [*A.TRIAL_FILES, f"{A.JOB}{A.CONFIG}", f"{A.JOB}{A.JOB_LOG}"]
    rows = spark.range(3 * len(kinds), numPartitions=1).select(
        F.col("id").cast("string").alias("trial_name"),
        F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("id") % len(kinds) + 1).cast("int")).alias("file"),
        F.concat(F.col("id").cast("string"), F.lit(":"), seen("id")).alias("body"))
    before = spark.conf.get(setting)
    A.write_packed(rows, str(tmp_path / "packed"))
    assert spark.conf.get(setting) == before
    run = A.PackedRun(spark, str(tmp_path / "packed"))
    for k, name in enumerate(kinds):
        got = {tuple(r) for r in run.bodies(name).collect()}
        assert {(n, b.split(":")[0]) for n, b in got} == {(str(i), str(i)) for i in range(k, 3 * len(kinds), len(kinds))}
        assert all(int(b.split(":")[1]) >= len(kinds) for _, b in got)
