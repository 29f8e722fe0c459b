import datetime as dt
from math import comb

import pytest
from pyspark.sql import functions as F

from tracewell.operators import registry, training_log, trials as B
from tracewell.operators.trajectories import (
    command_loops, directory_listing, messages_as_turns, system_prompts, trajectory_messages,
)
from tracewell.operators.conversations import format_conversations
from tracewell.functions import templates as T


def test_pass_at_k(spark):
    cases = [(n, c, k) for n in range(0, 9) for c in range(0, n + 1) for k in range(1, 10)]
    df = spark.createDataFrame(cases, "n long, c long, k int")
    for k in range(1, 10):
        rows = df.filter(F.col("k") == k).select("n", "c", B.pass_at(F.col("n"), F.col("c"), k).alias("p"))
        for n, c, p in rows.collect():
            if n < k:
                assert p is None
            else:
                assert p == pytest.approx(1 - comb(n - c, k) / comb(n, k))


def test_outcomes(spark):
    rows = [(1.0, "AgentTimeoutError", None), (None, "AgentTimeoutError", "Verifier execution timed out x"), (0.0, "AgentTimeoutError", None), (0.0, None, None),
            (None, None, "Verifier execution timed out after 900.0 seconds"),
            (None, "VerifierTimeoutError", None), (None, None, None), (None, None, "other")]
    df = spark.createDataFrame(rows, "r double, e string, f string")
    got = [r[0] for r in df.select(B.outcome(F.col("r"), F.col("e"), F.col("f"))).collect()]
    assert got == ["pass", "verifier_timeout", "agent_timeout", "fail", "verifier_timeout", "verifier_timeout",
                   "no_result", "no_result"]


def test_success_names_its_denominator(spark):
    rows = [("a", 1.0), ("a", 1.0), ("b", 0.0), ("c", None)]
    r = B.success_rates(spark.createDataFrame(rows, "task_name string, reward double")).first()
    assert (r.n_trials, r.n_rewarded, r.n_tasks, r.n_passes, r.n_tasks_solved) == (4, 3, 3, 2, 1)
    assert r.passes_per_trial == 0.5 and r.passes_per_task == pytest.approx(2 / 3)
    assert r.mean_task_reward == pytest.approx(1 / 3)


def test_missing_attempts(spark):
    ran = spark.createDataFrame([("a",), ("a",), ("b",)], "task_name string")
    planned = spark.createDataFrame([("a",), ("b",), ("c",)], "task_name string")
    rows = sorted(map(tuple, B.missing_attempts(ran, planned, 2).collect()))
    assert rows == [("b", 2), ("c", 1), ("c", 2)]


def test_compare_runs(spark):
    make = lambda rows: spark.createDataFrame(rows, "task_name string, reward double")
    runs = B.stack_runs(old=make([("a", 1.0), ("b", 0.0), ("c", 1.0), ("e", None)]),
                        new=make([("a", 1.0), ("b", 1.0), ("c", 0.0), ("d", 1.0)]))
    got = {r.task_name: (r.change, r.solved_before) for r in B.compare_runs(runs, "old", "new").collect()}
    assert got == {"a": ("both", True), "b": ("gained", False), "c": ("lost", True),
                   "d": ("gained", None), "e": ("neither", False)}
    up = B.run_uplift(runs, "old", "new").first()
    assert (up.rate_before, up.rate_after, up.ratio, up.difference) == (0.5, 0.75, 1.5, 0.25)


def test_retry(spark):
    df = spark.createDataFrame([("AgentTimeoutError", 0), ("OSError", 0), ("OSError", 1), (None, 0)],
                               "e string, n int")
    d = lambda p: [r[0] for r in df.select(B.retry_decision(F.col("e"), F.col("n"), p)).collect()]
    assert d(B.RetryPolicy(1)) == ["excluded", "retry", "no_retries_left", "no_exception"]
    assert d(B.RetryPolicy(1, include=("KeyError",)))[1] == "not_included"


@pytest.mark.parametrize("cut", [{}, {"floor": 0, "pieces": 3}])
def test_concurrency(spark, cut):
    spans = [(0, 10), (5, 12), (10, 20), (10, 10), (11, 13)]
    df = spark.createDataFrame(spans, "a long, b long")
    rows = B.concurrency(df, [], F.col("a"), F.col("b"), **cut).orderBy("us").collect()
    assert [(r.us, r.n_running) for r in rows] == [(0, 1), (5, 2), (10, 2), (11, 3), (12, 2), (13, 1), (20, 0)]
    peak = B.peak_concurrency(df, [], F.col("a"), F.col("b"), configured=2, **cut).first()
    assert (peak.peak, peak.peak_us, peak.first_us, peak.last_us, peak.over_configured) == (3, 11, 0, 20, True)


def test_attempts_with_cut_tasks(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 3 else "cold", start + dt.timedelta(seconds=i * 7 % 50)) for i in range(90)]
    df = spark.createDataFrame(rows, "trial_id long, task_name string, started_at timestamp_ntz")
    whole = sorted(map(tuple, B.number_attempts(df).collect()))
    cut = sorted(map(tuple, B.number_attempts(df, floor=0, pieces=5).collect()))
    assert whole == cut and max(r[3] for r in whole) == 60


def test_tokens_known_and_unknown(spark):
    df = spark.createDataFrame([(None,), (3,), (4,)], "tokens long")
    r = B.token_totals(df, ["tokens"]).first()
    assert (r.n_trials, r.tokens_total, r.tokens_known) == (3, 7, 2)


def test_early_stop(spark):
    log = spark.createDataFrame([(1, i, 1 / (i + 1)) for i in range(20)] + [(2, 0, 0.5), (2, 1, None)],
                                "run_id long, step long, loss double")
    rows = {r.run_id: r for r in training_log.early_stop(log).collect()}
    assert (rows[1].stop_step, rows[1].best_loss, rows[1].best_loss_to_stop) == (9, 0.05, 0.1)
    assert (rows[2].stop_step, rows[2].best_loss, rows[2].n_logged) == (None, 0.5, 1)
    assert training_log.trained_rows(log).groupBy("run_id").count().orderBy("run_id").collect() == [(1, 10), (2, 2)]
    for floor in (0, 3, 100):
        best = training_log.best_loss(log, floor=floor, pieces=4).filter("run_id = 1").orderBy("step").collect()
        assert [r.best_loss for r in best] == [1 / (i + 1) for i in range(20)]


def test_checkpoints(spark):
    df = spark.createDataFrame([(1, s) for s in range(0, 100, 10)] + [(2, 5)], "run_id long, step long")
    rows = training_log.newest_checkpoints(df, 2)
    assert sorted(map(tuple, rows.collect())) == [(1, 80), (1, 90), (2, 5)]


def test_advantage(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 1.0), ("b", 1.0)], "t string, reward double")
    got = sorted(r.advantage for r in training_log.group_advantage(df, ["t"], epsilon=0.0).collect())
    assert got == [-1.0, 0.0, 0.0, 1.0]


@pytest.mark.parametrize("cut", [{"floor": 0, "pieces": 4}, {"floor": 5, "pieces": 9}, {}])
def test_command_loops(spark, cut):
    cmds = "a a a b a a b b b b".split()
    df = spark.createDataFrame([(1, i, c) for i, c in enumerate(cmds)], "trial_id int, cmd_seq long, cmd string")
    rows = command_loops(df, 3, **cut).orderBy("first_seq").collect()
    assert [(r.cmd, r.first_seq, r.last_seq, r.n_repeats) for r in rows] == [("a", 0, 2, 3), ("b", 6, 9, 4)]


def test_listing(spark):
    rows = [("none", None)] + [("few", n) for n in "ba"] + [("many", f"f{i:02}") for i in range(12)]
    out = directory_listing(spark.createDataFrame(rows, "env string, name string"))
    got = {r.env: r for r in system_prompts(out, F.when(F.col("env") == "few", "/srv\n"), "{current_directory}:{file_listing_header}").collect()}
    assert got["none"].header == "Current directory is empty." and got["none"].listing == ""
    assert got["few"].header == "Files in current directory (2 files):" and got["few"].listing == "1. a\n2. b"
    assert got["many"].header == "Files in current directory (showing first 10 of 12):"
    assert got["many"].listing.endswith("10. f09")
    assert got["few"].system_prompt.startswith("/srv:") and got["none"].system_prompt.startswith("/app:")


@pytest.mark.parametrize("cut", [{"floor": 0, "pieces": 3}, {}])
def test_trajectory(spark, cut):
    seeds = spark.createDataFrame([(1, "S", "I")], "trial_id long, system_prompt string, instruction string")
    replies = spark.createDataFrame(
        [(1, 1, "hm", None), (1, 2, None, "down"), (1, 3, "```sh\nls\n```", None),
         (1, 4, "```sh\nls\nrm\n```", "gone"), (1, 5, "TASK COMPLETE", None), (1, 6, "later", None)],
        "trial_id long, iteration long, reply string, error string")
    ran = spark.createDataFrame([(1, 3, 1, "ls", 0, "x", ""), (1, 4, 1, "ls", 0, "part", "")],
                                "trial_id long, iteration long, cmd_idx long, cmd string, return_code int, stdout string, stderr string")
    messages = trajectory_messages(seeds, replies, ran, **cut)
    rows = messages.orderBy("msg_idx").collect()
    assert [r.msg_idx for r in rows] == list(range(10))
    assert [r.role for r in rows] == ["system", "user", "assistant", "user", "user", "assistant", "user",
                                      "assistant", "user", "assistant"]
    assert rows[8].content == "An error occurred: gone\nPlease try a different approach."
    assert rows[3].content == T.NO_COMMAND_TEXT
    assert rows[4].content == "An error occurred: down\nPlease try a different approach."
    assert rows[6].content == "Command 1: ls\nExit code: 0\nSTDOUT:\nx\n" + T.FEEDBACK_TAIL
    assert format_conversations(messages_as_turns(messages)).first().n_turns == 9


def test_models(spark):
    asked = spark.createDataFrame([("base",), ("a",), ("zz",)], "model_name string")
    known = spark.createDataFrame([({"a": "/w/a", "b": "/w/b"},)], "m map<string,string>")
    table = registry.explode_adapters(known, "m")
    got = {r.model_name: (r.target, r.resolved) for r in registry.resolve_models(asked, table, "base").collect()}
    assert got == {"base": ("base", "base"), "a": ("adapter", "/w/a"), "zz": ("unknown", None)}
