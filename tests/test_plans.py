"""What the plans must look like, whatever the data."""

import os

import pytest

from tracewell.operators import conversations as C
from tracewell.operators import training_log, trials
from tracewell.operators.blocks import ordered
from tracewell.plans import all_queries as queries
from tracewell.plans import views as V

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

USER_CODE = {"udf_row_function", "udf_batched_formatter", "udf_tokenizer", "udf_reward",
             "udf_truncate", "udf_render"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    has_python = any(w in plan for w in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas"))
    assert has_python == (name in USER_CODE)


def test_flagship_shuffles_turns_once(spark):
    plan = plan_of(C.format_conversations(V.noisy_conversations(spark, SF)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Window" not in plan


def test_limit_is_a_pushed_filter(spark):
    turns = V.table(spark, SF, "conversations")
    plan = plan_of(C.first_conversations(turns, 5).filter("role = 'user'"))
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


def test_cheap_questions_do_not_read_text_twice(spark):
    plan = plan_of(C.drop_report(V.table(spark, SF, "conversations")))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_spans_read_and_shuffle_once(spark):
    plan = plan_of(C.response_spans(V.noisy_conversations(spark, SF)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_top_per_group_is_cut_before_the_shuffle(spark):
    saved = V.loss_log(spark, SF).select("run_id", "step")
    plan = plan_of(training_log.newest_checkpoints(saved, 3))
    assert "WindowGroupLimit" in plan


def test_nothing_hot_means_a_plain_window(spark):
    events = V.table(spark, SF, "events")
    plan = plan_of(ordered(events, ["user_id"], ["event_id"]).number("n").rows())
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_hot_groups_are_windows_over_blocks(spark):
    events = V.table(spark, SF, "events")
    groups = ordered(events, ["event_type"], ["event_id"], floor=10)
    plan = plan_of(groups.number("n").rows())
    windows = [l for l in plan.splitlines() if "Window [row_number()" in l]
    assert windows and all("_block" in l.split("windowspecdefinition(")[1] for l in windows)


def test_distinct_tasks_need_no_distinct(spark):
    rated = trials.trial_table(V.trials(spark, SF), "trial_id", V.rewards(spark, SF))
    assert "Expand" not in plan_of(trials.success_rates(rated))


def test_packed_scan_reads_one_kind(spark, tmp_path):
    from tracewell.sources import artifacts as A

    rows = spark.createDataFrame(
        [("t", "1", A.REWARD), ("t", "{}", A.RESULT)], "trial_name string, body string, file string")
    A.write_packed(rows, str(tmp_path / "p"))
    plan = plan_of(A.rewards(A.PackedRun(spark, str(tmp_path / "p"))))
    assert "PartitionFilters: [isnotnull(file" in plan
