"""SQL functions against the same rules as DataFrame expressions."""

import random

import pytest
from pyspark.sql import functions as F

from tracewell.functions import sql, text
from tracewell.functions.fences import with_commands
from tracewell.operators import trajectories as J


@pytest.fixture
def replies(spark):
    rng = random.Random(4)
    parts = ["```bash", " ```sh -x", "```", "``` \x1c", "ls", "", "a\\b 'q'", "task complete", "TASK", "\u2003", "é"]
    rows = [(k, 0, "\n".join(rng.choice(parts) for _ in range(rng.randint(0, 12))), rng.choice([None, None, "refused"])) for k in range(300)]
    rows += [(900, 0, None, None), (901, 0, "", None), (902, 0, "```bash\n" + "x" * 200_000 + "\n```", None)]
    rows += [(903, 0, "```bash\nls\n```", None), (903, 0, "```bash\nls\n```", None)]
    sql.register(spark)
    sql.register(spark)
    df = spark.createDataFrame(rows, "trial_id long, iteration long, reply string, error string")
    df.createOrReplaceTempView("replies_of_sql_test")
    return df


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_text_rules(spark, replies):
    reply = F.col("reply")
    want = with_commands(replies).select(
        "trial_id", text.py_strip(reply), text.is_blank(reply), text.signals_completion(reply), "commands")
    got = spark.sql("""SELECT trial_id, py_strip(reply), is_blank(reply), signals_completion(reply), fenced_commands(reply)
                       FROM replies_of_sql_test""")
    assert rows_of(got) == rows_of(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_turn_class(spark, replies):
    want = J.classify_turns(replies).select("trial_id", "turn_class")
    got = spark.sql("SELECT trial_id, turn_class(reply, error) AS turn_class FROM replies_of_sql_test")
    assert rows_of(got) == rows_of(want)


def test_commands_as_a_table(spark, replies):
    want = with_commands(replies).select("trial_id", F.posexplode("commands").alias("at", "cmd")).select(
        "trial_id", (F.col("at") + 1).cast("long"), "cmd")
    got = spark.sql("SELECT r.trial_id, c.cmd_idx, c.cmd FROM replies_of_sql_test r, LATERAL bash_commands(r.reply) c")
    assert rows_of(got) == rows_of(want) and got.schema["cmd_idx"].dataType.simpleString() == "bigint"
    assert spark.sql("SELECT * FROM bash_commands(NULL)").count() == 0
