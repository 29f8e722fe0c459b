"""Agent trajectories: classify turns, collect commands, rebuild conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions import templates as T
from tracewell.functions.fences import with_commands
from tracewell.functions.text import py_strip, signals_completion
from tracewell.operators.blocks import join_by, ordered

# Final states of a trajectory.
WITH_SIGNAL, WITHOUT_SIGNAL = "completed_with_signal", "completed"


def until_complete(replies: DataFrame) -> DataFrame:
    """The turns of each trial up to its first completion signal, which ends the loop."""
    done = (
        replies.filter(signals_completion(F.col("reply")))
        .groupBy("trial_id").agg(F.min("iteration").alias("_done_at"))
    )
    return join_by(replies, done, ["trial_id"]).filter(
        F.col("_done_at").isNull() | (F.col("iteration") <= F.col("_done_at"))
    ).drop("_done_at")


def classify_turns(replies: DataFrame) -> DataFrame:
    """Turns up to the first completion, with ``commands``, ``n_commands`` and ``turn_class``.

    A null reply is a failed model call. The completion signal comes next, so commands inside a
    completing reply are not run. A set ``error`` with a reply is a run that broke off: the reply
    counts, its commands' output does not.
    """
    error = F.col("error").isNotNull() if "error" in replies.columns else F.lit(False)
    kind = (
        F.when(F.col("reply").isNull(), "error")
        .when(signals_completion(F.col("reply")), "complete")
        .when(error, "error")
        .when(F.size("commands") == 0, "no_command")
        .otherwise("execute")
    )
    return with_commands(until_complete(replies)).withColumns(
        {"turn_class": kind, "n_commands": F.size("commands").cast("long")}
    )


def command_rows(replies: DataFrame) -> DataFrame:
    """One row per executed command, numbered from 1 within its reply."""
    run = classify_turns(replies).filter(F.col("turn_class") == "execute")
    others = [c for c in replies.columns if c != "reply"]
    return run.select(*others, F.posexplode("commands").alias("_at", "cmd")).select(
        *others, (F.col("_at") + 1).cast("long").alias("cmd_idx"), "cmd"
    )


def trial_status(replies: DataFrame) -> DataFrame:
    """Iterations, message count, completion signal and final status per trial."""
    kinds = classify_turns(replies)
    totals = kinds.groupBy("trial_id").agg(
        F.max("iteration").cast("long").alias("iterations"),
        F.count(F.lit(1)).alias("_turns"),
        F.count_if(F.col("turn_class") == "complete").alias("_done"),
        F.count_if(F.col("reply").isNull()).alias("_unanswered"),
    )
    signal = F.col("_done") > 0
    # Two seed messages; a turn adds a reply and what is said to it. A completing turn adds only
    # the reply, a failed model call only the note.
    length = 2 + 2 * F.col("_turns") - F.col("_done") - F.col("_unanswered")
    return totals.select(
        "trial_id",
        "iterations",
        length.alias("conversation_length"),
        signal.alias("task_complete_signal"),
        F.when(signal, WITH_SIGNAL).otherwise(WITHOUT_SIGNAL).alias("status"),
    )


def command_stats(replies: DataFrame, executions: DataFrame | None = None) -> DataFrame:
    """Commands per trial and per iteration; with executions also the failing share."""
    kinds = classify_turns(replies)
    ran = F.when(F.col("turn_class") == "execute", F.col("n_commands")).otherwise(0)
    stats = kinds.groupBy("trial_id").agg(
        F.count(F.lit(1)).alias("n_iterations"),
        F.sum(ran).alias("n_commands"),
        F.avg(ran).alias("commands_per_iteration"),
        F.max(ran).alias("max_commands"),
    )
    return stats if executions is None else stats.join(exit_stats(executions), "trial_id", "left")


def exit_stats(executions: DataFrame) -> DataFrame:
    failing = F.col("return_code") != 0
    return executions.groupBy("trial_id").agg(
        F.count(F.lit(1)).alias("n_executed"),
        F.count_if(failing).alias("n_failing"),
        F.avg(failing.cast("double")).alias("failing_share"),
    )


def with_feedback(executions: DataFrame, number: str = "cmd_idx") -> DataFrame:
    """Add the feedback text of each command."""
    return executions.withColumn(
        "feedback",
        T.command_feedback(
            F.col(number), F.col("cmd"), F.col("return_code"), F.col("stdout"), F.col("stderr")
        ),
    )


def iteration_feedback(executions: DataFrame) -> DataFrame:
    """One message per iteration: its commands' feedback in order plus the fixed tail."""
    shown = with_feedback(executions).select(
        "trial_id", "iteration", F.struct("cmd_idx", "feedback").alias("f")
    )
    return (
        shown.groupBy("trial_id", "iteration")
        .agg(F.sort_array(F.collect_list("f")).alias("fs"))
        .select(
            "trial_id", "iteration",
            F.concat(
                F.array_join(F.transform("fs", lambda f: f["feedback"]), T.FEEDBACK_SEPARATOR),
                F.lit(T.FEEDBACK_TAIL),
            ).alias("content"),
        )
    )


def trajectory_messages(
    seeds: DataFrame, replies: DataFrame, executions: DataFrame, **cutting
) -> DataFrame:
    """Rebuild the conversation of every trial: ``trial_id, msg_idx, role, content``.

    ``seeds`` holds ``trial_id, system_prompt, instruction``; ``replies`` holds
    ``trial_id, iteration, reply, error``: the reply is null when the model call failed, and
    both are set when running the commands failed. ``executions`` holds the commands that were run.
    Each reply is classified once; output counts only for turns that ran to their end.
    """
    seed_rows = seeds.select(
        "trial_id",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit("system").alias("role"),
                         F.col("system_prompt").alias("content")),
                F.struct(F.lit(1).alias("part"), F.lit("user").alias("role"),
                         F.col("instruction").alias("content")),
            )
        ).alias("m"),
    ).select("trial_id", F.lit(0).cast("long").alias("iteration"), "m.*")
    error = F.col("error") if "error" in replies.columns else F.lit("")
    note = F.when(F.col("turn_class") == "no_command", F.lit(T.NO_COMMAND_TEXT)).when(
        F.col("turn_class") == "error", T.error_text(F.coalesce(error, F.lit("")))
    )
    iteration = F.col("iteration").cast("long")
    said = iteration_feedback(executions).select("trial_id", iteration.alias("iteration"), "content")
    turns = join_by(
        classify_turns(replies).select(
            "trial_id", iteration.alias("iteration"), "reply", "turn_class", note.alias("note")),
        said, ["trial_id", "iteration"],
    )
    answer = F.coalesce("note", F.when(F.col("turn_class") == "execute", F.col("content")))
    turn_rows = turns.select(
        "trial_id", "iteration",
        F.explode(F.array(
            F.struct(F.lit(2).alias("part"), F.lit("assistant").alias("role"), F.col("reply").alias("content")),
            F.struct(F.lit(3).alias("part"), F.lit("user").alias("role"), answer.alias("content")),
        )).alias("m"),
    ).select("trial_id", "iteration", "m.*").filter(F.col("content").isNotNull())
    rows = seed_rows.unionByName(turn_rows)
    trials = ordered(rows, ["trial_id"], ["iteration", "part"], **cutting)
    return trials.number("_nth").rows().select(
        "trial_id", (F.col("_nth") - 1).alias("msg_idx"), "role", "content"
    )


def messages_as_turns(messages: DataFrame) -> DataFrame:
    """Rebuilt conversations in the flat shape the training-data operators read."""
    return messages.select(
        F.col("trial_id").alias("conv_id"), F.col("msg_idx").alias("turn"), "role",
        F.col("content").alias("text"),
    )


def command_loops(
    executions: DataFrame, at_least: int, order: str = "cmd_seq", **cutting
) -> DataFrame:
    """Stretches of the same command in a row, ``at_least`` long."""
    start = F.when(F.col("_prev").isNull() | (F.col("_prev") != F.col("cmd")), F.col(order))
    trials = ordered(
        executions.select("trial_id", order, "cmd"), ["trial_id"], [order], **cutting
    )
    placed = trials.previous("cmd", "_prev").running(first_seq=(start, "max"))
    return (
        placed.rows().groupBy("trial_id", "first_seq")
        .agg(
            F.first("cmd").alias("cmd"),
            F.max(order).alias("last_seq"),
            F.count(F.lit(1)).alias("n_repeats"),
        )
        .filter(F.col("n_repeats") >= at_least)
    )


def directory_listing(
    files: DataFrame, env: str = "env", name: str = "name", limit: int = T.LISTING_LIMIT
) -> DataFrame:
    """Header and numbered first entries per environment; ``files`` may hold a null name
    for an empty directory. Counting and choosing both combine before the shuffle."""
    entry = F.when(F.col(name) != "", F.col(name))
    named = files.select(env, entry.alias("_name"))
    sizes = named.groupBy(env).agg(F.count("_name").alias("n"))
    order = Window.partitionBy(env).orderBy("_name")
    top = (
        named.filter(F.col("_name").isNotNull())
        .withColumn("_i", F.row_number().over(order))
        .filter(F.col("_i") <= limit)
        .groupBy(env)
        .agg(F.sort_array(F.collect_list(F.struct("_i", "_name"))).alias("top"))
    )
    n = F.col("n").cast("string")
    header = (
        F.when(F.col("n") == 0, T.EMPTY_DIRECTORY)
        .when(F.col("n") <= limit, T.fill(T.SHORT_DIRECTORY, n=n))
        .otherwise(T.fill(T.LONG_DIRECTORY, k=F.lit(limit), n=n))
    )
    lines = F.transform(
        "top", lambda e: F.concat(e["_i"].cast("string"), F.lit(". "), e["_name"])
    )
    return sizes.join(top, env, "left").select(
        env, "n", header.alias("header"),
        F.coalesce(F.array_join(lines, "\n"), F.lit("")).alias("listing"),
    )


def system_prompts(
    listings: DataFrame, directory: Column, template: str = T.SYSTEM_PROMPT
) -> DataFrame:
    """Fill the prompt template; a missing working directory becomes the default one."""
    shown = F.when(F.coalesce(directory, F.lit("")) != "", py_strip(directory)).otherwise(
        T.DEFAULT_DIRECTORY
    )
    return listings.withColumn(
        "system_prompt",
        T.fill(
            template,
            current_directory=shown,
            file_listing_header=F.col("header"),
            file_listing=F.col("listing"),
        ),
    )
