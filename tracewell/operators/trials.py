"""Benchmark trials: assemble, classify, compare, count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.text import micros
from tracewell.operators.blocks import ordered
from tracewell.operators.quantiles import exact_quantiles

# Exception classes and outcome names.
AGENT_TIMEOUT = "AgentTimeoutError"
VERIFIER_TIMEOUT = "VerifierTimeoutError"
VERIFIER_TIMEOUT_TEXT = "Verifier execution timed out"
OUTCOMES = ("pass", "fail", "agent_timeout", "verifier_timeout", "no_result")
EXCLUDED_EXCEPTIONS = (
    "RewardFileNotFoundError",
    "RewardFileEmptyError",
    "VerifierTimeoutError",
    "AgentTimeoutError",
    "VerifierOutputParseError",
)


# --- assembly ----------------------------------------------------------------


def test_rollup(tests: DataFrame, key: str = "trial_id") -> DataFrame:
    """Tests, passes, partial credit and all-passed flag per trial."""
    passed = F.count_if(F.col("status") == "passed")
    return tests.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_tests"),
        passed.alias("n_tests_passed"),
        (passed / F.count(F.lit(1))).alias("partial_credit"),
        (passed == F.count(F.lit(1))).alias("all_passed"),
    )


def trial_table(spine: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """One row per planned trial; each part holds at most one row per key and may lack
    any of them."""
    for part in parts:
        spine = spine.join(part, key, "left")
    return spine


def outcome(reward: Column, exc_type: Column, failure: Column) -> Column:
    """A pass beats a late exception. A verifier that timed out left no verdict, whatever
    the agent did before; an agent timeout explains the zero reward that follows it."""
    return (
        F.when(reward >= 1, "pass")
        .when(
            (exc_type == VERIFIER_TIMEOUT) | F.startswith(failure, F.lit(VERIFIER_TIMEOUT_TEXT)),
            "verifier_timeout",
        )
        .when(exc_type == AGENT_TIMEOUT, "agent_timeout")
        .when(reward.isNotNull(), "fail")
        .otherwise("no_result")
    )


def outcome_counts(trials: DataFrame) -> DataFrame:
    return trials.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_trials"))


def without_result(configs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    return configs.join(results.select(key), key, "left_anti")


def select_tasks(
    trials: DataFrame,
    include: Sequence[str] | DataFrame | None = None,
    exclude: Sequence[str] | DataFrame | None = None,
    task: str = "task_name",
) -> DataFrame:
    """Task filter; a null list filters nothing, long lists may be given as tables."""
    for names, how in ((include, "left_semi"), (exclude, "left_anti")):
        if names is None:
            continue
        if isinstance(names, DataFrame):
            trials = trials.join(names.select(task), task, how)
        else:
            hit = F.col(task).isin(*names)
            trials = trials.filter(hit if how == "left_semi" else ~hit)
    return trials


# --- success -------------------------------------------------------------------


def task_summary(trials: DataFrame, by: Sequence[str] = ("task_name",)) -> DataFrame:
    """Attempts, rewarded attempts, passes, any pass, and the mean reward over rewarded
    attempts and over all of them (missing counts as 0)."""
    passed = F.col("reward") >= 1
    return trials.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count("reward").alias("n_rewarded"),
        F.count_if(passed).alias("n_passes"),
        (F.count_if(passed) > 0).alias("solved"),
        F.avg("reward").alias("mean_reward"),
        F.avg(F.coalesce(F.col("reward").cast("double"), F.lit(0.0))).alias("mean_with_missing"),
    )


def success_rates(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Success with every denominator named. Trials are folded per task first, so distinct
    tasks need no distinct aggregate."""
    tasks = task_summary(trials, [*by, "task_name"])
    n_tasks = F.count(F.lit(1))
    passes = F.sum("n_passes")
    return tasks.groupBy(*by).agg(
        F.sum("n_attempts").alias("n_trials"),
        F.sum("n_rewarded").alias("n_rewarded"),
        n_tasks.alias("n_tasks"),
        passes.alias("n_passes"),
        F.count_if("solved").alias("n_tasks_solved"),
        (passes / F.sum("n_attempts")).alias("passes_per_trial"),
        (passes / F.nullif(F.sum("n_rewarded"), F.lit(0))).alias("passes_per_rewarded_trial"),
        (passes / n_tasks).alias("passes_per_task"),
        (F.count_if("solved") / n_tasks).alias("solved_tasks_per_task"),
        F.avg("mean_with_missing").alias("mean_task_reward"),
    )


def pass_at(n: Column, c: Column, k: int) -> Column:
    """Unbiased pass@k: 1 - C(n-c, k) / C(n, k), as a product of k factors."""
    missed = F.aggregate(
        F.sequence(F.lit(0), F.lit(k - 1)),
        F.lit(1.0),
        lambda product, i: product * ((n - c - i) / (n - i)),
    )
    return (
        F.when(n < k, F.lit(None).cast("double"))
        .when(c == 0, F.lit(0.0))
        .when(n - c < k, F.lit(1.0))
        .otherwise(F.lit(1.0) - missed)
    )


def pass_at_k(tasks: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean pass@k over the tasks with at least k attempts; ``tasks`` from task_summary."""
    scored = tasks.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).cast("long").alias("k"),
                        pass_at(F.col("n_attempts"), F.col("n_passes"), k).alias("score"),
                    )
                    for k in ks
                ]
            )
        ).alias("s")
    ).select("s.*")
    return scored.groupBy("k").agg(
        F.count("score").alias("n_tasks"), F.avg("score").alias("pass_at_k")
    )


def number_attempts(trials: DataFrame, **cutting) -> DataFrame:
    """1-based attempt number within a task, by start time then trial id."""
    tasks = ordered(trials, ["task_name"], ["started_at", "trial_id"], **cutting)
    return tasks.number("attempt_no").rows()


def missing_attempts(trials: DataFrame, planned: DataFrame, n_attempts: int) -> DataFrame:
    """Planned (task, attempt) pairs that never ran. Attempts are numbered without gaps,
    so a count per task says which numbers are missing."""
    ran = trials.groupBy("task_name").agg(F.count(F.lit(1)).alias("n"))
    done = F.coalesce("n", F.lit(0))
    return (
        planned.select("task_name").distinct().join(ran, "task_name", "left")
        .filter(done < n_attempts)
        .select("task_name", F.explode(F.sequence(done + 1, F.lit(n_attempts).cast("long")))
                .alias("attempt_no"))
    )


# --- comparison -----------------------------------------------------------------


def stack_runs(**runs: DataFrame) -> DataFrame:
    """Rows of several runs under a ``run_id``; missing columns become null."""
    out = None
    for name, df in runs.items():
        df = df.withColumn("run_id", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def compare_runs(stacked: DataFrame, before: str, after: str) -> DataFrame:
    """Per task: gained, lost, both or neither, from one grouping of the stacked runs (no
    join); a task seen in only one run has a null on the other side."""

    def side(run: str, value: Column) -> Column:
        return F.max(F.when(F.col("run_id") == run, value))

    solved = F.coalesce(F.col("reward"), F.lit(0)) >= 1
    tasks = (
        stacked.filter(F.col("run_id").isin(before, after))
        .groupBy("task_name")
        .agg(side(before, solved).alias("solved_before"), side(after, solved).alias("solved_after"))
    )
    was = F.coalesce("solved_before", F.lit(False))
    now = F.coalesce("solved_after", F.lit(False))
    change = (
        F.when(was & now, "both").when(now, "gained").when(was, "lost").otherwise("neither")
    )
    return tasks.withColumn("change", change)


def uplift(before: Column, after: Column) -> tuple[Column, Column]:
    """Ratio (null when there was nothing before) and difference."""
    return after / F.nullif(before, F.lit(0)), after - before


def run_uplift(stacked: DataFrame, before: str, after: str) -> DataFrame:
    def rate(run: str) -> Column:
        mine = F.col("run_id") == run
        return F.count_if(mine & (F.col("reward") >= 1)) / F.nullif(F.count_if(mine), F.lit(0))

    rates = stacked.agg(rate(before).alias("rate_before"), rate(after).alias("rate_after"))
    ratio, difference = uplift(F.col("rate_before"), F.col("rate_after"))
    return rates.withColumns({"ratio": ratio, "difference": difference})


# --- retries and consistency -------------------------------------------------------


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = 0
    include: tuple[str, ...] | None = None
    exclude: tuple[str, ...] = EXCLUDED_EXCEPTIONS


def retry_decision(exc_type: Column, retries_used: Column, policy: RetryPolicy) -> Column:
    """Excluded classes are never retried; a null include list includes everything."""
    wanted = F.lit(True) if policy.include is None else exc_type.isin(*policy.include)
    return (
        F.when(exc_type.isNull(), "no_exception")
        .when(exc_type.isin(*policy.exclude), "excluded")
        .when(~wanted, "not_included")
        .when(retries_used >= policy.max_retries, "no_retries_left")
        .otherwise("retry")
    )


def reconcile(pairs: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Flags telling which recorded values agree, nulls included."""
    return {name: a.eqNullSafe(b) for name, (a, b) in pairs.items()}


# --- failure patterns, phases, totals ----------------------------------------------


def failure_patterns(rows: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    return (
        rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *by).limit(limit)
    )


def unpivot_phases(trials: DataFrame, phases: dict[str, Column]) -> DataFrame:
    """One row per trial and phase, with its length in microseconds."""
    return trials.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("phase"), c.cast("long").alias("us"))
                    for n, c in phases.items()
                ]
            )
        ).alias("p")
    ).select("p.*")


def number_stats(
    df: DataFrame, keys: Sequence[str], value: str, scale: float = 1.0, **cutting
) -> DataFrame:
    """Count, mean, exact median, minimum and maximum per key."""
    medians = exact_quantiles(df, keys, value, {"median": 0.5}, **cutting)
    plain = df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    joined = plain.join(medians, list(keys), "left")
    numbers = {c: F.col(c) / F.lit(scale) for c in ("mean", "median", "min", "max")}
    return joined.select(*keys, "n", *[v.alias(c) for c, v in numbers.items()])


def failed_turns(iterations: Column, conversation_length: Column) -> Column:
    """Turns whose model call failed: each adds one message instead of two."""
    return 2 * iterations + 1 - conversation_length


def token_totals(trials: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sums with the number of known values, so unknown is not read as zero."""
    aggs = [F.count(F.lit(1)).alias("n_trials")]
    for c in columns:
        aggs += [F.sum(c).alias(f"{c}_total"), F.count(c).alias(f"{c}_known")]
    return trials.groupBy(*by).agg(*aggs)


def artifact_coverage(presence: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many trials have which set of files."""
    shape = F.concat_ws("+", *[F.when(F.col(f), f) for f in flags])
    return presence.groupBy(shape.alias("files")).agg(F.count(F.lit(1)).alias("n_trials"))


def coverage_of_files(presence: DataFrame) -> DataFrame:
    """The same from one row per trial and file; a trial has a handful of files."""
    shapes = presence.groupBy("trial_name").agg(F.sort_array(F.collect_set("file")).alias("f"))
    return shapes.groupBy(F.array_join("f", "+").alias("files")).agg(
        F.count(F.lit(1)).alias("n_trials")
    )


def metric_registry(trials: DataFrame, metrics: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """All named aggregates in one pass."""
    return trials.groupBy(*by).agg(*[c.alias(n) for n, c in metrics.items()])


def hardest_tasks(trials: DataFrame, n: int) -> DataFrame:
    """Lowest mean reward first, then slowest."""
    return (
        trials.groupBy("task_name")
        .agg(
            F.count(F.lit(1)).alias("n_attempts"),
            F.avg(F.coalesce(F.col("reward"), F.lit(0)).cast("double")).alias("mean_reward"),
            F.avg("duration_us").alias("mean_us"),
        )
        .orderBy("mean_reward", F.desc("mean_us"), "task_name")
        .limit(n)
    )


# --- time ---------------------------------------------------------------------------


def _changes(trials: DataFrame, by: Sequence[str], start: Column, stop: Column) -> DataFrame:
    """Net change of running trials per instant; ends and starts of one instant cancel."""
    steps = trials.select(
        *by,
        F.explode(
            F.array(
                F.struct(start.alias("us"), F.lit(1).cast("long").alias("d")),
                F.struct(stop.alias("us"), F.lit(-1).cast("long").alias("d")),
            )
        ).alias("e"),
    ).select(*by, "e.us", "e.d")
    return steps.groupBy(*by, "us").agg(F.sum("d").alias("change"))


def concurrency(
    trials: DataFrame, by: Sequence[str], start: Column, stop: Column, **cutting
) -> DataFrame:
    """Number of running trials after every change."""
    changes = ordered(_changes(trials, by, start, stop), by, ["us"], **cutting)
    counted = changes.running(n_running=(F.col("change"), "sum")).rows()
    return counted.select(*by, "us", "n_running")


def peak_concurrency(
    trials: DataFrame, by: Sequence[str], start: Column, stop: Column,
    configured: int | None = None, **cutting,
) -> DataFrame:
    """Highest number of trials at once, when it was first reached, and the span."""
    timeline = concurrency(trials, by, start, stop, **cutting)
    # The earliest instant of the highest value: both in one ordered struct.
    best = F.max(F.struct("n_running", (-F.col("us")).alias("neg_us")))
    peaks = timeline.groupBy(*by).agg(
        best.alias("b"), F.min("us").alias("first_us"), F.max("us").alias("last_us")
    ).select(
        *by, F.col("b.n_running").alias("peak"), (-F.col("b.neg_us")).alias("peak_us"),
        "first_us", "last_us",
    )
    if configured is None:
        return peaks
    return peaks.withColumn("over_configured", F.col("peak") > configured)


def throughput(trials: DataFrame, finished: Column, width: str = "10 minutes") -> DataFrame:
    return (
        trials.groupBy(F.window(finished, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_finished"))
        .select(F.col("w.start").alias("bucket_start"), "n_finished")
    )
