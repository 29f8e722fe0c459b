"""Explicit schemas of every source; nothing is inferred, since fields that happen to be
null in all files would get a wrong type."""

from __future__ import annotations

CONVERSATIONS = (
    "conv_id BIGINT, conversations ARRAY<STRUCT<role: STRING, `from`: STRING, content: STRING>>"
)
TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
LOSS_LOG = "run_id BIGINT, step BIGINT, loss DOUBLE"

_PHASE = "STRUCT<started_at: STRING, finished_at: STRING>"
_AGENT = (
    "STRUCT<name: STRING, import_path: STRING, model_name: STRING, override_timeout_sec: DOUBLE, "
    "override_setup_timeout_sec: DOUBLE, max_timeout_sec: DOUBLE, kwargs: MAP<STRING, STRING>>"
)
_ENVIRONMENT = (
    "STRUCT<type: STRING, import_path: STRING, force_build: BOOLEAN, `delete`: BOOLEAN, "
    "override_cpus: BIGINT, override_memory_mb: BIGINT, override_storage_mb: BIGINT, "
    "override_gpus: BIGINT, kwargs: MAP<STRING, STRING>>"
)
_VERIFIER = (
    "STRUCT<override_timeout_sec: DOUBLE, max_timeout_sec: DOUBLE, `disable`: BOOLEAN>"
)
_TASK = (
    "STRUCT<path: STRING, git_url: STRING, git_commit_id: STRING, overwrite: BOOLEAN, "
    "download_dir: STRING, source: STRING>"
)
_RETRY = (
    "STRUCT<max_retries: INT, include_exceptions: ARRAY<STRING>, "
    "exclude_exceptions: ARRAY<STRING>, wait_multiplier: DOUBLE, min_wait_sec: DOUBLE, "
    "max_wait_sec: DOUBLE>"
)

TRIAL_CONFIG = (
    f"task {_TASK}, trial_name STRING, trials_dir STRING, timeout_multiplier DOUBLE, "
    f"agent {_AGENT}, environment {_ENVIRONMENT}, verifier {_VERIFIER}, job_id STRING"
)
JOB_CONFIG = (
    "job_name STRING, jobs_dir STRING, n_attempts INT, timeout_multiplier DOUBLE, debug BOOLEAN, "
    "orchestrator STRUCT<type: STRING, n_concurrent_trials: INT, quiet: BOOLEAN, "
    f"retry: {_RETRY}, kwargs: MAP<STRING, STRING>>, environment {_ENVIRONMENT}, "
    f"verifier {_VERIFIER}, metrics ARRAY<STRING>, agents ARRAY<{_AGENT}>, "
    "datasets ARRAY<STRUCT<task_names: ARRAY<STRING>, exclude_task_names: ARRAY<STRING>, "
    "registry: STRUCT<name: STRING, url: STRING>, name: STRING, version: STRING, "
    "overwrite: BOOLEAN, download_dir: STRING>>, tasks ARRAY<STRING>"
)
_CONFIG_STRUCT = (
    f"STRUCT<task: {_TASK}, trial_name: STRING, trials_dir: STRING, timeout_multiplier: DOUBLE, "
    f"agent: {_AGENT}, environment: {_ENVIRONMENT}, verifier: {_VERIFIER}, job_id: STRING>"
)
TRIAL_RESULT = (
    "id STRING, task_name STRING, trial_name STRING, trial_uri STRING, "
    "task_id STRUCT<git_url: STRING, git_commit_id: STRING, path: STRING>, "
    f"source STRING, task_checksum STRING, config {_CONFIG_STRUCT}, "
    "agent_info STRUCT<name: STRING, version: STRING, model_info: STRING>, "
    "agent_result STRUCT<n_input_tokens: BIGINT, n_cache_tokens: BIGINT, n_output_tokens: BIGINT, "
    "cost_usd: DOUBLE, rollout_details: STRING, metadata: STRUCT<iterations: BIGINT, "
    "conversation_length: BIGINT, status: STRING, task_complete_signal: BOOLEAN>>, "
    "verifier_result STRUCT<rewards: MAP<STRING, DOUBLE>>, exception_info STRING, "
    "started_at STRING, finished_at STRING, "
    f"environment_setup {_PHASE}, agent_setup {_PHASE}, agent_execution {_PHASE}, verifier {_PHASE}"
)
TEST_REPORT = (
    "results STRUCT<tool: STRUCT<name: STRING, version: STRING>, "
    "summary: STRUCT<tests: INT, passed: INT, failed: INT, skipped: INT, pending: INT, other: INT, "
    "start: DOUBLE, stop: DOUBLE>, "
    "tests: ARRAY<STRUCT<name: STRING, status: STRING, raw_status: STRING, duration: DOUBLE, "
    "start: DOUBLE, stop: DOUBLE, retries: INT, file_path: STRING, trace: STRING, "
    "message: STRING, tags: ARRAY<STRING>>>>"
)
