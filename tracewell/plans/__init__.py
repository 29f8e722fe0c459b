"""Checked queries, grouped by subject."""

from __future__ import annotations

import importlib

from tracewell.plans.catalog import ORACLES, QUERIES

SUBJECTS = (
    "training_data", "agent_runs", "benchmark_trials", "names_and_lines", "run_files", "run_folders", "live_runs",
)


def _load() -> None:
    for subject in SUBJECTS:
        importlib.import_module(f"tracewell.plans.{subject}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
