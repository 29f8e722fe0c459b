"""Names: agents, cache folders, trials, adapters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def agent_name(model_id: Column) -> Column:
    """Owner dropped, lower case, ``_`` to ``-``, first three dash fields."""
    short = F.element_at(F.split(model_id, "/"), -1)
    return F.substring_index(F.translate(F.lower(short), "_", "-"), "-", 3)


def cache_folder(repo_id: Column, kind: str = "datasets") -> Column:
    return F.concat(F.lit(f"{kind}--"), F.replace(repo_id, F.lit("/"), F.lit("--")))


TRIAL_NAME = r"^(.*)__([^_]+)$"


def trial_task(trial_name: Column) -> Column:
    task = F.regexp_extract(trial_name, TRIAL_NAME, 1)
    return F.when(F.rlike(trial_name, F.lit(TRIAL_NAME)), task)


def trial_suffix(trial_name: Column) -> Column:
    suffix = F.regexp_extract(trial_name, TRIAL_NAME, 2)
    return F.when(F.rlike(trial_name, F.lit(TRIAL_NAME)), suffix)


def name_path_pairs(mapping: Column) -> Column:
    """Map -> array of ``name=path``, ordered by name."""
    pairs = F.transform(
        F.map_entries(mapping), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.sort_array(pairs)
