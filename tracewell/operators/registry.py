"""Adapter registry: which weights answer a request for a model name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def adapters_map(adapters: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in adapters.items() for x in pair]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def explode_adapters(df: DataFrame, column: str) -> DataFrame:
    """One row per adapter of a map column."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias("name", "path"))


def resolve_models(
    requests: DataFrame, adapters: DataFrame, base_model: str, model: str = "model_name"
) -> DataFrame:
    """Add ``target`` (base / adapter / unknown) and ``resolved``.

    ``adapters`` holds unique ``name``s with their ``path``. No broadcast is forced: the
    optimizer broadcasts the registry when its measured size allows.
    """
    known = adapters.select(F.col("name").alias(model), F.col("path").alias("_path"))
    joined = requests.join(known, model, "left")
    is_base = F.col(model) == base_model
    return joined.withColumns(
        {
            "target": F.when(is_base, "base")
            .when(F.col("_path").isNotNull(), "adapter")
            .otherwise("unknown"),
            "resolved": F.when(is_base, F.lit(base_model)).otherwise(F.col("_path")),
        }
    ).drop("_path")
