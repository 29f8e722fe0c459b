"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges go from the larger to the smaller end.

    Both steps find the least neighbour by a grouping that combines before it shuffles, and join
    it back, so that adaptive execution can split the edges of a hot node.
    """
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("least"))
    large = (
        edges.select(F.col("low").alias("hub"), F.col("high").alias("other"))
        .join(least.withColumnRenamed("high", "hub"), "hub")
        .select(F.col("other").alias("high"), F.col("least").alias("low"))
        .filter("high > low")
    )
    least = large.groupBy("high").agg(F.min("low").alias("least"))
    ends = F.explode(F.array("high", "low")).alias("high")
    return large.join(least, "high").select(ends, F.col("least").alias("low")).filter("high > low").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (high, low) has one lower neighbour and no higher ones, or higher ones only."""
    ends = edges.select(F.col("high").alias("node"), "low").unionByName(
        edges.select(F.col("low").alias("node"), F.lit(None).cast(edges.schema["low"].dataType).alias("low")))
    nodes = ends.groupBy("node").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.count("*").alias("n"),
                                     F.count("low").alias("lower"))
    return nodes.agg(F.count_if(F.expr("least < most or lower > 0 and n > lower"))).first()[0] == 0


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps alternate until the edges are stars; then each node points at the
    least node of its component. Edges that are stars from the start take no step. Every round is a
    written table, so a lost executor costs one round at most. Null ends and loops are ignored.
    """
    edges = (
        edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"),
                     (F.col("a").isNull() | F.col("b").isNull()).alias("broken"))
        .filter("not broken and high > low").select("high", "low").distinct()
    )
    edges = stored(edges, purpose)
    while not _are_stars(edges):
        edges = stored(_stars(edges), purpose)
    roots = edges.select(F.col("low").alias("node")).distinct()
    return (
        edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        .unionByName(roots.select("node", F.col("node").alias("component")))
    )


def as_edges(reached: DataFrame) -> DataFrame:
    """What ``components`` found, as edges (a, b) that connect the same nodes."""
    return reached.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least member first) after linking members a[k] and b[k]."""
    a, b = label[a], label[b]
    root = np.arange(len(label))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if np.array_equal(root, before):
            return root[label]
