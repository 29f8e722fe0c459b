"""Exact quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.blocks import BLOCK, HOT, Ordered, ordered


def _ranks(p: float, rows: Column) -> tuple[Column, Column]:
    """The 0-based ranks a quantile is interpolated from."""
    rank = F.lit(p) * (rows - 1)
    return F.floor(rank), F.ceil(rank)


def _needed_blocks(groups: Ordered, at: dict[str, float]) -> DataFrame:
    """Rows of the cut groups that can hold a wanted rank, with the number of values in
    earlier blocks and in the whole group; ordinary groups keep all rows."""
    of_key = Window.partitionBy(*groups.keys)
    earlier = of_key.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = groups.block_totals(_total=F.sum("_n")).select(
        *groups.parts, "_total",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(of_key).alias("_all"),
    )
    joined = groups.with_block_values(blocks)
    wanted = ~F.col(HOT)
    for p in at.values():
        for rank in _ranks(p, F.col("_all")):
            wanted = wanted | (
                (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_total"))
            )
    return joined.filter(wanted)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, at: dict[str, float], **cutting
) -> DataFrame:
    """Interpolated quantiles (position ``p * (n - 1)``) of the non-null values per key.

    Equal values are counted together before anything is ordered. Of a hot group only the
    few blocks that hold a wanted rank are ordered at all.
    """
    known = df.filter(F.col(value).isNotNull())
    counted = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    groups = ordered(counted, keys, [value], **cutting)
    part = Window.partitionBy(*groups.parts)
    so_far = part.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto, rows = F.sum("_n").over(so_far), F.sum("_n").over(part)
    ranked = groups.df
    if groups.is_cut:
        ranked = _needed_blocks(groups, at)
        upto = F.coalesce("_before", F.lit(0)) + upto
        rows = F.coalesce("_all", rows)
    ranked = ranked.withColumns({"_upto": upto, "_rows": rows})
    number = F.col(value).cast("double")

    aggs, outs = [], []
    for name, p in at.items():
        low, high = f"_{name}_lo", f"_{name}_hi"
        for out, rank in zip((low, high), _ranks(p, F.col("_rows")), strict=True):
            aggs.append(F.min(F.when(F.col("_upto") > rank, number)).alias(out))
        rank = F.lit(p) * (F.col("_rows") - 1)
        weight = rank - F.floor(rank)
        outs.append((F.col(low) + (F.col(high) - F.col(low)) * weight).alias(name))
    picked = ranked.groupBy(*keys).agg(F.max("_rows").alias("_rows"), *aggs)
    return picked.select(*keys, *outs)
