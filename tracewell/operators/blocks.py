"""Ordered computations over groups that may be far larger than one task.

Most groups are small, and a plain window does them. A hot group is cut into blocks, that
is, consecutive stretches of its order of about equal size. Each block is worked
on by itself, one small row per block says what it adds up to, and those rows alone are
scanned in order to tell every block what came before it:

    rows --(window per key and block)------------------------------.
      '--hot only--(aggregate per key and block)--(window per key)--+--> running value

A group is hot if it has more than ``HOT_ROWS`` rows or ``HOT_BYTES`` bytes, and every hot
group is cut, however many there are. One counting pass, which combines before it shuffles,
finds out whether there are any; then the rows of the hot groups are dealt to blocks by the
range of their keys and all order columns, so that neither one key nor one first order value
makes a block large. The blocks are a written table, which keeps their bounds fixed. Nothing
is collected but three sums, and no join is forced to broadcast. When nothing is hot, no join
and no extra shuffle is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.session import written_table

HOT_ROWS = 1_000_000   # groups up to this many rows ...
HOT_BYTES = 256 << 20  # ... and bytes are never cut

BLOCK, HOT = "_block", "_hot"

# What earlier blocks contribute: running form of each total.
CARRY: dict[str, Callable[[str], Column]] = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "last": lambda name: F.last(name, ignorenulls=True),
}
AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


def width(df: DataFrame) -> Column:
    """About how many bytes a row takes."""
    sized = [f.name for f in df.schema if isinstance(f.dataType, T.StringType | T.BinaryType)]
    fixed = F.lit(16 * len(df.columns)).cast("long")
    return sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in sized), fixed)


def join_by(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join that also matches null keys; keeps the left key columns.

    Without keys ``right`` has at most one row, and its columns become scalar subqueries.
    """
    if not keys:
        row = right.select(F.struct(*right.columns)).scalar()
        return left.withColumns({c: row[c] for c in right.columns})
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    joined = left.join(renamed, on, how)
    return joined if how == "left_anti" else joined.drop(*[f"_r_{k}" for k in keys])


@dataclass(frozen=True)
class Ordered:
    """Rows in groups ``keys``, ordered by ``order``; hot groups carry a block number."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    is_cut: bool

    def map(self, function: Callable[[DataFrame], DataFrame]) -> Ordered:
        """Apply a row-wise change that keeps keys, order and block."""
        return replace(self, df=function(self.df))

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK, HOT)

    @property
    def parts(self) -> list[str]:
        """Columns that name the group, or the block of a cut group."""
        return [*self.keys, BLOCK] if self.is_cut else list(self.keys)

    def _window(self):
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    def block_totals(self, **totals: Column) -> DataFrame:
        """One row per block of the hot keys."""
        hot = self.df.filter(F.col(HOT))
        return hot.groupBy(*self.parts).agg(*[agg.alias(n) for n, agg in totals.items()])

    def with_block_values(self, values: DataFrame) -> DataFrame:
        """The rows with the columns of ``values``, a row per block; null for ordinary groups."""
        hot = join_by(self.df.filter(F.col(HOT)), values, self.parts)
        new = [f for f in values.schema if f.name not in self.parts]
        cold = self.df.filter(~F.col(HOT))
        return hot.unionByName(cold.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new}))

    def _carry(self, totals: dict[str, tuple[Column, str]]) -> DataFrame:
        """Add, per total, its combined value over the earlier blocks of the key; null for
        ordinary groups and first blocks."""
        if not self.is_cut:
            return self.df.withColumns({n: F.lit(None) for n in totals})
        per_block = self.block_totals(**{n: agg for n, (agg, _) in totals.items()})
        earlier = (
            Window.partitionBy(*self.keys).orderBy(BLOCK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = per_block.select(
            *self.parts, *[CARRY[kind](n).over(earlier).alias(n) for n, (_, kind) in totals.items()]
        )
        return self.with_block_values(carried)

    def number(self, out: str) -> Ordered:
        """1-based position of each row in its group."""
        rows = self._carry({"_before": (F.count(F.lit(1)), "sum")})
        local = F.row_number().over(self._window()).cast("long")
        before = F.coalesce(F.col("_before").cast("long"), F.lit(0))
        return replace(self, df=rows.withColumn(out, local + before).drop("_before"))

    def previous(self, value: str, out: str) -> Ordered:
        """Value of the row before; null for the first row. ``value`` must not be null, and the
        order must tell the rows of a group apart."""
        rows = self._carry({"_last": (F.max_by(value, F.struct(*self.order)), "last")})
        local = F.lag(value).over(self._window())
        return replace(self, df=rows.withColumn(out, F.coalesce(local, "_last")).drop("_last"))

    def running(self, **outs: tuple[Column, str]) -> Ordered:
        """Running ``sum``, ``min`` or ``max`` of a value up to and including each row."""
        before = {f"_before_{n}": (AGGREGATE[how](v), how) for n, (v, how) in outs.items()}
        rows = self._carry(before)
        frame = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        kinds = {f.name: f.dataType for f in rows.select(
            *[AGGREGATE[how](v).over(frame).alias(n) for n, (v, how) in outs.items()]
        ).schema}
        for n, (value, how) in outs.items():
            local = AGGREGATE[how](value).over(frame)
            carried = F.col(f"_before_{n}").cast(kinds[n])
            if how == "sum":
                zero = F.lit(0).cast(kinds[n])
                both = F.coalesce(local, zero) + F.coalesce(carried, zero)
            else:
                both = (F.least if how == "min" else F.greatest)(local, carried)
            rows = rows.withColumn(n, both)
        return replace(self, df=rows.drop(*before))

    def totals(self, **outs: tuple[Column, str]) -> Ordered:
        """``sum``, ``min`` or ``max`` over the whole group, next to every row."""
        part = Window.partitionBy(*self.parts)
        local = {n: AGGREGATE[how](v).over(part) for n, (v, how) in outs.items()}
        if not self.is_cut:
            return replace(self, df=self.df.withColumns(local))
        hot = self.df.filter(F.col(HOT))
        whole = hot.groupBy(*self.keys).agg(
            *[AGGREGATE[how](v).alias(f"_hot_{n}") for n, (v, how) in outs.items()])
        hot = join_by(hot, whole, self.keys)
        names = {n: F.col(f"_hot_{n}") for n in outs}
        hot = hot.withColumns(names).drop(*[f"_hot_{n}" for n in outs])
        return replace(self, df=hot.unionByName(self.df.filter(~F.col(HOT)).withColumns(local)))


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    floor: int = HOT_ROWS,
    floor_bytes: int = HOT_BYTES,
    pieces: int | None = None,
) -> Ordered:
    """Prepare ordered groups, cutting those above ``floor`` rows or ``floor_bytes`` bytes.

    The hot groups together get ``pieces`` ranges, or as many as it takes to keep a range near
    those sizes. Rows equal in keys and order lie in one block.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(width(df)).alias("_b"))
    hot = sizes.filter((F.col("_n") > floor) | (F.col("_b") > floor_bytes))
    found = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows"), F.sum("_b").alias("bytes")).first()
    if not found["keys"]:
        return Ordered(df, tuple(keys), tuple(order), False)
    if pieces is None:
        pieces = 1 + max(math.ceil(found["rows"] / max(floor, 1)), math.ceil(found["bytes"] / max(floor_bytes, 1)))
    named = written_table(hot.select(*keys), "hot-keys") if keys else None
    rows = join_by(df, named, keys, "inner") if keys else df
    placed = rows.repartitionByRange(pieces, *keys, *order).withColumn(BLOCK, F.spark_partition_id())
    blocks = written_table(placed, "blocks").withColumn(HOT, F.lit(True))
    rest = join_by(df, named, keys, "left_anti") if keys else df.limit(0)
    rest = rest.withColumns({BLOCK: F.lit(-1), HOT: F.lit(False)})
    return Ordered(rest.unionByName(blocks), tuple(keys), tuple(order), True)
