"""Columns worked out exactly once.

The optimizer may copy a projected expression into a filter or projection above it. Where
that expression is looked up once per array element, the copy would be worked out once per
element too, and linear work would become quadratic. Values that come out of a generator
are never copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose values later steps refer to, instead of to their expressions."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
