"""Comparing the members of large groups tile by tile.

A group is dealt to blocks of bounded size, and every pair of its blocks is a tile. Tiles are rows that
lie together in a sorted partition, so a task holds one tile at a time. What a tile finds leaves it as
one edge for each member, never as pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.components import join_labels

#: Members that one side of a tile holds.
TILE = 512


def whole_runs(batches, *keys: str):
    """(table, cuts): consecutive rows that agree in ``keys`` lie between two cuts, whatever the bounds of
    the batches."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        change = np.zeros(max(rows.num_rows - 1, 0), dtype=bool)
        for k in keys:
            values = rows.column(k).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        if len(cuts) > 1:
            yield rows.slice(0, cuts[-1]).combine_chunks(), cuts
        rest = rows.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), [0, rest.num_rows]


def runs(batches, *keys: str):
    """Tables of consecutive rows that agree in ``keys``."""
    for table, cuts in whole_runs(batches, *keys):
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield table.slice(lo, hi - lo).combine_chunks()


def edges(members: np.ndarray, found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Pairs of rows as one edge for each row, to the least member it is connected with."""
    a = np.concatenate([np.full(len(o), r) for r, o in found]) if found else np.zeros(0, dtype=np.int64)
    b = np.concatenate([o for _, o in found]) if found else np.zeros(0, dtype=np.int64)
    label = join_labels(np.arange(len(members)), a, b)
    touched = np.unique(np.concatenate([a, b])).astype(np.int64)
    least = np.full(len(members), np.iinfo(np.int64).max)
    np.minimum.at(least, label[touched], members[touched])
    return pa.RecordBatch.from_arrays([pa.array(members[touched], pa.int64()), pa.array(least[label[touched]], pa.int64())],
                                      names=["a", "b"])


def tiles_of(rows: DataFrame) -> DataFrame:
    """``rows`` (key, blocks, doc, ...) dealt to the pairs of blocks of their key, each pair together.

    New columns: block, i and j; a tile holds the rows of blocks i and j of a key.
    """
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    )


def blocks_of(count) -> F.Column:
    return F.ceil(count / TILE).cast("int").alias("blocks")
