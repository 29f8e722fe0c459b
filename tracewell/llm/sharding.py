"""Longest-processing-time scheduling of documents into shards of near equal bytes.

Documents of equal text are a group that stays together. Groups are taken by falling size, each to the
least-loaded shard, which a heap gives. Groups of one size are interchangeable, so the schedule is worked
out on the table of sizes: a row for each size that occurs and its number of groups. Sizes that differ add up to the
input at most, so that table has no more than the square root of twice the input's bytes as rows, whatever the
number of groups. It is read in order by one task that holds the loads and nothing else; all else,
grouping, ranking and numbering, is spread over the cluster.

Only lengths and hashes of texts are shuffled. Texts are compared by 128 bits.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored
from tracewell.operators.blocks import HOT_ROWS, ordered

SHARDS = 24
ROW_BYTES = 8

#: Up to so many groups of one size are dealt one after the other; more at once, with the same outcome.
ONE_BY_ONE = 96


def starts_below(loads: np.ndarray, size: int, level: int) -> np.ndarray:
    """How often each shard is taken, if one of load l is taken at l, l + size, ... below ``level``."""
    return np.maximum(-((loads - level) // size), 0)


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of ``size`` each shard gets, always the least loaded, of equal ones the first."""
    taken = [0] * len(loads)
    if count > ONE_BY_ONE:
        now = np.array(loads, dtype=object)
        low, high = min(loads), min(loads) + size * count  # level whose starts are at most count
        while low < high:
            middle = (low + high + 1) // 2
            if starts_below(now, size, middle).sum() <= count:
                low = middle
            else:
                high = middle - 1
        taken = [int(n) for n in starts_below(now, size, low)]
        count -= sum(taken)
    heap = [(load + n * size, k) for k, (load, n) in enumerate(zip(loads, taken))]
    heapq.heapify(heap)
    for _ in range(count):
        load, k = heap[0]
        taken[k] += 1
        heapq.heapreplace(heap, (load + size, k))
    return taken


def _schedule(shards: int):
    def run(batches):
        loads = [0] * shards
        for batch in batches:
            ends = []
            for size, count in zip(batch.column("group_size").to_pylist(), batch.column("groups").to_pylist()):
                taken = deal(loads, size, count)
                loads = [load + n * size for load, n in zip(loads, taken)]
                ends.append(np.cumsum(taken).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("group_size"), pa.array(ends, pa.list_(pa.int64()))], names=["group_size", "ends"])

    return run


def sized(documents: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """doc_id, size, text_crc32 and a 128-bit key of every row; a null text is an empty one."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return documents.select(
        "doc_id", (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("key"))


def schedule(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``groups`` (key, group_size) with their shard, by longest processing time."""
    sizes = groups.groupBy("group_size").agg(F.count("*").alias("groups"))
    ends = stored(
        sizes.repartition(1).sortWithinPartitions(F.desc("group_size"))
        .mapInArrow(_schedule(shards), "group_size long, ends array<long>"), "shard-ends")
    ranked = ordered(groups, ["group_size"], ["key"]).number("rank").rows()
    return ranked.join(ends, "group_size").select(
        "key", F.size(F.filter("ends", lambda end: end < F.col("rank"))).alias("shard"))


def assign(documents: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES) -> DataFrame:
    """A row for each document: doc_id, size, text_crc32, shard, slot.

    ``slot`` counts the rows of a shard from 0, by doc_id (nulls first), then size and text_crc32. Null and empty texts are equal
    and weigh ``row_bytes``. Rows that repeat, and all rows of equal text, share a shard; of equal rows each has a slot
    of its own. An empty table gives an empty one; further columns are not read. A group larger than
    a shard's share makes its shard larger than the others, which then share the rest evenly.
    """
    if shards < 1 or row_bytes < 1:
        raise ValueError("shards and row_bytes must be positive")
    rows = stored(sized(documents, row_bytes), "sizes")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("group_size")), "text-groups")
    placed = stored(rows.join(schedule(groups, shards), "key").drop("key"), "placed")
    total = placed.count()
    order = ["doc_id", "size", "text_crc32"]
    numbered = ordered(placed, ["shard"], order, floor=min(HOT_ROWS, max(1024, total // 200))).number("slot").rows()
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"))
