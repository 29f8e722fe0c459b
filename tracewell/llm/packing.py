"""Variable-capacity best-fit packing of documents into training sequences.

Documents are cut into pieces of at most the largest capacity; pieces go into bins of several permitted
capacities, longest first, each into the open bin that it leaves least room in. When none has room a
bin is opened, of the capacity that costs least for each word that goes into it: for every permitted capacity the bin is
filled on trial with the pieces still to come, the longest that fits first, and downsized. A bin costs its capacity
plus a fixed overhead. As the trial looks at one bin only, each shard is packed with a fixed least capacity too, once for every permitted
one; in all packings each bin is at last downsized to the least capacity that holds its contents, and the packing of least
cost counts.

Pieces are dealt to shards of about ``SHARD_LENGTH`` by a hash of all that tells them apart, copies of a row
numbered, so no source or document makes a shard larger than others. The number of shards grows with
the input and each is packed in one task.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_LENGTH = 4_000_000


def best_fit(lengths: list[int], opening: Callable[[int], int]) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset) of each length in the given order, and the contents of each bin.

    ``opening`` gives the capacity of a bin opened for the piece at a place in the order; of bins with
    equal room the one opened first is taken.
    """
    room: list[tuple[int, int]] = []
    filled: list[int] = []
    bins, offsets = [], []
    for place, n in enumerate(lengths):
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            k, left = len(filled), opening(place)
            filled.append(0)
        bins.append(k)
        offsets.append(filled[k])
        filled[k] += n
        if left > n:
            bisect.insort(room, (left - n, k))
    return bins, offsets, filled


def at_least(lengths: list[int], capacities: list[int], least: int) -> Callable[[int], int]:
    """Opens the least capacity that is at least ``least`` and holds the piece."""
    return lambda place: next(c for c in capacities if c >= max(lengths[place], least))


def cheapest(lengths: list[int], capacities: list[int], overhead: int) -> Callable[[int], int]:
    """Opens the capacity of least cost for a word, filled on trial with pieces from this one on; ``lengths`` descend."""
    falling = [-n for n in lengths]

    def filled(place: int, room: int) -> int:
        whole = room
        while room and (place := bisect.bisect_left(falling, -room, place)) < len(falling):
            n = -falling[place]
            after = bisect.bisect_right(falling, -n, place)
            taken = min(after - place, room // n)
            room -= taken * n
            place = after
        return whole - room

    def opening(place: int) -> int:
        best = None
        for c in capacities:
            if c >= lengths[place]:
                words = filled(place, c)
                cost = capacities[bisect.bisect_left(capacities, words)] + overhead
                # cost / words < best cost / best words, in integers
                if best is None or cost * best[1] < best[0] * words:
                    best = (cost, words, c)
        return best[2]

    return opening


def pack_jointly(lengths: list[int], capacities: list[int], overhead: int):
    """The packing of least cost over all rules of opening: bins, offsets, downsized capacities. ``lengths`` descend."""
    best = None
    rules = [cheapest(lengths, capacities, overhead), *(at_least(lengths, capacities, c) for c in capacities)]
    for opening in rules:
        bins, offsets, filled = best_fit(lengths, opening)
        final = [capacities[bisect.bisect_left(capacities, f)] for f in filled]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = (cost, bins, offsets, final)
    return best[1:]


def _pack_shard(capacities: list[int], overhead: int):
    def run(table):
        table = table.combine_chunks()
        order = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row_key", "ascending"),
                               ("copy", "ascending"), ("piece", "ascending")])
        bins, offsets, final = pack_jointly(order.column("length").to_pylist(), capacities, overhead)
        return pa.table({
            **{c: order.column(c) for c in ("doc_id", "copy", "piece", "start", "length", "shard")},
            "bin": pa.array(bins, pa.int64()), "capacity": pa.array([final[b] for b in bins], pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
        })

    return run


def word_count(text) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def pack(documents: DataFrame, capacities=CAPACITIES, overhead: int = OVERHEAD,
         shard_length: int = SHARD_LENGTH, length: Column | None = None) -> DataFrame:
    """A row for each piece: doc_id, copy, piece, start, length, shard, bin, capacity, offset.

    ``length`` (default: words of ``text``) is a document's size; a piece covers start to start + length of
    it. ``bin`` is unique within its shard. Documents of no length, null and blank texts among them, have
    no piece. Rows that repeat doc_id and text are told apart by ``copy``, from 1. A null doc_id is packed
    like others. An empty table gives an empty one; further columns are not read.
    """
    capacities = sorted(set(capacities))
    if not capacities or capacities[0] <= 0:
        raise ValueError("capacities must be positive")
    largest = capacities[-1]
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"),
        (word_count(F.col("text")) if length is None else length.cast("long")).alias("size"))
    rows = stored(rows.filter("size > 0").groupBy("doc_id", "row_key", "size").agg(F.count("*").alias("copies")), "lengths")
    total = rows.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    pieces = (
        rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / largest))))
        .withColumn("start", F.col("piece") * largest)
        .withColumn("length", F.least(F.col("size") - F.col("start"), F.lit(largest)))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "row_key", "copy", "piece"), F.lit(max(-(-total // shard_length), 1))))
        .select("doc_id", "row_key", "copy", "piece", "start", "length", "shard")
    )
    return pieces.groupBy("shard").applyInArrow(
        _pack_shard(capacities, overhead),
        "doc_id long, copy long, piece long, start long, length long, shard long, bin long, capacity long, offset long")


def sequences(packed: DataFrame, documents: DataFrame) -> DataFrame:
    """(shard, bin, capacity, texts): the pieces' words, one blank apart, in the order they are packed in.

    For documents measured in words, with different ids. Pieces of a null doc_id, which no join meets, have no text
    here, and documents without a piece, null and empty ones among them, are left out.
    """
    words = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    pieces = packed.join(documents.select("doc_id", words.alias("words")), "doc_id")
    text = F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
    return (
        pieces.groupBy("shard", "bin", "capacity").agg(F.sort_array(F.collect_list(F.struct("offset", text.alias("text")))).alias("own"))
        .select("shard", "bin", "capacity", F.col("own.text").alias("texts"))
    )
