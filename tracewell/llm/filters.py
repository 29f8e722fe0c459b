"""A bit filter of 64-bit hashes that occur once, or at least twice, built by Spark.

Filters only spare work: what they let through is always checked by an exact join. Their size is bounded,
so they may be broadcast; a full one lets more through, never less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Most bits of a filter, as a power of two: 32 MB.
MOST = 28
LEAST = 16


class Filter:
    """A bit for each leading part of a hash."""

    def __init__(self, power: int):
        self.power = power
        self.bits = np.zeros(1 << (power - 3), dtype=np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.power)).astype(np.int64)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def power_for(hashes: int) -> int:
    """Sixteen bits or more for each hash, within the bounds."""
    return min(max(int(hashes).bit_length() + 4, LEAST), MOST)


def packed(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as their steps, byte by byte: leading bytes of steps are nearly all alike."""
    steps = np.diff(values, prepend=np.uint32(0)).astype(np.uint32)
    return pa.Codec("zstd", compression_level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    """The ``count`` values that ``packed`` was given."""
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True), dtype=np.uint8)
    steps = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def bucket_rows(hashes: np.ndarray, power: int) -> pa.RecordBatch:
    """Hashes of a batch by their leading ``power`` bits, each bucket the 32 bits that follow, sorted and packed; a
    third and further occurrence in the batch is left out, as it tells nothing new."""
    hashes = np.sort(hashes)
    spare = np.zeros(len(hashes), dtype=bool)
    spare[2:] = hashes[2:] == hashes[:-2]
    hashes = hashes[~spare]
    bucket = (hashes >> np.uint64(64 - power)).astype(np.int32)
    rest = (hashes >> np.uint64(32 - power)).astype(np.uint32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    parts = np.split(rest, cuts[1:]) if len(cuts) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts], pa.int32()), pa.array([len(x) for x in parts], pa.int32()),
         pa.array([packed(x) for x in parts], pa.binary())],
        names=["bucket", "count", "hashes"])


def _slice(power: int, twice: bool):
    def run(table):
        rows = zip(table.column("hashes").to_pylist(), table.column("count").to_pylist())
        seen = np.concatenate([unpacked(x, n) for x, n in rows])
        if twice:
            seen = np.sort(seen)
            seen = seen[1:][seen[1:] == seen[:-1]]
        bits = np.zeros(1 << power, dtype=np.uint8)
        bits[seen >> np.uint32(32 - power)] = 1
        return pa.table({"bucket": table.column("bucket")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return run


def filter_of(rows: DataFrame, batch_hashes, size: int, twice: bool) -> Filter:
    """The filter of about ``size`` hashes that ``batch_hashes`` gives for each batch of ``rows``.

    With ``twice`` only hashes that occur at least twice set their bit. Hashes are gathered in buckets of
    bounded size, and a bucket's slice of the filter is all that leaves it.
    """
    out = Filter(power_for(size))
    power = min(max(int(size >> 20), 1).bit_length(), out.power - 6)

    def run(batches):
        for batch in batches:
            found = batch_hashes(batch)
            if len(found):
                yield bucket_rows(found, power)

    slices = (
        rows.mapInArrow(run, "bucket int, count int, hashes binary")
        .groupBy("bucket").applyInArrow(_slice(out.power - power, twice), "bucket int, bits binary")
    )
    width = len(out.bits) >> power
    for r in slices.toLocalIterator():
        out.bits[r["bucket"] * width: (r["bucket"] + 1) * width] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out
