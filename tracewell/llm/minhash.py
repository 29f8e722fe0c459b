"""Near-duplicate documents: fast similarity sketches, banding, and a check on the full sets.

A document's set holds its distinct five-word shingles (see ``shingle_sets``). The sketch has 128
coordinates. In round i every element of the set is hashed to one bin and offers the value (i, hash)
there; a bin keeps its least value, and rounds go on until no bin is empty. In rounds 128 to 255
every element goes to the bin numbered like the round, so all bins fill for certain. Two sets agree
in a coordinate with probability equal to their Jaccard similarity.

Four coordinates make a band, 32 bands a sketch: a pair at similarity 0.75 shares no band with
probability 5e-6. Candidates must also agree in 70 of the coordinates' low bytes, which a pair at
0.75 misses by more than five standard deviations. Every remaining candidate is checked on its full sets.

No group is expanded into all its pairs:

1. Equal sets are one node.
2. Every document is paired with the least one that it shares a bucket with. Confirmed links give first
   components, which take in the large groups of copies. Then members of a bucket whose least member
   is in another component are paired with that one.
3. Only buckets that still hold several components are looked at again, in tiles of bounded size that
   compare the sketches of members of *different* components. A tile returns one edge for each member,
   which makes groups of alike documents; these go through tiles again, now with their texts, that
   check every alike pair on its full sets and return one edge for each member.

So every pair that shares a band is either confirmed, refused, or already connected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import words as W
from tracewell.llm.components import as_edges, components
from tracewell.llm.tables import stored
from tracewell.llm.tiles import blocks_of, edges, runs, tiles_of

SHINGLE = 5
SIMILARITY_PERCENT = 75
BINS = 128
BAND_ROWS = 4
#: Coordinates (low bytes) in which a pair must agree to be checked.
AGREE = 70

_ROUND_SEEDS = np.random.default_rng(4711).integers(0, 1 << 63, 2 * BINS, dtype=np.uint64)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE):
    """For every text in order, its set of shingle hashes, sorted.

    A text of fewer words has its whole sequence as one shingle; one without words has the empty set.
    """
    for piece in W.pieces(column):
        found = W.words_of(piece, W.SPACED)
        full = W.shingle_hashes(found.hash, shingle)
        for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
            if hi - lo >= shingle:
                yield np.unique(full[lo: hi - shingle + 1])
            else:
                yield W.shingle_hashes(found.hash[lo:hi], hi - lo) if hi > lo else full[:0]


def sketch(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    out = np.full(bins, _NONE)
    at_once = max(1, 8 * bins // len(values))
    done = 0
    while done < bins:
        rounds = np.arange(done, min(done + at_once, bins), dtype=np.uint64)[:, None]
        offered = W.mixed(values[None, :] ^ _ROUND_SEEDS[done: done + len(rounds), None])
        bin_ = (offered & np.uint64(bins - 1)).astype(np.int64)
        np.minimum.at(out, bin_.ravel(), ((rounds << np.uint64(48)) | (offered >> np.uint64(16))).ravel())
        done += len(rounds)
        if not (out == _NONE).any():
            return out
    for bin_ in np.flatnonzero(out == _NONE):
        least = W.mixed(values ^ _ROUND_SEEDS[bins + bin_]).min()
        out[bin_] = (np.uint64(bins + bin_) << np.uint64(48)) | (least >> np.uint64(16))
    return out


def band_hashes(coordinates: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    bands = coordinates.reshape(-1, rows)
    out = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        out = W.mixed(out ^ bands[:, k])
    return out


def _sketch_rows(batches):
    for batch in batches:
        sizes, keys, bands, small = [], [], [], []
        for own in shingle_sets(batch.column(1)):
            sizes.append(len(own))
            if len(own):
                coordinates = sketch(own)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                bands.append(band_hashes(coordinates).view(np.int64))
                small.append((coordinates & np.uint64(255)).astype(np.uint8).tobytes())
            else:
                keys.append(None)
                bands.append(None)
                small.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.binary())],
            names=["doc_id", "n_shingles", "set_key", "bands", "small"],
        )


def _confirm_rows(percent: int):
    def confirm(batches):
        for batch in batches:
            a, b, text_a, text_b = batch.columns
            keep = np.zeros(batch.num_rows, dtype=bool)
            codes = text_b.dictionary_encode()
            others = list(shingle_sets(codes.dictionary))
            for r, (own, k) in enumerate(zip(shingle_sets(text_a), codes.indices.to_pylist())):
                if k is not None and len(own):
                    shared = len(np.intersect1d(own, others[k], assume_unique=True))
                    keep[r] = shared > 0 and 100 * shared >= percent * (len(own) + len(others[k]) - shared)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return confirm


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough; one for each two texts of the documents."""
    sides = (
        pairs.hint("merge").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .hint("merge").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return sides.mapInArrow(_confirm_rows(percent), "a long, b long")


def _alike_in_tile(tile: pa.Table):
    """(r, others) for each row of the tile's first block: rows of the second block that are in another
    component and agree in enough coordinates."""
    block, docs, comps = (tile.column(c).to_numpy() for c in ("block", "doc", "comp"))
    i, j = tile.column("i")[0].as_py(), tile.column("j")[0].as_py()
    small = np.frombuffer(b"".join(tile.column("small").to_pylist()), dtype=np.uint8).reshape(len(docs), BINS)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for r in left:
        others = right[docs[right] > docs[r]] if i == j else right
        others = others[comps[others] != comps[r]]
        others = others[(small[others] == small[r]).sum(1) >= AGREE]
        if len(others):
            yield r, others


def _alike_edges(batches):
    """Connects the alike members of a bucket, tile by tile."""
    for tile in runs(batches, "key", "i", "j"):
        yield edges(tile.column("doc").to_numpy(), list(_alike_in_tile(tile)))


def _similar_edges(percent: int):
    """Checks all alike pairs of a tile on their full sets and connects those that are similar."""

    def run(batches):
        for tile in runs(batches, "key", "i", "j"):
            alike = list(_alike_in_tile(tile))
            if not alike:
                continue
            sets = list(shingle_sets(tile.column("text").combine_chunks()))
            size = np.array([len(x) for x in sets])
            flat = np.concatenate(sets)
            _, flat = np.unique(flat, return_inverse=True)
            at = np.cumsum(size) - size
            held = np.zeros(int(flat.max()) + 1, dtype=bool)
            found = []
            for r, others in alike:
                own = flat[at[r]: at[r] + size[r]]
                held[own] = True
                shared = np.array([np.count_nonzero(held[flat[at[o]: at[o] + size[o]]]) for o in others])
                held[own] = False
                found.append((r, others[100 * shared >= percent * (size[r] + size[others] - shared)]))
            yield edges(tile.column("doc").to_numpy(), found)

    return run


def links(documents: DataFrame, sketches: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Edges (a, b) that connect exactly the documents connected by similar pairs."""
    real = sketches.filter("doc_id is not null and n_shingles > 0")
    nodes = real.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    first = F.col("doc_id") == F.col("node")
    placed = stored(
        real.select("doc_id", "set_key", "bands", "small").join(nodes, "set_key")
        .select("doc_id", "node", F.when(first, F.col("bands")).alias("bands"), F.when(first, F.col("small")).alias("small")),
        "sketches")
    twins = placed.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    own = placed.filter("doc_id = node").select(F.col("doc_id").alias("doc"), "bands", "small")

    banded = own.select("doc", F.explode("bands").alias("h"))
    shared = (
        banded.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("last"))
        .filter("least < last").select("h", "least")
    )
    members = stored(banded.join(shared, "h"), "buckets")

    # the texts that any candidate pair can need, shuffled once, in the same way at every size
    needed = members.select(F.col("doc").alias("doc_id")).distinct()
    texts = stored(documents.join(needed.hint("merge"), "doc_id", "left_semi"), "minhash-texts")
    small = own.select("doc", "small")

    # first every member with the least document it shares a bucket with, then with the least of those
    # buckets whose least document is still in another component
    stars = members.filter("doc <> least").groupBy("doc").agg(F.min("least").alias("least"))
    asked = _alike(stars.select(F.col("doc").alias("a"), F.col("least").alias("b")), small)
    first = stored(_confirmed(asked, texts, percent), "links")
    reached = components(first, "reached")
    where = _placed(members, reached)
    stars = where.filter("doc <> least and comp <> least_comp").select(
        F.col("doc").alias("a"), F.col("least").alias("b")).distinct()
    stars = stars.join(asked, ["a", "b"], "left_anti")
    asked = stored(asked.unionByName(_alike(stars, small)), "stars")
    # the stars of the components so far stand for the links that made them
    second = _confirmed(asked.join(first, ["a", "b"], "left_anti"), texts, percent)
    reached = components(as_edges(reached).unionByName(second), "reached")
    where = _placed(members, reached)
    mixed = (
        where.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("n"))
        .filter("c0 < c1").select("h", blocks_of(F.col("n")))
    )
    tiles = tiles_of(
        where.select("h", "doc", "comp").join(mixed, "h").join(small, "doc")
        .select(F.col("h").alias("key"), "blocks", "doc", "comp", "small"))
    near = components(tiles.mapInArrow(_alike_edges, "a long, b long"), "alike")
    near = stored(near.select(F.col("component").alias("key"), F.col("node").alias("doc")), "alike-groups")
    sizes = near.groupBy("key").agg(blocks_of(F.count("*")))
    tiles = tiles_of(
        near.join(sizes, "key").join(where.groupBy("doc").agg(F.min("comp").alias("comp")), "doc").join(small, "doc")
        .join(texts.withColumnRenamed("doc_id", "doc"), "doc"))
    third = tiles.mapInArrow(_similar_edges(percent), "a long, b long")
    return twins.unionByName(as_edges(reached)).unionByName(third)


def _placed(members: DataFrame, reached: DataFrame) -> DataFrame:
    """``members`` with the components of the document and of its bucket's least document."""
    return stored(
        members.join(reached.select(F.col("node").alias("doc"), F.col("component").alias("c")), "doc", "left")
        .join(reached.select(F.col("node").alias("least"), F.col("component").alias("d")), "least", "left")
        .select("h", "doc", "least", F.coalesce("c", "doc").alias("comp"), F.coalesce("d", "least").alias("least_comp")),
        "members")


def _alike(pairs: DataFrame, small: DataFrame) -> DataFrame:
    """Pairs (a, b) that agree in enough coordinates."""
    sides = (
        pairs.join(small.select(F.col("doc").alias("a"), F.col("small").alias("small_a")), "a")
        .join(small.select(F.col("doc").alias("b"), F.col("small").alias("small_b")), "b")
        .select("a", "b", "small_a", "small_b")
    )
    return stored(sides.mapInArrow(_alike_rows(BINS), "a long, b long").distinct(), "alike")


def _alike_rows(bins: int):
    def alike(batches):
        for batch in batches:
            a, b, left, right = batch.columns
            left, right = (np.frombuffer(b"".join(x.to_pylist()), dtype=np.uint8).reshape(-1, bins) for x in (left, right))
            mask = pa.array((left == right).sum(1) >= AGREE)
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return alike


def near_duplicates(documents: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents`` (doc_id, text, ...).

    Two documents are linked when 100 * |A and B| >= percent * |A or B|; component_id is the smallest
    doc_id reachable over links. Null, empty and blank texts have no shingles and link with nothing.
    Rows without a doc_id are kept and have no component. Rows that repeat a doc_id are one node with
    the links of all its texts, and each of them is kept if the id is its component's. An empty table
    gives an empty one. Other columns are not read, whatever their names.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(
        documents.mapInArrow(
            _sketch_rows, "doc_id long, n_shingles long, set_key binary, bands array<long>, small binary"),
        "minhash",
    )
    reached = components(links(documents, sketches, percent), "near-duplicates")
    out = sketches.select("doc_id", "n_shingles").join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(documents: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """``documents`` with one document of each group of near-duplicates, the one with the smallest id."""
    gone = near_duplicates(documents, percent).filter("not kept").select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
