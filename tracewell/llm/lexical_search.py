"""Ranked lexical search over an inverted index with block maxima.

``build_index`` cuts the documents into shards of about ``SHARD_BYTES`` of text, each made by one task on
its own, and writes a row for every term of a shard: its postings (document, occurrences) in compressed blocks
of ``BLOCK``, with each block's last document, most occurrences and least document length. Those bound a block's
score whatever the weights are, so the index knows neither the statistics nor the queries.

``search`` looks the terms of the queries up in the index. In each shard the terms of an item are ordered by the
bound of their whole list. Lists are read whole (essential) as long as a document not met yet could still get among
the best; after that only documents already met are looked up in the other lists, and the maximum of the block a document
would be in rejects it before that block is decompressed. The best of every shard are merged
at the end, cut per task first.

Queries come in blocks of at most ``PAIRS`` terms (or one item, if it alone has more), which bounds what is broadcast.
Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.tables import stored
from tracewell.llm.words import ALNUM, PIECE_BYTES, pieces, words_of

SHARD_BYTES = 16 << 20
BLOCK = 64
PAIRS = 500_000
INDEX = ("shard long, term long, postings long, heads binary, body binary, doc_ids array<long>, filled long, length long")

#: Fixed values of the score.
SCALE, SLOPE, BASE = 1_000_000_000, 90, 10


# ---- compressed lists -------------------------------------------------------------------------

def encoded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the last byte of a value below 128; and the number of bytes of each value."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), dtype=np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << 7 * k)
    at = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    for k in range(int(sizes.max(initial=0))):
        more = sizes > k
        part = (values[more] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[more] + k] = part.astype(np.uint8) | np.where(sizes[more] > k + 1, 128, 0).astype(np.uint8)
    return out, sizes


def decoded(data: np.ndarray) -> np.ndarray:
    """The values of ``encoded`` bytes."""
    ends = np.flatnonzero(data < 128)
    if len(ends) == len(data):
        return data.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    within = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * within), starts)


# ---- building ---------------------------------------------------------------------------------

def _binaries(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Stretches of a byte array between cuts as a column."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _columns(size: int, **given) -> pa.RecordBatch:
    kinds = {"shard": pa.int64(), "term": pa.int64(), "postings": pa.int64(), "heads": pa.binary(), "body": pa.binary(),
             "doc_ids": pa.list_(pa.int64()), "filled": pa.int64(), "length": pa.int64()}
    return pa.RecordBatch.from_arrays([given.get(k, pa.nulls(size, t)) for k, t in kinds.items()], names=list(kinds))


def shard_rows(shard: int, doc_ids: list, hashes: np.ndarray, docs: np.ndarray):
    """Batches of the index: a row with the documents of the shard, then one for each term.

    ``hashes`` are the words of all documents in order, ``docs`` the place of each word's document.
    """
    lengths = np.bincount(docs, minlength=len(doc_ids)).astype(np.int64)
    yield _columns(1, shard=pa.array([shard], pa.int64()), body=pa.array([lengths.tobytes()], pa.binary()),
                   doc_ids=pa.array([doc_ids], pa.list_(pa.int64())),
                   filled=pa.array([int((lengths > 0).sum())]), length=pa.array([int(lengths.sum())]))
    if not len(hashes):
        return
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])]))
    tf = np.diff(np.append(first, len(hashes)))
    hashes, docs = hashes[first], docs[first]
    opens = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    counts = np.diff(np.append(opens, len(hashes)))
    place = np.arange(len(docs)) - np.repeat(opens, counts)
    blocks = np.flatnonzero(place % BLOCK == 0)
    delta = np.diff(docs, prepend=0)
    delta[opens] = docs[opens] + 1
    body, sizes = encoded(np.column_stack([delta, tf]).reshape(-1))
    sizes = np.add.reduceat(sizes.reshape(-1, 2).sum(axis=1), blocks)
    ends = np.append(blocks[1:], len(docs)) - 1
    heads = np.column_stack([docs[ends], np.maximum.reduceat(tf, blocks), np.minimum.reduceat(lengths[docs], blocks),
                             sizes]).astype(np.int64)
    own = np.append(np.searchsorted(blocks, opens), len(blocks))  # the blocks of each term
    bytes_before = np.concatenate([[0], np.cumsum(sizes)])
    yield _columns(
        len(opens), shard=pa.array(np.full(len(opens), shard), pa.int64()), term=pa.array(hashes[opens].view(np.int64)),
        postings=pa.array(counts.astype(np.int64)), heads=_binaries(heads.reshape(-1).view(np.uint8), own * 32),
        body=_binaries(body, bytes_before[own]))


def _index(batches):
    part = TaskContext.get().partitionId()
    made, ids, hashes, docs, size = 0, [], [], [], 0

    def close():
        return shard_rows(part << 32 | made, ids, np.concatenate(hashes or [np.zeros(0, np.uint64)]),
                          np.concatenate(docs or [np.zeros(0, np.int64)]))

    for batch in batches:
        known = batch.column("doc_id").to_pylist()
        for piece in pieces(batch.column("text"), min(PIECE_BYTES, SHARD_BYTES)):
            words = words_of(piece, ALNUM)
            hashes.append(words.hash)
            docs.append(words.row + len(ids))
            ids += known[piece.first_row: piece.first_row + piece.rows]
            size += len(piece.data)
            if size >= SHARD_BYTES:
                yield from close()
                made, ids, hashes, docs, size = made + 1, [], [], [], 0
    if ids:
        yield from close()


def build_index(documents: DataFrame) -> DataFrame:
    """The inverted index of whole texts, written to the shared folder.

    A row without a term describes a shard: doc_ids, the documents' lengths (body), ``filled`` (documents with a
    term) and ``length`` (terms in all). Every other row is a term's list in a shard. Null texts have no
    term. A doc_id may be null or repeated; each row is a document. Further columns are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_index, INDEX), "index")


# ---- searching --------------------------------------------------------------------------------

@dataclass
class Statistics:
    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents of these lengths."""
        if not self.terms or not len(lengths):
            return np.full(len(lengths), BASE, dtype=np.int64)
        factor = SLOPE * self.documents
        if int(lengths.max()) * factor < 1 << 63:
            return BASE + lengths * factor // self.terms
        return np.array([BASE + int(n) * factor // self.terms for n in lengths], dtype=np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SCALE * tf // (1000 * tf + 8 * m)


class PostingList:
    """A term's list in a shard; blocks are decompressed when first asked for."""

    def __init__(self, weight: int, heads: bytes, body: bytes, statistics: Statistics, m: np.ndarray):
        head = np.frombuffer(heads, dtype=np.int64).reshape(-1, 4)
        self.last, self.ends = head[:, 0], np.cumsum(head[:, 3])
        self.body, self.weight, self.m = np.frombuffer(body, dtype=np.uint8), weight, m
        self.bounds = weight * impact(head[:, 1], statistics.damping(head[:, 2]))
        self.bound = int(self.bounds.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.all: tuple[np.ndarray, np.ndarray] | None = None

    def _scored(self, values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return docs, self.weight * impact(values[1::2], self.m[docs])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the list."""
        if self.all is None:
            values = decoded(self.body)
            self.all = self._scored(values, np.cumsum(values[::2]) - 1)
        return self.all

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self.open:
            values = decoded(self.body[self.ends[k - 1] if k else 0: self.ends[k]])
            before = self.last[k - 1] if k else -1
            self.open[k] = self._scored(values, np.cumsum(values[::2]) + before)
        return self.open[k]


def highest(scores: np.ndarray, k: int) -> int:
    """The k-th highest, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of_shard(lists: list[PostingList], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (places) that may be among the k best of the shard, with their scores; ties with the k-th stay."""
    lists = sorted(lists, key=lambda x: -x.bound)
    rest = np.append(np.cumsum([x.bound for x in lists][::-1])[::-1], 0)  # bound of list i and all later
    score, least, at = np.zeros(size, dtype=np.int64), 1, 0
    while at < len(lists) and rest[at] >= least:  # essential: a document not met yet may still count
        docs, gained = lists[at].whole()
        score[docs] += gained
        at += 1
        least = max(least, highest(score, k))
    found = np.flatnonzero((score > 0) & (score + rest[at] >= least))
    for i in range(at, len(lists)):
        own, after = lists[i], rest[i + 1]
        block = np.searchsorted(own.last, found)
        inside = block < len(own.last)
        bound = np.where(inside, own.bounds[np.minimum(block, len(own.last) - 1)], 0)
        stay = score[found] + bound + after >= least
        found, block, inside = found[stay], block[stay], inside[stay]
        for b in np.unique(block[inside]).tolist():
            docs, gained = own.block(b)
            here = found[block == b]
            place = np.searchsorted(docs, here)
            hit = docs[np.minimum(place, len(docs) - 1)] == here
            score[here[hit]] += gained[place[hit]]
        least = max(least, highest(score[found], k))
        found = found[score[found] + after >= least]
    return found, score[found]


def _search(block, statistics: Statistics, k: int):
    """``block``: broadcast (items, offsets, terms, weights); item i has terms[offsets[i]:offsets[i + 1]]."""

    def run(lists, shards):
        items, offsets, terms, weights = block.value
        out: tuple[list, list, list] = ([], [], [])
        if lists.num_rows and shards.num_rows:
            lengths = np.frombuffer(shards.column("lengths")[0].as_py(), dtype=np.int64)
            doc_ids = shards.column("ids")[0].as_py()
            m = statistics.damping(lengths)
            weight = dict(zip(terms.tolist(), weights.tolist()))
            known = {
                t: PostingList(weight[t], heads, body, statistics, m) for t, heads, body in
                zip(*(lists.column(c).to_pylist() for c in ("term", "heads", "body"))) if weight[t] > 0
            }
            for i, item in enumerate(items):
                own = [known[t] for t in terms[offsets[i]: offsets[i + 1]].tolist() if t in known]
                if own:
                    docs, scores = best_of_shard(own, len(lengths), k)
                    best = sorted((-s, doc_ids[d] is None, doc_ids[d] or 0, d) for d, s in zip(docs.tolist(), scores.tolist()))
                    for s, _, _, d in best[:k]:
                        for column, value in zip(out, (item, doc_ids[d], -s)):
                            column.append(value)
        return pa.table({"item_id": pa.array(out[0], pa.int64()), "doc_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.int64())})

    return run


def _terms(batches):
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        for piece in pieces(batch.column("text")):
            words = words_of(piece, ALNUM)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[piece.first_row + r] for r in words.row.tolist()], pa.int64()),
                 pa.array(words.hash.view(np.int64))], names=["item_id", "term"])


def query_blocks(queries: DataFrame, most: int = PAIRS):
    """Blocks (items, offsets, terms) of whole items, of at most ``most`` terms or one item; read one at a time."""
    rows = queries.filter("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    pairs = stored(rows.mapInArrow(_terms, "item_id long, term long").distinct(), "query-terms")
    items: list[int] = []
    terms: list[list[int]] = []
    for item, own in pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("term"))).orderBy("item_id").toLocalIterator():
        if items and sum(map(len, terms)) + len(own) > most:
            yield _block(items, terms)
            items, terms = [], []
        items.append(item)
        terms.append(own)
    if items:
        yield _block(items, terms)


def _block(items: list[int], terms: list[list[int]]):
    return np.array(items), np.cumsum([0, *map(len, terms)]), np.concatenate([np.array(t, dtype=np.int64) for t in terms])


def search(index: DataFrame, queries: DataFrame, k: int = 10, most: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``index`` that score highest for each item.

    ``queries`` has item_id and text. Rows that share an item_id are one item, with the terms of all of them; rows
    without one, and items without terms, find nothing. Documents of equal score rank by doc_id (null last); rows
    that repeat a doc_id are ranked each. Empty tables give an empty result. Further columns are not read.
    """
    spark = index.sparkSession
    shards = index.filter("term is null")
    totals = shards.agg(F.sum("filled"), F.sum("length")).first()
    statistics = Statistics(totals[0] or 0, totals[1] or 0)
    found = []
    for items, offsets, terms in query_blocks(queries, most):
        wanted = F.broadcast(spark.createDataFrame(pa.table({"term": np.unique(terms)})))
        lists = index.join(wanted, "term")
        df = dict(map(tuple, lists.groupBy("term").agg(F.sum("postings")).collect()))  # as many rows as the block has terms
        weights = np.array([statistics.weight(df.get(t, 0)) for t in terms.tolist()], dtype=np.int64)
        block = spark.sparkContext.broadcast((items.tolist(), offsets, terms, weights))
        best = (
            lists.select("shard", "term", "heads", "body").groupBy("shard")
            .cogroup(shards.select(F.col("shard").alias("of"), F.col("body").alias("lengths"), F.col("doc_ids").alias("ids")).groupBy("of"))
            .applyInArrow(_search(block, statistics, k), "item_id long, doc_id long, score long")
        )
        found.append(stored(best, "shard-best"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")
