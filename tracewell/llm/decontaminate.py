"""Benchmark decontamination: a prefix-filtered containment join of item windows with documents.

A window is ``size`` consecutive words of a benchmark item; an item of fewer words is one window.
The tokens of a window are its three-word shingles (the whole window if it is shorter). They are
ordered by rarity in the documents: one pass counts every benchmark token over all texts. As a
window must be contained whole, one token is a sufficient prefix, so a window is looked for only
where its rarest token stands. There the position bound (the window must fit between the ends of
the text) is applied and the window is compared word by word, first by hash, then by bytes.

Windows are a query set held against all documents in blocks of at most ``block_windows``: a block
is the only thing broadcast and the only thing the driver sees. Documents are never shuffled. With
several blocks the hits so far travel with the documents through a written table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm import words as W
from tracewell.llm.tables import free_name, stored

SIZE = 10
TOKEN_WORDS = 3
#: Windows of one broadcast block; a window takes under 1 kB there.
BLOCK_WINDOWS = 1 << 16

WINDOWS_SCHEMA = "item string, at long, words array<binary>"


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, at, words) for every window of every item; items without id or words have none."""

    def windows(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            out = []
            for piece in W.pieces(batch.column(1)):
                found = W.words_of(piece, W.ALNUM, hashed=False)
                for r in range(piece.rows):
                    name, lo, hi = names[piece.first_row + r], found.first[r], found.first[r + 1]
                    own = [found.lower[s:e].tobytes() for s, e in zip(found.start[lo:hi], found.end[lo:hi])]
                    if name is None or not own:
                        continue
                    for at in range(max(1, len(own) - size + 1)):
                        out.append((name, at, own[at: at + size]))
                        if len(out) == 10_000:
                            yield _window_batch(out)
                            out = []
            if out:
                yield _window_batch(out)

    chosen = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return chosen.mapInArrow(windows, WINDOWS_SCHEMA)


def _window_batch(rows) -> pa.RecordBatch:
    item, at, words = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.string()), pa.array(at, pa.int64()), pa.array(words, pa.list_(pa.binary()))],
        names=["item", "at", "words"],
    )


def _hash_words(words: list[bytes]) -> np.ndarray:
    piece = W.Piece(0, np.frombuffer(b"\n".join(words), dtype=np.uint8),
                    np.array([0, sum(map(len, words)) + len(words) - 1]))
    return W.words_of(piece, W.ALNUM).hash


@dataclass
class Block:
    """Distinct windows of a block, by their length in words."""

    texts: list[tuple[bytes, ...]]
    items: list[list[str]]
    hashes: list[np.ndarray]

    @classmethod
    def of(cls, rows) -> Block:
        by_text: dict[tuple[bytes, ...], set[str]] = {}
        for r in rows:
            by_text.setdefault(tuple(bytes(w) for w in r["words"]), set()).add(r["item"])
        texts = sorted(by_text)
        return cls(texts, [sorted(by_text[t]) for t in texts], [_hash_words(list(t)) for t in texts])

    def tokens(self) -> dict[int, np.ndarray]:
        """By token width, the distinct token hashes."""
        out: dict[int, list[np.ndarray]] = {}
        for h in self.hashes:
            width = min(TOKEN_WORDS, len(h))
            out.setdefault(width, []).append(W.shingle_hashes(h, width))
        return {width: np.unique(np.concatenate(all_)) for width, all_ in out.items()}

    def index(self, seen: dict[int, int]) -> dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]]:
        """By token width: sorted prefix tokens and, for each, the (window, offset) it stands for."""
        chosen: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, h in enumerate(self.hashes):
            width = min(TOKEN_WORDS, len(h))
            own = W.shingle_hashes(h, width).tolist()
            offset = min(range(len(own)), key=lambda j: (seen.get(own[j], 0), own[j], j))
            chosen.setdefault(width, {}).setdefault(own[offset], []).append((k, offset))
        out = {}
        for width, found in chosen.items():
            keys = sorted(found)
            out[width] = (np.array(keys, dtype=np.uint64), [found[k] for k in keys])
        return out


class Lookup:
    """Positions at which one of some sorted hashes stands; a bitmap turns most words away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, index of the key found there)."""
        at = np.flatnonzero(self.bits[(hashes >> np.uint64(44)).astype(np.int64)])
        slot = np.searchsorted(self.keys, hashes[at])
        same = self.keys[np.minimum(slot, len(self.keys) - 1)] == hashes[at]
        return at[same], slot[same]


def token_counts(documents: DataFrame, tokens: dict[int, np.ndarray]) -> dict[int, int]:
    """How often each benchmark token stands in the documents, over all of them."""
    sent = documents.sparkSession.sparkContext.broadcast(tokens)

    def count(batches):
        lookups = {width: Lookup(keys) for width, keys in sent.value.items()}
        total = {width: np.zeros(len(look.keys), dtype=np.int64) for width, look in lookups.items()}
        for batch in batches:
            for piece in W.pieces(batch.column(0)):
                found = W.words_of(piece, W.ALNUM)
                for width, look in lookups.items():
                    at, slot = look.find(W.shingle_hashes(found.hash, width))
                    inside = found.row[at] == found.row[at + width - 1]
                    total[width] += np.bincount(slot[inside], minlength=len(look.keys))
        for width, look in lookups.items():
            some = np.flatnonzero(total[width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(look.keys[some].astype(np.int64)), pa.array(total[width][some])], names=["token", "n"]
            )

    counted = documents.select("text").mapInArrow(count, "token long, n long")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in rows}


def _match_piece(found: W.Words, block: Block, index, lookups):
    """For each row with a hit: (set of windows, hit mask of its words)."""
    out: dict[int, tuple[set[int], np.ndarray]] = {}
    for width, (_, targets) in index.items():
        hashes = W.shingle_hashes(found.hash, width)
        for at, slot in zip(*(x.tolist() for x in lookups[width].find(hashes))):
            r = int(found.row[at])
            lo, hi = int(found.first[r]), int(found.first[r + 1])
            for k, offset in targets[slot]:
                begin, text = at - offset, block.texts[k]
                stop = begin + len(text)
                if begin < lo or stop > hi or not np.array_equal(found.hash[begin:stop], block.hashes[k]):
                    continue
                bounds = zip(found.start[begin:stop].tolist(), found.end[begin:stop].tolist())
                if any(found.lower[s:e].tobytes() != w for (s, e), w in zip(bounds, text)):
                    continue
                windows, hit = out.setdefault(r, (set(), np.zeros(hi - lo, dtype=bool)))
                windows.add(k)
                hit[begin - lo: stop - lo] = True
    return out


def contaminated_words(documents: DataFrame, benchmark: DataFrame, size: int = SIZE,
                       block_windows: int = BLOCK_WINDOWS, column: str = "found") -> DataFrame:
    """``documents`` with a struct column ``column``: n_words, n_hit, items (sorted), hits.

    ``hits`` is a bitmap of the words that lie in an occurrence of a window (null without any).
    Rows keep their order of columns and their number, repeated ones too; a null or empty text has
    no words and no hits; items without an id or without words have no windows; an empty benchmark
    hits nothing. ``column`` must not be a column of the documents; other columns pass through.
    """
    windows = stored(item_windows(benchmark, size), "windows")
    blocks = -(-windows.count() // block_windows)
    found = "n_words long, n_hit long, items array<string>, hits binary"
    schema = T.StructType([*documents.schema, T.StructField(column, T.StructType.fromDDL(found))])
    block_of = F.pmod(F.xxhash64("words"), F.lit(max(blocks, 1)))
    state = documents
    for number in range(max(blocks, 1)):
        block = Block.of(windows.filter(block_of == number).toLocalIterator())
        index = block.index(token_counts(documents, block.tokens())) if block.texts else {}
        if number:
            state = stored(state, "decontaminated")
        state = _with_block(state, schema, block, index)
    return state


def _with_block(state: DataFrame, schema: T.StructType, block: Block, index) -> DataFrame:
    sent = state.sparkSession.sparkContext.broadcast((block, index))
    column = [c.lower() for c in state.columns].index("text")
    earlier, names = len(state.columns) == len(schema), schema.names

    def match(batches):
        block, index = sent.value
        lookups = {width: Lookup(keys) for width, (keys, _) in index.items()}
        for batch in batches:
            before = batch.column(batch.num_columns - 1).to_pylist() if earlier else None
            found_rows = []
            for piece in W.pieces(batch.column(column)):
                found = W.words_of(piece, W.ALNUM)
                hits = _match_piece(found, block, index, lookups) if index else {}
                counts = np.diff(found.first).tolist()
                for r, n in enumerate(counts):
                    windows, mask = hits.get(r, ((), None))
                    items = {name for k in windows for name in block.items[k]}
                    if before and before[piece.first_row + r]["hits"] is not None:
                        old = before[piece.first_row + r]
                        bits = np.unpackbits(np.frombuffer(old["hits"], dtype=np.uint8))[:n].astype(bool)
                        mask = bits if mask is None else mask | bits
                        items |= set(old["items"])
                    found_rows.append({
                        "n_words": n, "n_hit": 0 if mask is None else int(mask.sum()), "items": sorted(items),
                        "hits": None if mask is None else np.packbits(mask).tobytes(),
                    })
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                              ("items", pa.list_(pa.string())), ("hits", pa.binary())])
            columns = batch.columns[:-1] if earlier else batch.columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found_rows, kind)], names=names)

    return state.mapInArrow(match, schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = SIZE,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns.

    Documents with null or empty texts stay. See ``contaminated_words`` for the other cases.
    """
    found = free_name(documents, "found")
    rest = contaminated_words(documents, benchmark, size, block_windows, found)
    return rest.filter(F.col(found)["n_hit"] == 0).drop(found)


def report(documents: DataFrame, benchmark: DataFrame, size: int = SIZE,
           block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``documents``."""
    found = contaminated_words(documents.select("doc_id", "text"), benchmark, size, block_windows)
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )
