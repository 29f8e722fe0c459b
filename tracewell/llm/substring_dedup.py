"""Removal of repeated 50-byte strings by a distributed merge sort of sampled suffixes.

Sorting every suffix of the corpus would shuffle many times its size, so suffixes are sampled by content:
in every 50-byte string the 16-byte gram of least hash (the leftmost of equals) is its *anchor*, so equal
strings have their anchors at the same place. Consecutive strings with one anchor are a *stretch* of 50 to
84 bytes; there is one for about 17 bytes of text. A suffix is written from the anchor on, to the end of its
stretch, followed by what the stretch holds before the anchor.

1. A repeated string reaches 16 bytes beyond its anchor on one side at least. Each text's anchors with the 16
   bytes before and after are hashed and counted in buckets, and hashes of two texts set a bit in a
   filter of bounded size; the others cannot lie in a repeated string. A full filter lets more through, never less.
2. Every task sorts the suffixes of its other anchors, makes equal ones one with their least
   doc_id, and sends them front-coded (length of the prefix shared with the one before, and the
   rest) to the bucket of the anchor.
3. A bucket merges its runs with a loser tree that keeps common prefix lengths: of two candidates the one
   that shares more with the last output is smaller without a look at either, and equal lengths are compared
   only beyond that prefix. Suffixes with the same anchor come out together; where a string of theirs
   occurs in several documents, a row says which strings of the stretch and what the least doc_id is.
4. Texts are read again, their stretches looked up in those rows by a join, which adaptive execution can
   split where a passage is common, and the covered bytes removed.

What is gathered in a bucket is one suffix for each task and different stretch, not one for each occurrence.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import words as W
from tracewell.llm.filters import filter_of
from tracewell.llm.tables import stored

LENGTH = 50
GRAM = 16
#: Bytes of text for each bucket of anchors, and bytes of text that make the runs of a task.
BUCKET_BYTES = 8 << 20
RUN_BYTES = 16 << 20
#: Bytes of text whose stretches are sought at a time: their hashes stay in a core's cache.
STRETCH_BYTES = 1 << 16
#: Suffixes with one anchor whose strings are held all at once.
FEW = 64
#: Bytes of text to an anchor, about.
ANCHOR_BYTES = 17

_SEED = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(991).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(W.powers(2)[1])
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _inverse_powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _INVERSE)
    out[0] = 1
    return np.multiply.accumulate(out)


class Stretches:
    """The stretches of a piece: row, first and last start of their strings, anchor and its hash."""

    def __init__(self, piece: W.Piece, length: int = LENGTH):
        self.piece, self.length = piece, length
        data, none = piece.data, np.zeros(0, dtype=np.int64)
        self.row = self.start = self.last = self.anchor = none
        self.hash = self.after = self.ahead = none.astype(np.uint64)
        if len(data) < length:
            return
        two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
        four = two[:-2] | (two[2:] << np.uint64(16))
        eight = four[:-4] | (four[4:] << np.uint64(32))
        grams = W.mixed(eight[:-8] * _SEED + W.mixed(eight[8:]))
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        wide, need = 1, length - GRAM + 1
        while wide < need:
            step = min(wide, need - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        sizes = np.diff(piece.offsets)
        inside = np.zeros(len(data) + 1, dtype=np.int32)
        long_ = sizes >= length
        np.add.at(inside, piece.offsets[:-1][long_], 1)
        np.add.at(inside, piece.offsets[1:][long_] - length + 1, -1)
        starts = np.flatnonzero(np.cumsum(inside[: len(least)]))
        if not len(starts):
            return
        anchors = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # an anchor lies inside its row, so it changes where the row does
        new = np.ones(len(starts), dtype=bool)
        new[1:] = anchors[1:] != anchors[:-1]
        first = np.flatnonzero(new)
        self.start, self.anchor = starts[first], anchors[first]
        self.last = starts[np.append(first[1:] - 1, len(starts) - 1)]
        self.hash = grams[self.anchor]
        self.row = np.searchsorted(piece.offsets, self.start, "right") - 1
        # the anchor with as many bytes after it, and before it; 0 where the text has none
        right, left = self.anchor + GRAM, self.anchor - GRAM
        end, begin = piece.offsets[self.row + 1] - GRAM, piece.offsets[self.row]
        after = W.mixed(self.hash + grams[np.minimum(right, len(grams) - 1)] * _SEED)
        ahead = W.mixed(grams[np.maximum(left, 0)] + self.hash * _SEED)
        self.after = np.where(right <= end, np.maximum(after, np.uint64(1)), np.uint64(0))
        self.ahead = np.where(left >= begin, np.maximum(ahead, np.uint64(1)), np.uint64(0))

    def keep(self, mask: np.ndarray) -> None:
        for name in ("row", "start", "last", "anchor", "hash", "after", "ahead"):
            setattr(self, name, getattr(self, name)[mask])

    def keep_known(self, known) -> None:
        """Drop what cannot hold a repeated string: 50 bytes around an anchor reach 16 bytes beyond it on one
        side at least, so one of its two longer hashes has been seen in another text."""
        self.keep(((self.after != 0) & known.has(self.after)) | ((self.ahead != 0) & known.has(self.ahead)))

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each stretch and the place of its anchor (see ``stretch_codes``)."""
        end = self.last + self.length
        sums = np.zeros(len(self.piece.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[self.piece.data] * W.powers(len(self.piece.data)), out=sums[1:])
        value = (sums[end] - sums[self.start]) * _inverse_powers(len(self.piece.data) + 1)[self.start]
        return _codes(value, end - self.start, self.anchor - self.start)


def _codes(value: np.ndarray, size: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = W.mixed(value + (size * 128 + before).astype(np.uint64))
    return value.view(np.int64), (W.mixed(value ^ _SEED + before.astype(np.uint64)) >> np.uint64(41)).astype(np.int64)


def stretch_codes(stretches: list[bytes], before: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of stretches given as bytes, with the number of bytes before the anchor."""
    size = np.array([len(x) for x in stretches], dtype=np.int64)
    data = np.frombuffer(b"".join(stretches), dtype=np.uint8)
    at = np.cumsum(size) - size
    within = np.arange(len(data)) - np.repeat(at, size)
    value = np.add.reduceat(_BYTES[data] * W.powers(int(size.max()))[within], at)
    return _codes(value, size, np.array(before, dtype=np.int64))


# --- 1. repeated anchors


def _anchor_hashes(batch) -> np.ndarray:
    """The longer hashes of the anchors of each text, once for a text."""
    out = [np.zeros(0, dtype=np.uint64)]
    for piece in W.pieces(batch.column(0), STRETCH_BYTES):
        own = Stretches(piece)
        for hashes in (own.after, own.ahead):
            some = hashes != 0
            rows, hashes = own.row[some], hashes[some]
            mine = np.unique(hashes ^ W.mixed(rows.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
            out.append(hashes[mine])
    return np.concatenate(out)


# --- 2. sorted, front-coded runs


def front_coded(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Shared prefix lengths, lengths of the rest, and the rests of sorted suffixes (shorter than 256 bytes)."""
    size = np.array([len(x) for x in suffixes], dtype=np.int64)
    width = int(size.max())
    table = np.zeros((len(suffixes), width), dtype=np.uint8)
    data = np.frombuffer(b"".join(suffixes), dtype=np.uint8)
    filled = np.arange(width)[None, :] < size[:, None]
    table[filled] = data
    differ = np.ones((len(suffixes), width + 1), dtype=bool)
    differ[1:, :width] = table[1:] != table[:-1]
    differ[0, :] = True
    shared = np.minimum(differ.argmax(1), size)
    shared[1:] = np.minimum(shared[1:], size[:-1])
    rest = filled & (np.arange(width)[None, :] >= shared[:, None])
    return shared.astype(np.uint8).tobytes(), (size - shared).astype(np.uint8).tobytes(), table[rest].tobytes()


def _run_rows(sent, bucket_power: int):
    """A run for every ``RUN_BYTES`` of text and bucket; the suffixes of one bucket exist at a time."""

    def run(batches):
        known = sent.value
        for batch in batches:
            ids = batch.column(1).to_numpy()
            for part in W.pieces(batch.column(0), RUN_BYTES):
                yield from _runs_of(part, ids, known, bucket_power)
        pa.default_memory_pool().release_unused()

    return run


def _runs_of(part: W.Piece, ids: np.ndarray, known, bucket_power: int):
    found = []
    row = 0
    while row < part.rows:
        last = int(np.searchsorted(part.offsets, part.offsets[row] + STRETCH_BYTES, "right")) - 1
        last = min(max(last, row + 1), part.rows)
        base = part.offsets[row]
        own = Stretches(W.Piece(row, part.data[base: part.offsets[last]], part.offsets[row: last + 1] - base))
        own.keep_known(known)
        found.append((own.hash >> np.uint64(64 - bucket_power), own.start + base, own.last + (LENGTH + base),
                      own.anchor + base, own.row + row))
        row = last
    bucket, start, end, anchor, row = (np.concatenate(x) for x in zip(*found))
    bucket, docs = bucket.astype(np.int64), ids[row + part.first_row]
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    text = part.data.tobytes()
    for own in np.split(order, cuts[1:]) if len(order) else ():
        least: dict[bytes, int] = {}
        several = set()
        for s, e, k, doc in zip(start[own].tolist(), end[own].tolist(), anchor[own].tolist(), docs[own].tolist()):
            suffix = text[k:e] + text[s:k][::-1] + bytes((e - k,))
            seen = least.setdefault(suffix, doc)
            if seen != doc:
                several.add(suffix)
                if doc < seen:
                    least[suffix] = doc
        yield _run_batch(int(bucket[own[0]]), least, several)


def _packed(data) -> bytes:
    return pa.Codec("zstd", compression_level=6).compress(data, asbytes=True)


def _planes(docs: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes before all second ones: the leading ones are nearly all alike."""
    return docs.view(np.uint8).reshape(-1, 8).T.tobytes()


def _of_planes(data: bytes) -> bytes:
    return np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.tobytes()


def _run_batch(bucket: int, least: dict[bytes, int], several: set[bytes]) -> pa.RecordBatch:
    order = sorted(least)
    shared, size, rest = front_coded(order)
    docs = np.array([least[x] for x in order], dtype=np.int64)
    many = bytes(x in several for x in order)
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([len(order)], pa.int32()), pa.array([len(rest)], pa.int64()),
         *(pa.array([_packed(x)], pa.binary()) for x in (shared, size, rest, _planes(docs), many))],
        names=["bucket", "items", "bytes", *_RUN])


_RUN = ["shared", "size", "rest", "docs", "many"]


# --- 3. merge


def run_items(shared: bytes, size: bytes, rest: bytes, docs: bytes, many: bytes):
    """(prefix shared with the one before, suffix, least doc, whether in several) of a front-coded run."""
    at, suffix = 0, b""
    for keep, n, low, several in zip(shared, size, memoryview(docs).cast("q"), many):
        suffix = suffix[:keep] + rest[at: at + n]
        at += n
        yield keep, suffix, low, several


def _unpacked(row: dict):
    sizes = {"shared": row["items"], "size": row["items"], "rest": row["bytes"], "docs": 8 * row["items"], "many": row["items"]}
    run = {k: pa.decompress(row[k], decompressed_size=n, codec="zstd", asbytes=True) if n else b"" for k, n in sizes.items()}
    return {**run, "docs": _of_planes(run["docs"])}


def merged(runs):
    """(prefix shared with the one before, suffix, least doc, whether in several) of sorted runs, in order.

    A loser tree: a node holds the run that lost there and how long a prefix it shares with the winner that
    went up. Only candidates that share equally long prefixes with the last output are compared, from the
    end of that prefix on.
    """
    runs = [iter(r) for r in runs]
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list = [None] * leaves
    prefix = [-1] * leaves
    for k, r in enumerate(runs):
        heads[k] = next(r, None)
        prefix[k] = 0 if heads[k] is not None else -1
    loser = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); sets the loser's prefix."""
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        if prefix[a] < 0:
            return a, b
        x, y, n = heads[a][1], heads[b][1], prefix[a]
        while x[n: n + 16] == y[n: n + 16] and n < len(x) and n < len(y):
            n += 16
        top = min(len(x), len(y))
        n = min(n, top)
        while n < top and x[n] == y[n]:
            n += 1
        if x[n: n + 1] <= y[n: n + 1]:
            prefix[b] = n
            return a, b
        prefix[a] = n
        return b, a

    level = list(range(leaves))
    node = leaves
    while len(level) > 1:
        node //= 2
        up = []
        for k in range(0, len(level), 2):
            winner, lost = play(level[k], level[k + 1])
            loser[node + k // 2] = lost
            up.append(winner)
        level = up
    winner = level[0]
    while heads[winner] is not None:
        _, suffix, low, several = heads[winner]
        yield prefix[winner], suffix, low, several
        heads[winner] = head = next(runs[winner], None)
        prefix[winner] = head[0] if head is not None else -1
        node = (leaves + winner) // 2
        while node:
            other = loser[node]
            # the frequent case first: unequal prefixes decide without a look at the suffixes
            if prefix[other] > prefix[winner]:
                loser[node], winner = winner, other
            elif prefix[other] == prefix[winner]:
                winner, loser[node] = play(winner, other)
            node //= 2


def _stretch(suffix: bytes) -> tuple[bytes, bytes]:
    """(before the anchor, from the anchor on)."""
    n = suffix[-1]
    return suffix[n:-1][::-1], suffix[:n]


def _common(a: bytes, b: bytes) -> int:
    """Bytes of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _pair_rows(one: list, two: list, out: list[tuple]) -> None:
    """``_group_rows`` for two suffixes: what their stretches share is one run of strings, told by the bytes both have on
    each side of the start of the anchor."""
    (x, low_x, several_x), (y, low_y, several_y) = one, two
    n, m = x[-1], y[-1]
    first = max(LENGTH - _common(x[:n], y[:m]), 0)
    last = _common(x[n:-1], y[m:-1])
    both = (min(low_x, low_y), several_x or several_y or low_x != low_y)
    for suffix, n, own in ((x, n, (low_x, several_x)), (y, m, (low_y, several_y))):
        before = len(suffix) - 1 - n
        whole, end = suffix[n:-1][::-1] + suffix[:n], before + n - LENGTH
        # strings go by how far before the anchor they begin
        begin, stop = max(before - last, 0), min(before - first, end)
        if begin > stop or both == own:
            runs = ((0, end, own),)
        else:
            runs = ((0, begin - 1, own), (begin, stop, both), (stop + 1, end, own))
        for lo, hi, (low, several) in runs:
            if several and lo <= hi:
                out.append((whole, before, lo, hi, low))


def _group_rows(group: list[list], out: list[tuple]) -> None:
    """For suffixes with one anchor: (stretch, bytes before, first and last string, least doc) where a
    string is in several documents."""
    low = group[0][1]
    if not any(g[2] or g[1] != low for g in group):
        return
    if len(group) == 1:
        before, after = _stretch(group[0][0])
        out.append((before + after, len(before), 0, len(before) + len(after) - LENGTH, low))
        return
    if len(group) == 2:
        _pair_rows(*group, out)
        return
    stretches = []
    for suffix, _, _ in group:
        before, after = _stretch(suffix)
        stretches.append((before + after, len(before), [None] * (len(before) + len(after) - LENGTH + 1)))
    results: dict[tuple[int, bool], tuple[int, bool]] = {}
    if len(group) <= FEW:
        by_ahead: list[dict[bytes, tuple[int, bool]]] = [{} for _ in range(LENGTH - GRAM + 1)]
        held = []
        for (whole, before, own), (_, low, several) in zip(stretches, group):
            tables = [by_ahead[before - k] for k in range(len(own))]
            keys = [whole[k: k + LENGTH] for k in range(len(own))]
            held.append((own, tables, keys))
            for strings, key in zip(tables, keys):
                seen = strings.setdefault(key, (low, several))
                if seen[0] != low or several and not seen[1]:
                    strings[key] = (min(seen[0], low), True)
        for own, tables, keys in held:
            own[:] = [strings[key] for strings, key in zip(tables, keys)]
    # in larger groups strings that begin equally far before the anchor are looked at together, and only those are held
    for ahead in range(LENGTH - GRAM + 1) if len(group) > FEW else ():
        strings: dict[bytes, tuple[int, bool]] = {}
        inside = [(x, before - ahead, low, several) for (x, before, own), (_, low, several) in zip(stretches, group)
                  if 0 <= before - ahead < len(own)]
        for whole, k, low, several in inside:
            key = whole[k: k + LENGTH]
            seen = strings.get(key)
            if seen is None:
                strings[key] = (low, several)
            elif seen[0] != low or several and not seen[1]:
                strings[key] = (min(seen[0], low), True)
        for whole, before, own in stretches:
            k = before - ahead
            if 0 <= k < len(own):
                found = strings[whole[k: k + LENGTH]]
                own[k] = results.setdefault(found, found)
    for whole, before, own in stretches:
        begin = 0
        while begin < len(own):
            end = begin
            while end + 1 < len(own) and own[end + 1] == own[begin]:
                end += 1
            if own[begin][1]:
                out.append((whole, before, begin, end, own[begin][0]))
            begin = end + 1


_FOUND = "code long, mark long, first int, last int, low long"


def _found_table(out: list[tuple]) -> pa.RecordBatch:
    code, mark = stretch_codes([o[0] for o in out], [o[1] for o in out])
    _, _, first, last, low = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(code), pa.array(mark), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(low, pa.int64())],
        names=["code", "mark", "first", "last", "low"])


def _merge_bucket(table):
    rows = table.drop_columns(["bucket"]).to_pylist()
    out: list[tuple] = []
    done = []
    group: list[list] = []
    for prefix, suffix, low, several in merged([run_items(**_unpacked(r)) for r in rows]):
        if prefix < GRAM:
            if group:
                _group_rows(group, out)
            if len(out) >= 10_000:
                done.append(_found_table(out))
                out = []
            group = [[suffix, low, several]]
        elif group[-1][0] == suffix:
            last = group[-1]
            last[1], last[2] = min(last[1], low), last[2] or several or last[1] != low
        else:
            group.append([suffix, low, several])
    if group:
        _group_rows(group, out)
    if out:
        done.append(_found_table(out))
    pa.default_memory_pool().release_unused()
    if done:
        return pa.Table.from_batches(done)
    return pa.schema([("code", pa.int64()), ("mark", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                      ("low", pa.int64())]).empty_table()


# --- 4. occurrences and removal


def _occurrence_rows(sent):
    def run(batches):
        known = sent.value
        for batch in batches:
            found, size = [], 0
            for piece in W.pieces(batch.column(0), STRETCH_BYTES):
                own = Stretches(piece)
                own.keep_known(known)
                code, mark = own.codes() if len(own.row) else (own.row, own.row)
                found.append((code, (mark << 40) | (own.start - piece.offsets[own.row]), own.row + piece.first_row))
                size += len(piece.data)
                if size >= W.PIECE_BYTES:
                    yield _place_rows(batch, found)
                    found, size = [], 0
            if found:
                yield _place_rows(batch, found)

    return run


def _place_rows(batch, found: list[tuple]) -> pa.RecordBatch:
    code, place, row = (np.concatenate(x) for x in zip(*found))
    rows = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(code), pa.array(place), batch.column(1).take(rows), batch.column(2).take(rows)],
        names=["code", "place", "doc_id", "row_key"])


def _removal_rows(batches):
    for batch in batches:
        data, offsets = W.flat_text(batch.column(0))
        spans = batch.column(2)
        out = []
        for r, own in enumerate(spans.to_pylist()):
            text = data[offsets[r]: offsets[r + 1]]
            if not own:
                out.append((len(text), [], hashlib.sha256(text.tobytes()).hexdigest()))
                continue
            own = np.sort(np.array(own, dtype=np.int64))
            start = own >> 8
            end = np.maximum.accumulate(start + (own & 255))
            new = np.ones(len(start), dtype=bool)
            new[1:] = start[1:] > end[:-1]
            first = np.flatnonzero(new)
            start, end = start[first], end[np.append(first[1:] - 1, len(end) - 1)]
            digest, at = hashlib.sha256(), 0
            for s, e in zip(start.tolist(), end.tolist()):
                digest.update(text[at:s].tobytes())
                at = e
            digest.update(text[at:].tobytes())
            out.append((len(text), list(zip(start.tolist(), end.tolist())), digest.hexdigest()))
        sizes, cut, kept = zip(*out) if out else ((), (), ())
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(sizes, pa.int64()),
             pa.array([[{"start": s, "end": e} for s, e in c] for c in cut], pa.list_(span)), pa.array(kept, pa.string())],
            names=["doc_id", "n_bytes", "removed", "kept_sha256"])


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (spans of bytes, in order) and kept_sha256 of every row of ``documents``.

    A byte is removed if a 50-byte string covers it that also starts in a document with a smaller doc_id. A
    null text is empty; texts under 50 bytes lose nothing. Rows without a doc_id lose nothing and take
    nothing from others. Rows that repeat a doc_id are one document in that they take nothing from each
    other. Only doc_id and text are read. An empty table gives an empty one.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    texts = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bucket_power = max(size // BUCKET_BYTES, 1).bit_length()
    known = spark.sparkContext.broadcast(
        filter_of(texts.select("text"), _anchor_hashes, 2 * size // ANCHOR_BYTES, twice=True))
    found = stored(
        texts.mapInArrow(_run_rows(known, bucket_power),
                         "bucket int, items int, bytes long, shared binary, size binary, rest binary, docs binary, many binary")
        .groupBy("bucket").applyInArrow(_merge_bucket, _FOUND), "repeated-stretches")
    keyed = texts.withColumn("row_key", F.hash("text"))
    places = keyed.select("text", "doc_id", "row_key").mapInArrow(
        _occurrence_rows(known), "code long, place long, doc_id long, row_key int")
    mark = F.shiftright("place", 40)
    at = F.col("place").bitwiseAND(F.lit((1 << 40) - 1))
    spans = (
        places.hint("merge").join(found, "code").filter((mark == F.col("mark")) & (F.col("low") < F.col("doc_id")))
        .select("doc_id", "row_key",
                (F.shiftleft(at + F.col("first"), 8) + (F.col("last") - F.col("first") + LENGTH)).alias("span"))
        .groupBy("doc_id", "row_key").agg(F.collect_list("span").alias("spans"))
    )
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.hash("l.text") == F.col("r.row_key"))
    return (
        rows.alias("l").join(spans.hint("merge").alias("r"), same, "left").select("l.text", "l.doc_id", "r.spans")
        .mapInArrow(_removal_rows, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept_sha256 string")
    )


def report(documents: DataFrame) -> DataFrame:
    """The digest of ``repeated_spans``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    length = F.transform("removed", lambda s: s["end"] - s["start"])
    return repeated_spans(documents).select(
        "doc_id", "n_bytes",
        F.aggregate(length, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), "kept_sha256",
    )
