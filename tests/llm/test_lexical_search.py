"""Ranked search against scores worked out plainly."""

import math
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from tracewell.llm import lexical_search as search


def plain(rows, items, k=10):
    docs = [(d, Counter(brute.words(t, brute.ALNUM))) for d, t in rows]
    filled = [sum(c.values()) for _, c in docs if c]
    big_n, big_l = len(filled), sum(filled)
    df = Counter(t for _, c in docs for t in c)
    terms = defaultdict(set)
    for item, text in items:
        if item is not None:
            terms[item] |= set(brute.words(text, brute.ALNUM))
    out = []
    for item, own in terms.items():
        scores = []
        for d, c in docs:
            n = sum(c.values())
            if not n:
                continue
            m = 100 - 90 + (90 * n * big_n) // big_l
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, items, parts=2, **more):
    documents = spark.createDataFrame([(*r, "own", "own") for r in rows], "doc_id long, text string, term string, shard string")
    queries = spark.createDataFrame([(*r, "own") for r in items], "item_id long, text string, score string")
    index = search.build_index(documents.repartition(parts))
    return index, sorted(tuple(r) for r in search.search(index, queries, **more).collect())


@pytest.mark.parametrize("values", [[], [0], [1, 127, 128, 300, 0, 2**35], list(range(500))])
def test_bytes_round_trip(values):
    data, sizes = search.encoded(np.array(values, dtype=np.int64))
    assert int(sizes.sum()) == len(data) and search.decoded(data).tolist() == values


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 20_000)
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(150)]
    weights = [1 / (k + 1) for k in range(150)]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    rows = [(k, text(rng.choice([1, 5, 40, 200]))) for k in range(700)]
    rows += [(k, rows[3][1]) for k in range(700, 740)]
    items = [(k, text(rng.choice([1, 3, 12]))) for k in range(25)]
    index, got = run(spark, rows, items, parts=3)
    assert index.filter("term is null").count() > 3
    assert index.filter("term is not null and postings > 64").count() > 0
    want = plain(rows, items)
    assert got == want
    assert sorted(map(tuple, search.search(index, spark.createDataFrame(items, "item_id long, text string"), most=60).collect())) == want
    assert run(spark, rows, items, k=3)[1] == plain(rows, items, 3)


def test_blocks_are_rejected_unread(monkeypatch):
    """A long list that cannot change the best is not decompressed."""
    rng = np.random.default_rng(1)
    size = 2000
    common, rare = np.arange(size), np.sort(rng.choice(size, 30, replace=False))
    rows = list(search.shard_rows(0, list(range(size)), np.concatenate([np.full(size, 5), np.full(30, 9), np.full(size, 7)]).astype(np.uint64),
                                  np.concatenate([common, rare, common])))
    lengths = np.frombuffer(rows[0].column("body")[0].as_py(), dtype=np.int64)
    stats = search.Statistics(size, int(lengths.sum()))
    m = stats.damping(lengths)
    lists = {t: search.PostingList(w, h, b, stats, m) for (t, w), h, b in zip(
        ((5, 3), (7, 2), (9, 5000)), rows[1].column("heads").to_pylist(), rows[1].column("body").to_pylist())}
    docs, scores = search.best_of_shard(list(lists.values()), size, 10)
    assert set(docs.tolist()) <= set(rare.tolist()) and len(docs) >= 10
    assert lists[5].all is None and lists[7].all is None and len(lists[5].open) < len(lists[5].last)


def test_odd_rows(spark):
    rows = [(None, None), (None, "a b"), (1, ""), (2, "a b"), (3, "A, B!"), (4, "é🙂 a"), (4, "é🙂 a"), (5, "z " * 50_000), (6, "x" * 200_000)]
    items = [(1, "a"), (1, "É🙂 é🙂"), (2, None), (3, ""), (None, "a"), (4, "z z unknown"), (5, "x" * 200_000), (6, "nothing")]
    assert run(spark, rows, items)[1] == plain(rows, items)
    assert run(spark, rows, [])[1] == [] and run(spark, [], items)[1] == []
    assert run(spark, [(1, None)], [(1, "a")])[1] == []


def test_lengths_beyond_64_bits():
    stats = search.Statistics(10**15, 10**18)
    lengths = np.array([0, 10**7], dtype=np.int64)
    assert stats.damping(lengths).tolist() == [10, 10 + 10**7 * 90 * 10**15 // 10**18]
