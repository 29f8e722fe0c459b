"""Longest-processing-time scheduling against a plain heap."""

import heapq
import random
import zlib
from collections import defaultdict

import pytest

from tracewell.llm import sharding


def plain_deal(loads, size, count):
    heap = [(load, k) for k, load in enumerate(loads)]
    heapq.heapify(heap)
    taken = [0] * len(loads)
    for _ in range(count):
        load, k = heapq.heappop(heap)
        taken[k] += 1
        heapq.heappush(heap, (load + size, k))
    return taken


@pytest.mark.parametrize("seed", range(40))
def test_many_equal_groups_at_once(seed):
    rng = random.Random(seed)
    loads = [rng.choice([0, 5, rng.randrange(10_000)]) for _ in range(rng.choice([1, 3, 24]))]
    size, count = rng.choice([1, 8, 97, 5000]), rng.choice([1, 96, 97, 500, 3000])
    assert sharding.deal(loads, size, count) == plain_deal(loads, size, count)


def check(spark, rows, shards):
    documents = spark.createDataFrame(rows, "doc_id long, text string, shard string, size string, key string")
    got = sharding.assign(documents.repartition(3), shards).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 8
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows), key=repr)
    groups = defaultdict(int)
    for _, t, *_ in rows:
        groups[t or ""] += size(t)
    loads = [0] * shards
    for total in sorted(groups.values(), reverse=True):
        loads[loads.index(min(loads))] += total
    own, slots, where = [0] * shards, defaultdict(list), defaultdict(set)
    for r in got:
        own[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[r.text_crc32, r.size].add(r.shard)
    assert own == loads
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    for s in slots:
        order = [((r.doc_id is not None, r.doc_id or 0), r.size, r.text_crc32) for r in sorted(got, key=lambda r: r.slot) if r.shard == s]
        assert order == sorted(order)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (1, None), (2, ""), (3, "a"), (3, "a"), (4, "é🙂"), (5, "x" * 100_000), (6, "b"), (6, "c")]
    check(spark, [(*r, "own", "own", "own") for r in rows], 3)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign(empty).count() == 0


def test_hot_group_and_many_equal_sizes(spark):
    rng = random.Random(7)
    rows = [(k, "copy " * 40) for k in range(1500)]
    rows += [(k, f"{rng.randrange(10**6):06d}") for k in range(1500, 4500)]
    rows += [(k, "y" * rng.randrange(400)) for k in range(4500, 4700)]
    check(spark, [(*r, None, None, None) for r in rows], 24)


def test_wrong_parameters(spark):
    with pytest.raises(ValueError):
        sharding.assign(spark.createDataFrame([], "doc_id long, text string"), 0)
