"""Packing of what filters gather and of what suffix runs hold."""

import numpy as np
import pytest

from tracewell.llm import filters, substring_dedup


@pytest.mark.parametrize("values", [[0], [7, 7], [0, 0, (1 << 32) - 1, (1 << 32) - 1], [1, 256, 65536, 1 << 31]])
def test_packed_values_come_back(values):
    values = np.array(values, dtype=np.uint32)
    assert filters.unpacked(filters.packed(values), len(values)).tolist() == values.tolist()


def test_gathered_hashes_are_small():
    """Sorted hashes, of each at most two, in less than the four bytes that each had."""
    hashes = np.random.default_rng(5).integers(0, 1 << 63, 80_000, dtype=np.uint64) * np.uint64(2)
    rows = filters.bucket_rows(np.concatenate([hashes, hashes[:9], hashes[:9]]), 1)
    found = [(b, filters.unpacked(x, n)) for b, x, n in zip(*(rows.column(c).to_pylist() for c in ("bucket", "hashes", "count")))]
    got = np.concatenate([(np.uint64(b) << np.uint64(32)) | x.astype(np.uint64) for b, x in found])
    assert got.tolist() == np.sort(np.concatenate([hashes, hashes[:9]]) >> np.uint64(31)).tolist()
    assert sum(len(x) for x in rows.column("hashes").to_pylist()) < 2.7 * len(hashes)


def test_doc_ids_of_a_run_come_back_and_are_small():
    rng = np.random.default_rng(6)
    ids = [-(1 << 63), (1 << 63) - 1, 0, -1, *rng.integers(0, 250_000, 20_000).tolist()]
    least = {b"%016d" % k + b"x" * 34 + bytes((50,)): doc for k, doc in enumerate(ids)}
    row = substring_dedup._run_batch(3, least, {min(least)}).to_pylist()[0]
    got = list(substring_dedup.run_items(**substring_dedup._unpacked(row)))
    assert [(suffix, low) for _, suffix, low, _ in got] == sorted(least.items()) and [x[3] for x in got[:2]] == [1, 0]
    assert len(row["docs"]) < len(substring_dedup._packed(np.array(ids, dtype=np.int64).tobytes()))
