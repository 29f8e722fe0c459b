"""Run stores: what a manifest names counts, whatever happens between the steps of a batch."""

import os

import pytest
from pyspark.sql import functions as F

from tracewell.streaming import live
from tracewell.streaming.runs import KEPT, RunStore, Table

SUMS = Table("sums", ("k",), {"n": "sum", "top": "max"})
NEWEST = Table("newest", ("k",))


def batch(spark, b):
    return spark.createDataFrame([(b % 3, 1, b), (None, 1, -b)], "k int, n long, top long")


def take(store, b):
    rows = batch(store.spark, b)
    store.commit(b, [(SUMS, store.write_run(SUMS, b, rows)), (NEWEST, store.write_run(NEWEST, b, rows))], last=b)


def answers(store, table):
    return sorted((tuple(r) for r in store.read(table).collect()), key=repr)


def test_many_batches_leave_few_runs(spark, tmp_path):
    store = RunStore(spark, str(tmp_path), fan=3)
    n = 25
    for b in range(n):
        take(store, b)
    # two runs of each power of three at most: 25 = 221 in base three
    assert len(store.runs("sums")) <= 2 * 3 and len(store.runs("newest")) <= 2 * 3
    last = {k: max(b for b in range(n) if b % 3 == k) for k in range(3)}
    assert answers(store, SUMS) == sorted([*((k, -(-(n - k) // 3), last[k]) for k in last), (None, n, 0)], key=repr)
    assert answers(store, NEWEST) == sorted([*((k, 1, last[k]) for k in last), (None, 1, 1 - n)], key=repr)
    assert len(os.listdir(tmp_path / "manifest")) <= 2 * KEPT + 2  # with check sums
    assert len(os.listdir(tmp_path / "sums")) <= 2 * 3 + 4 * KEPT
    assert store.manifest()["notes"] == {"last": n - 1} and store.manifest()["batch"] == n - 1


@pytest.mark.parametrize("stop", ["first run", "all runs", "draft", "commit", "merge"])
def test_a_crash_at_any_step_loses_nothing(spark, tmp_path, stop, monkeypatch):
    store = RunStore(spark, str(tmp_path), fan=3)
    take(store, 0), take(store, 1)

    class Crash(Exception):
        pass

    def crash(*_, **__):
        raise Crash

    real = RunStore._swap
    with monkeypatch.context() as m:
        if stop == "first run":
            m.setattr(RunStore, "commit", crash)
        if stop == "all runs":
            m.setattr(RunStore, "_swap", crash)
        if stop == "draft":
            m.setattr(RunStore, "_swap", lambda self, v, x: (self._files().create(self._at("manifest", f"_draft-{v:08}.json"), True).close(), crash()))
        if stop == "commit":
            m.setattr(RunStore, "_compact", crash)
        if stop == "merge":  # the third batch fills a level; its merged run is written, its manifest is not
            calls = []
            m.setattr(RunStore, "_swap", lambda self, v, x: crash() if calls else (calls.append(v), real(self, v, x)))
        with pytest.raises(Crash):
            take(store, 2)
    seen = []
    again = store.each_batch(lambda rows, b, now: (seen.append(b), take(store, b)))
    again(batch(spark, 2), 2)  # the stream gives the batch again
    assert seen == ([] if stop in ("commit", "merge") else [2])
    assert answers(store, SUMS) == sorted([(0, 1, 0), (1, 1, 1), (2, 1, 2), (None, 3, 0)], key=repr)
    take(store, 3)
    assert answers(store, NEWEST) == sorted([(0, 1, 3), (1, 1, 1), (2, 1, 2), (None, 1, -3)], key=repr)
    assert len(store.runs("sums")) <= 3


def test_two_writers(spark, tmp_path):
    one, two = RunStore(spark, str(tmp_path)), RunStore(spark, str(tmp_path))
    take(one, 0)
    stale = {"version": 0, "batch": -1, "notes": {}, "tables": {}}
    two.manifest = lambda: stale
    with pytest.raises(RuntimeError):
        take(two, 0)
    assert answers(one, SUMS) == sorted([(0, 1, 0), (None, 1, 0)], key=repr)


def test_empty_store(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "none"))
    assert store.runs("sums") == [] and store.rows("sums", "k INT").count() == 0
    with pytest.raises(ValueError):
        store.rows("sums")
    store.commit(0, [(SUMS, store.write_run(SUMS, 0, batch(spark, 0).limit(0)))])
    assert store.read(SUMS).count() == 0


def test_late_trials_correct_closed_windows(spark, tmp_path):
    counts = live.SuccessCounts(spark, str(tmp_path / "out"))
    landed = []

    def land(*rows):
        landed.extend(rows)
        frame = spark.createDataFrame(list(rows), "id string, finished_at string, reward double")
        frame.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema("id STRING, finished_at STRING, reward DOUBLE").json(str(tmp_path / "in"))
        counts.start(stream, F.to_timestamp_ntz("finished_at"), str(tmp_path / "state")).awaitTermination()

    at = "2026-01-11T{}:00".format
    land(("a", at("22:00"), 1.0), ("b", at("22:05"), 0.0), ("a", at("22:00"), 1.0), (None, at("22:00"), 1.0), ("x", None, 1.0))
    land(("c", at("23:30"), None), ("d", at("21:55"), 1.0))  # 21:55 is open: the watermark is 21:05
    assert counts.late_trials().count() == 0
    land(("e", at("22:01"), 1.0), ("a", at("22:00"), 1.0), ("f", at("22:25"), 1.0), ("e", at("22:01"), 1.0))  # watermark 22:30
    assert sorted((r.id, r.n_landed, r.corrects) for r in counts.late_trials().collect()) == [("a", 1, False), ("e", 2, True), ("f", 1, True)]
    assert [tuple(r) for r in counts.late_counts().collect()] == [(2, 4, 2)]
    land(("e", at("22:01"), 1.0))
    unique = {(i, t): r for i, t, r in landed if i and t}
    want = {}
    for (_, t), r in unique.items():
        key = t[11:15] + "0"
        n, p = want.get(key, (0, 0))
        want[key] = (n + 1, p + (r is not None and r >= 1))
    got = {r.bucket_start.strftime("%H:%M"): (r.n_finished, r.n_passes) for r in counts.read().collect()}
    assert got == want
    assert {r.bucket_start.strftime("%H:%M"): r.n_corrected for r in counts.read().collect() if r.n_corrected} == {"22:00": 1, "22:20": 1}
    assert counts.late_trials().count() == 4
