"""Streams must end at the batch answer, also with repeated and late files."""

import json

from pyspark.sql import functions as F

from tracewell import schemas
from tracewell.operators.training_log import early_stop
from tracewell.streaming import live

RESULT = "id STRING, finished_at STRING, reward DOUBLE"


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows))


def run_upsert(spark, stream, keys, base):
    table = live.UpsertTable(spark, str(base / "out"), keys)
    table.start(stream, str(base / "state")).awaitTermination()
    return table


def read(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(path))


def test_early_stop_equals_batch_in_any_file_order(spark, tmp_path):
    log = [{"run_id": r, "step": i, "loss": (r + 1) / (i + 1)} for r in (0, 1) for i in range(20)]
    for n, start in enumerate((30, 0, 20, 10)):
        write_lines(tmp_path / "in" / f"{n}.json", log[start:start + 10])
    stream = live.live_early_stop(read(spark, tmp_path / "in", schemas.LOSS_LOG))
    table = run_upsert(spark, stream, ["run_id"], tmp_path)
    batch = early_stop(spark.createDataFrame(
        [(x["run_id"], x["step"], x["loss"]) for x in log], schemas.LOSS_LOG))
    assert sorted(table.read().collect()) == sorted(batch.collect())

    # More files later: the stream goes on from its checkpoint.
    write_lines(tmp_path / "in" / "9.json", [{"run_id": 2, "step": 5, "loss": 0.01}])
    again = live.live_early_stop(read(spark, tmp_path / "in", schemas.LOSS_LOG))
    table.start(again, str(tmp_path / "state")).awaitTermination()
    assert [tuple(r) for r in table.read().filter("run_id = 2").collect()] == [(2, 1, 5, 0.01, 0.01)]


def test_success_counts_each_trial_once(spark, tmp_path):
    rows = [{"id": str(i), "finished_at": f"2026-01-11T22:{i:02}:00.000001", "reward": float(i % 2)}
            for i in range(40)]
    write_lines(tmp_path / "in" / "1.json", rows[:25])
    write_lines(tmp_path / "in" / "2.json", rows[20:])
    write_lines(tmp_path / "in" / "3.json", rows[5:15])
    counts = live.live_success(read(spark, tmp_path / "in", RESULT), F.to_timestamp_ntz("finished_at"))
    out = run_upsert(spark, counts, ["bucket_start"], tmp_path).read().orderBy("bucket_start").collect()
    assert [(r.n_finished, r.n_passes) for r in out] == [(10, 5)] * 4


def test_trials_behind_the_watermark_are_left_out(spark, tmp_path):
    on_time = [{"id": "a", "finished_at": "2026-01-11T22:00:00", "reward": 1.0}]
    write_lines(tmp_path / "in" / "1.json", on_time)
    base = tmp_path
    start = lambda: run_upsert(
        spark, live.live_success(read(spark, tmp_path / "in", RESULT), F.to_timestamp_ntz("finished_at")),
        ["bucket_start"], base)
    start()
    write_lines(tmp_path / "in" / "2.json", [{"id": "late", "finished_at": "2026-01-11T10:00:00", "reward": 1.0}])
    table = start()
    assert table.read().agg(F.sum("n_finished")).first()[0] == 1


def test_adapter_activity(spark, tmp_path):
    lines = [('vllm:lora_requests_info{running_lora_adapters="a"} 2', "2026-01-11T22:00:01Z"),
             ('vllm:lora_requests_info{running_lora_adapters="a"} 5', "2026-01-11T22:00:31Z"),
             ('vllm:lora_requests_info{running_lora_adapters=""} 1', "2026-01-11T22:01:01Z"),
             ("process_open_fds 9", "2026-01-11T22:01:01Z")]
    write_lines(tmp_path / "in" / "1.json", [{"line": a, "scraped_at": b} for a, b in lines])
    scrapes = read(spark, tmp_path / "in", "line STRING, scraped_at TIMESTAMP")
    out = run_upsert(spark, live.live_adapter_activity(scrapes, "running_lora_adapters"),
                     ["bucket_start", "name", "label"], tmp_path).read()
    assert sorted((r.label, r.max_value, r.n_lines) for r in out.collect()) == [("", 1.0, 1), ("a", 5.0, 2)]


def test_format_stream(spark, tmp_path):
    write_lines(tmp_path / "in" / "1.json", [
        {"conv_id": 1, "conversations": [{"from": "human", "content": "a"}, {"role": "bot", "content": "b"}]},
        {"conv_id": 2, "conversations": [{"role": "user", "content": "a"}]}])
    stream = live.live_format(read(spark, tmp_path / "in", schemas.CONVERSATIONS))
    live.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.conv_id, r.n_turns) for r in rows] == [(1, 2)]


def test_result_files_as_they_land(spark, tmp_path):
    def land(name, reward):
        folder = tmp_path / "run" / name
        folder.mkdir(parents=True)
        (folder / "config.json").write_text("{}")
        (folder / "result.json").write_text(json.dumps(
            {"id": name, "trial_name": name, "finished_at": "2026-01-11T22:05:00.000001",
             "verifier_result": {"rewards": {"reward": reward}}}, indent=4))

    def go():
        results = live.result_stream(spark, str(tmp_path / "run"), files_per_batch=1)
        counts = live.live_success(results, F.to_timestamp_ntz("finished_at"))
        return run_upsert(spark, counts, ["bucket_start"], tmp_path).read().collect()

    land("a__1", 1.0), land("b__2", 0.0)
    assert [(r.n_finished, r.n_passes) for r in go()] == [(2, 1)]
    land("c__3", 1.0)
    assert [(r.n_finished, r.n_passes) for r in go()] == [(3, 2)]


def test_scrapes_as_they_land(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = live.ActivityTable(spark, str(tmp_path / "out"), "running_lora_adapters")
    for n, value in enumerate((2, 7, 3)):
        (tmp_path / "in" / f"{n}.txt").write_text(f'vllm:lora_requests_info{{running_lora_adapters="a"}} {value}')
        table.start(live.metric_stream(spark, str(tmp_path / "in")), str(tmp_path / "state")).awaitTermination()
    rows = table.read().groupBy("label").agg(F.max("max_value").alias("m"), F.sum("n_lines").alias("n")).collect()
    assert [(r.label, r.m, r.n) for r in rows] == [("a", 7.0, 3)]


def test_activity_as_a_streaming_aggregation(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text('vllm:lora_requests_info{running_lora_adapters="a"} 2')
    activity = live.live_adapter_activity(
        live.metric_stream(spark, str(tmp_path / "in")), "running_lora_adapters")
    rows = run_upsert(spark, activity, ["bucket_start", "name", "label"], tmp_path).read().collect()
    assert [(r.label, r.max_value) for r in rows] == [("a", 2.0)]
