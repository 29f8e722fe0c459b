"""The pipeline's stages, each on what the one before kept, and the registered queries."""

import brute
import corpus_pipeline
import pytest
from compare import check, duck
from pyspark.sql import functions as F

from tracewell.llm import line_dedup, packing, toxicity
from tracewell.llm.queries import all_oracles, all_queries
from tracewell.llm.tables import stored, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "step")
        out.append((name, docs, after))
        docs = after
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_columns(steps):
    assert [name for name, _, _ in steps] == [
        "toxicity", "line dedup", "near-duplicates", "decontamination", "packing"]
    for _, before, after in steps[:-1]:
        assert after.dtypes == before.dtypes


def test_toxicity_stage(spark, steps):
    _, before, after = steps[0]
    found = toxicity.report(before, table(spark, SF, "labels"))
    assert ids(after) == ids(found.filter("not rejected"))


def test_line_stage(steps):
    _, before, after = steps[1]
    assert ids(after) == ids(before)
    assert after.filter("n_chars <> length(text)").count() == before.filter("n_chars <> length(text)").count()
    left = dict(texts(line_dedup.without_repeated_lines(before)))
    assert dict(texts(after)) == left
    lines = [x for t in left.values() for x in t.split("\n") if len(brute.words(x, brute.ALNUM)) >= line_dedup.MIN_WORDS]
    normal = [tuple(brute.words(x, brute.ALNUM)) for x in lines]
    assert len(set(normal)) == len(normal)


def test_near_duplicate_stage(steps):
    _, before, after = steps[2]
    assert ids(after) == sorted(d for d, _, _, kept in brute.near_duplicates(texts(before)) if kept)


def test_decontamination_stage(spark, steps):
    _, before, after = steps[3]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert ids(after) == sorted(r[0] for r in brute.contaminated(texts(before), items) if not r[5])


def test_packing_stage(steps):
    _, before, after = steps[4]
    pieces = after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == {d: len(t.split()) for d, t in texts(before) if t.split()}
    bins = after.groupBy("shard", "bin").agg(F.sum("length").alias("n"), F.max("capacity").alias("c")).collect()
    assert all(r.c == min(c for c in packing.CAPACITIES if c >= r.n) for r in bins)


def test_run_is_all_stages(spark, steps):
    def rows(frame):
        return sorted(map(tuple, frame.collect()))

    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[-1][2])


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_queries_match_their_twins(spark, name):
    problem, n = check(spark, duck(SF), name, all_queries()[name], all_oracles()[name], SF)
    assert problem is None and n > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    got = all_queries()["op2_toxicity"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r.score for r in got if r.toxic == 1], [r.score for r in got if r.toxic == 0]
    ranked = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert len(toxic) > 50 and ranked > 0.9
