"""Cut groups must give the rows an uncut window gives."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewell.operators.blocks import ordered
from tracewell.operators.quantiles import exact_quantiles

CUT = {"floor": 0, "pieces": 40}  # every key is hot
CUTS = [CUT, {}, {"floor": 100, "pieces": 16}]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [
        (None if rng.random() < 0.1 else ("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}"),
         i, rng.randint(0, 400), float(rng.randint(-20, 20)), rng.choice("xyz"))
        for i in range(3000)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, id long, t long, v double, c string").persist()


@pytest.mark.parametrize("cut", CUTS)
def test_number_rows(rows, cut):
    groups = ordered(rows, ["k"], ["t", "id"], **cut)
    got = groups.number("n").rows().select("id", "n")
    want = rows.select("id", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).alias("n"))
    assert sorted(got.collect()) == sorted(want.collect())
    if cut is CUT:
        assert groups.df.filter("k = 'hot'").select("_hot").distinct().collect() == [(True,)]
        blocks = groups.df.filter("k = 'hot'").groupBy("_block").count().collect()
        assert len(blocks) > 8 and max(r["count"] for r in blocks) < 250
    assert groups.is_cut == bool(cut)


def test_only_hot_keys_are_cut(rows):
    groups = ordered(rows, ["k"], ["t", "id"], floor=400, pieces=8)
    cut = groups.df.filter("_hot").select("k").distinct().collect()
    assert [r.k for r in cut] == ["hot"]


def _largest(groups):
    return groups.df.filter("_hot").groupBy(*groups.parts).count().agg(F.max("count")).first()[0]


def test_any_number_of_hot_keys(spark):
    rows = spark.range(30_000).select((F.col("id") % 3000).alias("k"), "id")
    groups = ordered(rows, ["k"], ["id"], floor=9)
    assert groups.df.filter("_hot").select("k").distinct().count() == 3000
    assert groups.number("n").rows().groupBy("k").agg(F.max("n").alias("m")).filter("m <> 10").count() == 0


def test_ties_of_the_first_order_column_are_cut(spark):
    rows = spark.range(5000).select(F.lit(1).alias("k"), F.lit(7).alias("t"), "id")
    groups = ordered(rows, ["k"], ["t", "id"], floor=500)
    assert _largest(groups) < 1500
    got = groups.number("n").previous("id", "p").rows()
    assert got.filter("n <> id + 1 or coalesce(p, -1) <> id - 1").count() == 0


def test_repeated_positions_are_counted(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("pos"), "id")
    assert ordered(rows, ["k"], ["pos"], floor=100).is_cut


def test_few_large_rows_are_hot(spark):
    rows = spark.range(20).select(F.lit(1).alias("k"), "id", F.repeat(F.lit("x"), 10_000).alias("text"))
    groups = ordered(rows, ["k"], ["id"], floor_bytes=50_000)
    assert groups.is_cut and _largest(groups) < 15


@pytest.mark.parametrize("how", ["sum", "min", "max"])
@pytest.mark.parametrize("cut", CUTS)
def test_running(rows, how, cut):
    groups = ordered(rows, ["k"], ["id"], **cut)
    got = groups.running(r=(F.col("v"), how)).rows().select("id", "r")
    frame = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("id", getattr(F, how)("v").over(frame).alias("r"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("cut", CUTS)
def test_running_over_everything(rows, cut):
    groups = ordered(rows, [], ["id"], **cut)
    got = groups.running(r=(F.col("v"), "sum")).rows().select("id", "r")
    want = rows.select("id", F.sum("v").over(Window.orderBy("id")).alias("r"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("cut", CUTS)
def test_totals(rows, cut, keys):
    groups = ordered(rows, keys, ["id"], **cut)
    got = groups.totals(s=(F.col("v"), "sum"), m=(F.col("t"), "max")).rows().select("id", "s", "m")
    whole = Window.partitionBy(*keys)
    want = rows.select("id", F.sum("v").over(whole).alias("s"), F.max("t").over(whole).alias("m"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("cut", CUTS)
def test_previous(rows, cut):
    groups = ordered(rows, ["k"], ["id"], **cut)
    got = groups.previous("c", "p").rows().select("id", "p")
    want = rows.select("id", F.lag("c").over(Window.partitionBy("k").orderBy("id")).alias("p"))
    key = lambda r: r.id
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


@pytest.mark.parametrize("cut", [CUT, {}])
def test_exact_quantiles(rows, cut):
    at = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(rows, ["k"], "v", at, **cut).collect()}
    values = {}
    for r in rows.collect():
        values.setdefault(r.k, []).append(r.v)
    assert set(got) == set(values)
    for k, v in values.items():
        for name, p in at.items():
            assert got[k][name] == pytest.approx(np.quantile(v, p))


def test_one_value_and_nulls(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", None), ("b", None)], "k string, v double")
    assert exact_quantiles(df, ["k"], "v", {"m": 0.5}, **CUT).collect() == [("a", 2.0)]
