"""Trees of JSON documents and chains of exceptions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tracewell.functions import parsing
from tracewell.operators.documents import tree_differences, tree_leaves

CAUSE, CONTEXT = parsing.CHAIN_TEXTS["cause"], parsing.CHAIN_TEXTS["context"]


def leaves(value, path="$"):
    if isinstance(value, dict) and value:
        for k, v in value.items():
            plain = k.isidentifier() and k.isascii()
            yield from leaves(v, f"{path}.{k}" if plain else f"{path}['{k}']")
    elif isinstance(value, list) and value:
        for i, v in enumerate(value):
            yield from leaves(v, f"{path}[{i}]")
    else:
        yield path, json.dumps(value, ensure_ascii=False)


def made(rng, depth=0):
    kind = rng.choice(["object", "list", "leaf"] if depth < 4 else ["leaf"])
    if kind == "object":
        return {rng.choice(["a", "b", "c d", "é", "_x1"]): made(rng, depth + 1) for _ in range(rng.randrange(4))}
    if kind == "list":
        return [made(rng, depth + 1) for _ in range(rng.randrange(3))]
    return rng.choice([None, True, 0, -5, 1.5, "", "x\"y", "é🙂", 10**12])


def variants(spark, rows):
    frame = spark.createDataFrame(rows, "k long, j string")
    return frame.select("k", F.try_parse_json("j").alias("v"))


def test_leaves_of_random_trees(spark):
    rng = random.Random(3)
    trees = [made(rng) for _ in range(60)]
    got = tree_leaves(variants(spark, [(k, json.dumps(t)) for k, t in enumerate(trees)]), "k")
    want = {(k, p): json.loads(v) for k, t in enumerate(trees) for p, v in leaves(t)}
    assert {(r.k, r.path): json.loads(r.value) for r in got.collect()} == want


def test_differences(spark):
    rng = random.Random(4)
    pairs = [(made(rng), made(rng)) for _ in range(40)] + [({"a": 1, "b": [1, 2]}, {"a": "1", "b": [1], "c": None})]
    left = variants(spark, [(k, json.dumps(a)) for k, (a, _) in enumerate(pairs)] + [(900, "[1]"), (901, None), (902, "{broken")])
    right = variants(spark, [(k, json.dumps(b)) for k, (_, b) in enumerate(pairs)])
    want = set()
    for k, (a, b) in enumerate([*pairs]):
        x, y = dict(leaves(a)), dict(leaves(b))
        want |= {(k, p) for p in x.keys() | y.keys() if p not in x or p not in y or json.loads(x[p]) != json.loads(y[p]) or
                 isinstance(json.loads(x[p]), bool) != isinstance(json.loads(y[p]), bool)}
    got = tree_differences(left, right, "k", "one", "two").collect()
    assert {(r.k, r.path) for r in got} == want | {(900, "$[0]")}
    own = {r.path: (r.one, r.two, r.kind) for r in got if r.k == len(pairs) - 1}
    assert own == {"$.a": ("1", '"1"', "changed"), "$.b[1]": ("2", None, "only_one"), "$.c": (None, "null", "only_two")}


LINK = 'Traceback (most recent call last):\n  File "/a b.py", line 3, in f\n    g()\n    ^^^\n  File "/c.py", line {}, in <module>\n    h()\n'
CHAINS = {
    "three": (LINK.format(7) + f"KeyError: 'x'\n\n{CONTEXT}\n\n" + LINK.format(8) + f"a.b.Gone\n\n{CAUSE}\n\n" + LINK.format(9) + "c.D: one\n  two\n\nthree\n",
              [(1, None, "KeyError", "KeyError", "'x'", 2, "/c.py", 7, "<module>"), (2, "context", "Gone", "a.b.Gone", None, 2, "/c.py", 8, "<module>"),
               (3, "cause", "D", "c.D", "one\n  two\n\nthree", 2, "/c.py", 9, "<module>")]),
    "bare": ("ValueError: a: b", [(1, None, "ValueError", "ValueError", "a: b", 0, None, None, None)]),
    "crlf": ("Traceback (most recent call last):\r\n  File \"/x\", line 1\r\nE: m\r\n", [(1, None, "E", "E", "m", 1, "/x", 1, None)]),
    "no class": ("killed by the harness", [(1, None, None, None, "killed by the harness", 0, None, None, None)]),
    "quoted": (f"E: said '{CAUSE}'", [(1, None, "E", "E", f"said '{CAUSE}'", 0, None, None, None)]),
    "cut off": (LINK.format(1), [(1, None, None, None, None, 2, "/c.py", 1, "<module>")]),
    "blank": (" \n", []), "null": (None, []),
}


@pytest.mark.parametrize("name", CHAINS)
def test_exception_links(spark, name):
    body, want = CHAINS[name]
    frame = spark.createDataFrame([("t", body)], "trial_name string, body string")
    rows = parsing.exception_links(frame).orderBy("link").collect()
    assert [tuple(r)[1:] for r in rows] == want


def test_many_links(spark):
    body = f"\n\n{CONTEXT}\n\n".join(LINK.format(n) + f"E{n}: {n}" for n in range(400))
    frame = spark.createDataFrame([("t", body)], "trial_name string, body string")
    rows = parsing.exception_links(frame).orderBy("link").collect()
    assert [r.exc_type for r in rows] == [f"E{n}" for n in range(400)] and {r.led_by for r in rows[1:]} == {"context"}
    last = parsing.parse_exceptions(frame).first()
    assert (last.exc_type, last.exc_message) == ("E399", "399")
