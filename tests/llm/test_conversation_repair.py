"""Repair of conversations against all edits worked out by dynamic programming."""

import hashlib
import random
import re
import zlib

import pytest

from tracewell.llm import conversation_repair as repair

FITS = {0: "u", 1: "u", 2: "a", 3: "u"}
THEN = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ROLE = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not re.search("[^\x20\x09-\x0d]", text):
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("" if re.search("[.!?][\x20\x09-\x0d]*\\Z", text) else "t")
        seen.add((role, text))
    return out


def plain(rows):
    """Counts, cost, audit and lines of one conversation."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marks = faults(rows)
    best = {0: (0, "", [])}

    def inserted(best):
        best = dict(best)
        while True:
            more = dict(best)
            for state, (cost, audit, lines) in best.items():
                then = THEN[state, FITS[state]]
                way = (cost + 5, audit + "I", [*lines, ROLE[FITS[state]] + ":"])
                more[then] = min(more.get(then, way), way)
            if more == best:
                return best
            best = more

    for (_, role, text), mark in zip(rows, marks):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            ways = [(state, (cost + 2, audit + "D", lines))]
            if mark not in "bd" or not mark:
                late = 5 * (mark == "t")
                if (state, role[:1]) in THEN:
                    ways.append((THEN[state, role[:1]], (cost + late, audit + "K", [*lines, f"{role}:{text}"])))
                ways.append((THEN[state, FITS[state]], (cost + late + 1, audit + "R", [*lines, f"{ROLE[FITS[state]]}:{text}"])))
            for then, way in ways:
                after[then] = min(after.get(then, way), way)
        best = after
    cost, audit, lines = min(v for s, v in inserted(best).items() if s in (0, 3))
    turns = [t for t, *_ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("b"), marks.count("d"), marks.count("t"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def want(rows):
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(rest)
    return sorted(((c, *plain(r)) for c, r in by.items()), key=repr)


def got(spark, rows, names=None):
    table = spark.createDataFrame([(*r, "own", "own") for r in rows], "conv_id long, turn long, role string, text string, pos string, cost string")
    return sorted((tuple(r) for r in repair.report(table.repartition(3), names).collect()), key=repr)


def conversation(rng, conv, n):
    rows = []
    for t in range(n):
        role = rng.choices(["user", "assistant", "system", "tool", "", None], [6, 6, 1, 1, .3, .3])[0] if rng.random() < .25 else ("user", "assistant")[t % 2]
        text = rng.choice(["Yes.", "no", "", " \n", None, f"Text {t}!", f"{t} cut", f"é {t}?", f"Fine {t}.\n"])
        rows.append((conv, rng.choice([t, t, t, t // 2, None]), role, text))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = [r for c in range(150) for r in conversation(rng, c, rng.randrange(1, 9))]
    assert got(spark, rows) == want(rows)


def test_long_conversations_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(repair, "STRETCH", 4)
    rng = random.Random(5)
    rows = [r for c in range(40) for r in conversation(rng, c, rng.choice([3, 4, 5, 8, 9, 30]))]
    assert got(spark, rows) == want(rows)


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(1, t, ("user", "assistant")[t % 2] if rng.random() < .9 else "user", f"Turn {t}{rng.choice('...!x')}") for t in range(700)]
    assert got(spark, rows) == want(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x." * 100_000), (1, None, "assistant", "A."), (2, 0, "user", ""),
            (3, 0, "system", "S."), (4, 0, "user", "A."), (4, 0, "user", "A."), (4, 7, "assistant", "B"), (5, 3, "unknown", "C."),
            (6, None, "user", "A."), (6, 5, "user", "B.")]
    names = spark.createDataFrame([(k,) for k in (None, 1, 2, 3, 4, 5, 6, 99)], "conv_id long")
    nothing = (99, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(spark, rows, names) == sorted([*want(rows), nothing], key=repr)
    assert got(spark, []) == []
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = repair.repaired(table).orderBy("conv_id", "place").collect()
    assert [(r.edit, r.role, r.text) for r in out if r.conv_id == 6] == [("K", "user", "A."), ("R", "assistant", "B.")]
    assert not [r for r in out if r.conv_id in (2, 3, 4)]
    assert repair.repaired(table.limit(0)).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"Well. {c}-{t}!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = []
    for c, t, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        expected += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, repair.damaged(table).collect()), key=repr) == sorted(expected, key=repr)
