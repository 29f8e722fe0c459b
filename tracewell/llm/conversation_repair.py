"""Conversations brought back to a legal order of roles by the cheapest edits.

Roles count by their initials; a legal conversation matches ``(s?(ua)+)?``. Every row is kept (K), given the role that fits (R,
user or assistant) or deleted (D), and empty turns may be inserted (I). The edits come from iterative-deepening
A*: a depth-first search that tries edits in ASCII order under a bound on the cost; when it fails, the bound rises to the
least cost that could still do. What a place and state are known to need at least is kept in a table, so a failed state is
not entered again with as little left. The first accepting path is the cheapest, and of those the least in ASCII order.

A conversation is searched in stretches of ``STRETCH`` rows, so one of any length is spread over many tasks. Most have one stretch. In the
others each stretch is solved for every pair of states it may begin and end in, insertions counting to the row that
follows. Two passes over the stretches then choose: from the last to the first the least cost to the end from each state, from the first to
the last the states themselves. Edits of one stretch that end in different states differ before their end, so comparing a stretch's
own edits settles ties of the whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored
from tracewell.operators.blocks import ordered

STRETCH = 64
#: Rows whose stretches one task searches, about.
TASK_ROWS = 1 << 14

#: Costs of the edits, and what a kept truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: The edits' letters are K, R, D and I; "[.!?]" ends a whole text; space and 0x09 to 0x0D are blank.
FULL, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"

#: States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn; where a role leads.
TAKES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS, WHOLE = (0, 3), 4
KEPT = 100_000  # solved stretches that a task remembers


# ---- search -----------------------------------------------------------------------------------

def _edges(symbol: str, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, next state) in ASCII order. ``symbol``: x must go, s, u, a or o (other) is the initial,
    a capital is truncated; empty after the last row."""
    turn = next(r for r in "ua" if state in TAKES[r])  # the user or assistant turn that fits here
    out = [("D", DELETE, 1, state)] if symbol else []
    out.append(("I", INSERT, 0, TAKES[turn][state]))
    if symbol and symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        kept = TAKES.get(symbol.lower(), {}).get(state)
        if kept is not None:
            out.append(("K", more, 1, kept))
        out.append(("R", REROLE + more, 1, TAKES[turn][state]))
    return out


EDGES = {(symbol, state): _edges(symbol, state) for symbol in ("", *"xsuaoSUAO") for state in range(4)}


def cheapest(symbols: str, entry: int, target: int) -> tuple[int, str] | None:
    """(cost, edits) from state ``entry`` to ``target``, or to a legal end if that is WHOLE; None if none leads there.

    On the way to a state the last edit takes a row; only a legal end may follow inserted turns.
    """
    n = len(symbols)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + {"x": DELETE, "o": REROLE}.get(symbols[i], DELETE if symbols[i].isupper() else 0)
    need: dict[tuple[int, int], float] = {}
    path: list[str] = []

    def walk(i: int, state: int, left: float) -> float:
        """0 with the edits in ``path``, backwards; else a bound above ``left`` of what it takes from here."""
        if i == n and (state in ENDS if target == WHOLE else state == target):
            return 0
        if i == n and target != WHOLE:
            return float("inf")
        least = need.get((i, state), ahead[i])
        if least > left:
            return least
        least = float("inf")
        for edit, cost, taken, then in EDGES[symbols[i] if i < n else "", state]:
            if cost > left:
                more = need.get((i + taken, then), ahead[i + taken])
            else:
                more = walk(i + taken, then, left - cost)
                if more <= left - cost:
                    path.append(edit)
                    return 0
            least = min(least, cost + more)
        need[i, state] = least
        return least

    bound: float = ahead[0]
    while bound <= DELETE * n + 2 * INSERT:  # deleting all and inserting what is missing costs no more
        more = walk(0, entry, bound)
        if more <= bound:
            return int(bound), "".join(reversed(path))
        bound = more
    return None


def _solve(batches):
    """The table of each stretch: costs and edits by begin and end, at 5 * begin + end; null where not needed or impossible."""
    known: dict[tuple[str, int, int], tuple[int, str] | None] = {}
    for batch in batches:
        costs, audits = [], []
        for block, last, symbols in zip(*(batch.column(c).to_pylist() for c in ("block", "last_block", "symbols"))):
            cost, audit = [None] * 20, [None] * 20
            for entry in range(4) if block else (0,):
                for target in (WHOLE,) if block == last else range(4):
                    case = (symbols, entry, target)
                    if case not in known:
                        if len(known) >= KEPT:
                            known.clear()
                        known[case] = cheapest(*case)
                    if known[case]:
                        cost[5 * entry + target], audit[5 * entry + target] = known[case]
            costs.append(cost)
            audits.append(audit)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "block", "last_block", "symbols")),
             pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
            names=["conv_id", "block", "last_block", "symbols", "costs", "audits"])


def _backward(batches):
    """Stretches from the last to the first: the end to choose for every begin."""
    ahead = None  # cost to the end of the conversation from each state after this stretch
    for batch in batches:
        choices = []
        for block, last, cost, audit in zip(*(batch.column(c).to_pylist() for c in ("block", "last_block", "costs", "audits"))):
            choice, now = [], []
            for entry in range(4):
                ways = []
                for end in (WHOLE,) if block == last else range(4):
                    k = 5 * entry + end
                    if cost[k] is not None and (end == WHOLE or ahead[end] is not None):
                        ways.append((cost[k] + (0 if end == WHOLE else ahead[end]), audit[k], end))
                best = min(ways, default=(None, None, None))
                now.append(best[0])
                choice.append(best[2])
            ahead = now
            choices.append(choice)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(choices, pa.list_(pa.int64()))],
                                         names=[*batch.schema.names, "choices"])


def _forward(batches):
    """Stretches from the first to the last: begin, cost and edits of each."""
    state = 0
    for batch in batches:
        entries, costs, audits = [], [], []
        for block, cost, audit, choice in zip(*(batch.column(c).to_pylist() for c in ("block", "costs", "audits", "choices"))):
            state = state if block else 0
            end = choice[state]
            entries.append(state)
            costs.append(cost[5 * state + end])
            audits.append(audit[5 * state + end])
            state = end
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "block", "symbols")), pa.array(entries, pa.int64()),
             pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            names=["conv_id", "block", "symbols", "entry", "cost", "audit"])


def _edits(batches):
    """A row for each edit: its place in the stretch, the row it takes (null if inserted) and a new role."""
    for batch in batches:
        source, k, edit, pos, role = [], [], [], [], []
        for row, (block, symbols, state, audit) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("block", "symbols", "entry", "audit")))):
            i = 0
            for place, letter in enumerate(audit):
                cause = symbols[i] if letter != "I" else ""
                then = next(e[3] for e in EDGES[cause, state] if e[0] == letter)
                source.append(row)
                k.append(place)
                edit.append(letter)
                pos.append(block * STRETCH + i + 1 if letter != "I" else None)
                role.append({2: "user", 3: "assistant"}[then] if letter in "IR" else None)
                state, i = then, i + (letter != "I")
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(source, pa.int64())) for c in ("conv_id", "block")), pa.array(k, pa.int64()),
             pa.array(edit, pa.string()), pa.array(pos, pa.int64()), pa.array(role, pa.string())],
            names=["conv_id", "block", "k", "edit", "pos", "new_role"])


def _hashes(batches):
    """SHA-256 of the lines of each conversation, which come in order."""

    def closed(kind, ids, hashes):
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.string())],
                                          names=["conv_id", "repaired_sha256"])

    now, made, kind = None, None, None
    for batch in batches:
        kind, ids, hashes = batch.schema.field("conv_id").type, [], []
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
            if made is not None and conv == now:
                made.update(b"\n")
            else:
                if made is not None:
                    ids.append(now)
                    hashes.append(made.hexdigest())
                now, made = conv, hashlib.sha256()
            made.update(line.encode())
        yield closed(kind, ids, hashes)
    if made is not None:
        yield closed(kind, [now], [made.hexdigest()])


# ---- tables -----------------------------------------------------------------------------------

def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; a null role or text is one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` as a test of repair: by crc32 of ``conv_id:turn`` (nulls as a space) modulo 20 a row is dropped (0), emptied (1),
    freed of ``.!?`` (2), repeated (3) or made a user's (4)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    return (
        plain(conversations).withColumn("fault", fault).filter("fault <> 0")
        .withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
        .withColumn("text", F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")))
        .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .drop("fault", "copy")
    )


def same(left: DataFrame, right: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """Join that takes nulls as equal; the keys of ``right`` go."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return left.join(other, [left[k].eqNullSafe(other[f"_{k}"]) for k in keys], how).drop(*[f"_{k}" for k in keys])


class Repair:
    """The cheapest repair of a table of conversations: conv_id, turn, role, text.

    Rows of a conversation are taken by turn (nulls first), role and text. Null roles and texts are one space; a null conv_id is a
    conversation like others; further columns are not read. A row is blank (nothing but blanks), or a duplicate (role and text
    seen earlier), both of which have to go, or truncated (does not end in ``.!?``). An empty table gives empty ones.
    A conversation's rows are numbered across tasks if they are many (``ordered``); its audit is one value, so that has to
    fit one cell, and its hash is taken by one task, row by row.
    """

    def __init__(self, conversations: DataFrame):
        initial = F.substring("role", 1, 1)
        rows = plain(conversations).withColumn(
            "initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("o"))
        order = ordered(rows, ["conv_id"], ["turn", "role", "text"])
        self.rows = stored(order.number("pos").previous("initial", "before").rows(), "turns")
        self.kind = self.rows.schema["conv_id"].dataType.simpleString()

    def marks(self) -> DataFrame:
        """conv_id, pos, turn, initial, before (the initial of the row before) and the first fault of each row: b, d, t or none."""
        rows = self.rows.select("conv_id", "pos", "turn", "initial", "before", "role", F.md5("text").alias("key"),
                                F.col("text").rlike(FULL).alias("full"), F.col("text").rlike(ENDED).alias("ended"))
        firsts = rows.groupBy("conv_id", "role", "key").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
        fault = F.when(~F.col("full"), "b").when(F.col("pos") > F.col("first"), "d").when(~F.col("ended"), "t").otherwise("")
        return same(rows, firsts, "conv_id", "role", "key").select(
            "conv_id", "pos", "turn", "initial", "before", fault.alias("fault"))

    def counts(self, marks: DataFrame) -> DataFrame:
        """A row for each conversation: n, gaps, blank, duplicate, truncated, illegal."""
        pair = F.concat("before", "initial")
        return marks.groupBy("conv_id").agg(
            F.count("*").alias("n"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0).cast("long")).alias("gaps"),
            *[F.count_if(F.col("fault") == c).alias(name) for c, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
            F.count_if(F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False))).alias("illegal"))

    def solved(self, marks: DataFrame, counts: DataFrame) -> DataFrame:
        """A row for each stretch: conv_id, block, symbols, entry, cost, audit."""
        symbol = F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper("initial")).otherwise(F.col("initial"))
        places = marks.select("conv_id", "pos", F.floor((F.col("pos") - 1) / STRETCH).alias("block"), symbol.alias("symbol"))
        stretches = places.groupBy("conv_id", "block").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]), "").alias("symbols"))
        last = counts.select("conv_id", F.floor((F.col("n") - 1) / STRETCH).alias("last_block"))
        fields = f"conv_id {self.kind}, block long, last_block long, symbols string, costs array<long>, audits array<string>"
        # a search takes far longer than its few bytes suggest, so tasks go by rows and not by size
        parts = 1 + (counts.agg(F.sum("n")).first()[0] or 0) // TASK_ROWS
        tables = stored(
            same(stretches, last, "conv_id", how="inner").select("conv_id", "block", "last_block", "symbols")
            .repartition(parts, "conv_id", "block").mapInArrow(_solve, fields), "stretches")
        single = tables.filter("last_block = 0").select(
            "conv_id", "block", "symbols", F.lit(0).cast("long").alias("entry"), F.col("costs")[WHOLE].alias("cost"),
            F.col("audits")[WHOLE].alias("audit"))
        several = (
            tables.filter("last_block > 0").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
            .mapInArrow(_backward, f"{fields}, choices array<long>")
            .repartition("conv_id").sortWithinPartitions("conv_id", "block")
            .mapInArrow(_forward, f"conv_id {self.kind}, block long, symbols string, entry long, cost long, audit string")
        )
        return stored(single.unionByName(several), "repairs")

    def turns(self, solved: DataFrame) -> DataFrame:
        """A row for each edit in order (block, k): edit, turn, role and text; deleted rows too."""
        fields = f"conv_id {self.kind}, block long, k long, edit string, pos long, new_role string"
        edits = solved.mapInArrow(_edits, fields)
        return same(edits, self.rows.select("conv_id", "pos", "turn", "role", "text"), "conv_id", "pos").select(
            "conv_id", "block", "k", "edit", "turn", F.coalesce("new_role", "role").alias("role"),
            F.coalesce("text", F.lit("")).alias("text"))


def repaired(conversations: DataFrame) -> DataFrame:
    """The conversations after their repair: conv_id, place (from 0 in order, with gaps), edit (K, R or I), turn, role, text."""
    work = Repair(conversations)
    marks = work.marks()
    return work.turns(work.solved(marks, work.counts(marks))).filter("edit <> 'D'").select(
        "conv_id", (F.col("block") * (8 * STRETCH) + F.col("k")).alias("place"), "edit", "turn", "role", "text")


def report(conversations: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``names`` (conv_id) may name conversations that have no row; they get zeros, an empty audit and the hash of nothing.
    """
    work = Repair(conversations)
    marks = stored(work.marks(), "marks")
    counts = stored(work.counts(marks), "counts")
    solved = work.solved(marks, counts)
    audits = solved.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    lines = work.turns(solved).filter("edit <> 'D'").select("conv_id", "block", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    hashes = (
        lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "k").select("conv_id", "line")
        .mapInArrow(_hashes, f"conv_id {work.kind}, repaired_sha256 string")
    )
    found = same(same(counts, audits, "conv_id"), hashes, "conv_id")
    if names is not None:
        found = same(names.select("conv_id").distinct(), found, "conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
