import random

import pytest
from pyspark.sql import functions as F

from tracewell.functions.templates import CHATML, STRICT_CHATML, Template
from tracewell.operators import conversations as C
from tracewell.sources.writers import write_training_text

BLANK = "\t \u001f "
CASES = {  # name -> turns, merged messages or drop reason
    "names": ("human:a|gpt:b", "user:a|assistant:b"),
    "merge": ("user:a|user:b|assistant:c", "user:a\n\nb|assistant:c"),
    "skip unknown": ("user:a|tool:x|user:b|assistant:c", "user:a\n\nb|assistant:c"),
    "blank does not split": ("user:a|assistant: |user:b|bot:c", "user:a\n\nb|assistant:c"),
    "assistant first": ("assistant:a|user:b|assistant:c", "starts_assistant"),
    "user last": ("user:a|assistant:b|user:c", "not_ends_assistant"),
    "both wrong": ("assistant:a|user:b", "starts_assistant"),
    "unknown first": ("tool:x|assistant:a", "starts_assistant"),
    "all blank": ("user: |assistant:\t", "empty"),
    "system first": ("system:s|assistant:a", "system:s|assistant:a"),
    "spaces kept": ("USER: a |Assistant:b", "user: a |assistant:b"),
    "role not trimmed": (" user:a|assistant:b", "starts_assistant"),
    "unicode blank": (f"user:{BLANK}|user:a|assistant:b", "user:a|assistant:b"),
    "zero width is text": ("user:​|assistant:b", "user:​|assistant:b"),
    "system merges": ("system:s|system:t|user:u|assistant:v", "system:s\n\nt|user:u|assistant:v"),
}


def turns_of(spark, talks):
    rows = [
        (i, t, *m.split(":", 1)) for i, talk in enumerate(talks)
        for t, m in enumerate(talk.split("|"))
    ]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def render(messages):
    return "".join(
        f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in (m.split(":", 1) for m in messages.split("|"))
    )


def outcome(row):
    return row.drop_reason or row.text


WANTED = [w if w in C.DROP_REASONS else render(w) for _, w in CASES.values()]


@pytest.mark.parametrize("head", [1, 2, 4096])
def test_flat_cases(spark, head):
    turns = turns_of(spark, [t for t, _ in CASES.values()])
    out = C.format_conversations(turns, keep_dropped=True, head_turns=head).orderBy("conv_id")
    rows = out.collect()
    assert [outcome(r) for r in rows] == WANTED
    kept = C.format_conversations(turns, head_turns=head).orderBy("conv_id").collect()
    assert kept == [r for r in rows if r.drop_reason is None]


def test_nested_cases(spark):
    nested = C.nest_turns(turns_of(spark, [t for t, _ in CASES.values()]))
    rows = C.format_nested(nested, keep_dropped=True).orderBy("conv_id").collect()
    assert [outcome(r) for r in rows] == WANTED


def test_turn_without_a_number_is_kept(spark):
    rows = [(1, None, "user", "a"), (1, 0, "assistant", "b"), (2, None, "assistant", "x"), (3, 1, "tool", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.drop_reason) for r in C.format_conversations(turns, keep_dropped=True).collect()}
    assert got == {1: (2, None), 2: (None, "starts_assistant"), 3: (None, "empty")}
    assert [r.content for r in C.merge_turns(turns).filter("conv_id = 1").orderBy("msg_idx").collect()] == ["a", "b"]


def test_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "turns")
    spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string").write.parquet(path)
    for keep in (False, True):
        frame = C.format_conversations(spark.read.parquet(path), keep_dropped=keep)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_ends_and_report(spark):
    turns = turns_of(spark, [t for t, _ in CASES.values()])
    ends = [r.drop_reason for r in C.conversation_ends(turns).orderBy("conv_id").collect()]
    assert ends == [w if w in C.DROP_REASONS else None for w in WANTED]
    report = C.drop_report(turns).first()
    assert (report.n_before, report.n_after, report.n_dropped) == (15, 9, 6)
    assert (report.n_empty, report.n_starts_assistant, report.n_not_ends_assistant) == (1, 4, 1)


def test_role_and_from(spark):
    nested = spark.createDataFrame(
        [(1, [(None, "human", "a"), ("assistant", "human", "b")]), (2, [(None, "human", None)]),
         (3, None), (4, [(None, None, "x"), ("user", None, "u"), ("bot", None, "v")])],
        "conv_id long, conversations array<struct<role:string, `from`:string, content:string>>",
    )
    rows = C.format_nested(nested, keep_dropped=True).orderBy("conv_id").collect()
    assert [outcome(r) for r in rows] == [
        render("user:a|assistant:b"), "empty", "empty", render("user:u|assistant:v"),
    ]
    flat = C.explode_turns(nested.filter("conv_id <> 3"))
    again = C.format_conversations(flat, keep_dropped=True).orderBy("conv_id").collect()
    assert [outcome(r) for r in again] == [outcome(r) for r in rows if r.conv_id != 3]


def plain_rules(talk):
    """The rules in a few lines of plain Python, as the yardstick."""
    known = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant",
             "bot": "assistant", "system": "system"}
    pairs = [(known.get(r.lower()), c) for r, c in talk if c.strip()]
    merged = []
    for role, content in (p for p in pairs if p[0]):
        if merged and merged[-1][0] == role:
            merged[-1] = (role, merged[-1][1] + "\n\n" + content)
        else:
            merged.append((role, content))
    return merged


def random_talks(n, longest):
    rng = random.Random(11)
    roles = ["user", "Human", "gpt", "assistant", "BOT", "system", "tool", ""]
    texts = ["a", " b ", "", " \t", "c\nd", "​", "é"]
    return [
        [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, longest))]
        for _ in range(n)
    ]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_random_conversations(spark, block):
    talks = random_talks(400, 14)
    rows = [(i, t, r, c) for i, talk in enumerate(talks) for t, (r, c) in enumerate(talk)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {i: plain_rules(talk) for i, talk in enumerate(talks)}

    formatted = {r.conv_id: r for r in C.format_conversations(
        turns, keep_dropped=True, head_turns=block).collect()}
    cut = {"floor": block, "pieces": 5}
    spans = {}
    for r in C.response_spans(turns, **cut).collect():
        spans.setdefault(r.conv_id, []).append((r.start, r.stop))
    merged = {}
    for r in C.merge_turns(turns, **cut).collect():
        merged.setdefault(r.conv_id, {})[r.msg_idx] = (r.role, r.content)

    for i, messages in want.items():
        got = formatted[i]
        assert [merged.get(i, {})[k] for k in sorted(merged.get(i, {}))] == messages
        if not messages:
            assert got.drop_reason == "empty"
        elif messages[0][0] == "assistant":
            assert got.drop_reason == "starts_assistant"
        elif messages[-1][0] != "assistant":
            assert got.drop_reason == "not_ends_assistant"
        else:
            assert got.text == "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in messages)
            assert got.n_turns == len(messages)
            said = [got.text[a:b] for a, b in sorted(spans[i])]
            assert said == [c for r, c in messages if r == "assistant"]
        if got.drop_reason:
            assert i not in spans

    nested = C.nest_turns(turns)
    for r in C.merge_nested(nested).collect():
        assert [(m.role, m.content) for m in r.messages] == want[r.conv_id]


def test_strict_template(spark):
    talks = ["system:s|user:u|assistant:a", "system:s|assistant:a", "user:u|system:s|user:v|assistant:a"]
    for head in (1, 2, 4096):
        rows = C.format_conversations(
            turns_of(spark, talks), STRICT_CHATML, keep_dropped=True, head_turns=head
        ).orderBy("conv_id").collect()
        assert [r.drop_reason for r in rows] == [None, "template_error", "template_error"]


def test_template_without_a_role(spark):
    bare = Template({"user": ("", ""), "assistant": ("", "")})
    talks = ["user:a|assistant:b", "system:s|user:a|assistant:b", "user:a|system:s|assistant:b"]
    turns = turns_of(spark, talks)
    for head in (1, 2, 4096):
        out = C.format_conversations(turns, bare, keep_dropped=True, head_turns=head)
        rows = out.orderBy("conv_id").collect()
        assert [outcome(r) for r in rows] == ["ab", "template_error", "template_error"]
    assert C.format_conversations(turns, bare).count() == 1
    nested = C.format_nested(C.nest_turns(turns), bare, keep_dropped=True)
    assert sorted(outcome(r) for r in nested.collect()) == ["ab", "template_error", "template_error"]


def test_blank_text_is_not_trained_on(spark):
    df = spark.createDataFrame([(" \t",), ("a",), (None,)], "text string")
    assert [r.text for r in C.training_text(df).collect()] == ["a"]


def test_raw_recipe_keeps_columns_and_fails_on_unknown_roles(spark):
    nested = C.nest_turns(turns_of(spark, ["user:|user:b|assistant:c"])).withColumn("tag", F.lit(1))
    row = C.format_raw(nested, CHATML).first()
    assert row.tag == 1 and row.text == render("user:|user:b|assistant:c")
    bad = C.nest_turns(turns_of(spark, ["tool:x"]))
    with pytest.raises(Exception, match="template has no role tool"):
        C.format_raw(bad).collect()


def test_written_text_is_counted_on_the_way(spark, tmp_path):
    turns = turns_of(spark, [t for t, _ in CASES.values()])
    formatted = C.format_conversations(turns, keep_dropped=True)
    sizes = write_training_text(formatted, str(tmp_path / "t"), "json")
    assert sizes == {"n_before": 15, "n_after": 9, "n_empty": 1, "n_starts_assistant": 4,
                     "n_not_ends_assistant": 1, "n_template_error": 0}
    assert spark.read.json(str(tmp_path / "t")).count() == 9


def test_first_n(spark):
    turns = turns_of(spark, [t for t, _ in CASES.values()])
    ids = lambda n: sorted(
        r.conv_id for r in C.first_conversations(turns, n).select("conv_id").distinct().collect()
    )
    assert ids(3) == [0, 1, 2] and len(ids(99)) == 15 and len(ids(None)) == 15
    assert C.first_formatted(turns).first().conv_id == 0


def test_truncate_and_lengths(spark):
    df = spark.createDataFrame([(1, " a  b c "), (2, "a b")], "i int, text string")
    rows = C.truncate(df, 2).orderBy("i").collect()
    assert [(r.text, r.n_tokens, r.was_truncated) for r in rows] == [("a b", 3, True), ("a b", 2, False)]
    report = C.length_report(df, 2).first()
    assert (report.n_rows, report.max_tokens, report.n_over_cap, report.p50) == (2, 3, 1, 2.5)


def test_epoch_order(spark):
    ids = spark.range(100).withColumnRenamed("id", "conv_id")
    order = C.epoch_order(ids, "conv_id", epochs=2)
    cut = C.epoch_order(ids, "conv_id", epochs=2, floor=10)
    rows = order.collect()
    assert sorted(rows) == sorted(cut.collect())
    orders = []
    for epoch in (0, 1):
        mine = sorted((r for r in rows if r.epoch == epoch), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(100))
        orders.append([r.conv_id for r in mine])
        assert sorted(orders[-1]) == list(range(100)) != orders[-1]
    assert orders[0] != orders[1]
    assert C.epoch_order(ids, "conv_id", seed=7).collect() != C.epoch_order(ids, "conv_id").collect()


@pytest.mark.parametrize("turns,reason", [
    ([(None, "user", "q"), (1, "assistant", "a")], None),
    ([(None, "assistant", "a"), (None, "user", "q")], "starts_assistant"),
    ([(None, "assistant", "a"), (1, "user", "q"), (2, "assistant", "b")], "starts_assistant"),
    ([(0, "user", "q"), (None, "system", "s"), (1, "assistant", "a")], None),
    ([(None, "user", " "), (1, "assistant", "a")], "starts_assistant"),
    ([(None, "user", "q"), (None, "user", "p")], "not_ends_assistant"),
])
def test_turns_without_a_number_come_first_everywhere(spark, turns, reason):
    flat = spark.createDataFrame([(1, *t) for t in turns], "conv_id long, turn long, role string, text string")
    (whole,) = C.format_conversations(flat, keep_dropped=True).collect()
    assert whole.drop_reason == reason
    report = C.drop_report(flat).first()
    assert report.n_dropped == (reason is not None) and (reason is None or report[f"n_{reason}"] == 1)
    spans = C.response_spans(flat).collect()
    if reason:
        assert not spans and C.first_formatted(flat).count() == 0
    else:
        said = "\n\n".join(t[2] for t in turns if t[1] == "assistant")
        assert [whole.text[s.start:s.stop] for s in spans] == [said]
        assert C.first_formatted(flat).first().text == whole.text
