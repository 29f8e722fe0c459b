from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracewell.functions import names, parsing, templates, text
from tracewell.functions.fences import with_commands
from tracewell.operators.trajectories import classify_turns, command_rows, trial_status


def one(spark, value, *columns, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_white_space_is_that_of_python(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "p int, t string")
    blank = {r.p for r in df.filter(text.is_blank(F.col("t"))).collect()}
    assert blank == {c for c in points if chr(c).strip() == ""}


def test_strip_and_blank(spark):
    samples = ["", " a ", "\t \u001f ", "​", None, " x　"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, t string")
    rows = df.select("i", text.py_strip(F.col("t")), text.is_blank(F.col("t"))).collect()
    for i, stripped, blank in rows:
        s = samples[i]
        assert stripped == (None if s is None else s.strip())
        assert blank == (s is None or s.strip() == "")


def test_clip(spark):
    c = F.col("v")
    assert one(spark, "é" * 1000, text.clip(c, 1000)).c0 == "é" * 1000
    assert one(spark, "é" * 1001, text.clip(c, 1000)).c0 == "é" * 1000 + "\n... [truncated 1 chars]"
    assert one(spark, "ab", text.preview(c)).c0 == "ab..."
    assert one(spark, "x" * 302, text.clip_for_console(c)).c0 == (
        "x" * 300 + "...\n... [2 more characters]"
    )
    assert one(spark, "ab", text.clip_for_console(c)).c0 == "ab..."


def test_words_and_truncate(spark):
    row = one(spark, " a b\n\nc ", text.words(F.col("v")), F.size(text.words(F.lit(" "))))
    assert row.c0 == ["a", "b", "c"] and row.c1 == 0


def test_completion_is_case_blind(spark):
    assert one(spark, "ok. Task Complete!", text.signals_completion(F.col("v"))).c0
    assert not one(spark, "task is complete", text.signals_completion(F.col("v"))).c0
    assert not one(spark, None, text.signals_completion(F.col("v"))).c0


FENCES = {
    "a\n```bash\nls\npwd\n```\n": ["ls\npwd"],
    "```sh\n```": [],
    "```bash\n\n```": [""],
    "```bash\nx\n```bash\ny\n```": ["y"],
    "```bash\nopen": [],
    "```shell\nz\n ``` \n```python\nq\n```": ["z"],
    "  ```bash\n```python\n1\n```\n```": ["```python\n1"],
    "": [],
    "```\nnot open\n```\n```sh\na\n```\nb\n```": ["a"],
}


def fence_rule(reply):
    """The rule, said differently: cut at marked lines, keep what lies between an opening
    line and a closing line."""
    found, block = [], None
    for line in reply.split("\n"):
        bare = line.strip()
        if bare[:7] == "```bash" or bare[:5] == "```sh":
            block = []
        elif bare == "```":
            found += ["\n".join(block)] if block else []
            block = None
        elif block is not None:
            block.append(line)
    return found


def commands(spark, replies):
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    return [r.commands for r in with_commands(df).orderBy("i").collect()]


def test_fence_cases(spark):
    assert commands(spark, list(FENCES)) == list(FENCES.values())
    assert [fence_rule(r) for r in FENCES] == list(FENCES.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["```bash", " ```sh x", "```", "\t``` ", "```python", "", "ls -1", " ```shell", "``` x"]
), max_size=12).map("\n".join), min_size=20, max_size=60))
def test_fence_property(spark, replies):
    assert commands(spark, replies) == [fence_rule(r) for r in replies]


def test_long_reply_is_linear(spark):
    reply = "```bash\n" + "\n".join(f"echo {i}" for i in range(40_000)) + "\n```"
    (found,) = commands(spark, [reply])
    assert len(found) == 1 and found[0].endswith("echo 39999")
    blocks = "\n".join(f"```sh\necho {i}\n```" for i in range(10_000))
    df = spark.createDataFrame([(1, 1, blocks)], "trial_id int, iteration int, reply string")
    assert command_rows(df).filter("cmd <> 'echo 5'").count() == 9_999


def test_completing_reply_runs_nothing(spark):
    df = spark.createDataFrame(
        [(1, 1, "hm", None), (1, 2, "```sh\na\n```\n```sh\nb\n```", None), (1, 3, None, "down"),
         (1, 4, "```sh\nc\n```", "lost"), (1, 5, "task complete\n```sh\nx\n```", None),
         (1, 6, "```sh\nlater\n```", None)],
        "trial_id int, iteration int, reply string, error string",
    )
    kinds = [r.turn_class for r in classify_turns(df).orderBy("iteration").collect()]
    assert kinds == ["no_command", "execute", "error", "error", "complete"]
    assert trial_status(df).first().conversation_length == 2 + 2 + 2 + 1 + 2 + 1
    rows = command_rows(df).orderBy("cmd_idx").collect()
    assert [(r.iteration, r.cmd_idx, r.cmd) for r in rows] == [(2, 1, "a"), (2, 2, "b")]


def test_feedback(spark):
    df = spark.createDataFrame([("ls", 0, "a\n", None), ("x", 2, "", "bad")],
                               "cmd string, rc int, out string, err string")
    c = templates.command_feedback(F.lit(1), F.col("cmd"), F.col("rc"), F.col("out"), F.col("err"))
    assert [r[0] for r in df.select(c).collect()] == [
        "Command 1: ls\nExit code: 0\nSTDOUT:\na\n\n", "Command 1: x\nExit code: 2\nSTDERR:\nbad\n",
    ]


def test_names(spark):
    v = F.col("v")
    assert one(spark, "Some-Owner/Tiny_Coder-3-7B-Instruct", names.agent_name(v)).c0 == (
        "tiny-coder-3"
    )
    assert one(spark, "A_b", names.agent_name(v)).c0 == "a-b"
    assert one(spark, "a/b", names.cache_folder(v)).c0 == "datasets--a--b"
    row = one(spark, "x__y__z9", names.trial_task(v), names.trial_suffix(v))
    assert tuple(row) == ("x__y", "z9")
    assert one(spark, "plain", names.trial_task(v)).c0 is None


def test_exception_lines(spark):
    bodies = [
        "Traceback\n  File x\npkg.mod.AgentTimeoutError: Agent execution timed out after 900.0 seconds\n\n",
        "ValueError\n", "", "no exception here: at all",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = parsing.parse_exceptions(df).orderBy("i").collect()
    assert [(r.exc_type, r.timeout_sec) for r in rows] == [
        ("AgentTimeoutError", 900.0), ("ValueError", None), (None, None), (None, None),
    ]
    assert rows[0].exc_message == "Agent execution timed out after 900.0 seconds"


def test_console(spark):
    bodies = [
        "x\nPASSED a.py::t1[a b]\nFAILED a.py::t2 - boom in 3s\nERROR a.py::t3\n"
        "=== 1 failed, 1 passed, 1 error in 0.09s ===",
        "=== test session starts ===\ncollected 1 item\n\na.py",
        "===== 3 passed, 2 warnings in 75.10s (0:01:15) =====\r\n",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = parsing.parse_console(df).orderBy("i").collect()
    assert [(r.n_passed, r.n_failed, r.n_errors, r.seconds) for r in rows] == [
        (1, 1, 1, 0.09), (None, None, None, None), (3, 0, 0, 75.1),
    ]
    tests = parsing.console_tests(df).orderBy("test_name").collect()
    assert [(r.status, r.test_name) for r in tests] == [
        ("passed", "a.py::t1[a b]"), ("failed", "a.py::t2"), ("error", "a.py::t3"),
    ]


def test_metric_lines(spark):
    lines = [
        'm:x{a="1,2",b="q\\"z"} 3.5', "m 1e3 1700000000", "# TYPE m gauge", 'm{a=""} NaN', "m{} 2", "bad",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    rows = parsing.parse_metrics(df).orderBy("i").collect()
    assert [(r.i, r.name, r.value) for r in rows if r.i != 3] == [
        (0, "m:x", 3.5), (1, "m", 1000.0), (4, "m", 2.0),
    ]
    assert rows[0].labels == {"a": "1,2", "b": 'q\\"z'} and rows[2].labels == {"a": ""}


def test_placeholders_are_filled_once(spark):
    got = one(spark, "{b}", templates.fill("<{a}|{b}>", a=F.col("v"), b=F.lit("x"))).c0
    assert got == "<{b}|x>"
