"""Checked queries over names, text artifacts, adapters and task corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import names as N
from tracewell.functions import parsing as P
from tracewell.operators import corpus, registry
from tracewell.plans import views as V
from tracewell.plans.catalog import ctes, query

EXCEPTIONS = V.SQL["trial_exceptions"]


@query("exception_parse", ctes(trial_exceptions=EXCEPTIONS) + """
SELECT trial_id, 'AgentTimeoutError' AS exc_type,
  regexp_extract(body, 'AgentTimeoutError: (.*)$', 1) AS exc_message,
  CAST(regexp_extract(body, 'after ([0-9.]+) seconds', 1) AS DOUBLE) AS timeout_sec
FROM trial_exceptions""")
def exception_parse(spark, sf):
    return P.parse_exceptions(V.trial_exceptions(spark, sf)).drop("body")


# Log lines of three kinds, and others, one per event.
LOG_LINE = """CASE
  WHEN event_type = 'error' THEN 'Exception AgentTimeoutError is in exclude_exceptions, not retrying'
  WHEN event_type = 'view' THEN 'Not retrying trial because the maximum was reached'
  WHEN event_type = 'signup' THEN concat('Trial task-', CAST(user_id % 89 AS VARCHAR(10)), '__',
    CAST(event_id AS VARCHAR(20)), ' failed: Verifier execution timed out after 900.0 seconds')
  ELSE concat('note ', event_type) END"""
LOG_LINES = f"SELECT event_id, {LOG_LINE} AS line FROM events"


@query("log_parse", ctes(log_lines=LOG_LINES) + """
SELECT event_id,
  CASE WHEN line LIKE 'Exception %' THEN 'excluded' WHEN line LIKE 'Not retrying %' THEN 'not_retrying'
       WHEN line LIKE 'Trial %' THEN 'trial_failed' END AS kind,
  CASE WHEN line LIKE 'Exception %' THEN split_part(line, ' ', 2) END AS exc_type,
  CASE WHEN line LIKE 'Trial %' THEN split_part(line, ' ', 2) END AS trial_name,
  CASE WHEN line LIKE 'Not retrying %' THEN split_part(line, ' because ', 2)
       WHEN line LIKE 'Trial %' THEN split_part(line, ' failed: ', 2) END AS message
FROM log_lines""")
def log_parse(spark, sf):
    lines = V.table(spark, sf, "events").selectExpr("event_id", f"{LOG_LINE} AS line")
    return P.parse_log_lines(lines).drop("line")


@query("trial_name_parse", """
SELECT event_id, concat('task__', CAST(user_id % 89 AS VARCHAR)) AS task_name,
  concat('s', CAST(event_id AS VARCHAR)) AS suffix FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 2 <> 0""")
def trial_name_parse(spark, sf):
    name = F.when(
        F.col("event_id") % 2 == 0,
        F.concat(F.lit("task__"), (F.col("user_id") % 89).cast("string"), F.lit("__s"), "event_id"),
    ).otherwise(F.concat(F.lit("plain_"), "event_id"))
    return V.table(spark, sf, "events").select(
        "event_id", N.trial_task(name).alias("task_name"), N.trial_suffix(name).alias("suffix")
    )


# Console texts built from the tests of an order; every seventh is cut off.
CONSOLES = """
SELECT l_orderkey AS trial_id, count(*) FILTER (WHERE l_returnflag = 'N') AS n_passed,
  count(*) FILTER (WHERE l_returnflag = 'R') AS n_failed,
  count(*) FILTER (WHERE l_returnflag NOT IN ('N', 'R')) AS n_errors
FROM lineitem GROUP BY l_orderkey"""


def consoles(spark, sf):
    flag = F.col("l_returnflag")
    tests = V.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("trial_id")).agg(
        F.count_if(flag == "N").alias("p"), F.count_if(flag == "R").alias("f"),
        F.count_if(~flag.isin("N", "R")).alias("e"),
    )
    passed = F.concat(F.col("p").cast("string"), F.lit(" passed"))
    failed = F.concat(F.col("f").cast("string"), F.lit(" failed"))
    errors = F.concat(F.col("e").cast("string"), F.when(F.col("e") == 1, " error").otherwise(" errors"))
    counts = F.concat_ws(
        ", ", F.when(F.col("f") > 0, failed), F.when(F.col("p") > 0, passed), F.when(F.col("e") > 0, errors)
    )
    head = F.lit("=== test session starts ===\nplatform linux\ncollected items\n\n")
    lines = F.concat(
        F.repeat(F.lit("PASSED tests/t.py::test_ok[a b]\n"), F.col("p").cast("int")),
        F.repeat(F.lit("FAILED tests/t.py::test_bad - AssertionError: in 5s\n"),
                 F.col("f").cast("int")),
        F.repeat(F.lit("ERROR tests/t.py::test_set_up - fixture 'db' not found\n"), F.col("e").cast("int")),
    )
    seconds = F.concat((F.col("trial_id") % 60).cast("string"), F.lit(".25"))
    rule = F.lit("=" * 12)
    whole = F.concat(head, lines, rule, F.lit(" "), counts, F.lit(" in "), seconds, F.lit("s "), rule)
    body = F.when(F.col("trial_id") % 7 == 0, head).otherwise(whole)
    return tests.select("trial_id", body.alias("body"))


@query("stdout_parse", ctes(c=CONSOLES) + """
SELECT trial_id, CASE WHEN trial_id % 7 <> 0 THEN n_passed END AS n_passed,
  CASE WHEN trial_id % 7 <> 0 THEN n_failed END AS n_failed,
  CASE WHEN trial_id % 7 <> 0 THEN n_errors END AS n_errors,
  CAST(CASE WHEN trial_id % 7 <> 0 THEN trial_id % 60 + 0.25 END AS DOUBLE) AS seconds FROM c""")
def stdout_parse(spark, sf):
    return P.parse_console(consoles(spark, sf)).drop("body")


@query("stdout_tests", """
SELECT l_orderkey AS trial_id,
  CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'N' THEN 'passed' ELSE 'error' END AS status,
  CASE l_returnflag WHEN 'R' THEN 'tests/t.py::test_bad' WHEN 'N' THEN 'tests/t.py::test_ok[a b]'
    ELSE 'tests/t.py::test_set_up' END AS test_name
FROM lineitem WHERE l_orderkey % 7 <> 0""")
def stdout_tests(spark, sf):
    return P.console_tests(consoles(spark, sf))


# --- names and adapters ---------------------------------------------------------------

MODEL_IDS = """
SELECT s_suppkey, concat('Owner/', replace(s_name, '#', '_'), '-Small-', CAST(s_nationkey AS VARCHAR),
  'B-Instruct') AS model_id FROM supplier"""


@query("agent_names", ctes(ids=MODEL_IDS) + """
SELECT s_suppkey, array_to_string(string_split(replace(lower(split_part(model_id, '/', 2)), '_', '-'),
  '-')[1:3], '-') AS agent_name,
  concat('datasets--', replace(model_id, '/', '--')) AS folder FROM ids""")
def agent_names(spark, sf):
    model_id = F.concat(
        F.lit("Owner/"), F.replace(F.col("s_name"), F.lit("#"), F.lit("_")), F.lit("-Small-"),
        F.col("s_nationkey").cast("string"), F.lit("B-Instruct"),
    )
    return V.table(spark, sf, "supplier").select(
        "s_suppkey", N.agent_name(model_id).alias("agent_name"),
        N.cache_folder(model_id).alias("folder"),
    )


@query("adapter_resolve", """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'base-model'
    ELSE concat('adapter-', CAST(user_id AS VARCHAR)) END AS model_name,
  CASE WHEN user_id % 4 = 0 THEN 'base' WHEN s.s_suppkey IS NOT NULL THEN 'adapter'
    ELSE 'unknown' END AS target,
  CASE WHEN user_id % 4 = 0 THEN 'base-model'
    WHEN s.s_suppkey IS NOT NULL THEN concat('/weights/', s.s_name) END AS resolved
FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id""")
def adapter_resolve(spark, sf):
    named = F.concat(F.lit("adapter-"), F.col("user_id").cast("string"))
    requests = V.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("user_id") % 4 == 0, "base-model").otherwise(named).alias("model_name"),
    )
    adapters = V.table(spark, sf, "supplier").select(
        F.concat(F.lit("adapter-"), F.col("s_suppkey").cast("string")).alias("name"),
        F.concat(F.lit("/weights/"), "s_name").alias("path"),
    )
    return registry.resolve_models(requests, adapters, "base-model")


@query("adapter_pairs", """
SELECT p_partkey, concat('brand=', p_brand, ' name=', p_name, ' type=', p_type) AS pairs FROM part""")
def adapter_pairs(spark, sf):
    modules = F.create_map(
        F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type"), F.lit("brand"),
        F.col("p_brand"),
    )
    return V.table(spark, sf, "part").select(
        "p_partkey", F.array_join(N.name_path_pairs(modules), " ").alias("pairs")
    )


@query("adapter_table", """
SELECT p_brand, unnest(['name', 'type']) AS name, unnest([p_name, p_type]) AS path FROM part""")
def adapter_table(spark, sf):
    modules = F.create_map(F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type"))
    registries = V.table(spark, sf, "part").select("p_brand", modules.alias("modules"))
    return registry.explode_adapters(registries, "modules")


# --- task corpora -----------------------------------------------------------------------

# One path per page: valid tasks, deeper files, version control and other files.
PATH = """concat('/corpus/', CASE
  WHEN page_id % 10 = 0 THEN '.github/instruction.md'
  WHEN page_id % 10 = 1 THEN '.gitattributes'
  WHEN page_id % 10 = 2 THEN concat('task-', CAST(page_id AS VARCHAR(20)), '/sub/instruction.md')
  WHEN page_id % 10 = 3 THEN concat('task-', CAST(page_id AS VARCHAR(20)), '/task.toml')
  ELSE concat('task-', CAST(page_id // 2 AS VARCHAR(20)), '/instruction.md') END)"""


def paths(spark, sf):
    return V.table(spark, sf, "pages").selectExpr(f"{PATH.replace('//', 'DIV')} AS path")


@query("valid_tasks", """
SELECT DISTINCT concat('task-', CAST(page_id // 2 AS VARCHAR)) AS task_name
FROM pages WHERE page_id % 10 > 3""")
def valid_tasks(spark, sf):
    return corpus.task_names(paths(spark, sf), "/corpus/")


@query("keep_valid_tasks", """
SELECT page_id FROM pages WHERE page_id IN (
  SELECT page_id // 2 FROM pages WHERE page_id % 10 > 3)""")
def keep_valid_tasks(spark, sf):
    planned = V.table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("task-"), F.col("page_id").cast("string")).alias("task_name")
    )
    valid = corpus.task_names(paths(spark, sf), "/corpus")
    return corpus.keep_valid(planned, valid).select("page_id")


SNAPSHOTS = """
SELECT source, md5(CAST(doc_id % 5 AS VARCHAR)) AS snapshot, doc_id,
  CASE WHEN doc_id % 5 = (doc_id // 5) % 5 THEN 'README.md'
       WHEN doc_id % 3 = 0 THEN '.git/instruction.md'
       ELSE concat('t', CAST(doc_id % 40 AS VARCHAR), '/instruction.md') END AS rest
FROM documents"""


@query("latest_snapshot", ctes(files=SNAPSHOTS, newest="""
SELECT source, max(snapshot) AS latest_snapshot FROM files GROUP BY source""") + """
SELECT concat('datasets--org--', n.source) AS folder, n.latest_snapshot,
  count(DISTINCT CASE WHEN rest LIKE 't%' THEN rest END) AS n_tasks,
  count(DISTINCT CASE WHEN rest LIKE 't%' THEN rest END) > 0 AS usable
FROM newest n JOIN files f ON f.source = n.source AND f.snapshot = n.latest_snapshot
GROUP BY n.source, n.latest_snapshot""")
def latest_snapshot(spark, sf):
    doc = F.col("doc_id")
    rest = (
        F.when(doc % 5 == F.floor(doc / 5) % 5, "README.md")
        .when(doc % 3 == 0, ".git/instruction.md")
        .otherwise(F.concat(F.lit("t"), (doc % 40).cast("string"), F.lit("/instruction.md")))
    )
    folder = N.cache_folder(F.concat(F.lit("org/"), "source"))
    path = F.concat(
        F.lit("/hub/"), folder, F.lit("/snapshots/"), F.md5((doc % 5).cast("string")),
        F.lit("/"), rest,
    )
    listed = V.table(spark, sf, "documents").select(path.alias("path"))
    parts = corpus.split_snapshot_path(F.col("path"))
    return corpus.snapshot_tasks(listed.select(*[c.alias(n) for n, c in parts.items()]), ["folder"])


# --- metric lines -----------------------------------------------------------------------

# One scraped line per event: adapter gauges, other gauges and comments.
METRIC_LINE = """CASE event_type
  WHEN 'error' THEN concat('# HELP vllm:lora_requests_info adapters ', CAST(event_id AS VARCHAR(20)))
  WHEN 'view' THEN concat('process_open_fds ', CAST(event_id AS VARCHAR(20)), '.0')
  WHEN 'signup' THEN 'vllm:lora_requests_info{max_lora="1",max_lora="2"} 7'
  ELSE concat('vllm:lora_requests_info{max_lora="', CAST(user_id % 4 AS VARCHAR(10)),
    '",running_lora_adapters="a', CAST(user_id % 7 AS VARCHAR(10)), ',b"} ',
    CAST(event_id AS VARCHAR(20)), '.5') END"""
METRICS = f"SELECT event_id, ts, {METRIC_LINE} AS line FROM events"


def metric_table(spark, sf):
    return V.table(spark, sf, "events").selectExpr("event_id", "ts", f"{METRIC_LINE} AS line")


@query("metric_lines", ctes(m=METRICS) + """
SELECT event_id, 'vllm:lora_requests_info' AS name,
  regexp_extract(line, 'max_lora="([^"]*)"', 1) AS max_lora,
  regexp_extract(line, 'running_lora_adapters="([^"]*)"', 1) AS running,
  CAST(regexp_extract(line, '([0-9.]+)$', 1) AS DOUBLE) AS value
FROM m WHERE line LIKE 'vllm:lora%running%'""")
def metric_lines(spark, sf):
    lines = metric_table(spark, sf)
    parsed = P.parse_metrics(lines.filter(P.is_adapter_metric(F.col("line"))))
    return parsed.select(
        "event_id", "name", F.col("labels")["max_lora"].alias("max_lora"),
        F.col("labels")["running_lora_adapters"].alias("running"), "value",
    )
