"""Checked queries over conversations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from tracewell.functions.templates import STRICT_CHATML
from tracewell.functions.text import PY_SPACE, is_blank, py_strip
from tracewell.operators import conversations as C
from tracewell.operators import plugins
from tracewell.plans import views as V
from tracewell.plans.catalog import ORACLES, ctes, query
from tracewell.session import scratch_dir
from tracewell.sources.datasets import read_conversations
from tracewell.sources.writers import first_row_preview, write_training_text
from tracewell.schemas import CONVERSATIONS

CAP = 250
FIRST = 40

SPACE_SQL = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]"

KEPT = f"""
SELECT conv_id, turn, content,
  CASE WHEN lower(role) IN ('human', 'user') THEN 'user'
       WHEN lower(role) IN ('gpt', 'assistant', 'bot') THEN 'assistant'
       WHEN lower(role) = 'system' THEN 'system' END AS role
FROM (SELECT conv_id, turn, role, text AS content FROM src
      WHERE NOT regexp_full_match(text, '{SPACE_SQL}*')) t
WHERE lower(role) IN ('human', 'user', 'gpt', 'assistant', 'bot', 'system')"""
MESSAGES = """
SELECT conv_id, seg, role, string_agg(content, concat(chr(10), chr(10)) ORDER BY turn) AS content
FROM (SELECT *, sum(starts) OVER (PARTITION BY conv_id ORDER BY turn) AS seg
      FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = role
                           THEN 0 ELSE 1 END AS starts FROM kept) f) n
GROUP BY conv_id, seg, role"""
CHECKED = """
SELECT c.conv_id, r.text, r.n_turns,
  CASE WHEN r.conv_id IS NULL THEN 'empty'
       WHEN r.first_role = 'assistant' THEN 'starts_assistant'
       WHEN r.last_role <> 'assistant' THEN 'not_ends_assistant' END AS drop_reason
FROM (SELECT DISTINCT conv_id FROM src) c LEFT JOIN (
  SELECT conv_id, count(*) AS n_turns, arg_min(role, seg) AS first_role,
    arg_max(role, seg) AS last_role,
    string_agg(concat('<|im_start|>', role, chr(10), content, '<|im_end|>', chr(10)), ''
               ORDER BY seg) AS text
  FROM messages GROUP BY conv_id) r ON c.conv_id = r.conv_id"""


def formatted_sql(src: str, tail: str, **more: str) -> str:
    return ctes(
        src=src, kept=KEPT, messages=MESSAGES, checked=CHECKED, **more
    ) + tail


NOISY = V.SQL["noisy_conversations"]
PLAIN = "SELECT conv_id, turn, role, text FROM conversations"
KEEP = "FROM checked WHERE drop_reason IS NULL"


def _plain(spark, sf):
    return V.table(spark, sf, "conversations")


@query("sft_format", formatted_sql(NOISY, f"SELECT conv_id, text, n_turns {KEEP}"))
def sft_format(spark, sf):
    return C.format_conversations(V.noisy_conversations(spark, sf)).drop("drop_reason")


@query("sft_drop_reasons", formatted_sql(NOISY, """
SELECT conv_id, drop_reason,
  CASE WHEN drop_reason IS NULL THEN n_turns END AS n_turns FROM checked"""))
def sft_drop_reasons(spark, sf):
    return C.format_conversations(V.noisy_conversations(spark, sf), keep_dropped=True).drop("text")


@query("sft_strict_template", formatted_sql(NOISY, """
SELECT c.conv_id, CASE WHEN drop_reason IS NOT NULL THEN drop_reason
  WHEN b.conv_id IS NOT NULL THEN 'template_error' END AS drop_reason
FROM checked c LEFT JOIN (
  SELECT DISTINCT m.conv_id FROM messages m JOIN messages p
    ON m.conv_id = p.conv_id AND m.seg = p.seg + 1
  WHERE m.role = 'system' OR (p.role = 'system' AND m.role = 'assistant')) b
ON c.conv_id = b.conv_id"""))
def sft_strict_template(spark, sf):
    noisy = V.noisy_conversations(spark, sf)
    return C.format_conversations(noisy, STRICT_CHATML, keep_dropped=True).select(
        "conv_id", "drop_reason"
    )


@query("sft_drop_report", formatted_sql(NOISY, """
SELECT count(*) AS n_before, count(*) FILTER (WHERE drop_reason IS NULL) AS n_after,
  count(drop_reason) AS n_dropped,
  count(*) FILTER (WHERE drop_reason = 'empty') AS n_empty,
  count(*) FILTER (WHERE drop_reason = 'starts_assistant') AS n_starts_assistant,
  count(*) FILTER (WHERE drop_reason = 'not_ends_assistant') AS n_not_ends_assistant
FROM checked"""))
def sft_drop_report(spark, sf):
    return C.drop_report(V.noisy_conversations(spark, sf))


@query("sft_first_n", formatted_sql(NOISY, f"""
SELECT conv_id, text {KEEP} AND conv_id IN (
  SELECT conv_id FROM (SELECT DISTINCT conv_id FROM src) d ORDER BY conv_id LIMIT {FIRST})"""))
def sft_first_n(spark, sf):
    first = C.first_conversations(V.noisy_conversations(spark, sf), FIRST)
    return C.format_conversations(first).select("conv_id", "text")


@query("sft_nested_format", formatted_sql(NOISY, f"SELECT conv_id, text, n_turns {KEEP}"))
def sft_nested_format(spark, sf):
    return C.format_nested(C.nest_turns(V.noisy_conversations(spark, sf))).drop("drop_reason")


MERGED = "SELECT conv_id, CAST(seg - 1 AS BIGINT) AS msg_idx, role, content FROM messages"


@query("sft_messages", formatted_sql(NOISY, MERGED))
def sft_messages(spark, sf):
    return C.merge_turns(V.noisy_conversations(spark, sf))


@query("sft_messages_nested", formatted_sql(NOISY, MERGED))
def sft_messages_nested(spark, sf):
    merged = C.merge_nested(C.nest_turns(V.noisy_conversations(spark, sf)))
    return merged.select("conv_id", F.posexplode("messages").alias("i", "m")).select(
        "conv_id", F.col("i").cast("long").alias("msg_idx"), "m.role", "m.content"
    )


@query("sft_format_raw", """
SELECT conv_id, count(*) AS n_messages,
  string_agg(concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), ''
             ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def sft_format_raw(spark, sf):
    raw = C.format_raw(C.nest_turns(_plain(spark, sf)))
    return raw.select("conv_id", F.size("conversations").cast("long").alias("n_messages"), "text")


WORDS = f"""
SELECT conv_id, text, CAST(len(list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'),
  lambda w: w <> '')) AS BIGINT) AS n_tokens,
  list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'), lambda w: w <> '') AS ws
{KEEP}"""


@query("sft_lengths", formatted_sql(PLAIN, f"""
SELECT count(*) AS n_rows, max(n_tokens) AS max_tokens,
  count(*) FILTER (WHERE n_tokens > {CAP}) AS n_over_cap,
  round(avg(CASE WHEN n_tokens > {CAP} THEN 1.0 ELSE 0.0 END), 9) AS share_over_cap,
  round(quantile_cont(n_tokens, 0.5), 6) AS p50, round(quantile_cont(n_tokens, 0.9), 6) AS p90,
  round(quantile_cont(n_tokens, 0.99), 6) AS p99
FROM toks""", toks=WORDS))
def sft_lengths(spark, sf):
    report = C.length_report(C.format_conversations(_plain(spark, sf)), CAP)
    return report.withColumns(
        {"share_over_cap": F.round("share_over_cap", 9),
         **{p: F.round(p, 6) for p in ("p50", "p90", "p99")}}
    )


@query("sft_truncate", formatted_sql(PLAIN, f"""
SELECT conv_id, n_tokens, n_tokens > {CAP} AS was_truncated,
  CASE WHEN n_tokens > {CAP} THEN array_to_string(ws[1:{CAP}], ' ') ELSE text END AS text
FROM toks""", toks=WORDS))
def sft_truncate(spark, sf):
    formatted = C.format_conversations(_plain(spark, sf)).select("conv_id", "text")
    return C.truncate(formatted, CAP)


@query("sft_preview", formatted_sql(PLAIN, f"""
SELECT conv_id, concat(substring(text, 1, 500), '...') AS text
{KEEP} ORDER BY conv_id LIMIT 1"""))
def sft_preview(spark, sf):
    first = C.first_formatted(_plain(spark, sf)).select("conv_id", "text")
    return first_row_preview(first, "conv_id")


@query("response_spans", formatted_sql(NOISY, """
SELECT conv_id, CAST(seg - 1 AS BIGINT) AS msg_idx,
  CAST(stop - length('<|im_end|>') - 1 - length(content) AS BIGINT) AS start,
  CAST(stop - length('<|im_end|>') - 1 AS BIGINT) AS stop
FROM (SELECT m.*, sum(length(concat('<|im_start|>', role, chr(10), content, '<|im_end|>', chr(10))))
        OVER (PARTITION BY conv_id ORDER BY seg) AS stop FROM messages m) s
WHERE role = 'assistant' AND conv_id IN (SELECT conv_id FROM checked WHERE drop_reason IS NULL)"""))
def response_spans(spark, sf):
    return C.response_spans(V.noisy_conversations(spark, sf))


#: One turn of each conversation has lost its number, which puts it first.
UNNUMBERED = f"""
SELECT conv_id, CASE WHEN turn = 1 + conv_id % 4 THEN -1 ELSE turn END AS turn, role, text FROM ({NOISY}) n"""


def _unnumbered(spark, sf):
    turns = V.noisy_conversations(spark, sf)
    return turns.withColumn("turn", F.when(F.col("turn") != 1 + F.col("conv_id") % 4, F.col("turn")))


@query("unnumbered_drop_report", ORACLES["sft_drop_report"].replace(NOISY.strip(), UNNUMBERED.strip()))
def unnumbered_drop_report(spark, sf):
    return C.drop_report(_unnumbered(spark, sf))


@query("unnumbered_format", ORACLES["sft_format"].replace(NOISY.strip(), UNNUMBERED.strip()))
def unnumbered_format(spark, sf):
    return C.format_conversations(_unnumbered(spark, sf)).select("conv_id", "text", "n_turns")


@query("unnumbered_spans", ORACLES["response_spans"].replace(NOISY.strip(), UNNUMBERED.strip()))
def unnumbered_spans(spark, sf):
    return C.response_spans(_unnumbered(spark, sf))


@query("unnumbered_preview", ORACLES["sft_preview"].replace(PLAIN, UNNUMBERED.strip()))
def unnumbered_preview(spark, sf):
    return first_row_preview(C.first_formatted(_unnumbered(spark, sf)).select("conv_id", "text"), "conv_id")


@query("epoch_order", ctes(ids="SELECT DISTINCT conv_id FROM conversations") + """
SELECT conv_id, CAST(epoch AS BIGINT) AS epoch, row_number() OVER (PARTITION BY epoch
  ORDER BY md5(concat('42:', CAST(epoch AS VARCHAR), ':', CAST(conv_id AS VARCHAR))), conv_id) - 1 AS position
FROM ids, (SELECT unnest([0, 1]) AS epoch) e""")
def epoch_order(spark, sf):
    return C.epoch_order(_plain(spark, sf).select("conv_id").distinct(), "conv_id", epochs=2)


@query("python_strip", ctes(src=NOISY) + f"""
SELECT conv_id, turn, regexp_full_match(text, '{SPACE_SQL}*') AS is_blank,
  regexp_replace(regexp_replace(text, '^{SPACE_SQL}+', ''), '{SPACE_SQL}+$', '') AS stripped,
  lower(role) AS lowered, upper(role) AS uppered FROM src""")
def python_strip(spark, sf):
    padded = F.col("text")
    return V.noisy_conversations(spark, sf).select(
        "conv_id", "turn", is_blank(padded).alias("is_blank"),
        py_strip(padded).alias("stripped"), F.lower("role").alias("lowered"),
        F.upper("role").alias("uppered"),
    )


@query("role_fallback", ctes(src=NOISY) + """
SELECT conv_id, turn, CASE WHEN lower(role) IN ('human', 'user') THEN 'user'
  WHEN lower(role) IN ('gpt', 'assistant', 'bot') THEN 'assistant'
  WHEN lower(role) = 'system' THEN 'system' END AS role FROM src""")
def role_fallback(spark, sf):
    moved = V.noisy_conversations(spark, sf).withColumns(
        {"from": F.when(F.col("turn") % 2 == 0, F.col("role")),
         "role": F.when(F.col("turn") % 2 != 0, F.col("role"))}
    )
    role = C.normalise_role(C.role_or_from(F.col("role"), F.col("from")))
    return moved.select("conv_id", "turn", role.alias("role"))


@query("scan_conversations", formatted_sql(NOISY, f"SELECT conv_id, text {KEEP}"))
def scan_conversations(spark, sf):
    path = scratch_dir(spark, "conversations")
    C.nest_turns(V.noisy_conversations(spark, sf)).withColumns(
        {"config": F.lit("default"), "split": F.lit("train")}
    ).write.partitionBy("config", "split").json(path)
    nested = read_conversations(spark, path, "default", "train", "json", CONVERSATIONS)
    return C.format_nested(nested).select("conv_id", "text")


@query("training_text_write", formatted_sql(NOISY, f"SELECT text {KEEP}"))
def training_text_write(spark, sf):
    path = scratch_dir(spark, "training-text")
    write_training_text(C.format_conversations(V.noisy_conversations(spark, sf)), path)
    return spark.read.schema("text STRING").parquet(path)


# --- user code ------------------------------------------------------------------

SHOUT_SQL = "SELECT conv_id, turn, concat(upper(role), ': ', text) AS formatted FROM conversations"


@query("udf_formatter", SHOUT_SQL)
def udf_formatter(spark, sf):
    def formatter(role, text):
        return F.concat(F.upper(role), F.lit(": "), text)

    out = plugins.apply_formatter(_plain(spark, sf), formatter, "role", "text", out="formatted")
    return out.select("conv_id", "turn", "formatted")


@query("udf_row_function", SHOUT_SQL)
def udf_row_function(spark, sf):
    out = plugins.apply_row_function(
        _plain(spark, sf), lambda role, text: f"{role.upper()}: {text}", "role", "text",
        out="formatted",
    )
    return out.select("conv_id", "turn", "formatted")


@query("udf_batched_formatter", SHOUT_SQL)
def udf_batched_formatter(spark, sf):
    def formatter(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(formatted=batch["role"].str.upper() + ": " + batch["text"])

    out = plugins.apply_batched(_plain(spark, sf), formatter, {"formatted": "string"})
    return out.select("conv_id", "turn", "formatted")


@query("udf_tokenizer", f"""
SELECT conv_id, turn, CAST(len(list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'),
  lambda w: w <> '')) AS BIGINT) AS n_tokens FROM conversations""")
def udf_tokenizer(spark, sf):
    def load():
        splitter = re.compile(f"[^{re.escape(PY_SPACE)}]+")
        return splitter.findall

    count = plugins.token_counter(load)
    return _plain(spark, sf).select("conv_id", "turn", count(F.col("text")).alias("n_tokens"))


@query("udf_reward", """
SELECT conv_id, turn, CAST(CASE WHEN length(text) % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS reward
FROM conversations""")
def udf_reward(spark, sf):
    score = plugins.reward_function(lambda done, wanted: float(done.strip() == wanted.strip()))
    wanted = F.when(F.char_length("text") % 2 == 0, F.concat(F.lit(" "), "text")).otherwise("?")
    return _plain(spark, sf).select("conv_id", "turn", score(F.col("text"), wanted).alias("reward"))


@query("udf_truncate", ctes(toks=f"""
SELECT conv_id, turn, text, list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'),
  lambda w: w <> '') AS ws FROM conversations""") + """
SELECT conv_id, turn, CAST(len(ws) AS BIGINT) AS n_tokens, len(ws) > 60 AS was_truncated,
  CASE WHEN len(ws) > 60 THEN array_to_string(ws[1:60], ' ') ELSE text END AS text FROM toks""")
def udf_truncate(spark, sf):
    cut = plugins.token_truncator(lambda: (str.split, " ".join), 60)
    return _plain(spark, sf).select("conv_id", "turn", cut(F.col("text")).alias("t")).select(
        "conv_id", "turn", "t.*"
    )


@query("udf_render", formatted_sql(NOISY, """
SELECT c.conv_id, c.text FROM checked c WHERE drop_reason IS NULL AND conv_id NOT IN (
  SELECT p.conv_id FROM messages p JOIN messages m ON m.conv_id = p.conv_id AND m.seg = 2
  WHERE p.seg = 1 AND p.role = 'system' AND m.role = 'assistant')"""))
def udf_render(spark, sf):
    noisy = V.noisy_conversations(spark, sf)
    ok = C.conversation_ends(noisy).filter(F.col("drop_reason").isNull())
    merged = C.merge_nested(C.nest_turns(noisy).join(ok, "conv_id", "left_semi"))

    def load():
        def render(messages: list[dict]) -> str:
            if messages[1]["role"] == "assistant" and messages[0]["role"] == "system":
                raise ValueError("a user must speak first")
            return "".join(
                f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in messages
            )

        return render

    render = plugins.chat_renderer(load)
    rendered = merged.select("conv_id", render(F.col("messages")).alias("text"))
    return C.drop_blank(rendered)
