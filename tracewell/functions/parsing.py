"""Parsers for the text artifacts of a run: tracebacks, logs, consoles, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.pin import pin
from tracewell.functions.text import py_strip

# The line formats of the artifacts.
EXCEPTION_LINE = r"^((?:[A-Za-z_]\w*\.)*([A-Za-z_]\w*))(?::\s?(.*))?$"
TIMEOUT_SECONDS = r"timed out after ([0-9]+(?:\.[0-9]+)?) seconds"
LOG_EXCLUDED = r"^Exception (\S+) is in exclude_exceptions, not retrying$"
LOG_NOT_RETRYING = r"^Not retrying trial because (.*)$"
LOG_FAILED = r"^Trial (\S+) failed: (.*)$"
CONSOLE_SUMMARY = r"^=+ .*\bin [0-9.]+s(?: \([^)]*\))? =+$"
CONSOLE_TEST = r"^(PASSED|FAILED|ERROR) (.*?)(?: - .*)?$"
CHAIN_TEXTS = {  # what stands between two links of a chained traceback
    "cause": "The above exception was the direct cause of the following exception:",
    "context": "During handling of the above exception, another exception occurred:",
}
TRACE_HEAD = r"^Traceback(?: \(most recent call last\):)?\n"
FRAME_LINE = r'(?m)^ *File "([^"\n]+)", line ([0-9]+)(?:, in (.*))?$'
METRIC_LINE = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+-?[0-9]+)?$"
METRIC_LABEL = r'([A-Za-z_][A-Za-z0-9_]*)="([^"\\]*(?:\\.[^"\\]*)*)"'
ADAPTER_METRICS = "vllm:lora_requests_info|running_lora_adapters|waiting_lora_adapters"


def _found(text: Column, pattern: str, group: int) -> Column:
    """Captured group, or null when the pattern does not match or the group is empty."""
    hit = F.regexp_extract(text, pattern, group)
    return F.when(F.rlike(text, F.lit(pattern)) & (hit != ""), hit)


def last_line(body: Column) -> Column:
    """Last non-blank line, stripped."""
    return py_strip(F.substring_index(py_strip(body), "\n", -1))


_BETWEEN = "|".join(rf"\Q{t}\E" for t in CHAIN_TEXTS.values())


def exception_text(link: Column) -> Column:
    """What a traceback says after its frames: the first line that is not indented, and all that follows."""
    bare = F.regexp_replace(F.regexp_replace(link, r"^\s*\n|\s+$", ""), TRACE_HEAD, "")
    return F.regexp_extract(bare, r"(?ms)^[^ \t\n].*\z", 0)


def _last_exception(body: Column) -> tuple[Column, Column]:
    """Text of the last link, and the line that names its class: the first one, or where that is something else the last."""
    text = exception_text(F.element_at(F.split(py_strip(body), rf"(?m)^(?:{_BETWEEN})$"), -1))
    head = F.substring_index(text, "\n", 1)
    named = F.rlike(head, F.lit(EXCEPTION_LINE))
    return F.when(named, text).otherwise(last_line(body)), F.when(named, head).otherwise(last_line(body))


def timeout_seconds(text: Column) -> Column:
    return _found(text, TIMEOUT_SECONDS, 1).cast("double")


def parse_exceptions(df: DataFrame, body: str = "body") -> DataFrame:
    """``exc_type`` (the class without its module), ``exc_message`` (all that follows it) and ``timeout_sec``."""
    text, line = _last_exception(F.col(body))
    rows = pin(df, _text=text, _line=line)
    start = F.char_length(F.regexp_extract("_line", EXCEPTION_LINE, 1)) + 1
    rest = F.regexp_replace(F.substring("_text", start, F.char_length("_text")), r"^:\s?", "")
    return rows.withColumns(
        {
            "exc_type": _found(F.col("_line"), EXCEPTION_LINE, 2),
            "exc_message": F.when(F.rlike("_line", F.lit(EXCEPTION_LINE)) & (rest != ""), rest),
            "timeout_sec": timeout_seconds(F.col("_text")),
        }
    ).drop("_text", "_line")


def exception_links(df: DataFrame, body: str = "body") -> DataFrame:
    """The links of chained tracebacks, a row each; other columns are repeated.

    ``link`` counts from 1, the first cause; ``led_by`` says what a link has to do with the one before: cause or
    context, null for the first. ``exc_type`` is the class without its module, ``exc_class`` with it, ``message`` all that follows, over several
    lines if need be. ``n_frames``, ``file``, ``line_no`` and ``function`` tell the frames and the innermost of them, null
    for a link without any. A null or blank body has no link.
    """
    others = [c for c in df.columns if c != body]
    text = F.regexp_replace(F.coalesce(F.col(body), F.lit("")), r"\r\n", "\n")
    parts = pin(
        df.select(*others, text.alias("_text")),
        _texts=F.filter(F.split("_text", rf"(?m)^(?:{_BETWEEN})$"), lambda x: py_strip(x) != ""),
        _marks=F.regexp_extract_all("_text", F.lit(f"(?m)^({_BETWEEN})$"), F.lit(1)),
    )
    links = parts.select(*others, "_marks", F.posexplode("_texts").alias("_at", "_link"))
    mark = F.get("_marks", F.col("_at") - 1)
    named = F.when(mark == CHAIN_TEXTS["cause"], "cause").when(mark == CHAIN_TEXTS["context"], "context")
    rows = pin(links, _ending=exception_text(F.col("_link")), _files=F.regexp_extract_all("_link", F.lit(FRAME_LINE), F.lit(1)),
               _lines=F.regexp_extract_all("_link", F.lit(FRAME_LINE), F.lit(2)),
               _names=F.regexp_extract_all("_link", F.lit(FRAME_LINE), F.lit(3)))
    head = F.substring_index("_ending", "\n", 1)
    rest = F.substring("_ending", F.char_length(_or_empty(_found(head, EXCEPTION_LINE, 1))) + 1, F.char_length("_ending"))
    known = _found(head, EXCEPTION_LINE, 1)
    message = F.regexp_replace(rest, r"^:\s?", "")
    last = lambda c: F.element_at(c, -1)
    return rows.select(
        *others, (F.col("_at") + 1).cast("long").alias("link"), named.alias("led_by"),
        _found(head, EXCEPTION_LINE, 2).alias("exc_type"), known.alias("exc_class"),
        F.when(known.isNull(), F.when(F.col("_ending") != "", F.col("_ending"))).otherwise(F.when(message != "", message)).alias("message"),
        F.size("_files").cast("long").alias("n_frames"),
        F.when(F.size("_files") > 0, last("_files")).alias("file"),
        F.when(F.size("_files") > 0, last("_lines").cast("long")).alias("line_no"),
        F.when((F.size("_files") > 0) & (last("_names") != ""), last("_names")).alias("function"),
    )


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def parse_log_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Classify job and trial log lines; unknown lines get a null ``kind``."""
    text = F.col(line)
    excluded = F.rlike(text, F.lit(LOG_EXCLUDED))
    failed = F.rlike(text, F.lit(LOG_FAILED))
    waived = F.rlike(text, F.lit(LOG_NOT_RETRYING))
    return df.withColumns(
        {
            "kind": F.when(excluded, "excluded")
            .when(waived, "not_retrying")
            .when(failed, "trial_failed"),
            "exc_type": _found(text, LOG_EXCLUDED, 1),
            "trial_name": _found(text, LOG_FAILED, 1),
            "message": F.when(failed, F.regexp_extract(text, LOG_FAILED, 2)).when(
                waived, F.regexp_extract(text, LOG_NOT_RETRYING, 1)
            ),
        }
    )


def console_lines(body: Column) -> Column:
    return F.split(body, "\r?\n")


def parse_console(df: DataFrame, body: str = "body") -> DataFrame:
    """Totals of a test console; all null when the console was cut off."""
    totals = F.filter(console_lines(F.col(body)), lambda l: F.rlike(l, F.lit(CONSOLE_SUMMARY)))
    summary = F.get(F.reverse(totals), 0)
    line = F.col("_summary")

    def count(word: str) -> Column:
        found = _found(line, rf"([0-9]+) {word}", 1).cast("long")
        return F.when(line.isNotNull(), F.coalesce(found, F.lit(0)))

    return (
        df.withColumn("_summary", summary)
        .withColumns(
            {
                "n_passed": count("passed"),
                "n_failed": count("failed"),
                "n_errors": count("errors?"),
                "seconds": _found(line, r"\bin ([0-9.]+)s", 1).cast("double"),
            }
        )
        .drop("_summary")
    )


def console_tests(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per PASSED, FAILED or ERROR line of a test console; a test's id goes up to the
    reason, or to the end of the line, and may hold blanks."""
    line = F.col("_line")
    return (
        df.withColumn("_line", F.explode(console_lines(F.col(body))))
        .filter(F.rlike(line, F.lit(CONSOLE_TEST)))
        .withColumns(
            {
                "status": F.lower(F.regexp_extract(line, CONSOLE_TEST, 1)),
                "test_name": F.regexp_extract(line, CONSOLE_TEST, 2),
            }
        )
        .drop("_line", body)
    )


def parse_metrics(df: DataFrame, line: str = "line") -> DataFrame:
    """Metric lines -> name, labels, value; comment and broken lines are dropped, and lines
    that give a label twice are broken."""
    text = F.col(line)
    names = F.regexp_extract_all("_labels", F.lit(METRIC_LABEL), F.lit(1))
    values = F.regexp_extract_all("_labels", F.lit(METRIC_LABEL), F.lit(2))
    single = F.size(F.array_distinct("_names")) == F.size("_names")
    return (
        df.filter(F.rlike(text, F.lit(METRIC_LINE)))
        .withColumns(
            {
                "name": F.regexp_extract(text, METRIC_LINE, 1),
                "_labels": F.regexp_extract(text, METRIC_LINE, 2),
                "value": F.regexp_extract(text, METRIC_LINE, 3).try_cast("double"),
            }
        )
        .withColumns({"_names": names, "_values": values})
        .filter(single)
        .withColumn("labels", F.when(single, F.map_from_arrays("_names", "_values")))
        .drop("_labels", "_names", "_values")
    )


def is_adapter_metric(line: Column) -> Column:
    return F.rlike(line, F.lit(ADAPTER_METRICS))
