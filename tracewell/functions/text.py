"""Text rules: Python-style strip, clipping, completion signal, truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python treats as white space.
PY_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
SPACE_CLASS = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
COMPLETION_SIGNAL = "TASK COMPLETE"


def py_strip(text: Column) -> Column:
    return F.btrim(text, F.lit(PY_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(py_strip(text), F.lit("")) == ""


def signals_completion(text: Column) -> Column:
    return F.coalesce(F.contains(F.upper(text), F.lit(COMPLETION_SIGNAL)), F.lit(False))


def clip(text: Column, limit: int, note: str = "\n... [truncated {n} chars]") -> Column:
    """Keep the first ``limit`` characters and say how many were cut."""
    before, after = note.split("{n}")
    cut = F.concat(
        F.substring(text, 1, limit),
        F.lit(before),
        (F.char_length(text) - limit).cast("string"),
        F.lit(after),
    )
    return F.when(F.char_length(text) > limit, cut).otherwise(text)


def clip_for_console(text: Column, limit: int = 300) -> Column:
    """The console form always ends in dots and names the rest on its own line."""
    head = F.concat(F.substring(text, 1, limit), F.lit("..."))
    rest = F.concat(
        F.lit("\n... ["), (F.char_length(text) - limit).cast("string"), F.lit(" more characters]")
    )
    return F.when(F.char_length(text) > limit, F.concat(head, rest)).otherwise(head)


def preview(text: Column, limit: int = 500) -> Column:
    """First characters plus dots; the dots are added even when nothing was cut."""
    return F.concat(F.substring(text, 1, limit), F.lit("..."))


def words(text: Column) -> Column:
    """White-space tokens of ``text``; an empty array for blank text."""
    stripped = py_strip(F.coalesce(text, F.lit("")))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, SPACE_CLASS + "+")
    )


def truncate_words(text: Column, tokens: Column, limit: int) -> Column:
    """The first ``limit`` tokens, or ``text`` itself when it is short enough."""
    return F.when(
        F.size(tokens) > limit, F.array_join(F.slice(tokens, 1, limit), " ")
    ).otherwise(text)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text without a zone -> TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(text)


def parse_epoch(seconds: Column) -> Column:
    """Epoch seconds as a double -> TIMESTAMP with microseconds."""
    return F.timestamp_seconds(seconds)


def micros(moment: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    return F.unix_micros(moment.cast("timestamp"))


def micros_between(start: Column, stop: Column) -> Column:
    return micros(stop) - micros(start)
