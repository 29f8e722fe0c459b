"""Shell commands inside fenced blocks of a reply.

A line whose stripped form starts with an opening mark (re)starts a block, a line
whose stripped form is exactly the closing mark ends it. So a command is exactly the
text between an opening line and the next marked line, when that one is a closing
line. Looking at neighbouring marks keeps the work linear in the number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.pin import pin
from tracewell.functions.text import py_strip

# Block marks.
OPENING_MARKS = ("```bash", "```sh")
CLOSING_MARK = "```"


def _opens(stripped: Column) -> Column:
    test = F.startswith(stripped, F.lit(OPENING_MARKS[0]))
    for mark in OPENING_MARKS[1:]:
        test = test | F.startswith(stripped, F.lit(mark))
    return test


def fence_marks(lines: Column) -> Column:
    """Array of (at, opens) for the opening and closing lines, in order."""
    numbered = F.transform(
        lines, lambda line, at: F.struct(at.alias("at"), py_strip(line).alias("bare"))
    )
    marks = F.filter(numbered, lambda m: _opens(m["bare"]) | (m["bare"] == CLOSING_MARK))
    return F.transform(
        marks, lambda m: F.struct(m["at"].alias("at"), _opens(m["bare"]).alias("opens"))
    )


def commands_between(lines: Column, marks: Column) -> Column:
    """Commands of a reply, given its lines and marks as columns of the same row."""
    spans = F.transform(
        marks,
        lambda mark, i: F.struct(
            mark["at"].alias("at"),
            mark["opens"].alias("opens"),
            F.get(marks, i + 1).alias("next"),
        ),
    )
    complete = F.filter(
        spans,
        lambda s: s["opens"]
        & s["next"].isNotNull()
        & ~s["next"]["opens"]
        & (s["next"]["at"] > s["at"] + 1),
    )
    return F.transform(
        complete,
        lambda s: F.array_join(
            F.slice(lines, s["at"] + 2, s["next"]["at"] - s["at"] - 1), "\n"
        ),
    )


def with_commands(df, reply: str = "reply", out: str = "commands"):
    """Add the array of commands of each reply; a null reply has none."""
    lines = pin(df, _lines=F.split(F.coalesce(F.col(reply), F.lit("")), "\n"))
    marked = pin(lines, _marks=fence_marks(F.col("_lines")))
    found = pin(marked, **{out: commands_between(F.col("_lines"), F.col("_marks"))})
    return found.drop("_lines", "_marks")
