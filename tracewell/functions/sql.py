"""The text rules as SQL functions, for users who write SQL alone.

``register`` declares temporary functions in a session. Their bodies are SQL, so a query that calls them is optimized as a
whole and runs no Python:

    SELECT trial_id, iteration, at + 1 AS cmd_idx, cmd
    FROM (SELECT trial_id, iteration, fenced_commands(reply) AS own FROM replies) LATERAL VIEW posexplode(own) AS at, cmd

    SELECT r.trial_id, r.iteration, c.cmd_idx, c.cmd FROM replies r, LATERAL bash_commands(r.reply) c

Both give the same rows. Spark works the second out as a join on the distinct replies, which shuffles their texts, so it is for
small tables; the first is a projection.

| Function | Returns |
|---|---|
| `py_strip(s)` | text without white space at its ends |
| `is_blank(s)` | whether nothing is left of it |
| `signals_completion(s)` | whether a reply says that its task is complete |
| `fenced_commands(reply)` | array of the commands in fenced blocks |
| `turn_class(reply, error)` | complete, error, no_command or execute |
| `bash_commands(reply)` | table (cmd_idx from 1, cmd) |

Null replies have no command and signal nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tracewell.functions.fences import CLOSING_MARK, OPENING_MARKS
from tracewell.functions.text import COMPLETION_SIGNAL, PY_SPACE

_SPACE = "".join(f"\\u{ord(c):04x}" for c in PY_SPACE)
_OPENS = " OR ".join(f"startswith(bare, '{m}')" for m in OPENING_MARKS)

#: In the order of their declaration, as later ones call earlier ones: name and parameters, result, body.
FUNCTIONS = (
    ("py_strip(s STRING)", "STRING", f"btrim(s, '{_SPACE}')"),
    ("is_blank(s STRING)", "BOOLEAN", "coalesce(py_strip(s), '') = ''"),
    ("signals_completion(s STRING)", "BOOLEAN", f"coalesce(contains(upper(s), '{COMPLETION_SIGNAL}'), false)"),
    # marked lines: where they are, whether they open a block
    ("_fence_marks(lines ARRAY<STRING>)", "ARRAY<STRUCT<at: INT, opens: BOOLEAN>>",
     f"""transform(filter(transform(lines, (line, at) -> struct(at, btrim(line, '{_SPACE}') AS bare)),
         m -> {_OPENS.replace('bare', 'm.bare')} OR m.bare = '{CLOSING_MARK}'),
         m -> struct(m.at AS at, ({_OPENS.replace('bare', 'm.bare')}) AS opens))"""),
    # an opening mark, the next mark closes, and lines between
    ("_between_marks(lines ARRAY<STRING>, marks ARRAY<STRUCT<at: INT, opens: BOOLEAN>>)", "ARRAY<STRING>",
     """transform(
         filter(transform(marks, (m, i) -> struct(m.at AS at, m.opens AS opens, get(marks, i + 1) AS next)),
                s -> s.opens AND s.next IS NOT NULL AND NOT s.next.opens AND s.next.at > s.at + 1),
         s -> array_join(slice(lines, s.at + 2, s.next.at - s.at - 1), '\\n'))"""),
    ("_commands_of(lines ARRAY<STRING>)", "ARRAY<STRING>", "_between_marks(lines, _fence_marks(lines))"),
    ("fenced_commands(reply STRING)", "ARRAY<STRING>", "_commands_of(split(coalesce(reply, ''), '\\n'))"),
    ("turn_class(reply STRING, error STRING)", "STRING",
     """CASE WHEN reply IS NULL THEN 'error' WHEN signals_completion(reply) THEN 'complete'
         WHEN error IS NOT NULL THEN 'error' WHEN size(fenced_commands(reply)) = 0 THEN 'no_command' ELSE 'execute' END"""),
    ("bash_commands(reply STRING)", "TABLE(cmd_idx BIGINT, cmd STRING)",
     "SELECT CAST(c.pos + 1 AS BIGINT), c.col FROM (SELECT fenced_commands(reply) AS own) o LATERAL VIEW posexplode(own) c AS pos, col"),
)


def register(spark: SparkSession) -> None:
    """Declares all functions in the session; doing so again changes nothing."""
    for head, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {result} RETURN {body}")
