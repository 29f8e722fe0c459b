"""Chat templates, prompts and feedback texts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.functions.text import clip

ROLES = ("system", "user", "assistant")


@dataclass(frozen=True)
class Template:
    """Marks put before and after each message of a role.

    ``forbidden`` lists role changes the template refuses, as (from, to); a conversation
    holding one is reported as ``template_error``.
    """

    marks: dict[str, tuple[str, str]]
    start: str = ""
    forbidden: tuple[tuple[str, str], ...] = field(default=())

    @property
    def may_fail(self) -> bool:
        return bool(self.forbidden) or not set(ROLES) <= set(self.marks)

    def _pick(self, role: Column, side: int, otherwise: Column) -> Column:
        out = None
        for name, marks in self.marks.items():
            case = role == name
            out = F.when(case, marks[side]) if out is None else out.when(case, marks[side])
        return out.otherwise(otherwise)

    def opening(self, role: Column) -> Column:
        return self._pick(role, 0, F.lit(None).cast("string"))

    def closing(self, role: Column) -> Column:
        return self._pick(role, 1, F.lit(None).cast("string"))

    def opening_or_fail(self, role: Column) -> Column:
        fail = F.raise_error(
            F.concat(F.lit("template has no role "), F.coalesce(role, F.lit("null")))
        ).cast("string")
        return self._pick(role, 0, fail)

    def opening_size(self, role: str) -> Column:
        return F.char_length(self.opening(F.col(role))).cast("long")

    def closing_size(self, role: str) -> Column:
        return F.char_length(self.closing(F.col(role))).cast("long")

    def forbids(self, before: Column, after: Column) -> Column:
        """True for a refused role change, or a change to a role without marks."""
        out = F.lit(False) if set(ROLES) <= set(self.marks) else ~after.isin(*self.marks)
        for a, b in self.forbidden:
            out = out | ((before == a) & (after == b))
        return out


CHATML = Template({r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ROLES})

# Same marks, but a system message may only come first and a user must follow it.
STRICT_CHATML = Template(
    CHATML.marks,
    forbidden=(("user", "system"), ("assistant", "system"), ("system", "assistant")),
)

# Texts the agent loop puts into a conversation.
NO_COMMAND_TEXT = (
    "No bash commands detected in your response. You MUST provide commands in ```bash code blocks."
    "\n\nBased on the task description:"
    "\n- If the task is complete and verified, respond with ONLY: 'TASK COMPLETE'"
    "\n- Otherwise, provide your next bash command in a ```bash code block"
    "\n- Do NOT just describe what you would do - actually write the bash command"
    "\n- Do NOT repeat commands you've already run unless you have a specific reason"
    "\n\nRemember: Do not stop until the task is fully and correctly completed."
)
FEEDBACK_TAIL = (
    "\n\nBased on these results:"
    "\n- If this completes all task requirements, respond with 'TASK COMPLETE'"
    "\n- If more steps are needed, provide the NEXT command (do NOT repeat what you just did)"
    "\n- Do NOT verify the same thing again unless there was an error"
    "\n- Move forward with the next logical step"
)
FEEDBACK_SEPARATOR = "\n---\n"
ERROR_FORMAT = "An error occurred: {error}\nPlease try a different approach."
EMPTY_DIRECTORY = "Current directory is empty."
SHORT_DIRECTORY = "Files in current directory ({n} files):"
LONG_DIRECTORY = "Files in current directory (showing first {k} of {n}):"
DEFAULT_DIRECTORY = "/app"
OUTPUT_LIMIT = 1000
LISTING_LIMIT = 10

# The wording around the three placeholders is the caller's; this one is only a default.
SYSTEM_PROMPT = (
    "You solve tasks in a sandbox by running shell commands.\n\n"
    "Your current working directory is:\n{current_directory}\n\n"
    "{file_listing_header}\n{file_listing}\n\n"
    "Put commands in ```bash blocks and say TASK COMPLETE when the task is done."
)


def fill(template: str, **values: Column) -> Column:
    """Literal text with ``{name}`` placeholders replaced by columns, in one pass."""
    parts, rest = [], template
    while rest:
        found = min(
            ((rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest),
            default=None,
        )
        if found is None:
            parts.append(F.lit(rest))
            break
        at, name = found
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts) if parts else F.lit("")


def command_feedback(
    number: Column, cmd: Column, return_code: Column, stdout: Column, stderr: Column,
    limit: int = OUTPUT_LIMIT,
) -> Column:
    """What the agent is told about one command; an empty stream is left out."""

    def stream(title: str, text: Column) -> Column:
        shown = F.concat(F.lit(f"{title}:\n"), clip(text, limit), F.lit("\n"))
        return F.when(F.coalesce(text, F.lit("")) != "", shown).otherwise("")

    return F.concat(
        F.lit("Command "), number.cast("string"), F.lit(": "), cmd, F.lit("\n"),
        F.lit("Exit code: "), return_code.cast("string"), F.lit("\n"),
        stream("STDOUT", stdout), stream("STDERR", stderr),
    )


def error_text(error: Column) -> Column:
    return fill(ERROR_FORMAT, error=error)
