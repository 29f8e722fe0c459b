"""Conversations: clean, merge, check, render, limit, report.

The flat form has one row per turn (``conv_id, turn, role, text``); the nested form has
one row per conversation with an array of ``(role, from, content)``.

Rendering never builds merged messages first. A *piece* is a stretch of consecutive kept
turns: the first and last role, and the text in between. Two neighbouring pieces are put
together with the merge separator when their touching roles agree, otherwise with the end
mark of one role and the start mark of the next. This is associative, so long conversations
are put together in stretches of ``HEAD_TURNS`` turns first; one shuffle, by conversation,
serves both steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.pin import pin
from tracewell.functions.templates import CHATML, Template
from tracewell.functions.text import is_blank, truncate_words, words
from tracewell.operators.blocks import join_by, ordered
from tracewell.operators.quantiles import exact_quantiles
from tracewell.session import written_table

# Accepted role names and the merge separator.
USER_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant", "bot")
SYSTEM_ROLES = ("system",)
MERGE_SEPARATOR = "\n\n"
DROP_REASONS = ("empty", "starts_assistant", "not_ends_assistant", "template_error")

HEAD_TURNS = 4096


def normalise_role(role: Column) -> Column:
    """Canonical role, or null for a role that is skipped. Not trimmed on purpose."""
    lowered = F.lower(role)
    return (
        F.when(lowered.isin(*USER_ROLES), "user")
        .when(lowered.isin(*ASSISTANT_ROLES), "assistant")
        .when(lowered.isin(*SYSTEM_ROLES), "system")
    )


def role_or_from(role: Column, sender: Column) -> Column:
    return F.coalesce(role, sender, F.lit(""))


def _marked_turns(turns: DataFrame) -> DataFrame:
    """Turns with canonical roles and whether they are ``kept``: blank and unknown ones are not."""
    role = role_or_from(F.col("role"), F.col("from")) if "from" in turns.columns else F.col("role")
    role = normalise_role(role)
    return turns.select(
        "conv_id", "turn", role.alias("role"), F.col("text").alias("content"),
        (~is_blank(F.col("text")) & role.isNotNull()).alias("kept"),
    )


def clean_turns(turns: DataFrame) -> DataFrame:
    """Kept turns only, with canonical roles: blank and unknown ones go."""
    return _marked_turns(turns).filter("kept").drop("kept")


def explode_turns(nested: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Nested rows -> flat turns."""
    return nested.select(
        F.col(conv).alias("conv_id"), F.posexplode("conversations").alias("turn", "m")
    ).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.from",
        F.col("m.content").alias("text"),
    )


def nest_turns(turns: DataFrame) -> DataFrame:
    """Flat turns -> one row per conversation in the nested source shape."""
    message = F.struct(
        F.col("turn"),
        F.col("role"),
        (F.col("from") if "from" in turns.columns else F.lit(None).cast("string")).alias("from"),
        F.col("text").alias("content"),
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(message)).alias("m"))
        .select(
            "conv_id",
            F.transform(
                "m",
                lambda x: F.struct(x["role"].alias("role"), x["from"].alias("from"),
                                   x["content"].alias("content")),
            ).alias("conversations"),
        )
    )


# --- pieces -----------------------------------------------------------------


def _piece(pos: Column, role: Column, content: Column) -> Column:
    return F.struct(
        pos.cast("long").alias("pos"),
        role.alias("first"),
        role.alias("last"),
        content.alias("body"),
        F.lit(1).cast("long").alias("messages"),
        F.lit(False).alias("broken"),
    )


def _stitch(pieces: Column, template: Template) -> dict[str, Column]:
    """The fields of one piece made of an ordered, non-empty array of pieces.

    ``pieces`` must be a plain column: it is looked up once per element, so an expression
    in its place would be worked out again each time.
    """

    def before(i: Column) -> Column:
        return F.get(pieces, i - 1)["last"]

    def glued(x: Column, i: Column) -> Column:
        glue = (
            F.when(i == 0, F.lit(""))
            .when(before(i) == x["first"], F.lit(MERGE_SEPARATOR))
            .otherwise(F.concat(template.closing(before(i)), template.opening(x["first"])))
        )
        return F.concat(glue, x["body"])

    def breaks(x: Column, i: Column) -> Column:
        return x["broken"] | ((i > 0) & template.forbids(before(i), x["first"]))

    def new_messages(x: Column, i: Column) -> Column:
        return x["messages"] - ((i > 0) & (before(i) == x["first"])).cast("long")

    if template.may_fail:
        broken = F.exists(F.transform(pieces, breaks), lambda b: b)
    else:
        broken = F.lit(False)
    return {
        "pos": F.get(pieces, 0)["pos"],
        "first": F.get(pieces, 0)["first"],
        "last": F.element_at(pieces, -1)["last"],
        "body": F.array_join(F.transform(pieces, glued), ""),
        "messages": F.aggregate(
            F.transform(pieces, new_messages), F.lit(0).cast("long"), lambda a, n: a + n
        ),
        "broken": broken,
    }


def _end_reason(empty: Column, first: Column, last: Column) -> Column:
    """Drop reason decided by the two ends, the start being checked first."""
    return (
        F.when(empty, "empty")
        .when(first == "assistant", "starts_assistant")
        .when(last != "assistant", "not_ends_assistant")
    )


def _render(df: DataFrame, template: Template, keep_dropped: bool) -> DataFrame:
    """``_early`` (reason known from the ends) and ``_pieces`` (ordered) -> text, n_turns,
    drop_reason, next to the other columns.

    The results are pinned: a filter on the reason must not work out the text again.
    """
    others = [c for c in df.columns if c not in ("_early", "_pieces")]
    if not keep_dropped:
        df = df.filter(F.col("_early").isNull())
    parts = {f"_{n}": c for n, c in _stitch(F.col("_pieces"), template).items() if n != "pos"}
    whole = df.withColumns(
        {n: F.when(F.col("_early").isNull(), c) for n, c in parts.items()}
    )
    text = F.when(
        ~F.col("_broken"),
        F.concat(
            F.lit(template.start), template.opening(F.col("_first")), F.col("_body"),
            template.closing(F.col("_last")),
        ),
    )
    reason = F.coalesce("_early", F.when(F.col("_text").isNull(), "template_error"))
    shown = pin(
        whole.withColumn("_text", text),
        text=F.col("_text"), n_turns=F.col("_messages"), drop_reason=reason,
    ).select(*others, "text", "n_turns", "drop_reason")
    if keep_dropped:
        return shown
    return shown.filter(F.col("drop_reason").isNull()) if template.may_fail else shown


# Turn position and role in one number, so that the ends of a conversation come from
# long-valued minima and maxima. Turns of one number go by the name of their role, as pieces do.
_ROLE_CODES = {"assistant": 0, "system": 1, "user": 2}


def turn_number(turn: str = "turn") -> Column:
    """Turns without a number come first."""
    return F.coalesce(F.col(turn).cast("long"), F.lit(-1).cast("long"))


def _end_code(turn: Column, role: Column) -> Column:
    code = F.coalesce(*[F.when(role == r, n) for r, n in _ROLE_CODES.items()])
    return turn.cast("long") * 4 + code


def _role_of(code: Column) -> Column:
    number = F.pmod(code, F.lit(4))
    return F.coalesce(*[F.when(number == n, r) for r, n in _ROLE_CODES.items()])


def format_conversations(
    turns: DataFrame,
    template: Template = CHATML,
    keep_dropped: bool = False,
    head_turns: int = HEAD_TURNS,
) -> DataFrame:
    """Flat turns -> ``conv_id, text, n_turns, drop_reason``.

    Without ``keep_dropped`` only rows that can be trained on come back, and turns that
    are skipped never reach the shuffle. The turns are read and shuffled once, by
    conversation; turns without a number come first.
    """
    marked = _marked_turns(turns)
    if not keep_dropped:
        marked = marked.filter("kept")
    number = turn_number()
    piece = F.when(F.col("kept"), _piece(number, F.col("role"), F.col("content")))
    code = F.when(F.col("kept"), _end_code(number, F.col("role")))
    stretches = (
        marked.select("conv_id", F.floor(number / F.lit(head_turns)).alias("block"), piece.alias("p"), code.alias("code"))
        .repartition("conv_id").groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list("p")).alias("ps"), F.min("code").alias("lo"), F.max("code").alias("hi"))
    )
    stitched = F.struct(*[c.alias(n) for n, c in _stitch(F.col("ps"), template).items()])
    gathered = (
        stretches.select("conv_id", F.when(F.size("ps") > 0, stitched).alias("p"), "lo", "hi")
        .groupBy("conv_id").agg(F.collect_list("p").alias("ps"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    early = _end_reason(F.col("lo").isNull(), _role_of(F.col("lo")), _role_of(F.col("hi")))
    ready = gathered.select(
        "conv_id", early.alias("_early"), F.sort_array("ps").alias("_pieces")
    )
    return _render(ready, template, keep_dropped)


def format_nested(
    df: DataFrame, template: Template = CHATML, keep_dropped: bool = False
) -> DataFrame:
    """Same rules on nested rows: no shuffle and no state, so it also runs on a stream."""
    normal = F.transform(
        F.coalesce("conversations", F.array().cast(df.schema["conversations"].dataType)),
        lambda m, i: F.struct(
            i.alias("pos"),
            normalise_role(role_or_from(m["role"], m["from"])).alias("role"),
            m["content"].alias("content"),
        ),
    )
    kept = F.filter(normal, lambda m: ~is_blank(m["content"]) & m["role"].isNotNull())
    pieces = F.transform(kept, lambda m: _piece(m["pos"], m["role"], m["content"]))
    others = [c for c in df.columns if c != "conversations"]
    found = pin(df, _pieces=pieces).select(*others, "_pieces")
    p = F.col("_pieces")
    early = _end_reason(
        F.size(p) == 0, F.get(p, 0)["first"], F.get(p, F.size(p) - 1)["last"]
    )
    return _render(found.withColumn("_early", early), template, keep_dropped)


def format_raw(df: DataFrame, template: Template = CHATML) -> DataFrame:
    """Second recipe: nested rows keep all columns and gain ``text``; nothing is cleaned,
    merged or dropped, and a role the template does not know stops the job."""
    parts = F.transform(
        "conversations",
        lambda m: F.concat(
            template.opening_or_fail(m["role"]), m["content"], template.closing(m["role"])
        ),
    )
    return df.withColumn("text", F.concat(F.lit(template.start), F.array_join(parts, "")))


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(~is_blank(F.col(text)))


def training_text(formatted: DataFrame) -> DataFrame:
    """Only ``text``, without dropped and blank rows. Rendered text is never blank, since it
    holds a non-blank turn, but a user's formatter may return anything."""
    if "drop_reason" in formatted.columns:
        formatted = formatted.filter(F.col("drop_reason").isNull())
    return drop_blank(formatted).select("text")


# --- merged messages ---------------------------------------------------------


def _talks(kept: DataFrame, **cutting):
    return ordered(kept, ["conv_id"], ["turn", "role"], **cutting)


def _starts() -> Column:
    """True for the first turn of a merged message, given the role before in ``_prev``."""
    return F.col("_prev").isNull() | (F.col("_prev") != F.col("role"))


def merge_turns(turns: DataFrame, **cutting) -> DataFrame:
    """One row per merged message: ``conv_id, msg_idx, role, content``."""
    placed = _talks(clean_turns(turns), **cutting).previous("role", "_prev").running(
        _nth=(_starts().cast("long"), "sum")
    )
    return (
        placed.rows()
        .groupBy("conv_id", (F.col("_nth") - 1).alias("msg_idx"), "role")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "content"))).alias("parts"))
        .select(
            "conv_id", "msg_idx", "role",
            F.array_join(F.transform("parts", lambda p: p["content"]), MERGE_SEPARATOR)
            .alias("content"),
        )
    )


def merge_nested(df: DataFrame) -> DataFrame:
    """Nested rows -> ``messages`` array of merged (role, content); linear per row."""
    normal = F.transform(
        "conversations",
        lambda m: F.struct(
            normalise_role(role_or_from(m["role"], m["from"])).alias("role"),
            m["content"].alias("content"),
        ),
    )
    kept = F.filter(normal, lambda m: ~is_blank(m["content"]) & m["role"].isNotNull())
    k, s = F.col("_kept"), F.col("_starts")
    at = F.filter(
        F.transform(
            k, lambda m, i: F.when((i == 0) | (F.get(k, i - 1)["role"] != m["role"]), i)
        ),
        lambda i: i.isNotNull(),
    )

    def message(start: Column, n: Column) -> Column:
        stop = F.coalesce(F.get(s, n + 1), F.size(k))
        parts = F.transform(F.slice(k, start + 1, stop - start), lambda m: m["content"])
        return F.struct(
            F.get(k, start)["role"].alias("role"),
            F.array_join(parts, MERGE_SEPARATOR).alias("content"),
        )

    found = pin(pin(df, _kept=kept), _starts=at)
    return pin(found, messages=F.transform(s, message)).drop("_kept", "_starts")


# --- verdicts without text -----------------------------------------------------


def conversation_ends(turns: DataFrame) -> DataFrame:
    """Drop reason from the first and last kept role per conversation, from long-valued partial aggregates:
    neither text nor strings are shuffled."""
    role = role_or_from(F.col("role"), F.col("from")) if "from" in turns.columns else F.col("role")
    code = _end_code(turn_number(), normalise_role(role))
    kept = F.when(~is_blank(F.col("text")), code)
    ends = turns.select("conv_id", kept.alias("k")).groupBy("conv_id").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n_kept")
    )
    reason = _end_reason(F.col("n_kept") == 0, _role_of(F.col("lo")), _role_of(F.col("hi")))
    return ends.select("conv_id", "n_kept", reason.alias("drop_reason"))


def drop_report(turns: DataFrame) -> DataFrame:
    """Dataset size before and after, and drops per reason, in one pass."""
    ends = conversation_ends(turns)

    def dropped(reason: str) -> Column:
        return F.count_if(F.coalesce(F.col("drop_reason") == reason, F.lit(False)))

    return ends.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(F.col("drop_reason").isNull()).alias("n_after"),
        F.count_if(F.col("drop_reason").isNotNull()).alias("n_dropped"),
        *[dropped(r).alias(f"n_{r}") for r in DROP_REASONS[:3]],
    )


def first_conversations(turns: DataFrame, n: int | None) -> DataFrame:
    """Turns of the ``n`` lowest conversation ids; applied before any cleaning."""
    if n is None:
        return turns
    ids = turns.select("conv_id").distinct().orderBy("conv_id").limit(n)
    return turns.filter(F.col("conv_id") <= ids.agg(F.max("conv_id")).scalar())


def first_formatted(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """The first row of the formatted dataset; only that conversation's text is read."""
    ends = conversation_ends(turns).filter(F.col("drop_reason").isNull())
    first = ends.agg(F.min("conv_id")).scalar()
    return format_conversations(turns.filter(F.col("conv_id") == first), template)


# --- lengths, truncation, spans -------------------------------------------------


def token_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("n_tokens", F.size(words(F.col(text))).cast("long"))


def length_report(df: DataFrame, cap: int, text: str = "text", **cutting) -> DataFrame:
    """Length quantiles, maximum and share over the cap."""
    # Lengths are kept as a small table: each use below would render the texts again.
    lengths = written_table(token_lengths(df, text).select("n_tokens"), "lengths")
    quantiles = exact_quantiles(
        lengths, [], "n_tokens", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, **cutting
    )
    totals = lengths.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("n_tokens").alias("max_tokens"),
        F.count_if(F.col("n_tokens") > cap).alias("n_over_cap"),
        F.avg((F.col("n_tokens") > cap).cast("double")).alias("share_over_cap"),
    )
    return join_by(totals, quantiles, [])


def truncate(df: DataFrame, max_tokens: int, text: str = "text") -> DataFrame:
    """Keep the first ``max_tokens`` tokens and say whether anything was cut."""
    return (
        df.withColumn("_tokens", words(F.col(text)))
        .withColumns(
            {
                "n_tokens": F.size("_tokens").cast("long"),
                "was_truncated": F.size("_tokens") > max_tokens,
                text: truncate_words(F.col(text), F.col("_tokens"), max_tokens),
            }
        )
        .drop("_tokens")
    )


def response_spans(turns: DataFrame, template: Template = CHATML, **cutting) -> DataFrame:
    """Where assistant replies lie in the rendered text: 0-based ``[start, stop)`` per
    merged message. Works on lengths only, so no text is shuffled or rendered."""
    kept = clean_turns(turns).select(
        "conv_id", "turn", "role", F.char_length("content").cast("long").alias("chars")
    )
    lead = (
        F.when(F.col("_prev").isNull(), F.lit(len(template.start)) + template.opening_size("role"))
        .when(~_starts(), F.lit(len(MERGE_SEPARATOR)))
        .otherwise(template.closing_size("_prev") + template.opening_size("role"))
    )
    code = _end_code(turn_number(), F.col("role"))
    placed = (
        _talks(kept, **cutting)
        .totals(_lo=(code, "min"), _hi=(code, "max"))
        .previous("role", "_prev")
        .running(stop=(lead + F.col("chars"), "sum"), _nth=(_starts().cast("long"), "sum"))
    )
    reason = _end_reason(F.lit(False), _role_of(F.col("_lo")), _role_of(F.col("_hi")))
    return (
        placed.rows().filter((F.col("role") == "assistant") & reason.isNull())
        .groupBy("conv_id", (F.col("_nth") - 1).alias("msg_idx"))
        .agg(F.min(F.col("stop") - F.col("chars")).alias("start"), F.max("stop").alias("stop"))
    )


# --- order of an epoch -----------------------------------------------------------


def epoch_order(ids: DataFrame, id_col: str, epochs: int = 1, seed: int = 42, **cutting) -> DataFrame:
    """``id_col, epoch, position``: every example once in each epoch, in an order that the seed fixes: by the md5 of seed,
    epoch and id. An order for writing examples in range partitions; what a trainer makes of it is its own."""
    drawn = ids.select(
        F.col(id_col), F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    ).withColumn("epoch", F.col("epoch").cast("long"))
    keyed = drawn.withColumn(
        "_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch"), F.col(id_col)))
    )
    placed = ordered(keyed, ["epoch"], ["_hash", id_col], **cutting).number("_nth").rows()
    return placed.select(id_col, "epoch", (F.col("_nth") - 1).alias("position"))
