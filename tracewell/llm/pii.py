"""Personal data: four base patterns, and identifiers found by bootstrapped contexts.

Base matches are seeds of their kinds; strings of 32, 40 or 64 hexadecimal digits are seeds of a fifth kind, secrets. The
one and the two whole words before a mention, with the signs that follow them, are its lexical patterns; other tokens
that hold a digit, or a sign between letters or digits, are candidates. Patterns and distinct values form a
graph, which is scored in rounds: a pattern is worth the confidence of its sure values divided by one more than the
number of all its values, a value one less the product of the doubts of its sure patterns. Values that became sure in a round
induce patterns in the next, beside the seeds. A sure value is marked where a sure pattern stands before it, and so
is a seed of a secret: digits alone may be a checksum. Patterns need several different sure values, so a passage that
is copied a thousand times proves nothing.

All of it is DataFrame expressions. The texts are read once; what goes on is a row for each mention, and
rounds group by pattern and by value, combining before they shuffle. Base spans that Java would find only
by deep recursion or in quadratic time are written as equivalent patterns without either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")

# The base patterns, as Java finds them fastest. A run of the first class is tried from its beginning
# (or from the end of the match before), since any later start in it meets the same rest; possessive
# groups are matched in a loop. Cards: only runs of 13 to 19 digits can pass the checks, and a run is
# never cut, so shorter and longer ones are not matched in the first place.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without these has no match.
GUARDS = {
    "email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]",
}
#: Spans of these come from contexts alone; a whole mention of this form is a seed.
ADDED_KINDS = ("secret",)
SEED_PATTERNS = {"secret": r"(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})"}
#: Tokens that may turn out to be identifiers: with a digit, or a sign with a letter after it.
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9._%@/-]))[A-Za-z]*+[._%@/-]*+(?:[0-9]|(?<=[._%@/-])[A-Za-z])(?:[A-Za-z0-9._%@/-]*[A-Za-z0-9])?"
CANDIDATE_GUARD = r"[0-9]|[._%@/-][A-Za-z]"
#: The last one or two words of a text, with the signs after them; and the last one.
_WORD, _SIGNS = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
LAST_TWO = rf"(?<!{_WORD}){_WORD}++(?:{_SIGNS}++{_WORD}++)?+{_SIGNS}*+$"
LAST_ONE = rf"(?<!{_WORD}){_WORD}++{_SIGNS}*+$"

ROUNDS = 4
#: Different sure values that a pattern needs.
LEAST_VALUES = 3
PATTERN_FROM = 0.6
VALUE_FROM = 0.8

_BLOCK = 256


def _quoted(regex: str) -> str:
    return "r'" + regex + "'"


def _found(hits: str, gaps: str, extra: str = "") -> str:
    """Spans of the matches ``hits`` that lie between texts of lengths ``gaps``.

    A running sum over the matches, taken in blocks so that its cost stays linear in them.
    ``extra`` are further fields of a span, in terms of the match number ``i``.
    """
    begin = f"a.pos + {gaps}[i - 1]"
    span = f"named_struct('start', {begin}, 'end', {begin} + length({hits}[i - 1]), 'value', {hits}[i - 1]{extra})"
    kind = "array<struct<start: int, end: int, value: string" + (", left: string" if extra else "") + ">>"
    inner = (
        f"aggregate(sequence(b * {_BLOCK} + 1, least(size({hits}), (b + 1) * {_BLOCK})), "
        f"named_struct('pos', acc.pos, 'own', cast(array() as {kind})), (a, i) -> "
        f"named_struct('pos', {begin} + length({hits}[i - 1]), 'own', concat(a.own, array({span}))))"
    )
    blocks = (
        f"aggregate(sequence(0, (size({hits}) - 1) div {_BLOCK}), "
        f"named_struct('pos', 0, 'out', cast(array() as array<{kind}>)), (acc, b) -> "
        f"transform(array({inner}), x -> named_struct('pos', x.pos, 'out', concat(acc.out, array(x.own))))[0], "
        "acc -> flatten(acc.out))"
    )
    return f"case when size({hits}) > 0 then {blocks} else cast(array() as {kind}) end"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """Whether a text of digits passes the Luhn check, as an SQL expression."""
    digit = f"int(substring(reverse({digits}), i, 1))"
    return (
        f"aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum + case when i % 2 = 1 then {digit} "
        f"when {digit} > 4 then 2 * {digit} - 9 else 2 * {digit} end) % 10 = 0"
    )


def passes(kind: str, value: str) -> str:
    """Whether a match of a base pattern counts, as an SQL expression."""
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return f"{value} rlike {_quoted('^' + part + '([.]' + part + '){3}$')}"
    if kind == "card":
        return f"length({_digits(value)}) between 13 and 19 and {luhn(_digits(value))}"
    if kind == "phone":
        return f"length({_digits(value)}) between 9 and 15"
    return "true"


def _base_spans(rows: DataFrame) -> DataFrame:
    """``rows`` with an array of spans (start, end, value) for each kind."""
    for kind in KINDS:
        rows = rows.withColumn(
            f"hits_{kind}", F.expr(
                f"case when text rlike {_quoted(GUARDS[kind])} "
                f"then regexp_extract_all(text, {_quoted(PATTERNS[kind])}, 0) else cast(array() as array<string>) end"))
    for kind in KINDS:
        rows = rows.withColumn(
            f"gaps_{kind}", F.expr(f"case when size(hits_{kind}) > 0 then "
                                   f"transform(split(text, {_quoted(PATTERNS[kind])}, -1), x -> length(x)) end"))
    for kind in KINDS:
        rows = rows.withColumn(
            kind, F.expr(f"filter({_found(f'hits_{kind}', f'gaps_{kind}')}, s -> {passes(kind, 's.value')})"))
    return rows.drop(*(f"{x}_{k}" for x in ("hits", "gaps") for k in KINDS))


def _mentions(rows: DataFrame) -> DataFrame:
    """``rows`` with an array of mentions: matches of any base pattern, or else candidate tokens, and the
    two whole words before each."""
    any_ = "|".join([*(PATTERNS[k] for k in KINDS), CANDIDATE])
    return (
        rows.withColumn("hits", F.expr(
            f"case when text rlike {_quoted(CANDIDATE_GUARD)} then regexp_extract_all(text, {_quoted(any_)}, 0) "
            "else cast(array() as array<string>) end"))
        .withColumn("between", F.expr(
            f"case when size(hits) > 0 then transform(split(text, {_quoted(any_)}, -1), "
            f"x -> named_struct('n', length(x), 'left', regexp_extract(x, {_quoted(LAST_TWO)}, 0))) end"))
        .withColumn("gaps", F.expr("transform(between, x -> x.n)"))
        .withColumn("mentions", F.expr(_found("hits", "gaps", ", 'left', between[i - 1].left")))
        .drop("hits", "between", "gaps")
    )


def _kind_of(value: str) -> Column:
    """The kind of a mention that is a seed, else null."""
    out = F.lit(None).cast("string")
    for kind in reversed(ADDED_KINDS):
        out = F.when(F.expr(f"{value} rlike {_quoted('^(?:' + SEED_PATTERNS[kind] + ')$')}"), F.lit(kind)).otherwise(out)
    for kind in reversed(KINDS):
        whole = _quoted(f"^(?:{PATTERNS[kind]})$")
        out = F.when(F.expr(f"{value} rlike {whole} and {passes(kind, value)}"), F.lit(kind)).otherwise(out)
    return out


def _patterns() -> Column:
    """The one and the two words before a mention, lower-cased, digits as 0, blanks as one."""
    left = r"regexp_replace(regexp_replace(lower(left), r'[0-9]++', '0'), r'\s++', ' ')"
    one = f"regexp_extract({left}, {_quoted(LAST_ONE)}, 0)"
    return F.expr(
        f"filter(array_distinct(array('1 ' || nullif({one}, ''), case when {one} <> {left} then '2 ' || {left} end)), x -> x is not null)")


def _some_base(value: str) -> Column:
    return F.expr(" or ".join(f"{value} rlike {_quoted(GUARDS[k])}" for k in KINDS))


def bootstrap(mentions: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Sure (pattern, kind) and (value, kind), seeds included, from mentions with pattern, value and kind.

    Seeds have confidence 1 in their kind and keep it. In a round, a pattern's confidence in a kind is the sum of
    its sure values' confidence divided by one more than the number of its different values, if ``LEAST_VALUES`` of
    them are sure of that kind; it is sure from ``PATTERN_FROM`` on, so of one kind only. Any other value's confidence is
    one less the product of (1 - confidence) over its sure patterns of a kind; it is sure from ``VALUE_FROM`` on, of its best kind.
    The rounds end early when one finds no further value.
    """
    edges = stored(mentions.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    sizes = stored(edges.groupBy("pattern").agg(F.count("*").alias("values")).filter(F.col("values") >= LEAST_VALUES), "pii-sizes")
    near = edges.join(sizes.select("pattern"), "pattern", "left_semi")
    seeds = stored(edges.filter("kind is not null").select("value", "kind").distinct().withColumn("sure", F.lit(1.0)), "pii-seeds")
    open_ = stored(near.filter("kind is null").select("pattern", "value"), "pii-open")
    # what seeds give a pattern is the same in all rounds
    seeded = stored(
        near.filter("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("n"), F.count("*").cast("double").alias("gain")),
        "pii-seeded")
    values, patterns, known = None, None, -1
    for _ in range(rounds):
        gained = seeded
        if values is not None:
            more = (
                open_.join(values, "value").groupBy("pattern", "kind")
                .agg(F.count("*").alias("n"), F.sum("sure").alias("gain"))
            )
            gained = seeded.unionByName(more).groupBy("pattern", "kind").agg(F.sum("n").alias("n"), F.sum("gain").alias("gain"))
        patterns = stored(
            gained.filter(F.col("n") >= LEAST_VALUES).join(sizes, "pattern")
            .select("pattern", "kind", (F.col("gain") / (F.col("values") + 1)).alias("sure"))
            .filter(F.col("sure") >= PATTERN_FROM), "pii-round")
        found = (
            open_.join(patterns, "pattern").groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("sure"))))).alias("sure"))
            .groupBy("value").agg(F.max(F.struct("sure", "kind")).alias("best"))
            .filter(F.col("best.sure") >= VALUE_FROM).select("value", "best.kind", "best.sure")
        )
        values = stored(found, "pii-values")
        before, known = known, values.count()
        if known == before or not known:
            break
    return patterns.select("pattern", "kind"), values.unionByName(seeds).select("value", "kind")


def find(documents: DataFrame) -> DataFrame:
    """doc_id, an array of spans (start, end, value) for each of ``KINDS``, and ``added`` of (kind, start, end), of
    these and of ``ADDED_KINDS``.

    Starts and ends count code points; the end is exclusive. A null text is empty. Rows with a null
    doc_id and repeated rows are taken like any other; added spans never overlap a base span. Only doc_id
    and text are read.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("text"))
    scanned = stored(_mentions(_base_spans(rows)).drop("text"), "pii")
    single = (
        scanned.select("doc_id", "row_key", F.explode("mentions").alias("m"))
        .select("doc_id", "row_key", "m.start", "m.end", "m.value", "m.left")
        .withColumn("kind", _kind_of("value"))
        .filter(F.col("kind").isNotNull() | ~_some_base("value"))
    )
    mentions = stored(single.withColumn("pattern", F.explode(_patterns())).drop("left"), "pii-mentions")
    patterns, values = bootstrap(mentions)
    added = (
        mentions.filter(F.col("kind").isNull() | F.col("kind").isin(*ADDED_KINDS)).drop("kind")
        .join(patterns, "pattern").join(values, ["value", "kind"])
        .groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("new"))
    )
    base = F.concat(*(F.expr(f"transform({k}, s -> named_struct('start', s.start, 'end', s.end))") for k in KINDS))
    joined = scanned.drop("mentions").alias("l").join(
        added.alias("r"),
        F.col("l.row_key").eqNullSafe(F.col("r.row_key")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")), "left",
    ).select("l.doc_id", *KINDS, "new", base.alias("base"))
    return joined.select(
        "doc_id", *KINDS,
        F.expr("coalesce(filter(new, n -> not exists(base, s -> s.start < n.end and n.start < s.end)), "
               "cast(array() as array<struct<kind: string, start: int, end: int>>))").alias("added"),
    )


def report(documents: DataFrame) -> DataFrame:
    """The digest of ``find``: counts of base spans by kind, base_sha256, all spans, and n_added, how many of them the contexts add."""
    found = find(documents)

    def named(kind: str, array: str) -> str:
        return f"transform({array}, s -> concat_ws(':', '{kind}', s.start, s.end))"

    base = reduce(lambda a, b: f"concat({a}, {b})", (named(k, k) for k in KINDS))
    def both(kind: str) -> str:
        base = f"transform({kind}, s -> named_struct('start', s.start, 'end', s.end)), " if kind in KINDS else ""
        added = f"transform(filter(added, n -> n.kind = '{kind}'), n -> named_struct('start', n.start, 'end', n.end))"
        return f"array_sort(concat({base}{added}))"

    every = reduce(lambda a, b: f"concat({a}, {b})", (named(k, both(k)) for k in (*KINDS, *ADDED_KINDS)))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(f"array_join({base}, ',')").cast("binary"), 256).alias("base_sha256"),
        F.expr(f"array_join({every}, ',')").alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
