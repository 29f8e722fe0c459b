"""URL filter: rules first, then the likelihood ratio of two character models.

URLs that a rule allows or blocks are the two training sets. Each has a Markov model of variable
order over the characters of the URL (A-Z lower-cased, runs of digits as one 0): the probability of
a character after its longest context is smoothed with that after the next shorter one, down to a
uniform one, so a context that was never seen leaves the decision to a shorter one. A URL without a
rule is judged by the difference of its log-likelihoods divided by its length; the threshold lies
between the mean differences of the allowed and the blocked URLs, equally many deviations from both.

Everything is a DataFrame expression. The models are tables with a row for each distinct gram; grams
are counted over all URLs, each row with its multiplicity. A URL's score is the sum of its grams'
differences. The table of differences is broadcast only if it has at most ``BROADCAST_GRAMS`` rows; beyond
that the grams are joined by a shuffle, in which adaptive execution splits the common ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.tables import stored

# Fixed values: (action, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Characters of context of the longest order.
ORDER = 4
#: Weight of the next shorter context, in characters seen.
PRIOR = 1.0
ALPHABET = 256
#: Rows of the table of differences that may be broadcast (well below 100 bytes each).
BROADCAST_GRAMS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, else nulls.

    A rule fits its host and that host's subdomains if the path starts with the rule's. Of equally
    long rules that fit, the last in order of action, host and path counts.
    """
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, on, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), *r)):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(start)
        rule = F.when(fits, F.lit(on + start)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def _grams(rows: DataFrame, order: int, *keep: str) -> DataFrame:
    """A row for each character of each URL and for its end: the character after its context."""
    text = F.regexp_replace(F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER), "[0-9]+", "0")
    padded = F.concat(F.lit(" " * order), text, F.lit(" "))
    return (
        rows.select(*keep, padded.alias("padded"))
        .select(*keep, "padded", F.explode(F.sequence(F.lit(1), F.length("padded") - order)).alias("pos"))
        .select(*keep, F.expr(f"substring(padded, pos, {order + 1})").alias("gram"))
    )


def differences(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, difference) for all grams of all URLs: log P(character | context), allowed less blocked.

    ``rows`` has url, action (allow, block or null) and copies.
    """
    counts = (
        _grams(rows, order, "action", "copies").groupBy("gram")
        .agg(*(F.sum(F.when(F.col("action") == a, F.col("copies")).otherwise(0)).alias(a) for a in ("allow", "block")))
    )
    counts = stored(counts, "grams")
    shorter = None
    for k in range(order + 1):
        own = (
            counts.groupBy(F.expr(f"substring(gram, {order + 1 - k}, {k + 1})").alias("gram"))
            .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
            .withColumn("context", F.expr(f"substring(gram, 1, {k})"))
        )
        seen = own.groupBy("context").agg(F.sum("allow").alias("all_allow"), F.sum("block").alias("all_block"))
        own = own.join(seen, "context")
        if shorter is None:
            own = own.withColumns({f"p_{a}": F.lit(1.0 / ALPHABET) for a in ("allow", "block")})
        else:
            own = own.withColumn("rest", F.expr("substring(gram, 2)")).join(shorter, "rest")
        shorter = own.select(
            F.col("gram").alias("rest"),
            *(((F.col(a) + PRIOR * F.col(f"p_{a}")) / (F.col(f"all_{a}") + PRIOR)).alias(f"p_{a}") for a in ("allow", "block")),
        )
        shorter = stored(shorter, "markov") if k in (2, order) else shorter
    return shorter.select(F.col("rest").alias("gram"), (F.log("p_allow") - F.log("p_block")).alias("difference"))


def verdicts(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of ``pages`` (page_id, url, ...).

    A null URL, or one without ``://``, has an empty host and path and is judged by its text, the null
    one as an empty text. If no URL is allowed by a rule or none is blocked, there is nothing to compare and all URLs
    without a rule are allowed. Equal scores to the threshold are allowed. Rows with equal page_id and
    url are one row until the end and come out as many times as they came in.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    rows = rows.select("page_id", "url", "copies", host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = stored(rows.select("*", rule.alias("rule"), action.alias("action")), "urls")
    ratio = differences(rows, order)
    if ratio.count() <= BROADCAST_GRAMS:
        ratio = F.broadcast(ratio)
    scores = (
        _grams(rows, order, "page_id", "url").join(ratio, "gram")
        .groupBy("page_id", "url").agg(F.avg("difference").alias("score"))
    )
    same = F.col("l.page_id").eqNullSafe(F.col("r.page_id")) & F.col("l.url").eqNullSafe(F.col("r.url"))
    scored = stored(rows.alias("l").join(scores.alias("r"), same).select("l.*", "score"), "url-scores")
    threshold = _threshold(scored)
    judged = F.when(F.col("score") >= threshold, "allow").otherwise("block") if threshold is not None else F.lit("allow")
    return (
        scored.withColumn("verdict", F.coalesce("action", judged))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("page_id", "host", "path", "rule", "verdict", "score")
    )


def _threshold(scored: DataFrame) -> float | None:
    by = {
        r["action"]: r for r in scored.filter("action is not null").groupBy("action")
        .agg((F.sum(F.col("score") * F.col("copies")) / F.sum("copies")).alias("mean"),
             (F.sum(F.col("score") * F.col("score") * F.col("copies")) / F.sum("copies")).alias("square")).collect()
    }
    if len(by) < 2:
        return None
    deviation = {a: max(r["square"] - r["mean"] ** 2, 0.0) ** 0.5 for a, r in by.items()}
    total = sum(deviation.values())
    if not total:
        return sum(r["mean"] for r in by.values()) / 2
    return (by["allow"]["mean"] * deviation["block"] + by["block"]["mean"] * deviation["allow"]) / total
