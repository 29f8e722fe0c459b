"""Licence scan: an Aho-Corasick automaton for tags and phrases, and licence expressions.

Each text is brought to its words, one blank apart, and the automaton reports every place of every
phrase in one pass. After an identifier tag and after a notice ("licensed under") the original text is read on as a licence
expression, after a notice with licences by their names, articles and versions passed over: a shunting-yard turns ``and``, ``or`` and ``with`` (binding with > and > or) into
postfix order, which is evaluated to the obligation the expression leaves: ``or`` lets the licensee
choose the lighter side, ``and`` imposes the heavier one, an exception lightens its licence a step.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import words as W

# Phrases, in lower-case words, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
MORE_PHRASES = {
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "apache license": "apache",
    "bsd license": "bsd",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "creative commons": "cc",
    "public domain": "public-domain",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
}
TAGS = {"spdx license identifier": "tag", "license expression": "tag", "license id": "tag"}
NOTICES = {
    "licensed under": "notice", "released under": "notice", "distributed under": "notice", "available under": "notice",
}

# Names of licences in running text, in lower-case words, and their identifiers.
NAMES = {
    "affero general public license": "agpl", "agpl": "agpl",
    "lesser general public license": "lgpl", "lgpl": "lgpl",
    "general public license": "gpl", "gpl": "gpl",
    "mozilla public license": "mpl", "mpl": "mpl",
    "eclipse public license": "epl", "epl": "epl",
    "apache software license": "apache", "apache": "apache",
    "mit": "mit", "bsd": "bsd", "isc": "isc", "zlib": "zlib",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa", "cc by": "cc-by", "cc0": "cc0", "unlicense": "unlicense",
    "classpath exception": "classpath-exception", "linking exception": "linking-exception",
}

# Obligation of licence identifiers, by how they begin. 0 none, 1 notice, 2 changes
# to the file, 3 works built on it, 4 use is restricted.
OBLIGATION = {
    "0bsd": 0, "cc0": 0, "unlicense": 0, "wtfpl": 0,
    "apache": 1, "bsd": 1, "isc": 1, "mit": 1, "zlib": 1, "cc-by": 1,
    "lgpl": 2, "mpl": 2, "epl": 2, "cddl": 2,
    "gpl": 3, "agpl": 3, "cc-by-sa": 3, "eupl": 3,
    "cc-by-nc": 4, "cc-by-nd": 4, "proprietary": 4,
}

# How strongly a label speaks for a licence statement; other labels count as "other", an expression that was read as the last.
WEIGHT = {"tag": 0.9, "reserved": 0.5, "notice": 0.4, "other": 0.7, "expression": 0.8}

_TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*)")
_GAP = rb"[\s-]{1,8}"
_PROSE = re.compile(
    rb"[\s,]{0,8}(?:(?:either|both|the|a|an|gnu|terms|of)\b[\s,]{1,8}){0,6}(?:(?P<sign>[()])|(?P<name>"
    + b"|".join(_GAP.join(map(str.encode, x.split())) for x in sorted(NAMES, key=len, reverse=True))
    + rb")(?![A-Za-z0-9])(?:" + _GAP + rb"licen[cs]es?\b)?"
    rb"(?:[\s,-]{0,8}(?:version\b|v\.?)?\s{0,8}[0-9]+(?:\.[0-9]+)*\+?(?![A-Za-z0-9]))?"
    rb"(?:[\s,-]{0,8}(?:only|(?:or\s{1,8})?(?:any\s{1,8})?later(?:\s{1,8}version)?)\b)?"
    rb"|(?P<binds>and|or|with)\b)", re.IGNORECASE)
_SPACE = re.compile(rb"[ \t]*:?")
_BINDS = {"or": 1, "and": 2, "with": 3}

SCHEMA = (
    "doc_id {kind}, n_words long, places array<struct<label: string, word: bigint, base: boolean>>, "
    "expressions array<string>, obligation int, score double"
)


def _identifier(text: bytes, at: int, end: int) -> tuple[str, int] | None:
    """The token of an expression of identifiers at ``at``, lower-cased, and where it ends."""
    found = _TOKEN.match(text, at, end)
    return found and (found[1].decode().lower(), found.end())


def _named(text: bytes, at: int, end: int) -> tuple[str, int] | None:
    """The same in running text: a licence by its name becomes its identifier."""
    found = _PROSE.match(text, at, end)
    if not found:
        return None
    if name := found["name"]:
        return NAMES[" ".join(re.split(r"[\s-]+", name.decode().lower()))], found.end()
    return (found["sign"] or found["binds"]).decode().lower(), found.end()


def postfix(text: bytes, at: int = 0, end: int | None = None, read=_identifier) -> list[str]:
    """The licence expression of ``text`` from ``at`` on, before ``end``, in postfix order; empty if there is none.

    ``read`` gives the tokens. Reading stops where an operand or operator is due and something else comes. A dangling operator
    or an open bracket is left out with all that follows.
    """
    out: list[str] = []
    waiting: list[str] = []
    good: tuple[int, list[str]] = 0, []  # what is read so far: so many of ``out``, then these
    open_, operand_due = 0, True
    end = len(text) if end is None else end
    while found := read(text, at, end):
        token, at = found
        if operand_due and token == "(":
            waiting.append(token)
            open_ += 1
        elif operand_due and token not in _BINDS and token != ")":
            out.append(token.rstrip("."))
            operand_due = False
        elif not operand_due and token in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand_due = True
        elif not operand_due and token == ")" and open_:
            while (top := waiting.pop()) != "(":
                out.append(top)
            open_ -= 1
        else:
            break
        if not operand_due and not open_:
            good = len(out), waiting[::-1]
    return out[: good[0]] + good[1]


def obligation(order: list[str]) -> int:
    """What a postfix expression obliges to, from 0 to 4; unknown licences count as 4."""
    stack: list[int] = []
    for token in order:
        if token in _BINDS and len(stack) >= 2:
            right, left = stack.pop(), stack.pop()
            if token == "or":
                stack.append(min(left, right))
            elif token == "and":
                stack.append(max(left, right))
            else:
                stack.append(max(left - 1, 0))
        else:
            known = [k for k in OBLIGATION if token == k or token.startswith(k + "-")]
            stack.append(OBLIGATION[max(known, key=len)] if known else 4)
    return stack[-1] if stack else -1


def licences(order: list[str]) -> set[str]:
    """The licence identifiers of a postfix expression; exceptions are left out."""
    stack: list[set[str]] = []
    for token in order:
        if token in _BINDS and len(stack) >= 2:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else left | right)
        else:
            stack.append({token})
    return stack[-1] if stack else set()


def automaton() -> ahocorasick.Automaton:
    """Phrases between blanks -> (label, words, kind)."""
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("more", MORE_PHRASES), ("tag", TAGS), ("notice", NOTICES)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (label, phrase.count(" ") + 1, kind, len(phrase) + 1))
    found.make_automaton()
    return found


def _spaced(found: W.Words) -> tuple[str, np.ndarray]:
    """All words one blank apart, with a line end between rows, and where each word starts there.

    One character stands for one byte.
    """
    length = found.end - found.start
    before = np.ones(len(found), dtype=np.int64)
    if len(found):
        before[1:][found.row[1:] != found.row[:-1]] = 3
    start = np.cumsum(before + length) - length
    size = int(start[-1] + length[-1]) + 1 if len(found) else 1
    out = np.full(size, 32, dtype=np.uint8)
    out[start[before == 3] - 2] = 10
    total = int(length.sum())
    within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(start, length) + within] = found.lower[np.repeat(found.start, length) + within]
    return out.tobytes().decode("latin-1"), start


def _scan_rows(batches):
    phrases = automaton()
    for batch in batches:
        sizes, places, expressions, duties, scores = [], [], [], [], []
        for piece in W.pieces(batch.column(1)):
            found = W.words_of(piece, W.ALNUM, hashed=False)
            text, start = _spaced(found)
            hits: dict[int, tuple[list, list, list]] = {}
            data = b""
            for last, (label, count, kind, size) in phrases.iter(text):
                word = int(np.searchsorted(start, last - size + 1))
                r = int(found.row[word])
                own, read, duty = hits.setdefault(r, ([], [], []))
                at = word - int(found.first[r])
                own.append({"label": label, "word": at, "base": kind == "base"})
                if kind in ("tag", "notice"):
                    data = data or piece.data.tobytes()
                    begin, end = int(found.end[word + count - 1]), int(piece.offsets[r + 1])
                    if kind == "tag":
                        order = postfix(data, _SPACE.match(data, begin, end).end(), end)
                    else:
                        order = postfix(data, begin, end, _named)
                    if order:
                        read.append(" ".join(order))
                        duty.append(obligation(order))
                        own.extend({"label": x, "word": at, "base": False} for x in sorted(licences(order)))
            sizes.extend(np.diff(found.first).tolist())
            for r in range(piece.rows):
                own, read, duty = hits.get(r, ((), (), ()))
                rest = 1 - WEIGHT["expression"] if read else 1.0
                for label in {p["label"] for p in own}:
                    rest *= 1 - WEIGHT.get(label, WEIGHT["other"])
                places.append(sorted(own, key=lambda p: (p["word"], p["label"])))
                expressions.append(list(read))
                duties.append(max(duty, default=None))
                scores.append(1 - rest)
        place = pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(place)),
             pa.array(expressions, pa.list_(pa.string())), pa.array(duties, pa.int32()),
             pa.array(scores, pa.float64())],
            names=["doc_id", "n_words", "places", "expressions", "obligation", "score"],
        )


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, places, expressions, obligation and score of every row of ``documents``.

    ``places`` lists every phrase with the number of its first word; ``expressions`` those found after
    tags and notices, in postfix order, and ``obligation`` the heaviest of them (null without any). The score is
    0 without a place. Null and empty texts have no words. Rows are taken one by one, so repeated
    rows, null ids and further columns make no difference.
    """
    kind = documents.select("doc_id").schema[0].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_scan_rows, SCHEMA.format(kind=kind))


def report(documents: DataFrame) -> DataFrame:
    """The digest of ``scan``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.filter("places", lambda p: p["base"])
    words = F.transform(base, lambda p: p["word"])

    def joined(which):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(which, lambda p: p["label"]))), ",")

    return scan(documents).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"), "score",
        "expressions", "obligation",
    )
