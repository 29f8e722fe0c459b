"""Hooks for user code: row formatters, batch formatters, tokenizers, rewards.

Python runs here only because the user's code is Python; it receives Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_formatter(
    df: DataFrame, formatter: Callable[..., Any], *inputs: str, out: str = "text"
) -> DataFrame:
    """Row formatter: ``formatter`` maps Columns to a Column and stays in the JVM."""
    return df.withColumn(out, formatter(*[F.col(c) for c in inputs]))


def apply_row_function(
    df: DataFrame, function: Callable[..., str | None], *inputs: str, out: str = "text"
) -> DataFrame:
    """Row formatter written in plain Python, called on Arrow batches."""

    @F.pandas_udf("string")
    def call(struct: pd.DataFrame) -> pd.Series:
        rows = struct.itertuples(index=False, name=None)
        return pd.Series([function(*row) for row in rows], dtype=object)

    return df.withColumn(out, call(F.struct(*inputs)))


def apply_batched(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], added: dict[str, str]
) -> DataFrame:
    """Batched formatter: gets a pandas batch, returns it with the ``added`` columns."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in added.items():
        schema = schema.add(name, T._parse_datatype_string(kind))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)[schema.fieldNames()]

    return df.mapInPandas(run, schema)


def token_counter(load: Callable[[], Callable[[str], list]]) -> Callable[[Column], Column]:
    """Column function counting tokens; ``load`` runs once per worker process task."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = load()
        for texts in batches:
            yield pd.Series([0 if t is None else len(tokenize(t)) for t in texts], dtype="int64")

    return count


def token_truncator(
    load: Callable[[], tuple[Callable[[str], list], Callable[[list], str]]], limit: int
) -> Callable[[Column], Column]:
    """Column function giving ``text, n_tokens, was_truncated``; ``load`` returns the encode
    and decode functions of a tokenizer. Texts within the limit come back unchanged."""

    @F.pandas_udf("text string, n_tokens long, was_truncated boolean")
    def truncate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode, decode = load()
        for texts in batches:
            rows = []
            for text in texts:
                tokens = [] if text is None else encode(text)
                cut = len(tokens) > limit
                rows.append((decode(tokens[:limit]) if cut else text, len(tokens), cut))
            yield pd.DataFrame(rows, columns=["text", "n_tokens", "was_truncated"])

    return truncate


def chat_renderer(
    load: Callable[[], Callable[[list[dict]], str]], strict: bool = False
) -> Callable[[Column], Column]:
    """Column function rendering an array of (role, content) with the user's own template;
    ``load`` returns it. A template that fails gives null, or stops the job when strict."""

    @F.pandas_udf("string")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        template = load()

        def one(messages) -> str | None:
            try:
                return template([{"role": m["role"], "content": m["content"]} for m in messages])
            except Exception:
                if strict:
                    raise
                return None

        for batch in batches:
            yield pd.Series([one(messages) for messages in batch], dtype=object)

    return render


def reward_function(score: Callable[[str, str], float]) -> Callable[[Column, Column], Column]:
    """Column function scoring a completion against its answer."""

    @F.pandas_udf("double")
    def rate(completions: pd.Series, answers: pd.Series) -> pd.Series:
        pairs = zip(completions, answers, strict=True)
        return pd.Series([float(score(c, a)) for c, a in pairs], dtype="float64")

    return rate
