"""Cleaning, tokens, stop words and stems."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.functions import text as fn
from textree.functions.stopwords import ENGLISH
from textree.operators.joins import BROADCAST_BYTES, join_small
from textree.storage import store

MODES = {"chain": fn.clean_chain, "last": fn.clean_last}


def clean(
    df: DataFrame,
    text_col: str,
    out_col: str | None = None,
    mode: str = "chain",
    drop_duplicates: bool = True,
    drop_empty_output: bool = False,
) -> DataFrame:
    """Cleaned text in ``out_col``.

    ``chain`` applies every step in turn. ``last`` gives the result of steps that each read the raw
    column: only the last one shows. In that mode the blank filter looks at the raw text, so titles that
    become empty stay unless ``drop_empty_output`` is set; chained in place it looks at the cleaned text.
    Without ``drop_duplicates`` this is a projection and a filter, and also takes a stream.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    out_col = out_col or f"cleaned_{text_col}"
    if drop_duplicates and out_col not in df.columns:
        # rows that agree in all columns have the same cleaned text, so only the raw columns travel
        df, drop_duplicates = df.filter(fn.not_blank(F.col(text_col))).dropDuplicates(), False
    cleaned = df.withColumn(out_col, MODES[mode](F.col(text_col))).filter(fn.not_blank(F.col(text_col)))
    if drop_empty_output:
        cleaned = cleaned.filter(F.col(out_col).rlike(r"\S"))
    return cleaned.dropDuplicates() if drop_duplicates else cleaned


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Keep rows whose columns, joined as text, hold anything but whitespace."""
    return df.filter(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns]).rlike(r"\S"))


def tokenize(df: DataFrame, text_col: str, out_col: str = "tokens") -> DataFrame:
    """Whitespace words as an array. (The library tokenizer's own rules are not public knowledge here.)"""
    return df.withColumn(out_col, fn.words(F.col(text_col)))


def token_rows(df: DataFrame, id_col: str, tokens_col: str = "tokens") -> DataFrame:
    """Long form: one row per token with its place in the document.

    The outer form keeps the optimizer from computing the array once more to filter out empty ones.
    """
    rows = df.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
    return rows.filter("token IS NOT NULL")


def remove_stopwords(tokens: DataFrame, words: Iterable[str] = ENGLISH, token_col: str = "token") -> DataFrame:
    """Drop stop words, ignoring case. The list is fixed, so it is a set test inside the scan stage."""
    return tokens.filter(~F.lower(token_col).isin(*[w.lower() for w in words]))


def stem_dictionary(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """(token, stem) for every distinct token: the rules run once a word, not once an occurrence."""
    distinct = tokens.select(F.col(token_col).alias("token")).distinct()
    return distinct.withColumn("stem", fn.stem_column(F.col("token")))


def stem_tokens(
    tokens: DataFrame, token_col: str = "token", out_col: str = "stem", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Every token with its stem, by a join with the dictionary of distinct tokens."""
    dictionary = store(stem_dictionary(tokens, token_col), "stems").df.toDF(token_col, out_col)
    return join_small(tokens, dictionary, [token_col], limit=limit)
