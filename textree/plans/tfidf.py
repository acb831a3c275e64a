"""From documents to the TF-IDF values of the most frequent words."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.functions import text as fn
from textree.functions.stopwords import ENGLISH
from textree.operators import features as ft
from textree.operators import text as tx
from textree.operators.joins import BROADCAST_BYTES, join_small
from textree.storage import store


class TfIdf(NamedTuple):
    """``values`` (id, term, tf, tfidf), ``vocabulary`` (term, cnt, term_idx) and the number of documents."""

    values: DataFrame
    vocabulary: DataFrame
    n_docs: int


def _tokenized(docs: DataFrame, id_col: str, text_col: str, mode: str) -> DataFrame:
    cleaned = tx.clean(docs.select(id_col, text_col), text_col, "cleaned", mode, drop_duplicates=False)
    return tx.tokenize(cleaned, "cleaned").select(id_col, "tokens")


def document_tokens(
    docs: DataFrame, id_col: str, text_col: str, mode: str = "chain", stop_words: Sequence[str] | None = ENGLISH
) -> DataFrame:
    """(id, pos, token) of the cleaned texts, without stop words unless told otherwise."""
    tokens = tx.token_rows(_tokenized(docs, id_col, text_col, mode), id_col)
    return tokens if stop_words is None else tx.remove_stopwords(tokens, stop_words)


def word_counts(
    docs: DataFrame, id_col: str, text_col: str, mode: str = "chain", stop_words: Sequence[str] | None = ENGLISH
) -> DataFrame:
    """(token, cnt) over the corpus. The NULL token counts the documents, so both take one scan."""
    marked = F.concat("tokens", F.array(F.lit(None).cast("string")))
    tokens = _tokenized(docs, id_col, text_col, mode).select(F.explode_outer(marked).alias("token"))
    if stop_words is not None:
        kept = ~F.lower("token").isin(*[w.lower() for w in stop_words])
        tokens = tokens.filter(F.col("token").isNull() | kept)
    return tokens.groupBy("token").agg(F.count("*").alias("cnt"))


def tfidf_table(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    vocab_size: int = 500,
    mode: str = "chain",
    stop_words: Sequence[str] | None = ENGLISH,
    stemming: bool = True,
    limit: int = BROADCAST_BYTES,
) -> TfIdf:
    """Vocabulary and TF-IDF in two scans of the texts.

    The first counts distinct words over the whole corpus; only those are stemmed, and the stems with most
    occurrences are the vocabulary. The second keeps the words that lead to it, so the token stream itself
    is neither stemmed nor shuffled: what travels are counts per (document, vocabulary term).
    """
    stem = fn.stem_column(F.col("token")) if stemming else F.col("token")
    counted = store(word_counts(docs, id_col, text_col, mode, stop_words).withColumn("term", stem), "words")
    # one row at most
    n_docs = sum(r["cnt"] for r in counted.df.filter("token IS NULL").select("cnt").collect())
    words = counted.df.filter("token IS NOT NULL")
    terms = store(ft.vocabulary(words, vocab_size, "cnt"), "vocabulary").df
    known = store(join_small(words, terms.select("term"), ["term"], "left_semi", limit=limit), "known")
    counted.release()
    tokens = document_tokens(docs, id_col, text_col, mode, stop_words)
    hits = join_small(tokens, known.df.select("token", "term"), ["token"], salt_on=[id_col, "pos"], limit=limit)
    counts = store(ft.term_counts(hits, id_col, "term"), "counts").df
    known.release()
    values = ft.tfidf(counts, store(ft.document_frequency(counts), "df").df, n_docs, id_col, limit)
    return TfIdf(values, terms, n_docs)
