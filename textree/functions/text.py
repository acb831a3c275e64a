"""Cleaning steps, tokens and label predicates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textree.functions import porter

# What is removed or squeezed, in this order.
MENTION = "@[a-zA-Z0-9_]+"
URL = r"\b(?:https?|ftp|com):\/\/\S+"
NEWLINE_TAB_DIGITS = "\n\t0123456789"
BLANKS = r"\s+"
# Everything but ASCII letters, digits and whitespace. Written with \w because Java matches this form of the
# class several times faster than one with ranges.
PUNCTUATION = r"[_[^\w\s]]"

# Label texts that count as positive, and the numerals that Spark's lenient cast reads as 1.
POSITIVE_LABELS = ("fake", "FAKE")
NUMERAL_ONE = r"^\s*[+]?0*1([.][0-9]*)?\s*$"


def clean_chain(text: Column) -> Column:
    """All steps one after the other. Newlines and tabs vanish, so the words around them fuse.

    Newlines, tabs and digits are single characters, so one character map removes all of them.
    """
    out = F.lower(F.trim(text))
    out = F.regexp_replace(F.regexp_replace(out, MENTION, ""), URL, "")
    out = F.translate(out, NEWLINE_TAB_DIGITS, "")
    return F.regexp_replace(F.regexp_replace(out, BLANKS, " "), PUNCTUATION, "")


def clean_last(text: Column) -> Column:
    """Only the punctuation step, which is all that is left when every step reads the raw column."""
    return F.regexp_replace(text, PUNCTUATION, "")


def not_blank(text: Column) -> Column:
    return F.trim(text) != ""


def words(text: Column) -> Column:
    """Split by whitespace, without empty strings."""
    return F.array_remove(F.split(text, BLANKS), "")


def is_positive(column: str, dtype: T.DataType) -> Column:
    """The label test by type: text variants for strings, equality with 1 for numbers."""
    label = F.col(f"`{column}`")
    if isinstance(dtype, T.StringType):
        return label.isin(*POSITIVE_LABELS) | label.rlike(NUMERAL_ONE)
    return label == 1


def stem_column(token: Column) -> Column:
    """Porter stem of one word. Dearer than a join where words repeat; see ``operators.text.stem_dictionary``."""
    return porter.stems(F.array(token))[0]
