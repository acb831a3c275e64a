"""Entropy arithmetic as SQL text: one call to the JVM per expression, however long it is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log2(x: str) -> str:
    """Base-2 logarithm through base 10, with 0 at 0."""
    return f"CASE WHEN {x} = 0.0D THEN 0.0D ELSE log10({x}) / log10(2.0D) END"


def entropy_term(p: str) -> str:
    return f"(-{p} * {log2(p)})"


def share(part: str, whole: str) -> str:
    """``part / whole`` with 0 for an empty whole."""
    return f"(CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0.0D END)"


def class_entropy(n0: str, n1: str, digits: int | None = 4) -> str:
    """Absolute entropy of a node, rounded half up as the stop rule and the gain expect it."""
    whole = f"({n0} + {n1})"
    value = f"abs({entropy_term(share(n0, whole))} + {entropy_term(share(n1, whole))})"
    return value if digits is None else f"round({value}, {digits})"


def majority(n0: str, n1: str) -> str:
    """Majority class; a tie or an empty node gives 1."""
    return f"CASE WHEN {n0} > {n1} THEN 0 ELSE 1 END"


def unit_hash(*parts: Column | str) -> Column:
    """A repeatable number in [0, 1) from the md5 of the joined parts (52 bits of it)."""
    digest = F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.col(p) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2**52))
