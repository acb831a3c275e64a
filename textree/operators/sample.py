"""Balanced training sets and the rest as test set."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textree.functions.numeric import unit_hash

SHARE = 0.8


def fractions(df: DataFrame, label: str = "y", share: float = SHARE) -> dict[int, float]:
    """The part of each class that makes both equally large: ``share`` of the smaller class."""
    counts = {r[0]: r[1] for r in df.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    if not (counts.get(0) and counts.get(1)):
        raise ValueError(f"both classes must be present, found {counts}")
    smaller = min(counts.values())
    return {y: smaller * share / n for y, n in counts.items()}


def in_train(parts: dict[int, float], id_cols: list[str], label: str = "y", salt: str = "42") -> Column:
    """True for the rows a repeatable draw takes: the hash of salt and id is below the class fraction."""
    wanted = F.when(F.col(label) == 0, F.lit(parts[0])).when(F.col(label) == 1, F.lit(parts[1]))
    return F.coalesce(unit_hash(F.lit(salt), *id_cols) < wanted, F.lit(False))


def balanced(
    df: DataFrame, id_cols: list[str], label: str = "y", share: float = SHARE, salt: str = "42"
) -> DataFrame:
    """A draw without replacement with about equal classes. Needs no shuffle beyond the class counts."""
    return df.filter(in_train(fractions(df, label, share), id_cols, label, salt))


def balanced_random(df: DataFrame, label: str = "y", share: float = SHARE, seed: int = 42) -> DataFrame:
    """The same draw for rows without an id, by Spark's own seeded sampling of each class."""
    parts = fractions(df, label, share)
    draws = [df.filter(F.col(label) == y).sample(False, min(parts[y], 1.0), seed) for y in (0, 1)]
    return draws[0].union(draws[1])


def train_test(
    df: DataFrame, id_cols: list[str], label: str = "y", share: float = SHARE, salt: str = "42"
) -> tuple[DataFrame, DataFrame]:
    """Balanced train set and everything else; one predicate and its opposite, so nothing is joined."""
    drawn = in_train(fractions(df, label, share), id_cols, label, salt)
    return df.filter(drawn), df.filter(~drawn)


HEX_STEP = 3  # digits by which a cut is refined in one pass: 4,096 counts of a class come to the driver


@dataclass(frozen=True)
class Cut:
    """Digests up to ``digits`` (or below them) are drawn."""

    digits: str
    inclusive: bool


def exact_cuts(df: DataFrame, wanted: dict[int, int], id_cols: list[str], label: str = "y", salt: str = "42") -> dict[int, Cut]:
    """For each class the cut below which exactly ``wanted`` digests of its ids lie.

    A selection without a sort: counts by the first digits find the bucket of the k-th smallest digest, the next pass
    counts inside that bucket alone, and so on until a bucket ends at k. Each pass is one scan and a small aggregation.
    """
    digest = _digest(id_cols, salt)
    open_ = {y: ("", k) for y, k in wanted.items() if k > 0}
    cuts = {y: Cut("", False) for y in wanted}
    while open_:
        inside = reduce(Column.__or__, [(F.col(label) == y) & digest.startswith(prefix) for y, (prefix, _) in open_.items()])
        size = min(32, len(next(iter(open_.values()))[0]) + HEX_STEP)
        counts = df.filter(inside).groupBy(F.col(label).alias("y"), F.substring(digest, 1, size).alias("digits")).agg(F.count("*").alias("n")).collect()
        following = {}
        for y, (prefix, k) in open_.items():
            below = 0
            for r in sorted((r for r in counts if r["y"] == y), key=lambda r: r["digits"]):
                if below + r["n"] >= k:
                    if below + r["n"] == k:
                        cuts[y] = Cut(r["digits"], True)
                    elif size == 32:  # rows of one id: together or not at all
                        cuts[y] = Cut(r["digits"], False)
                    else:
                        following[y] = (r["digits"], k - below)
                    break
                below += r["n"]
        open_ = following
    return cuts


def _digest(id_cols: list[str], salt: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(salt), *id_cols))


def in_exact_train(df: DataFrame, id_cols: list[str], label: str = "y", share: float = SHARE, salt: str = "42") -> Column:
    """True for floor(``share`` of the smaller class) rows of each class, a repeatable draw by the digest of the id.

    Sizes are exact where ids are unique; rows that share an id at the cut all stay out. Null ids are left out of the
    digest, rows with other labels are never drawn, and a missing class is a ValueError.
    """
    counts = {r[0]: r[1] for r in df.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    if not (counts.get(0) and counts.get(1)):
        raise ValueError(f"both classes must be present, found {counts}")
    k = int(Decimal(str(share)) * min(counts.values()))
    digest, drawn = _digest(id_cols, salt), F.lit(False)
    for y, cut in exact_cuts(df, {0: k, 1: k}, id_cols, label, salt).items():
        start = F.substring(digest, 1, len(cut.digits))
        drawn = drawn | ((F.col(label) == y) & (start <= cut.digits if cut.inclusive else start < cut.digits))
    return F.coalesce(drawn, F.lit(False))


def balanced_exact(df: DataFrame, id_cols: list[str], label: str = "y", share: float = SHARE, salt: str = "42") -> DataFrame:
    """As ``balanced``, with exactly equal classes."""
    return df.filter(in_exact_train(df, id_cols, label, share, salt))


def train_test_exact(df: DataFrame, id_cols: list[str], label: str = "y", share: float = SHARE, salt: str = "42") -> tuple[DataFrame, DataFrame]:
    drawn = in_exact_train(df, id_cols, label, share, salt)
    return df.filter(drawn), df.filter(~drawn)


COPIES = 1000


def rest_of(df: DataFrame, taken: DataFrame, copies: int = COPIES) -> DataFrame:
    """Multiset difference for rows without an id. ``taken`` must be stored if it was drawn at random.

    Equal rows are counted, not moved. A row that is left many times is written out by many tasks, each
    making at most ``copies`` of it, so a group of copies of any size is no heavier than another.
    """
    sign = "_n"
    counted = (
        df.withColumn(sign, F.lit(1))
        .unionByName(taken.withColumn(sign, F.lit(-1)))
        .groupBy(*[f"`{c}`" for c in df.columns])
        .agg(F.sum(sign).alias(sign))
        .filter(f"{sign} > 0")
    )
    few = counted.filter(f"{sign} <= {copies}")
    many = (
        counted.filter(f"{sign} > {copies}")
        .withColumn("_start", F.explode(F.expr(f"sequence(0L, {sign} - 1, {copies}L)")))
        .repartition(F.expr("_start"), *[f"`{c}`" for c in df.columns])
        .withColumn(sign, F.least(F.lit(copies).cast("long"), F.col(sign) - F.col("_start")))
        .drop("_start")
    )
    repeated = few.unionByName(many).withColumn("_copy", F.explode(F.expr(f"sequence(1L, {sign})")))
    return repeated.select(*[f"`{c}`" for c in df.columns])
