"""Gain-ratio split search for all open nodes of a level at once.

Tables: ``rows`` (node_id, y, x), ``hist`` (node_id, feature, value, n0, n1), ``nodes`` (node_id, n0, n1),
with ``entropy`` added by ``node_stats``; ``candidates`` (node_id, feature, split, l0, l1, r0, r1, entropy). ``feature`` is a name, or its place in a dense row.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.functions.numeric import class_entropy, entropy_term, majority
from textree.operators.joins import join_small
from textree.storage import Stored, store

GROUP = ["node_id", "feature"]
NODE_BYTES = 64
MAX_GROUP = 1_000_000


def class_counts(df: DataFrame, label: str = "y") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n_rows"))


def node_stats(nodes: DataFrame, entropy_digits: int | None = 4) -> DataFrame:
    """Entropy and majority class of each node."""
    entropy = class_entropy("n0", "n1", entropy_digits)
    return nodes.selectExpr("*", f"{entropy} AS entropy", f"{majority('n0', 'n1')} AS majority")


def long_rows(rows: DataFrame, sparse: bool) -> DataFrame:
    """(node_id, y, feature, value); zeros of sparse rows are left to ``with_zero_bins``."""
    if not sparse:
        return rows.select("node_id", "y", F.posexplode("x").alias("feature", "value"))
    return rows.select("node_id", "y", F.explode("x").alias("feature", "value")).filter("value != 0.0")


def histogram(long: DataFrame) -> DataFrame:
    """Class counts per (node, feature, value), combined inside each task first."""
    return long.groupBy(*GROUP, "value").agg(F.expr("sum(1 - y) AS n0"), F.expr("sum(y) AS n1"))


def with_zero_bins(hist: DataFrame, nodes: DataFrame, nodes_bytes: int | None = None) -> DataFrame:
    """Add the bin of the rows that store no value: node totals less the stored ones, where any are left."""
    stored = hist.groupBy(*GROUP).agg(F.expr("sum(n0) AS s0"), F.expr("sum(n1) AS s1"))
    zeros = join_small(stored, nodes.select("node_id", "n0", "n1"), ["node_id"], "inner", GROUP, nodes_bytes)
    zeros = zeros.selectExpr(*GROUP, "0.0D AS value", "n0 - s0 AS n0", "n1 - s1 AS n1")
    return hist.unionByName(zeros.filter("n0 + n1 > 0"))


def child_histogram(
    small: DataFrame, parents: DataFrame, splits: DataFrame, splits_bytes: int | None = None, sparse: bool = False
) -> DataFrame:
    """Histogram of the open children of a level from the rows of the smaller child of each split alone.

    ``small`` holds (node_id, y, feature, value) of those rows, ``parents`` the histogram of the level above and
    ``splits`` its splits with the ``family`` columns. The larger child is what its parent has beyond the smaller one.
    Both are summed by the parent's bins, so one shuffle of bins serves both children.
    """
    ids = splits.selectExpr("node_id", "small_id", "big_id", "small_open", "big_open", "small0", "small1")
    up = join_small(small, ids.selectExpr("node_id AS up", "small_id AS node_id"), ["node_id"], "inner", ["feature", "value"], splits_bytes)
    above = join_small(parents, ids.select("node_id"), ["node_id"], "left_semi", ["feature", "value"], splits_bytes)
    cell = "named_struct('value', value, 's0', CAST(1 - y AS BIGINT), 's1', CAST(y AS BIGINT))"
    if sparse:
        # of the parent's zeros the smaller child has all its rows, less one for each value it stores
        cells = f"inline(array({cell}, named_struct('value', 0.0D, 's0', CAST(y - 1 AS BIGINT), 's1', CAST(-y AS BIGINT))))"
        zeros = join_small(above.filter("value = 0.0").select(*GROUP), ids.select("node_id", "small0", "small1"), ["node_id"], "inner", ["feature"], splits_bytes)
        counts = up.selectExpr("up AS node_id", "feature", cells).unionByName(zeros.selectExpr(*GROUP, "0.0D AS value", "small0 AS s0", "small1 AS s1"))
    else:
        counts = up.selectExpr("up AS node_id", "feature", f"inline(array({cell}))")
    counts = counts.selectExpr(*GROUP, "value", "0L AS p0", "0L AS p1", "s0", "s1")
    parts = counts.unionByName(above.selectExpr(*GROUP, "value", "n0 AS p0", "n1 AS p1", "0L AS s0", "0L AS s1"))
    summed = parts.groupBy(*GROUP, "value").agg(*[F.sum(c).alias(c) for c in ("p0", "p1", "s0", "s1")]).filter("p0 + p1 > 0")
    both = join_small(summed, ids.drop("small0", "small1"), ["node_id"], "inner", ["feature", "value"], splits_bytes)
    child = "named_struct('node_id', {0}_id, 'feature', feature, 'value', value, 'n0', {1}, 'n1', {2}, 'open', {0}_open)"
    pair = f"inline(array({child.format('small', 's0', 's1')}, {child.format('big', 'p0 - s0', 'p1 - s1')}))"
    return both.selectExpr(pair).filter("open AND n0 + n1 > 0").drop("open")


def _left_side(table: DataFrame) -> DataFrame:
    """Counts below each midpoint from (value, next_value, n0, n1, run0, run1).

    A midpoint that rounds down to ``value`` itself leaves that bin on the right. One that is not finite
    would leave one side empty and is dropped.
    """
    split = "(value + next_value) / 2.0D"
    left = table.selectExpr(
        *GROUP,
        f"{split} AS split",
        f"CASE WHEN {split} > value THEN run0 ELSE run0 - n0 END AS l0",
        f"CASE WHEN {split} > value THEN run1 ELSE run1 - n1 END AS l1",
    )
    return left.filter(f"abs(split) <= {sys.float_info.max!r}D")


def _running(hist: DataFrame, by: list[str]) -> DataFrame:
    order = f"(PARTITION BY {', '.join(by)} ORDER BY value)"
    upto = order.replace(")", " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    return hist.selectExpr(
        *by,
        "value",
        "n0",
        "n1",
        f"lead(value) OVER {order} AS next_value",
        f"sum(n0) OVER {upto} AS run0",
        f"sum(n1) OVER {upto} AS run1",
    )


def left_counts(hist: DataFrame) -> DataFrame:
    """Class counts left of every midpoint by a running sum within each (node, feature)."""
    return _left_side(_running(hist, GROUP))


def piece_bounds(hist: DataFrame, largest: int, max_group: int) -> DataFrame:
    """Where groups of more than ``max_group`` values are cut: (node_id, feature, bounds, heads).

    The bounds come from a quantile sketch of each such group, merged over tasks. With p pieces and a rank error of
    n / 8p no piece exceeds ``max_group``, for any distribution of values and any number of shuffle partitions.
    """
    pieces = max(2, -(-2 * largest // max_group))
    shares = [i / pieces for i in range(1, pieces)]
    sizes = hist.groupBy(*GROUP).agg(F.count("*").alias("n")).filter(F.col("n") > max_group)
    large = join_small(hist, sizes.select(*GROUP), GROUP, "inner", ["value"])
    found = large.groupBy(*GROUP).agg(F.percentile_approx("value", shares, 8 * pieces).alias("bounds"))
    step = math.isqrt(pieces)
    heads = f"transform(sequence(0, size(bounds) - 1, {step}), i -> bounds[i])"
    return found.selectExpr(*GROUP, "array_sort(array_distinct(bounds)) AS bounds").selectExpr("*", f"{heads} AS heads", f"{step} AS step")


def _in_pieces(hist: DataFrame, bounds: DataFrame) -> DataFrame:
    """``piece``: how many bounds of its group lie below a value, looked up in two steps of the root of their number."""
    met = join_small(hist, bounds, GROUP, "left", ["value"])
    met = met.withColumn("_head", F.expr("size(filter(heads, b -> b < value))"))
    inside = "(_head - 1) * step + size(filter(slice(bounds, (_head - 1) * step + 1, step), b -> b < value))"
    piece = f"CASE WHEN bounds IS NULL OR _head = 0 THEN 0 ELSE {inside} END"
    return met.withColumn("piece", F.expr(piece)).drop("bounds", "heads", "step", "_head")


def left_counts_ranged(hist: DataFrame, max_group: int = MAX_GROUP, largest: int | None = None, stored: list[Stored] | None = None) -> DataFrame:
    """The same counts when one (node, feature) has more values than one task should sort.

    Larger groups are cut into pieces of consecutive values, at most ``max_group`` in each whatever the session's
    settings. Pieces are summed on their own; what lies before a piece, and the value that follows it, come from a
    table with one row per piece. ``hist`` should be stored. The bounds are stored and added to ``stored`` for the
    caller to release once the counts are used.
    """
    by = [*GROUP, "piece"]
    largest = largest_group(hist) if largest is None else largest
    # stored, because both uses below must see the same cut
    bounds = store(piece_bounds(hist, largest, max_group), "bounds")
    if stored is not None:
        stored.append(bounds)
    pieces = _in_pieces(hist, bounds.df)
    order = "(PARTITION BY node_id, feature ORDER BY piece)"
    before = order.replace(")", " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    edges = (
        pieces.groupBy(*by)
        .agg(F.sum("n0").alias("p0"), F.sum("n1").alias("p1"), F.min("value").alias("first_value"))
        .selectExpr(
            *by,
            f"coalesce(sum(p0) OVER {before}, 0) AS before0",
            f"coalesce(sum(p1) OVER {before}, 0) AS before1",
            f"lead(first_value) OVER {order} AS after_value",
        )
    )
    return _left_side(
        _running(pieces, by)
        .join(edges, by)
        .selectExpr(
            *GROUP,
            "value",
            "n0",
            "n1",
            "coalesce(next_value, after_value) AS next_value",
            "run0 + before0 AS run0",
            "run1 + before1 AS run1",
        )
    )


def split_points(left: DataFrame) -> DataFrame:
    """Midpoints of neighbouring distinct values; a feature with one value has none."""
    return left.select(*GROUP, "split")


def largest_group(hist: DataFrame) -> int:
    """Most distinct values that any (node, feature) has."""
    sizes = hist.groupBy(*GROUP).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def candidates(left: DataFrame, nodes: DataFrame, nodes_bytes: int | None = None) -> DataFrame:
    """Counts on both sides of each midpoint: the right side is what the node has beyond the left."""
    totals = nodes.select("node_id", "n0", "n1", "entropy")
    sides = join_small(left, totals, ["node_id"], "inner", [*GROUP, "split"], nodes_bytes)
    return sides.selectExpr(*GROUP, "split", "l0", "l1", "n0 - l0 AS r0", "n1 - l1 AS r1", "entropy")


def gain_ratio(cands: DataFrame, min_side: int = 100) -> DataFrame:
    """Gain ratio of the splits that leave more than ``min_side`` rows on both sides.

    ``entropy`` comes with the node and is rounded there; the information of the sides is not. The shares
    are columns of their own so that each is computed once and the generated code stays small.
    """
    allowed = cands.filter(f"l0 + l1 > {min_side} AND r0 + r1 > {min_side}").selectExpr(
        "*", "CAST(l0 + l1 AS DOUBLE) AS _l", "CAST(r0 + r1 AS DOUBLE) AS _r"
    )
    shares = allowed.selectExpr(
        "*",
        "l0 / _l AS _l0",
        "l1 / _l AS _l1",
        "r0 / _r AS _r0",
        "r1 / _r AS _r1",
        "_l / (_l + _r) AS _pl",
        "_r / (_l + _r) AS _pr",
    )
    left = f"_pl * ({entropy_term('_l0')} + {entropy_term('_l1')})"
    right = f"_pr * ({entropy_term('_r0')} + {entropy_term('_r1')})"
    ratio = f"try_divide(entropy - ({left} + {right}), {entropy_term('_pl')} + {entropy_term('_pr')})"
    kept = [c for c in cands.columns if c != "entropy"]
    return shares.selectExpr(*kept, f"{ratio} AS gain_ratio")


def best(gains: DataFrame, gain_digits: int | None = None) -> DataFrame:
    """The split with the largest gain ratio per node; ties go to the first feature, then the lowest split.

    A minimum over structs is combined inside each task, so a node with most of the candidates is no
    heavier than any other. ``gain_digits`` rounds the ratio before it is compared.
    """
    rank = "-gain_ratio" if gain_digits is None else f"-round(gain_ratio, {gain_digits})"
    rest = [c for c in gains.columns if c not in ("node_id", "feature", "split")]
    first = f"min(struct({rank} AS rank, feature, split, {', '.join(rest)})) AS b"
    return gains.groupBy("node_id").agg(F.expr(first)).select("node_id", "b.feature", "b.split", *[f"b.{c}" for c in rest])
