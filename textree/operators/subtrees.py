"""Subtrees below nodes of bounded size, each grown in the task that holds the node's rows.

The split rule is that of ``operators.split``. Ratios are compared as rounded there, so the last bit of a logarithm,
in which numpy and the JVM may differ, does not decide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.operators.features import add_row_id
from textree.storage import Stored, store

# ``path`` leads from the node ``top`` to the split: 0 is left, 1 is right.
SPLITS = "top long, path string, depth int, feature string, split double, l0 long, l1 long, r0 long, r1 long"


def _rounded(value: float, digits: int) -> float:
    """Half up on the decimal form, as Spark rounds."""
    return float(Decimal(repr(float(value))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def _term(p):
    with np.errstate(divide="ignore", invalid="ignore"):
        return -p * np.where(p == 0.0, 0.0, np.log10(p) / np.log10(2.0))


def entropy(n0: int, n1: int, digits: int | None) -> float:
    whole = n0 + n1
    value = abs(float(_term(np.float64(n0 / whole)) + _term(np.float64(n1 / whole)))) if whole else 0.0
    return value if digits is None else _rounded(value, digits)


def midpoints(
    v: np.ndarray, y: np.ndarray, most: int, values: np.ndarray | None = None,
    before: tuple[int, int] = (0, 0), bin_before: tuple[int, int] = (0, 0), after: float | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Midpoints of a sorted column with the rows and ones left of each, in pieces of at most ``most`` values that are
    summed on their own.

    ``v`` holds places in ``values`` if those are given. Where the column goes on in other tasks, ``before`` lies left of
    its first row and ``bin_before`` left of all rows with that row's value; ``after`` is the next value behind it.
    """
    ends = np.flatnonzero(v[1:] != v[:-1])
    here, there = (a if values is None else values[a] for a in (v[ends], v[ends + 1]))
    if after is not None:
        ends = np.append(ends, len(v) - 1)
        here, there = np.append(here, v[-1] if values is None else values[v[-1]]), np.append(there, after)
    (rows, ones), total, begin = bin_before, before[1], 0
    for first in range(0, len(ends), most):
        end, low, high = (a[first : first + most] for a in (ends, here, there))
        upto = before[0] + end + 1
        run = total + np.cumsum(y[begin : end[-1] + 1], dtype=np.int64)[end - begin]
        with np.errstate(over="ignore", invalid="ignore"):
            split = (low + high) / 2.0
        # a midpoint that rounds down to the value itself leaves that bin on the right
        whole = split > low
        yield split, np.where(whole, upto, np.append(rows, upto[:-1])), np.where(whole, run, np.append(ones, run[:-1]))
        rows, ones, total, begin = upto[-1], run[-1], run[-1], end[-1] + 1


def _ratios(rows: np.ndarray, ones: np.ndarray, n: int, n1: int, node_entropy: float) -> np.ndarray:
    left, right = rows.astype(float), (n - rows).astype(float)
    pl, pr = left / (left + right), right / (left + right)
    inside = pl * (_term((rows - ones) / left) + _term(ones / left))
    inside = inside + pr * (_term((n - rows - (n1 - ones)) / right) + _term((n1 - ones) / right))
    return (node_entropy - inside) / (_term(pl) + _term(pr))


def best_split(parts: Iterable[tuple], n: int, n1: int, rule) -> tuple[float, int, float, int, int] | None:
    """Rounded ratio, place of the feature, split, rows and ones to its left; ties go to the first feature, then the
    lowest split. ``parts`` has (place, split, rows, ones) in that order, for a node of ``n`` rows, ``n1`` of them ones."""
    node_entropy = entropy(n - n1, n1, rule.entropy_digits)
    found, most, slack = [], -np.inf, 2 * 10.0**-rule.gain_digits
    for place, *part in parts:
        split, rows, _ = part
        allowed = (rows > rule.min_side) & (n - rows > rule.min_side) & (np.abs(split) <= sys.float_info.max)
        if not allowed.any():
            continue
        split, rows, ones = (a[allowed] for a in part)
        ratio = _ratios(rows, ones, n, n1, node_entropy)
        if ratio.max() >= most - slack:
            most = max(most, ratio.max())
            near = np.flatnonzero(ratio >= most - slack)
            found.append((place, ratio[near], split[near], rows[near], ones[near]))
    best = None
    for place, ratio, split, rows, ones in found:
        if ratio.max() < most - slack:
            continue
        values, at = np.unique(ratio, return_inverse=True)
        ratio = np.array([_rounded(r, rule.gain_digits) for r in values])[at]
        i = int(np.argmax(ratio))
        if best is None or ratio[i] > best[0]:
            best = (float(ratio[i]), place, float(split[i]), int(rows[i]), int(ones[i]))
    return best


def grow(x: np.ndarray, y: np.ndarray, depth: int, rule) -> Iterator[tuple]:
    """(path, depth, place, split, l0, l1, r0, r1) of all splits below a node at ``depth`` whose rows are given.

    Every column is sorted once; a split parts the sorted columns, so a node costs its own rows.
    """
    orders = [np.argsort(column, kind="stable") for column in x.T]
    goes_right = np.zeros(len(y), bool)
    waiting = [("", depth, [(x[o, k], y[o], o) for k, o in enumerate(orders)])]
    while waiting:
        path, depth, columns = waiting.pop()
        n, n1 = len(columns[0][1]), int(columns[0][1].sum())
        best = best_split(((k, *part) for k, (v, labels, _) in enumerate(columns) for part in midpoints(v, labels, rule.max_group)), n, n1, rule)
        if best is None:
            continue
        _, place, split, n_left, l1 = best
        sides = ((n_left - l1, l1), (n - n_left - (n1 - l1), n1 - l1))
        yield path, depth, place, split, *sides[0], *sides[1]
        over = columns[place][2][n_left:]
        goes_right[over] = True
        masks = [goes_right[ids] for _, _, ids in columns]
        goes_right[over] = False
        for side, (c0, c1) in enumerate(sides):
            if depth + 1 < rule.max_depth and entropy(c0, c1, rule.entropy_digits) > rule.entropy_stop:
                parts = [tuple(a[m if side else ~m] for a in column) for column, m in zip(columns, masks, strict=True)]
                waiting.append((f"{path}{side}", depth + 1, parts))


def subtree_splits(rows: DataFrame, names: Sequence[str], depth: int, rule, tops: dict[int, tuple[str, int]] | None = None) -> DataFrame:
    """All splits below the nodes that ``rows`` (node_id, y, x) are in. A task holds one node at a time.

    The nodes lie at ``depth``, or where ``tops`` says: the path of each from the root, and its depth.
    """
    names = list(names)

    def grown(key: tuple, node: pa.Table) -> pa.Table:
        top, (above, start) = key[0].as_py(), ("", depth)
        if tops is not None:
            top, (above, start) = 1, tops[top]
        y = node["y"].to_numpy()
        x = pa.concat_arrays(node["x"].chunks).flatten().to_numpy().reshape(len(y), len(names))
        made = [(top, above + path, at, names[place], *rest) for path, at, place, *rest in grow(x, y, start, rule)]
        columns = list(zip(*made, strict=True)) if made else [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SPLITS.split(", "))])
    # a given number keeps small rows with much work in as many tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("node_id", "y", "x").repartition(parts, "node_id").groupBy("node_id").applyInArrow(grown, SPLITS)


def numbered_splits(splits: DataFrame, next_id: int) -> Stored:
    """The stored ``splits`` with node_id, left_id and right_id, numbered level by level in the order of their parents."""
    slots = add_row_id(splits, ["depth", "top", "path"], "slot")
    ids = slots.selectExpr("*", f"2 * slot + {next_id - 2} AS left_id", f"2 * slot + {next_id - 1} AS right_id")
    up = ids.selectExpr("top", "path AS up", "left_id AS up_left", "right_id AS up_right")
    met = ids.withColumn("up", F.expr("left(path, length(path) - 1)")).join(up, ["top", "up"], "left")
    node = "CASE WHEN path = '' THEN top WHEN endswith(path, '1') THEN up_right ELSE up_left END AS node_id"
    columns = ("depth", "feature", "split", "l0", "l1", "r0", "r1", "false AS left_open", "false AS right_open", "left_id", "right_id")
    return store(met.selectExpr(node, *columns), "level")
