"""Growing a gain-ratio tree level by level, scoring tables with it, reading it as rules.

A tree is a table: node_id (root 1, numbered level by level), parent_id, depth, feature, split,
left_id (value < split), right_id, label (leaves only), n0, n1.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.functions.numeric import class_entropy, majority
from textree.operators import split as sp
from textree.operators.features import Matrix, add_row_id
from textree.operators.joins import BROADCAST_BYTES, join_small, size_in_bytes
from textree.operators.large_nodes import large_splits, opens, rows_below, tasks_for
from textree.operators.subtrees import SPLITS, numbered_splits, subtree_splits
from textree.storage import Stored, spread, store

ENTROPY_STOP = 0.3
# Nodes of one level whose splits may pass through the driver.
LOCAL_NODES = 1000
# Nodes of one level that may be numbered by a single task.
NUMBER_ROWS = 1_000_000
# Nodes up to which scoring is one nested CASE expression.
CASE_NODES = 200
# Level joins that may pile up in one plan before the rows are stored again.
PLAN_LEVELS = 6
# Levels of a tree beyond a broadcast that one join walks through.
WALK_LEVELS = 5
# A level's histogram is kept for the next one while it has at most this part of the cells it was built from.
KEEP_SHARE = 0.5
# Below so many cells a level is built from all its rows: less work than a stored table.
KEEP_CELLS = 1_000_000
# Cells of a node whose subtree one task may grow.
SUBTREE_CELLS = 1_000_000

WINNERS = pa.schema(
    [
        ("node_id", pa.int64()),
        ("depth", pa.int32()),
        ("feature", pa.string()),
        ("split", pa.float64()),
        ("l0", pa.int64()),
        ("l1", pa.int64()),
        ("r0", pa.int64()),
        ("r1", pa.int64()),
        ("left_open", pa.bool_()),
        ("right_open", pa.bool_()),
        ("left_id", pa.int64()),
        ("right_id", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """When a node stays open and which splits it may take."""

    max_depth: int
    min_side: int
    entropy_stop: float
    entropy_digits: int | None
    gain_digits: int | None
    max_group: int

    def opens(self, n0: str, n1: str, depth: int) -> str:
        if depth >= self.max_depth:
            return "false"
        return f"{class_entropy(n0, n1, self.entropy_digits)} > {self.entropy_stop!r}D"


@dataclass(frozen=True)
class Level:
    """The splits of one depth, and what the next depth needs to know about them."""

    winners: DataFrame
    n_splits: int
    n_open: int
    biggest: int
    active: int
    winners_bytes: int
    rows: list[dict]
    stored: Stored | None


def _check_root(rows: DataFrame, sparse: bool, rule: Rule) -> tuple[int, int, bool, float, bool]:
    """Class totals, whether the root is open, the cells of a row and whether all rows hold as many values, none of
    them NULL, after refusing other labels and NaN features."""
    values = "map_values(x)" if sparse else "x"
    found = (
        rows.selectExpr(
            "count_if(y = 0) AS n0",
            "count_if(y = 1) AS n1",
            "count_if(y NOT IN (0, 1)) AS bad",
            f"count_if(exists({values}, v -> isnan(v))) AS nan",
            "coalesce(avg(size(x)), 0D) AS cells",
            f"min(size(x)) = max(size(x)) AND count_if(exists({values}, v -> v IS NULL)) = 0 AS even",
        )
        .selectExpr("*", f"{rule.opens('n0', 'n1', 0)} AS open")
        .first()
    )
    if found["bad"]:
        raise ValueError(f"{found['bad']} rows have a label that is neither 0 nor 1")
    if found["nan"]:
        raise ValueError(f"{found['nan']} rows hold a NaN feature")
    return found["n0"], found["n1"], found["open"], found["cells"], bool(found["even"])


def _store_spread(rows: DataFrame) -> Stored:
    """Store the rows; a table in fewer pieces than there are cores is stored once more, in as many."""
    kept = store(rows, "rows")
    wider = spread(kept.df)
    if wider is kept.df:
        return kept
    again = store(wider, "rows")
    kept.release()
    return again


def _value_at(x: str, place: Column, sparse: bool) -> Column:
    """The value of a row's feature, found by name in a sparse row or by place in a dense one."""
    if sparse:
        return F.coalesce(F.try_element_at(x, place), F.lit(0.0))
    return F.get(x, place)


def children(winners: DataFrame) -> DataFrame:
    """Both children of every split: (node_id, parent_id, depth, n0, n1, open)."""

    def child(side: str) -> str:
        return (
            f"named_struct('node_id', {side}_id, 'parent_id', node_id, 'depth', depth + 1, "
            f"'n0', {side[0]}0, 'n1', {side[0]}1, 'open', {side}_open)"
        )

    return winners.selectExpr(f"inline(array({child('left')}, {child('right')}))")


def family(winners: DataFrame) -> DataFrame:
    """The splits with an open child, each with its smaller and its larger child."""
    small = "l0 + l1 <= r0 + r1"

    def pick(left: str, right: str) -> str:
        return f"CASE WHEN {small} THEN {left} ELSE {right} END"

    return winners.filter("left_open OR right_open").selectExpr(
        "*",
        f"{small} AS left_small",
        f"{pick('left_id', 'right_id')} AS small_id",
        f"{pick('right_id', 'left_id')} AS big_id",
        f"{pick('left_open', 'right_open')} AS small_open",
        f"{pick('right_open', 'left_open')} AS big_open",
        f"{pick('l0', 'r0')} AS small0",
        f"{pick('l1', 'r1')} AS small1",
    )


def route(
    rows: DataFrame, winners: DataFrame, names: tuple[str, ...] | None, winners_bytes: int | None = None, halves: bool = False
) -> DataFrame:
    """Move the rows of split nodes to the children that stay open; all other rows are done.

    ``built`` marks the rows whose cells the next histogram needs. With ``halves`` these are the rows of the smaller
    child of each split, which are then kept for one level even if only the larger child is open.
    """
    sparse = names is None
    place = F.col("feature") if sparse else _place(names)
    flags = ["left_small", "small_open", "big_open"]
    steps = family(winners).select("node_id", place.alias("place"), "split", "left_id", "right_id", *flags)
    met = join_small(rows, steps, ["node_id"], "inner", ["salt"], winners_bytes)
    right = _value_at("x", F.col("place"), sparse) >= F.col("split")
    met = met.withColumn("_right", right).withColumn("_small", F.expr("_right != left_small"))
    kept = "_small OR big_open" if halves else "CASE WHEN _small THEN small_open ELSE big_open END"
    return met.filter(kept).selectExpr(
        "CASE WHEN _right THEN right_id ELSE left_id END AS node_id", "y", "x", "salt", "_small AS built" if halves else "true AS built"
    )


def _place(names: Sequence[str]) -> Column:
    """Place of a feature in a dense row."""
    return (F.array_position(F.lit(list(names)), F.col("feature")) - 1).cast("int")


def level_histogram(rows: DataFrame, nodes: DataFrame, n_nodes: int, sparse: bool, above: tuple[DataFrame, Level] | None) -> DataFrame:
    """Bins of all open nodes: from all their rows, or, given the histogram above and its splits, from the smaller children."""
    if above:
        parents, level = above
        cells = sp.long_rows(rows.filter("built"), sparse)
        return sp.child_histogram(cells, parents, family(level.winners), level.winners_bytes, sparse)
    hist = sp.histogram(sp.long_rows(rows, sparse))
    return sp.with_zero_bins(hist, nodes, n_nodes * sp.NODE_BYTES) if sparse else hist


def best_splits(hist: DataFrame, nodes: DataFrame, n_nodes: int, largest: int, rule: Rule) -> tuple[DataFrame, list[Stored]]:
    """The best split of every open node, and what had to be stored on the way. ``largest`` bounds the values of a group."""
    kept: list[Stored] = []
    if largest > rule.max_group:
        left = sp.left_counts_ranged(hist, rule.max_group, largest, kept)
    else:
        left = sp.left_counts(hist)
    gains = sp.gain_ratio(sp.candidates(left, nodes, n_nodes * sp.NODE_BYTES), rule.min_side)
    return sp.best(gains, rule.gain_digits), kept


def _local_level(spark: SparkSession, found: DataFrame, next_id: int) -> Level:
    """Number the few splits of a small level on the driver and keep them as literal rows."""
    rows = [r.asDict() for r in found.collect()]
    rows.sort(key=lambda r: r["node_id"])
    sizes = []
    for slot, row in enumerate(rows):
        row["left_id"], row["right_id"] = next_id + 2 * slot, next_id + 2 * slot + 1
        for side in ("left", "right"):
            if row[f"{side}_open"]:
                sizes.append(row[f"{side[0]}0"] + row[f"{side[0]}1"])
    table = pa.Table.from_pylist(rows, WINNERS)
    return Level(
        spark.createDataFrame(table), len(rows), len(sizes), max(sizes, default=0), sum(sizes), table.nbytes, rows, None
    )


def _stored_level(found: DataFrame, n_nodes: int, next_id: int) -> Level:
    """Number the splits of a large level in Spark and store them."""
    kept = None
    if n_nodes <= NUMBER_ROWS:
        numbered = found.selectExpr("*", "CAST(row_number() OVER (ORDER BY node_id) AS BIGINT) AS slot")
    else:
        kept = store(found, "best")
        numbered = add_row_id(kept.df, ["node_id"], "slot")
    ids = (f"2 * slot + {next_id - 2} AS left_id", f"2 * slot + {next_id - 1} AS right_id")
    level = store(numbered.selectExpr(*found.columns, *ids), "level")
    if kept:
        kept.release()
    left, right = "CASE WHEN left_open THEN l0 + l1 END", "CASE WHEN right_open THEN r0 + r1 END"
    seen = level.df.selectExpr(
        "count(*) AS n",
        f"count({left}) + count({right}) AS n_open",
        f"coalesce(greatest(max({left}), max({right})), 0) AS biggest",
        f"coalesce(sum({left}), 0) + coalesce(sum({right}), 0) AS active",
        "coalesce(sum(octet_length(feature) + 96), 0) AS bytes",
    ).first()
    return Level(level.df, seen["n"], seen["n_open"], seen["biggest"], seen["active"], seen["bytes"], [], level)


def _subtree_level(rows: DataFrame, nodes: DataFrame, n_nodes: int, names: Sequence[str], depth: int, rule: Rule, next_id: int) -> Level:
    """All splits below the open nodes of a level, whose rows a task may hold node by node."""
    inside = join_small(rows, nodes.select("node_id"), ["node_id"], "left_semi", ["salt"], n_nodes * sp.NODE_BYTES)
    found = store(subtree_splits(inside, names, depth, rule), "subtrees")
    level = numbered_splits(found.df, next_id)
    found.release()
    return Level(level.df, level.df.count(), 0, 0, 0, 0, [], level)


def _whole_tree(rows: DataFrame, n0: int, n1: int, names: Sequence[str], tasks: int, largest: int, rule: Rule) -> Level:
    """All splits of the tree: of nodes of over ``largest`` rows by tasks that stay for all levels, below them node by node."""
    spark = rows.sparkSession
    splits = large_splits(rows, n0, n1, names, tasks, largest, rule)
    tops = []
    for s in splits:
        for side, counts in enumerate(((s["l0"], s["l1"]), (s["r0"], s["r1"]))):
            if sum(counts) <= largest and opens(*counts, s["depth"] + 1, rule):
                tops.append((f"{s['path']}{side}", s["depth"] + 1))
    tops = dict(enumerate(tops))
    made = spark.createDataFrame([tuple(s.values()) for s in splits], SPLITS)
    if tops:
        below = subtree_splits(rows_below(rows, splits, list(names), tops), names, 0, rule, tops)
        made = made.unionByName(below)
    found = store(made, "subtrees")
    level = numbered_splits(found.df, 2)
    found.release()
    return Level(level.df, level.df.count(), 0, 0, 0, 0, [], level)


def fit(
    matrix: Matrix,
    max_depth: int = 100,
    min_side: int = 100,
    entropy_stop: float = ENTROPY_STOP,
    entropy_digits: int | None = 4,
    gain_digits: int | None = None,
    max_group: int = sp.MAX_GROUP,
    plan_levels: int = PLAN_LEVELS,
    local_nodes: int = LOCAL_NODES,
    keep_share: float = KEEP_SHARE,
    keep_cells: int = KEEP_CELLS,
    subtree_cells: int = SUBTREE_CELLS,
) -> DataFrame:
    """Grow the tree: one job per depth for all its nodes, until they are small.

    Each row carries its features and the node it is in, so no level shuffles rows: only histogram bins
    and one line per node travel. A node becomes a leaf when its entropy is at most ``entropy_stop``, at
    ``max_depth``, or when no split leaves more than ``min_side`` rows on each side. Levels of up to
    ``local_nodes`` nodes hand their splits to the driver; larger ones stay tables.

    While a level's histogram has at most ``keep_share`` of the cells it sums up, it is stored, and the next level
    looks at the rows of the smaller child of each split only; the larger child is the difference. Values that hardly
    repeat would make such a histogram as large as the rows, so there (and in levels of fewer than ``keep_cells`` cells)
    every open row is looked at. The tree is the same.

    A node of a dense table with at most ``subtree_cells`` cells and half of all rows is brought to one task, which
    grows all below it: lopsided splits can make a small node a hundred levels deep, and each would be a job. In a table
    of more cells the nodes above are split by tasks that hold sorted ranges of all features and stay for all levels
    (``operators/large_nodes.py``); if they cannot hold them, or the table is small, levels are jobs until no open node
    is larger. Without ``gain_digits`` levels stay jobs, as the last bit of a ratio may decide there.
    """
    if min_side < 0:
        raise ValueError("min_side must not be negative")
    rule = Rule(max_depth, min_side, entropy_stop, entropy_digits, gain_digits, max_group)
    spark, names = matrix.rows.sparkSession, matrix.names
    salt = F.monotonically_increasing_id().alias("salt")
    rows_at = _store_spread(matrix.rows.select("y", "x").dropna(subset=["y"]).select("y", "x", salt))
    n0, n1, is_open, row_cells, even = _check_root(rows_at.df, matrix.sparse, rule)
    rows = rows_at.df.withColumn("node_id", F.lit(1).cast("long"))
    root = pa.table({"node_id": [1], "n0": [n0], "n1": [n1]})
    nodes = sp.node_stats(spark.createDataFrame(root), entropy_digits)
    n_nodes, biggest, stored_rows = int(is_open), n0 + n1, n0 + n1
    depth, next_id, piled, levels = 0, 2, 0, []
    active, halves, above = n0 + n1, keep_share > 0, None

    by_node = even and not matrix.sparse and gain_digits is not None
    largest_node = int(min((n0 + n1) // 2, subtree_cells // max(1.0, row_cells)))
    tasks = tasks_for(spark, n0 + n1, len(names)) if by_node and is_open and 0 < subtree_cells < row_cells * (n0 + n1) else 0
    if tasks:
        levels.append(_whole_tree(rows_at.df, n0, n1, names, tasks, largest_node, rule))
        n_nodes = 0
    while n_nodes:
        if by_node and biggest <= largest_node:
            levels.append(_subtree_level(rows, nodes, n_nodes, names, depth, rule, next_id))
            break
        hist, kept, last = level_histogram(rows, nodes, n_nodes, matrix.sparse, above and (above.df, levels[-1])), [], above
        above, halves = None, halves and row_cells * active >= keep_cells
        # a group has no more values than its node has rows, so small nodes need no look
        if halves or biggest > max_group:
            made = store(hist, "hist")
            hist = made.df
            halves = halves and hist.count() <= keep_share * row_cells * active
            if halves:
                above = made
            else:
                kept.append(made)
            if biggest > max_group:
                biggest = sp.largest_group(hist)
        found, cut = best_splits(hist, nodes, n_nodes, biggest, rule)
        kept += cut
        if not matrix.sparse:
            found = found.withColumn("feature", F.element_at(F.lit(list(names)), F.col("feature") + 1))
        found = found.selectExpr(
            "node_id",
            f"{depth} AS depth",
            "feature",
            "split",
            "l0",
            "l1",
            "r0",
            "r1",
            f"{rule.opens('l0', 'l1', depth + 1)} AS left_open",
            f"{rule.opens('r0', 'r1', depth + 1)} AS right_open",
        )
        if n_nodes <= local_nodes:
            level = _local_level(spark, found, next_id)
        else:
            level = _stored_level(found, n_nodes, next_id)
        for part in kept + ([last] if last else []):
            part.release()
        levels.append(level)
        n_nodes, biggest, active = level.n_open, level.biggest, level.active
        next_id += 2 * level.n_splits
        depth += 1
        if not n_nodes:
            break
        nodes = sp.node_stats(children(level.winners).filter("open"), entropy_digits)
        rows = route(rows, level.winners, names, level.winners_bytes, halves)
        piled += 1
        if piled >= plan_levels or level.active * 2 <= stored_rows:
            fresh = store(rows.select("y", "x", "salt", "node_id", "built"), "rows")
            rows_at.release()
            rows_at, rows, stored_rows, piled = fresh, fresh.df, level.active, 0

    rows_at.release()
    if above:
        above.release()
    tree = store(_assemble(spark, n0, n1, levels), "tree").df
    for level in levels:
        if level.stored:
            level.stored.release()
    return tree


def _assemble(spark: SparkSession, n0: int, n1: int, levels: list[Level]) -> DataFrame:
    """One table from the splits of all levels; a child that was not split is a leaf."""
    local = pa.Table.from_pylist([row for level in levels for row in level.rows], WINNERS)
    winners = spark.createDataFrame(local)
    paths = [level.stored.path for level in levels if level.stored]
    if paths:
        winners = winners.unionByName(spark.read.schema(winners.schema).parquet(*paths))
    root = spark.sql(f"SELECT 1L AS node_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth, {n0}L AS n0, {n1}L AS n1")
    nodes = root.unionByName(children(winners).drop("open"))
    steps = winners.select("node_id", "feature", "split", "left_id", "right_id")
    return nodes.join(steps, "node_id", "left").selectExpr(
        "node_id",
        "parent_id",
        "depth",
        "feature",
        "split",
        "left_id",
        "right_id",
        f"CASE WHEN feature IS NULL THEN {majority('n0', 'n1')} END AS label",
        "n0",
        "n1",
    )


# --- scoring ---------------------------------------------------------------------------------------


def _goes_right(value: Column, split, boundary: str) -> Column:
    return value > split if boundary == "gt" else value >= split


def case_expression(nodes: dict[int, dict], value_of: Callable[[str], Column], boundary: str) -> Column:
    """The whole tree as one nested CASE."""

    def build(node_id: int) -> Column:
        node = nodes[node_id]
        if node["feature"] is None:
            return F.lit(node["label"])
        right = _goes_right(value_of(node["feature"]), node["split"], boundary)
        return F.when(right, build(node["right_id"])).otherwise(build(node["left_id"]))

    return build(1)


def _used_features(tree: DataFrame, most: int) -> list[str]:
    """Features that the tree splits on, sorted; one more than ``most`` at most come back."""
    named = tree.filter("feature IS NOT NULL").select("feature").distinct()
    return sorted(r[0] for r in named.limit(most + 1).collect())


def _resolve(tree: DataFrame, columns: Sequence[str], case_sensitive: bool) -> dict[str, str]:
    """The column of each feature, by the session's case rule; ValueError names what is missing or ambiguous."""
    key = str if case_sensitive else str.lower
    found: dict[str, list[str]] = {}
    for column in columns:
        found.setdefault(key(column), []).append(column)
    used = _used_features(tree, len(columns))
    missing = [f for f in used if key(f) not in found]
    if missing:
        raise ValueError(f"no column for the features {missing}")
    double = [f for f in used if len(found[key(f)]) > 1]
    if double:
        raise ValueError(f"more than one column for the features {double}")
    return {f: found[key(f)][0] for f in used}


def _walker(nodes: list[dict], names: Sequence[str], boundary: str, kind) -> Callable[[Column], Column]:
    """One pass over arrays of feature values: every row of a batch goes down one level at a time."""
    at = {node["node_id"]: i for i, node in enumerate(nodes)}
    place_of = {name: i for i, name in enumerate(names)}
    inner = np.array([node["feature"] is not None for node in nodes])
    place = np.array([place_of[n["feature"]] if n["feature"] is not None else 0 for n in nodes], np.int32)
    split = np.array([n["split"] if n["feature"] is not None else 0.0 for n in nodes])
    left, right = (np.array([at[n[side]] if n["feature"] is not None else 0 for n in nodes]) for side in ("left_id", "right_id"))
    label = np.array([n["label"] or 0 for n in nodes])
    root = at[1]

    @F.pandas_udf(kind)
    def walk(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, 1))
        now = np.full(len(x), root)
        open_ = np.flatnonzero(inner[now])
        while len(open_):
            node = now[open_]
            value = x[open_, place[node]]
            goes_right = (value > split[node] if boundary == "gt" else value >= split[node]) | np.isnan(value)
            now[open_] = np.where(goes_right, right[node], left[node])
            open_ = open_[inner[now[open_]]]
        return pd.Series(label[now])

    return walk


def packed_subtrees(tree: DataFrame, names: Sequence[str], levels: int) -> DataFrame:
    """The tree cut into subtrees of ``levels`` levels: (_node, _depth, _at, _nodes), one row for each.

    ``_nodes`` is an array of at most 2^(levels + 1) - 1 entries in order of node_id, the subtree's root at place
    ``_at`` (from 1). An entry is a split, with the places of its children, a leaf with its label, or the root of a
    subtree below, whose id is in ``next``.
    """
    nodes = tree.select("node_id", "depth", _place(names).alias("place"), "split", "left_id", "right_id", "label")
    links = tree.filter("feature IS NOT NULL").select(F.col("node_id").alias("up"), (F.col("depth") + 1).alias("depth"), F.explode(F.array("left_id", "right_id")).alias("node_id"))
    inside = nodes.filter(F.col("depth") % levels == 0).select("node_id", F.col("node_id").alias("_node"))
    members = [inside.withColumn("below", F.lit(False))]
    for step in range(1, levels + 1):
        kids = links.filter(F.col("depth") % levels == step % levels)
        inside = kids.join(inside.select(F.col("node_id").alias("up"), "_node"), "up").select("node_id", "_node")
        members.append(inside.withColumn("below", F.lit(step == levels)))
    entries = reduce(DataFrame.unionByName, members).join(nodes, "node_id")
    # the root of a subtree below is an entry of its own subtree as a split or a leaf, and of the one above as a link
    listed = entries.groupBy("_node").agg(F.array_sort(F.collect_list(F.struct("node_id", "below", "place", "split", "left_id", "right_id", "label"))).alias("l"))
    entry = (
        "named_struct('place', CASE WHEN NOT e.below THEN e.place END, 'split', e.split, 'left_at', array_position(l.node_id, e.left_id), "
        "'right_at', array_position(l.node_id, e.right_id), 'label', e.label, 'next', CASE WHEN e.below THEN e.node_id END)"
    )
    depths = nodes.selectExpr("node_id AS _node", "depth AS _depth")
    return listed.selectExpr("_node", "array_position(l.node_id, _node) AS _at", f"transform(l, e -> {entry}) AS _nodes").join(depths, "_node")


def _walk_by_joins(rows: DataFrame, tree: DataFrame, names: Sequence[str], boundary: str, levels: int, limit: int) -> DataFrame:
    """Scoring of (_row, _x) with a tree that is not broadcast: one join for every ``levels`` levels, in which a row
    meets a packed subtree and walks through it. Rows get a number to be salted by, so that copies part as well; only
    the number, the values and the node are carried, and rows that have reached a leaf are not joined again."""
    whole = store(rows.withColumn("_number", F.monotonically_increasing_id()), "walk")
    packed = store(packed_subtrees(tree, names, levels), "subtrees")
    deepest = packed.df.agg(F.max("_depth")).first()[0]
    now = whole.df.select("_number", "_x", F.lit(1).cast("long").alias("_node"))
    sign = ">" if boundary == "gt" else ">="
    node = "element_at(_nodes, CAST(i AS INT))"
    step = f"CASE WHEN {node}.place IS NULL THEN i WHEN get(_x, {node}.place) {sign} {node}.split THEN {node}.right_at ELSE {node}.left_at END"
    ended = f"element_at(_nodes, CAST(aggregate(sequence(1, {levels}), _at, (i, _) -> {step}) AS INT))"
    layers = []
    for depth in range(0, deepest + 1, levels):
        layer = packed.df.filter(F.col("_depth") == depth).drop("_depth")
        met = join_small(now, layer, ["_node"], "inner", ["_number"], limit=limit).withColumn("_end", F.expr(ended))
        met = met.select("_number", F.expr("CASE WHEN _end.next IS NOT NULL THEN _x END").alias("_x"), F.col("_end.next").alias("_node"), F.col("_end.label").alias("_label"))
        layers.append(store(met, "walk"))
        now = layers[-1].df.filter("_node IS NOT NULL").drop("_label")
    scored = reduce(DataFrame.unionByName, [x.df.filter("_node IS NULL").select("_number", "_label") for x in layers])
    done = store(scored, "walk")
    for used in (packed, *layers):
        used.release()
    return whole.df.select("_number", "_row").join(done.df, "_number")


def _score(
    df: DataFrame, tree: DataFrame, names: Sequence[str], value_of: Callable[[str], Column], out_col: str, boundary: str,
    case_nodes: int, walk_levels: int, limit: int,
) -> DataFrame:
    """The same checks and answers for every size of tree. A tree of up to ``limit`` bytes is a projection - one
    expression if it is small, else arrays that every task walks - and takes a stream; a larger one is joined."""
    small = tree.limit(case_nodes + 1).count() <= case_nodes
    if small or size_in_bytes(tree) <= limit:
        nodes = [r.asDict() for r in tree.collect()]
        if small:
            return df.withColumn(out_col, case_expression({n["node_id"]: n for n in nodes}, value_of, boundary))
        walk = _walker(nodes, names, boundary, tree.schema["label"].dataType)
        return df.withColumn(out_col, walk(F.array(*[value_of(n) for n in names])))
    kept = [c for c in df.columns if c != out_col]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.array(*[value_of(n) for n in names]).alias("_x"))
    scored = _walk_by_joins(rows, tree, names, boundary, walk_levels, limit)
    return scored.select(*[F.col(f"_row.`{c}`") for c in kept], F.col("_label").alias(out_col))


def predict(
    df: DataFrame,
    tree: DataFrame,
    out_col: str = "prediction",
    boundary: str = "gt",
    case_nodes: int = CASE_NODES,
    walk_levels: int = WALK_LEVELS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The columns of a wide table plus the predicted class.

    ``boundary='gt'`` sends a value equal to a split left, as scoring has always done; ``'ge'`` sends it
    right, as growing does. Null values count as 0. Features are found by the session's case rule; a missing one is
    a ValueError whatever the size of the tree.
    """
    column = _resolve(tree, df.columns, df.sparkSession.conf.get("spark.sql.caseSensitive") == "true")

    def value_of(name: str) -> Column:
        return F.coalesce(F.col(f"`{column[name]}`").cast("double"), F.lit(0.0))

    return _score(df, tree, list(column), value_of, out_col, boundary, case_nodes, walk_levels, limit)


def predict_matrix(
    matrix: Matrix,
    tree: DataFrame,
    out_col: str = "prediction",
    boundary: str = "gt",
    case_nodes: int = CASE_NODES,
    walk_levels: int = WALK_LEVELS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Score the rows of a matrix; ``x`` is dropped from the result. A sparse row without a feature has 0 there."""
    if matrix.sparse:
        names = [r[0] for r in tree.filter("feature IS NOT NULL").select("feature").distinct().orderBy("feature").collect()]
    else:
        names = list(_resolve(tree, matrix.names, True))

    def value_of(name: str) -> Column:
        return _value_at("x", F.lit(name) if matrix.sparse else F.lit(matrix.names.index(name)), matrix.sparse)

    scored = _score(matrix.rows, tree, names, value_of, out_col, boundary, case_nodes, walk_levels, limit)
    return scored.drop("x")


# --- the tree as data ------------------------------------------------------------------------------


def rules(tree: DataFrame, plan_levels: int = PLAN_LEVELS) -> DataFrame:
    """One row per leaf: the conditions on its path, its class and its row counts, with true sides.

    A node starts with the condition it hangs on, and with its parent; each join puts before it what its upmost known
    ancestor has, so paths double in length and a tree of depth 100 takes seven joins. Each is stored, as both sides of
    the next one read it; ``plan_levels`` stays for callers that set it.
    """
    deepest = tree.agg(F.max("depth")).first()[0]
    splits = tree.filter("feature IS NOT NULL").selectExpr("node_id AS up", "feature", "split", "right_id")
    step = "concat(feature, CASE WHEN node_id = right_id THEN ' >= ' ELSE ' < ' END, CAST(split AS STRING)) AS rule"
    met = join_small(tree.selectExpr("node_id", "parent_id AS up", "feature IS NULL AS leaf"), splits, ["up"], "left", ["node_id"])
    paths = store(met.selectExpr("node_id", "up", "leaf", step), "rules")
    reach, now = 1, paths.df
    while reach < deepest:
        # an inner node is an ancestor; a path that has reached the root is joined no more
        above = now.filter("NOT leaf").selectExpr("node_id AS up", "up AS _up", "rule AS _rule")
        met = join_small(now.filter("up IS NOT NULL"), above, ["up"], "inner", ["node_id"])
        longer = met.selectExpr("node_id", "_up AS up", "leaf", "concat_ws(' AND ', _rule, rule) AS rule")
        now = longer.unionByName(now.filter("up IS NULL"))
        reach *= 2
        fresh = store(now, "rules")
        paths.release()
        paths = fresh
        now = paths.df
    leaves = now.filter("leaf").selectExpr("node_id", "coalesce(rule, '') AS rule")
    return tree.filter("feature IS NULL").join(leaves, "node_id").select("node_id", "depth", "rule", "label", "n0", "n1")


def save(tree: DataFrame, path: str) -> None:
    tree.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
