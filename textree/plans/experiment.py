"""One run: balanced train set, tree, scores on the rest, report."""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from textree.operators import evaluate as ev
from textree.operators import sample as sm
from textree.operators.features import dense_matrix
from textree.plans import tree as tr


class Run(NamedTuple):
    tree: DataFrame
    scored: DataFrame
    report: DataFrame


def train_and_score(
    df: DataFrame,
    feature_cols: Sequence[str],
    id_cols: Sequence[str],
    label: str = "ground_truth",
    share: float = sm.SHARE,
    salt: str = "42",
    boundary: str = "gt",
    old_names: bool = True,
    **tree_options,
) -> Run:
    """Split a wide table, grow a tree on the balanced part, score the rest. ``df`` is read several times:
    store it first if it is costly."""
    train, test = sm.train_test(df, list(id_cols), label, share, salt)
    started = time.perf_counter()
    tree = tr.fit(dense_matrix(train, feature_cols, label), **tree_options)
    fit_ms = round((time.perf_counter() - started) * 1000)
    root = tree.filter("node_id = 1").first()
    scored = tr.predict(test, tree, boundary=boundary)
    scores = ev.metrics(ev.confusion(scored, label))
    return Run(tree, scored, ev.report(scores, {0: root["n0"], 1: root["n1"]}, fit_ms, old_names))
