"""Confusion counts, closed-form metrics and the report row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")

    def cell(actual: int, said: int) -> Column:
        return F.count(F.when((y == actual) & (p == said), 1))

    return df.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"), cell(1, 0).alias("fn")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def metrics(counts: DataFrame) -> DataFrame:
    """Areas under the curves of a hard 0/1 prediction, and the usual ratios of the positive class."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    prevalence = _ratio(tp + fn, tp + fp + tn + fn)
    both = (tp + fp > 0) & (tn + fn > 0)
    pr = recall * precision + (1 - recall) * (precision + prevalence) / 2
    return counts.select(
        "*",
        ((recall + _ratio(tn, tn + fp)) / 2).alias("area_under_roc"),
        F.when(both, pr).otherwise(prevalence).alias("area_under_pr"),
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def report(scores: DataFrame, train_counts: dict[int, int], fit_ms: int, old_names: bool = True) -> DataFrame:
    """The run as one row. ``old_names`` keeps the field names that stored reports have always had."""
    if not old_names:
        return scores.withColumns(
            {"fit_ms": F.lit(fit_ms), "train_n0": F.lit(train_counts[0]), "train_n1": F.lit(train_counts[1])}
        )
    train = F.struct(
        F.lit(float(train_counts[0])).alias("num false"), F.lit(float(train_counts[1])).alias("num true")
    )
    return scores.select(
        F.col("area_under_roc").alias("Accuracy"),
        F.col("area_under_pr").alias("Precision"),
        F.lit(fit_ms).cast("long").alias("Execution Time"),
        train.alias("Train Set"),
        (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("Test Set"),
    )
