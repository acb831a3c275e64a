"""Comparison of runs over cluster sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def workers(runs: DataFrame) -> DataFrame:
    """Machines used: three cores each, or two where instances have two cores; a sequential run has one."""
    cores = F.col("cores")
    per_machine = F.when(cores == 2, F.lit(2)).otherwise(F.lit(3))
    used = F.when(cores == 0, F.lit(1)).otherwise(F.ceil(F.col("instances") * cores / per_machine))
    return runs.withColumn("workers", used.cast("int"))


def scaling(runs: DataFrame, widths: Sequence[int] | None = None) -> DataFrame:
    """Job minutes per data set width (all, or the given ones), cores per instance and number of workers."""
    minutes = F.round(F.avg("job_ms") / 60000, 2)
    chosen = runs if widths is None else runs.filter(F.col("n_columns").isin(*widths))
    return (
        workers(chosen)
        .groupBy("n_columns", "cores", "workers")
        .agg(F.count("*").alias("n_runs"), minutes.alias("job_minutes"))
    )


def scaling_by_width(runs: DataFrame, cores: int = 3, skip: Sequence[int] = ()) -> DataFrame:
    """One line per width, but for those in ``skip``: minutes against workers for a number of cores per instance."""
    chosen = runs.filter((F.col("cores") == cores) & ~F.col("n_columns").isin(*skip))
    minutes = F.round(F.avg("job_ms") / 60000, 2)
    return workers(chosen).groupBy("n_columns", "workers").agg(minutes.alias("job_minutes"))


def scaling_grid(scaled: DataFrame) -> DataFrame:
    """The same as a grid with one column per worker count that occurs; no run is left out."""
    counts = sorted(r[0] for r in scaled.select("workers").distinct().collect())
    return scaled.groupBy("n_columns", "cores").pivot("workers", counts).agg(F.first("job_minutes"))


# Data and workers grow together in this series of (instances, cores, n_columns).
GROWTH = ((0, 0, 25), (1, 3, 50), (2, 3, 100), (4, 3, 250))


def growth(runs: DataFrame, series: Sequence[tuple[int, int, int]] = GROWTH) -> DataFrame:
    """Minutes along a series in which the sequential run counts as zero workers."""
    key = F.struct("instances", "cores", "n_columns")
    wanted = [F.struct(F.lit(i), F.lit(c), F.lit(n)) for i, c, n in series]
    chosen = workers(runs.filter(key.isin(*wanted)))
    machines = F.when(F.col("cores") == 0, F.lit(0)).otherwise(F.col("workers"))
    minutes = F.round(F.avg("job_ms") / 60000, 2)
    return (
        chosen.withColumn("workers", machines).groupBy("workers", "n_columns").agg(minutes.alias("job_minutes"))
    )
