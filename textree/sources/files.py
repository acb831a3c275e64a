"""File listings, and the write-and-read-back that cuts a plan between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.storage import store


def file_manifest(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, length and modification time of every file below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def file_present(manifest: DataFrame, suffix: str) -> bool:
    return not manifest.filter(F.col("path").endswith(suffix)).isEmpty()


def newest(manifest: DataFrame) -> DataFrame:
    """The last file by modification time (by path among equals) and its size."""
    last = F.max(F.struct("modificationTime", "path", "length")).alias("f")
    return manifest.agg(last).select("f.path", "f.length", "f.modificationTime")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write to the shared folder and read back: later steps start from the stored table."""
    return store(df, name).df
