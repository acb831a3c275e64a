"""CSV scans and the CSV sink: header, quotes doubled inside quotes, newlines allowed in fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LABEL = "ground_truth"
INDEX = "Index"


def _options(multi_line: bool) -> dict[str, object]:
    return {
        "header": True,
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        "multiLine": multi_line,
    }


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = True,
    strict: bool = False,
) -> DataFrame:
    """All columns as strings unless a schema is given.

    ``strict`` makes a field that does not fit its type, and a file whose header has other names or another order, an
    error in place of a NULL or of values under wrong names.

    A multi-line file cannot be split, so it is one task: keep such data in many files, or pass
    ``multi_line=False`` where no field holds a newline and let Spark split the files.
    """
    reader = spark.read.options(**_options(multi_line))
    if strict:
        reader = reader.options(mode="FAILFAST", enforceSchema=False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def feature_schema(columns: list[str], long_index: bool = False) -> T.StructType:
    """Types by name: the label and the index are integers (the index 64-bit if asked), every other column is a double."""
    whole = {LABEL: T.IntegerType(), INDEX: T.LongType() if long_index else T.IntegerType()}
    return T.StructType([T.StructField(c, whole.get(c, T.DoubleType()), True) for c in columns])


def read_feature_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, strict: bool = False, long_index: bool = False
) -> DataFrame:
    """A wide feature table: names from the header, types from the names, one typed scan.

    The numbers hold no newlines, so the files are split by default.
    """
    header = read_csv(spark, path, multi_line=multi_line).columns
    return read_csv(spark, path, feature_schema(header, long_index), multi_line, strict)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path``. Blanks at the ends of fields are kept; an empty text reads back as NULL.

    ``single_file`` is for small tables.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(
        **_options(True), ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
