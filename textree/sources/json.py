"""JSON-lines scan, report sink and the scan of past reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textree.operators.joins import join_small, size_in_bytes
from textree.storage import store


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    label_col: str = "label",
    label: int = 1,
) -> DataFrame:
    """Complete, distinct rows of a JSON-lines set, all given one label."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path).dropna().dropDuplicates().withColumn(label_col, F.lit(label))


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


# How the last segments of a run's path name its cluster shape and its data set. Partition folders
# (key=value) hold the same names.
RUN_PATH = r"(?:^|[/=])(?:instances(\d+)cores(\d+)|([^/]*sequential))/(?:[^/=]*=)?result(\d+)(?:\.json)?(?:/[^/]*)?$"
# Numbers are read as text first because JSON writers may quote long integers.
RUN_FIELDS = "`Accuracy` double, `Precision` double, `Execution Time` string, `Job Time` string, `_corrupt_record` string"


#: No longer looked at: how a file's records are laid out is told by its lines, whatever its size.
REPORT_BYTES = 1024 * 1024
# One line in so many is parsed to find the files that hold an object a line; all lines of the files it leaves open are.
PROBE = 100


def _run_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, fits, instances, cores and n_columns of every file: what a path says is taken apart once, not once a record."""

    def number(group: int) -> Column:
        return F.try_to_number(F.regexp_extract("path", RUN_PATH, group), F.lit("9999999999")).cast("int")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    sequential = F.regexp_extract("path", RUN_PATH, 3) != ""
    return files.select(F.col("_metadata.file_path").alias("path")).select(
        "path",
        F.col("path").rlike(RUN_PATH).alias("fits"),
        F.when(sequential, F.lit(0)).otherwise(number(1)).alias("instances"),
        F.when(sequential, F.lit(0)).otherwise(number(2)).alias("cores"),
        number(4).alias("n_columns"),
    )


def _an_object(line: str) -> Column:
    return F.trim(line).startswith("{") & F.try_parse_json(line).isNotNull()


def _run_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per record, with what its path says: a file's lines if one of them is an object by itself, the whole
    file otherwise, whatever its size."""
    files = store(_run_files(spark, path), "run-files").df
    files_bytes = size_in_bytes(files)
    read = spark.read.option("recursiveFileLookup", True).text(path)
    where = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block")]
    lines = read.select(*where, F.monotonically_increasing_id().alias("_line"), "value")

    def of_files(found: DataFrame, some: DataFrame, how: str = "inner") -> DataFrame:
        return join_small(found, some, ["path"], how, ["path", "_line"], small_bytes=files_bytes)

    def in_lines(found: DataFrame) -> DataFrame:
        return store(found.filter(_an_object("value")).select("path").distinct(), "run-files").df

    some = in_lines(lines.filter(f"_line % {PROBE} = 0"))
    unsure = files.join(some, "path", "left_anti")
    more = in_lines(of_files(lines, unsure.select("path"), "left_semi"))
    by_line = store(files.join(some.unionByName(more), "path", "left_semi"), "run-files").df
    whole = store(files.join(by_line.select("path"), "path", "left_anti"), "run-files").df
    found = of_files(lines, by_line).select(*files.columns, "value")
    if not whole.isEmpty():
        held = of_files(lines, whole.select("path"), "left_semi").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("l"))
        texts = held.select("path", F.array_join("l.value", "\n").alias("value"))
        found = found.unionByName(join_small(texts, whole, ["path"], small_bytes=files_bytes).select(*files.columns, "value"))
    found = found.filter(F.col("value").rlike(r"\S"))
    # as the rows of a generator a record is parsed once, however often its fields are named
    parsed = found.select(*files.columns, "value", F.inline(F.array(F.from_json("value", RUN_FIELDS))))
    # a field of another type is null in its record and makes no broken one
    broken = F.from_json("value", "`_corrupt_record` string")["_corrupt_record"]
    return parsed.withColumn("_corrupt_record", F.when(F.col("_corrupt_record").isNotNull(), broken)).drop("value")


def read_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per stored report, whatever its layout, with the key its path holds; sequential runs get (0, 0, n).

    The key stands in the folder that holds the result, whatever folders lie above. What cannot be read is in
    :func:`unread_runs`.
    """
    return _run_records(spark, path).filter(F.col("fits") & F.col("_corrupt_record").isNull()).select(
        "instances",
        "cores",
        "n_columns",
        F.col("Job Time").cast("double").alias("job_ms"),
        F.col("Execution Time").cast("double").alias("fit_ms"),
        F.col("Accuracy").alias("area_under_roc"),
        F.col("Precision").alias("area_under_pr"),
    )


def unread_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, reason and number of the records that :func:`read_runs` does not give."""
    reason = F.when(~F.col("fits"), "path").when(F.col("_corrupt_record").isNotNull(), "record")
    records = _run_records(spark, path).withColumn("reason", reason).filter("reason IS NOT NULL")
    return records.groupBy("path", "reason").agg(F.count("*").alias("n_records"))
