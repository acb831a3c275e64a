"""Term tables, TF-IDF, long and wide feature tables, row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textree.operators.joins import BROADCAST_BYTES, join_small
from textree.storage import store

LABEL = "ground_truth"
RESERVED = ("ground_truth", "index")


# --- terms -----------------------------------------------------------------------------------------


def term_counts(tokens: DataFrame, id_col: str, token_col: str = "token") -> DataFrame:
    """(id, term, tf): counts are combined inside each task before the shuffle."""
    return tokens.groupBy(id_col, F.col(token_col).alias("term")).agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, size: int = 500, count_col: str = "tf") -> DataFrame:
    """The ``size`` terms with most occurrences, as (term, cnt, term_idx); ties go to the smaller term."""
    totals = counts.groupBy("term").agg(F.sum(count_col).alias("cnt"))
    top = totals.orderBy(F.desc("cnt"), "term").limit(size)
    place = F.row_number().over(Window.orderBy(F.desc("cnt"), "term")) - 1
    return top.withColumn("term_idx", place)


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of documents per term of a table with one row per (id, term)."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def tfidf(
    counts: DataFrame, df_table: DataFrame, n_docs: int, id_col: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """(id, term, tf, tfidf) for the terms of ``df_table``, with ``idf = ln((n + 1) / (df + 1))``."""
    idf = df_table.select("term", F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    return join_small(counts, idf, ["term"], salt_on=[id_col], limit=limit).select(
        id_col, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


# --- shapes ----------------------------------------------------------------------------------------


def melt(df: DataFrame, id_cols: Sequence[str], feature_cols: Sequence[str]) -> DataFrame:
    """One row per (row, feature) of a wide numeric table."""
    wide = df.select(*id_cols, *[F.col(f"`{c}`").cast("double").alias(c) for c in feature_cols])
    return wide.unpivot(list(id_cols), [f"`{c}`" for c in feature_cols], "feature", "value")


def check_column_names(terms: Sequence[str]) -> None:
    """Terms that would clash as columns: reserved names, or names equal but for case."""
    seen: set[str] = set()
    for term in terms:
        name = term.lower()
        if name in RESERVED or name in seen:
            raise ValueError(f"term {term!r} cannot be a column of the wide table")
        seen.add(name)


def to_wide(
    values: DataFrame,
    rows: DataFrame,
    terms: Sequence[str],
    id_col: str,
    label_col: str = LABEL,
    value_col: str = "tfidf",
    digits: int | None = 5,
) -> DataFrame:
    """One row per row of ``rows``: id, one column per term (0.0 where absent), the label last.

    What travels and is held is an entry per value; the columns are spread out only as the result is written.
    """
    check_column_names(terms)
    places = values.sparkSession.createDataFrame(list(enumerate(terms)), "_place int, term string")
    # one row per column of the result
    placed = values.select(id_col, "term", value_col).join(F.broadcast(places), "term")
    cells = placed.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_place", F.col(value_col).alias("_value")))).alias("_cells"))
    # one entry a place, as the columns are
    single = F.filter("_cells", lambda cell, i: (i == 0) | (cell["_place"] != F.get("_cells", i - 1)["_place"]))
    cells = cells.select(id_col, F.map_from_entries(single).alias("_cells"))
    joined = rows.select(id_col, label_col).join(cells, id_col, "left")

    def filled(place: int, term: str) -> Column:
        value = F.coalesce(F.col("_cells")[F.lit(place)], F.lit(0.0))
        return (value if digits is None else F.round(value, digits)).alias(term)

    return joined.select(id_col, *[filled(i, t) for i, t in enumerate(terms)], label_col)


def expand_array(
    df: DataFrame,
    array_col: str,
    names: Sequence[str],
    label_col: str = LABEL,
    keep: Sequence[str] = (),
    digits: int | None = 5,
) -> DataFrame:
    """One double column per array place, rounded, with the label last; other columns are dropped."""
    check_column_names(names)
    values = F.col(array_col).cast("array<double>")
    if digits is not None:
        values = F.transform(values, lambda v: F.round(v, digits))
    ready = df.select(*keep, values.alias("_values"), label_col)
    return ready.select(*keep, *[F.col("_values")[i].alias(n) for i, n in enumerate(names)], label_col)


def array_rows(df: DataFrame, id_cols: Sequence[str], array_col: str) -> DataFrame:
    """Long form of an array column: (ids, term_idx, value)."""
    values = F.col(array_col).cast("array<double>")
    return df.select(*id_cols, F.posexplode(values).alias("term_idx", "value"))


def slice_array(df: DataFrame, array_col: str, indices: Sequence[int], out_col: str) -> DataFrame:
    """The chosen places of an array, in the order given."""
    return df.withColumn(out_col, F.array(*[F.col(array_col)[i] for i in indices]))


def take_columns(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` columns and the last one."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[:n] + df.columns[-1:]])


ONE_TASK_ROWS = 100_000


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str], one_task: int = ONE_TASK_ROWS) -> DataFrame:
    """A repeatable ``limit``: the first ``n`` rows by a total order.

    Up to ``one_task`` rows are each task's best, merged in one. Beyond that rows are range-sorted, and counts of the
    ranges tell which lie before the cut: no task holds more than its range. Columns keep their order.
    """
    if n <= one_task:
        return df.orderBy(*order_by).limit(n)
    return add_row_id(df, order_by, "_number").filter(F.col("_number") <= n).select(*[f"`{c}`" for c in df.columns])


# --- row numbers -----------------------------------------------------------------------------------


def add_row_id(
    df: DataFrame, order_by: Sequence[str | Column] = (), name: str = "row_id", start: int = 1
) -> DataFrame:
    """Consecutive row numbers without bringing all rows to one task; the number comes first.

    Rows are range-sorted by ``order_by`` (or left as they are). A row's number is its place in its
    partition plus the rows of the partitions before; only one count per partition is summed in one task.
    """
    columns = df.columns
    placed = (df.orderBy(*order_by) if order_by else df).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    placed = store(placed, "numbered").df
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    number = (F.col("_offset") + F.col("_place") + F.lit(start)).cast("long").alias(name)
    # one row per partition of the sort: always small
    return placed.join(F.broadcast(offsets), "_part").select(number, *[f"`{c}`" for c in columns])


# --- matrices for the tree -------------------------------------------------------------------------


@dataclass(frozen=True)
class Matrix:
    """Rows ``(y INT, x, ...)`` for growing and scoring a tree.

    Dense: ``x`` is an array of doubles and ``names`` are the sorted feature names of its places.
    Sparse: ``names`` is None and ``x`` maps the names of non-zero features to their values.
    """

    rows: DataFrame
    names: tuple[str, ...] | None

    @property
    def sparse(self) -> bool:
        return self.names is None


def dense_matrix(
    df: DataFrame, feature_cols: Sequence[str], label: str | Column | None = LABEL, keep: Sequence[str] = ()
) -> Matrix:
    """NULL features count as 0.0; rows with a NULL label are dropped."""
    names = tuple(sorted(feature_cols))
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]
    columns = [F.array(*values).alias("x"), *keep]
    if label is None:
        return Matrix(df.select(*columns), names)
    y = (F.col(label) if isinstance(label, str) else label).cast("int").alias("y")
    return Matrix(df.select(y, *columns).dropna(subset=["y"]), names)


def sparse_matrix(
    values: DataFrame,
    labels: DataFrame,
    id_col: str,
    value_col: str = "tfidf",
    feature_col: str = "term",
    digits: int | None = 5,
) -> Matrix:
    """From (id, feature, value) and (id, y): one shuffle brings each row's non-zero values together.

    A row holds at most one entry per feature, as a row of the wide table would. NULL counts as 0.0, and
    rows of ``labels`` without values get an empty map. Values are rounded to ``digits`` places first, as in the
    wide table; what rounds to 0 is not stored.
    """
    value = F.col(value_col).cast("double")
    value = value if digits is None else F.round(value, digits)
    cell = F.struct(F.col(feature_col), value.alias(value_col))
    maps = (
        values.filter(value != 0.0)
        .groupBy(id_col)
        .agg(F.map_from_entries(F.collect_list(cell)).alias("x"))
    )
    empty = F.create_map().cast(T.MapType(T.StringType(), T.DoubleType(), True))
    rows = (
        labels.select(id_col, F.col("y").cast("int").alias("y"))
        .dropna(subset=["y"])
        .join(maps, id_col, "left")
        .select("y", F.coalesce("x", empty).alias("x"), id_col)
    )
    return Matrix(rows, None)
