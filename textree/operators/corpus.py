"""From differently shaped labelled sources to one (title, ground_truth) corpus."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.functions.text import is_positive, not_blank

TITLE = "title"
LABEL = "ground_truth"
# Column names that trigger a row filter, and the language kept.
LABEL_COLUMNS = ("label", "Label", "Ground Label")
LANGUAGE_COLUMN = "language"
LANGUAGE = "english"


@dataclass(frozen=True)
class Source:
    """One entry of the registry: the rows, the column holding the text, and the label they get."""

    name: str
    df: DataFrame
    text_col: str
    label: int = 1


def filter_rows(df: DataFrame) -> DataFrame:
    """Keep positive rows of a labelled set and English rows of a set with a language column.

    Filters are chosen by exact column name; a label column is renamed to ``ground_truth``.
    """
    for field in df.schema:
        if field.name in LABEL_COLUMNS:
            df = df.filter(is_positive(field.name, field.dataType)).withColumnRenamed(field.name, LABEL)
        elif field.name == LANGUAGE_COLUMN:
            df = df.filter(F.col(field.name) == LANGUAGE)
    return df


def sentences(df: DataFrame, text_col: str = "text", label: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-blank sentence of ``text_col`` (cut at every full stop), all with one label."""
    parts = df.select(*keep, F.explode(F.split(text_col, r"\.")).alias(TITLE))
    return (
        parts.withColumn(TITLE, F.trim(TITLE)).filter(not_blank(F.col(TITLE))).withColumn(LABEL, F.lit(label))
    )


def harmonize(
    df: DataFrame, text_col: str, label: int = 1, sentence_label: int = 1, title: str = TITLE
) -> DataFrame:
    """One source as (title, ground_truth): distinct titles, plus the sentences of a ``text`` column.

    Sentences are taken even where ``text`` is itself the title column, and are not deduplicated here.
    """
    kept = filter_rows(df)
    titles = (
        kept.select(F.col(f"`{text_col}`").alias(title))
        .dropna(subset=[title])
        .dropDuplicates([title])
        .withColumn(LABEL, F.lit(label).cast("int"))
    )
    if "text" not in kept.columns:
        return titles
    found = sentences(kept, "text", sentence_label).withColumnRenamed(TITLE, title)
    return found.unionByName(titles)


def titles_and_sentences(df: DataFrame, text_col: str, label: int = 1, sentence_label: int = 1, title: str = TITLE) -> DataFrame:
    """The rows of ``harmonize``, with repeats, from one pass over the source: each row becomes its title and, where
    there is a ``text`` column, its sentences. A null title and blank sentences give no row."""
    kept = filter_rows(df)
    entry = F.struct(F.col(f"`{text_col}`").alias(title), F.lit(label).cast("int").alias(LABEL))
    entries = F.filter(F.array(entry), lambda e: e[title].isNotNull())
    if "text" in kept.columns:
        trimmed = F.transform(F.split("text", r"\."), lambda s: F.trim(s))
        found = F.transform(F.filter(trimmed, not_blank), lambda s: F.struct(s.alias(title), F.lit(sentence_label).cast("int").alias(LABEL)))
        entries = F.concat(entries, F.coalesce(found, F.array().cast(f"array<struct<{title}:string,{LABEL}:int>>")))
    return kept.select(F.inline(entries))


def build_corpus(sources: Sequence[Source], sentence_label: int = 1) -> DataFrame:
    """Union of all harmonized sources without repeated (title, ground_truth) rows: one scan a source, one dedup."""
    tables = [titles_and_sentences(s.df, s.text_col, s.label, sentence_label) for s in sources]
    return dedup(reduce(DataFrame.unionByName, tables))


def dedup(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows. Copies are merged within each task before anything is shuffled.

    With ``columns`` one whole row per key is kept: the smallest by the remaining columns, in order.
    """
    rest = [c for c in df.columns if columns and c not in columns]
    if not rest:
        return df.dropDuplicates()
    first = F.min(F.struct(*rest)).alias("_row")
    kept = df.groupBy(*columns).agg(first)
    return kept.select(*[f"_row.{c}" if c in rest else c for c in df.columns])


def label_violations(df: DataFrame, label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Labels outside {0, 1} with their number of rows, by source if asked; empty means sound."""
    return df.filter(~F.col(label).isin(0, 1)).groupBy(*by, label).agg(F.count("*").alias("n_rows"))

