"""From raw documents to packed training bins, in five stages.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; all but the last return the columns of
documents. Toxic documents go; repeated runs of lines are cut out, and with them documents that consist of
nothing else; of each group of near copies one row, with the smallest doc_id, stays; secrets are overwritten; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textree.llm import jaccard_join, line_chunks, secret_scan, toxicity
from textree.llm.queries import packed, table
from textree.operators.features import add_row_id
from textree.storage import store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR = jaccard_join.Rule(words=5, percent=80)
#: The model of the first stage and the bins of the last are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters as the text now has them."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that a model of the labelled rows (without the held-out fifth) scores at 0.5 or more go."""
    model = toxicity.fit_split(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of two or more lines go whole; a document of which nothing is left goes too, one that was empty stays."""
    cut = line_chunks.dedup_line_runs(docs, keep=("lang", "source"))
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    return _documents(cut.where(F.coalesce(~emptied, F.lit(True))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: of the texts that word shingles link, the one whose doc_id is smallest.

    Rows decide, not ids: a null id comes last, rows that share an id but not the text are told apart, and of rows that
    share both one stays (the smallest by the other columns). Rows whose text has no words all
    stay. An empty table gives an empty table; other columns go.
    """
    docs = docs.select(*COLUMNS)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(worded).withColumn("_text", F.unhex(F.md5("text")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id")).alias("first")
    texts = rows.groupBy("_text").agg(first).select("_text", "first.late", F.col("first.doc_id").alias("_first"))
    numbered = store(add_row_id(texts, ["late", "_first", "_text"], "_number").drop("late"), "near-numbers").df
    # one row of each text is compared, under a number of its own
    chosen = secret_scan.join_measured(rows, numbered, "_text").where(F.col("doc_id").eqNullSafe(F.col("_first"))).drop("_text", "_first")
    chosen = store(chosen, "near-rows").df
    linked = jaccard_join.link_documents(chosen, NEAR, "_number")
    stays = store(linked.where("component_id = doc_id").select(F.col("doc_id").alias("_number")).distinct(), "near-stays").df
    kept = secret_scan.join_measured(chosen, stays, "_number", "left_semi")
    repeated = store(chosen.groupBy("_number").count().where("count > 1").select("_number"), "near-repeated").df
    single = secret_scan.join_measured(kept, repeated, "_number", "left_anti").select(*COLUMNS)
    several = secret_scan.join_measured(kept, repeated, "_number", "left_semi")
    one = several.groupBy("_number").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return single.unionByName(one).unionByName(docs.where(~worded))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is overwritten in place; no document goes."""
    ledger = secret_scan.Ledger(spark)
    ledger.update(docs)
    return _documents(ledger.redact(docs))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, n_tokens, shard, bin, bin_start, source, cluster."""
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
