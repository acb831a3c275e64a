"""Terms, TF-IDF, shapes and row numbers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.base import FEATURES, LINE_ID, RETURNED_SQL, documents, english_doc, lines, query, table
from catalog.corpus import KEPT_SQL, STEMMED_SQL
from textree.ml import TextCleaner, TokenStemmer
from textree.operators import features as ft
from textree.plans.tfidf import document_tokens, tfidf_table
from textree.storage import new_path, store

SIZE = 500
WIDE = SIZE
COUNTS_SQL = f"{KEPT_SQL}, counts AS (SELECT doc_id, token AS term, count(*) AS tf FROM kept GROUP BY ALL)"


STEM_COUNTS_SQL = f"{STEMMED_SQL}, counts AS (SELECT doc_id, stem AS term, count(*) AS tf FROM kept JOIN stems USING (token) GROUP BY ALL)"


def vocab_sql(size: int, counts: str = COUNTS_SQL) -> str:
    return f"""{counts}, vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cnt,
      CAST(row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS INTEGER) AS term_idx
      FROM counts GROUP BY term ORDER BY cnt DESC, term LIMIT {size})"""


def tfidf_sql(size: int, counts: str = COUNTS_SQL) -> str:
    return f"""{vocab_sql(size, counts)},
    freq AS (SELECT term, count(*) AS df FROM counts JOIN vocab USING (term) GROUP BY term),
    total AS (SELECT count(*) AS n FROM documents WHERE trim(text) <> ''),
    scores AS (SELECT doc_id, term, tf, tf * ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) AS tfidf
      FROM counts JOIN freq USING (term), total)"""


def counts(spark, sf_dir):
    return ft.term_counts(document_tokens(documents(spark, sf_dir), "doc_id", "text"), "doc_id")


@query("term_counts", f"WITH {COUNTS_SQL} SELECT * FROM counts")
def term_counts(spark, sf_dir):
    return counts(spark, sf_dir)


@query("vocabulary_topk", f"WITH {vocab_sql(SIZE)} SELECT term, cnt, term_idx FROM vocab")
def vocabulary_topk(spark, sf_dir):
    return ft.vocabulary(counts(spark, sf_dir), SIZE)


@query("document_frequency", f"WITH {COUNTS_SQL} SELECT term, count(*) AS df FROM counts GROUP BY term")
def document_frequency(spark, sf_dir):
    return ft.document_frequency(counts(spark, sf_dir))


@query("tfidf", f"WITH {tfidf_sql(SIZE)} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM scores")
def tfidf(spark, sf_dir):
    made = tfidf_table(documents(spark, sf_dir), "doc_id", "text", SIZE, stemming=False)
    return made.values.withColumn("tfidf", F.round("tfidf", 6))


@query("tfidf_stemmed", f"WITH {tfidf_sql(SIZE, STEM_COUNTS_SQL)} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM scores")
def tfidf_stemmed(spark, sf_dir):
    made = tfidf_table(documents(spark, sf_dir), "doc_id", "text", SIZE)
    return made.values.withColumn("tfidf", F.round("tfidf", 6))


WIDE_COLUMNS = ", ".join(
    f"coalesce(round(max(CASE WHEN term_idx = {i} THEN tfidf END), 5), 0.0) AS term_{i}" for i in range(WIDE)
)


@query(
    "tfidf_wide",
    f"""WITH {tfidf_sql(WIDE)} SELECT d.doc_id, {WIDE_COLUMNS},
    any_value(CAST(CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS INTEGER)) AS ground_truth
    FROM documents d LEFT JOIN (scores JOIN vocab USING (term)) s ON d.doc_id = s.doc_id GROUP BY d.doc_id""",
)
def tfidf_wide(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("ground_truth", english_doc())
    made = tfidf_table(docs, "doc_id", "text", WIDE, stemming=False)
    places = made.vocabulary.select("term", F.concat(F.lit("term_"), "term_idx").alias("name"))
    # the vocabulary has WIDE rows, whatever the size of the data
    named = made.values.join(F.broadcast(places), "term").select("doc_id", F.col("name").alias("term"), "tfidf")
    return ft.to_wide(named, docs, [f"term_{i}" for i in range(WIDE)], "doc_id")


SHARE = 0.05


@query(
    "ml_pipeline_scores",
    f"""WITH {STEM_COUNTS_SQL}, freq AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    total AS (SELECT count(*) AS n FROM documents WHERE trim(text) <> '')
    SELECT doc_id, term, round(tf * ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE)), 6) AS tfidf
    FROM counts JOIN freq USING (term), total WHERE df >= ceil({SHARE}::DOUBLE * n)""",
)
def ml_pipeline_scores(spark, sf_dir):
    """The text stages as one ``pyspark.ml`` pipeline: fitted, saved, loaded and applied by the loaded model.

    The vocabulary is every stem in a twentieth of the documents, so no tie decides what is in it.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text")
    stages = [
        TextCleaner(inputCol="text", outputCol="cleaned"),
        Tokenizer(inputCol="cleaned", outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="kept"),
        TokenStemmer(inputCol="kept", outputCol="stems"),
        CountVectorizer(inputCol="stems", outputCol="raw", minDF=SHARE),
        IDF(inputCol="raw", outputCol="features"),
    ]
    path = new_path(spark, "ml-pipeline")
    # the estimators read the stems, which are made once; on a frame that is not persisted the first would hold all words as objects
    stems = store(PipelineModel(stages[:4]).transform(docs).select("stems"), "stems")
    held = stems.df.persist(StorageLevel.DISK_ONLY)
    fitted = Pipeline(stages=stages[4:]).fit(held)
    held.unpersist()
    stems.release()
    PipelineModel(stages[:4] + fitted.stages).save(path)
    model = PipelineModel.load(path)
    words = F.array(*[F.lit(w) for w in model.stages[4].vocabulary])
    # both vectors become arrays once a document, not once a place of the vocabulary
    places = F.arrays_zip(words.alias("term"), vector_to_array("raw").alias("raw"), vector_to_array("features").alias("tfidf"))
    met = model.transform(docs).select("doc_id", F.inline(F.filter(places, lambda p: p["raw"] > 0)))
    return met.filter("term <> ''").select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query(
    "embedding_long",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS term_idx, CAST(embedding[i] AS DOUBLE) AS value
    FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""",
)
def embedding_long(spark, sf_dir):
    return ft.array_rows(table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding")


@query(
    "vector_slice",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[3] AS DOUBLE) AS third FROM embeddings""",
)
def vector_slice(spark, sf_dir):
    cut = ft.slice_array(table(spark, sf_dir, "embeddings"), "embedding", [0, 2], "sliced")
    ends = F.col("sliced").cast("array<double>")
    return cut.select("vec_id", ends[0].alias("first"), ends[1].alias("third"))


@query(
    "vector_expand",
    "SELECT vec_id, "
    + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 5) AS v{i}" for i in range(64))
    + ", CAST(CASE WHEN label < 5 THEN 1 ELSE 0 END AS INTEGER) AS ground_truth FROM embeddings",
)
def vector_expand(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("ground_truth", F.when(F.col("label") < 5, 1).otherwise(0))
    return ft.expand_array(rows, "embedding", [f"v{i}" for i in range(64)], keep=["vec_id"])


@query(
    "melt_lineitem",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, {RETURNED_SQL} AS y, '{c}' AS feature, {c} AS value FROM lineitem"
        for c in FEATURES
    ),
)
def melt_lineitem(spark, sf_dir):
    return ft.melt(lines(spark, sf_dir), [*LINE_ID, "y"], FEATURES)


@query("take_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate FROM lineitem")
def take_columns(spark, sf_dir):
    return ft.take_columns(table(spark, sf_dir, "lineitem"), 3)


@query(
    "limit_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000""",
)
def limit_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ft.limit_rows(rows, 10000, ["o_orderkey"])


@query(
    "limit_rows_ranged",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey DESC, l_linenumber LIMIT 5000""",
)
def limit_rows_ranged(spark, sf_dir):
    """The same where no task may hold all the rows asked for."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ft.limit_rows(rows, 5000, [F.desc("l_orderkey"), "l_linenumber"], one_task=1000)


@query(
    "row_index",
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS "Index", o_orderkey, o_totalprice
    FROM orders""",
)
def row_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ft.add_row_id(rows, [F.desc("o_totalprice"), "o_orderkey"], "Index")


@query("sort_rows", "SELECT event_id, user_id, value FROM events ORDER BY value, event_id")
def sort_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "value").orderBy("value", "event_id")
