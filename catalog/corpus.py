"""Harmonizing, cleaning, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import chain_sql, documents, last_sql, query, table
from catalog.stems import STEMS_SQL
from textree.functions.stopwords import ENGLISH
from textree.operators import corpus as cp
from textree.operators import features as ft
from textree.operators import text as tx
from textree.plans.tfidf import document_tokens

LABEL_CASE = """CASE WHEN toxic = 1 AND quality = 1 THEN 'fake' WHEN toxic = 1 THEN 'FAKE'
  WHEN quality = 1 THEN ' 1.0 ' ELSE 'Fake' END"""
LANGUAGE_CASE = "CASE WHEN lang = 'en' THEN 'english' ELSE lang END"
POSITIVE = r"(label IN ('fake', 'FAKE') OR regexp_matches(label, '^\s*[+]?0*1([.][0-9]*)?\s*$'))"


def labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.expr(LABEL_CASE).alias("label"))
    docs = documents(spark, sf_dir).select("doc_id", "text", F.expr(LANGUAGE_CASE).alias("language"))
    return docs.join(labels, "doc_id")


LABELLED_SQL = f"""labelled AS (SELECT doc_id, text, {LANGUAGE_CASE} AS language, label FROM documents
  JOIN (SELECT doc_id, {LABEL_CASE} AS label FROM labels) USING (doc_id))"""


@query(
    "filter_rows_label",
    f"""WITH {LABELLED_SQL} SELECT doc_id, label AS ground_truth FROM labelled WHERE {POSITIVE}""",
)
def filter_rows_label(spark, sf_dir):
    return cp.filter_rows(labelled(spark, sf_dir).select("doc_id", "label"))


@query(
    "filter_rows_language",
    f"""WITH {LABELLED_SQL} SELECT doc_id, language, label AS ground_truth FROM labelled
    WHERE language = 'english' AND {POSITIVE}""",
)
def filter_rows_language(spark, sf_dir):
    return cp.filter_rows(labelled(spark, sf_dir).select("doc_id", "language", "label"))


def sentences_sql(source: str) -> str:
    return f"""SELECT title, CAST(1 AS INTEGER) AS ground_truth
      FROM (SELECT trim(unnest(string_split(text, '.'))) AS title FROM {source}) WHERE title <> ''"""


def titles_sql(source: str, column: str, label: int) -> str:
    return f"""SELECT DISTINCT {column} AS title, CAST({label} AS INTEGER) AS ground_truth
      FROM {source} WHERE {column} IS NOT NULL"""


@query(
    "sentences",
    """SELECT doc_id, title, CAST(1 AS INTEGER) AS ground_truth
    FROM (SELECT doc_id, trim(unnest(string_split(text, '.'))) AS title FROM documents) WHERE title <> ''""",
)
def sentences(spark, sf_dir):
    return cp.sentences(documents(spark, sf_dir), keep=["doc_id"])


@query(
    "harmonize_source",
    f"""WITH {LABELLED_SQL}, kept AS (SELECT * FROM labelled WHERE language = 'english' AND {POSITIVE})
    {sentences_sql("kept")} UNION ALL ({titles_sql("kept", "text", 1)})""",
)
def harmonize_source(spark, sf_dir):
    return cp.harmonize(labelled(spark, sf_dir), "text")


@query(
    "build_corpus",
    f"""WITH {LABELLED_SQL}, kept AS (SELECT * FROM labelled WHERE language = 'english' AND {POSITIVE})
    SELECT DISTINCT title, ground_truth FROM (
      {sentences_sql("kept")} UNION ALL ({titles_sql("kept", "text", 1)})
      UNION ALL {sentences_sql("conversations")} UNION ALL ({titles_sql("conversations", "text", 1)})
      UNION ALL {sentences_sql("benchmark")} UNION ALL ({titles_sql("benchmark", "text", 0)})
      UNION ALL ({titles_sql("pages", "url", 1)}))""",
)
def build_corpus(spark, sf_dir):
    return cp.build_corpus(
        [
            cp.Source("documents", labelled(spark, sf_dir), "text"),
            cp.Source("conversations", table(spark, sf_dir, "conversations"), "text"),
            cp.Source("benchmark", table(spark, sf_dir, "benchmark"), "text", 0),
            cp.Source("pages", table(spark, sf_dir, "pages"), "url"),
        ]
    )


@query(
    "label_violations",
    """SELECT lang, label AS ground_truth, count(*) AS n_rows
    FROM (SELECT d.lang, l.quality + l.toxic AS label FROM documents d JOIN labels l USING (doc_id))
    WHERE label NOT IN (0, 1) GROUP BY lang, label""",
)
def label_violations(spark, sf_dir):
    both = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    rows = both.select("lang", (F.col("quality") + F.col("toxic")).alias("ground_truth"))
    return cp.label_violations(rows, by=["lang"])


@query("clean_chain", f"SELECT doc_id, text, {chain_sql('text')} AS cleaned FROM documents WHERE trim(text) <> ''")
def clean_chain(spark, sf_dir):
    return tx.clean(documents(spark, sf_dir).select("doc_id", "text"), "text", "cleaned")


@query("clean_pages", f"SELECT page_id, {chain_sql('url')} AS cleaned FROM (SELECT page_id, concat('see ', url, ' ', html) AS url FROM pages)")
def clean_pages(spark, sf_dir):
    """Raw pages led by their address: the step that takes out addresses has something to do."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("see "), "url", F.lit(" "), "html").alias("text"))
    return tx.clean(pages, "text", "cleaned", drop_duplicates=False).select("page_id", "cleaned")


@query("clean_last", f"SELECT doc_id, text, {last_sql('text')} AS cleaned FROM documents WHERE trim(text) <> ''")
def clean_last(spark, sf_dir):
    return tx.clean(documents(spark, sf_dir).select("doc_id", "text"), "text", "cleaned", mode="last")


@query(
    "clean_in_place",
    f"""SELECT DISTINCT text, source FROM (SELECT {chain_sql("text")} AS text, source FROM documents)
    WHERE trim(text) <> ''""",
)
def clean_in_place(spark, sf_dir):
    return tx.clean(documents(spark, sf_dir).select("text", "source"), "text", "text")


@query("dedup_texts", "SELECT DISTINCT text FROM documents")
def dedup_texts(spark, sf_dir):
    return cp.dedup(documents(spark, sf_dir).select("text"))


@query("dedup_by_text", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_by_text(spark, sf_dir):
    return cp.dedup(documents(spark, sf_dir).select("doc_id", "text"), ["text"])


@query(
    "drop_blank_rows",
    r"SELECT role, text FROM conversations WHERE regexp_matches(coalesce(role, '') || coalesce(text, ''), '\S')",
)
def drop_blank_rows(spark, sf_dir):
    return tx.drop_blank_rows(table(spark, sf_dir, "conversations").select("role", "text"))


STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
# token list with its places, blank strings dropped first
TOKENS_SQL = rf"""tokens AS (SELECT doc_id, lang, CAST(i - 1 AS INTEGER) AS pos, list[i] AS token FROM (
    SELECT doc_id, lang, list, unnest(generate_series(1, len(list))) AS i FROM (
      SELECT doc_id, lang, list_filter(string_split_regex({chain_sql("text")}, '\s+'), lambda w: w <> '') AS list
      FROM documents WHERE trim(text) <> '')))"""
KEPT_SQL = f"{TOKENS_SQL}, kept AS (SELECT * FROM tokens WHERE lower(token) NOT IN ({STOP_SQL}))"


@query("tokens", f"WITH {TOKENS_SQL} SELECT doc_id, pos, token FROM tokens")
def tokens(spark, sf_dir):
    return document_tokens(documents(spark, sf_dir), "doc_id", "text", stop_words=None)


@query("tokens_no_stopwords", f"WITH {KEPT_SQL} SELECT doc_id, pos, token FROM kept")
def tokens_no_stopwords(spark, sf_dir):
    return document_tokens(documents(spark, sf_dir), "doc_id", "text")


STEMMED_SQL = f"{KEPT_SQL}, {STEMS_SQL}"


@query("stemmed_tokens", f"WITH {STEMMED_SQL} SELECT doc_id, pos, token, stem FROM kept JOIN stems USING (token)")
def stemmed_tokens(spark, sf_dir):
    return tx.stem_tokens(document_tokens(documents(spark, sf_dir), "doc_id", "text"))


@query(
    "stemmed_vocab",
    f"""WITH {STEMMED_SQL} SELECT stem AS term, count(*) AS cnt,
    CAST(row_number() OVER (ORDER BY count(*) DESC, stem) - 1 AS INTEGER) AS term_idx
    FROM kept JOIN stems USING (token) GROUP BY stem ORDER BY cnt DESC, stem LIMIT 500""",
)
def stemmed_vocab(spark, sf_dir):
    stems = tx.stem_tokens(document_tokens(documents(spark, sf_dir), "doc_id", "text"))
    return ft.vocabulary(ft.term_counts(stems, "doc_id", "stem"), 500)
