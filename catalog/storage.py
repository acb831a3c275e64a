"""Round trips of the given tables through every source and sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FEATURES, RETURNED_SQL, documents, lines, query, table
from catalog.model import LINES_TREE_SQL, TREE_COLUMNS, lines_tree, rounded_split
from textree import sources as src
from textree.operators import runs as rn
from textree.plans import tree as tr
from textree.storage import new_path

CAST_DOCUMENTS = ["CAST(doc_id AS BIGINT) doc_id", "text", "lang", "source", "CAST(n_chars AS BIGINT) n_chars"]


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "documents-csv")
    src.write_csv(documents(spark, sf_dir), path)
    return src.read_csv(spark, path).selectExpr(*CAST_DOCUMENTS)


@query(
    "feature_csv_roundtrip",
    f"""SELECT CAST(l_orderkey AS INTEGER) AS "Index", {", ".join(FEATURES)}, {RETURNED_SQL} AS ground_truth
    FROM lineitem""",
)
def feature_csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "features-csv")
    wide = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("Index"), *FEATURES, F.col("y").alias("ground_truth")
    )
    src.write_csv(wide, path)
    return src.read_feature_csv(spark, path)


@query(
    "jsonl_source",
    """SELECT DISTINCT role, text, CAST(1 AS INTEGER) AS label FROM conversations
    WHERE role IS NOT NULL AND text IS NOT NULL""",
)
def jsonl_source(spark, sf_dir):
    path = new_path(spark, "conversations-jsonl")
    table(spark, sf_dir, "conversations").select("role", "text").write.json(path)
    return src.read_jsonl(spark, path)


@query("materialize", "SELECT * FROM conversations")
def materialize(spark, sf_dir):
    return src.materialize(table(spark, sf_dir, "conversations"))


@query("file_manifest")
def file_manifest(spark, sf_dir):
    files = src.file_manifest(spark, sf_dir, "*.parquet")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query(
    "file_manifest_by_role",
    "SELECT role, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM conversations WHERE text IS NOT NULL GROUP BY role",
)
def file_manifest_by_role(spark, sf_dir):
    """Texts written one folder per role: what the manifest adds up to is every text and its line end."""
    path = new_path(spark, "conversations-text")
    kept = table(spark, sf_dir, "conversations").filter("text IS NOT NULL").select("role", F.col("text").alias("value"))
    kept.write.partitionBy("role").text(path)
    files = src.file_manifest(spark, path, "*.txt")
    role = F.regexp_extract("path", "/role=([^/]*)/", 1)
    return files.groupBy(role.alias("role")).agg(F.sum("length").alias("n_bytes"))


@query(
    "corpus_with_jsonl",
    """SELECT text AS title, CAST(0 AS INTEGER) AS ground_truth FROM benchmark
    UNION ALL SELECT DISTINCT text, CAST(1 AS INTEGER) FROM conversations WHERE text IS NOT NULL""",
)
def corpus_with_jsonl(spark, sf_dir):
    """Rows of a JSON-lines set, all of label 1, put to a corpus of label 0."""
    path = new_path(spark, "conversations-jsonl")
    table(spark, sf_dir, "conversations").select("text").write.json(path)
    added = src.read_jsonl(spark, path, label_col="ground_truth").withColumnRenamed("text", "title")
    corpus = table(spark, sf_dir, "benchmark").select(F.col("text").alias("title"), F.lit(0).alias("ground_truth"))
    return corpus.unionByName(added)


@query("tree_save_load", f"WITH {LINES_TREE_SQL} SELECT {TREE_COLUMNS} FROM tree")
def tree_save_load(spark, sf_dir):
    path = new_path(spark, "saved-tree")
    tr.save(lines_tree(spark, sf_dir, max_depth=2), path)
    return rounded_split(tr.load(spark, path))


# Every line item is taken for one finished run: its line number gives the instances (the first line is a
# sequential run), its flag the cores per instance, its status the width, its price and quantity the times.
RUN_CORES = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END"
RUN_WIDTH = "CASE l_linestatus WHEN 'O' THEN 100 ELSE 250 END"


def stored_runs(spark, sf_dir):
    path = new_path(spark, "analysis")
    lineitem = table(spark, sf_dir, "lineitem")
    shape = f"CASE WHEN l_linenumber = 1 THEN 'sequential' ELSE concat('instances', l_linenumber, 'cores', {RUN_CORES}) END"
    runs = lineitem.selectExpr(
        "l_discount AS `Accuracy`",
        "l_tax AS `Precision`",
        "CAST(CAST(l_quantity * 1000 AS BIGINT) AS STRING) AS `Execution Time`",
        "CAST(round(l_extendedprice) AS BIGINT) AS `Job Time`",
        f"{shape} AS run",
        f"concat('result', {RUN_WIDTH}) AS result",
    )
    runs.write.partitionBy("run", "result").json(path)
    return src.read_runs(spark, path)


RUNS_SQL = f"""runs AS (SELECT CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END AS INTEGER) AS instances,
  CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE {RUN_CORES} END AS INTEGER) AS cores,
  CAST({RUN_WIDTH} AS INTEGER) AS n_columns, round(l_extendedprice)::DOUBLE AS job_ms,
  (l_quantity * 1000)::DOUBLE AS fit_ms, l_discount AS area_under_roc, l_tax AS area_under_pr FROM lineitem)"""
WORKERS_SQL = f"""{RUNS_SQL}, placed AS (SELECT *, CAST(CASE WHEN cores = 0 THEN 1
  ELSE ceil(instances * cores / CASE WHEN cores = 2 THEN 2.0 ELSE 3.0 END) END AS INTEGER) AS workers FROM runs)"""


@query("read_runs", f"WITH {RUNS_SQL} SELECT * FROM runs")
def read_runs(spark, sf_dir):
    return stored_runs(spark, sf_dir)


@query(
    "runs_scaling",
    f"""WITH {WORKERS_SQL} SELECT n_columns, cores, workers, count(*) AS n_runs,
    round(avg(job_ms) / 60000, 2) AS job_minutes FROM placed GROUP BY ALL""",
)
def runs_scaling(spark, sf_dir):
    return rn.scaling(stored_runs(spark, sf_dir))


@query(
    "runs_by_width",
    f"""WITH {WORKERS_SQL} SELECT n_columns, workers, round(avg(job_ms) / 60000, 2) AS job_minutes
    FROM placed WHERE cores = 3 GROUP BY ALL""",
)
def runs_by_width(spark, sf_dir):
    return rn.scaling_by_width(stored_runs(spark, sf_dir))


GRID_COLUMNS = ", ".join(f"max(CASE WHEN workers = {w} THEN job_minutes END) AS w{w}" for w in range(1, 8))


@query(
    "runs_grid",
    f"""WITH {WORKERS_SQL}, scaled AS (SELECT n_columns, cores, workers, round(avg(job_ms) / 60000, 2) AS job_minutes
    FROM placed GROUP BY ALL) SELECT n_columns, cores, {GRID_COLUMNS} FROM scaled GROUP BY ALL""",
)
def runs_grid(spark, sf_dir):
    grid = rn.scaling_grid(rn.scaling(stored_runs(spark, sf_dir)))
    return grid.toDF("n_columns", "cores", *[f"w{c}" for c in grid.columns[2:]])


@query(
    "runs_unmatched",
    """SELECT CASE WHEN l_linenumber = 2 THEN 'path' ELSE 'record' END AS reason, count(*) AS n_records
    FROM lineitem WHERE l_linenumber IN (2, 3) GROUP BY ALL""",
)
def runs_unmatched(spark, sf_dir):
    """The second lines lie under a folder that is no run, the third ones are no JSON; the others are read."""
    path = new_path(spark, "analysis")
    kept = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 3 THEN '{broken' ELSE to_json(struct(l_discount AS Accuracy)) END AS value",
        "CASE WHEN l_linenumber = 2 THEN 'notes' ELSE 'instances2cores3' END AS run",
        "'result100' AS result",
    )
    kept.write.partitionBy("run", "result").text(path)
    return src.unread_runs(spark, path).groupBy("reason").agg(F.sum("n_records").alias("n_records"))


@query(
    "runs_growth",
    f"""WITH {WORKERS_SQL} SELECT CAST(CASE WHEN cores = 0 THEN 0 ELSE workers END AS INTEGER) AS workers, n_columns,
    round(avg(job_ms) / 60000, 2) AS job_minutes FROM placed
    WHERE (instances, cores, n_columns) IN ((0, 0, 100), (2, 3, 100), (4, 3, 250)) GROUP BY ALL""",
)
def runs_growth(spark, sf_dir):
    return rn.growth(stored_runs(spark, sf_dir), ((0, 0, 100), (2, 3, 100), (4, 3, 250)))
