"""Trees, sampling, scores and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FEATURES, LINE_ID, LINES_SQL, documents, english_doc, lines, query, table
from catalog.splits import entropy_sql, search_ctes
from textree.operators import evaluate as ev
from textree.operators import sample as sm
from textree.operators.features import dense_matrix, sparse_matrix
from textree.plans import tree as tr
from textree.plans.experiment import train_and_score
from textree.plans.tfidf import tfidf_table
from textree.sources import read_runs, write_report
from textree.storage import new_path, store

DEPTH = 2


def tree_ctes(source: str, depth: int, features=FEATURES) -> str:
    """The tree unrolled: per level the rows, histogram, winners and children; then ``tree``."""
    ctes = [f"r0 AS (SELECT CAST(1 AS BIGINT) AS node_id, y, {', '.join(features)} FROM {source})"]
    ctes.append(
        """kids_root AS (SELECT CAST(1 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS depth,
        CAST(sum(1 - y) AS BIGINT) AS n0, CAST(sum(y) AS BIGINT) AS n1 FROM r0)"""
    )
    before, above = "kids_root", []
    for d in range(depth):
        long = " UNION ALL ".join(f"SELECT node_id, y, '{f}' AS feature, {f} AS value FROM r{d}" for f in features)
        taken = " + ".join(f"(SELECT count(*) FROM win{k})" for k in range(d)) or "0"
        ctes += [
            f"n{d} AS (SELECT * FROM {before} WHERE round({entropy_sql('n0', 'n1')}, 4) > 0.3)",
            f"""h{d} AS (SELECT node_id, feature, value, CAST(sum(1 - y) AS BIGINT) AS n0,
            CAST(sum(y) AS BIGINT) AS n1 FROM ({long}) GROUP BY ALL)""",
            search_ctes(f"h{d}", f"n{d}", str(d)),
            f"""num{d} AS (SELECT *, CAST(2 * ({taken}) + 2 * row_number() OVER (ORDER BY node_id) AS BIGINT)
            AS left_id FROM win{d})""",
            f"""kids{d} AS (SELECT left_id AS node_id, node_id AS parent_id, {d + 1} AS depth, l0 AS n0, l1 AS n1
            FROM num{d} UNION ALL SELECT left_id + 1, node_id, {d + 1}, r0, r1 FROM num{d})""",
        ]
        value = "CASE w.feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in features) + " END"
        ctes.append(
            f"""r{d + 1} AS (SELECT left_id + CASE WHEN {value} >= w.split THEN 1 ELSE 0 END AS node_id,
            y, {", ".join(features)} FROM r{d} JOIN num{d} w USING (node_id))"""
        )
        above.append(before)
        before = f"kids{d}"
    nodes = " UNION ALL ".join(f"SELECT * FROM {t}" for t in [*above, before])
    wins = " UNION ALL ".join(f"SELECT node_id, feature, split, left_id FROM num{d}" for d in range(depth))
    ctes.append(
        f"""tree AS (SELECT n.node_id, parent_id, CAST(depth AS INTEGER) AS depth, feature, split, left_id,
        left_id + 1 AS right_id,
        CAST(CASE WHEN feature IS NULL THEN CASE WHEN n0 > n1 THEN 0 ELSE 1 END END AS INTEGER) AS label, n0, n1
        FROM ({nodes}) n LEFT JOIN ({wins}) w USING (node_id))"""
    )
    return ",\n".join(ctes)


def scored_ctes(source: str, depth: int, features=FEATURES) -> str:
    """Rows of ``source`` with the prediction of ``tree``; a value equal to a split goes left."""
    value = "CASE t.feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in features) + " END"
    ctes = [f"p0 AS (SELECT *, CAST(1 AS BIGINT) AS spot FROM {source})"]
    for d in range(depth):
        ctes.append(
            f"""p{d + 1} AS (SELECT p.* EXCLUDE (spot), CASE WHEN t.feature IS NULL THEN spot
            WHEN {value} > t.split THEN right_id ELSE left_id END AS spot
            FROM p{d} p JOIN tree t ON p.spot = t.node_id)"""
        )
    ctes.append(
        f"""scored AS (SELECT p.* EXCLUDE (spot), t.label AS prediction
        FROM p{depth} p JOIN tree t ON p.spot = t.node_id)"""
    )
    return ",\n".join(ctes)


def lines_tree(spark, sf_dir, **options):
    return tr.fit(dense_matrix(lines(spark, sf_dir), FEATURES, "y"), gain_digits=10, **options)


LINES_TREE_SQL = f"src AS ({LINES_SQL}), {tree_ctes('src', DEPTH)}"
TREE_COLUMNS = "node_id, parent_id, depth, feature, round(split, 9) AS split, left_id, right_id, label, n0, n1"


def rounded_split(tree):
    return tree.withColumn("split", F.round("split", 9))


@query("tree_depth2_nodes", f"WITH {LINES_TREE_SQL} SELECT {TREE_COLUMNS} FROM tree")
def tree_depth2_nodes(spark, sf_dir):
    return rounded_split(lines_tree(spark, sf_dir, max_depth=DEPTH))


@query("tree_depth2_ranged", f"WITH {LINES_TREE_SQL} SELECT {TREE_COLUMNS} FROM tree")
def tree_depth2_ranged(spark, sf_dir):
    """The same tree with every feature cut into ranges."""
    return rounded_split(lines_tree(spark, sf_dir, max_depth=DEPTH, max_group=1))


PREDICT_SQL = f"""WITH {LINES_TREE_SQL}, {scored_ctes("src", DEPTH)}
  SELECT l_orderkey, l_linenumber, l_discount, l_quantity, l_tax, y, prediction FROM scored"""


@query("tree_depth2_predict", PREDICT_SQL)
def tree_depth2_predict(spark, sf_dir):
    return tr.predict(lines(spark, sf_dir), lines_tree(spark, sf_dir, max_depth=DEPTH))


@query("tree_depth2_predict_by_joins", PREDICT_SQL)
def tree_depth2_predict_by_joins(spark, sf_dir):
    return tr.predict(lines(spark, sf_dir), lines_tree(spark, sf_dir, max_depth=DEPTH), case_nodes=0)


PATH_SQL = """SELECT leaf.node_id, leaf.depth, leaf.label, leaf.n0, leaf.n1,
    CAST(a.feature AS VARCHAR) AS first_feature, round(a.split, 9) AS first_split,
    CAST(b.feature AS VARCHAR) AS second_feature, round(b.split, 9) AS second_split
  FROM tree leaf LEFT JOIN tree p ON leaf.parent_id = p.node_id
  LEFT JOIN tree b ON leaf.depth = 2 AND b.node_id = p.node_id
  LEFT JOIN tree a ON a.node_id = CASE leaf.depth WHEN 2 THEN p.parent_id WHEN 1 THEN p.node_id END
  WHERE leaf.feature IS NULL"""


@query("tree_rules", f"WITH {LINES_TREE_SQL} {PATH_SQL}")
def tree_rules(spark, sf_dir):
    """Leaves with the conditions on their paths, taken apart again so that numbers compare as numbers."""
    found = tr.rules(lines_tree(spark, sf_dir, max_depth=DEPTH))
    parts = {}
    for place, i in (("first", 0), ("second", 1)):
        step = F.split(F.get(F.split("rule", " AND "), i), " ")
        parts[f"{place}_feature"] = F.when(step[0] != "", step[0])
        parts[f"{place}_split"] = F.round(F.try_element_at(step, F.lit(3)).cast("double"), 9)
    return found.withColumns(parts).drop("rule")


@query("tree_text_fit")
def tree_text_fit(spark, sf_dir):
    """A full-depth tree on sparse TF-IDF rows: is the document English?"""
    docs = documents(spark, sf_dir)
    made = tfidf_table(docs, "doc_id", "text")
    return tr.fit(sparse_matrix(made.values, docs.select("doc_id", english_doc().alias("y")), "doc_id"))


def text_wide_sql() -> str:
    from catalog.features import tfidf_sql

    names = [f"term_{i}" for i in range(5)]
    columns = ", ".join(
        f"coalesce(max(CASE WHEN term_idx = {i} THEN round(tfidf, 5) END), 0.0) AS term_{i}" for i in range(5)
    )
    return f"""{tfidf_sql(5)}, src AS (SELECT d.doc_id, {columns},
      any_value(CAST(CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS INTEGER)) AS y
      FROM documents d LEFT JOIN (scores JOIN vocab USING (term)) s ON d.doc_id = s.doc_id GROUP BY d.doc_id),
      {tree_ctes("src", DEPTH, names)}"""


@query("tree_sparse_depth2", f"WITH {text_wide_sql()} SELECT {TREE_COLUMNS.replace('9)', '6)')} FROM tree")
def tree_sparse_depth2(spark, sf_dir):
    """Sparse rows of the five most frequent words, checked against the tree of their wide table."""
    docs = documents(spark, sf_dir)
    made = tfidf_table(docs, "doc_id", "text", 5, stemming=False)
    places = made.vocabulary.select("term", F.concat(F.lit("term_"), "term_idx").alias("name"))
    # five rows
    values = made.values.join(F.broadcast(places), "term").select("doc_id", F.col("name").alias("term"), "tfidf")
    rows = sparse_matrix(values, docs.select("doc_id", english_doc().alias("y")), "doc_id")
    tree = tr.fit(rows, max_depth=DEPTH, gain_digits=10)
    return tree.withColumn("split", F.round("split", 6))


# --- sampling ---

COUNTED = "(SELECT count(*) FILTER (y = 0) AS c0, count(*) FILTER (y = 1) AS c1 FROM src)"
DRAWN_SQL = f"""src AS ({LINES_SQL}), drawn AS (SELECT src.*,
  ('0x' || substr(md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 13))::BIGINT
    / 4503599627370496::DOUBLE < least(c0, c1) * 0.8::DOUBLE / CASE WHEN y = 0 THEN c0 ELSE c1 END AS in_train
  FROM src, {COUNTED})"""


@query("balanced_sample", f"WITH {DRAWN_SQL} SELECT * EXCLUDE (in_train) FROM drawn WHERE in_train")
def balanced_sample(spark, sf_dir):
    return sm.balanced(lines(spark, sf_dir), LINE_ID)


@query(
    "balanced_exact",
    """WITH src AS (SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS INTEGER) AS y FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))) AS rn FROM src)
    SELECT o_orderkey, o_custkey, y FROM ranked
    WHERE rn <= (SELECT floor(least(count(*) FILTER (y = 0), count(*) FILTER (y = 1)) * 0.8) FROM src)""",
)
def balanced_exact(spark, sf_dir):
    dear = F.when(F.col("o_totalprice") > 300000, 1).otherwise(0).alias("y")
    return sm.balanced_exact(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", dear), ["o_orderkey"])


@query("train_test_split", f"WITH {DRAWN_SQL} SELECT * FROM drawn")
def train_test_split(spark, sf_dir):
    train, test = sm.train_test(lines(spark, sf_dir), LINE_ID)
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query(
    "except_all",
    """SELECT l_linenumber, l_quantity FROM lineitem
    EXCEPT ALL SELECT l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'""",
)
def except_all(spark, sf_dir):
    rows = lines(spark, sf_dir)
    return sm.rest_of(rows.select("l_linenumber", "l_quantity"), rows.filter("y = 1").select("l_linenumber", "l_quantity"))


@query(
    "union_all",
    """SELECT l_linenumber, l_tax FROM lineitem WHERE l_returnflag <> 'R'
    UNION ALL SELECT l_linenumber, l_tax FROM lineitem WHERE l_returnflag = 'R'""",
)
def union_all(spark, sf_dir):
    rows = lines(spark, sf_dir).select("l_linenumber", "l_tax", "y")
    return rows.filter("y = 0").union(rows.filter("y = 1")).drop("y")


# --- scores ---

RUN_SQL = f"""{DRAWN_SQL}, train AS (SELECT * FROM drawn WHERE in_train),
  test AS (SELECT * EXCLUDE (in_train) FROM drawn WHERE NOT in_train),
  {tree_ctes("train", DEPTH)}, {scored_ctes("test", DEPTH)},
  conf AS (SELECT count(*) FILTER (y = 1 AND prediction = 1) AS tp, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
    count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 1 AND prediction = 0) AS fn FROM scored),
  rates AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS prec,
    CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS rec,
    CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0 END AS spec,
    (tp + fn)::DOUBLE / (tp + fp + tn + fn) AS prev FROM conf),
  scores AS (SELECT *, (rec + spec) / 2 AS roc,
    CASE WHEN tp + fp > 0 AND tn + fn > 0 THEN rec * prec + (1 - rec) * (prec + prev) / 2 ELSE prev END AS pr
    FROM rates)"""


def run(spark, sf_dir):
    return train_and_score(lines(spark, sf_dir), FEATURES, LINE_ID, "y", max_depth=DEPTH, gain_digits=10)


def run_scores(spark, sf_dir):
    return ev.metrics(ev.confusion(run(spark, sf_dir).scored))


@query("confusion", f"WITH {RUN_SQL} SELECT tp, fp, tn, fn FROM conf")
def confusion(spark, sf_dir):
    return ev.confusion(run(spark, sf_dir).scored)


@query(
    "binary_metrics",
    f"""WITH {RUN_SQL} SELECT tp, fp, tn, fn, round(roc, 9) AS area_under_roc, round(pr, 9) AS area_under_pr,
    round((tp + tn)::DOUBLE / (tp + fp + tn + fn), 9) AS accuracy, round(prec, 9) AS precision,
    round(rec, 9) AS recall, round(2 * tp::DOUBLE / (2 * tp + fp + fn), 9) AS f1 FROM scores""",
)
def binary_metrics(spark, sf_dir):
    names = ("area_under_roc", "area_under_pr", "accuracy", "precision", "recall", "f1")
    return run_scores(spark, sf_dir).withColumns({n: F.round(n, 9) for n in names})


@query(
    "report",
    f"""WITH {RUN_SQL}, sizes AS (SELECT count(*) FILTER (y = 0)::DOUBLE AS n0, count(*) FILTER (y = 1)::DOUBLE AS n1
    FROM train)
    SELECT round(roc, 9) AS "Accuracy", round(pr, 9) AS "Precision", n0 AS num_false, n1 AS num_true,
    tp + fp + tn + fn AS "Test Set" FROM scores, sizes""",
)
def report(spark, sf_dir):
    """The report without its run time, which differs each time, and with flat train counts."""
    made = store(run(spark, sf_dir).report, "report").df
    return made.select(
        F.round("Accuracy", 9).alias("Accuracy"),
        F.round("Precision", 9).alias("Precision"),
        F.col("`Train Set`.`num false`").alias("num_false"),
        F.col("`Train Set`.`num true`").alias("num_true"),
        "Test Set",
    )


@query(
    "report_roundtrip",
    f"""WITH {RUN_SQL} SELECT CAST(2 AS INTEGER) AS instances, CAST(3 AS INTEGER) AS cores, CAST(100 AS INTEGER) AS n_columns,
    round(roc, 9) AS area_under_roc, round(pr, 9) AS area_under_pr FROM scores""",
)
def report_roundtrip(spark, sf_dir):
    """The report goes through its sink into a run folder and is found there by the scan of runs."""
    path = new_path(spark, "analysis")
    write_report(run(spark, sf_dir).report, f"{path}/instances2cores3/result100")
    scores = {n: F.round(n, 9).alias(n) for n in ("area_under_roc", "area_under_pr")}
    return read_runs(spark, path).select("instances", "cores", "n_columns", *scores.values())


# --- the same at the depth the operator trains to, with prices among the features; held by tests, not by SQL ---

WIDE = [*FEATURES, "l_extendedprice"]
WORDS = 500


def full_tree(spark, sf_dir, **options):
    return tr.fit(dense_matrix(lines(spark, sf_dir, WIDE), WIDE, "y"), gain_digits=10, **options)


def full_run(spark, sf_dir):
    return train_and_score(lines(spark, sf_dir, WIDE), WIDE, LINE_ID, "y", gain_digits=10)


@query("tree_full_nodes")
def tree_full_nodes(spark, sf_dir):
    return full_tree(spark, sf_dir)


@query("tree_full_ranged")
def tree_full_ranged(spark, sf_dir):
    """Every level whose nodes have more than 1,000 values of a feature is searched in pieces."""
    return full_tree(spark, sf_dir, max_group=1000)


@query("tree_full_predict")
def tree_full_predict(spark, sf_dir):
    return tr.predict(lines(spark, sf_dir, WIDE), full_tree(spark, sf_dir))


@query("tree_full_predict_by_joins")
def tree_full_predict_by_joins(spark, sf_dir):
    return tr.predict(lines(spark, sf_dir, WIDE), full_tree(spark, sf_dir), case_nodes=0, limit=0)


@query("tree_full_rules")
def tree_full_rules(spark, sf_dir):
    return tr.rules(full_tree(spark, sf_dir))


@query("tree_full_save_load")
def tree_full_save_load(spark, sf_dir):
    path = new_path(spark, "saved-tree")
    tr.save(full_tree(spark, sf_dir), path)
    return tr.load(spark, path)


@query("tree_sparse_full")
def tree_sparse_full(spark, sf_dir):
    """Sparse rows of the 500 most frequent words."""
    docs = documents(spark, sf_dir)
    made = tfidf_table(docs, "doc_id", "text", WORDS, stemming=False)
    rows = sparse_matrix(made.values, docs.select("doc_id", english_doc().alias("y")), "doc_id")
    return tr.fit(rows, gain_digits=10)


@query("confusion_full")
def confusion_full(spark, sf_dir):
    return ev.confusion(full_run(spark, sf_dir).scored)


@query("binary_metrics_full")
def binary_metrics_full(spark, sf_dir):
    return ev.metrics(ev.confusion(full_run(spark, sf_dir).scored))


@query("report_full")
def report_full(spark, sf_dir):
    """The report as it is written, its run time left out."""
    return store(full_run(spark, sf_dir).report, "report").df.drop("Execution Time")


@query("report_roundtrip_full")
def report_roundtrip_full(spark, sf_dir):
    path = new_path(spark, "analysis")
    write_report(full_run(spark, sf_dir).report, f"{path}/instances2cores3/result100")
    return read_runs(spark, path).select("instances", "cores", "n_columns", "area_under_roc", "area_under_pr")
