"""Class counts, histograms and the gain-ratio search on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FEATURES, RETURNED_SQL, lines, query
from textree.operators import split as sp
from textree.operators.features import dense_matrix
from textree.storage import store

LOG2 = "log10({0}) / log10(2.0::DOUBLE)"


def term_sql(p: str) -> str:
    return f"(CASE WHEN {p} = 0 THEN 0.0 ELSE -({p}) * {LOG2.format(p)} END)"


def entropy_sql(a: str, b: str) -> str:
    whole = f"({a} + {b})"
    return f"({term_sql(f'{a}::DOUBLE / {whole}')} + {term_sql(f'{b}::DOUBLE / {whole}')})"


def hist_sql(features: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT CAST(1 AS BIGINT) AS node_id, '{c}' AS feature, {c} AS value, {RETURNED_SQL} AS y FROM lineitem"
        for c in features
    )
    return f"""long AS ({parts}),
    hist AS (SELECT node_id, feature, value, CAST(sum(1 - y) AS BIGINT) AS n0, CAST(sum(y) AS BIGINT) AS n1
      FROM long GROUP BY node_id, feature, value)"""


def search_ctes(hist: str, nodes: str, suffix: str = "") -> str:
    """CTEs cand, gain and win over a histogram and a (node_id, n0, n1) table."""
    return f"""run{suffix} AS (SELECT node_id, feature,
        (value + lead(value) OVER w) / 2 AS split,
        CAST(sum(h.n0) OVER w AS BIGINT) AS l0, CAST(sum(h.n1) OVER w AS BIGINT) AS l1
      FROM {hist} h WINDOW w AS (PARTITION BY node_id, feature ORDER BY value)),
    cand{suffix} AS (SELECT r.node_id, feature, split, l0, l1, n.n0 - l0 AS r0, n.n1 - l1 AS r1,
        round({entropy_sql("n.n0", "n.n1")}, 4) AS entropy
      FROM run{suffix} r JOIN {nodes} n USING (node_id) WHERE split IS NOT NULL),
    gain{suffix} AS (SELECT *, (entropy - (
          (l0 + l1)::DOUBLE / (l0 + l1 + r0 + r1) * {entropy_sql("l0", "l1")}
          + (r0 + r1)::DOUBLE / (l0 + l1 + r0 + r1) * {entropy_sql("r0", "r1")}))
        / {entropy_sql("(l0 + l1)", "(r0 + r1)")} AS gain_ratio
      FROM cand{suffix} WHERE l0 + l1 > 100 AND r0 + r1 > 100),
    win{suffix} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY node_id ORDER BY round(gain_ratio, 10) DESC, feature, split) AS rn FROM gain{suffix})
      WHERE rn = 1)"""


NODES_SQL = f"""nodes AS (SELECT CAST(1 AS BIGINT) AS node_id,
  CAST(sum(1 - {RETURNED_SQL}) AS BIGINT) AS n0, CAST(sum({RETURNED_SQL}) AS BIGINT) AS n1 FROM lineitem)"""
BASE_SQL = f"{hist_sql(FEATURES)}, {NODES_SQL}, {search_ctes('hist', 'nodes')}"
PRICE_SQL = f"{hist_sql(['l_extendedprice'])}, {NODES_SQL}, {search_ctes('hist', 'nodes')}"


def root_rows(spark, sf_dir, features=FEATURES):
    rows = dense_matrix(lines(spark, sf_dir, features), features, "y").rows
    return rows.withColumn("node_id", F.lit(1).cast("long"))


def root_hist(spark, sf_dir, features=FEATURES):
    return sp.histogram(sp.long_rows(root_rows(spark, sf_dir, features), sparse=False))


def root_search(spark, sf_dir, features=FEATURES):
    """The stored histogram and, from the bins of its first feature, the class totals of the node: one scan."""
    hist = store(root_hist(spark, sf_dir, features), "root-hist").df
    counts = hist.filter("feature = 0").groupBy("node_id").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return hist, sp.node_stats(counts)


def found_candidates(spark, sf_dir):
    hist, node = root_search(spark, sf_dir)
    return sp.candidates(sp.left_counts(hist), node, nodes_bytes=sp.NODE_BYTES)


def named(df, features=FEATURES):
    return df.withColumn("feature", F.element_at(F.lit(sorted(features)), F.col("feature") + 1))


@query("class_counts", f"SELECT {RETURNED_SQL} AS y, count(*) AS n_rows FROM lineitem GROUP BY ALL")
def class_counts(spark, sf_dir):
    return sp.class_counts(lines(spark, sf_dir))


@query(
    "class_entropy",
    f"""WITH n AS (SELECT l_linenumber AS node_id, CAST(sum(1 - {RETURNED_SQL}) AS BIGINT) AS n0,
      CAST(sum({RETURNED_SQL}) AS BIGINT) AS n1 FROM lineitem GROUP BY l_linenumber)
    SELECT node_id, n0, n1, round(abs({entropy_sql("n0", "n1")}), 4) AS entropy,
      CAST(CASE WHEN n0 > n1 THEN 0 ELSE 1 END AS INTEGER) AS majority FROM n""",
)
def class_entropy(spark, sf_dir):
    groups = lines(spark, sf_dir).groupBy(F.col("l_linenumber").alias("node_id"))
    return sp.node_stats(groups.agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1")))


@query("histogram", f"WITH {hist_sql(FEATURES)} SELECT * FROM hist")
def histogram(spark, sf_dir):
    return named(root_hist(spark, sf_dir))


@query("split_points", f"WITH {BASE_SQL} SELECT node_id, feature, round(split, 9) AS split FROM cand")
def split_points(spark, sf_dir):
    return named(sp.split_points(sp.left_counts(root_hist(spark, sf_dir)))).withColumn("split", F.round("split", 9))


CANDIDATES_SELECT = "SELECT node_id, feature, round(split, 9) AS split, l0, l1, r0, r1 FROM cand"


@query("candidates", f"WITH {BASE_SQL} {CANDIDATES_SELECT}")
def candidates(spark, sf_dir):
    found = found_candidates(spark, sf_dir)
    return named(found.drop("entropy")).withColumn("split", F.round("split", 9))


@query("candidates_ranged", f"WITH {PRICE_SQL} {CANDIDATES_SELECT}")
def candidates_ranged(spark, sf_dir):
    price = ["l_extendedprice"]
    hist, node = root_search(spark, sf_dir, price)
    hist = store(hist, "hist").df
    found = sp.candidates(sp.left_counts_ranged(hist, max_group=1000), node, nodes_bytes=sp.NODE_BYTES).drop("entropy")
    return named(found, price).withColumn("split", F.round("split", 9))


def gains(spark, sf_dir):
    return sp.gain_ratio(found_candidates(spark, sf_dir))


GAIN_COLUMNS = "node_id, feature, round(split, 9) AS split, l0, l1, r0, r1, round(gain_ratio, 9) AS gain_ratio"


def rounded(df):
    return named(df).withColumns({"split": F.round("split", 9), "gain_ratio": F.round("gain_ratio", 9)})


@query("gain_ratio", f"WITH {BASE_SQL} SELECT {GAIN_COLUMNS} FROM gain")
def gain_ratio(spark, sf_dir):
    return rounded(gains(spark, sf_dir))


@query("best_split", f"WITH {BASE_SQL} SELECT {GAIN_COLUMNS} FROM win")
def best_split(spark, sf_dir):
    return rounded(sp.best(gains(spark, sf_dir), 10))
