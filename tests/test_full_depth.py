"""The queries at full depth against a plain recursion over arrays."""

import functools

import numpy as np
import pytest

from catalog import model
from catalog.base import LINE_ID, QUERIES, documents, english_doc, lines
from catalog.model import WIDE, WORDS
from textree.operators import sample as sm
from textree.plans.tfidf import tfidf_table

SF_DIR = "/root/testdata/sf0.001"
DOCS_DIR = "/root/testdata/sf0.01"


def entropy(n0, n1):
    n = n0 + n1
    parts = [np.where(c > 0, c / n * np.log2(np.maximum(c, 1) / n), 0.0) for c in (n0, n1)]
    return -(parts[0] + parts[1])


def grow(x, y, names, min_side=100, max_depth=100, depth=0):
    """Nested tuples (feature, split, left, right) or (label, n0, n1)."""
    n1 = int(y.sum())
    n0 = len(y) - n1
    # the entropy of a node is rounded before the gain is taken, as in the operator's SQL
    h, best = round(float(entropy(np.float64(n0), np.float64(n1))), 4), None
    if h > 0.3 and depth < max_depth:
        for name, k in sorted((name, k) for k, name in enumerate(names)):
            values, at = np.unique(x[:, k], return_inverse=True)
            if len(values) < 2:
                continue
            ones = np.bincount(at, weights=y)
            rows = np.bincount(at)
            l1, left = np.cumsum(ones)[:-1], np.cumsum(rows)[:-1].astype(float)
            r1, right = n1 - l1, len(y) - left
            info = (left * entropy(left - l1, l1) + right * entropy(right - r1, r1)) / len(y)
            ratio = np.round((h - info) / entropy(left, right), 10)
            ratio[(left <= min_side) | (right <= min_side)] = -np.inf
            i = int(np.argmax(ratio))
            if ratio[i] > (best[0] if best else -np.inf):
                best = (ratio[i], name, k, (values[i] + values[i + 1]) / 2)
    if best is None:
        return (0 if n0 > n1 else 1, n0, n1)
    _, name, k, split = best
    side = x[:, k] >= split
    return (name, float(split), *[grow(x[s], y[s], names, min_side, max_depth, depth + 1) for s in (~side, side)])


def nested(rows):
    nodes = {r["node_id"]: r for r in rows}

    def build(i):
        n = nodes[i]
        if n["feature"] is None:
            return (n["label"], n["n0"], n["n1"])
        return (n["feature"], n["split"], build(n["left_id"]), build(n["right_id"]))

    return build(1)


def rounded(node):
    return node if len(node) == 3 else (node[0], round(node[1], 9), rounded(node[2]), rounded(node[3]))


def leaves(node, path=()):
    if len(node) == 3:
        return [(len(path), path, *node)]
    name, split, left, right = node
    return leaves(left, (*path, (name, "<", round(split, 9)))) + leaves(right, (*path, (name, ">=", round(split, 9))))


def told(node, row):
    while len(node) == 4:
        node = node[3] if row[node[0]] > node[1] else node[2]
    return node[0]


def arrays(df):
    rows = df.toPandas()
    return rows[WIDE].to_numpy(float), rows["y"].to_numpy(int)


@pytest.fixture(scope="module", autouse=True)
def fitted_once():
    """One fit for all queries of the tree and one for all of the run; each takes over a minute."""
    with pytest.MonkeyPatch.context() as patch:
        for name in ("full_tree", "full_run"):
            patch.setattr(model, name, functools.cache(getattr(model, name)))
        yield


@pytest.fixture(scope="module")
def want(spark):
    return grow(*arrays(lines(spark, SF_DIR, WIDE)), WIDE)


@pytest.mark.parametrize("name", ["tree_full_nodes", "tree_full_ranged", "tree_full_save_load"])
def test_nodes(spark, want, name):
    got = QUERIES[name](spark, SF_DIR).collect()
    assert max(r["depth"] for r in got) > 2 and "l_extendedprice" in {r["feature"] for r in got}
    assert rounded(nested(got)) == rounded(want)


def test_rules(spark, want):
    got = []
    for r in QUERIES["tree_full_rules"](spark, SF_DIR).collect():
        steps = [x.split(" ") for x in r["rule"].split(" AND ")]
        got.append((r["depth"], tuple((f, sign, round(float(s), 9)) for f, sign, s in steps), r["label"], r["n0"], r["n1"]))
    assert sorted(got) == sorted(leaves(want))


@pytest.mark.parametrize("name", ["tree_full_predict", "tree_full_predict_by_joins"])
def test_predictions(spark, want, name):
    got = QUERIES[name](spark, SF_DIR).collect()
    assert len(got) == lines(spark, SF_DIR).count()
    assert all(r["prediction"] == told(want, r) for r in got)


def test_run(spark):
    train, test = sm.train_test(lines(spark, SF_DIR, WIDE), LINE_ID)
    x, y = arrays(train)
    tree = grow(x, y, WIDE)
    cells = {(a, p): 0 for a in (0, 1) for p in (0, 1)}
    for r in test.collect():
        cells[r["y"], told(tree, r)] += 1
    tp, fp, tn, fn = cells[1, 1], cells[0, 1], cells[0, 0], cells[1, 0]
    recall, precision, prevalence = tp / (tp + fn), tp / (tp + fp), (tp + fn) / (tp + fp + tn + fn)
    roc = (recall + tn / (tn + fp)) / 2
    pr = recall * precision + (1 - recall) * (precision + prevalence) / 2
    assert tuple(QUERIES["confusion_full"](spark, SF_DIR).first()) == (tp, fp, tn, fn)
    scores = QUERIES["binary_metrics_full"](spark, SF_DIR).first().asDict()
    f1 = 2 * tp / (2 * tp + fp + fn)
    made = {"area_under_roc": roc, "area_under_pr": pr, "precision": precision, "recall": recall, "f1": f1, "accuracy": (tp + tn) / sum(cells.values())}
    assert all(scores[k] == pytest.approx(v, abs=1e-12) for k, v in made.items())
    report = QUERIES["report_full"](spark, SF_DIR).first()
    assert (report["Accuracy"], report["Precision"]) == (pytest.approx(roc), pytest.approx(pr))
    assert tuple(report["Train Set"]) == (len(y) - y.sum(), y.sum()) and report["Test Set"] == sum(cells.values())
    found = QUERIES["report_roundtrip_full"](spark, SF_DIR).collect()
    assert [tuple(r) for r in found] == [(2, 3, 100, pytest.approx(roc), pytest.approx(pr))]


def test_sparse_tree(spark):
    docs = documents(spark, DOCS_DIR)
    values = tfidf_table(docs, "doc_id", "text", WORDS, stemming=False).values.toPandas()
    labels = docs.select("doc_id", english_doc().alias("y")).toPandas()
    place = {d: i for i, d in enumerate(labels["doc_id"])}
    names = sorted(set(values["term"]))
    column = {t: i for i, t in enumerate(names)}
    x = np.zeros((len(labels), len(names)))
    x[[place[d] for d in values["doc_id"]], [column[t] for t in values["term"]]] = values["tfidf"].round(5)  # as sparse_matrix does
    got = QUERIES["tree_sparse_full"](spark, DOCS_DIR).collect()
    assert len(names) > 400 and len(got) > 3
    assert rounded(nested(got)) == rounded(grow(x, labels["y"].to_numpy(int), names))
