"""The distributed tree against a small independent one, and the rules that a rewrite gets wrong."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textree.operators import large_nodes
from textree.operators import split as sp
from textree.operators.features import dense_matrix, sparse_matrix
from textree.plans import tree as tr


def entropy(*counts):
    n = sum(counts)
    return -sum(c / n * math.log10(c / n) / math.log10(2) for c in counts if c)


def grow(rows, names, min_side, max_depth, stop=0.3):
    """Plain recursion over rows (values, y): nested tuples (feature, split, left, right) or (label, n0, n1)."""

    def build(rows, depth):
        n1 = sum(y for _, y in rows)
        n0 = len(rows) - n1
        h = round(entropy(n0, n1), 4)
        best = None
        if h > stop and depth < max_depth:
            for name in sorted(names):
                values = sorted({v[name] for v, _ in rows})
                for a, b in zip(values, values[1:]):
                    split = (a + b) / 2
                    left = [y for v, y in rows if v[name] < split]
                    right = [y for v, y in rows if v[name] >= split]
                    if len(left) <= min_side or len(right) <= min_side:
                        continue
                    sides = [(len(s) - sum(s), sum(s)) for s in (left, right)]
                    info = sum(len(s) / len(rows) * entropy(*c) for s, c in zip((left, right), sides))
                    ratio = round((h - info) / entropy(len(left), len(right)), 10)
                    if best is None or ratio > best[0]:
                        best = (ratio, name, split)
        if best is None:
            return (0 if n0 > n1 else 1, n0, n1)
        _, name, split = best
        left = build([r for r in rows if r[0][name] < split], depth + 1)
        right = build([r for r in rows if r[0][name] >= split], depth + 1)
        return (name, split, left, right)

    return build(rows, 0)


def nested(tree):
    nodes = {r["node_id"]: r for r in tree.collect()}

    def build(i):
        n = nodes[i]
        if n["feature"] is None:
            return (n["label"], n["n0"], n["n1"])
        assert n["label"] is None
        return (n["feature"], n["split"], build(n["left_id"]), build(n["right_id"]))

    assert sorted(nodes) == list(range(1, len(nodes) + 1))
    return build(1)


def sample_rows(seed, n=400, zeros=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = {
            "a": float(rng.randint(0, 6)),
            "b": round(rng.gauss(0, 1), 2),
            "c": rng.choice([0.0, 1.0]),
            "d": 3.5,
        }
        if zeros:
            v = {k: x if rng.random() < 0.4 else 0.0 for k, x in v.items()}
        y = int(rng.random() < (0.8 if v["a"] + v["b"] > 3 else 0.25))
        rows.append((v, y))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, *(v[k] for k in "abcd"), y) for i, (v, y) in enumerate(rows)],
        "id int, a double, b double, c double, d double, ground_truth int",
    )


@pytest.mark.parametrize(
    "options",
    [{}, {"max_group": 5}, {"local_nodes": 0}, {"plan_levels": 1, "local_nodes": 2}, {"keep_share": 0}, {"keep_share": 9.0, "keep_cells": 0, "max_group": 5}],
    ids=str,
)
def test_dense_tree_equals_plain_recursion(spark, options):
    rows = sample_rows(2)
    tree = tr.fit(dense_matrix(frame(spark, rows), "abcd"), max_depth=4, min_side=10, gain_digits=10, **options)
    assert nested(tree) == grow(rows, "abcd", 10, 4)


@pytest.mark.parametrize("options", [{"keep_share": 9.0, "keep_cells": 0}, {"max_group": 5, "local_nodes": 0, "keep_share": 0}], ids=str)
def test_sparse_tree_equals_dense_tree(spark, options):
    rows = sample_rows(3, zeros=True)
    df = frame(spark, rows)
    long = df.unpivot(["id"], ["a", "b", "c", "d"], "term", "tfidf")
    labels = df.select("id", F.col("ground_truth").alias("y"))
    want = grow(rows, "abcd", 10, 4)
    for values in (long, long.filter("tfidf != 0")):
        tree = tr.fit(sparse_matrix(values, labels, "id"), max_depth=4, min_side=10, gain_digits=10, **options)
        assert nested(tree) == want


@pytest.mark.parametrize("sparse", [False, True])
def test_children_from_the_smaller_one(spark, sparse):
    """At most half of the rows of split nodes are looked at, and the bins are those of all rows."""
    rows = sample_rows(5, zeros=True)
    df = frame(spark, rows)
    if sparse:
        labels = df.select("id", F.col("ground_truth").alias("y"))
        matrix = sparse_matrix(df.unpivot(["id"], ["a", "b", "c", "d"], "term", "tfidf"), labels, "id")
    else:
        matrix = dense_matrix(df, "abcd")
    root = spark.createDataFrame([(1, *[sum(1 for _, y in rows if y == k) for k in (0, 1)])], "node_id long, n0 long, n1 long")
    now = matrix.rows.selectExpr("1L AS node_id", "y", "x", "monotonically_increasing_id() AS salt")

    def histogram(rows, nodes):
        hist = sp.histogram(sp.long_rows(rows, sparse))
        return sp.with_zero_bins(hist, nodes) if sparse else hist

    def bins(hist):
        return sorted(tuple(r[c] for c in ("node_id", "feature", "value", "n0", "n1")) for r in hist.collect())

    for left_open, right_open in ((True, True), (True, False), (False, True)):
        split = 0.05
        side = [[k for k, (v, y) in enumerate(rows) if (v["b"] >= split) == right] for right in (False, True)]
        l0, l1, r0, r1 = (sum(1 for k in s if rows[k][1] == y) for s in side for y in (0, 1))
        level = spark.createDataFrame(
            [(1, 0, "b", split, l0, l1, r0, r1, left_open, right_open, 2, 3)],
            "node_id long, depth int, feature string, split double, l0 long, l1 long, r0 long, r1 long, left_open boolean, right_open boolean, left_id long, right_id long",
        )
        nodes = tr.children(level).filter("open").select("node_id", "n0", "n1")
        halves = tr.route(now, level, matrix.names, halves=True)
        assert 0 < halves.filter("built").count() <= len(rows) // 2
        made = sp.child_histogram(sp.long_rows(halves.filter("built"), sparse), histogram(now, root), tr.family(level), sparse=sparse)
        want = histogram(tr.route(now, level, matrix.names), nodes)
        assert bins(made) == bins(want)


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_no_piece_is_longer_than_asked(spark, partitions):
    rng = random.Random(4)
    values = {round(rng.paretovariate(0.5), 6) for _ in range(3000)}
    hist = spark.createDataFrame([(n, f, v, 1, i % 2) for n, f in ((1, 0), (1, 1), (2, 0)) for i, v in enumerate(values) if n == 1 or i < 10], "node_id long, feature int, value double, n0 long, n1 long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pieces = sp._in_pieces(hist, sp.piece_bounds(hist, len(values), 40)).groupBy("node_id", "feature", "piece").count().collect()
        assert max(r["count"] for r in pieces) <= 40 and len(pieces) > 2 * len(values) / 40
        sums = [sorted(map(tuple, left.collect())) for left in (sp.left_counts(hist), sp.left_counts_ranged(hist, 40))]
        assert sums[0] == sums[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbering_of_very_large_levels(spark, monkeypatch):
    monkeypatch.setattr(tr, "NUMBER_ROWS", 0)
    rows = sample_rows(1)
    tree = tr.fit(dense_matrix(frame(spark, rows), "abcd"), max_depth=3, min_side=10, gain_digits=10, local_nodes=0)
    assert nested(tree) == grow(rows, "abcd", 10, 3)


@pytest.mark.parametrize("options", [{"local_nodes": 0}, {"keep_share": 9.0, "keep_cells": 0}], ids=str)
def test_levels_and_subtrees_give_the_same_table(spark, options):
    rows = sample_rows(2)
    matrix = dense_matrix(frame(spark, rows), "abcd")
    levels, subtrees = (tr.fit(matrix, max_depth=5, min_side=5, gain_digits=10, subtree_cells=cells, **options) for cells in (0, 10_000))
    assert nested(levels) == grow(rows, "abcd", 5, 5)
    assert sorted(levels.collect()) == sorted(subtrees.collect())


def test_a_deep_tree_of_small_nodes_is_not_a_job_a_level(spark, monkeypatch):
    """One half is pure; in the other, splits take few rows off at a time."""
    df = spark.createDataFrame([(float(i), int(i % 7 == 0 or i >= 99)) for i in range(200)], "x double, ground_truth int")
    found = []
    real = tr._local_level
    monkeypatch.setattr(tr, "_local_level", lambda *args: found.append(1) or real(*args))
    tree = tr.fit(dense_matrix(df, ["x"]), max_depth=40, min_side=1, entropy_stop=0.0, gain_digits=10).collect()
    deepest = max(r["depth"] for r in tree)
    assert deepest > 5 and len(found) < deepest / 2
    assert [r["node_id"] for r in sorted(tree, key=lambda r: r["node_id"])] == list(range(1, len(tree) + 1))


def test_subtrees_split_as_levels_do_at_the_edges(spark):
    """Midpoints that round onto a value, infinite values, ties of features and -0.0."""
    low = 1.0
    high = math.nextafter(low, 2)
    odd = [-0.0, 0.0, low, high, math.nextafter(high, 2), math.inf, -math.inf, 1.7e308]
    df = spark.createDataFrame([(odd[i % 8], odd[i % 8], float(i % 5), int(i % 8 in (1, 3, 6) or i % 11 == 0)) for i in range(160)], "m double, k double, j double, ground_truth int")
    matrix = dense_matrix(df, ["m", "k", "j"])
    levels, subtrees = (tr.fit(matrix, max_depth=4, min_side=2, gain_digits=10, subtree_cells=cells) for cells in (0, 10_000))
    assert len(levels.collect()) > 5 and sorted(levels.collect(), key=str) == sorted(subtrees.collect(), key=str)


@pytest.mark.parametrize(("list_rows", "options"), [(0, {}), (0, {"max_group": 3}), (1000, {"max_group": 3})], ids=str)
def test_tasks_that_hold_ranges_give_the_same_table(spark, monkeypatch, list_rows, options):
    """Nodes too large for one task were a job a level; here ranges of a few rows, with values that go over many of them."""
    nodes = []
    monkeypatch.setattr(large_nodes, "TASK_ROWS", 300)
    monkeypatch.setattr(large_nodes, "RANGE_ROWS", 20)
    monkeypatch.setattr(large_nodes, "LIST_ROWS", list_rows)
    monkeypatch.setattr(tr, "large_splits", lambda *args: nodes.append(large_nodes.large_splits(*args)) or nodes[-1])
    rng = random.Random(12)
    near = math.nextafter(1.0, 2.0)
    rows = [(rng.choice([0.0, -0.0, 1.0, near, math.inf]), rng.random(), float(rng.random() < 0.02), rng.randrange(4) / 4, rng.randrange(2)) for _ in range(900)]
    rows = [(*r[:4], int(r[4] or r[0] == near or r[1] > 0.9)) for r in rows]
    matrix = dense_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double, ground_truth int"), "abcd")
    levels, ranges = (tr.fit(matrix, max_depth=12, min_side=3, gain_digits=10, subtree_cells=cells, **options) for cells in (0, 200))
    assert len(nodes) == 1 and len(nodes[0]) > 5 and max(s["depth"] for s in nodes[0]) > 2
    assert len(levels.collect()) > 40 and sorted(levels.collect(), key=str) == sorted(ranges.collect(), key=str)


def test_lists_that_tasks_cannot_hold_leave_levels_as_jobs(spark, monkeypatch):
    assert large_nodes.tasks_for(spark, 1_000_000, 4) == 8
    monkeypatch.setattr(large_nodes, "TASK_BYTES", 1000)
    assert large_nodes.tasks_for(spark, 1_000_000, 4) == 0
    matrix = dense_matrix(frame(spark, sample_rows(7)), "abcd")
    levels, fallback = (tr.fit(matrix, max_depth=4, min_side=5, gain_digits=10, subtree_cells=cells) for cells in (0, 200))
    assert sorted(levels.collect()) == sorted(fallback.collect())


def test_rules_of_a_deep_tree_take_a_join_for_each_doubling(spark, monkeypatch):
    """A chain of 21 levels took 21 joins."""
    chain = [(2 * d, 2 * d - 1, d, None, None, None, None, d % 2, d, 0) for d in range(1, 22)]
    chain += [(2 * d + 1, 2 * d - 1 or None, d, "x", d / 4, 2 * d + 2, 2 * d + 3, None, d, 0) for d in range(21)]
    chain.append((43, 41, 21, None, None, None, None, 1, 0, 0))
    chain = [(n, None if n == 1 else up, *rest) for n, up, *rest in chain]
    tree = spark.createDataFrame(chain, "node_id long, parent_id long, depth int, feature string, split double, left_id long, right_id long, label int, n0 long, n1 long")
    joins = []
    real = tr.join_small
    monkeypatch.setattr(tr, "join_small", lambda *args, **options: joins.append(1) or real(*args, **options))
    got = {r["node_id"]: r["rule"] for r in tr.rules(tree).collect()}
    above = [f"x >= {d / 4}" for d in range(21)]
    assert got == {2 * d: " AND ".join([*above[: d - 1], f"x < {(d - 1) / 4}"]) for d in range(1, 22)} | {43: " AND ".join(above)}
    assert len(joins) == 6
    assert tr.rules(tree.filter("node_id = 1").selectExpr("node_id", "parent_id", "0 AS depth", "CAST(NULL AS STRING) AS feature", "split", "left_id", "right_id", "1 AS label", "n0", "n1")).first()["rule"] == ""


def test_pure_and_shallow_roots_are_leaves(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(300)], "x double, ground_truth int")
    tree = tr.fit(dense_matrix(df, ["x"]))
    assert nested(tree) == (1, 0, 300)
    assert tr.predict(df, tree, case_nodes=0).filter("prediction = 1").count() == 300
    rows = sample_rows(1)
    assert nested(tr.fit(dense_matrix(frame(spark, rows), "abcd"), max_depth=0))[0] in (0, 1)


def test_tie_of_classes_gives_one(spark):
    df = spark.createDataFrame([(1.0, i % 2) for i in range(10)], "x double, ground_truth int")
    assert nested(tr.fit(dense_matrix(df, ["x"]))) == (1, 5, 5)


def test_sides_must_exceed_the_minimum(spark):
    df = spark.createDataFrame([(float(i >= 100), int(i >= 100)) for i in range(200)], "x double, ground_truth int")
    assert nested(tr.fit(dense_matrix(df, ["x"]), min_side=100)) == (1, 100, 100)
    assert nested(tr.fit(dense_matrix(df, ["x"]), min_side=99))[0] == "x"


def test_equal_features_tie_by_name(spark):
    df = spark.createDataFrame(
        [(float(i % 2), float(i % 2), i % 2) for i in range(40)], "z double, m double, ground_truth int"
    )
    assert nested(tr.fit(dense_matrix(df, ["z", "m"]), min_side=5))[0] == "m"


def test_null_features_are_zero_and_null_labels_are_dropped(spark):
    df = spark.createDataFrame(
        [(None, 0)] * 20 + [(2.0, 1)] * 20 + [(2.0, None)] * 5, "x double, ground_truth int"
    )
    tree = tr.fit(dense_matrix(df, ["x"]), min_side=5)
    assert nested(tree) == ("x", 1.0, (0, 20, 0), (1, 0, 20))
    assert {r["prediction"] for r in tr.predict(df.filter("x IS NULL"), tree).collect()} == {0}


@pytest.mark.parametrize("rows", [[(float("nan"), 0), (1.0, 1)], [(1.0, 2), (0.0, 0)]])
def test_bad_input_is_refused(spark, rows):
    with pytest.raises(ValueError):
        tr.fit(dense_matrix(spark.createDataFrame(rows, "x double, ground_truth int"), ["x"]))


def test_boundary_of_scoring(spark):
    df = spark.createDataFrame([(0.0, 0)] * 20 + [(2.0, 1)] * 20, "x double, ground_truth int")
    tree = tr.fit(dense_matrix(df, ["x"]), min_side=5)
    edge = spark.createDataFrame([(1.0,)], "x double")
    for options in ({}, {"case_nodes": 0}):
        assert tr.predict(edge, tree, **options).first()["prediction"] == 0
        assert tr.predict(edge, tree, boundary="ge", **options).first()["prediction"] == 1


def test_all_ways_of_scoring_agree(spark):
    rows = sample_rows(5)
    df = frame(spark, rows)
    matrix = dense_matrix(df, "abcd", keep=["id"])
    tree = tr.fit(matrix, max_depth=6, min_side=5)
    want = {r["id"]: r["prediction"] for r in tr.predict(df, tree, boundary="ge").collect()}
    joined = tr.predict(df, tree, boundary="ge", case_nodes=0, limit=0, walk_levels=2)
    salted = tr.predict(df, tree, boundary="ge", case_nodes=0, limit=0)
    places = tr.predict_matrix(matrix, tree, boundary="ge")
    place_joins = tr.predict_matrix(matrix, tree, boundary="ge", case_nodes=0)
    long = df.unpivot(["id"], ["a", "b", "c", "d"], "term", "tfidf")
    sparse = sparse_matrix(long, df.select("id", F.col("ground_truth").alias("y")), "id")
    for scored in (
        joined,
        salted,
        places,
        place_joins,
        tr.predict_matrix(sparse, tree, boundary="ge"),
        tr.predict_matrix(sparse, tree, boundary="ge", case_nodes=0),
    ):
        assert {r["id"]: r["prediction"] for r in scored.collect()} == want
    assert joined.columns == [*df.columns, "prediction"]
    # leaves hold exactly the rows that training sent there
    leaves = tree.filter("feature IS NULL").agg(F.sum("n0"), F.sum("n1")).first()
    assert sum(leaves) == len(rows)


def test_save_load_and_rules(spark, tmp_path):
    rows = sample_rows(6)
    tree = tr.fit(dense_matrix(frame(spark, rows), "abcd"), max_depth=4, min_side=10)
    tr.save(tree, str(tmp_path / "tree"))
    assert nested(tr.load(spark, str(tmp_path / "tree"))) == nested(tree)
    df = frame(spark, rows)
    for rule in tr.rules(tree, plan_levels=2).collect():
        counts = df.filter(rule["rule"] or "true").groupBy().agg(F.count("*"), F.sum("ground_truth")).first()
        assert (counts[0] - counts[1], counts[1]) == (rule["n0"], rule["n1"])


def test_midpoint_that_rounds_onto_a_value(spark):
    a = 1.0
    b = math.nextafter(a, 2.0)
    hist = spark.createDataFrame(
        [(1, 0, a, 3, 1), (1, 0, b, 1, 3), (1, 0, 5.0, 2, 2)],
        "node_id long, feature int, value double, n0 long, n1 long",
    )
    for left in (sp.left_counts(hist), sp.left_counts_ranged(hist, 1)):
        for r in left.collect():
            below = [(n0, n1) for v, n0, n1 in ((a, 3, 1), (b, 1, 3), (5.0, 2, 2)) if v < r["split"]]
            assert (r["l0"], r["l1"]) == tuple(map(sum, zip(*below)) if below else (0, 0))


def test_infinite_values_give_no_infinite_split(spark):
    hist = spark.createDataFrame(
        [(1, 0, 0.0, 1, 0), (1, 0, 2.0, 0, 1), (1, 0, float("inf"), 1, 1)],
        "node_id long, feature int, value double, n0 long, n1 long",
    )
    assert [r["split"] for r in sp.left_counts(hist).collect()] == [1.0]


def test_scoring_and_cleaning_take_a_stream(spark, tmp_path):
    from textree.operators.text import clean

    df = spark.createDataFrame([(0.0, 0, "A 1!")] * 20 + [(2.0, 1, "B")] * 20, "x double, ground_truth int, t string")
    tree = tr.fit(dense_matrix(df, ["x"]), min_side=5)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    scored = clean(tr.predict(stream, tree), "t", drop_duplicates=False)
    query = scored.writeStream.format("memory").queryName("scored").start()
    query.processAllAvailable()
    query.stop()
    rows = spark.table("scored").groupBy("ground_truth", "prediction", "cleaned_t").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 0, "a ", 20), (1, 1, "b", 20)]


def deep_tree(spark, feature="b"):
    """511 nodes over one feature: splits halve 0..256, leaves alternate."""
    nodes = []
    for number in range(1, 512):
        depth = number.bit_length() - 1
        first = (number - (1 << depth)) * (256 >> depth)
        leaf = depth == 8
        nodes.append(
            (number, depth, None if leaf else feature, None if leaf else first + (128 >> depth) - 0.5,
             None if leaf else 2 * number, None if leaf else 2 * number + 1, first % 2 if leaf else None, 1, 1)
        )
    return spark.createDataFrame(
        nodes, "node_id long, depth int, feature string, split double, left_id long, right_id long, label int, n0 long, n1 long"
    )


WAYS = [{"case_nodes": 1000}, {}, {"case_nodes": 0, "limit": 0, "walk_levels": 3}, {"case_nodes": 0, "limit": 0, "walk_levels": 1}]


@pytest.mark.parametrize("way", WAYS)
def test_scoring_is_the_same_for_every_size_of_tree(spark, way):
    tree = deep_tree(spark)
    df = spark.createDataFrame(
        [(float(i), i, i + 1, i + 2, i + 3, "x") for i in range(256)], "B double, split int, left_id int, _node int, _row int, _x string"
    )
    got = tr.predict(df, tree, **way)
    assert got.columns == [*df.columns, "prediction"]
    assert sorted(map(tuple, got.collect())) == [(float(i), i, i + 1, i + 2, i + 3, "x", i % 2) for i in range(256)]
    with pytest.raises(ValueError, match="b"):
        tr.predict(df.drop("B"), tree, **way)
    odd = spark.createDataFrame([(None,), (float("nan"),)], "b double")
    assert sorted(r["prediction"] for r in tr.predict(odd, tree, **way).collect()) == [0, 1]


@pytest.mark.parametrize("way", WAYS[:2])
def test_a_stream_is_scored_by_large_trees_too(spark, tmp_path, way):
    path = str(tmp_path / "in")
    spark.createDataFrame([(float(i),) for i in range(256)], "b double").write.parquet(path)
    stream = spark.readStream.schema("b double").parquet(path)
    run = tr.predict(stream, deep_tree(spark), **way).writeStream.format("memory").queryName("scored_stream").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(map(tuple, spark.table("scored_stream").collect())) == [(float(i), i % 2) for i in range(256)]


def test_nested_columns_count_with_their_content(spark):
    from textree.operators.joins import size_in_bytes

    df = spark.range(10).selectExpr("id", "array_repeat(repeat('x', 1000), 1000) AS a", "map('k', repeat('y', 500)) AS m", "struct(id AS i) AS s")
    assert size_in_bytes(df) > 10_000_000
    assert size_in_bytes(spark.createDataFrame([(bytes(5000), None)], "b binary, n array<array<int>>")) > 5000
    with pytest.raises(ValueError):
        size_in_bytes(spark.sql("SELECT INTERVAL '1' MONTH AS i"))


def test_a_tree_of_a_hundred_levels_takes_twenty_joins(spark, monkeypatch):
    """A chain with a leaf at every level, and bushy ends, walked in subtrees of five levels."""
    rng = random.Random(8)
    nodes, at, serial = [], 1, 2
    for depth in range(100):
        left, right = serial, serial + 1
        serial += 2
        nodes.append((at, None, depth, rng.choice("ab"), rng.random(), left, right, None))
        on, off = (left, right) if rng.random() < 0.5 else (right, left)
        nodes.append((off, at, depth + 1, None, None, None, None, depth % 2))
        at = on
    nodes.append((at, None, 100, None, None, None, None, 1))
    parent = {c: n[0] for n in nodes for c in (n[5], n[6]) if c}
    nodes = [(n[0], parent.get(n[0]), *n[2:], 0, 0) for n in nodes]
    tree = spark.createDataFrame(nodes, "node_id long, parent_id long, depth int, feature string, split double, left_id long, right_id long, label int, n0 long, n1 long")
    df = spark.createDataFrame([(i, rng.random(), rng.random()) for i in range(500)], "id int, a double, b double")
    want = {r["id"]: r["prediction"] for r in tr.predict(df, tree, case_nodes=0).collect()}
    joins = []
    real = tr.join_small
    monkeypatch.setattr(tr, "join_small", lambda *args, **options: joins.append(1) or real(*args, **options))
    got = {r["id"]: r["prediction"] for r in tr.predict(df, tree, case_nodes=0, limit=0).collect()}
    assert got == want and len(joins) == 21  # levels 0 to 100
