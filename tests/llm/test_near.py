"""Similarity joins, components and neighbour search against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from textree.llm import grid_order_join, jaccard_join, posting_lists
from textree.llm.components import components


def plain_components(nodes, links):
    label = {x: x for x in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(300)] + [(7, 7), (None, 3), (5, None)]
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(4)).df.collect()
    sound = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = plain_components({x for e in sound for x in e}, sound)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).df.count() == 0


def plain_sets(text, words):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    size = min(words, len(parts))
    return frozenset(tuple(parts[i : i + size]) for i in range(len(parts) - size + 1))


def plain_links(rows, rule):
    sets = {i: plain_sets(x, rule.words) for i, x in rows}
    where = defaultdict(list)
    for i, s in sets.items():
        for gram in s:
            where[gram].append(i)
    near = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b])]
    return sets, plain_components(sets, links), links


def near_texts():
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(3000)}"
    passage = [word() for _ in range(60)]
    rows, number = [], 0
    for size in (1, 1, 1, 2, 3, 5, 40, 90):
        base = [word() for _ in range(draw.randrange(40, 160))]
        if size > 3:
            base += passage
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(5)):  # more changes drift out of reach of some copies, not of others
                copy[draw.randrange(len(copy))] = word()
            rows.append((number, " ".join(copy)))
            number += 1
    rows += [(500 + i, " ".join([word() for _ in range(30)] + passage)) for i in range(40)]
    rows += [(600, None), (601, ""), (602, " \n\t"), (603, "one two"), (604, "ONE\ttwo"), (605, "two one"), (606, "É é"), (607, "é é")]
    rows += [(608, rows[0][1].upper()), (609, " ".join(word() for _ in range(20000)))]
    return rows


@pytest.mark.parametrize("rule", [jaccard_join.Rule(4, 85), jaccard_join.Rule(5, 80)])
def test_jaccard_components_match_brute_force(spark, rule):
    rows = near_texts()
    sets, want, links = plain_links(rows, rule)
    assert len(links) > 500
    docs = spark.createDataFrame([(i, x, "t") for i, x in rows], "doc_id long, text string, token string").repartition(5)
    got = jaccard_join.link_documents(docs, rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_prefixes_of_similar_sets_share_the_smaller_number_of_matches():
    draw = np.random.default_rng(2)
    rule = jaccard_join.Rule(5, 80)
    excess = draw.choice([0.0, 50.0], jaccard_join.BUCKETS)
    for _ in range(200):
        n = int(draw.integers(1, 120))
        a = draw.integers(0, 2**63, n).astype(np.uint64)
        b = np.r_[a[: n - n // 10], draw.integers(0, 2**63, n // 12).astype(np.uint64)]
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both < rule.percent * (len(a) + len(b) - both):
            continue
        x, y = jaccard_join.prefix(a, excess, rule), jaccard_join.prefix(b, excess, rule)
        asked = min(x[2], y[2])
        assert len(np.intersect1d(x[0][x[1] <= asked], y[0][y[1] <= asked])) >= asked
        assert jaccard_join.profiles_allow(jaccard_join.profile(a), jaccard_join.profile(b), rule.percent)
        odd_a, odd_b = ([x[0].as_py() for x in jaccard_join.parities(pa.array([jaccard_join.profile(s)]))] for s in (a, b))
        differ = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(odd_a, odd_b, strict=True))
        assert differ <= len(a) + len(b) - 2 * both <= (100 - rule.percent) * (len(a) + len(b)) // (100 + rule.percent)


def test_parities_tell_unlike_sets_apart_and_pass_over_sets_without_a_profile():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**64, 150, dtype=np.uint64)) for _ in range(2)]
    words = [x.to_pylist() for x in jaccard_join.parities(pa.array([jaccard_join.profile(s) for s in sets] + [None], pa.binary()))]
    assert sum(((x[0] ^ x[1]) & (2**64 - 1)).bit_count() for x in words) > 15 * 300 // 185
    assert [x[2] for x in words] == [None] * 4
    assert [len(x) for x in jaccard_join.parities(pa.array([], pa.binary()))] == [0] * 4


def test_chains_of_near_copies_match_brute_force(spark):
    """Copies that drift out of each other's reach around a text that is not there: many pairs, few links."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(160):
        copy = list(base)
        for _ in range(draw.randrange(1, 5)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(9000)}"
        rows.append((i, " ".join(copy)))
    rule = jaccard_join.Rule(4, 85)
    sets, want, links = plain_links(rows, rule)
    assert 50 < len(links) < 160 * 159 // 4 and len(set(want.values())) > 10
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_of_repeated_rows_null_ids_and_nothing(spark):
    schema = "doc_id long, text string"
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text), (3, text), (None, text), (4, "other words here now and then"), (None, None)]
    got = jaccard_join.link_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 3), (3, 3), (3, 3), (4, 4)]
    assert jaccard_join.link_documents(spark.createDataFrame([], schema)).count() == 0


def vectors(n=900, d=24):
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(n, d))
    rows[100:400] = rows[0] + 0.16 * draw.normal(size=(300, d))
    rows[400:420] = rows[1]
    rows[420:430] = rows[2] * np.linspace(0.5, 3, 10)[:, None]
    return rows


def vector_frame(spark, rows, kind="double"):
    odd = [(-1, None), (-2, [0.0] * rows.shape[1]), (-3, [float("nan")] * rows.shape[1]), (-4, [None] + [1.0] * (rows.shape[1] - 1)), (-5, [])]
    data = [(i, [float(v) for v in x]) for i, x in enumerate(rows)] + odd
    return spark.createDataFrame([(i, x, "v") for i, x in data], f"vec_id long, embedding array<{kind}>, digest string").repartition(4)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_grid_join_matches_brute_force(spark, kind):
    rows = vectors()
    if kind == "float":
        rows = rows.astype(np.float32).astype(float)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    want = plain_components(range(len(rows)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked), strict=True) if a < b])
    got = grid_order_join.near_duplicates(vector_frame(spark, rows, kind), leading=6, block=64).collect()
    assert len(got) == len(rows) + 5
    for r in got:
        if r.vec_id < 0:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (linked[r.vec_id].sum(), want[r.vec_id], want[r.vec_id] == r.vec_id)


def test_grid_join_descends_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(grid_order_join, "FAN_OUT", 2)
    rows = vectors(500)
    got = grid_order_join.near_duplicates(vector_frame(spark, rows), leading=4, block=16)
    one = grid_order_join.near_duplicates(vector_frame(spark, rows), leading=4, block=4096)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, one.collect()))


def test_grid_join_of_nothing(spark):
    assert grid_order_join.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    rows = spark.createDataFrame([(1, None), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = grid_order_join.near_duplicates(rows).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in got) == [(0, 0), (1, 0), (1, 1), (1, 1)]


def test_posting_lists_recall_scores_and_ties(spark):
    rows = vectors(1500)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    settings = posting_lists.Settings(list_size=64, chunk=100)
    got = posting_lists.nearest(vector_frame(spark, rows), k=5, settings=settings).collect()
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query[r.query_id].append(r)
    assert set(by_query) == set(range(0, 1500, 50))
    hits = 0
    for q, found in by_query.items():
        scores = units @ units[q]
        order = [i for i in np.lexsort((np.arange(len(rows)), -np.round(scores, 12))) if i != q][:5]
        assert [r.rank for r in found] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in found], [scores[r.vec_id] for r in found], atol=1e-12)
        hits += len({r.vec_id for r in found} & {int(i) for i in order})
    assert hits >= 0.9 * 5 * len(by_query)
    assert [r.vec_id for r in by_query[400]] == [1, 401, 402, 403, 404]


def test_posting_lists_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    got = posting_lists.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (50, [0.0, 2.0])], schema)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert posting_lists.nearest(spark.createDataFrame([], schema)).count() == 0
    assert posting_lists.nearest(spark.createDataFrame([(50, [1.0])], schema)).count() == 0
