import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plain_porter import stem
from textree.functions.stopwords import ENGLISH
from textree.operators import features as ft
from textree.operators import text as tx
from textree.operators.joins import join_small, size_in_bytes
from textree.plans.tfidf import tfidf_table

WORDS = "apple berry cherry date elder fig grape holly iris jasmine running runs ran the of".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))) for i in range(60)]
    return spark.createDataFrame([*rows, (60, "   "), (61, None)], "id int, text string").cache()


def test_tfidf_equals_spark_ml(spark, docs):
    arrays = tx.tokenize(docs.filter("trim(text) != ''"), "text", "words")
    model = CountVectorizer(inputCol="words", outputCol="tf").fit(arrays)
    counted = model.transform(arrays)
    scored = IDF(inputCol="tf", outputCol="v").fit(counted).transform(counted)
    arr = {r["id"]: r["a"] for r in scored.select("id", vector_to_array("v").alias("a")).collect()}
    made = tfidf_table(docs, "id", "text", stop_words=None, stemming=False)
    assert made.n_docs == arrays.count()
    got = {(r["id"], r["term"]): r["tfidf"] for r in made.values.collect()}
    for doc, values in arr.items():
        for term, value in zip(model.vocabulary, values):
            assert math.isclose(got.get((doc, term), 0.0), value, abs_tol=1e-12)
    assert sorted(made.vocabulary.toPandas()["term"]) == sorted(model.vocabulary)


@pytest.mark.parametrize("limit", [0, 10**9])
@pytest.mark.parametrize("size", [4, 500])
def test_tfidf_with_stems_against_brute_force(docs, size, limit):
    made = tfidf_table(docs, "id", "text", size, limit=limit)
    bags = {
        r["id"]: Counter(stem(w) for w in r["text"].split() if w not in ENGLISH)
        for r in docs.collect()
        if (r["text"] or "").strip()
    }
    totals = sum(bags.values(), Counter())
    top = sorted(totals, key=lambda w: (-totals[w], w))[:size]
    assert [r["term"] for r in made.vocabulary.orderBy("term_idx").collect()] == top
    want = {}
    for doc, bag in bags.items():
        for term in set(bag) & set(top):
            df = sum(term in b for b in bags.values())
            want[doc, term] = bag[term] * math.log((len(bags) + 1) / (df + 1))
    got = {(r["id"], r["term"]): r["tfidf"] for r in made.values.collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


def test_melt_and_wide_are_inverse(spark):
    rows = [(i, float(i), i / 3, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, a double, `b c` double, ground_truth int")
    long = ft.melt(df, ["id"], ["a", "b c"]).withColumnsRenamed({"feature": "term", "value": "tfidf"})
    back = ft.to_wide(long.filter("tfidf != 0"), df, ["a", "b c"], "id", digits=None)
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect())) == rows


def test_wide_rounds_half_up(spark):
    values = spark.createDataFrame([(1, "w", 0.000005)], "id int, term string, tfidf double")
    rows = spark.createDataFrame([(1, 0), (2, 1)], "id int, ground_truth int")
    out = {r["id"]: r["w"] for r in ft.to_wide(values, rows, ["w"], "id").collect()}
    assert out == {1: 0.00001, 2: 0.0}


@pytest.mark.parametrize("terms", [["The", "the"], ["ground_truth"], ["index"], ["a", "a"]])
def test_wide_refuses_clashing_names(terms):
    with pytest.raises(ValueError):
        ft.check_column_names(terms)


@pytest.mark.parametrize("order", [[], ["v"]])
def test_row_ids_are_consecutive(spark, order):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    rows = ft.add_row_id(df, order).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(1, 1001))
    if order:
        assert all(r["row_id"] == r["v"] + 1 for r in rows)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, how):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id int, k string")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("none", 3)], "k string, v int")
    ways = [join_small(big, small, ["k"], how, limit=limit) for limit in (0, 10**9)]
    assert ways[0].columns == ways[1].columns
    assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].collect()))
    assert size_in_bytes(small) > 0


def test_take_columns_and_slice(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert ft.take_columns(df, 2).columns == ["a", "b", "d"]
    arr = spark.createDataFrame([([5.0, 6.0, 7.0],)], "v array<double>")
    assert ft.slice_array(arr, "v", [0, 2], "s").first()["s"] == [5.0, 7.0]


def test_wide_rows_travel_as_entries(spark):
    """A row of the pivot held a number for every column, in each task that met one of its values."""
    values = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.25), (1, "other", 9.0), (2, "b", None), (3, "a", 1.0), (None, "a", 7.0), (1, None, 8.0)], "id int, term string, tfidf double")
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (4, 0), (None, 1)], "id int, ground_truth int")
    wide = ft.to_wide(values, rows, ["a", "b"], "id")
    assert wide.columns == ["id", "a", "b", "ground_truth"]
    want = [(1, 0.25, 0.5, 0), (1, 0.25, 0.5, 1), (2, 0.0, 0.0, 1), (4, 0.0, 0.0, 0), (None, 0.0, 0.0, 1)]
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(want, key=str)
    assert "pivotfirst" not in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    assert ft.to_wide(values.unionAll(values), rows, ["a", "b"], "id").count() == 5
