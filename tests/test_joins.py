"""Joins with heavy keys, the exact sample and the one-scan corpus."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from textree.operators import corpus, joins
from textree.operators import sample as sm


def test_a_key_with_half_of_the_rows_is_cut(spark):
    rows = [("hot" if i % 2 else f"k{i % 97}", i) for i in range(40_000)]
    big = spark.createDataFrame(rows, "k string, v long").repartition(6)
    small = spark.createDataFrame([(k, len(k)) for k in {k for k, _ in rows} | {"alone"}], "k string, n long")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        heavy = {r["k"]: r["_parts"] for r in joins.heavy_keys(big, ["k"]).collect()}
        assert heavy == {"hot": 64}
        for how in ("inner", "left"):
            met = joins.join_small(big, small, ["k"], how, ["v"], limit=0)
            sizes = [r["n"] for r in met.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(sizes) == len(rows) and max(sizes) < 3 * statistics.median(sizes)
            assert met.columns == ["k", "v", "n"]
            assert met.filter("n != length(k)").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_heavy_join_with_null_and_missing_keys(spark):
    big = spark.createDataFrame([(None, 1)] * 50 + [("a", 2)] * 50 + [("b", 3)], "k string, v int")
    small = spark.createDataFrame([("a", 10), (None, 11), ("c", 12)], "k string, w int")
    got = joins.join_small(big, small, ["k"], "left", limit=0).groupBy("k", "w").count().collect()
    assert {(r["k"], r["w"], r["count"]) for r in got} == {(None, None, 50), ("a", 10, 50), ("b", None, 1)}
    assert joins.join_small(big.limit(0), small, ["k"], limit=0).count() == 0


@pytest.mark.parametrize("n0, n1", [(5000, 1700), (3, 2), (1, 900)])
def test_exact_sample_has_exact_sizes(spark, n0, n1):
    df = spark.createDataFrame([(i, int(i >= n0)) for i in range(n0 + n1)] + [(10**6, None), (10**6 + 1, 7)], "id long, y int")
    train, test = sm.train_test_exact(df, ["id"])
    k = min(n0, n1) * 8 // 10
    digest = {i: hashlib.md5(f"42|{i}".encode()).hexdigest() for i in range(n0 + n1)}
    want = set(sorted(range(n0), key=digest.get)[:k]) | set(sorted(range(n0, n0 + n1), key=digest.get)[:k])
    assert {r["id"] for r in train.collect()} == want
    assert test.count() == n0 + n1 + 2 - len(want)


def test_exact_sample_of_repeated_ids_never_exceeds(spark):
    df = spark.createDataFrame([(i // 3, i % 2) for i in range(600)], "id long, y int")
    drawn = {r["y"]: r["count"] for r in sm.balanced_exact(df, ["id"]).groupBy("y").count().collect()}
    assert all(232 <= n <= 240 for n in drawn.values()) and len(drawn) == 2
    with pytest.raises(ValueError):
        sm.balanced_exact(df.filter("y = 1"), ["id"])


def test_corpus_reads_each_source_once(spark, tmp_path):
    draw = random.Random(1)
    texts = ["One. Two . . Three", None, "", "One", " Four.", "Two"]
    rows = [(draw.choice(texts), draw.choice([*texts, "T"]), draw.choice(["fake", "real"])) for _ in range(60)]
    spark.createDataFrame(rows, "text string, headline string, label string").write.parquet(f"{tmp_path}/s")
    source = spark.read.parquet(f"{tmp_path}/s")
    for column in ("headline", "text"):
        want = corpus.dedup(corpus.harmonize(source, column, 0, 1)).collect()
        made = corpus.build_corpus([corpus.Source("s", source, column, 0)], 1)
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want)) and made.columns == ["title", "ground_truth"]
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and plan.count("Aggregate [") == 1
