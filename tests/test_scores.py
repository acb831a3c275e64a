import json
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from textree import sources as src
from textree.operators import evaluate as ev
from textree.operators import runs as rn
from textree.operators import sample as sm
from textree.plans.experiment import train_and_score


@pytest.mark.parametrize("table", [(5, 2, 7, 3), (4, 6, 0, 0), (0, 0, 6, 4), (0, 3, 5, 2), (1, 0, 0, 9), (8, 0, 9, 0)])
def test_closed_forms_equal_the_evaluator(spark, table):
    tp, fp, tn, fn = table
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(0, 0)] * tn + [(1, 0)] * fn
    df = spark.createDataFrame(rows, "y int, prediction int")
    got = ev.metrics(ev.confusion(df)).first()
    assert (got["tp"], got["fp"], got["tn"], got["fn"]) == table
    assert got["accuracy"] == pytest.approx((tp + tn) / len(rows))
    doubles = df.select(F.col("y").cast("double"), F.col("prediction").cast("double"))
    for column, name in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="prediction", metricName=name)
        if tp + fn and fp + tn:
            assert got[column] == pytest.approx(evaluator.evaluate(doubles))


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(4000).selectExpr("id", "CAST(id % 5 = 0 AS INT) AS y", "CAST(id % 7 AS DOUBLE) AS v").cache()


def test_train_and_test_are_a_partition(table):
    train, test = sm.train_test(table, ["id"])
    ids = [r["id"] for part in (train, test) for r in part.collect()]
    assert sorted(ids) == list(range(4000))
    n = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    assert abs(n[0] - 640) < 100 and abs(n[1] - 640) < 60
    again = sm.balanced(table.repartition(3), ["id"])
    assert {r["id"] for r in again.collect()} == {r["id"] for r in train.collect()}
    other = sm.balanced(table, ["id"], salt="7")
    assert {r["id"] for r in other.collect()} != {r["id"] for r in train.collect()}


def test_one_class_cannot_be_balanced(table):
    with pytest.raises(ValueError):
        sm.fractions(table.filter("y = 1"))


def test_random_draw_and_its_rest(spark, table):
    rows = table.select("y", "v")
    train = src.materialize(sm.balanced_random(rows))
    rest = sm.rest_of(rows, train, copies=7)
    count = lambda df: Counter(map(tuple, df.collect()))
    assert count(train) + count(rest) == count(rows)
    assert count(rest) == count(rows.exceptAll(train))


def test_rest_keeps_null_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "x int, s string")
    taken = spark.createDataFrame([(None, "a"), (2, "b")], "x int, s string")
    assert sorted(map(str, sm.rest_of(df, taken).collect())) == sorted(map(str, df.exceptAll(taken).collect()))


def test_run_and_report(spark, table, tmp_path):
    df = table.withColumn("w", F.col("y") * 2.0 + F.col("v") / 10)
    run = train_and_score(df, ["v", "w"], ["id"], "y", min_side=50)
    path = str(tmp_path / "result100.json")
    src.write_report(run.report, path)
    files = src.file_manifest(spark, path, "*.json")
    assert files.count() == 1 and src.file_present(files, ".json")
    report = json.loads(spark.read.text(path).first()[0])
    assert report["Accuracy"] == 1.0 and report["Precision"] == 1.0
    assert set(report) == {"Accuracy", "Precision", "Execution Time", "Train Set", "Test Set"}
    train = report["Train Set"]
    assert train["num false"] + train["num true"] + report["Test Set"] == 4000


def test_runs_by_path(spark, tmp_path):
    for place, job in (
        ("instances1cores2/result100", 60000), ("instances2cores3/result100", "90000"),
        ("instances4cores3/result250", 120000), ("sequential/result100", 300000), ("sequential/result25", 30000),
        ("instances1cores3/result50", 45000),
    ):
        file = tmp_path / f"{place}.json"
        file.parent.mkdir(exist_ok=True)
        file.write_text(json.dumps({"Accuracy": 0.5, "Precision": 0.5, "Execution Time": "12", "Job Time": job}))
    runs = src.read_runs(spark, str(tmp_path))
    keys = {(r["instances"], r["cores"], r["n_columns"], r["job_ms"]) for r in runs.collect()}
    assert (2, 3, 100, 90000.0) in keys and (0, 0, 25, 30000.0) in keys and len(keys) == 6
    scaled = {(r["n_columns"], r["cores"], r["workers"]): r["job_minutes"] for r in rn.scaling(runs).collect()}
    assert scaled == {(100, 2, 1): 1.0, (100, 3, 2): 1.5, (250, 3, 4): 2.0, (100, 0, 1): 5.0, (25, 0, 1): 0.5, (50, 3, 1): 0.75}
    grown = {(r["workers"], r["n_columns"], r["job_minutes"]) for r in rn.growth(runs).collect()}
    assert grown == {(0, 25, 0.5), (1, 50, 0.75), (2, 100, 1.5), (4, 250, 2.0)}
    by_width = {(r["n_columns"], r["workers"]) for r in rn.scaling_by_width(runs).collect()}
    assert by_width == {(50, 1), (100, 2), (250, 4)}
    assert rn.scaling(runs, [250]).count() == 1 and rn.scaling_by_width(runs, skip=[50]).count() == 2
