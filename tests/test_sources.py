import gzip
import json
from collections import Counter
from types import SimpleNamespace

import pytest

from textree import sources as src
from textree import storage
from textree.operators.features import dense_matrix
from textree.plans import tfidf, tree
from textree.sources import json as json_source

NASTY = [
    ('He said "hi", then left', "a"),
    ("two\nlines", "b"),
    ("  kept blanks  ", "c"),
    ("", "d"),
    (None, "e"),
    ("comma, quote \"\" end", "f"),
]


@pytest.mark.parametrize("single", [True, False])
def test_csv_keeps_texts_whole(spark, tmp_path, single):
    df = spark.createDataFrame(NASTY, "title string, key string")
    src.write_csv(df, str(tmp_path / "t"), single_file=single)
    back = src.read_csv(spark, str(tmp_path / "t"))
    assert set(dict(back.dtypes).values()) == {"string"}
    # an empty text comes back as NULL, as CSV scans have it
    want = {key: title or None for title, key in NASTY}
    assert {r["key"]: r["title"] for r in back.collect()} == want


def test_feature_csv_types_by_name(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, 2.0, 1), (2, 0.0, 1.5, 0)], "Index int, apple double, `the` double, ground_truth int")
    src.write_csv(df, str(tmp_path / "f"))
    back = src.read_feature_csv(spark, str(tmp_path / "f"))
    assert back.dtypes == [("Index", "int"), ("apple", "double"), ("the", "double"), ("ground_truth", "int")]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_strict_feature_csv_refuses_what_does_not_fit(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.csv").write_text("Index,apple,ground_truth\n3000000000,0.5,1\n")
    assert src.read_feature_csv(spark, str(folder), strict=True, long_index=True).first()["Index"] == 3_000_000_000
    with pytest.raises(Exception):
        src.read_feature_csv(spark, str(folder), strict=True).collect()
    (folder / "b.csv").write_text("apple,Index,ground_truth\n0.5,1,1\n")
    with pytest.raises(Exception):
        src.read_feature_csv(spark, str(folder), strict=True, long_index=True).collect()


def test_jsonl(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"t": "a"}\n{"t": "a"}\n{"t": null}\n{"t": "b"}\n')
    rows = src.read_jsonl(spark, str(path)).collect()
    assert sorted((r["t"], r["label"]) for r in rows) == [("a", 1), ("b", 1)]


def test_manifest_and_newest(spark, tmp_path):
    (tmp_path / "one.csv").write_text("12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "two.csv").write_text("123")
    files = src.file_manifest(spark, str(tmp_path), "*.csv")
    assert sorted(r["length"] for r in files.collect()) == [3, 5]
    assert src.file_present(files, "one.csv") and not src.file_present(files, "three.csv")
    assert src.newest(files).first()["length"] in (3, 5)


def test_store_and_release(spark):
    kept = storage.store(spark.range(10))
    assert kept.df.count() == 10
    kept.release()
    assert not storage_has(spark, kept.path)


def storage_has(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_dir(FakeSession({"spark.checkpoint.dir": "/shared"}, None, "yarn")) == "/shared"
    assert storage.shared_dir(FakeSession({}, "/set-by-hand", "yarn")) == "/set-by-hand"
    with pytest.raises(RuntimeError):
        storage.shared_dir(FakeSession({}, None, "yarn"))
    with pytest.raises(RuntimeError):
        storage.shared_dir(FakeSession({}, None, "local-cluster[3,2,1024]"))
    assert storage.shared_dir(spark)


def test_runs_take_their_key_from_the_last_folders(spark, tmp_path):
    report = '{"Accuracy": 0.5, "Precision": 0.25, "Execution Time": "12", "Job Time": 60000}'
    for path in ("result9/instances2cores3/result100.json", "old-sequential/instances4cores1/result250/part-0.json", "sequential/result25.json"):
        file = tmp_path / "runs" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(report + "\n")
    (tmp_path / "runs" / "notes.json").write_text(report + "\n")
    (tmp_path / "runs" / "instances2cores3" ).mkdir()
    (tmp_path / "runs" / "instances2cores3" / "result50.json").write_text(report + "\n{broken\n")
    rows = src.read_runs(spark, str(tmp_path / "runs")).collect()
    assert sorted((r["instances"], r["cores"], r["n_columns"]) for r in rows) == [(0, 0, 25), (2, 3, 50), (2, 3, 100), (4, 1, 250)]
    assert {r["fit_ms"] for r in rows} == {12.0}
    left = src.unread_runs(spark, str(tmp_path / "runs")).collect()
    assert sorted((r["reason"], r["n_records"]) for r in left) == [("path", 1), ("record", 1)]


def test_paths_of_runs_are_taken_apart_once_a_file(spark, tmp_path):
    """Each record went through five patterns on its path and was parsed twice."""
    folder = tmp_path / "runs" / "instances2cores3" / "result50"
    folder.mkdir(parents=True)
    lines = ['{"Accuracy": 0.5, "Precision": 0.25, "Execution Time": "12"}', '{"Accuracy": "no number", "Precision": 0.25}', "{broken"]
    (folder / "part-0.json").write_text("\n".join(lines * 3) + "\n")
    found = src.read_runs(spark, str(tmp_path / "runs"))
    got = sorted(found.select("instances", "cores", "n_columns", "area_under_roc", "area_under_pr").collect(), key=str)
    assert got == sorted([(2, 3, 50, 0.5, 0.25)] * 3 + [(2, 3, 50, None, 0.25)] * 3, key=str)
    left = src.unread_runs(spark, str(tmp_path / "runs")).collect()
    assert [(r["reason"], r["n_records"]) for r in left] == [("record", 3)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "cores(" not in plan and plan.count("from_json(StructField(Accuracy") == 1


def test_reports_in_any_layout(spark, tmp_path, monkeypatch):
    report = {"Accuracy": 0.5, "Precision": 0.25, "Execution Time": "12", "Job Time": 60000}
    texts = {
        10: json.dumps(report, indent=4),
        20: "\r\n\r\n" + json.dumps(report, indent=2).replace("\n", "\r\n") + "\r\n",
        30: json.dumps(report) + "\n" + json.dumps(report),
        40: json.dumps(report, indent=4)[:-3],
        50: "  \n",
        60: json.dumps(report) + "\n" + json.dumps(report, indent=1),
        70: "".join(json.dumps(report) + "\n" for _ in range(50)),
    }
    for width, text in texts.items():
        file = tmp_path / "runs" / "instances2cores3" / f"result{width}.json"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(text.encode())
    with gzip.open(tmp_path / "runs" / "instances2cores3" / "result80.json.gz", "wt") as out:
        out.write(texts[10])
    for limit in (json_source.REPORT_BYTES, 1000):  # the file of 50 lines is read whole, then line by line
        monkeypatch.setattr(json_source, "REPORT_BYTES", limit)
        found = Counter(r["n_columns"] for r in src.read_runs(spark, str(tmp_path / "runs")).collect())
        assert found == {10: 1, 20: 1, 30: 2, 60: 1, 70: 50}
        assert all(r["fit_ms"] == 12.0 for r in src.read_runs(spark, str(tmp_path / "runs")).collect())
        left = {r["path"].rsplit("/", 1)[-1]: (r["reason"], r["n_records"]) for r in src.unread_runs(spark, str(tmp_path / "runs")).collect()}
        assert left == {"result40.json": ("record", 1), "result60.json": ("record", 6), "result80.json.gz": ("path", 1)}


def test_the_layout_of_a_report_does_not_hang_on_its_size(spark, tmp_path):
    """Files beyond 1 MB were read by lines alone, so a large report over several lines was lost."""
    report = {"Accuracy": 0.5, "Precision": 0.25, "Execution Time": "12", "notes": ["x" * 90] * 15_000}
    one = json.dumps({"Accuracy": 0.5, "Precision": 0.25, "Execution Time": "12"})
    texts = {
        10: json.dumps(report, indent=1),
        20: json.dumps(report, indent=1)[:-3],
        30: "{broken\n" * 200_000 + one + "\n",
        40: json.dumps(report, indent=1).replace("\n", "\r\n"),
        50: "\ufeff" + one + "\n" + one,
        60: json.dumps(report),
    }
    for width, text in texts.items():
        folder = tmp_path / "runs" / "instances2cores3"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"result{width}.json").write_bytes(text.encode())
    assert sum(len(t) > json_source.REPORT_BYTES for t in texts.values()) == 5
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")  # a file in several tasks keeps its order
    try:
        rows = src.read_runs(spark, str(tmp_path / "runs")).collect()
        left = {r["path"].rsplit("/", 1)[-1]: (r["reason"], r["n_records"]) for r in src.unread_runs(spark, str(tmp_path / "runs")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert Counter(r["n_columns"] for r in rows) == {10: 1, 30: 1, 40: 1, 50: 2, 60: 1}
    assert {(r["area_under_roc"], r["fit_ms"]) for r in rows} == {(0.5, 12.0)}
    assert left == {"result20.json": ("record", 1), "result30.json": ("record", 200_000)}


def folders(spark):
    root = storage.shared_dir(spark)
    listed = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(spark._jvm.org.apache.hadoop.fs.Path(root))
    return {f.getPath().getName() for f in listed}


def test_scope_owns_what_is_stored_inside(spark):
    before = folders(spark)
    with storage.scope() as outer:
        with storage.scope() as inner:
            kept, gone = storage.store(spark.range(5), "kept"), storage.store(spark.range(6), "gone")
            joined = kept.df.join(spark.range(3), "id").groupBy("id").count()
            inner.keep(joined)
        assert joined.count() == 3
        assert not storage_has(spark, gone.path) and storage_has(spark, kept.path)
    assert folders(spark) == before and not outer.made
    with pytest.raises(ZeroDivisionError), storage.scope() as failing:
        failing.keep(storage.store(spark.range(5)).df)
        1 / 0  # noqa: B018
    with storage.scope() as alone:
        alone.keep(storage.store(spark.range(5)).df)
    assert len(folders(spark) - before) == 1
    alone.release()
    assert folders(spark) == before


def test_no_folder_is_left_by_plans_in_a_scope(spark):
    before = folders(spark)
    docs = spark.createDataFrame([(i, f"apple berry {'cherry ' * (i % 3)} w{i % 7}") for i in range(60)], "id long, title string")
    rows = spark.createDataFrame([(i, [float(i % 11), float(i % 5)], int(i % 11 > 4)) for i in range(400)], "id long, x array<double>, y int")
    with storage.scope() as kept:
        made = tfidf.tfidf_table(docs, "id", "title", limit=0)
        model = tree.fit(tree_rows(rows), min_side=5)
        kept.keep(model)
        assert made.values.count() and tree.rules(model).count()
    assert model.count() > 1
    kept.release()
    assert folders(spark) == before


def tree_rows(rows):
    return dense_matrix(rows.selectExpr("x[0] AS a", "x[1] AS b", "y"), ["a", "b"], "y")


class FakeSession:
    def __init__(self, conf, folder, master):
        self.conf = conf
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: folder, master=master)
