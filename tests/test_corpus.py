import pytest

from textree.operators import corpus as cp


def titles(df):
    return sorted((r["title"], r["ground_truth"]) for r in df.collect())


def test_label_variants(spark):
    values = ["fake", "FAKE", "Fake", "1", " 1 ", "1.0", "1.7", "01", "+1", "1e0", "real", "0", None, "2"]
    df = spark.createDataFrame([(v,) for v in values], "label string")
    kept = {r["ground_truth"] for r in cp.filter_rows(df).collect()}
    assert kept == {"fake", "FAKE", "1", " 1 ", "1.0", "1.7", "01", "+1"}


@pytest.mark.parametrize("name", ["label", "Label", "Ground Label"])
def test_numeric_label_columns(spark, name):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (None, "c")], f"`{name}` int, title string")
    out = cp.filter_rows(df)
    assert out.columns == ["ground_truth", "title"]
    assert [r["title"] for r in out.collect()] == ["a"]


def test_language_and_other_columns(spark):
    df = spark.createDataFrame([("english", "a"), ("German", "b"), (None, "c")], "language string, LABEL string")
    out = cp.filter_rows(df)
    assert out.columns == ["language", "LABEL"]
    assert out.count() == 1


def test_sentences_trim_and_blank(spark):
    df = spark.createDataFrame([("One.  Two . . ..",), (None,), ("",)], "text string")
    assert titles(cp.sentences(df)) == [("One", 1), ("Two", 1)]


def test_harmonize_keeps_sentence_copies_but_not_title_copies(spark):
    df = spark.createDataFrame([("A. A", "T"), ("B", "T"), ("B", None)], "text string, head string")
    out = cp.harmonize(df, "head", label=0)
    assert titles(out) == [("A", 1), ("A", 1), ("B", 1), ("B", 1), ("T", 0)]
    assert dict(out.dtypes) == {"title": "string", "ground_truth": "int"}


def test_text_as_title_gives_whole_texts_and_sentences(spark):
    df = spark.createDataFrame([("A. B",)], "text string")
    assert titles(cp.harmonize(df, "text")) == [("A", 1), ("A. B", 1), ("B", 1)]


def test_build_corpus_removes_copies_across_sources(spark):
    a = spark.createDataFrame([("x",), ("y",)], "head string")
    b = spark.createDataFrame([("x",), ("x",)], "line string")
    out = cp.build_corpus([cp.Source("a", a, "head", 0), cp.Source("b", b, "line"), cp.Source("c", a, "head")])
    assert titles(out) == [("x", 0), ("x", 1), ("y", 0), ("y", 1)]


def test_violations(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "b")], "ground_truth int, src string")
    out = {(r["src"], r["ground_truth"], r["n_rows"]) for r in cp.label_violations(df, by=["src"]).collect()}
    assert out == {("a", 2, 1), ("b", 2, 1)}


def test_dedup_by_column_keeps_one_whole_row(spark):
    df = spark.createDataFrame([(2, "k", "b"), (1, "k", "z"), (3, "m", "c")], "id int, key string, v string")
    out = cp.dedup(df, ["key"])
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "k", "z"), (3, "m", "c")]
