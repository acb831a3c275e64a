"""From CSV sources to rules, as in the README."""

from textree import sources
from textree.operators import corpus, features
from textree.plans import tfidf, tree


def test_sources_to_rules(spark, tmp_path):
    real = spark.createDataFrame([(f"Parliament voted on budget number {i} today",) for i in range(60)], "headline string")
    odd = [(f"Aliens dance in town {i}", f"They came. Nobody saw {'x' * i}.", "FAKE") for i in range(60)]
    sources.write_csv(real, str(tmp_path / "a"))
    sources.write_csv(spark.createDataFrame(odd, "title string, text string, label string"), str(tmp_path / "b"))
    titles = corpus.build_corpus(
        [
            corpus.Source("a", sources.read_csv(spark, str(tmp_path / "a")), "headline", 0),
            corpus.Source("b", sources.read_csv(spark, str(tmp_path / "b")), "title", 1),
        ]
    )
    assert titles.dtypes == [("title", "string"), ("ground_truth", "int")]
    docs = sources.materialize(features.add_row_id(titles, ["title", "ground_truth"], "doc_id"))
    # 60 headlines, 60 titles, 60 distinct second sentences and one "They came"
    assert docs.count() == 181
    made = tfidf.tfidf_table(docs, "doc_id", "title", vocab_size=20)
    assert made.n_docs == 181
    rows = features.sparse_matrix(made.values, docs.selectExpr("doc_id", "ground_truth AS y"), "doc_id")
    model = tree.fit(rows, min_side=20)
    scored = tree.predict_matrix(rows, model)
    assert scored.filter("prediction != y").isEmpty()
    assert tree.rules(model).count() == 2
