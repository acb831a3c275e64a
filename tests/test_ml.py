from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from textree.ml import GainRatioTreeClassifier, GainRatioTreeModel, TextCleaner, TokenStemmer, VectorExpander


def test_stages_from_text_to_prediction(spark, tmp_path):
    rows = [(f"Cats running {i}, the cat!", 1) for i in range(30)] + [(f"Dogs slept @joe {i} x{'y' * i}", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "title string, ground_truth int")
    counts = CountVectorizer(inputCol="stems", outputCol="raw", vocabSize=20, minDF=2)
    front = Pipeline(
        stages=[
            TextCleaner(inputCol="title", outputCol="cleaned"),
            Tokenizer(inputCol="cleaned", outputCol="tokens"),
            StopWordsRemover(inputCol="tokens", outputCol="kept"),
            TokenStemmer(inputCol="kept", outputCol="stems"),
            counts,
            IDF(inputCol="raw", outputCol="features"),
        ]
    ).fit(df)
    vocabulary = front.stages[4].vocabulary
    assert {"cat", "run", "dog", "slept"} <= set(vocabulary)
    names = [w or "blank" for w in vocabulary]
    wide = VectorExpander(inputCol="features", vocabulary=names).transform(front.transform(df))
    assert wide.columns == [*names, "ground_truth"]
    assert wide.count() == 60
    model = GainRatioTreeClassifier(minSide=5).fit(wide)
    scored = model.transform(wide)
    assert scored.filter(F.col("Prediction") != F.col("ground_truth")).isEmpty()
    model.save_tree(str(tmp_path / "tree"))
    again = GainRatioTreeModel.load_tree(spark, str(tmp_path / "tree"))
    assert again.rules().count() == model.rules().count() == 2


def test_stage_settings_survive_saving(spark, tmp_path):
    TextCleaner(inputCol="a", outputCol="b", mode="last").save(str(tmp_path / "cleaner"))
    loaded = TextCleaner.load(str(tmp_path / "cleaner"))
    assert (loaded.getInputCol(), loaded.getOutputCol(), loaded.getOrDefault(loaded.mode)) == ("a", "b", "last")


def test_a_fitted_pipeline_is_saved_whole(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 3, int(i > 20)) for i in range(60)], "a double, b int, ground_truth int")
    fitted = Pipeline(stages=[GainRatioTreeClassifier(minSide=5).setLabelCol("ground_truth")]).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    assert loaded.stages[0].uid == fitted.stages[0].uid
    want = sorted(map(tuple, fitted.transform(df).collect()))
    assert sorted(map(tuple, loaded.transform(df).collect())) == want
    assert TextCleaner().setInputCol("x").setOutputCol("y").getOutputCol() == "y"


def test_scores_are_fitted_on_stored_stems(spark, tmp_path, monkeypatch):
    """On a frame that is not persisted the vectorizer holds every word as an object, and stems were made three times."""
    from pyspark.ml.feature import CountVectorizer

    from catalog.base import QUERIES

    rows = [(i, f"Running runs apple {'berry' if i % 2 else 'cherries'} of {i}", "en") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    seen, real = [], CountVectorizer._fit
    monkeypatch.setattr(CountVectorizer, "_fit", lambda self, df: seen.append((df.columns, df.storageLevel.useDisk, df.storageLevel.useMemory)) or real(self, df))
    got = QUERIES["ml_pipeline_scores"](spark, str(tmp_path)).collect()
    assert seen == [(["stems"], True, False)]
    assert {(r["term"], r["doc_id"] % 2) for r in got} == {("run", 0), ("run", 1), ("appl", 0), ("appl", 1), ("berri", 1), ("cherri", 0)}
    assert len(got) == 40 * 3
