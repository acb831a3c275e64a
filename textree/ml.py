"""The operators as stages for ``pyspark.ml.Pipeline``."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textree.functions.porter import stems
from textree.operators import features as ft
from textree.operators import text as tx
from textree.plans import tree as tr

LABEL = "ground_truth"
INDEX = "Index"


class Settable(Params):
    """Setters that return the stage."""

    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)


class TextCleaner(Transformer, Settable, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Cleaned text in ``outputCol``; see ``operators.text.clean`` for the two modes."""

    mode = Param(Params._dummy(), "mode", "chain or last", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, mode="chain"):
        super().__init__()
        self._setDefault(mode="chain")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return tx.clean(dataset, self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.mode))


class TokenStemmer(Transformer, Settable, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Stems of an array of tokens, as a column expression; takes a stream too."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), stems(F.col(self.getInputCol())))


class VectorExpander(Transformer, Settable, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One double column per vocabulary word, rounded to five places, and the label; the rest is dropped."""

    vocabulary = Param(
        Params._dummy(), "vocabulary", "names of the vector's places", typeConverter=TypeConverters.toListString
    )
    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, vocabulary=None, labelCol=LABEL):
        super().__init__()
        self._setDefault(labelCol=LABEL)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = self.getOrDefault(self.labelCol)
        arrays = dataset.select(vector_to_array(self.getInputCol()).alias("features_array"), label)
        return ft.expand_array(arrays, "features_array", self.getOrDefault(self.vocabulary), label)


class GainRatioTreeClassifier(Estimator, Settable, DefaultParamsReadable, DefaultParamsWritable):
    """Grows a tree on every column but the label and the index."""

    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level", typeConverter=TypeConverters.toInt)
    minSide = Param(
        Params._dummy(), "minSide", "a split leaves more rows than this", typeConverter=TypeConverters.toInt
    )
    entropyStop = Param(
        Params._dummy(), "entropyStop", "entropy at which a node is a leaf", typeConverter=TypeConverters.toFloat
    )
    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, maxDepth=100, minSide=100, entropyStop=tr.ENTROPY_STOP, labelCol=LABEL):
        super().__init__()
        self._setDefault(maxDepth=100, minSide=100, entropyStop=tr.ENTROPY_STOP, labelCol=LABEL)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> GainRatioTreeModel:
        label = self.getOrDefault(self.labelCol)
        names = [c for c in dataset.columns if c not in (label, INDEX)]
        tree = tr.fit(
            ft.dense_matrix(dataset, names, label),
            self.getOrDefault(self.maxDepth),
            self.getOrDefault(self.minSide),
            self.getOrDefault(self.entropyStop),
        )
        return GainRatioTreeModel(tree)


class GainRatioTreeModel(Model, MLWritable, MLReadable):
    """``tree`` is the tree table; ``transform`` adds the column ``Prediction``. Saved with its tree as Parquet."""

    def __init__(self, tree: DataFrame):
        super().__init__()
        self.tree = tree

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return tr.predict(dataset, self.tree, "Prediction")

    def rules(self) -> DataFrame:
        return tr.rules(self.tree)

    def save_tree(self, path: str) -> None:
        tr.save(self.tree, path)

    @classmethod
    def load_tree(cls, spark, path: str) -> GainRatioTreeModel:
        return cls(tr.load(spark, path))

    def write(self) -> MLWriter:
        return TreeModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TreeModelReader()


class TreeModelWriter(MLWriter):
    def __init__(self, model: GainRatioTreeModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.save_tree(f"{path}/tree")


class TreeModelReader(MLReader):
    def load(self, path: str) -> GainRatioTreeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GainRatioTreeModel.load_tree(self.sparkSession, f"{path}/tree")
        model._resetUid(metadata["uid"])
        return model
