"""A chi-squared cut of a feature vector as a pipeline stage: fitted on one matrix, applied to any other alike, stored and loaded."""

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.selection import feature_columns


def class_scores(sums) -> np.ndarray:
    """Chi-squared by column from ``(positive, rows, feature sums)`` of each class; NaN for a column that sums to zero."""
    rows = sum(n for _, n, _ in sums)
    total = sum(np.asarray(s) for _, _, s in sums)
    score = np.zeros(len(total))
    with np.errstate(divide="ignore", invalid="ignore"):
        for _, n, observed in sums:
            expected = n / rows * total
            score += (np.asarray(observed) - expected) ** 2 / expected
    # With one class there is nothing to tell apart.
    return score if len(sums) == 2 else np.full(len(total), np.nan)


def best_positions(scores, k) -> list[int]:
    """Positions of the ``k`` best scores, unscored ones last, equal ones to the later column; in the order of the columns."""
    order = sorted(range(len(scores)), key=lambda i: (not np.isnan(scores[i]), scores[i] if not np.isnan(scores[i]) else 0.0, i))
    return sorted(order[::-1][:k])


class _Cut(HasFeaturesCol, HasOutputCol):
    def _defaults(self):
        self._setDefault(featuresCol="features", outputCol="selected")


class ChiSquaredCut(Estimator, _Cut, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the ``k`` features that tell a 0/1 label apart best. Features must not be negative.

    One pass: the rows and the feature vectors of each class are added up; two rows reach the driver.
    """

    k = Param(Params._dummy(), "k", "number of features to keep", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, k=100, featuresCol="features", labelCol="target", outputCol="selected"):
        super().__init__()
        self._defaults()
        self._setDefault(k=100, labelCol="target")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        vector = self.getFeaturesCol()
        by_class = dataset.where(F.col(vector).isNotNull()).groupBy(
            F.coalesce(F.col(self.getLabelCol()) == 1, F.lit(False)).alias("positive")).agg(
            F.count("*").alias("n"), Summarizer.sum(F.col(vector)).alias("sums"))
        sums = [(r.positive, r.n, r.sums.toArray()) for r in by_class.collect()]
        kept = best_positions(class_scores(sums), self.getOrDefault(self.k)) if sums else []
        model = ChiSquaredCutModel(kept)
        return model._set(featuresCol=vector, outputCol=self.getOutputCol())


class ChiSquaredCutModel(Model, _Cut, DefaultParamsReadable, DefaultParamsWritable):
    """Takes the kept positions out of the feature vector."""

    kept = Param(Params._dummy(), "kept", "positions of the kept features", TypeConverters.toListInt)

    def __init__(self, kept=()):
        super().__init__()
        self._defaults()
        self._set(kept=list(kept))

    def positions(self) -> list[int]:
        return self.getOrDefault(self.kept)

    def _transform(self, dataset):
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(),
                            indices=self.positions()).transform(dataset)


def cut_matrices(matrices: dict, columns, k, label="target", fitted="train") -> dict:
    """Every matrix with its keys and the ``k`` columns that the ``fitted`` one selects; no other matrix has a say."""
    from riskloom.operators.models import assembled_features
    columns = list(columns)
    model = ChiSquaredCut(k=k, labelCol=label).fit(assembled_features(matrices[fitted], columns))
    names = [columns[i] for i in model.positions()]

    def cut(matrix: DataFrame) -> DataFrame:
        keys = [c for c in matrix.columns if c not in feature_columns(matrix)]
        return matrix.select(*keys, *[F.col(f"`{n}`") for n in names])

    return {name: cut(matrix) for name, matrix in matrices.items()}
