"""The factor model as an ML estimator: parameters, grids, tuning and stored models.

``RidgeFactors`` alternates the least-squares steps of ``normal_equations`` and gives a
``RidgeFactorsModel``, whose factors are tables.  Both are saved and loaded like every
ML stage, and ``TrainValidationSplit`` tunes them on a hold-out; as the factors of a stored model
are plain tables, any engine can compute the error that a choice rests on.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasMaxIter, HasPredictionCol, HasRegParam, HasSeed
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from rateflow.operators import normal_equations as ne


class _FactorParams(HasMaxIter, HasRegParam, HasSeed, HasPredictionCol):
    rank = Param(Params._dummy(), "rank", "length of the factor vectors", typeConverter=TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(rank=5, maxIter=10, regParam=0.01, seed=ne.SEED, predictionCol="prediction")

    def getRank(self) -> int:
        return self.getOrDefault(self.rank)


class RidgeFactors(Estimator, _FactorParams, MLReadable, MLWritable):
    """Fits factors to (userId, productId, score)."""

    @keyword_only
    def __init__(self, *, rank=5, maxIter=10, regParam=0.01, seed=ne.SEED, predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RidgeFactorsModel:
        users, items = ne.fit(dataset, self.getRank(), self.getMaxIter(), self.getRegParam(), self.getSeed())
        return self._copyValues(RidgeFactorsModel(users, items))

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class RidgeFactorsModel(Model, _FactorParams, MLReadable, MLWritable):
    """Factor tables ``userFactors`` (userId, features) and ``itemFactors`` (productId, features)."""

    def __init__(self, users: DataFrame | None = None, items: DataFrame | None = None):
        super().__init__()
        self.userFactors, self.itemFactors = users, items

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows with a prediction; those of an unknown user or product are left out."""
        told = ne.predict(dataset, self.userFactors, self.itemFactors)
        return told.withColumnRenamed("prediction", self.getPredictionCol())

    def fold_in(self, ratings: DataFrame) -> DataFrame:
        """(userId, features) of users from ratings of the model's products."""
        return ne.half_step(ratings, self.itemFactors, "userId", "productId", self.getRegParam(), self.getRank())

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.userFactors.write.parquet(f"{path}/userFactors")
        self.instance.itemFactors.write.parquet(f"{path}/itemFactors")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> RidgeFactorsModel:
        model = super().load(path)
        spark = SparkSession.active()
        model.userFactors = spark.read.parquet(f"{path}/userFactors")
        model.itemFactors = spark.read.parquet(f"{path}/itemFactors")
        return model


def tuner(ranks, regs, max_iter: int = 10, train_ratio: float = 0.8, seed: int = ne.SEED, parallelism: int = 2) -> TrainValidationSplit:
    """A hold-out search over ranks and ridges by RMSE, keeping every point's model."""
    factors = RidgeFactors(maxIter=max_iter, seed=seed)
    grid = ParamGridBuilder().addGrid(factors.rank, list(ranks)).addGrid(factors.regParam, list(regs)).build()
    return TrainValidationSplit(estimator=factors, estimatorParamMaps=grid, trainRatio=train_ratio, seed=seed, parallelism=parallelism,
                                evaluator=RegressionEvaluator(labelCol="score", predictionCol="prediction", metricName="rmse"),
                                collectSubModels=True)


def points(fitted) -> list[tuple[int, float, float]]:
    """(rank, regParam, rmse) of every grid point of a fitted tuner."""
    def value(map_, name):
        return next(v for p, v in map_.items() if p.name == name)

    return [(value(m, "rank"), value(m, "regParam"), error) for m, error in zip(fitted.getEstimatorParamMaps(), fitted.validationMetrics)]
