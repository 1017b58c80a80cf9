"""Forecast models over a feature panel: column preparation and MLlib estimators with the panel's usual settings.

Every estimator is a Pipeline fitted on training rows only. Feature rows with a null are left out in training and
forecast alike, as MLlib has no missing values. Rows stay distributed; the driver holds trees and coefficients only.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.storage import compact
from tidemark.operators.evaluate import column_kinds

SEED = 42
#: Percentage of the training rows, by a hash of their key, on which boosting judges when to stop.
HOLDOUT = 15


def preparation(kinds: dict[str, list[str]], components: int = 20) -> list:
    """Stages from columns (as `evaluate.column_kinds` sorts them) to the vector `features`.

    Strings become indicators, and a value unknown in training has none; numbers are centred and scaled by training
    rows; embedding columns are scaled and projected to `components`; two-valued columns pass."""
    stages, parts = [], []
    if kinds["onehot"]:
        coded = [f"__i_{c}" for c in kinds["onehot"]]
        stages += [StringIndexer(inputCols=kinds["onehot"], outputCols=coded, handleInvalid="keep"), OneHotEncoder(inputCols=coded, outputCols=[f"__h_{c}" for c in kinds["onehot"]])]
        parts += [f"__h_{c}" for c in kinds["onehot"]]
    for name in ("scale", "pca"):
        if kinds[name]:
            stages += [VectorAssembler(inputCols=kinds[name], outputCol=f"__v_{name}", handleInvalid="skip"), StandardScaler(inputCol=f"__v_{name}", outputCol=f"__s_{name}", withMean=True)]
            parts.append(f"__s_{name}")
    if kinds["pca"]:
        stages.append(PCA(k=min(components, len(kinds["pca"])), inputCol="__s_pca", outputCol="__p_pca"))
        parts[-1] = "__p_pca"
    return [*stages, VectorAssembler(inputCols=parts + kinds["pass"], outputCol="features", handleInvalid="skip")]


def explained_variance(model: PipelineModel) -> list[float]:
    """Share of the variance that each embedding component explains."""
    return [float(v) for s in model.stages if s.__class__.__name__ == "PCAModel" for v in s.explainedVariance]


def gradient_boosting(trees: int = 500, rate: float = 0.01, depth: int = 4, leaf: int = 100, share: float = 0.3, tolerance: float = 0.0001) -> Estimator:
    """MLlib's boosted trees, which stop once the held-out rows no longer gain; `ensembles.PatientBoosting` has a leaf penalty and patience."""
    return GBTRegressor(labelCol="target", maxIter=trees, stepSize=rate, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy=str(share), validationIndicatorCol="__held", validationTol=tolerance, seed=SEED)


def random_forest(trees: int = 500, rows: float = 0.3, share: float = 0.1, depth: int = 12, leaf: int = 100) -> Estimator:
    """MLlib's bagged trees on shares of rows and columns; `ensembles.BaggedForest` scores the rows out of its bags."""
    return RandomForestRegressor(labelCol="target", numTrees=trees, subsamplingRate=rows, featureSubsetStrategy=str(share), maxDepth=depth, minInstancesPerNode=leaf, seed=SEED)


def linear() -> Estimator:
    return LinearRegression(labelCol="target")


def huber(penalty: float = 1e-4, most: int = 400) -> Estimator:
    """Linear model whose loss grows only linearly for outliers. The small penalty keeps indicators that sum to one, and so
    repeat the intercept, from taking its value: rows of an unknown category would lose it."""
    return LinearRegression(labelCol="target", loss="huber", regParam=penalty, maxIter=most)


def lasso(penalties: tuple[float, ...] = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1), folds: int = 5) -> Estimator:
    """MLlib's L1 penalty chosen by cross-validation, a fit for each fold and penalty; `ensembles.LassoPath` makes one pass."""
    model = LinearRegression(labelCol="target", elasticNetParam=1.0)
    grid = ParamGridBuilder().addGrid(model.regParam, list(penalties)).build()
    return CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="target"), numFolds=folds, seed=SEED)


def with_holdout(train: DataFrame) -> DataFrame:
    """`train` with `__held`, true for a fixed share of its (date, symbol) keys."""
    return train.withColumn("__held", F.pmod(F.xxhash64("date", "symbol"), F.lit(100)) < HOLDOUT)


def fit_preparation(train: DataFrame, columns: list[str], components: int = 20) -> PipelineModel:
    """The preparation of `columns`, fitted on rows without nulls in them."""
    clean = train.dropna(subset=columns)
    return Pipeline(stages=preparation(column_kinds(clean, columns), components)).fit(clean)


def known_rows(train: DataFrame, prepared: PipelineModel, columns: list[str]) -> DataFrame:
    """date, symbol, target, features and `__held` of the training rows without nulls, computed once, as every fit reads them many times."""
    return compact(prepared.transform(with_holdout(train.dropna(subset=[*columns, "target"]))).select("date", "symbol", "target", "features", "__held"))


def forecasts(train: DataFrame, test: DataFrame, columns: list[str], models: dict[str, Estimator], components: int = 20, blends: dict[str, list[str]] | None = None) -> DataFrame:
    """model, date, symbol, prediction and actual of every test row without nulls, from each model fitted on `train`.

    A blend is the mean of its models' predictions. Columns are prepared once; training vectors are written and cached for the
    models' passes, and read again if an executor that holds them is lost. All models score the test
    rows in one pass. Without training rows or models there is nothing to fit: a ValueError."""
    prepared = fit_preparation(train, columns, components)
    keep = ["date", "symbol", "target", "features"]
    known = known_rows(train, prepared, columns).cache()
    ahead = prepared.transform(test.dropna(subset=[*columns, "target"])).select(keep)
    if not models or known.isEmpty():
        raise ValueError("forecasts need a model and training rows")
    for name, model in models.items():
        ahead = model.fit(known).transform(ahead).withColumnRenamed("prediction", f"__m_{name}")
    known.unpersist()
    blended = {f"__m_{name}": sum(F.col(f"__m_{m}") for m in members) / len(members) for name, members in (blends or {}).items()}
    ahead = ahead.withColumns(blended) if blended else ahead
    names = [*models, *(blends or {})]
    rows = ahead.select(F.col("date"), F.col("symbol"), F.col("target").alias("actual"), *[F.col(f"__m_{n}").alias(n) for n in names])
    return rows.unpivot(["date", "symbol", "actual"], names, "model", "prediction")
