"""Queries that fit models; SQL has no form for them. Figures of each model, rounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import evaluate as V
from tidemark.operators import features as X
from tidemark.operators import ensembles as M
from tidemark.operators import model as L
from tidemark.functions.storage import compact
from tidemark.sources.fixtures import bars, table

#: The split of the fixture's days.
SPLIT = "1999-01-01"
COLUMNS = ["open_close_change_pct_1lag", "hl_spread_pct_1lag", "close_open_ratio_1lag", "gap_pct_1lag", "return_1lag", "return_2lag", "return_7d_1lag", "volatility_20", "atr", "day_of_week", "is_month_end"]


def _panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, a row a symbol and day; the line items are read once for all passes over them."""
    rows = X.calendar(X.target(X.volatility_features(X.price_features(bars(spark, sf_dir))), 5))
    return V.split_at(compact(rows.select("date", "symbol", "target", *COLUMNS)), SPLIT)


def forecast_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of each model, and of the ensemble of boosting and forest, on all rows after the split."""
    train, test = _panel(spark, sf_dir)
    models = {"boosting": M.PatientBoosting(), "forest": M.BaggedForest(), "linear": L.linear(), "huber": L.huber(), "lasso": M.LassoPath()}
    found = L.forecasts(train, test, COLUMNS, models, blends={"ensemble": ["boosting", "forest"]})
    clipped = V.clip_predictions(found, train)
    return V.scores(clipped, "model").select("model", "n", *[F.round(c, 9).alias(c) for c in ("rmse", "rmse_zero", "improvement_pct", "accuracy", "spearman")])


def forecast_out_of_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of a forest on the training rows that its trees have not seen, by symbol."""
    train, _ = _panel(spark, sf_dir)
    known = L.known_rows(train, L.fit_preparation(train, COLUMNS), COLUMNS)
    seen = M.BaggedForest(trees=60, per_bag=20, leaf=20, share=0.4).fit(known).out_of_bag(known)
    return V.scores(seen.select("symbol", "prediction", F.col("target").alias("actual")), "symbol").select("symbol", "n", *[F.round(c, 9).alias(c) for c in ("rmse", "rmse_zero", "accuracy")])


def embedding_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all document vectors and the share of the variance that each explains."""
    rows = table(spark, sf_dir, "embeddings")
    vector = next(f.name for f in rows.schema if f.dataType.simpleString().startswith("array"))
    n = rows.select(F.max(F.size(vector))).first()[0]
    columns = [f"news_emb_{i}" for i in range(n)]
    wide = rows.select([F.get(vector, F.lit(i)).cast("double").alias(c) for i, c in enumerate(columns)])
    shares = L.explained_variance(L.fit_preparation(wide, columns))
    return spark.createDataFrame([(i, round(v, 9)) for i, v in enumerate(shares)], "component int, explained double")


QUERIES = {"forecast_models": forecast_models, "forecast_out_of_bag": forecast_out_of_bag, "embedding_components": embedding_components}
