"""Estimators that MLlib has not: forests that score the rows their trees have not seen, boosting with patience and a leaf penalty,
and lasso paths from moment matrices. Trees are MLlib's; fitted objects give `transform` like a model of MLlib.

Training rows have date, symbol (together unique), target and a vector `features`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.storage import checkpointed

SEED = 42
#: Rounds of boosting that one plan scores.
PLANNED = 25


def share_of(*key: Column | str) -> Column:
    """A number from 0 to 1 by the hash of a key."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 40)) / float(1 << 40)


def draws(bag: int, rate: float) -> Column:
    """How often a bag holds a row: a Poisson number with this mean, by a hash of the row and the bag, so that it is known again later."""
    u, out, mass, below = share_of(F.lit(f"bag {bag}"), "date", "symbol"), F.lit(0), math.exp(-rate), 0.0
    for k in range(1, 12):
        below, mass = below + mass, mass * rate / k
        out = F.when(u >= below, k).otherwise(out)
    return out


class BaggedForest:
    """A forest of bags: `per_bag` trees share a bag of rows, drawn with replacement at a rate, and choose columns at each node on their own."""

    def __init__(self, trees: int = 500, rate: float = 0.3, share: float = 0.1, depth: int = 12, leaf: int = 100, per_bag: int = 25):
        self.trees, self.rate, self.share, self.depth, self.leaf, self.per_bag = trees, rate, share, depth, leaf, per_bag

    def fit(self, known: DataFrame) -> BaggedForestModel:
        models = []
        for bag in range(-(-self.trees // self.per_bag)):
            n = min(self.per_bag, self.trees - bag * self.per_bag)
            forest = RandomForestRegressor(labelCol="target", weightCol="__w", numTrees=n, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy=str(self.share), maxDepth=self.depth, minInstancesPerNode=self.leaf, seed=SEED + bag)
            rows = known.withColumn("__w", draws(bag, self.rate).cast("double")).where("__w > 0")
            models.append((n, forest.fit(rows)))
        return BaggedForestModel(models, self.rate)


class BaggedForestModel:
    def __init__(self, models: list, rate: float):
        self.models, self.rate = models, rate

    def _each(self, rows: DataFrame) -> DataFrame:
        for bag, (_, model) in enumerate(self.models):
            rows = model.setPredictionCol(f"__p{bag}").transform(rows)
        return rows

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with the mean of all trees as `prediction`."""
        total = sum(n * F.col(f"__p{bag}") for bag, (n, _) in enumerate(self.models)) / sum(n for n, _ in self.models)
        return self._each(rows).withColumn("prediction", total).drop(*[f"__p{bag}" for bag in range(len(self.models))])

    def out_of_bag(self, known: DataFrame) -> DataFrame:
        """`known` with the mean of the trees whose bags do not hold the row as `prediction`; rows in all bags are left out."""
        free = {bag: draws(bag, self.rate) == 0 for bag in range(len(self.models))}
        part = lambda f: sum(F.when(free[bag], f(bag, n)).otherwise(0.0) for bag, (n, _) in enumerate(self.models))
        votes = part(lambda _, n: F.lit(float(n)))
        out = self._each(known).withColumn("prediction", F.try_divide(part(lambda bag, n: n * F.col(f"__p{bag}")), votes))
        return out.where("prediction is not null").drop(*[f"__p{bag}" for bag in range(len(self.models))])

    def out_of_bag_score(self, known: DataFrame) -> dict[str, float]:
        """n, rmse and r2 of the rows that some tree has not seen."""
        e = F.col("target") - F.col("prediction")
        r = self.out_of_bag(known).agg(F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.var_pop("target").alias("v")).first()
        return {"n": r["n"], "rmse": math.sqrt(r["mse"]), "r2": 1 - r["mse"] / r["v"]} if r["n"] and r["v"] else {"n": r["n"], "rmse": math.nan, "r2": math.nan}


def leaf_counts(model) -> list[tuple[float, float]]:
    """Prediction and training rows of each leaf of a forest's only tree, in the order of MLlib's leaf numbers."""
    out, todo = [], [model._call_java("trees")[0].rootNode()]
    while todo:
        node = todo.pop()
        if node.subtreeDepth() == 0:
            out.append((node.prediction(), float(node.impurityStats().count())))
        else:
            todo += [node.rightChild(), node.leftChild()]
    return out


class PatientBoosting:
    """Boosted trees: each round fits one tree to what is left of the target, and its leaves count n / (n + penalty) of their mean.

    Rows marked `__held` are not fitted; once their error has not gained `tolerance` for `patience` rounds, growth ends and the
    rounds after the best one go. Without held rows all rounds stay."""

    def __init__(self, rounds: int = 500, rate: float = 0.01, depth: int = 4, leaf: int = 100, share: float = 0.3, penalty: float = 1.0, patience: int = 30, tolerance: float = 1e-7, every: int = 10):
        self.rounds, self.rate, self.depth, self.leaf, self.share = rounds, rate, depth, leaf, share
        self.penalty, self.patience, self.tolerance, self.every = penalty, patience, tolerance, every

    def fit(self, known: DataFrame) -> PatientBoostingModel:
        base = known.where("not __held").agg(F.avg("target")).first()[0] or 0.0
        rows = checkpointed(known.select("features", "target", "__held", F.lit(base).alias("__f")))
        trees, losses = [], []
        loss = lambda r: r.where("__held").agg(F.avg(F.pow(F.col("target") - F.col("__f"), 2))).first()[0]
        losses.append(loss(rows))
        for k in range(self.rounds):
            tree = RandomForestRegressor(labelCol="__rest", numTrees=1, bootstrap=False, featureSubsetStrategy=str(self.share), maxDepth=self.depth, minInstancesPerNode=self.leaf, seed=SEED + k)
            model = tree.fit(rows.where("not __held").withColumn("__rest", F.col("target") - F.col("__f"))).setLeafCol("__leaf").setPredictionCol("__tree")
            trees.append((model, [self.rate * p * n / (n + self.penalty) for p, n in leaf_counts(model)]))
            grown = _grown(rows, *trees[-1])
            # each round reads the sums of the last one, not the trees of all before
            grown = checkpointed(grown) if (k + 1) % self.every == 0 else grown.cache()
            losses.append(loss(grown))
            rows.unpersist()
            rows = grown
            if losses[0] is not None and self._best(losses) <= len(losses) - 1 - self.patience:
                break
        rows.unpersist()
        best = self._best(losses) if losses[0] is not None else len(trees)
        return PatientBoostingModel(base, trees[:best], losses)

    def _best(self, losses: list[float]) -> int:
        """The round of the last gain over the best loss so far by more than the tolerance."""
        best, at = losses[0], 0
        for i, x in enumerate(losses):
            if x < best - self.tolerance:
                best, at = x, i
        return at


def _grown(rows: DataFrame, model, values: list[float]) -> DataFrame:
    leaf = F.get(vector_to_array("__leaf"), F.lit(0)).cast("int")
    step = F.get(F.array(*[F.lit(float(v)) for v in values]), leaf)
    return model.transform(rows).withColumn("__f", F.col("__f") + step).drop("__leaf", "__tree")


class PatientBoostingModel:
    def __init__(self, base: float, trees: list, losses: list):
        self.base, self.trees, self.losses = base, trees, losses

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with the sum of all rounds as `prediction`; rows are written after every `PLANNED` rounds, as a plan of hundreds of trees would not end."""
        rows = rows.withColumn("__f", F.lit(self.base))
        for k, (model, values) in enumerate(self.trees):
            rows = checkpointed(rows) if k and k % PLANNED == 0 else rows
            rows = _grown(rows, model, values)
        return rows.withColumnRenamed("__f", "prediction")


def fold_moments(known: DataFrame, folds: int) -> list[np.ndarray]:
    """For each fold the matrix of sums of products of (1, features, target): one pass over the rows, whatever is fitted from it.

    Each task sums its rows; only folds times the square of the number of columns comes to the driver."""
    rows = known.select(F.floor(share_of(F.lit("fold"), "date", "symbol") * folds).cast("int").alias("fold"), vector_to_array("features").alias("x"), "target")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for fold, part in frame.groupby("fold"):
                z = np.column_stack([np.ones(len(part)), np.stack(part["x"].to_numpy()), part["target"].to_numpy()])
                total[fold] = total.get(fold, 0) + z.T @ z
        if total:  # an empty column of lists has no type that Arrow takes
            yield pd.DataFrame({"fold": list(total), "m": [m.ravel() for m in total.values()]})

    sums = rows.mapInPandas(run, "fold int, m array<double>").groupBy("fold").agg(Summarizer.sum(array_to_vector("m")).alias("m"))
    return [r["m"].toArray().reshape(math.isqrt(r["m"].size), -1) for r in sorted(sums.collect(), key=lambda r: r["fold"])]


def lasso_from_moments(moments: np.ndarray, penalties: list[float], most: int = 100_000, tolerance: float = 1e-12) -> list[np.ndarray]:
    """Coefficients (intercept first) for each penalty, largest first, by coordinate descent on the matrix of moments alone.

    Minimises half the mean squared error plus the penalty times the coefficients' sizes in units of their columns' deviations; columns of one value have 0."""
    n, mean = moments[0, 0], moments[0] / moments[0, 0]
    centred = moments[1:, 1:] / n - np.outer(mean[1:], mean[1:])
    scale = np.sqrt(np.maximum(np.diag(centred)[:-1], 0))
    live = scale > 1e-12 * (1 + np.abs(mean[1:-1]))
    unit = np.where(live, scale, 1.0)
    gram, cross = centred[:-1, :-1] / np.outer(unit, unit), centred[:-1, -1] / unit
    out, beta = [], np.zeros(len(unit))
    for penalty in penalties:
        for _ in range(most):
            moved = 0.0
            for j in np.flatnonzero(live):
                rest = cross[j] - gram[j] @ beta + gram[j, j] * beta[j]
                new = math.copysign(max(abs(rest) - penalty, 0.0), rest) / gram[j, j]
                moved, beta[j] = max(moved, abs(new - beta[j])), new
            if moved <= tolerance * (1 + np.abs(beta).max(initial=0)):
                break
        own = beta / unit
        out.append(np.concatenate([[mean[-1] - own @ mean[1:-1]], own]))
    return out


def squared_error(moments: np.ndarray, coefficients: np.ndarray) -> float:
    """Mean squared error on the rows of these moments."""
    w = np.concatenate([-coefficients, [1.0]])
    return max(0.0, float(w @ moments @ w)) / moments[0, 0]


class LassoPath:
    """L1 penalty chosen by cross-validation over a path of penalties: given ones, or `steps` of them down from the least that leaves no coefficient."""

    def __init__(self, penalties: tuple[float, ...] | None = None, folds: int = 5, steps: int = 100, depth: float = 1e-3):
        self.penalties, self.folds, self.steps, self.depth = penalties, folds, steps, depth

    def fit(self, known: DataFrame) -> LinearScores:
        parts = fold_moments(known, self.folds)
        if not parts:
            raise ValueError("no training rows")
        whole = sum(parts)
        penalties = sorted(self.penalties or self._path(whole), reverse=True)
        errors = np.zeros(len(penalties))
        for part in parts if len(parts) > 1 else []:
            for i, c in enumerate(lasso_from_moments(whole - part, penalties)):
                errors[i] += math.sqrt(squared_error(part, c))
        best = int(np.argmin(errors))
        return LinearScores(lasso_from_moments(whole, penalties[: best + 1])[-1], penalties[best])

    def _path(self, whole: np.ndarray) -> list[float]:
        n, mean = whole[0, 0], whole[0] / whole[0, 0]
        spread = np.sqrt(np.maximum(np.diag(whole)[1:-1] / n - mean[1:-1] ** 2, 0))
        cross = np.abs(whole[1:-1, -1] / n - mean[1:-1] * mean[-1])
        top = max((c / s for c, s in zip(cross, spread) if s > 1e-12), default=0.0) or 1e-12
        return list(top * np.geomspace(1, self.depth, self.steps))


class LinearScores:
    """Fitted linear scores: intercept and coefficients."""

    def __init__(self, coefficients: np.ndarray, penalty: float):
        self.intercept, self.coefficients, self.penalty = float(coefficients[0]), coefficients[1:], penalty

    def transform(self, rows: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array("features"), F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda x, c: x * c)
        return rows.withColumn("prediction", F.aggregate(products, F.lit(self.intercept), lambda a, x: a + x))
