"""Out-of-bag forests, patient boosting and lasso paths against plain computations; long scans; terms; outliers."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.functions.sequential import decayed_sums, ewm_columns, scanned_ewm
from tidemark.operators import bars as B
from tidemark.operators import ensembles as M
from tidemark.operators import news as N


@pytest.fixture(scope="module")
def known(spark):
    random = np.random.default_rng(1)
    x = random.normal(size=(900, 4)) * [1, 5, 0.2, 1]
    x[:, 3] = 2.0  # of one value
    y = np.sign(x[:, 0]) + 0.1 * x[:, 1] + random.normal(size=900) * 0.3 + 7
    rows = [(f"s{i % 30}", pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=i // 30), float(y[i]), Vectors.dense(x[i]), bool(i % 5 == 0)) for i in range(900)]
    return spark.createDataFrame(rows, ["symbol", "date", "target", "features", "__held"]).cache()


def test_forest_scores_the_rows_that_its_trees_have_not_seen(known):
    model = M.BaggedForest(trees=5, rate=0.8, share=1.0, depth=3, leaf=5, per_bag=2).fit(known)
    assert [n for n, _ in model.models] == [2, 2, 1]
    got = {(r.symbol, r.date): r.prediction for r in model.out_of_bag(known).collect()}
    rows = known.select("*", *[M.draws(b, 0.8).alias(f"d{b}") for b in range(3)]).collect()
    drawn = Counter(r[f"d{b}"] for r in rows for b in range(3))
    assert abs(drawn[0] / 2700 - math.exp(-0.8)) < 0.04 and abs(drawn[1] / 2700 - 0.8 * math.exp(-0.8)) < 0.04
    want = {}
    for r in rows:
        free = [b for b in range(3) if r[f"d{b}"] == 0]
        if free:
            votes = [t.predict(r.features) for b in free for t in model.models[b][1].trees]
            want[r.symbol, r.date] = float(np.mean(votes))
    assert got == pytest.approx(want, abs=1e-9)
    y = {(r.symbol, r.date): r.target for r in rows}
    score = model.out_of_bag_score(known)
    assert score["n"] == len(want) and score["rmse"] == pytest.approx(math.sqrt(np.mean([(y[k] - v) ** 2 for k, v in want.items()])))
    everything = {(r.symbol, r.date): r.prediction for r in model.transform(known).collect()}
    assert everything == pytest.approx({(r.symbol, r.date): float(np.mean([t.predict(r.features) for _, m in model.models for t in m.trees])) for r in rows}, abs=1e-9)


def test_boosting_stops_with_patience_at_the_best_round_and_shrinks_leaves(known):
    boost = M.PatientBoosting(rounds=40, rate=0.6, depth=2, leaf=5, share=1.0, penalty=20.0, patience=4, tolerance=0.0, every=3)
    model = boost.fit(known)
    best = int(np.argmin(model.losses))
    assert len(model.trees) == best and (len(model.losses) == 41 or len(model.losses) == best + 1 + 4)
    rows = known.collect()
    fitted = [r for r in rows if not r["__held"]]
    f = {id(r): np.mean([x.target for x in fitted]) for r in rows}
    for tree, values in model.trees:
        leaves = {id(r): int(tree.predictLeaf(r.features)[0]) for r in rows}
        for leaf in set(leaves[id(r)] for r in fitted):
            inside = [r for r in fitted if leaves[id(r)] == leaf]
            mean = np.mean([r.target - f[id(r)] for r in inside])
            assert values[leaf] == pytest.approx(0.6 * mean * len(inside) / (len(inside) + 20.0), abs=1e-9)
        f = {k: v + values[leaves[k]] for k, v in f.items()}
    got = {(r.symbol, r.date): r.prediction for r in model.transform(known).collect()}
    assert got == pytest.approx({(r.symbol, r.date): f[id(r)] for r in rows}, abs=1e-9)
    held = [r for r in rows if r["__held"]]
    assert model.losses[best] == pytest.approx(np.mean([(r.target - f[id(r)]) ** 2 for r in held]))


def test_lasso_path_from_moments(known, spark):
    spark.sparkContext.setJobGroup("lasso", "")
    model = M.LassoPath((0.01, 0.1, 0.5), folds=4).fit(known)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("lasso")) <= 3  # one pass over the rows; the rest is its shuffle and order
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    whole = sum(M.fold_moments(known, 4))
    for penalty in (0.01, 0.1, 0.5):
        plain = LinearRegression(labelCol="target", elasticNetParam=1.0, regParam=penalty, tol=1e-12, maxIter=2000).fit(known)
        ours = M.lasso_from_moments(whole, [penalty])[0]
        assert ours[1:] == pytest.approx(plain.coefficients.toArray(), abs=1e-6) and ours[0] == pytest.approx(plain.intercept, abs=1e-6)
        error = known.select("target", "features").rdd.map(lambda r: (r.target - ours[0] - float(r.features.dot(ours[1:]))) ** 2).mean()
        assert M.squared_error(whole, ours) == pytest.approx(error, abs=1e-9)
    folds = known.withColumn("fold", F.floor(M.share_of(F.lit("fold"), "date", "symbol") * 4)).toPandas()
    errors = []
    for penalty in (0.5, 0.1, 0.01):
        rmse = []
        for k in range(4):
            train, test = folds[folds.fold != k], folds[folds.fold == k]
            z = np.column_stack([np.ones(len(train)), np.stack([v.toArray() for v in train.features]), train.target])
            c = M.lasso_from_moments(z.T @ z, [penalty])[0]
            rmse.append(math.sqrt(np.mean([(t - c[0] - v.toArray() @ c[1:]) ** 2 for t, v in zip(test.target, test.features)])))
        errors.append(np.mean(rmse))
    assert model.penalty == (0.5, 0.1, 0.01)[int(np.argmin(errors))]
    row = model.transform(known).first()
    assert row.prediction == pytest.approx(model.intercept + float(row.features.dot(model.coefficients)))
    path = M.LassoPath(steps=20).fit(known)
    assert 0 < path.penalty and path.coefficients[3] == 0


def test_decayed_sums_go_on_from_a_state():
    random = np.random.default_rng(2)
    x = np.where(random.random(700) < 0.2, np.nan, random.normal(size=700))
    whole = decayed_sums(x, 0.9)
    a = decayed_sums(x[:333], 0.9)
    b = decayed_sums(x[333:], 0.9, tuple(s[-1] for s in a))
    for w, p, q in zip(whole, a, b):
        np.testing.assert_allclose(w, np.concatenate([p, q]), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("tasks", [1, 7])
def test_long_series_over_many_tasks(spark, tasks):
    random = np.random.default_rng(3)
    rows = [("long", i, None if random.random() < 0.1 or 700 < i < 2100 else float(random.normal())) for i in range(3000)] + [(s, i, float(i)) for s in ("a", "m", "z") for i in range(40)] + [("none", i, None) for i in range(5)]
    df = spark.createDataFrame([rows[i] for i in random.permutation(len(rows))], "symbol string, date int, x double")
    wanted = {"fast": ("x", 3, 2), "slow": ("x", 60, 10), "one": ("x", 1, 1)}
    got = scanned_ewm(df, wanted, tasks=tasks)
    assert got.rdd.getNumPartitions() == tasks
    got, want = (d.toPandas().sort_values(["symbol", "date"], ignore_index=True) for d in (got, ewm_columns(df, wanted)))
    pd.testing.assert_frame_equal(got, want, rtol=1e-10)
    assert scanned_ewm(df.limit(0), wanted).count() == 0


def test_terms_with_a_small_store_equal_plain_counts(spark):
    random = np.random.default_rng(4)
    words = [f"w{i:02d}" for i in range(60)]
    weight = 1 / np.arange(1, 61)
    rows = [(i, " ".join(random.choice(words, random.integers(0, 40), p=weight / weight.sum())) + " the ünder X yz", None) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, a string, b string").repartition(3)
    counts = Counter()
    own = {i: Counter(N.terms_of(a + " ", N.STOP_WORDS)) for i, a, _ in rows}
    for c in own.values():
        counts.update(c)
    assert "the" not in counts and "ünder" in counts and not any(re.fullmatch(".", t) for t in counts)
    chosen = [t for _, t in sorted((-n, t) for t, n in counts.items())[:25]]
    df_of = Counter(t for c in own.values() for t in c if t in chosen)
    want = {}
    for i, c in own.items():
        x = {t: c[t] * (math.log(301 / (1 + df_of[t])) + 1) for t in c if t in chosen}
        length = math.sqrt(sum(v * v for v in x.values()))
        want |= {(i, t): v / length for t, v in x.items()}
    for held in (40, 200, 100_000):  # too small to be certain, tight, ample
        got = {(r.id, r.term): r.weight for r in N.tfidf(df, ["a", "b"], most=25, held=held).collect()}
        assert got == pytest.approx(want)
    assert N.tfidf(df.limit(0), ["a"]).count() == 0


def test_outliers_of_many_columns_take_one_exchange(spark):
    random = np.random.default_rng(5)
    rows = [(s, i, *[None if random.random() < (0.1 if s == "b" else 0) else float(v) for v in random.standard_t(2, 3)]) for s in "abc" for i in range(60)] + [("one", 0, 1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "symbol string, date int, x double, y double, z double")
    frame = df.toPandas()
    for method in B.OUTLIERS:
        out = B.remove_outliers(df, ["x", "y", "z"], method, 2.0)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        keep = pd.Series(True, frame.index)
        for c in "xyz":
            g = frame.groupby("symbol")[c]
            q1, q2, q3 = (g.transform("quantile", q) for q in (0.25, 0.5, 0.75))
            dev = (frame[c] - q2).abs()
            mad = dev.groupby(frame.symbol).transform("median").where(g.transform(lambda s: s.isna().sum()) == 0)
            bad = {"iqr": (frame[c] < q1 - 1.5 * (q3 - q1)) | (frame[c] > q3 + 1.5 * (q3 - q1)), "zscore": ((frame[c] - g.transform("mean")) / g.transform("std")).abs() > 2.0, "modified_zscore": (0.6745 * (frame[c] - q2) / mad.replace(0, np.nan)).abs() > 2.0}[method]
            keep &= ~bad.fillna(False)
        assert {tuple(r)[:2] for r in out.collect()} == set(frame[keep][["symbol", "date"]].itertuples(index=False, name=None))
    with pytest.raises(ValueError):
        B.remove_outliers(df, ["x"], "median")


def test_fits_read_training_rows_in_few_tasks_whatever_the_panel_s(known, spark):
    from tidemark.operators import model as L

    train = known.select("date", "symbol", "target", F.lit("a").alias("kind"), F.col("target").alias("x")).repartition(64)
    rows = L.known_rows(train, L.fit_preparation(train, ["x", "kind"]), ["x", "kind"])
    assert rows.count() == 900 and rows.rdd.getNumPartitions() == 1


def test_lasso_with_tasks_without_rows(known):
    parts = M.fold_moments(known.limit(5).repartition(16), 2)
    assert sum(m[0, 0] for m in parts) == 5


def test_boosting_scores_in_blocks_of_rounds(known, monkeypatch):
    model = M.PatientBoosting(rounds=7, rate=0.5, depth=2, leaf=5, share=1.0, patience=9, tolerance=0.0, every=3).fit(known)
    whole = {(r.symbol, r.date): r.prediction for r in model.transform(known).collect()}
    monkeypatch.setattr(M, "PLANNED", 2)
    cut = model.transform(known)
    assert len(model.trees) == 7 and cut._jdf.queryExecution().optimizedPlan().toString().count("UDF(") <= 2 * 2
    assert {(r.symbol, r.date): r.prediction for r in cut.collect()} == pytest.approx(whole, abs=1e-12)


def test_panel_of_the_models_reads_its_line_items_once(spark):
    from tidemark.plans import models as P

    for part in P._panel(spark, "/root/testdata/sf0.001"):
        assert "parquet" not in part._jdf.queryExecution().optimizedPlan().toString()
