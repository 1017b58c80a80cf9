"""Rules of windows, cleaning and indicators against pandas, and every registered query against its SQL."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import windows as w
from tidemark.functions.sequential import ewm_columns, parabolic
from tidemark.operators import bars as B
from tidemark.operators import events as E
from tidemark.operators import features as X
from tidemark.operators import news as N
from tidemark.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def frame(spark):
    x = [1.0, None, 3.0, 2.0, None, None, 5.0, 4.0, 4.0, 0.0]
    rows = [("a", pd.Timestamp("2024-01-01") + pd.Timedelta(days=i), v) for i, v in enumerate(x)] + [("b", pd.Timestamp("2024-01-01"), 7.0)]
    return spark.createDataFrame([(s, d.date(), v) for s, d, v in rows], "symbol string, date date, x double"), pd.Series([math.nan if v is None else v for v in x])


def column(df, c):
    df = df.withColumn("__out", F.col(c) if isinstance(c, str) else c).where("symbol = 'a'").orderBy("date")
    return [math.nan if r["__out"] is None else float(r["__out"]) for r in df.collect()]


def same(a, b):
    np.testing.assert_allclose(a, list(b), rtol=1e-12, equal_nan=True)


def test_windows_follow_pandas(frame):
    df, s = frame
    o = w.by("symbol")
    same(column(df, w.roll(F.avg, "x", o, 3)), s.rolling(3).mean())
    same(column(df, w.roll(F.stddev_samp, "x", o, 4, 2)), s.rolling(4, min_periods=2).std())
    same(column(df, w.ffill("x", o)), s.ffill())
    same(column(df, w.bfill("x", "symbol")), s.bfill())
    same(column(ewm_columns(df, {"e": ("x", 3, 2)}), "e"), s.ewm(span=3, min_periods=2).mean())
    same(column(B.fill_missing(df, "interpolate", ["x"]), "x"), s.interpolate())
    same(column(df.withColumn("r", w.rank_pct("x", "symbol")), "r"), s.rank(pct=True))
    assert column(df, w.most("x", F.lit(2.5)))[1] != column(df, w.most("x", F.lit(2.5)))[1]


def test_parabolic_modes():
    high, low = np.array([10.0, 11, 12, 9, 8, 7, 13]), np.array([9.0, 10, 11, 7, 6, 5, 12])
    trailing, turning = parabolic(high, low, 0.02, 0.2, False), parabolic(high, low, 0.02, 0.2, True)
    assert (trailing[1:] <= low[:-1] + 1e-12).all() and turning[3] == 12.0
    assert np.isnan(parabolic(np.array([1.0, np.nan, 2]), np.array([1.0, 1, 1]), 0.02, 0.2, True)[1:]).all()


def test_features_use_the_past_only(spark):
    rows = [("a", pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=i), 10.0 + i % 5, 12.0 + i % 7, 8.0 + i % 3, 9.0 + i % 4, 100.0 + i) for i in range(60)]
    schema = "symbol string, date date, open double, high double, low double, close double, volume double"
    changed = rows[:40] + [(*rows[40][:2], 50.0, 60.0, 40.0, 55.0, 9999.0)] + rows[41:]
    for part in (X.price_features, X.volume_features, X.technical_features, X.momentum_features, X.volatility_features, X.trend_features):
        a, b = (B.drop_today(part(spark.createDataFrame(r, schema))).where("date <= '2024-02-10'").orderBy("date").toPandas() for r in (rows, changed))
        pd.testing.assert_frame_equal(a, b)


def test_cleaning_keeps_every_symbol(spark):
    rows = [(s, pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=i), 5.0, 4.0 if i == 3 else 6.0, 4.5, None if i == 2 else 5.5, -1.0 if i == 4 else 10.0) for s in "ab" for i in range(8)]
    out = B.clean(spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume double"), times=True).toPandas()
    assert len(out) == 16 and out.close.notna().all() and (out.high >= out.close).all() and (out.volume >= 0).all() and out.is_weekend.sum() == 4


def test_news_dates(spark):
    df = spark.createDataFrame([("Tue, 05 Mar 2024 10:00:00 GMT", "Mar-07-26", "3 days ago"), ("junk", "x", "7/3/2026"), ("2024-03-05T01:02:03Z", "Jan-01-20", "5 hours ago")], "a string, b string, c string")
    got = [tuple(map(str, r)) for r in df.select(N.feed_date(F.col("a"), "2024-04-01"), N.table_date(F.col("b")), N.relative_date(F.col("c"), "2024-04-10")).collect()]
    assert got == [("2024-03-05", "2026-03-07", "2024-04-07"), ("2024-04-01", "None", "2026-03-07"), ("2024-03-05", "2020-01-01", "2024-04-10")]


def test_grades(spark):
    df = spark.createDataFrame([("Buy",), ("long-term buy",), ("Underperform",), ("Hold",), ("?",), (None,), ("",), ("Top Pick",), ("avoid",), (" Fair Value ",), ("Speculative Buy",), ("sector perform",)], "g string")
    assert [r[0] for r in df.select(E.grade_score("g")).collect()] == [1, 1, -1, 0, None, None, None, 1, -1, 0, 1, 0]
    rows = [("up", "Sell", "Buy", 1), ("DOWN ", "Buy", "Sell", -1), ("Upgrade", "Hold", "Hold", 0), ("initiated", "Buy", None, 1), ("initiation", "Buy", "Buy", 0), (None, "Sell", "Buy", -1), ("init", "?", None, 0), (None, "Buy", "?", 1)]
    got = E.classify_revisions(spark.createDataFrame(rows, "action string, to_grade string, from_grade string, want int"))
    assert all(r.direction == r.want for r in got.collect())


def test_officers(spark):
    titles = {"General Counsel": 1, "Secretary": 1, "Treasurer": 1, "Controller": 1, "Managing Director": 1, "Chairman": 0, "Director": 0, "President and CEO": 1, "VP of Engineering": 1, None: 0, "Preceo": 0}
    rows = [(f"t{i}", "S", t, 1.0, 1.0) for i, t in enumerate(titles)]
    df = spark.createDataFrame(rows, "ticker string, code string, position string, value double, shares double").withColumn("date", F.lit("2024-01-01").cast("date"))
    got = {r.ticker: r.officer_sells for r in E.insider_daily(df).collect()}
    assert [got[f"t{i}"] for i in range(len(titles))] == list(titles.values())


def test_landed_grade_changes(spark):
    df = spark.createDataFrame([("A", "2024-01-05", "Buy"), ("A", "x", "Buy"), ("A", None, "Sell"), ("A", "2025-01-01", "Buy")], "Ticker string, GradeDate string, ToGrade string")
    got = E.grade_changes(df, "2024-01-01", "2024-12-31")
    assert got.columns == ["date", "ticker", "to_grade"] and [(str(r.date), r.to_grade) for r in got.collect()] == [("2024-01-05", "Buy")]


def test_event_features_of_some_sources(spark):
    """A source that is not there leaves its columns out; days without events are zero; an unknown source is an error."""
    grid = E.spine(spark.createDataFrame([("A",), ("B",)], "ticker string"), "2024-01-01", "2024-01-12")
    rows = spark.createDataFrame([("A", "P", "CEO", 5.0, 2.0)], "ticker string, code string, position string, value double, shares double").withColumn("date", F.lit("2024-01-03").cast("date"))
    out = E.event_features(grid, {"insider": E.insider_daily(rows)})
    assert out.count() == grid.count() and "congress_net" not in out.columns and out.agg(F.sum("insider_buys_30d")).first()[0] == 8
    assert E.event_features(grid, {}).columns == grid.columns
    with pytest.raises(ValueError):
        E.event_features(grid, {"weather": rows})


def test_curve_and_closes(spark):
    df = spark.createDataFrame([(3.0, 2.0, 14.0), (2.0, 3.0, 15.5), (None, 1.0, 25.0), (1.0, 1.0, 200.0), (1.0, 0.0, None)], "treasury_10y double, treasury_2y double, vix double")
    got = [(r.yield_curve_slope, r.yield_curve_inverted, r.vix_regime) for r in E.curve_and_regime(df).collect()]
    assert got == [(1.0, 0, "low_vol"), (-1.0, 1, "normal"), (None, 0, "elevated"), (0.0, 0, "nan"), (1.0, 0, "nan")]
    assert E.curve_and_regime(df.select("treasury_2y")).columns == ["treasury_2y"]


def test_bars_between_days_and_missing_sectors(spark):
    df = spark.sql("SELECT IF(id < 3, 'a', 'b') AS SYMBOL, date_add(DATE '2024-01-01', id::int) AS DATE, 1.0D AS OPEN FROM range(5)")
    got = B.load_bars(df, "2024-01-02", "2024-01-05")
    assert got.columns == ["symbol", "date", "open"] and got.count() == 3
    info = spark.createDataFrame([("a", "tech"), ("a", "tech")], "symbol string, sector string")
    assert sorted(r.sector for r in B.symbol_info(got, info, ["sector"]).collect()) == ["N/A", "tech", "tech"]
    wide = spark.createDataFrame([("2024-01-01", 1.0, 2.0, 3.0)], "date string, close_a double, close_b_c double, open_a double")
    assert {(r.symbol, r.close, r.open) for r in B.wide_to_long(wide, ["open", "close"]).collect()} == {("a", 1.0, 3.0), ("b_c", 2.0, None)}


def test_exact_quantiles(spark):
    import random

    from tidemark.operators.evaluate import overall_quantiles

    random.seed(5)
    values = [random.choice([1.0, 2.0, random.random() * 9, None]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = pd.Series(values, dtype=float).quantile([0.0, 0.25, 0.5, 0.9, 1.0]).tolist()
    assert overall_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], ranges=9) == pytest.approx(want)
    assert all(math.isnan(q) for q in overall_quantiles(df.limit(0), "x", [0.5]))


def test_p_values(spark):
    from tidemark.operators.evaluate import t_tail, with_p_value

    for t, freedom, p in ((2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.959966, 10**6, 0.05), (0.0, 5, 1.0)):
        assert t_tail(t / math.sqrt(freedom + t * t), freedom) == pytest.approx(p, rel=1e-4)
    df = spark.createDataFrame([(0.5, 12), (1.0, 9), (None, 9), (0.2, 2)], "spearman double, n bigint")
    got = [r.p_value for r in with_p_value(df).collect()]
    assert got[0] == pytest.approx(0.0978, abs=1e-3) and got[1] == 0 and got[2] is None and got[3] is None


def test_plans_stay_small(spark):
    """Grouped maps, scans of the line items and exchanges on a key of the plans that were the largest."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lambda q: QUERIES[q](spark, SF)._jdf.queryExecution().executedPlan().toString()
        table = plan("feature_table")
        assert table.count("FlatMapGroups") == 1 and table.count("lineitem.parquet") <= 2
        returns = plan("portfolio_returns")
        assert returns.count("Scan parquet") == 0 and returns.count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.isoformat()[:10] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    want = [dict(zip(names, map(plain, r))) for r in found.fetchall()]
    got = [{k: plain(v) for k, v in r.asDict().items()} for r in QUERIES[name](spark, SF).collect()]
    keys = [c for c in sorted(names) if not any(isinstance(r[c], float) for r in want)]
    order = lambda r: [(r[c] is None, str(r[c])) for c in keys]
    assert len(got) == len(want) and (not got or set(got[0]) == set(names))
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        for c in names:
            assert a[c] == (pytest.approx(b[c], rel=1e-6, abs=2e-6) if isinstance(b[c], float) else b[c]), (c, a, b)


def test_all_sql_belongs_to_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and os.path.isdir(SF)


def test_macro_features_of_missing_inputs(spark):
    """Without its inputs a feature is left out; missing values make flags 0 and numbers null; an empty table stays empty."""
    from tidemark.operators.macro import macro_features, macro_table

    rows = spark.sql("SELECT date_add(DATE '2024-01-01', id::int) AS date, IF(id = 3, NULL, 10.0 + 10 * id) AS vix, id AS extra FROM range(12)")
    out = {r["date"].day: r for r in macro_features(rows).collect()}
    assert [out[d]["vix_regime"] for d in (1, 2, 3, 4, 11, 12)] == ["low", "normal", "high", "nan", "nan", "nan"]
    assert out[4]["vix_above_ma20"] == 0 and out[4]["vix_term_structure"] is None and out[6]["extra"] == 5
    assert out[9]["vix_5d_pct"] == pytest.approx(90 / 30 - 1)  # the value before the gap is carried forward
    assert "yc_slope_10y2y" not in rows.columns and "usd_z" not in macro_features(rows).columns
    assert macro_table(rows.limit(0), rows.select("date", "extra", (rows.vix + 1).alias("btc_price")).drop("extra")).count() == 0
    flows = rows.select("date", (rows.vix / 10).alias("hyg_abnormal_volume"))
    assert {"credit_flow_signal", "flow_risk_on", "risk_appetite_v2"} <= set(macro_table(rows, flows=flows).columns)


def test_overall_ranks(spark):
    """Mean ranks of ties, whatever the ranges; nulls have none."""
    import random

    random.seed(3)
    values = [random.choice([None, 1.0, 2.0, random.random()]) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    from tidemark.operators.evaluate import with_overall_rank

    known = sorted(v for v in values if v is not None)
    want = sorted(((v, known.index(v) + (known.count(v) + 1) / 2) for v in known))
    got = [tuple(r) for r in with_overall_rank(rows, "x", "r", ranges=7).collect()]
    assert sorted(g for g in got if g[0] is not None) == want and sum(g[1] is None for g in got) == values.count(None)
    assert with_overall_rank(rows.limit(0), "x", "r").count() == 0


def test_models_recover_a_line(spark):
    """Each model beats the zero forecast on rows after the split; a category unknown in training has no effect."""
    from tidemark.operators import model as L
    from tidemark.operators.evaluate import scores, split_at

    rows = spark.sql("""SELECT date_add(DATE '2024-01-01', (id % 100)::int) AS date, 's' || (id div 100) AS symbol, sin(id) AS x, cos(id * id) AS news_emb_0, sin(id * 3) AS news_emb_1,
        (id % 2)::double AS even, IF(id % 100 > 90, 'new', IF(id % 3 = 0, 'a', 'b')) AS kind, 2 * sin(id) + 0.1 * cos(id * 7) AS target FROM range(2000)""")
    train, test = split_at(rows, "2024-03-20")
    columns = ["x", "news_emb_0", "news_emb_1", "even", "kind"]
    models = {"boosting": L.gradient_boosting(30, 0.3, share=1.0), "forest": L.random_forest(20, rows=1.0, share=1.0, leaf=10), "linear": L.linear(), "huber": L.huber(), "lasso": L.lasso((1e-3, 1e-2))}
    found = L.forecasts(train, test, columns, models, components=1, blends={"mean": ["linear", "lasso"]})
    got = {r["model"]: r for r in scores(found, "model").collect()}
    n = test.count()
    assert {m: r["n"] for m, r in got.items()} == dict.fromkeys([*models, "mean"], n)
    assert min(r["improvement_pct"] for r in got.values()) > 30, {m: r["improvement_pct"] for m, r in got.items()}
    assert got["lasso"]["improvement_pct"] > 90
    assert len(L.explained_variance(L.fit_preparation(train, columns, 2))) == 2
    with pytest.raises(ValueError):
        L.forecasts(train, test, columns, {})


def test_tfidf_against_brute_force(spark):
    """Terms of one and two words, smooth idf and unit length, by plain counting; null and empty texts have no terms."""
    import re
    from collections import Counter

    from pyspark.ml.feature import StopWordsRemover

    rows = [(1, "Rates rise again", "markets fall as rates rise"), (2, "Markets fall", None), (3, None, ""), (4, "rates", "rates rates rise markets")]
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    terms = {}
    for i, a, b in rows:
        w = [x for x in re.findall(r"\w\w+", f"{a or ''} {b or ''}".lower()) if x not in stop]
        terms[i] = Counter(w + [" ".join(x) for x in zip(w, w[1:])])
    df = Counter(t for c in terms.values() for t in c)
    want = {}
    for i, c in terms.items():
        raw = {t: n * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, n in c.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        want |= {(i, t): v / length for t, v in raw.items()}
    got = {(r.id, r.term): r.weight for r in N.tfidf(spark.createDataFrame(rows, "id int, headline string, description string"), ["headline", "description"]).collect()}
    assert got == pytest.approx(want)


def test_correlated_columns_against_pandas(spark):
    from tidemark.operators.evaluate import correlated_columns

    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 200))
    frame = pd.DataFrame({"a": a, "b": b, "a2": 3 * a + 0.01 * b, "c": rng.normal(size=200), "b2": 0.5 * b})
    corr, var = frame.corr().abs(), frame.var()
    dropped = set()
    for i, c in enumerate(frame.columns):
        near = [x for x in frame.columns[:i] if corr.loc[c, x] > 0.8]
        if near:
            dropped |= {*near, c} - {max([*near, c], key=lambda x: var[x])}
    assert set(correlated_columns(spark.createDataFrame(frame), list(frame.columns), 0.8)) == dropped == {"a", "b2"}


def test_permutation_importance_and_families(spark):
    """Dealing a used feature to other rows makes the error rise, an unused one not; families by beginnings."""
    from tidemark.operators import evaluate as V

    df = spark.sql("SELECT date_add(DATE '2024-01-01', (id % 100)::int) AS date, 's' || (id div 100) AS symbol, sin(id) AS vix_a, cos(id * 3) AS news_b, 2 * sin(id) AS actual FROM range(2000)")
    found = V.permutation_importance(df, ["vix_a", "news_b"], lambda x: x.withColumn("prediction", 2 * F.col("vix_a")), repeats=2)
    got = {r.feature: r.importance for r in found.collect()}
    assert got["vix_a"] > 1 and got["news_b"] == pytest.approx(0)
    rows = sorted(df.collect(), key=lambda r: (r.date, r.symbol))
    x, y = np.array([r.vix_a for r in rows]), np.array([r.actual for r in rows])
    rises = []
    for j, a in enumerate(V.dealing_primes(2)):
        dealt = np.empty(len(x))
        dealt[(a * np.arange(len(x)) + 7919 * (j + 1)) % len(x)] = x
        assert sorted(dealt) == sorted(x)
        rises.append(np.sqrt(np.mean((2 * dealt - y) ** 2)) - np.sqrt(np.mean((2 * x - y) ** 2)))
    assert got["vix_a"] == pytest.approx(np.mean(rises), abs=1e-12)
    group = "importance"
    spark.sparkContext.setJobGroup(group, "")
    V.permutation_importance(df, ["vix_a", "news_b"], lambda x: x.withColumn("prediction", 2 * F.col("vix_a")), repeats=5).write.format("noop").mode("overwrite").save()
    executions = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    V.permutation_importance(df, ["vix_a"], lambda x: x.withColumn("prediction", 2 * F.col("vix_a")), repeats=1).write.format("noop").mode("overwrite").save()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 2 * executions  # as many for one feature as for ten variants
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    names = ["news_emb_3", "news_mean", "insider_buys", "revision_net", "vix_regime", "cpi_mom", "return_1lag"]
    out = spark.createDataFrame([(n,) for n in names], "f string").select(V.family(F.col("f"))).collect()
    assert [r[0] for r in out] == ["news_embedding", "news_sentiment", "alternative", "alternative", "macro", "macro", "price/tech"]
    assert {r.family: r.n for r in V.family_importance(found).collect()} == {"macro": 1, "news_sentiment": 1}
