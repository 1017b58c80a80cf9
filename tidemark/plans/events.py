"""Queries over event sources, macro series, news and portfolios, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import change
from tidemark.operators import evaluate as V
from tidemark.operators import events as E
from tidemark.operators import features as X
from tidemark.operators import news as N
from tidemark.plans.bars import _PX, _PX1, BARS_SQL, S, r, roll
from tidemark.sources.fixtures import ANALYST_SQL, ARTICLES_SQL, FUNDS, INSIDER_SQL, MACRO_SQL, ORDER_DAYS_SQL, analyst_rows, articles, bars, days_of, insider_rows, macro_series, order_days, table

QUERIES: dict = {}


def _spark(f):
    QUERIES[f.__name__] = f
    return f


def _round(df: DataFrame, keys: list[str], columns: list[str], digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*keys, *[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c).cast("bigint").alias(c) if kinds[c] in ("int", "bigint") else F.col(c) for c in columns])


TD = ["ticker", "date"]
EVENT_DAYS_SQL = ("(SELECT min(ts)::DATE FROM events)", "(SELECT max(ts)::DATE FROM events)")
INSIDER = ["insider_buys", "insider_sells", "insider_buy_value", "insider_sell_value", "insider_transaction_count", "officer_buys", "officer_sells", "grant_count", "grant_shares", "tax_withheld_count", "tax_withheld_shares", "option_exercises", "gift_count", "insider_net_transactions", "insider_net_value", "insider_buy_ratio"]


@_spark
def insider_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.insider_daily(insider_rows(spark, sf)), TD, INSIDER)


def _tickers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_name").alias("ticker"))


INSIDER_X = ["insider_buys_30d", "insider_sells_30d", "insider_activity_5d", "insider_buy_value_30d", "insider_net_value_30d", "insider_officer_buy_ratio", "grant_intensity_30d", "tax_event_30d", "option_exercise_30d", "total_disposal_30d", "compensation_style_90d"]


@_spark
def insider_features(spark: SparkSession, sf: str) -> DataFrame:
    grid = E.spine(_tickers(spark, sf), *days_of(table(spark, sf, "events"), "ts"))
    return _round(E.insider_features(grid, E.insider_daily(insider_rows(spark, sf))), TD, INSIDER_X)


def _congress(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("code") == "M", "purchase").when(F.col("code") == "S", "sale (full)").otherwise("exchange")
    return insider_rows(spark, sf).select(*TD, kind.alias("type"))


@_spark
def congress_features(spark: SparkSession, sf: str) -> DataFrame:
    out = E.congress_features(E.spine(_tickers(spark, sf), *days_of(table(spark, sf, "events"), "ts")), E.congress_daily(_congress(spark, sf)))
    return _round(out, TD, ["congress_net", "congress_trade_count", "congress_activity_30d", "congress_buy_signal"])


def _views(spark: SparkSession, sf: str) -> DataFrame:
    return insider_rows(spark, sf).where("code = 'S'").groupBy(*TD).agg(F.count("*").alias("views"))


@_spark
def attention_features(spark: SparkSession, sf: str) -> DataFrame:
    out = E.attention_features(E.spine(_tickers(spark, sf), *days_of(table(spark, sf, "events"), "ts")), E.pageview_features(_views(spark, sf)))
    return _round(out, TD, ["views", "pageviews_ma7", "attention_spike", "attention_trend"])


def _earnings(spark: SparkSession, sf: str) -> DataFrame:
    first = analyst_rows(spark, sf).withColumn("q", F.trunc("date", "quarter")).groupBy("ticker", "q").agg(F.min_by(F.struct("date", "target"), F.struct("date", "id")).alias("x"))
    rows = first.select("ticker", F.col("x.date").alias("date"), F.col("x.target").alias("actual"))
    return rows.withColumn("estimate", F.lag("actual").over(Window.partitionBy("ticker").orderBy("date")))


@_spark
def earnings_surprise(spark: SparkSession, sf: str) -> DataFrame:
    """All reports, and as schedule each ticker's last report and a quarter: what lies after the last day of all is the next one."""
    rows = _earnings(spark, sf)
    schedule = rows.groupBy("ticker").agg(F.date_add(F.max("date"), 91).alias("date"))
    return _round(E.with_next_scheduled(E.earnings_surprise(rows), schedule, order_days(spark, sf)[1]), [*TD, "scheduled"], ["surprise", "surprise_pct"], 4)


EARNINGS_X = ["earnings_surprise_pct", "earnings_beat", "days_since_earnings", "days_to_next_earnings", "earnings_surprise_ma"]


@_spark
def earnings_features(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.earnings_features(E.spine(_tickers(spark, sf), *order_days(spark, sf)), E.earnings_surprise(_earnings(spark, sf))), TD, EARNINGS_X, 4)


def _revisions(spark: SparkSession, sf: str) -> DataFrame:
    landed = analyst_rows(spark, sf).select("ticker", F.col("date").cast("string").alias("GradeDate"), "firm", F.col("to_grade").alias("ToGrade"), F.col("from_grade").alias("FromGrade"), F.col("action").alias("Action"))
    return E.classify_revisions(E.grade_changes(landed, *order_days(spark, sf)))


@_spark
def revision_features(spark: SparkSession, sf: str) -> DataFrame:
    out = E.revision_features(E.spine(_tickers(spark, sf), *order_days(spark, sf)), E.revisions_daily(_revisions(spark, sf)))
    return _round(out, TD, ["revision_upgrades_30d", "revision_downgrades_30d", "revision_net_30d", "revision_activity", "revision_momentum", "revision_sentiment"])


@_spark
def revisions_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.revisions_daily(_revisions(spark, sf)), TD, ["upgrades", "downgrades", "initiations", "reiterations", "revisions", "net_revisions"])


TARGETS = ["pt_mean", "pt_high", "pt_low", "pt_count", "pt_revision_direction"]


@_spark
def targets_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.targets_daily(E.target_direction(analyst_rows(spark, sf))), TD, TARGETS, 4)


@_spark
def target_features(spark: SparkSession, sf: str) -> DataFrame:
    out = E.target_features(E.spine(_tickers(spark, sf), *order_days(spark, sf)), E.targets_daily(E.target_direction(analyst_rows(spark, sf))))
    return _round(out, TD, ["pt_mean", "pt_count", "pt_dispersion", "pt_momentum_60d"], 4)


@_spark
def short_interest_features(spark: SparkSession, sf: str) -> DataFrame:
    b = bars(spark, sf).withColumnRenamed("symbol", "ticker")
    half = F.when(F.day("date") <= 15, F.date_add(F.trunc("date", "month"), 14)).otherwise(F.last_day("date"))
    rows = b.groupBy("ticker", half.alias("date")).agg(F.sum("volume").alias("short"), F.avg("volume").alias("daily"))
    before = F.lag("short").over(Window.partitionBy("ticker").orderBy("date"))
    rows = rows.withColumns({"days_to_cover": F.col("short") / F.col("daily"), "short_pct_chg": 100 * (F.col("short") / before - 1)})
    return _round(E.short_interest_features(E.spine(_tickers(spark, sf), *order_days(spark, sf)), rows), TD, ["days_to_cover", "short_pct_chg", "short_squeeze_risk"], 4)


RS = ["r1", "r2", "r3", "r4", "r5"]


@_spark
def macro_grid(spark: SparkSession, sf: str) -> DataFrame:
    a = E.series_on_grid(macro_series(spark, sf), RS, *order_days(spark, sf))
    b = E.series_on_grid(macro_series(spark, sf), RS, *order_days(spark, sf), mode="reference").select("date", F.col("r1").alias("r1_grid_only"))
    return _round(a.join(b, "date"), ["date"], [*RS, "r1_grid_only"], 9)


@_spark
def macro_join(spark: SparkSession, sf: str) -> DataFrame:
    macro = E.series_on_grid(macro_series(spark, sf), RS, *order_days(spark, sf))
    return _round(E.macro_join(E.spine(_tickers(spark, sf), *order_days(spark, sf)), macro, ["r1", "r2"]), TD, ["r1", "r2", "r1_5d_change", "r2_5d_change"], 9)


@_spark
def fund_flows(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.fund_flows(bars(spark, sf).where(F.col("symbol").isin(FUNDS))), ["symbol", "date"], ["dollar_volume", "abnormal_volume", "flow_momentum"], 4)


@_spark
def news_clean(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", N.clean_html(F.col("html")).alias("text"))


@_spark
def news_merge(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf)
    return N.merge_sources([a.where("id % 3 = 0"), a.where("id % 3 != 0")]).select("id", "ticker", "date", "source")


@_spark
def news_daily_vectors(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf).select("id", *TD).join(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), "id")
    out = N.daily_vectors(a).select(*TD, F.posexplode("embedding").alias("place", "x"))
    return out.select(*TD, F.col("place").cast("bigint").alias("place"), F.round("x", 6).alias("x"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """date, symbol, prediction (lagged distance from the mean of twenty) and actual (a hundredth of the return of five rows)."""
    df = X.target(bars(spark, sf).withColumn("p", change("close", X.sma("close", 20))), 5)
    return X.shifted(df, ["p"]).select("date", "symbol", F.col("p").alias("prediction"), (F.col("target") / 100).alias("actual"))


@_spark
def forecast_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.scores(predictions(spark, sf)), [], ["n", "rmse", "rmse_zero", "accuracy", "pearson", "spearman", "improvement_pct"])


@_spark
def forecast_persistence(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.scores(V.persistence(predictions(spark, sf)).dropna()), [], ["n", "rmse", "accuracy", "pearson"])


@_spark
def forecast_clipped(spark: SparkSession, sf: str) -> DataFrame:
    p = predictions(spark, sf).dropna()
    train, test = V.split_at(p.withColumn("target", F.col("actual") / 3), "1999-01-01")
    return _round(V.clip_predictions(V.ensemble(test, V.persistence(test).dropna()), train), ["date", "symbol"], ["prediction"])


@_spark
def forecast_daily_ic(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.daily_ic(predictions(spark, sf)), ["date"], ["n", "ic", "ic_mean"])


@_spark
def forecast_symbol_ic(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.symbol_ic(predictions(spark, sf)), ["symbol"], ["n", "rmse", "accuracy", "ic"])


@_spark
def forecast_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.summary(predictions(spark, sf), "actual", "symbol"), ["symbol"], ["n", "mean", "std", "min", "q25", "q50", "q75", "max"])


@_spark
def portfolio_legs(spark: SparkSession, sf: str) -> DataFrame:
    return V.legs(predictions(spark, sf)).select("date", "symbol", "leg")


PORTFOLIO = ["long_return", "short_return", "gross", "turnover", "net"]


@_spark
def portfolio_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.growth(V.portfolio(predictions(spark, sf))), ["date"], ["period", *PORTFOLIO, "cumulative", "drawdown"])


@_spark
def portfolio_performance(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.performance(V.portfolio(predictions(spark, sf))), [], ["annual_return", "annual_volatility", "sharpe", "total_return", "max_drawdown", "win_rate", "periods"])


@_spark
def portfolio_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _round(V.monthly(V.portfolio(predictions(spark, sf))), ["month"], ["ret"])


@_spark
def correlated_features(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"sma_ratio_{n}" for n in (5, 10, 20, 50)] + ["return_1lag"]
    df = X.price_features(bars(spark, sf)).withColumns({f"sma_ratio_{n}": change("close", X.sma("close", n)) for n in (5, 10, 20, 50)})
    return spark.createDataFrame([(c,) for c in V.correlated_columns(df, names, 0.8)], "feature string")


_SPINE = lambda a, b: f"spine AS (SELECT n_name AS ticker, d::DATE AS date FROM nation, (SELECT unnest(generate_series({a}, {b}, INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6)"
_ID = r"insider_daily AS (SELECT ticker, date, count_if(code = 'P') AS insider_buys, count_if(code = 'S') AS insider_sells, coalesce(sum(value) FILTER (code = 'P'), 0) AS insider_buy_value, coalesce(sum(value) FILTER (code = 'S'), 0) AS insider_sell_value, count(*) AS insider_transaction_count, count_if(code = 'P' AND officer) AS officer_buys, count_if(code = 'S' AND officer) AS officer_sells, count_if(code = 'A') AS grant_count, coalesce(sum(shares) FILTER (code = 'A'), 0) AS grant_shares, count_if(code = 'F') AS tax_withheld_count, coalesce(sum(shares) FILTER (code = 'F'), 0) AS tax_withheld_shares, count_if(code = 'M') AS option_exercises, count_if(code = 'G') AS gift_count FROM (SELECT *, coalesce(regexp_matches(lower(position), '\b(ceo|cfo|coo|cto|president|officer|evp|svp|vp|counsel|secretary|treasurer|principal|controller|managing)\b'), false) AS officer FROM insider) GROUP BY ticker, date)"
_COUNTS = ["insider_buys", "insider_sells", "insider_transaction_count", "officer_buys", "officer_sells", "grant_count", "tax_withheld_count", "option_exercises", "gift_count"]
_T = lambda f, c, n: f"{f}({c}) OVER (PARTITION BY ticker ORDER BY date ROWS {n - 1} PRECEDING)"
_CARRY = lambda c, by="PARTITION BY ticker": f"last_value({c} IGNORE NULLS) OVER ({by} ORDER BY date ROWS UNBOUNDED PRECEDING)"
_W = "WINDOW t AS (PARTITION BY ticker ORDER BY date)"
_EARN = """firsts AS (SELECT ticker, date_trunc('quarter', date) AS q, min_by({'d': date, 't': target}, {'d': date, 'i': id}) AS x FROM analyst GROUP BY ALL), earn AS (SELECT ticker, x.d AS date, x.t AS actual, lag(x.t) OVER (PARTITION BY ticker ORDER BY x.d) AS estimate FROM firsts),
surprises AS (SELECT *, actual - estimate AS surprise, 100 * (actual - estimate) / nullif(abs(estimate), 0) AS surprise_pct FROM earn)"""
_UP = "buy|overweight|outperform|strong buy|positive|sector outperform|top pick|conviction buy|accumulate|above average|add|long-term buy|market outperform|strong outperform|sector perform/outperform"
_DOWN = "sell|underweight|underperform|reduce|negative|sector underperform|strong sell|avoid|below average|market underperform"
_FLAT = "hold|neutral|equal-weight|market perform|sector perform|peer perform|in-line|perform|sector weight|market weight|fair value"
_GRADE = lambda c: "CASE " + " ".join(f"WHEN regexp_{how}_match({c}, '{names}') THEN {score}" for how in ("full", "any") for names, score in ((_UP, 1), (_DOWN, -1), (_FLAT, 0))).replace("regexp_any_match", "regexp_matches") + " END"
_REV = f"""revs AS (SELECT *, lower(trim(coalesce(action, ''))) AS a, {_GRADE("lower(trim(to_grade))")} AS t, {_GRADE("lower(trim(from_grade))")} AS f FROM analyst),
dirs AS (SELECT *, CASE WHEN a = 'up' THEN 1 WHEN a = 'down' THEN -1 WHEN t != f THEN sign(t - f) WHEN a IN ('init', 'initiated', 'initiate') THEN coalesce(t, 0) WHEN t IS NOT NULL AND f IS NULL THEN t ELSE 0 END AS direction FROM revs),
rev_daily AS (SELECT ticker, date, count_if(direction > 0) AS upgrades, count_if(direction < 0) AS downgrades, count_if(contains(a, 'init')) AS initiations, count_if(contains(a, 'reit') OR contains(a, 'main')) AS reiterations, count(*) AS revisions, count_if(direction > 0) - count_if(direction < 0) AS net_revisions FROM dirs GROUP BY ticker, date)"""
_TARGET = """moves AS (SELECT *, coalesce(sign(target - lag(target) OVER (PARTITION BY ticker, firm ORDER BY date, id)), 0) AS move FROM analyst),
pt AS (SELECT ticker, date, avg(target) AS pt_mean, max(target) AS pt_high, min(target) AS pt_low, count(*) AS pt_count, round_even(avg(move), 0) AS pt_revision_direction FROM moves GROUP BY ticker, date)"""
_GRID = f"""wide AS (SELECT date, {", ".join(f"max(value) FILTER (series = '{c}') AS {c}" for c in RS)} FROM series GROUP BY date),
days AS (SELECT unnest(generate_series({ORDER_DAYS_SQL[0]}, {ORDER_DAYS_SQL[1]}, INTERVAL 1 DAY))::DATE AS date),
macro AS (SELECT * FROM (SELECT date, {", ".join(f"{_CARRY(c, '')} AS {c}" for c in RS)} FROM days LEFT JOIN wide USING (date)) WHERE isodow(date) < 6)"""
_PRED = f"{BARS_SQL}, sma AS (SELECT *, close / nullif({roll('avg', 'close', 20)}, 0) - 1 AS p FROM bars), pred AS (SELECT date, symbol, lag(p) OVER s AS prediction, (lead(close, 5) OVER s / nullif(close, 0) - 1) / 100 AS actual FROM sma {S}), full_pred AS (SELECT * FROM pred WHERE prediction IS NOT NULL AND actual IS NOT NULL)"
_RANKS = lambda keys: f"ranks AS (SELECT *, {', '.join(f'rank() OVER ({keys} ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}{keys and chr(44) + keys[12:]}) - 1) / 2.0::DOUBLE AS {n}' for c, n in (('prediction', 'rp'), ('actual', 'ra')))} FROM full_pred)"
_SCORES = {"rmse": "sqrt(avg(pow(prediction - actual, 2)))", "rmse_zero": "sqrt(avg(pow(actual, 2)))", "accuracy": "avg(((prediction > 0) = (actual > 0))::INT)", "pearson": "corr(prediction, actual)", "spearman": "corr(rp, ra)", "improvement_pct": "100 * (1 - sqrt(avg(pow(prediction - actual, 2))) / sqrt(avg(pow(actual, 2))))"}
_LEGS = f"""{_PRED}, dts AS (SELECT DISTINCT date FROM full_pred), reb AS (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) AS n FROM dts) WHERE (n - 1) % 5 = 0),
ranked AS (SELECT p.*, row_number() OVER (PARTITION BY date ORDER BY prediction, symbol) AS up, row_number() OVER (PARTITION BY date ORDER BY prediction DESC, symbol DESC) AS down, count(*) OVER (PARTITION BY date) AS n FROM full_pred p JOIN reb USING (date)),
legs AS (SELECT * FROM (SELECT date, symbol, actual, CASE WHEN down <= greatest(1, floor(n * 0.2::DOUBLE)) THEN 'long' WHEN up <= greatest(1, floor(n * 0.2::DOUBLE)) THEN 'short' END AS leg FROM ranked WHERE n >= 10) WHERE leg IS NOT NULL)"""
_PORT = f"""{_LEGS}, held AS (SELECT *, dense_rank() OVER (ORDER BY date) AS period FROM legs),
fresh AS (SELECT h.period, h.leg, count(*) AS fresh FROM held h LEFT JOIN held b ON h.period = b.period + 1 AND h.leg = b.leg AND h.symbol = b.symbol WHERE b.symbol IS NULL GROUP BY ALL),
byleg AS (SELECT period, date, leg, avg(actual) AS m, count(*) AS n FROM held GROUP BY ALL),
port AS (SELECT period, date, max(m) FILTER (leg = 'long') AS long_return, max(m) FILTER (leg = 'short') AS short_return, avg(coalesce(fresh, 0) / n::DOUBLE) AS turnover FROM byleg LEFT JOIN fresh USING (period, leg) GROUP BY period, date),
net AS (SELECT *, long_return - short_return AS gross, long_return - short_return - turnover * 10 / 1e4 * 2 AS net FROM port),
grown AS (SELECT *, product(1 + net) OVER (ORDER BY period) AS cumulative FROM net), drawn AS (SELECT *, cumulative / max(cumulative) OVER (ORDER BY period) - 1 AS drawdown FROM grown)"""

ORACLES = {
    "insider_daily": f"WITH {INSIDER_SQL}, {_ID} SELECT ticker, date, {', '.join(f'{c}::BIGINT AS {c}' for c in _COUNTS)}, {r(['insider_buy_value', 'insider_sell_value', 'grant_shares', 'tax_withheld_shares'])}, (insider_buys - insider_sells)::BIGINT AS insider_net_transactions, round(insider_buy_value - insider_sell_value, 6) AS insider_net_value, round(insider_buys / greatest(insider_transaction_count, 1)::DOUBLE, 6) AS insider_buy_ratio FROM insider_daily",
    "insider_features": f"""WITH {INSIDER_SQL}, {_ID}, {_SPINE(*EVENT_DAYS_SQL)}, g AS (SELECT ticker, date, {", ".join(f"coalesce({c}, 0) AS {c}" for c in [*_COUNTS, "insider_buy_value", "insider_sell_value"])} FROM spine LEFT JOIN insider_daily USING (ticker, date)),
f AS (SELECT *, {_T("sum", "insider_buys", 30)} AS b, {_T("sum", "insider_sells", 30)} AS s, {_T("sum", "tax_withheld_count", 30)} AS tax FROM g)
SELECT ticker, date, b::BIGINT AS insider_buys_30d, s::BIGINT AS insider_sells_30d, {_T("sum", "insider_transaction_count", 5)}::BIGINT AS insider_activity_5d, round({_T("sum", "insider_buy_value", 30)}, 6) AS insider_buy_value_30d, round({_T("sum", "(insider_buy_value - insider_sell_value)", 30)}, 6) AS insider_net_value_30d, round({_T("sum", "officer_buys", 30)} / greatest(b, 1)::DOUBLE, 6) AS insider_officer_buy_ratio,
{_T("sum", "grant_count", 30)}::BIGINT AS grant_intensity_30d, tax::BIGINT AS tax_event_30d, {_T("sum", "option_exercises", 30)}::BIGINT AS option_exercise_30d, (s + tax)::BIGINT AS total_disposal_30d, round({_T("sum", "grant_count", 90)} / nullif({_T("sum", "grant_count", 90)} + {_T("sum", "insider_sells", 90)}, 0)::DOUBLE, 6) AS compensation_style_90d FROM f""",
    "congress_features": f"""WITH {INSIDER_SQL}, {_SPINE(*EVENT_DAYS_SQL)}, c AS (SELECT ticker, date, count_if(code = 'M') - count_if(code = 'S') AS net, count(*) AS n FROM insider GROUP BY ALL), g AS (SELECT ticker, date, coalesce(net, 0) AS net, coalesce(n, 0) AS n FROM spine LEFT JOIN c USING (ticker, date))
SELECT ticker, date, net::BIGINT AS congress_net, n::BIGINT AS congress_trade_count, {_T("sum", "n", 30)}::BIGINT AS congress_activity_30d, ({_T("sum", "net", 30)} > 0)::BIGINT AS congress_buy_signal FROM g""",
    "attention_features": f"""WITH {INSIDER_SQL}, {_SPINE(*EVENT_DAYS_SQL)}, v AS (SELECT ticker, date, count(*) AS views FROM insider WHERE code = 'S' GROUP BY ALL),
w AS (SELECT *, {_T("avg", "views", 7)} AS ma7, (views > {_T("avg", "views", 30)} + 2 * coalesce({_T("stddev_samp", "views", 30)}, 0))::INT AS spike FROM v),
j AS (SELECT ticker, date, coalesce({_CARRY("views")}, 0) AS views, coalesce({_CARRY("ma7")}, 0) AS ma7, coalesce({_CARRY("spike")}, 0) AS spike FROM spine LEFT JOIN w USING (ticker, date))
SELECT ticker, date, views::BIGINT AS views, round(ma7, 6) AS pageviews_ma7, spike::BIGINT AS attention_spike, round(ma7 / greatest({_T("avg", "views", 30)}, 1), 6) AS attention_trend FROM j""",
    "earnings_surprise": f"""WITH {ANALYST_SQL}, {_EARN}, nxt AS (SELECT ticker, max(date) + 91 AS date FROM earn GROUP BY ticker)
SELECT ticker, date, false AS scheduled, {r(["surprise", "surprise_pct"], 4)} FROM surprises UNION ALL SELECT ticker, date, true, NULL, NULL FROM nxt WHERE date > {ORDER_DAYS_SQL[1]}""",
    "earnings_features": f"""WITH {ANALYST_SQL}, {_EARN}, {_SPINE(*ORDER_DAYS_SQL)}, rep AS (SELECT ticker, date, max(surprise_pct) AS sp FROM surprises GROUP BY ALL), ma AS (SELECT *, {_T("avg", "sp", 4)} AS ma FROM rep),
j AS (SELECT s.ticker, s.date, sp, ma, m.date IS NOT NULL AS rep, row_number() OVER (PARTITION BY s.ticker ORDER BY s.date) AS n FROM spine s LEFT JOIN ma m USING (ticker, date)), k AS (SELECT *, CASE WHEN rep THEN n END AS pos FROM j)
SELECT ticker, date, round({_CARRY("sp")}, 4) AS earnings_surprise_pct, (sp > 0)::BIGINT AS earnings_beat, (n - {_CARRY("pos")})::BIGINT AS days_since_earnings, (first_value(pos IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - n)::BIGINT AS days_to_next_earnings, round({_CARRY("ma")}, 4) AS earnings_surprise_ma FROM k""",
    "revisions_daily": f"WITH {ANALYST_SQL}, {_REV} SELECT ticker, date, {', '.join(f'{c}::BIGINT AS {c}' for c in ('upgrades', 'downgrades', 'initiations', 'reiterations', 'revisions', 'net_revisions'))} FROM rev_daily",
    "revision_features": f"""WITH {ANALYST_SQL}, {_REV}, {_SPINE(*ORDER_DAYS_SQL)}, g AS (SELECT ticker, date, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("upgrades", "downgrades", "revisions", "net_revisions"))} FROM spine LEFT JOIN rev_daily USING (ticker, date)),
f AS (SELECT *, {_T("sum", "upgrades", 30)} AS u, {_T("sum", "downgrades", 30)} AS d, {_T("sum", "net_revisions", 30)} AS n30, {_T("sum", "net_revisions", 90)} AS n90, {_T("sum", "revisions", 5)} AS a FROM g)
SELECT ticker, date, u::BIGINT AS revision_upgrades_30d, d::BIGINT AS revision_downgrades_30d, n30::BIGINT AS revision_net_30d, a::BIGINT AS revision_activity, round(n30 - n90 / 3::DOUBLE, 6) AS revision_momentum, round(greatest(-1, least(1, coalesce(n30 / nullif(u + d, 0)::DOUBLE, 0))), 6) AS revision_sentiment FROM f""",
    "targets_daily": f"WITH {ANALYST_SQL}, {_TARGET} SELECT ticker, date, {r(['pt_mean', 'pt_high', 'pt_low'], 4)}, pt_count::BIGINT AS pt_count, pt_revision_direction::BIGINT AS pt_revision_direction FROM pt",
    "target_features": f"""WITH {ANALYST_SQL}, {_TARGET}, {_SPINE(*ORDER_DAYS_SQL)}, j AS (SELECT ticker, date, {", ".join(f"{_CARRY(c)} AS {c}" for c in ("pt_mean", "pt_high", "pt_low", "pt_count"))} FROM spine LEFT JOIN pt USING (ticker, date))
SELECT ticker, date, round(pt_mean, 4) AS pt_mean, pt_count::BIGINT AS pt_count, round((pt_high - pt_low) / nullif(pt_mean, 0), 4) AS pt_dispersion, round(pt_mean / nullif(lag(pt_mean, 60) OVER t, 0) - 1, 4) AS pt_momentum_60d FROM j {_W}""",
    "short_interest_features": f"""WITH {BARS_SQL}, h AS (SELECT symbol AS ticker, CASE WHEN day(date) <= 15 THEN (date_trunc('month', date) + INTERVAL 14 DAY)::DATE ELSE last_day(date) END AS date, sum(volume) AS short, avg(volume) AS daily FROM bars GROUP BY ALL),
s AS (SELECT ticker, date, short / daily AS dtc, 100 * (short / lag(short) OVER t - 1) AS chg FROM h {_W}), {_SPINE(*ORDER_DAYS_SQL)}, j AS (SELECT ticker, date, {_CARRY("dtc")} AS dtc, {_CARRY("chg")} AS chg FROM spine LEFT JOIN s USING (ticker, date))
SELECT ticker, date, round(dtc, 4) AS days_to_cover, round(chg, 4) AS short_pct_chg, CASE WHEN dtc IS NOT NULL THEN coalesce(chg > 0 AND dtc > 5, false)::BIGINT END AS short_squeeze_risk FROM j""",
    "macro_grid": f"""WITH {MACRO_SQL}, {_GRID}, ongrid AS (SELECT date, {_CARRY("r1", "")} AS r1_grid_only FROM (SELECT * FROM days WHERE isodow(date) < 6) LEFT JOIN wide USING (date)) SELECT date, {r([*RS, "r1_grid_only"], 9)} FROM macro JOIN ongrid USING (date)""",
    "macro_join": f"""WITH {MACRO_SQL}, {_GRID}, {_SPINE(*ORDER_DAYS_SQL)}, j AS (SELECT ticker, date, {_CARRY("r1")} AS r1, {_CARRY("r2")} AS r2 FROM spine LEFT JOIN macro USING (date)) SELECT ticker, date, {r({"r1": "r1", "r2": "r2", "r1_5d_change": "r1 - lag(r1, 5) OVER t", "r2_5d_change": "r2 - lag(r2, 5) OVER t"}, 9)} FROM j {_W}""",
    "fund_flows": f"""WITH {BARS_SQL}, d AS (SELECT symbol, date, close * volume AS dv FROM bars WHERE symbol IN ('NATION_0', 'NATION_1', 'NATION_2'))
SELECT symbol, date, round(dv, 4) AS dollar_volume, round((dv - CASE WHEN count(dv) OVER f >= 5 THEN avg(dv) OVER f END) / greatest(stddev_samp(dv) OVER f, 1), 4) AS abnormal_volume, round(dv / nullif(lag(dv, 5) OVER s, 0) - 1, 4) AS flow_momentum FROM d WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING), s AS (PARTITION BY symbol ORDER BY date)""",
    "news_clean": r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages",
    "news_merge": f"WITH {ARTICLES_SQL} SELECT id, ticker, date, source FROM (SELECT *, row_number() OVER (PARTITION BY ticker, headline ORDER BY (id % 3 != 0)::INT, id) AS n FROM articles) WHERE n = 1",
    "news_daily_vectors": f"WITH {ARTICLES_SQL}, p AS (SELECT ticker, date, unnest(embedding)::DOUBLE AS x, unnest(range(0, len(embedding))) AS place FROM articles JOIN embeddings ON vec_id = id) SELECT ticker, date, place, round(avg(x), 6) AS x FROM p GROUP BY ALL",
    "correlated_features": f"""WITH {BARS_SQL}, {_PX1}, x AS (SELECT {", ".join(f"close / nullif({roll('avg', 'close', n)}, 0) - 1 AS c{i}" for i, n in enumerate((5, 10, 20, 50)))}, {_PX["return_1lag"]} AS c4 FROM lags {S}),
k AS (SELECT {", ".join(f"corr(c{i}, c{j}) AS r{i}{j}" for i in range(5) for j in range(i))}, {", ".join(f"var_samp(c{i}) AS v{i}" for i in range(5))} FROM x WHERE {" AND ".join(f"c{i} IS NOT NULL" for i in range(5))}),
near AS ({" UNION ALL ".join(f"SELECT {i} AS i, {j} AS m FROM k WHERE abs(r{i}{j}) > 0.8" for i in range(5) for j in range(i))}), members AS (SELECT * FROM near UNION SELECT i, i FROM near),
spread AS ({" UNION ALL ".join(f"SELECT {i} AS m, v{i} AS v FROM k" for i in range(5))}), ranked AS (SELECT m, row_number() OVER (PARTITION BY i ORDER BY v DESC, m) AS n FROM members JOIN spread USING (m))
SELECT DISTINCT (['sma_ratio_5', 'sma_ratio_10', 'sma_ratio_20', 'sma_ratio_50', 'return_1lag'])[m + 1] AS feature FROM ranked WHERE n > 1""",
    "forecast_scores": f"WITH {_PRED}, {_RANKS('')} SELECT count(*) AS n, {r(_SCORES)} FROM ranks",
    "forecast_persistence": f"WITH {_PRED}, q AS (SELECT actual, lag(actual) OVER s AS prediction FROM (SELECT * FROM pred) {S}) SELECT count(*) AS n, {r({k: _SCORES[k] for k in ('rmse', 'accuracy', 'pearson')})} FROM q WHERE actual IS NOT NULL AND prediction IS NOT NULL",
    "forecast_clipped": f"""WITH {_PRED}, b AS (SELECT 3 * stddev_samp(actual / 3) AS b FROM full_pred WHERE date < DATE '1999-01-01'), t AS (SELECT date, symbol, (prediction + lag(actual) OVER s) / 2 AS p FROM (SELECT * FROM full_pred WHERE date >= DATE '1999-01-01') {S})
SELECT date, symbol, round(least(greatest(p, -b), b), 6) AS prediction FROM t, b WHERE p IS NOT NULL""",
    "forecast_daily_ic": f"WITH {_PRED}, {_RANKS('PARTITION BY date')}, d AS (SELECT date, count(*) AS n, corr(rp, ra) AS ic FROM ranks GROUP BY date HAVING count(*) > 5) SELECT date, n, round(ic, 6) AS ic, round(CASE WHEN count(ic) OVER f >= 20 THEN avg(ic) OVER f END, 6) AS ic_mean FROM d WINDOW f AS (ORDER BY date ROWS 19 PRECEDING)",
    "forecast_symbol_ic": f"WITH {_PRED}, {_RANKS('PARTITION BY symbol')} SELECT symbol, count(*) AS n, {r({'rmse': _SCORES['rmse'], 'accuracy': _SCORES['accuracy'], 'ic': 'corr(rp, ra)'})} FROM ranks GROUP BY symbol HAVING count(*) > 10",
    "forecast_summary": f"WITH {_PRED} SELECT symbol, count(actual) AS n, {r({'mean': 'avg(actual)', 'std': 'stddev_samp(actual)', 'min': 'min(actual)', 'q25': 'quantile_cont(actual, 0.25)', 'q50': 'quantile_cont(actual, 0.5)', 'q75': 'quantile_cont(actual, 0.75)', 'max': 'max(actual)'})} FROM pred GROUP BY symbol",
    "portfolio_legs": f"WITH {_LEGS} SELECT date, symbol, leg FROM legs",
    "portfolio_returns": f"WITH {_PORT} SELECT date, period::BIGINT AS period, {r([*PORTFOLIO, 'cumulative', 'drawdown'])} FROM drawn",
    "portfolio_performance": f"WITH {_PORT} SELECT {r({'annual_return': 'avg(net) * 50.4', 'annual_volatility': 'stddev_samp(net) * sqrt(50.4)', 'sharpe': 'avg(net) * 50.4 / nullif(stddev_samp(net) * sqrt(50.4), 0)', 'total_return': 'product(1 + net) - 1', 'max_drawdown': 'min(drawdown)', 'win_rate': 'avg((net > 0)::INT)'})}, count(*) AS periods FROM drawn",
    "portfolio_monthly": f"WITH {_PORT}, m AS (SELECT last_day(date) AS month, product(1 + net) - 1 AS ret FROM net GROUP BY ALL), span AS (SELECT last_day(d::DATE) AS month FROM (SELECT unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS d FROM net)) SELECT month, round(coalesce(ret, 0), 6) AS ret FROM span LEFT JOIN m USING (month)",
}
