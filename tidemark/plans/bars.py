"""Queries over bars, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.sequential import sar_column, scanned_ewm
from tidemark.operators import bars as B
from tidemark.operators import features as X
from tidemark.sources.fixtures import BARS_SQL, DIRTY_SQL, FUND_SQL, FUNDS, bars, dirty_bars, fund_map, table

KEY = ["symbol", "date"]


#: Digits that hold a price in full where it ends: cents over quantities up to 50. Fewer would cut at halves, which engines
#: round to different sides.
TICKS = 8
#: Added before rounding where values end at a half, which engines round to different sides.
HALF = 1e-9


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Key and columns, rounded alike on both sides of a comparison."""
    return df.select(*KEY, *[F.round(c, digits).alias(c) for c in columns])


def rounded_table(df: DataFrame) -> DataFrame:
    """All columns, rounded like those of their groups, integers wide."""
    exact = {*PX, "true_range"}
    return df.select([F.round(c, TICKS if c in exact else 6).alias(c) if k == "double" else F.col(c).cast("bigint").alias(c) if k == "int" else F.col(c) for c, k in df.dtypes])


def r(columns: dict[str, str] | list[str], digits: int = 6) -> str:
    items = columns.items() if isinstance(columns, dict) else ((c, c) for c in columns)
    return ", ".join(f"round({e}, {digits}) AS {c}" for c, e in items)


PX = ["open_close_change_pct_1lag", "hl_spread_pct_1lag", "price_position_1lag", "gap_1lag", "gap_pct_1lag", "close_open_ratio_1lag", "high_close_ratio_1lag", "low_close_ratio_1lag", "return_1lag", "return_2lag", "return_3lag", "return_5lag", "return_10lag", "return_7d_1lag", "return_7d_2lag"]
VO = ["volume_change_1lag", "volume_sma_5", "volume_sma_20", "volume_ema_5", "volume_ema_20", "volume_ratio_5", "volume_ratio_20", "volume_volatility", "vwap_ratio"]
TI = ["rsi_14", "rsi_21", "stoch_k", "stoch_d", "bb_width", "bb_position", "macd_pct", "macd_signal_pct", "macd_histogram_pct", *[f"{k}_ratio_{n}" for k in ("sma", "ema") for n in X.SPANS]]
VL = ["volatility_10", "volatility_20", "volatility_30", "true_range", "atr", "rv_5d_lag", "rv_22d_lag"]
ICHIMOKU = [f"ichimoku_{p}_ratio" for p in ("conversion", "base", "span_a", "span_b")]


def _spark(name: str):
    def of(f):
        QUERIES[name] = f
        return f

    return of


QUERIES: dict = {}


def _days(spark: SparkSession, sf: str) -> tuple[str, str]:
    """First day of the line items and the day after the last."""
    first, last = table(spark, sf, "lineitem").agg(F.min(F.to_date("l_shipdate")), F.date_add(F.max(F.to_date("l_shipdate")), 1)).first()
    return str(first), str(last)


@_spark("bar_load")
def bar_load(spark: SparkSession, sf: str) -> DataFrame:
    info = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("symbol"), F.col("n_regionkey").cast("string").alias("sector"))
    out = B.symbol_info(B.loader_fill(B.load_bars(dirty_bars(spark, sf), *_days(spark, sf))), info, ["sector"])
    return out.select(*KEY, "sector", *[F.round(c, TICKS).alias(c) for c in [*B.PRICES, "volume", "price_change"]])


@_spark("bar_report")
def bar_report(spark: SparkSession, sf: str) -> DataFrame:
    return B.report(dirty_bars(spark, sf), "symbol")


@_spark("bar_clean")
def bar_clean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(B.clean(dirty_bars(spark, sf), floor=10.0), [*B.PRICES, "volume"], TICKS)


@_spark("bar_chain")
def bar_chain(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cleaning chain: zeros, gaps, ranges, volume floor, smoothing, outliers, parts of the date and scaling."""
    out = B.clean(dirty_bars(spark, sf), floor=10.0, smooth=5, outliers="iqr", scaler="minmax", times=True)
    return out.select(*KEY, *[F.round(c, 6).alias(c) for c in (*B.PRICES, "volume")], F.col("week").cast("bigint").alias("week"), "is_month_end")


@_spark("line_item_trend")
def line_item_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Exponential means of the prices of all line items in one series, in the order of their keys."""
    i = table(spark, sf, "lineitem")
    place = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("place")
    rows = i.select(F.lit("all").alias("symbol"), place, (F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"))
    out = scanned_ewm(rows.select("symbol", F.format_string("%012d/%012d/%012d/%012d", "place.l_orderkey", "place.l_linenumber", "place.l_partkey", "place.l_suppkey").alias("date"), "price"), {"trend_3": ("price", 3, 1), "trend_5": ("price", 5, 4)})
    return out.select(F.col("date").alias("place"), F.round("trend_3", 4).alias("trend_3"), F.round("trend_5", 4).alias("trend_5"))


@_spark("bar_interpolate")
def bar_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    df = B.smooth_volume(B.fill_missing(B.zero_to_null(dirty_bars(spark, sf)), "interpolate", ["open", "close", "volume"]), 5)
    return rounded(df, ["open", "close", "volume"], TICKS)


@_spark("bar_backfill")
def bar_backfill(spark: SparkSession, sf: str) -> DataFrame:
    df = B.between_dates(B.zero_to_null(dirty_bars(spark, sf)), *_days(spark, sf))
    return rounded(B.fill_missing(B.fill_missing(df, "backward_fill", ["close"]), "drop", ["open", "volume"]), ["open", "close", "volume"], TICKS)


@_spark("bar_outliers")
def bar_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return B.outlier_flags(bars(spark, sf), "volume", 2.5).select(*KEY, "out_iqr", "out_z", "out_mz")


@_spark("bar_without_outliers")
def bar_without_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(B.remove_outliers(bars(spark, sf), ["close", "volume"], "iqr"), ["close", "volume"], TICKS)


@_spark("bar_times")
def bar_times(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).select(*KEY, *[c.alias(k) for k, c in B.time_features().items()])


@_spark("bar_scaled")
def bar_scaled(spark: SparkSession, sf: str) -> DataFrame:
    df = dirty_bars(spark, sf)
    stats = B.fit_scaler(df, ["close", "volume"])
    out = None
    for m in ("standard", "robust", "minmax"):
        one = B.scale(df, stats, ["close", "volume"], m).select(*KEY, F.lit(m).alias("method"), F.round("close", 6).alias("close"), F.round("volume", 6).alias("volume"))
        out = one if out is None else out.union(one)
    return out


@_spark("bar_dense_columns")
def bar_dense_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = B.drop_sparse_columns(dirty_bars(spark, sf), 0.1).dropna()
    return B.keep_symbols(df, ["NATION_3", "NATION_4"], "none_").select(*KEY, *[F.round(c, TICKS).alias(c) for c in ("high", "low", "close")])


@_spark("price_features")
def price_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.price_features(bars(spark, sf)), PX, TICKS)


@_spark("volume_features")
def volume_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.volume_features(bars(spark, sf)), VO)


@_spark("target_calendar")
def target_calendar(spark: SparkSession, sf: str) -> DataFrame:
    five = X.target(bars(spark, sf), 5).withColumnRenamed("target", "target_5")
    names = ["day_of_week", "month", "quarter", "is_month_end", "is_quarter_end", "is_year_end"]
    return X.calendar(X.target(five, 1)).select(*KEY, *names, F.round("target", 6).alias("target"), F.round("target_5", 6).alias("target_5"))


@_spark("technical_features")
def technical_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.technical_features(bars(spark, sf)), TI)


@_spark("momentum_features")
def momentum_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.momentum_features(bars(spark, sf).withColumn("roc_10", X.roc("close", 10))), ["roc_10", "williams_r", "cci", "mfi"])


@_spark("volatility_features")
def volatility_features(spark: SparkSession, sf: str) -> DataFrame:
    df = X.volatility_features(bars(spark, sf))
    return df.select(*KEY, *[F.round(c, TICKS if c == "true_range" else 6).alias(c) for c in VL])


@_spark("trend_features")
def trend_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.trend_features(bars(spark, sf)), ["adx", *ICHIMOKU])


@_spark("parabolic_stop")
def parabolic_stop(spark: SparkSession, sf: str) -> DataFrame:
    a, b = sar_column(bars(spark, sf), "reference", name="sar"), sar_column(bars(spark, sf), "standard", name="sar_standard")
    return a.join(b.select(*KEY, "sar_standard"), KEY).select(*KEY, F.round(F.col("sar") + HALF, 6).alias("sar"), F.round(F.col("sar_standard") + HALF, 6).alias("sar_standard"))


@_spark("rank_features")
def rank_features(spark: SparkSession, sf: str) -> DataFrame:
    df = X.volatility_features(X.price_features(bars(spark, sf)))
    names = ["return_1lag", "return_7d_1lag", "volatility_20", "atr"]
    return rounded(X.rank_features(df, names, FUNDS), [f"{c}_pctile" for c in names])


FUND_COLUMNS = ["stock_return_1lag", *[f"{e}_return_1lag" for e in FUNDS], *[f"relative_return_1lag_{e}" for e in FUNDS], *[f"corr_{e}_{n}d" for e in FUNDS for n in (20, 60, 120)]]


@_spark("fund_features")
def fund_features(spark: SparkSession, sf: str) -> DataFrame:
    df = X.without_funds(X.fund_features(bars(spark, sf), fund_map(spark, sf), FUNDS), FUNDS)
    return df.select(*KEY, *[f"ETF_map_{e}" for e in FUNDS], *[F.round(c, 6).alias(c) for c in FUND_COLUMNS])


@_spark("universe")
def universe(spark: SparkSession, sf: str) -> DataFrame:
    return X.universe(fund_map(spark, sf), FUNDS)


@_spark("feature_table")
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """The whole feature table."""
    return rounded_table(X.feature_table(bars(spark, sf), fund_map(spark, sf), FUNDS))


@_spark("flagship")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Two indicators as of the row before, without today's bar."""
    df = X.rsi(bars(spark, sf), 14, "rsi_14").withColumn("sma_ratio_20", X.change("close", X.sma("close", 20)))
    return rounded(B.drop_today(X.shifted(df, ["rsi_14", "sma_ratio_20"])), ["rsi_14", "sma_ratio_20"])


def ema(x: str, span: int, least: int = 0) -> str:
    """Exponential mean over the list of all values so far (missing ones kept in place)."""
    a = 1 - 2 / (span + 1)
    top = f"list_sum(list_transform(list({x}) OVER s, lambda v, i: v * pow({a}::DOUBLE, (count(*) OVER s) - i)))"
    low = f"list_sum(list_transform(list({x}) OVER s, lambda v, i: CASE WHEN v IS NOT NULL THEN pow({a}::DOUBLE, (count(*) OVER s) - i) END))"
    return f"CASE WHEN count({x}) OVER s >= {least} THEN {top} / {low} END"


S = "WINDOW s AS (PARTITION BY symbol ORDER BY date)"


def roll(f: str, x: str, n: int) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {frame} >= {n} THEN {f}({x}) {frame} END"


def lagged(columns: list[str]) -> dict[str, str]:
    return {c: f"lag({c}) OVER s" for c in columns}


_RETURNS = f"rets AS (SELECT *, close / nullif(lag(close) OVER s, 0) - 1 AS ret FROM bars {S})"
_VOLATILITY = f"""{_RETURNS}, ranges AS (SELECT *, CASE WHEN lag(close) OVER s IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER s), abs(low - lag(close) OVER s)) END AS true_range FROM rets {S}),
vola AS (SELECT *, {", ".join(f"{roll('stddev_samp', 'ret', n)} * sqrt(252) AS volatility_{n}" for n in (10, 20, 30))}, {roll("avg", "true_range", 14)} AS atr, {roll("stddev_samp", "ret", 5)} AS rv_5d_lag, {roll("stddev_samp", "ret", 22)} AS rv_22d_lag FROM ranges)"""
_FILL = lambda c: f"last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)"
_BACK = lambda c: f"first_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_GUARD = lambda f, *cs: f"CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in cs)} THEN {f}({', '.join(cs)}) END"
_ZERO = "zeroed AS (SELECT symbol, date, nullif(open, 0) AS open, nullif(high, 0) AS high, nullif(low, 0) AS low, nullif(close, 0) AS close, CASE WHEN volume < 0 THEN 0 ELSE volume END AS volume FROM dirty)"
_PX1 = f"""lags AS (SELECT *, lag(open) OVER s AS o1, lag(high) OVER s AS h1, lag(low) OVER s AS l1, lag(close) OVER s AS c1, lag(close, 2) OVER s AS c2, lag(close, 8) OVER s AS c8, lag(close, 15) OVER s AS c15,
  close / nullif(lag(close) OVER s, 0) - 1 AS ret FROM bars {S})"""
_PX = {
    "open_close_change_pct_1lag": "(c1 - o1) / nullif(o1, 0)",
    "hl_spread_pct_1lag": "(h1 - l1) / nullif(l1, 0)",
    "price_position_1lag": "(c1 - l1) / nullif(h1 - l1, 0)",
    "gap_1lag": "o1 - c2",
    "gap_pct_1lag": "(o1 - c2) / nullif(c2, 0)",
    "close_open_ratio_1lag": "c1 / nullif(o1, 0)",
    "high_close_ratio_1lag": "h1 / nullif(c1, 0)",
    "low_close_ratio_1lag": "l1 / nullif(c1, 0)",
    **{f"return_{k}lag": f"lag(ret, {k}) OVER s" for k in (1, 2, 3, 5, 10)},
    "return_7d_1lag": "c1 / nullif(c8, 0) - 1",
    "return_7d_2lag": "c8 / nullif(c15, 0) - 1",
}
_INTERPOLATED = lambda c: (
    f"CASE WHEN {c} IS NOT NULL OR {_FILL(c)} IS NULL THEN {c} WHEN {_BACK(c)} IS NULL THEN {_FILL(c)} ELSE {_FILL(c)} + ({_BACK(c)} - {_FILL(c)}) * (n - {_FILL(f'CASE WHEN {c} IS NOT NULL THEN n END')})::DOUBLE"
    f" / ({_BACK(f'CASE WHEN {c} IS NOT NULL THEN n END')} - {_FILL(f'CASE WHEN {c} IS NOT NULL THEN n END')}) END AS {c}"
)
_DX = f"""moves AS (SELECT *, CASE WHEN high - lag(high) OVER s > lag(low) OVER s - low AND high - lag(high) OVER s > 0 THEN high - lag(high) OVER s ELSE 0 END AS plus,
  CASE WHEN lag(low) OVER s - low > high - lag(high) OVER s AND lag(low) OVER s - low > 0 THEN lag(low) OVER s - low ELSE 0 END AS minus,
  CASE WHEN lag(close) OVER s IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER s), abs(low - lag(close) OVER s)) END AS tr FROM bars {S}),
di AS (SELECT *, 100 * ({roll("avg", "plus", 14)}) / nullif({roll("avg", "tr", 14)}, 0) AS p, 100 * ({roll("avg", "minus", 14)}) / nullif({roll("avg", "tr", 14)}, 0) AS m FROM moves),
dx AS (SELECT *, 100 * abs(p - m) / nullif(p + m, 0) AS d, ({roll("max", "high", 9)} + {roll("min", "low", 9)}) / 2 AS conversion, ({roll("max", "high", 26)} + {roll("min", "low", 26)}) / 2 AS base, ({roll("max", "high", 52)} + {roll("min", "low", 52)}) / 2 AS span_b FROM di)"""
_TREND = {"adx": roll("avg", "d", 14), **{f"ichimoku_{p}_ratio": f"close / nullif({e}, 0) - 1" for p, e in (("conversion", "conversion"), ("base", "base"), ("span_a", "((conversion + base) / 2)"), ("span_b", "span_b"))}}
_PCTILE = lambda c: f"CASE WHEN {c} IS NOT NULL AND symbol NOT IN ('NATION_0', 'NATION_1', 'NATION_2') THEN (rank() OVER (PARTITION BY date ORDER BY {c} NULLS LAST) + (count({c}) OVER (PARTITION BY date, {c}) - 1) / 2.0::DOUBLE) / count({c}) OVER (PARTITION BY date) END"

_SAR = f"""bars AS MATERIALIZED (WITH {BARS_SQL} SELECT * FROM bars), nb AS MATERIALIZED (SELECT *, row_number() OVER s AS n, lag(low) OVER s AS pl, lag(high) OVER s AS ph FROM bars {S}),
ref AS (SELECT symbol, n, low AS stop, high AS extreme, 0.02::DOUBLE AS speed FROM nb WHERE n = 1
  UNION ALL SELECT b.symbol, b.n, least(r.stop + r.speed * (r.extreme - r.stop), b.pl), greatest(r.extreme, b.high), CASE WHEN b.high > r.extreme THEN least(r.speed + 0.02::DOUBLE, 0.2::DOUBLE) ELSE r.speed END FROM ref r JOIN nb b ON b.symbol = r.symbol AND b.n = r.n + 1),
std AS (SELECT symbol, n, true AS up, low AS stop, high AS extreme, 0.02::DOUBLE AS speed FROM nb WHERE n = 1
  UNION ALL SELECT symbol, n, CASE WHEN turn THEN NOT up ELSE up END,
    CASE WHEN turn THEN extreme WHEN up THEN least(t, pl) ELSE greatest(t, ph) END,
    CASE WHEN turn THEN CASE WHEN up THEN low ELSE high END WHEN up THEN greatest(extreme, high) ELSE least(extreme, low) END,
    CASE WHEN turn THEN 0.02::DOUBLE WHEN CASE WHEN up THEN high > extreme ELSE low < extreme END THEN least(speed + 0.02::DOUBLE, 0.2::DOUBLE) ELSE speed END
  FROM (SELECT *, CASE WHEN up THEN low < t ELSE high > t END AS turn FROM (SELECT b.symbol, b.n, b.low, b.high, b.pl, b.ph, r.up, r.extreme, r.speed, r.stop + r.speed * (r.extreme - r.stop) AS t FROM std r JOIN nb b ON b.symbol = r.symbol AND b.n = r.n + 1)))"""

ORACLES = {
    "bar_load": f"""WITH {DIRTY_SQL}
, filled AS (SELECT symbol, date, {", ".join(f"{_FILL(c)} AS {c}" for c in B.PRICES)}, coalesce(volume, 0) AS volume FROM dirty)
SELECT symbol, date, coalesce(n_regionkey::VARCHAR, 'N/A') AS sector, {r([*B.PRICES, "volume"], TICKS)}, round(close - open, {TICKS}) AS price_change FROM filled LEFT JOIN nation ON symbol = n_name""",
    "bar_report": f"""WITH {DIRTY_SQL} SELECT symbol, count(*) AS n, {", ".join(f"count_if({c} <= 0)::BIGINT AS bad_{c}" for c in B.PRICES)}, count_if(volume < 0)::BIGINT AS bad_volume, {", ".join(f"count_if({c} IS NULL)::BIGINT AS null_{c}" for c in [*B.PRICES, "volume"])} FROM dirty GROUP BY symbol""",
    "bar_clean": f"""WITH {DIRTY_SQL}, {_ZERO}, filled AS (SELECT symbol, date, {", ".join(f"{_FILL(c)} AS {c}" for c in [*B.PRICES, "volume"])} FROM zeroed),
high AS (SELECT * REPLACE ({_GUARD("greatest", "high", "low")} AS high) FROM filled),
inside AS (SELECT * REPLACE (CASE WHEN open IS NOT NULL AND low IS NOT NULL AND high IS NOT NULL THEN least(greatest(open, low), high) END AS open, CASE WHEN close IS NOT NULL AND low IS NOT NULL AND high IS NOT NULL THEN least(greatest(close, low), high) END AS close) FROM high),
ranged AS (SELECT symbol, date, open, close, {_GUARD("greatest", "high", "open", "close")} AS high, {_GUARD("least", "low", "open", "close")} AS low, CASE WHEN volume IS NOT NULL THEN greatest(volume, 10) END AS volume FROM inside)
SELECT symbol, date, {r([*B.PRICES, "volume"], TICKS)} FROM ranged""",
    "bar_interpolate": f"""WITH {DIRTY_SQL}, {_ZERO}, numbered AS (SELECT *, row_number() OVER s AS n FROM zeroed {S}), lines AS (SELECT symbol, date, {", ".join(_INTERPOLATED(c) for c in ("open", "close", "volume"))} FROM numbered),
smooth AS (SELECT * REPLACE (coalesce(CASE WHEN count(volume) OVER f >= 5 THEN avg(volume) OVER f END, volume) AS volume) FROM lines WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT symbol, date, {r(["open", "close", "volume"], TICKS)} FROM smooth""",
    "bar_backfill": f"""WITH {DIRTY_SQL}, {_ZERO}, back AS (SELECT symbol, date, open, volume, {_BACK("close")} AS close FROM zeroed)
SELECT symbol, date, {r(["open", "close", "volume"], TICKS)} FROM back WHERE open IS NOT NULL AND volume IS NOT NULL""",
    "bar_outliers": f"""WITH {BARS_SQL}, st AS (SELECT symbol, quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS q2, quantile_cont(volume, 0.75) AS q3, avg(volume) AS m, stddev_samp(volume) AS s FROM bars GROUP BY symbol),
mad AS (SELECT symbol, quantile_cont(abs(volume - q2), 0.5) AS mad FROM bars JOIN st USING (symbol) GROUP BY symbol)
SELECT symbol, date, volume < q1 - 1.5 * (q3 - q1) OR volume > q3 + 1.5 * (q3 - q1) AS out_iqr, coalesce(abs((volume - m) / nullif(s, 0)) > 2.5, false) AS out_z, coalesce(abs(0.6745 * (volume - q2) / nullif(mad, 0)) > 2.5, false) AS out_mz
FROM bars JOIN st USING (symbol) JOIN mad USING (symbol)""",
    "bar_without_outliers": f"""WITH {BARS_SQL}, st AS (SELECT symbol, quantile_cont(volume, 0.25) AS v1, quantile_cont(volume, 0.75) AS v3, quantile_cont(close, 0.25) AS c1, quantile_cont(close, 0.75) AS c3 FROM bars GROUP BY symbol)
SELECT symbol, date, {r(["close", "volume"], TICKS)} FROM bars JOIN st USING (symbol) WHERE volume BETWEEN v1 - 1.5 * (v3 - v1) AND v3 + 1.5 * (v3 - v1) AND close BETWEEN c1 - 1.5 * (c3 - c1) AND c3 + 1.5 * (c3 - c1)""",
    "bar_times": f"""WITH {BARS_SQL} SELECT symbol, date, year(date)::INT AS year, month(date)::INT AS month, day(date)::INT AS day, (isodow(date) - 1)::INT AS dayofweek, dayofyear(date)::INT AS dayofyear, week(date)::INT AS week, quarter(date)::INT AS quarter,
isodow(date) >= 6 AS is_weekend, day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end, date = date_trunc('quarter', date)::DATE AS is_quarter_start, date = (date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS is_quarter_end, dayofyear(date) = 1 AS is_year_start, month(date) = 12 AND day(date) = 31 AS is_year_end FROM bars""",
    "bar_scaled": f"""WITH {DIRTY_SQL}, full_rows AS (SELECT * FROM dirty WHERE close IS NOT NULL AND volume IS NOT NULL),
st AS (SELECT {", ".join(f"avg({c}) AS {c}m, stddev_pop({c}) AS {c}s, min({c}) AS {c}lo, max({c}) AS {c}hi, quantile_cont({c}, 0.25) AS {c}a, quantile_cont({c}, 0.5) AS {c}b, quantile_cont({c}, 0.75) AS {c}c" for c in ("close", "volume"))} FROM full_rows)
SELECT symbol, date, 'standard' AS method, {r({c: f"({c} - {c}m) / {c}s" for c in ("close", "volume")})} FROM dirty, st
UNION ALL SELECT symbol, date, 'robust', {r({c: f"({c} - {c}b) / ({c}c - {c}a)" for c in ("close", "volume")})} FROM dirty, st
UNION ALL SELECT symbol, date, 'minmax', {r({c: f"({c} - {c}lo) / ({c}hi - {c}lo)" for c in ("close", "volume")})} FROM dirty, st""",
    "bar_dense_columns": f"""WITH {DIRTY_SQL}, n AS (SELECT count(*) AS n, count(open) AS o, count(volume) AS v FROM dirty)
SELECT symbol, date, {r(["high", "low", "close"], TICKS)} FROM dirty, n WHERE symbol IN ('NATION_3', 'NATION_4') AND (o < floor(0.9 * n.n) OR open IS NOT NULL) AND (v < floor(0.9 * n.n) OR volume IS NOT NULL) AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL""",
    "price_features": f"WITH {BARS_SQL}, {_PX1} SELECT symbol, date, {r(_PX, TICKS)} FROM lags {S}",
    "volume_features": f"""WITH {BARS_SQL}, l AS (SELECT symbol, date, lag(volume) OVER s AS v1, lag(volume, 2) OVER s AS v2, lag(close) OVER s AS c1 FROM bars {S}),
f AS (SELECT *, v1 - v2 AS volume_change_1lag, {roll("avg", "v1", 5)} AS volume_sma_5, {roll("avg", "v1", 20)} AS volume_sma_20, {ema("v1", 5, 5)} AS volume_ema_5, {ema("v1", 20, 20)} AS volume_ema_20, {roll("stddev_samp", "v1", 20)} AS volume_volatility,
  c1 / (({roll("sum", "(c1 * v1)", 20)}) / nullif({roll("sum", "v1", 20)}, 0)) - 1 AS vwap_ratio FROM l {S})
SELECT symbol, date, {r([c for c in VO if "ratio" not in c] + ["vwap_ratio"])}, round(v1 / nullif(volume_sma_5, 0), 6) AS volume_ratio_5, round(v1 / nullif(volume_sma_20, 0), 6) AS volume_ratio_20 FROM f""",
    "target_calendar": f"""WITH {BARS_SQL} SELECT symbol, date, (isodow(date) - 1)::INT AS day_of_week, month(date)::INT AS month, quarter(date)::INT AS quarter, (date = last_day(date))::INT AS is_month_end, (date = last_day(date) AND month(date) % 3 = 0)::INT AS is_quarter_end, (month(date) = 12 AND day(date) = 31)::INT AS is_year_end,
round(lead(close) OVER s / nullif(close, 0) - 1, 6) AS target, round(lead(close, 5) OVER s / nullif(close, 0) - 1, 6) AS target_5 FROM bars {S}""",
    "technical_features": f"""WITH {BARS_SQL}, d AS (SELECT *, CASE WHEN close > lag(close) OVER s THEN close - lag(close) OVER s ELSE 0 END AS up, CASE WHEN close < lag(close) OVER s THEN lag(close) OVER s - close ELSE 0 END AS down, {ema("close", 12)} - {ema("close", 26)} AS macd,
  {", ".join(f"{ema('close', n)} AS ema{n}" for n in X.SPANS)}, {", ".join(f"{roll('avg', 'close', n)} AS sma{n}" for n in X.SPANS)}, {roll("stddev_samp", "close", 20)} AS dev, {roll("min", "low", 14)} AS lo, {roll("max", "high", 14)} AS hi FROM bars {S}),
e AS (SELECT *, {ema("macd", 9)} AS signal, 100 * (close - lo) / nullif(hi - lo, 0) AS stoch_k, {roll("avg", "up", 14)} AS u14, {roll("avg", "down", 14)} AS d14, {roll("avg", "up", 21)} AS u21, {roll("avg", "down", 21)} AS d21 FROM d {S}),
f AS (SELECT *, 100 * u14 / nullif(u14 + d14, 0) AS rsi_14, 100 * u21 / nullif(u21 + d21, 0) AS rsi_21, {roll("avg", "stoch_k", 3)} AS stoch_d, 4 * dev / nullif(sma20, 0) AS bb_width, (close - sma20 + 2 * dev) / nullif(4 * dev, 0) AS bb_position,
  macd / nullif(close, 0) AS macd_pct, signal / nullif(close, 0) AS macd_signal_pct, (macd - signal) / nullif(close, 0) AS macd_histogram_pct, {", ".join(f"close / nullif(sma{n}, 0) - 1 AS sma_ratio_{n}, close / nullif(ema{n}, 0) - 1 AS ema_ratio_{n}" for n in X.SPANS)} FROM e)
SELECT symbol, date, {r(lagged(TI))} FROM f {S}""",
    "momentum_features": f"""WITH {BARS_SQL}, t AS (SELECT *, (high + low + close) / 3 AS tp, {roll("min", "low", 14)} AS lo, {roll("max", "high", 14)} AS hi FROM bars),
u AS (SELECT *, {roll("avg", "tp", 20)} AS mean, list(tp) OVER (PARTITION BY symbol ORDER BY date ROWS 19 PRECEDING) AS near, CASE WHEN tp > lag(tp) OVER s THEN tp * volume ELSE 0 END AS inflow, CASE WHEN tp < lag(tp) OVER s THEN tp * volume ELSE 0 END AS outflow FROM t {S}),
v AS (SELECT *, -100 * (hi - close) / nullif(hi - lo, 0) AS williams_r, (tp - mean) / nullif(0.015 * list_sum(list_transform(near, lambda x: abs(x - mean))) / 20, 0) AS cci, {roll("sum", "inflow", 14)} AS gain, {roll("sum", "outflow", 14)} AS loss FROM u),
x AS (SELECT *, 100 * gain / nullif(gain + loss, 0) AS mfi FROM v)
SELECT symbol, date, round(100 * (close / nullif(lag(close, 10) OVER s, 0) - 1), 6) AS roc_10, {r(lagged(["williams_r", "cci", "mfi"]))} FROM x {S}""",
    "volatility_features": f"WITH {BARS_SQL}, {_VOLATILITY} SELECT symbol, date, {r(lagged([c for c in VL if c != "true_range"]))}, {r(lagged(["true_range"]), TICKS)} FROM vola {S}",
    "trend_features": f"WITH {BARS_SQL}, {_DX}, f AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in _TREND.items())} FROM dx) SELECT symbol, date, {r(lagged(list(_TREND)))} FROM f {S}",
    "rank_features": f"""WITH {BARS_SQL}, {_VOLATILITY}, f AS (SELECT symbol, date, lag(ret) OVER s AS return_1lag, lag(close) OVER s / nullif(lag(close, 8) OVER s, 0) - 1 AS return_7d_1lag, lag(volatility_20) OVER s AS volatility_20, lag(atr) OVER s AS atr FROM vola {S})
SELECT symbol, date, {r({f"{c}_pctile": _PCTILE(f"round({c}, 9)") for c in ("return_1lag", "return_7d_1lag", "volatility_20", "atr")})} FROM f""",
    "fund_features": f"""WITH {BARS_SQL}, {FUND_SQL}, wide AS (SELECT date, {", ".join(f"max(CASE WHEN symbol = '{e}' THEN close END) AS {e}" for e in FUNDS)} FROM bars WHERE symbol IN ('NATION_0', 'NATION_1', 'NATION_2') GROUP BY date),
carried AS (SELECT date, {", ".join(f"last_value({e} IGNORE NULLS) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {e}" for e in FUNDS)} FROM wide),
moved AS (SELECT date, {", ".join(f"{e} / nullif(lag({e}) OVER (ORDER BY date), 0) - 1 AS {e}" for e in FUNDS)} FROM carried),
panel AS (SELECT date, {", ".join(f"lag({e}) OVER (ORDER BY date) AS {e}_return_1lag" for e in FUNDS)} FROM moved),
{_RETURNS}, own AS (SELECT *, lag(ret) OVER s AS stock_return_1lag FROM rets {S}),
flags AS (SELECT symbol, {", ".join(f"count_if(etf = '{e}')::INT AS ETF_map_{e}" for e in FUNDS)} FROM fund_map GROUP BY symbol),
f AS (SELECT * FROM own LEFT JOIN panel USING (date) JOIN flags USING (symbol) WHERE symbol NOT IN ('NATION_0', 'NATION_1', 'NATION_2'))
SELECT symbol, date, {", ".join(f"ETF_map_{e}" for e in FUNDS)}, {r(["stock_return_1lag", *[f"{e}_return_1lag" for e in FUNDS]])}, {r({f"relative_return_1lag_{e}": f"stock_return_1lag - {e}_return_1lag" for e in FUNDS})},
{r({f"corr_{e}_{n}d": f"CASE WHEN count(stock_return_1lag + {e}_return_1lag) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) >= {n} THEN corr(stock_return_1lag, {e}_return_1lag) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END" for e in FUNDS for n in (20, 60, 120)})} FROM f""",
    "universe": f"WITH {FUND_SQL} SELECT DISTINCT symbol FROM (SELECT symbol FROM fund_map UNION SELECT etf FROM fund_map UNION SELECT unnest(['NATION_0', 'NATION_1', 'NATION_2']))",
    "flagship": f"""WITH {BARS_SQL}, d AS (SELECT *, CASE WHEN close > lag(close) OVER s THEN close - lag(close) OVER s ELSE 0 END AS up, CASE WHEN close < lag(close) OVER s THEN lag(close) OVER s - close ELSE 0 END AS down FROM bars {S}),
e AS (SELECT *, {roll("avg", "up", 14)} AS u, {roll("avg", "down", 14)} AS w, close / nullif({roll("avg", "close", 20)}, 0) - 1 AS sma_ratio_20 FROM d), f AS (SELECT *, 100 * u / nullif(u + w, 0) AS rsi_14 FROM e)
SELECT symbol, date, {r(lagged(["rsi_14", "sma_ratio_20"]))} FROM f {S}""",
}

#: Weights of 200 rows back are below 1e-35 here, so a frame of 200 rows gives all digits.
ORACLES["line_item_trend"] = """WITH i AS (SELECT printf('%012d/%012d/%012d/%012d', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place, (l_extendedprice / l_quantity)::DOUBLE AS x FROM lineitem),
w AS (SELECT place, list(x) OVER f AS l, count(*) OVER (ORDER BY place) AS n FROM i WINDOW f AS (ORDER BY place ROWS 199 PRECEDING)),
s AS (SELECT place, n, list_sum(list_transform(l, lambda v, i: v * pow(0.5::DOUBLE, len(l) - i))) / list_sum(list_transform(l, lambda v, i: pow(0.5::DOUBLE, len(l) - i))) AS a,
list_sum(list_transform(l, lambda v, i: v * pow(2 / 3::DOUBLE, len(l) - i))) / list_sum(list_transform(l, lambda v, i: pow(2 / 3::DOUBLE, len(l) - i))) AS b FROM w)
SELECT place, round(a, 4) AS trend_3, CASE WHEN n >= 4 THEN round(b, 4) END AS trend_5 FROM s"""
_FIVE = [*B.PRICES, "volume"]
ORACLES["bar_chain"] = f"""{ORACLES["bar_clean"].rsplit(chr(10) + "SELECT", 1)[0]},
smooth AS (SELECT * REPLACE (coalesce(CASE WHEN count(volume) OVER f >= 5 THEN avg(volume) OVER f END, volume) AS volume) FROM ranged WINDOW f AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
quarters AS (SELECT symbol, {", ".join(f"quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.75) AS {c}_c" for c in _FIVE)} FROM smooth GROUP BY symbol),
kept AS (SELECT smooth.* FROM smooth JOIN quarters USING (symbol) WHERE NOT ({" OR ".join(f"coalesce({c} < {c}_a - 1.5 * ({c}_c - {c}_a) OR {c} > {c}_c + 1.5 * ({c}_c - {c}_a), false)" for c in _FIVE)})),
ends AS (SELECT {", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _FIVE)} FROM dirty WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FIVE)})
SELECT symbol, date, {r({c: f"({c} - {c}_lo) / ({c}_hi - {c}_lo)" for c in _FIVE})}, week(date) AS week, date = last_day(date) AS is_month_end FROM kept, ends"""

ORACLES["parabolic_stop"] = f"WITH RECURSIVE {_SAR} SELECT symbol, date, round(ref.stop + {HALF}, 6) AS sar, round(std.stop + {HALF}, 6) AS sar_standard FROM nb JOIN ref USING (symbol, n) JOIN std USING (symbol, n)"


def _unrounded(name: str) -> str:
    """A query's SQL with all its digits."""
    return ORACLES[name].replace(", 6) AS", ", 15) AS").replace(f", {TICKS}) AS", ", 15) AS")


_CALENDAR = ["day_of_week", "month", "quarter", "is_month_end", "is_quarter_end", "is_year_end"]
_GROUPS = {"price_features": PX, "volume_features": VO, "technical_features": TI, "momentum_features": ["williams_r", "cci", "mfi"], "volatility_features": VL, "trend_features": ["adx", *ICHIMOKU]}


def _table_sql(groups: list[str], ranked: list[str], stop: bool) -> str:
    """The feature table from the SQL of its groups; ranks are over all symbols, rows of funds go afterwards."""
    parts = [f"g{i} AS MATERIALIZED ({_unrounded(g)})" for i, g in enumerate(groups)]
    names = [c for g in groups for c in _GROUPS[g]]
    if stop:
        parts.append(f"stops AS MATERIALIZED (WITH RECURSIVE {_SAR} SELECT symbol, date, lag(close / nullif(stop, 0) - 1) OVER s AS sar_ratio FROM nb JOIN ref USING (symbol, n) {S})")
        names.append("sar_ratio")
    joined = " ".join(["FROM g0", *[f"JOIN g{i} USING (symbol, date)" for i in range(1, len(groups))], *["JOIN stops USING (symbol, date)"] * stop])
    parts.append(f"ranks AS (SELECT symbol, date, {', '.join(names)}, {', '.join(f'{_PCTILE(f"round({c}, 9)")} AS {c}_pctile' for c in ranked)} {joined})")
    parts += [f"funds AS ({_unrounded('fund_features')})", f"moments AS ({_unrounded('target_calendar')})"]
    shown = [*names, *[f"{c}_pctile" for c in ranked], *FUND_COLUMNS, "target"]
    flags = [f"{c}::BIGINT AS {c}" for c in [*[f"ETF_map_{e}" for e in FUNDS], *_CALENDAR]]
    exact = set(PX) | {"true_range"}
    rounds = [f"round({c}, {TICKS if c in exact else 6}) AS {c}" for c in shown]
    return f"WITH {', '.join(parts)} SELECT symbol, date, {', '.join(rounds + flags)} FROM ranks JOIN funds USING (symbol, date) JOIN moments USING (symbol, date)"


ORACLES["feature_table"] = _table_sql(list(_GROUPS), X.RANKED, True)
ORACLES["technical_table"] = _table_sql(["technical_features"], ["rsi_14", "sma_ratio_20", "macd_pct", "bb_position"], False)
