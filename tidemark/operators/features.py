"""Price, volume, technical, cross-sectional and fund-relative features of daily bars.

All but `target` use rows before today only. Windows of a series share one partitioning, so a whole table of
features costs one exchange on the symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.sequential import ewm, ewm_columns, sar, series_columns
from tidemark.functions.windows import by, change, ffill, flag, lag, most, rank_pct, ratio, roll
from tidemark.operators.bars import drop_today, time_features

SPANS = (5, 10, 20, 50, 100, 200)


def padded_return(c: str, k: int = 1) -> Column:
    """Change over k rows with gaps carried forward."""
    return change(ffill(c, by("symbol")), F.lag(ffill(c, by("symbol")), k).over(by("symbol")))


def with_returns(df: DataFrame) -> DataFrame:
    """`ret`, the padded daily return, which many features take."""
    df = df.withColumn("__c", ffill("close", by("symbol")))
    return df.withColumn("ret", change("__c", lag("__c", by("symbol")))).drop("__c")


def price_features(df: DataFrame) -> DataFrame:
    df = df.withColumns({f"{c}1": lag(c, by("symbol")) for c in ("open", "high", "low", "close")} | {"close2": lag("close", by("symbol"), 2), "ret": padded_return("close")})
    o, h, lo, c = (F.col(f"{x}1") for x in ("open", "high", "low", "close"))
    return df.withColumns(
        {
            "open_close_change_pct_1lag": ratio(c - o, o),
            "hl_spread_pct_1lag": ratio(h - lo, lo),
            "price_position_1lag": ratio(c - lo, h - lo),
            "gap_1lag": o - F.col("close2"),
            "gap_pct_1lag": ratio(o - F.col("close2"), "close2"),
            "close_open_ratio_1lag": ratio(c, o),
            "high_close_ratio_1lag": ratio(h, c),
            "low_close_ratio_1lag": ratio(lo, c),
            **{f"return_{k}lag": lag("ret", by("symbol"), k) for k in (1, 2, 3, 5, 10)},
            "return_7d_1lag": change(c, lag("close", by("symbol"), 8)),
            "return_7d_2lag": change(lag("close", by("symbol"), 8), lag("close", by("symbol"), 15)),
        }
    ).drop("open1", "high1", "low1", "close1", "close2", "ret")


#: Recurrences of the feature groups; `feature_table` computes them all in one grouped map over the bars.
VOLUME_STEPS = {f"volume_ema_{n}": ewm(lambda group: group["volume"].shift(1), n, n) for n in (5, 20)}
TECHNICAL_STEPS = {
    **{f"__ema{n}": ewm("close", n, 0) for n in SPANS},
    "__fast": ewm("close", 12, 0),
    "__slow": ewm("close", 26, 0),
    "__macd": lambda group: group["__fast"] - group["__slow"],
    "__signal": ewm("__macd", 9, 0),
}


def volume_features(df: DataFrame) -> DataFrame:
    df = series_columns(df, VOLUME_STEPS)
    df = df.withColumns({"v1": lag("volume", by("symbol")), "c1": lag("close", by("symbol"))})
    df = df.withColumns({"volume_change_1lag": F.col("v1") - lag("volume", by("symbol"), 2), "cv": F.col("c1") * F.col("v1"), **{f"volume_sma_{n}": roll(F.avg, "v1", by("symbol"), n) for n in (5, 20)}})
    df = df.withColumns({**{f"volume_ratio_{n}": ratio("v1", f"volume_sma_{n}") for n in (5, 20)}, "volume_volatility": roll(F.stddev_samp, "v1", by("symbol"), 20), "vwap_ratio": change("c1", ratio(roll(F.sum, "cv", by("symbol"), 20), roll(F.sum, "v1", by("symbol"), 20)))})
    return df.drop("v1", "c1", "cv")


def target(df: DataFrame, horizon: int = 1) -> DataFrame:
    """The return from today's close to the one `horizon` rows on: what models forecast."""
    ahead = F.lead(padded_return("close")).over(by("symbol")) if horizon == 1 else change(F.lead("close", horizon).over(by("symbol")), "close")
    if horizon == 1:
        return with_returns(df).withColumn("target", F.lead("ret").over(by("symbol"))).drop("ret")
    return df.withColumn("target", ahead)


def calendar(df: DataFrame) -> DataFrame:
    t = time_features()
    return df.withColumns({"day_of_week": t["dayofweek"], "month": t["month"], "quarter": t["quarter"], **{k: t[k].cast("int") for k in ("is_month_end", "is_quarter_end", "is_year_end")}})


def rsi(df: DataFrame, n: int, name: str) -> DataFrame:
    """Relative strength by simple means; the first row counts as no move."""
    d = F.col("close") - lag("close", by("symbol"))
    df = df.withColumns({"__up": F.when(d > 0, d).otherwise(0.0), "__down": F.when(d < 0, -d).otherwise(0.0)})
    up, down = roll(F.avg, "__up", by("symbol"), n), roll(F.avg, "__down", by("symbol"), n)
    return df.withColumn(name, 100 * ratio(up, up + down)).drop("__up", "__down")


def sma(c: str, n: int) -> Column:
    return roll(F.avg, c, by("symbol"), n)


def bollinger(c: str = "close", n: int = 20, width: float = 2.0) -> tuple[Column, Column, Column]:
    """Upper, middle and lower band."""
    mid, dev = roll(F.avg, c, by("symbol"), n), roll(F.stddev_samp, c, by("symbol"), n)
    return mid + width * dev, mid, mid - width * dev


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """macd, macd_signal and macd_histogram of the close."""
    df = ewm_columns(df, {"__fast": ("close", fast, 0), "__slow": ("close", slow, 0)})
    df = ewm_columns(df.withColumn("macd", F.col("__fast") - F.col("__slow")), {"macd_signal": ("macd", signal, 0)})
    return df.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("__fast", "__slow")


def stochastic(df: DataFrame, n: int = 14, smooth: int = 3) -> DataFrame:
    low, high = roll(F.min, "low", by("symbol"), n), roll(F.max, "high", by("symbol"), n)
    df = df.withColumn("stoch_k", 100 * ratio(F.col("close") - low, high - low))
    return df.withColumn("stoch_d", roll(F.avg, "stoch_k", by("symbol"), smooth))


def shifted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as of the row before."""
    return df.withColumns({c: lag(c, by("symbol")) for c in columns})


def technical_features(df: DataFrame) -> DataFrame:
    """Twenty-one indicators as of the row before."""
    df = series_columns(df, TECHNICAL_STEPS)
    df = rsi(rsi(df, 14, "rsi_14"), 21, "rsi_21")
    df = stochastic(df)
    upper, mid, lower = bollinger()
    out = {f"sma_ratio_{n}": change("close", sma("close", n)) for n in SPANS} | {f"ema_ratio_{n}": change("close", f"__ema{n}") for n in SPANS}
    out |= {"macd_pct": ratio("__macd", "close"), "macd_signal_pct": ratio("__signal", "close"), "macd_histogram_pct": ratio(F.col("__macd") - F.col("__signal"), "close")}
    out |= {"bb_width": ratio(upper - lower, mid), "bb_position": ratio(F.col("close") - lower, upper - lower)}
    df = df.withColumns(out)
    return shifted(df, ["rsi_14", "rsi_21", "stoch_k", "stoch_d", *out]).drop(*[f"__ema{n}" for n in SPANS], "__fast", "__slow", "__macd", "__signal")


def roc(c: str, n: int) -> Column:
    return 100 * change(c, lag(c, by("symbol"), n))


def williams_r(n: int = 14) -> Column:
    low, high = roll(F.min, "low", by("symbol"), n), roll(F.max, "high", by("symbol"), n)
    return -100 * ratio(high - F.col("close"), high - low)


def momentum_features(df: DataFrame) -> DataFrame:
    """williams_r, cci and mfi as of the row before."""
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    df = df.withColumns({"__tp": tp, "williams_r": williams_r()})
    mean, near = roll(F.avg, "__tp", by("symbol"), 20), F.collect_list("__tp").over(by("symbol").rowsBetween(-19, 0))
    df = df.withColumns({"__mean": mean, "__near": near})
    apart = F.aggregate("__near", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("__mean"))) / 20
    flow, move = F.col("__tp") * F.col("volume"), F.col("__tp") - lag("__tp", by("symbol"))
    df = df.withColumns({"cci": ratio(F.col("__tp") - F.col("__mean"), 0.015 * apart), "__in": F.when(move > 0, flow).otherwise(0.0), "__out": F.when(move < 0, flow).otherwise(0.0)})
    gain, loss = roll(F.sum, "__in", by("symbol"), 14), roll(F.sum, "__out", by("symbol"), 14)
    df = df.withColumn("mfi", 100 * ratio(gain, gain + loss))
    return shifted(df, ["williams_r", "cci", "mfi"]).drop("__tp", "__mean", "__near", "__in", "__out")


def true_range() -> Column:
    before = lag("close", by("symbol"))
    return most(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def volatility_features(df: DataFrame) -> DataFrame:
    df = with_returns(df).withColumn("true_range", true_range())
    year = F.sqrt(F.lit(252.0))
    out = {f"volatility_{n}": roll(F.stddev_samp, "ret", by("symbol"), n) * year for n in (10, 20, 30)} | {"atr": roll(F.avg, "true_range", by("symbol"), 14), "rv_5d_lag": roll(F.stddev_samp, "ret", by("symbol"), 5), "rv_22d_lag": roll(F.stddev_samp, "ret", by("symbol"), 22)}
    return shifted(df.withColumns(out), ["true_range", *out]).drop("ret")


def adx(df: DataFrame, n: int = 14) -> DataFrame:
    up, down = F.col("high") - lag("high", by("symbol")), lag("low", by("symbol")) - F.col("low")
    df = df.withColumns({"__plus": F.when((up > down) & (up > 0), up).otherwise(0.0), "__minus": F.when((down > up) & (down > 0), down).otherwise(0.0), "__tr": true_range()})
    atr = roll(F.avg, "__tr", by("symbol"), n)
    df = df.withColumns({"__p": 100 * ratio(roll(F.avg, "__plus", by("symbol"), n), atr), "__m": 100 * ratio(roll(F.avg, "__minus", by("symbol"), n), atr)})
    df = df.withColumn("__dx", 100 * ratio(F.abs(F.col("__p") - F.col("__m")), F.col("__p") + F.col("__m")))
    return df.withColumn("adx", roll(F.avg, "__dx", by("symbol"), n)).drop("__plus", "__minus", "__tr", "__p", "__m", "__dx")


def ichimoku(df: DataFrame, short: int = 9, middle: int = 26, long: int = 52) -> DataFrame:
    mid = lambda n: (roll(F.max, "high", by("symbol"), n) + roll(F.min, "low", by("symbol"), n)) / 2
    df = df.withColumns({"conversion": mid(short), "base": mid(middle), "span_b": mid(long)})
    return df.withColumn("span_a", (F.col("conversion") + F.col("base")) / 2)


def trend_features(df: DataFrame, sar_mode: str = "reference") -> DataFrame:
    """adx, sar_ratio and the Ichimoku ratios as of the row before."""
    df = ichimoku(adx(series_columns(df, {"sar": sar(sar_mode)})))
    parts = ["conversion", "base", "span_a", "span_b"]
    df = df.withColumns({"sar_ratio": change("close", "sar"), **{f"ichimoku_{p}_ratio": change("close", p) for p in parts}})
    return shifted(df, ["adx", "sar_ratio", *[f"ichimoku_{p}_ratio" for p in parts]]).drop("sar", *parts)


RANKED = ["return_1lag", "return_5lag", "return_7d_1lag", "volume_ratio_5", "volume_ratio_20", "rsi_14", "sma_ratio_20", "macd_pct", "bb_position", "volatility_20", "atr", "adx"]


def rank_features(df: DataFrame, columns: list[str], funds: list[str]) -> DataFrame:
    """`*_pctile`: rank shares within the date over all rows, then without value for funds. What differs beyond nine decimals is a tie."""
    fund = F.col("symbol").isin(funds)
    df = df.withColumns({f"{c}_pctile": rank_pct(F.round(c, 9), "date") for c in columns})
    return df.withColumns({f"{c}_pctile": F.when(~fund, F.col(f"{c}_pctile")) for c in columns})


def fund_panel(df: DataFrame, funds: list[str]) -> DataFrame:
    """date and `{fund}_return_1lag`, lagged on the union of the funds' dates. A few rows a day: one ordered series."""
    wide = df.where(F.col("symbol").isin(funds)).groupBy("date").pivot("symbol", funds).agg(F.first("close"))
    days = Window.orderBy("date")
    wide = wide.withColumns({f"__{e}": ffill(e, days) for e in funds})
    wide = wide.withColumns({e: change(f"__{e}", F.lag(f"__{e}").over(days)) for e in funds})
    return wide.select("date", *[F.lag(e).over(days).alias(f"{e}_return_1lag") for e in funds])


def fund_features(df: DataFrame, mapping: DataFrame, funds: list[str], windows: tuple[int, ...] = (20, 60, 120), prices: DataFrame | None = None) -> DataFrame:
    """Fund returns, map flags, returns relative to every fund and rolling correlations; the last two for mapped symbols only.

    prices: narrow rows to take the funds' closes from, if `df` is wide or costly."""
    flags = mapping.groupBy("symbol").pivot("etf", funds).agg(F.lit(1)).withColumnsRenamed({e: f"ETF_map_{e}" for e in funds})
    df = df.join(F.broadcast(fund_panel(df if prices is None else prices, funds)), "date", "left").join(flags.withColumn("__mapped", F.lit(True)), "symbol", "left")
    df = with_returns(df).withColumn("stock_return_1lag", lag("ret", by("symbol"))).drop("ret").fillna(0, [f"ETF_map_{e}" for e in funds])
    out = {}
    for e in funds:
        x, y = F.col("stock_return_1lag"), F.col(f"{e}_return_1lag")
        out[f"relative_return_1lag_{e}"] = F.when(F.col("__mapped"), x - y)
        both = x.isNotNull() & y.isNotNull()
        a, b = F.when(both, x), F.when(both, y)
        for n in windows:
            frame = by("symbol").rowsBetween(1 - n, 0)
            rho = F.try_divide(F.covar_pop(a, b).over(frame), F.stddev_pop(a).over(frame) * F.stddev_pop(b).over(frame))
            out[f"corr_{e}_{n}d"] = F.when(F.col("__mapped") & (F.count(a).over(frame) >= n), rho)
    return df.withColumns(out).drop("__mapped")


def without_funds(df: DataFrame, funds: list[str]) -> DataFrame:
    """Rows of other symbols; missing map flags are 0."""
    flags = [c for c in df.columns if c.startswith("ETF_map_")]
    df = df.where(~F.col("symbol").isin(funds))
    return df.fillna(0, flags) if flags else df


def universe(mapping: DataFrame, funds: list[str]) -> DataFrame:
    """All symbols: those of the map, their funds and listed funds."""
    listed = mapping.sparkSession.createDataFrame([(e,) for e in funds], "symbol string")
    return mapping.select("symbol").union(mapping.select("etf")).union(listed).distinct()


def feature_table(df: DataFrame, mapping: DataFrame, funds: list[str], price: bool = True, volume: bool = True, technical: bool = True, momentum: bool = True, volatility: bool = True, trend: bool = True, horizon: int = 1) -> DataFrame:
    """The whole feature table of (symbol, date), without what is only known today and without funds.

    One grouped map over the bars for all recurrences, one exchange on the symbol for all windows, one on the date for the ranks."""
    prices = df
    steps = (VOLUME_STEPS if volume else {}) | (TECHNICAL_STEPS if technical else {}) | ({"sar": sar()} if trend else {})
    df = series_columns(df, steps)
    for wanted, part in ((price, price_features), (volume, volume_features), (technical, technical_features), (momentum, momentum_features), (volatility, volatility_features), (trend, trend_features)):
        if wanted:
            df = part(df)
    df = target(fund_features(df, mapping, funds, prices=prices), horizon)
    df = rank_features(df, [c for c in RANKED if c in df.columns], funds)
    return without_funds(drop_today(calendar(df)), funds)


def technical_table(df: DataFrame, mapping: DataFrame, funds: list[str]) -> DataFrame:
    """Technical indicators with fund, target, rank and calendar columns only."""
    return feature_table(df, mapping, funds, price=False, volume=False, momentum=False, volatility=False, trend=False)
