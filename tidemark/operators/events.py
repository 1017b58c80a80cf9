"""Event sources rolled up to days, and features of them on a business-day grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import by, clip, ffill, flag, lag, ratio, roll

# Words of a position that make an officer, and analysts' grades by leaning.
OFFICER = r"\b(ceo|cfo|coo|cto|president|officer|evp|svp|vp|counsel|secretary|treasurer|principal|controller|managing)\b"
#: A grade in no list counts by the first leaning of which it holds a name.
GRADES = {
    1: ["buy", "overweight", "outperform", "strong buy", "positive", "sector outperform", "top pick", "conviction buy", "accumulate", "above average", "add", "long-term buy", "market outperform", "strong outperform", "sector perform/outperform"],
    -1: ["sell", "underweight", "underperform", "reduce", "negative", "sector underperform", "strong sell", "avoid", "below average", "market underperform"],
    0: ["hold", "neutral", "equal-weight", "market perform", "sector perform", "peer perform", "in-line", "perform", "sector weight", "market weight", "fair value"],
}
INITIATIONS = ["init", "initiated", "initiate"]
# End of fixed values.


def spine(tickers: DataFrame, start: str, end: str) -> DataFrame:
    """ticker and date: every business day from start to end for every ticker."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return tickers.select("ticker").distinct().select("ticker", F.explode(F.filter(days, lambda d: F.weekday(d) < 5)).alias("date"))


def insider_daily(rows: DataFrame) -> DataFrame:
    """Counts, values and shares of transactions by code for each ticker and day."""
    code, officer = F.col("code"), F.coalesce(F.lower("position").rlike(OFFICER), F.lit(False))
    n = lambda c: F.count_if(c)
    total = lambda c, v: F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0.0))
    out = rows.where("date is not null and trim(code) != ''").groupBy("ticker", "date").agg(
        n(code == "P").alias("insider_buys"),
        n(code == "S").alias("insider_sells"),
        total(code == "P", "value").alias("insider_buy_value"),
        total(code == "S", "value").alias("insider_sell_value"),
        F.count("*").alias("insider_transaction_count"),
        n((code == "P") & officer).alias("officer_buys"),
        n((code == "S") & officer).alias("officer_sells"),
        n(code == "A").alias("grant_count"),
        total(code == "A", "shares").alias("grant_shares"),
        n(code == "F").alias("tax_withheld_count"),
        total(code == "F", "shares").alias("tax_withheld_shares"),
        n(code == "M").alias("option_exercises"),
        n(code == "G").alias("gift_count"),
    )
    return out.withColumns(
        {
            "insider_net_transactions": F.col("insider_buys") - F.col("insider_sells"),
            "insider_net_value": F.col("insider_buy_value") - F.col("insider_sell_value"),
            "insider_buy_ratio": F.col("insider_buys") / F.greatest("insider_transaction_count", F.lit(1)),
        }
    )


def latest_filings(rows: DataFrame, most: int) -> DataFrame:
    """Rows of the first `most` filings of each ticker by arrival; a missing date becomes the filing date."""
    place = F.dense_rank().over(Window.partitionBy("ticker").orderBy("arrival", "filing_id"))
    return rows.withColumn("__n", place).where(F.col("__n") <= most).withColumn("date", F.coalesce("date", "filing_date")).drop("__n")


def congress_daily(rows: DataFrame) -> DataFrame:
    """Purchases, sales, their number and balance by ticker and day."""
    kind = F.lower("type")
    buy, sell = kind.contains("purchase") | kind.contains("buy"), kind.contains("sale") | kind.contains("sell")
    out = rows.groupBy("ticker", "date").agg(F.count_if(buy).alias("congress_buys"), F.count_if(sell).alias("congress_sells"), F.count("*").alias("congress_trade_count"))
    return out.withColumn("congress_net", F.col("congress_buys") - F.col("congress_sells"))


def pageview_features(rows: DataFrame) -> DataFrame:
    """Seven-row mean and spikes over two deviations of thirty rows, by ticker."""
    w = by("ticker")
    mean, deviation = roll(F.avg, "views", w, 30, 1), F.coalesce(roll(F.stddev_samp, "views", w, 30, 1), F.lit(0.0))
    return rows.withColumns({"pageviews_ma7": roll(F.avg, "views", w, 7, 1), "attention_spike": flag(F.col("views") > mean + 2 * deviation)})


def earnings_surprise(rows: DataFrame) -> DataFrame:
    surprise = F.col("actual") - F.col("estimate")
    return rows.withColumns({"surprise": surprise, "surprise_pct": 100 * F.try_divide(surprise, F.abs("estimate"))})


def with_next_scheduled(rows: DataFrame, schedule: DataFrame, end: str) -> DataFrame:
    """The reports and, for each ticker, the nearest scheduled date after `end` that has none yet."""
    nearest = schedule.where(F.col("date") > F.lit(end).cast("date")).groupBy("ticker").agg(F.min("date").alias("date"))
    fresh = nearest.join(rows.select("ticker", "date"), ["ticker", "date"], "left_anti").withColumn("scheduled", F.lit(True))
    return rows.withColumn("scheduled", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def grade_score(grade: str) -> Column:
    """1, 0, -1 or NULL: exact grades first, then those that contain one; buying before selling before neutral."""
    g = F.lower(F.trim(F.col(grade)))
    exact = F.coalesce(*[F.when(g.isin(words), F.lit(s)) for s, words in GRADES.items()])
    part = F.coalesce(*[F.when(g.rlike("|".join(words)), F.lit(s)) for s, words in GRADES.items()])
    return F.coalesce(exact, part)


def classify_revisions(rows: DataFrame) -> DataFrame:
    """direction of a grade change: the action, then the grades, then the level alone."""
    rows = rows.withColumns({"__to": grade_score("to_grade"), "__from": grade_score("from_grade")})
    action = F.lower(F.trim(F.coalesce("action", F.lit(""))))
    both = F.col("__to").isNotNull() & F.col("__from").isNotNull()
    direction = (
        F.when(action == "up", 1)
        .when(action == "down", -1)
        .when(both & (F.col("__to") != F.col("__from")), F.signum(F.col("__to") - F.col("__from")).cast("int"))
        .when(action.isin(INITIATIONS) | F.col("__from").isNull(), F.coalesce("__to", F.lit(0)))
        .otherwise(0)
    )
    return rows.withColumn("direction", direction).drop("__to", "__from")


def grade_changes(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Landed grade changes between two days: `date` from the first of the columns Date, GradeDate and date that is there, else from the first
    of all; names like ToGrade become to_grade; rows without a valid date go."""
    found = next((c for c in ("Date", "GradeDate", "date") if c in rows.columns), rows.columns[0])
    named = {c: {"tograde": "to_grade", "fromgrade": "from_grade"}.get(c.lower(), c.lower()) for c in rows.columns if c != found}
    out = rows.select(F.expr(f"try_cast(`{found}` AS date)").alias("date"), *[F.col(f"`{c}`").alias(n) for c, n in named.items() if n != "date"])
    return out.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def revisions_daily(rows: DataFrame) -> DataFrame:
    action = F.lower(F.coalesce("action", F.lit("")))
    out = rows.groupBy("ticker", "date").agg(F.count_if(F.col("direction") > 0).alias("upgrades"), F.count_if(F.col("direction") < 0).alias("downgrades"), F.count_if(action.contains("init")).alias("initiations"), F.count_if(action.rlike("reit|main")).alias("reiterations"), F.count("*").alias("revisions"))
    return out.withColumn("net_revisions", F.col("upgrades") - F.col("downgrades"))


def target_direction(rows: DataFrame) -> DataFrame:
    """Move of a firm's target against its target before; its first is 0."""
    before = F.lag("target").over(Window.partitionBy("ticker", "firm").orderBy("date", "id"))
    return rows.withColumn("move", F.coalesce(F.signum(F.col("target") - before), F.lit(0.0)).cast("int"))


def targets_daily(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ticker", "date").agg(F.avg("target").alias("pt_mean"), F.max("target").alias("pt_high"), F.min("target").alias("pt_low"), F.count("*").alias("pt_count"), F.bround(F.avg("move")).cast("int").alias("pt_revision_direction"))


def series_on_grid(rows: DataFrame, names: list[str], start: str, end: str, mode: str = "asof") -> DataFrame:
    """One row each business day, one column each series, carried forward.

    mode 'asof' takes the last observation at or before the day, also of a weekend; 'reference' only those dated
    on grid days. A macro table is one short series, so its windows have no partition."""
    wide = rows.groupBy("date").pivot("series", names).agg(F.first("value"))
    first = wide.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    grid = first if mode == "asof" else first.where(F.weekday("date") < 5)
    days = Window.orderBy("date")
    return grid.join(wide, "date", "left").withColumns({c: ffill(c, days) for c in names}).where(F.weekday("date") < 5)


def closes_on_grid(bars: DataFrame, names: dict[str, str], start: str, end: str) -> DataFrame:
    """date and the closes of a few symbols as columns, on business days, carried forward. names: symbol to column."""
    series = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    rows = bars.where(F.col("symbol").isin(list(names))).select("date", F.element_at(series, F.col("symbol")).alias("series"), F.col("close").alias("value"))
    return series_on_grid(rows, list(names.values()), start, end, mode="reference")


def curve_and_regime(df: DataFrame) -> DataFrame:
    """Slope of the yield curve, whether it is inverted, and four regimes of volatility, each where its inputs are there.

    A level at or below 0, above 100 or unknown has the regime 'nan'; an unknown slope is not inverted."""
    if {"treasury_10y", "treasury_2y"} <= set(df.columns):
        df = df.withColumn("yield_curve_slope", F.col("treasury_10y") - F.col("treasury_2y"))
        df = df.withColumn("yield_curve_inverted", flag(F.col("yield_curve_slope") < 0))
    if "vix" in df.columns:
        v = F.col("vix")
        regime = F.when(v <= 0, "nan").when(v <= 15, "low_vol").when(v <= 20, "normal").when(v <= 30, "elevated").when(v <= 100, "crisis").otherwise("nan")
        df = df.withColumn("vix_regime", regime)
    return df


def fund_flows(df: DataFrame) -> DataFrame:
    """Dollar volume, its twenty-row score and its five-row change, by fund."""
    w = by("symbol")
    df = df.withColumn("dollar_volume", F.col("close") * F.col("volume"))
    deviation = clip(roll(F.stddev_samp, "dollar_volume", w, 20, 5), 1.0)
    return df.withColumns({"abnormal_volume": (F.col("dollar_volume") - roll(F.avg, "dollar_volume", w, 20, 5)) / deviation, "flow_momentum": F.try_divide(F.col("dollar_volume"), lag("dollar_volume", w, 5)) - 1})


def _sum(c: str, n: int) -> Column:
    return roll(F.sum, c, by("ticker"), n, 1)


def on_spine(grid: DataFrame, events: DataFrame, zero: list[str]) -> DataFrame:
    """Grid with the day's events; listed columns are 0 on days without."""
    return grid.join(events, ["ticker", "date"], "left").fillna(0, zero)


def insider_features(grid: DataFrame, daily: DataFrame) -> DataFrame:
    zero = [c for c in daily.columns if c not in ("ticker", "date")]
    df = on_spine(grid, daily, zero)
    df = df.withColumns({"insider_buys_30d": _sum("insider_buys", 30), "insider_sells_30d": _sum("insider_sells", 30), "insider_activity_5d": _sum("insider_transaction_count", 5), "insider_buy_value_30d": _sum("insider_buy_value", 30), "insider_net_value_30d": _sum("insider_net_value", 30), "grant_intensity_30d": _sum("grant_count", 30), "tax_event_30d": _sum("tax_withheld_count", 30), "option_exercise_30d": _sum("option_exercises", 30)})
    grants, sells = _sum("grant_count", 90), _sum("insider_sells", 90)
    return df.withColumns({"insider_officer_buy_ratio": _sum("officer_buys", 30) / F.greatest("insider_buys_30d", F.lit(1)), "total_disposal_30d": F.col("insider_sells_30d") + F.col("tax_event_30d"), "compensation_style_90d": F.try_divide(grants, grants + sells)})


def earnings_features(grid: DataFrame, reports: DataFrame) -> DataFrame:
    """Last surprise and whether it beat, rows since the last and to the next report, mean of four surprises."""
    reports = reports.groupBy("ticker", "date").agg(F.max_by("surprise_pct", F.coalesce("surprise_pct", F.lit(float("-inf")))).alias("surprise_pct"))
    reports = reports.withColumns({"earnings_surprise_ma": roll(F.avg, "surprise_pct", by("ticker"), 4, 1), "__report": F.lit(True)})
    df = grid.join(reports, ["ticker", "date"], "left").withColumn("__row", F.row_number().over(by("ticker")))
    df = df.withColumn("__at", F.when(F.col("__report"), F.col("__row")))
    later = F.last("__at", ignorenulls=True).over(Window.partitionBy("ticker").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"earnings_beat": F.when(F.col("surprise_pct").isNotNull(), (F.col("surprise_pct") > 0).cast("int")), "earnings_surprise_pct": ffill("surprise_pct", by("ticker")), "days_since_earnings": F.col("__row") - ffill("__at", by("ticker")), "days_to_next_earnings": later - F.col("__row"), "earnings_surprise_ma": ffill("earnings_surprise_ma", by("ticker"))}).drop("__row", "__at", "__report", "surprise_pct")


def congress_features(grid: DataFrame, daily: DataFrame) -> DataFrame:
    df = on_spine(grid, daily.select("ticker", "date", "congress_net", "congress_trade_count"), ["congress_net", "congress_trade_count"])
    return df.withColumns({"congress_activity_30d": _sum("congress_trade_count", 30), "congress_buy_signal": flag(_sum("congress_net", 30) > 0)})


def attention_features(grid: DataFrame, daily: DataFrame) -> DataFrame:
    df = grid.join(daily, ["ticker", "date"], "left").withColumns({c: F.coalesce(ffill(c, by("ticker")), F.lit(0)) for c in ("views", "pageviews_ma7", "attention_spike")})
    return df.withColumn("attention_trend", F.col("pageviews_ma7") / F.greatest(roll(F.avg, "views", by("ticker"), 30, 1), F.lit(1.0)))


def revision_features(grid: DataFrame, daily: DataFrame) -> DataFrame:
    zero = ["upgrades", "downgrades", "revisions", "net_revisions"]
    df = on_spine(grid, daily.select("ticker", "date", *zero), zero)
    df = df.withColumns({"revision_upgrades_30d": _sum("upgrades", 30), "revision_downgrades_30d": _sum("downgrades", 30), "revision_net_30d": _sum("net_revisions", 30), "revision_activity": _sum("revisions", 5)})
    total = F.col("revision_upgrades_30d") + F.col("revision_downgrades_30d")
    return df.withColumns({"revision_momentum": F.col("revision_net_30d") - _sum("net_revisions", 90) / 3, "revision_sentiment": clip(F.coalesce(F.try_divide(F.col("revision_net_30d"), total), F.lit(0.0)), -1.0, 1.0)})


def short_interest_features(grid: DataFrame, rows: DataFrame) -> DataFrame:
    df = grid.join(rows.select("ticker", "date", "days_to_cover", "short_pct_chg"), ["ticker", "date"], "left").withColumns({c: ffill(c, by("ticker")) for c in ("days_to_cover", "short_pct_chg")})
    return df.withColumn("short_squeeze_risk", F.when(F.col("days_to_cover").isNotNull(), flag((F.col("short_pct_chg") > 0) & (F.col("days_to_cover") > 5))))


def target_features(grid: DataFrame, daily: DataFrame) -> DataFrame:
    names = ["pt_mean", "pt_high", "pt_low", "pt_count", "pt_revision_direction"]
    df = grid.join(daily, ["ticker", "date"], "left").withColumns({c: ffill(c, by("ticker")) for c in names})
    return df.withColumns({"pt_dispersion": ratio(F.col("pt_high") - F.col("pt_low"), "pt_mean"), "pt_momentum_60d": F.try_divide(F.col("pt_mean"), lag("pt_mean", by("ticker"), 60)) - 1})


def macro_join(grid: DataFrame, macro: DataFrame, names: list[str]) -> DataFrame:
    """Grid with the macro columns of the day, carried forward, and their five-row changes."""
    df = grid.join(F.broadcast(macro.select("date", *names)), "date", "left").withColumns({c: ffill(c, by("ticker")) for c in names})
    return df.withColumns({f"{c}_5d_change": F.col(c) - lag(c, by("ticker"), 5) for c in names})


def event_features(grid: DataFrame, sources: dict[str, DataFrame], macro_names: list[str] = ()) -> DataFrame:
    """All features of the sources that are there, on the grid of (ticker, date), for all tickers in one plan.

    sources: rolled-up rows by name, of insider, earnings, congress, pageviews, macro, revisions, short_interest and targets. Every part
    keeps the grid's rows, so parts can be left out; columns of a source's day are in the result beside its features."""
    parts = {"insider": insider_features, "earnings": earnings_features, "congress": congress_features, "pageviews": attention_features, "macro": None, "revisions": revision_features, "short_interest": short_interest_features, "targets": target_features}
    unknown = set(sources) - set(parts)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    for name, part in parts.items():
        if name in sources:
            grid = macro_join(grid, sources[name], list(macro_names)) if part is None else part(grid, sources[name])
    return grid
