"""Panel assembly, selection, evaluation of forecasts and long/short portfolios."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.storage import checkpointed
from tidemark.functions.windows import by, rank_pct, roll


def panel(prices: DataFrame, macro: DataFrame, events: DataFrame, news: DataFrame, zero: list[str]) -> DataFrame:
    """Four sources joined to the price rows; event columns are 0 where missing."""
    df = prices.join(macro, "date", "left").join(events, ["date", "symbol"], "left").join(news, ["date", "symbol"], "left")
    return df.fillna(0, zero) if zero else df


def correlated_columns(df: DataFrame, columns: list[str], threshold: float) -> list[str]:
    """Columns to drop: walking in order, of a column and all earlier ones over the threshold, kept or not, only the one of highest variance stays.

    Spark computes the matrix, whose size is the number of columns; the walk needs nothing else."""
    rows = df.select(columns).dropna()
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(rows)
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    variance = rows.agg(*[F.var_samp(c).alias(c) for c in columns]).first().asDict()
    dropped: set[str] = set()
    for i, c in enumerate(columns):
        group = [columns[j] for j in range(i) if abs(matrix[i][j]) > threshold]
        if group:
            group.append(c)
            best = max(group, key=lambda x: variance[x])
            dropped |= {x for x in group if x != best}
    return [c for c in columns if c in dropped]


def split_at(df: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("date") < F.lit(day).cast("date")), df.where(F.col("date") >= F.lit(day).cast("date"))


def column_kinds(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """onehot: strings; pca: embedding columns; scale: more than two values; pass: the rest. One pass over the rows."""
    kinds = dict(df.dtypes)
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns if kinds[c] != "string"]).first().asDict()
    out: dict[str, list[str]] = {"onehot": [], "pca": [], "scale": [], "pass": []}
    for c in columns:
        out["onehot" if kinds[c] == "string" else "pca" if c.startswith("news_emb_") else "scale" if counts[c] > 2 else "pass"].append(c)
    return out


def ensemble(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean of two predictions of the same rows."""
    both = a.withColumnRenamed("prediction", "__a").join(b.select("date", "symbol", F.col("prediction").alias("__b")), ["date", "symbol"])
    return both.withColumn("prediction", (F.col("__a") + F.col("__b")) / 2).drop("__a", "__b")


def clip_predictions(df: DataFrame, train: DataFrame, widths: float = 3.0) -> DataFrame:
    """Predictions within three deviations of the training target."""
    bound = train.agg((widths * F.stddev_samp("target")).alias("__b"))
    p, b = F.col("prediction"), F.col("__b")
    return df.crossJoin(F.broadcast(bound)).withColumn("prediction", F.when(p > b, b).when(p < -b, -b).otherwise(p)).drop("__b")  # bound has one row


def with_overall_rank(df: DataFrame, column: str, name: str, ranges: int = 256) -> DataFrame:
    """`df` with the mean rank of a number among all rows; ties share theirs and NULL has none.

    Equal values are counted first. Approximate quantiles cut the values into ranges, each ranked in a task of its
    own, and the ranges' sizes, which are few, move their ranks up: no task sorts all rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__x")).agg(F.count("*").alias("__n"))
    cuts = sorted(set(counts.approxQuantile("__x", [i / ranges for i in range(1, ranges)], 0.001)))
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c <= F.col("__x")))
    counts = counts.withColumn("__r", place)
    sizes = counts.groupBy("__r").agg(F.sum("__n").alias("__size"))
    below = sizes.select("__r", (F.sum("__size").over(Window.orderBy("__r")) - F.col("__size")).alias("__below"))
    inside = F.sum("__n").over(Window.partitionBy("__r").orderBy("__x"))
    ranks = counts.withColumn("__up", inside).join(F.broadcast(below), "__r")  # one row a range
    ranks = ranks.select("__x", (F.col("__below") + F.col("__up") - (F.col("__n") - 1) / 2).alias(name))
    return df.join(ranks, df[column] == F.col("__x"), "left").drop("__x")


def scores(df: DataFrame, *keys: str) -> DataFrame:
    """n, rmse, rmse of zero, improvement in %, directional accuracy, Pearson and Spearman coefficients.

    Groups are ranked by windows over their keys; without keys all rows are ranked in ranges."""
    df = df.dropna(subset=["prediction", "actual"])
    if keys:
        df = df.withColumns({"__p": rank_pct("prediction", *keys), "__y": rank_pct("actual", *keys)})
    else:
        df = with_overall_rank(with_overall_rank(df, "prediction", "__p"), "actual", "__y")
    error, zero = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("actual"), 2))), F.sqrt(F.avg(F.pow(F.col("actual"), 2)))
    corr = lambda a, b: F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), error.alias("rmse"), zero.alias("rmse_zero"), F.avg(((F.col("prediction") > 0) == (F.col("actual") > 0)).cast("double")).alias("accuracy"), corr("prediction", "actual").alias("pearson"), corr("__p", "__y").alias("spearman"))
    return out.withColumn("improvement_pct", 100 * (1 - F.try_divide(F.col("rmse"), F.col("rmse_zero"))))


def with_p_value(df: DataFrame, coefficient: str = "spearman", n: str = "n") -> DataFrame:
    """`df` with `p_value`: how likely a coefficient at least as far from 0 is without correlation, by Student's t with n - 2 degrees of freedom.

    `df` has a few rows of scores; the tail is a finite sum for whole degrees of freedom. A coefficient of 1 or -1 has p 0, fewer than three rows none."""

    def tail(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([t_tail(float(a), int(b) - 2) if pd.notna(a) and pd.notna(b) and b > 2 else None for a, b in zip(r, k)], dtype="float64")

    return df.withColumn("p_value", F.pandas_udf(tail, "double")(coefficient, n))


def t_tail(r: float, freedom: int) -> float:
    """Two-sided tail of Student's t at r * sqrt(freedom / (1 - r^2)): the regularised incomplete beta function I(1 - r^2; freedom / 2, 1 / 2) by its continued fraction."""
    x, a, b = 1 - r * r, freedom / 2, 0.5
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _beta_fraction(1 - x, b, a) / b
    return front * _beta_fraction(x, a, b) / a


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated backwards from a depth that suffices for its convergence."""
    out, depth = 1.0, 200 + int(4 * math.sqrt(max(a, b)))
    for m in range(depth, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        out = 1 + even / (1 + odd / out)
    return 1 / (1 - (a + b) * x / (a + 1) / out)


def daily_ic(df: DataFrame, least: int = 5, smooth: int = 20) -> DataFrame:
    """Rank coefficient of each date with over `least` names, and its rolling mean. One row a date, so one ordered series."""
    ic = scores(df, "date").where(F.col("n") > least).select("date", "n", F.col("spearman").alias("ic"))
    return ic.withColumn("ic_mean", roll(F.avg, "ic", Window.orderBy("date"), smooth))


def symbol_ic(df: DataFrame, least: int = 10) -> DataFrame:
    return scores(df, "symbol").where(F.col("n") > least).select("symbol", "n", "rmse", "accuracy", F.col("spearman").alias("ic"))


def persistence(df: DataFrame) -> DataFrame:
    """Each symbol's actual of the row before as its forecast."""
    return df.withColumn("prediction", F.lag("actual").over(by("symbol")))


def numbered(df: DataFrame) -> DataFrame:
    """`df` with `__n`, the place of each row from 0 by (date, symbol): within its date, on top of the earlier dates' rows, of which there is one sum a date."""
    dates = df.groupBy("date").agg(F.count("*").alias("__rows"))
    below = dates.select("date", (F.sum("__rows").over(Window.orderBy("date")) - F.col("__rows")).alias("__below"))
    within = F.row_number().over(Window.partitionBy("date").orderBy("symbol"))
    return df.withColumn("__n", within).join(F.broadcast(below), "date").withColumn("__n", F.col("__below") + F.col("__n") - 1).drop("__below")  # one row a date


def dealing_primes(n: int) -> list[int]:
    """The first `n` primes above a million: steps by which values are dealt to other rows."""
    found: list[int] = []
    x = 1_000_001
    while len(found) < n:
        x += 2
        if all(x % d for d in range(3, math.isqrt(x) + 1, 2)):
            found.append(x)
    return found


#: A step that divides the number of rows would not reach all of them; this prime stands in for it.
OTHER_STEP = 998_244_353


def permutation_importance(df: DataFrame, features: list[str], score: Callable[[DataFrame], DataFrame], repeats: int = 5) -> DataFrame:
    """feature and importance: mean rise of the rmse when the feature's values are dealt to other rows of the whole table.

    score: DataFrame -> DataFrame with prediction, other columns kept. Rows are numbered by (date, symbol), which is unique; the value of row n
    goes to row (a * n + b) mod N, a permutation as a shares no divisor with N. The values of all features and repeats travel by their new
    numbers in one exchange and meet the rows in another, so all variants are scored and measured in one job, after one
    that counts the rows. An empty table gives no importance (null)."""
    count = df.count()
    steps = [p if count % p else OTHER_STEP for p in dealing_primes(len(features) * repeats)]
    rows = numbered(df)
    dealt = [F.struct(F.pmod(F.lit(a) * F.col("__n") + F.lit(7919 * (j + 1)), F.lit(max(count, 1)).cast("long")).alias("to"), F.lit(j).alias("j"), F.col(features[j // repeats]).cast("double").alias("x")) for j, a in enumerate(steps)]
    values = rows.select(F.explode(F.array(*dealt)).alias("d")).groupBy(F.col("d.to").alias("__n")).agg(F.collect_list(F.struct("d.j", "d.x")).alias("__dealt"))
    own = F.array(F.struct(F.lit(-1).alias("j"), F.lit(None).cast("double").alias("x")))
    variants = rows.join(values, "__n").withColumn("__v", F.explode(F.concat(own, "__dealt"))).drop("__dealt", "__n")
    for i, f in enumerate(features):
        mine = F.col("__v.j").between(i * repeats, (i + 1) * repeats - 1)
        variants = variants.withColumn(f, F.when(mine, F.col("__v.x")).otherwise(F.col(f).cast("double")))
    found = score(variants.withColumn("__j", F.col("__v.j")).drop("__v")).groupBy("__j").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("actual"), 2))).alias("__r"))
    plain = F.max(F.when(F.col("__j") < 0, F.col("__r"))).over(Window.partitionBy())  # a row a variant
    rise = found.withColumn("__rise", F.col("__r") - plain).where("__j >= 0").groupBy(F.floor(F.col("__j") / repeats).cast("int").alias("__i")).agg(F.avg("__rise").alias("importance"))
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "__i int, feature string")
    return names.join(rise, "__i", "left").select("feature", "importance")


# Families of features by the beginnings of their names; the first that fits counts.
FAMILIES = {
    "news_embedding": ["news_emb_"],
    "news_sentiment": ["news_"],
    "alternative": ["insider_", "revision_"],
    "macro": [
        "yc_", "rate_", "vix_", "hy_", "bbb_", "ted_", "credit_", "claims_", "unemp_", "sahm_", "oil_", "gold_", "usd_", "mortgage_", "fed_", "nfci_",
        "stress_", "risk_", "policy_", "growth_", "inflation_", "stagflation_", "treasury_", "breakeven_", "real_yield_", "consumer_sentiment", "m2_",
        "leading_", "nonfarm_", "continued_", "avg_weekly_", "cpi", "core_", "pce", "gas_", "jpy_", "eur_", "gbp_", "housing_", "building_", "permits_",
        "industrial_", "retail_sales_", "durable_", "inv_sales_", "term_premium_", "btc_", "copper_", "aggregate_flow", "credit_flow", "safety_flow",
        "risk_appetite", "spy_", "qqq_", "iwm_", "hyg_", "tlt_",
    ],
}
# End of fixed values.


def family(c: Column) -> Column:
    """Family of a feature name by its beginning; 'price/tech' if none fits."""
    out = F.lit("price/tech")
    for name, prefixes in reversed(FAMILIES.items()):
        out = F.when(reduce(Column.__or__, [c.startswith(p) for p in prefixes]), name).otherwise(out)
    return out


def family_importance(df: DataFrame) -> DataFrame:
    return df.groupBy(family(F.col("feature")).alias("family")).agg(F.sum("importance").alias("total"), F.avg("importance").alias("mean"), F.count("*").alias("n"))


def overall_quantiles(df: DataFrame, column: str, shares: list[float], ranges: int = 256) -> list[float]:
    """Exact quantiles of all known values, between neighbours linearly; no task sorts all rows and only ranges' sizes meet in one.

    Equal values are counted first; approximate quantiles cut them into ranges, and only the values at the wanted places come back."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("x")).agg(F.count("*").alias("n"))
    cuts = sorted(set(counts.approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.001)))
    counts = counts.withColumn("r", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c <= F.col("x"))))
    sizes = counts.groupBy("r").agg(F.sum("n").alias("size"))
    below = sizes.select("r", (F.sum("size").over(Window.orderBy("r")) - F.col("size")).alias("below"), F.sum("size").over(Window.partitionBy()).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("r").orderBy("x"))
    ranked = counts.withColumn("upto", upto).join(F.broadcast(below), "r").select("x", "total", (F.col("below") + F.col("upto") - F.col("n")).alias("first"), (F.col("below") + F.col("upto") - 1).alias("last"))  # one row a range
    places = [(F.col("total") - 1) * F.lit(q) for q in shares]
    wanted = reduce(Column.__or__, [(F.col("first") <= f(p)) & (F.col("last") >= f(p)) for p in places for f in (F.floor, F.ceil)])
    found = ranked.where(wanted).collect()
    out = []
    for q in shares:
        at = (found[0]["total"] - 1) * q if found else 0.0
        low, high = (next((r["x"] for r in found if r["first"] <= k <= r["last"]), float("nan")) for k in (math.floor(at), math.ceil(at)))
        out.append(low + (high - low) * (at - math.floor(at)))
    return out


def summary(df: DataFrame, column: str, *keys: str) -> DataFrame:
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.groupBy(*keys).agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(column).alias("max"))


def rebalance_dates(df: DataFrame, every: int) -> DataFrame:
    """Every k-th distinct date. Dates are few: one ordered series."""
    days = df.select("date").distinct().withColumn("__n", F.row_number().over(Window.orderBy("date")))
    return days.where(F.pmod(F.col("__n") - 1, F.lit(every)) == 0).select("date")


def legs(df: DataFrame, every: int = 5, share: float = 0.2, least: int = 10) -> DataFrame:
    """date, symbol, leg (long or short) and actual of each kept rebalance date; ties by symbol.

    The forecasts are written once to the checkpoint folder: dates, legs and periods are several passes over them."""
    df = checkpointed(df.select("date", "symbol", "prediction", "actual").dropna())
    df = df.join(F.broadcast(rebalance_dates(df, every)), "date", "left_semi")
    up = F.row_number().over(Window.partitionBy("date").orderBy("prediction", "symbol"))
    down = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("prediction"), F.desc("symbol")))
    df = df.withColumns({"__up": up, "__down": down, "__n": F.count("*").over(Window.partitionBy("date"))}).where(F.col("__n") >= least)
    size = F.greatest(F.lit(1), (F.col("__n") * share).cast("int"))
    leg = F.when(F.col("__down") <= size, "long").when(F.col("__up") <= size, "short")
    return checkpointed(df.withColumn("leg", leg).where("leg is not null").select("date", "symbol", "leg", "actual", size.alias("size")))


def portfolio(df: DataFrame, every: int = 5, share: float = 0.2, least: int = 10, bps: float = 10.0) -> DataFrame:
    """period, date, long and short means, gross and net return, and turnover of each kept rebalance date.

    Turnover of a leg is its share of names that were not in it a period before; the first is 1."""
    held = legs(df, every, share, least)
    numbered = held.select("date").distinct().withColumn("period", F.row_number().over(Window.orderBy("date")))
    held = held.join(F.broadcast(numbered), "date")  # one row a rebalance date
    before = F.lag("period").over(Window.partitionBy("leg", "symbol").orderBy("period"))
    held = held.withColumn("fresh", F.when(before == F.col("period") - 1, 0).otherwise(1))
    by_leg = held.groupBy("period", "date", "leg").agg(F.avg("actual").alias("mean"), F.avg("fresh").alias("turnover"))
    one = by_leg.groupBy("period", "date").agg(F.max(F.when(F.col("leg") == "long", F.col("mean"))).alias("long_return"), F.max(F.when(F.col("leg") == "short", F.col("mean"))).alias("short_return"), F.avg("turnover").alias("turnover"))
    one = one.withColumn("gross", F.col("long_return") - F.col("short_return"))
    return one.withColumn("net", F.col("gross") - F.col("turnover") * bps / 1e4 * 2)


def growth(df: DataFrame, column: str = "net") -> DataFrame:
    """Cumulative growth and drawdown of a series of periods."""
    so_far = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("cumulative", F.product(1 + F.col(column)).over(so_far))
    return df.withColumn("drawdown", F.col("cumulative") / F.max("cumulative").over(so_far) - 1)


def performance(df: DataFrame, every: int = 5) -> DataFrame:
    """One row: annual return, volatility, Sharpe ratio, total return, largest drawdown, share of winning periods."""
    year = 252 / every
    g = growth(df)
    out = g.agg((F.avg("net") * year).alias("annual_return"), (F.stddev_samp("net") * year**0.5).alias("annual_volatility"), (F.product(1 + F.col("net")) - 1).alias("total_return"), F.min("drawdown").alias("max_drawdown"), F.avg((F.col("net") > 0).cast("double")).alias("win_rate"), F.count("*").alias("periods"))
    return out.withColumn("sharpe", F.try_divide("annual_return", "annual_volatility"))


def monthly(df: DataFrame) -> DataFrame:
    """month and compounded return; months without periods have 0."""
    own = df.groupBy(F.last_day("date").alias("month")).agg((F.product(1 + F.col("net")) - 1).alias("ret"))
    span = df.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m")).select(F.last_day("m").alias("month"))
    return span.join(own, "month", "left").fillna(0.0, ["ret"])
