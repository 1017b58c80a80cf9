"""Checks, cleaning, outliers, time features and scaling of daily bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import bfill, by, ffill, least, most
from tidemark.operators.evaluate import overall_quantiles

PRICES = ["open", "high", "low", "close"]


def load_bars(df: DataFrame, start: str, end: str, symbols: list[str] | None = None) -> DataFrame:
    """Bars of `symbols` from start to before end, names in lower case."""
    df = df.toDF(*[c.lower() for c in df.columns]).where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
    return df.where(F.col("symbol").isin(symbols)) if symbols else df


def wide_to_long(df: DataFrame, fields: list[str], key: str = "date") -> DataFrame:
    """Columns named field_symbol become rows of date and symbol with a column for each field."""
    names = [c for c in df.columns if c != key and c.split("_", 1)[0] in fields]
    long = df.unpivot([key], names, "name", "value").withColumns({"field": F.substring_index("name", "_", 1), "symbol": F.regexp_replace("name", "^[^_]*_", "")})
    return long.groupBy(key, "symbol").pivot("field", fields).agg(F.first("value"))


def symbol_info(df: DataFrame, info: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with columns of a small dimension by symbol; 'N/A' where it has none."""
    small = info.select("symbol", *columns).dropDuplicates(["symbol"])
    return df.join(small, "symbol", "left").fillna("N/A", columns)


def report(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, prices that are not positive, negative volumes and nulls of each column, by group."""
    missing = [c for c in [*PRICES, "volume"] if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    low = [F.count_if(F.col(c) <= 0).alias(f"bad_{c}") for c in PRICES]
    null = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in [*PRICES, "volume"]]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *low, F.count_if(F.col("volume") < 0).alias("bad_volume"), *null)


def loader_fill(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Prices carried forward, missing volumes 0, and the day's price change."""
    w = by(key)
    df = df.withColumns({**{c: ffill(c, w) for c in PRICES}, "volume": F.coalesce("volume", F.lit(0.0))})
    return df.withColumn("price_change", F.col("close") - F.col("open"))


def zero_to_null(df: DataFrame) -> DataFrame:
    """Prices of zero become missing, negative ones stay; volumes below zero become zero."""
    return df.withColumns({**{c: F.nullif(F.col(c), F.lit(0.0)) for c in PRICES}, "volume": F.when(F.col("volume") < 0, 0.0).otherwise(F.col("volume"))})


def fill_missing(df: DataFrame, method: str, columns: list[str], key: str = "symbol") -> DataFrame:
    """forward_fill, backward_fill, interpolate (linear by position, the end padded), drop or none."""
    w = by(key)
    if method == "none":
        return df
    if method == "drop":
        return df.dropna(subset=columns)
    if method == "forward_fill":
        return df.withColumns({c: ffill(c, w) for c in columns})
    if method == "backward_fill":
        return df.withColumns({c: bfill(c, key) for c in columns})
    if method != "interpolate":
        raise ValueError(f"unknown method {method}")
    df = df.withColumn("__row", F.row_number().over(w))
    marks = {f"__{c}": F.when(F.col(c).isNotNull(), F.struct("__row", F.col(c).alias("x"))) for c in columns}
    df = df.withColumns(marks)
    out = {}
    for c in columns:
        a, b = ffill(f"__{c}", w), bfill(f"__{c}", key)
        line = a["x"] + (b["x"] - a["x"]) * F.try_divide(F.col("__row") - a["__row"], b["__row"] - a["__row"])
        out[c] = F.when(F.col(c).isNotNull() | a.isNull(), F.col(c)).when(b.isNull(), a["x"]).otherwise(line)
    return df.withColumns(out).drop("__row", *marks)


def repair_ranges(df: DataFrame) -> DataFrame:
    """high at least low; open and close moved into the range."""
    df = df.withColumn("high", most("high", "low"))
    return df.withColumns({c: least(most(c, "low"), F.col("high")) for c in ("open", "close")})


def enforce_relations(df: DataFrame) -> DataFrame:
    """high at least, and low at most, of open and close."""
    return df.withColumns({"high": most("high", "open", "close"), "low": least("low", "open", "close")})


def volume_floor(df: DataFrame, floor: float) -> DataFrame:
    return df.withColumn("volume", most("volume", F.lit(floor)))


def smooth_volume(df: DataFrame, n: int, key: str = "symbol") -> DataFrame:
    """Centred mean of n rows; edges keep the raw value. It looks ahead: never a model input."""
    frame = by(key).rowsBetween(-(n // 2), (n - 1) // 2)
    mean = F.when(F.count("volume").over(frame) >= n, F.avg("volume").over(frame))
    return df.withColumn("volume", F.coalesce(mean, F.col("volume")))


#: Methods of the flags out_iqr (1.5 ranges), out_z and out_mz (by median deviation; a group with a gap flags nothing).
OUTLIERS = {"iqr": "out_iqr", "zscore": "out_z", "modified_zscore": "out_mz"}


def _with_outliers(df: DataFrame, columns: list[str], methods: list[str], threshold: float, key: str) -> DataFrame:
    """`df` with a flag `__<method>_<i>` for each method and column, from exact statistics of each group.

    All statistics are windows over the group, so rows are dealt by the key once for all columns and nothing is joined."""
    group = Window.partitionBy(key)
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    made, flags = {}, {}
    for i, c in enumerate(columns):
        if methods != ["zscore"]:
            made[f"__q{i}"] = F.percentile(c, quarters).over(group)
        if "zscore" in methods:
            made |= {f"__m{i}": F.avg(c).over(group), f"__s{i}": F.stddev_samp(c).over(group)}
        if "modified_zscore" in methods:
            made[f"__g{i}"] = F.count_if(F.col(c).isNull()).over(group)
    df = df.withColumns(made)
    if "modified_zscore" in methods:
        spread = {f"__d{i}": F.percentile(F.abs(F.col(c) - F.col(f"__q{i}")[1]), F.lit(0.5)).over(group) for i, c in enumerate(columns)}
        df, made = df.withColumns(spread), made | spread
    for i, c in enumerate(columns):
        x, q = F.col(c), F.col(f"__q{i}")
        tests = {
            "iqr": lambda: (x < q[0] - 1.5 * (q[2] - q[0])) | (x > q[2] + 1.5 * (q[2] - q[0])),
            "zscore": lambda: F.abs(F.try_divide(x - F.col(f"__m{i}"), F.col(f"__s{i}"))) > threshold,
            "modified_zscore": lambda: (F.col(f"__g{i}") == 0) & (F.abs(F.try_divide(0.6745 * (x - q[1]), F.col(f"__d{i}"))) > threshold),
        }
        flags |= {f"__{m}_{i}": F.coalesce(tests[m](), F.lit(False)) for m in methods}
    return df.withColumns(flags).drop(*made)


def outlier_flags(df: DataFrame, column: str, threshold: float = 3.0, key: str = "symbol") -> DataFrame:
    """The flags of all methods for one column."""
    return _with_outliers(df, [column], list(OUTLIERS), threshold, key).withColumnsRenamed({f"__{m}_0": name for m, name in OUTLIERS.items()})


def remove_outliers(df: DataFrame, columns: list[str], method: str = "iqr", threshold: float = 3.0, key: str = "symbol") -> DataFrame:
    """Rows that no column flags by the method iqr, zscore or modified_zscore."""
    if method not in OUTLIERS:
        raise ValueError(f"unknown method {method}")
    flags = [f"__{method}_{i}" for i in range(len(columns))]
    df = _with_outliers(df, columns, [method], threshold, key)
    return df.where(~reduce(Column.__or__, [F.col(f) for f in flags])).drop(*flags)


def time_features(date: str = "date") -> dict[str, Column]:
    """Fourteen parts of a date; weeks begin on Monday."""
    d = F.col(date)
    quarter_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.day(d),
        "dayofweek": F.weekday(d),
        "dayofyear": F.dayofyear(d),
        "week": F.weekofyear(d),
        "quarter": F.quarter(d),
        "is_weekend": F.weekday(d) >= 5,
        "is_month_start": F.day(d) == 1,
        "is_month_end": d == F.last_day(d),
        "is_quarter_start": d == F.to_date(F.trunc(d, "quarter")),
        "is_quarter_end": d == quarter_end,
        "is_year_start": F.dayofyear(d) == 1,
        "is_year_end": (F.month(d) == 12) & (F.day(d) == 31),
    }


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of statistics over the rows where all columns are known."""
    df = df.dropna(subset=columns)
    out = []
    for c in columns:
        quarters = [F.lit(q) for q in overall_quantiles(df, c, [0.25, 0.5, 0.75])]
        out += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.first(F.array(*quarters)).alias(f"{c}_q")]
    return df.agg(*out)


def scale(df: DataFrame, stats: DataFrame, columns: list[str], method: str) -> DataFrame:
    """standard, robust or minmax; a constant column is divided by one."""
    df = df.crossJoin(F.broadcast(stats))  # stats has one row
    out = {}
    for c in columns:
        centre, width = {
            "standard": (F.col(f"{c}_mean"), F.col(f"{c}_std")),
            "robust": (F.col(f"{c}_q")[1], F.col(f"{c}_q")[2] - F.col(f"{c}_q")[0]),
            "minmax": (F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")),
        }[method]
        out[c] = (F.col(c) - centre) / F.when(width == 0, 1.0).otherwise(width)
    return df.withColumns(out).drop(*stats.columns)


def clean(df: DataFrame, fill: str = "forward_fill", floor: float = 0.0, smooth: int = 0, outliers: str | None = None, scaler: str | None = None, times: bool = False, key: str = "symbol") -> DataFrame:
    """The whole cleaning chain for each series; statistics of a scaler come from the raw rows."""
    columns = [*PRICES, "volume"]
    out = df.transform(zero_to_null).transform(fill_missing, fill, columns, key).transform(repair_ranges).transform(enforce_relations).transform(volume_floor, floor)
    if smooth:
        out = smooth_volume(out, smooth, key)
    if outliers:
        out = remove_outliers(out, columns, outliers, key=key)
    if times:
        out = out.withColumns(time_features())
    return scale(out, fit_scaler(df, columns), columns, scaler) if scaler else out


def drop_today(df: DataFrame) -> DataFrame:
    """Without what is only known after the day: prices, volume, dividends, splits and price change."""
    return df.drop(*PRICES, "volume", "dividends", "stock splits", "price_change")


def drop_sparse_columns(df: DataFrame, share: float) -> DataFrame:
    """Columns known on int((1 - share) * n) rows or more."""
    counts = df.agg(F.count("*").alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if counts[c] >= int((1 - share) * counts["__n"])])


def keep_symbols(df: DataFrame, symbols: list[str], zero_prefix: str) -> DataFrame:
    """Rows of listed symbols; columns of a prefix are 0 where missing."""
    zero = [c for c in df.columns if c.startswith(zero_prefix)]
    df = df.where(F.col("symbol").isin(symbols))
    return df.fillna(0, zero) if zero else df


def between_dates(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
