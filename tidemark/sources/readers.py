"""Landed files as tables, and results kept by their parameters."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def economic_series(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """date, series and value of two-column CSV files, or folders of such files, named after their series; '.' and other non-numbers go. names: series id to name."""
    series = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv(/part-[^/]*)?$", 1)
    rows = spark.read.csv(path, header=True, schema="date string, value string").select("date", "value", series.alias("series"))
    rows = rows.select(F.expr("try_cast(date AS date)").alias("date"), "series", F.expr("try_cast(value AS double)").alias("value")).dropna()
    if names is None:
        return rows
    mapping = spark.createDataFrame(list(names.items()), "series string, name string")
    return rows.join(F.broadcast(mapping), "series").select("date", F.col("name").alias("series"), "value")


def file_date(path: Column) -> Column:
    """Date in a file name, as 2024-01-15, 2024_01_15 or 20240115."""
    part = lambda i: F.regexp_extract(path, r"(\d{4})[_-]?(\d{2})[_-]?(\d{2})", i)
    return F.try_to_date(F.concat_ws("-", part(1), part(2), part(3)), "yyyy-MM-dd")


def landed_name(path: Column) -> Column:
    """Name of a landed file, or of the folder of a part file."""
    name = F.substring_index(path, "/", -1)
    return F.when(name.startswith("part-"), F.substring_index(F.substring_index(path, "/", -2), "/", 1)).otherwise(name)


def short_interest(spark: SparkSession, path: str, tickers: list[str] | None = None) -> DataFrame:
    """ticker, date, short_interest, average_volume and days_to_cover of pipe-delimited files; columns found by words of their headers."""
    rows = spark.read.csv(path, header=True, sep="|")
    find = lambda *words: next((c for c in rows.columns if all(w in c.lower().replace("_", " ") for w in words)), None)
    number = lambda c: F.regexp_replace(F.col(f"`{c}`"), ",", "").try_cast("double") if c else F.lit(None).cast("double")
    symbol = find("symbol") or find("ticker")
    if symbol is None:
        raise ValueError(f"no symbol column among {rows.columns}")
    out = rows.select(F.upper(F.trim(F.col(f"`{symbol}`"))).alias("ticker"), file_date(landed_name(F.col("_metadata.file_path"))).alias("date"), number(find("current", "short") or find("short", "interest")).alias("short_interest"), number(find("average", "volume") or find("avg", "volume")).alias("average_volume"), number(find("days", "cover")).alias("days_to_cover"))
    return out.where(F.col("ticker").isin(tickers)) if tickers else out


def price_targets(spark: SparkSession, path: str) -> DataFrame:
    """ticker, date, firm, target and posted price of JSON arrays; a posted price of 0 is missing, rows without a valid date or target go."""
    rows = spark.read.json(path, multiLine=True, schema="symbol string, publishedDate string, analystCompany string, priceTarget string, priceWhenPosted double")
    out = rows.select(F.col("symbol").alias("ticker"), F.try_to_date(F.substring("publishedDate", 1, 10), "yyyy-MM-dd").alias("date"), F.col("analystCompany").alias("firm"), F.col("priceTarget").try_cast("double").alias("target"), F.nullif(F.col("priceWhenPosted"), F.lit(0.0)).alias("posted"))
    return out.where("date is not null and target is not null")


def pageviews(spark: SparkSession, path: str) -> DataFrame:
    """article, date and views of JSON documents with items."""
    items = spark.read.json(path, multiLine=True, schema="items array<struct<article: string, timestamp: string, views: bigint>>").select(F.explode("items").alias("i"))
    return items.select("i.article", F.try_to_date(F.substring("i.timestamp", 1, 8), "yyyyMMdd").alias("date"), "i.views")


def with_articles(df: DataFrame, titles: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """`df` with `article` of its ticker: the title that the table `titles` (ticker, title) has for it in any case, else the ticker with '_(company)'.

    Of several titles of a ticker the first by its letters counts. The table is broadcast where it is small."""
    known = titles.where("ticker is not null and title is not null").groupBy(F.upper("ticker").alias("__ticker")).agg(F.min("title").alias("__title"))
    known = F.broadcast(known) if titles.count() <= most_broadcast else known
    out = df.join(known, F.upper(df["ticker"]) == F.col("__ticker"), "left")
    return out.withColumn("article", F.coalesce("__title", F.concat(F.upper(df["ticker"]), F.lit("_(company)")))).drop("__ticker", "__title")


def feed_items(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """title, description, link and pubDate of the items of RSS files, the first `most` of each file by their order in it."""
    rows = spark.read.format("xml").option("rowTag", "item").schema("title string, description string, link string, pubDate string").load(path)
    if not most:
        return rows
    numbered = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    place = F.row_number().over(Window.partitionBy("__file").orderBy("__block", "__at"))
    return numbered.withColumn("__n", place).where(F.col("__n") <= most).drop("__file", "__block", "__at", "__n")


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, one for each key: of the new side if it has one, else of the old; of equals the least. Columns of either side are kept."""
    both = old.withColumn("__side", F.lit(1)).unionByName(new.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    rest = sorted(c for c in both.columns if c not in (*keys, "__side"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("__side", *rest))
    return both.withColumn("__n", place).where("__n = 1").drop("__n", "__side")


def fetch_plan(store: DataFrame, end: str, tolerance: int = 7) -> DataFrame:
    """source, ticker, latest and fetch_from: the day after the latest, missing where it is within the tolerance of `end`."""
    last = store.groupBy("source", "ticker").agg(F.max("date").alias("latest"))
    return last.withColumn("fetch_from", F.when(F.datediff(F.lit(end).cast("date"), "latest") > tolerance, F.date_add("latest", 1)))


def result_path(folder: str, **parameters) -> str:
    """Place of a result in a store keyed by its parameters: the same parameters give the same place, in any order and with any order of lists."""
    plain = {k: sorted(v) if isinstance(v, (list, tuple, set)) else v for k, v in parameters.items()}
    return f"{folder}/result-{hashlib.sha256(json.dumps(plain, sort_keys=True, default=str).encode()).hexdigest()[:16]}"


def stored_result(spark: SparkSession, folder: str, make: Callable[[], DataFrame], **parameters) -> DataFrame:
    """The result of these parameters, from the store or else made and written there. A half-written result has no _SUCCESS file and is made again."""
    path = result_path(folder, **parameters)
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").schema
    except AnalysisException:
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header."""
    df.write.mode("overwrite").csv(path, header=True)
