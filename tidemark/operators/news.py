"""News articles: cleaning, dates, merging, sentiment, daily aggregates and text vectors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.storage import checkpointed


def clean_html(c: Column) -> Column:
    """Without tags, white space folded."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))


def feed_date(c: Column, as_of: str) -> Column:
    """Date of a feed item in one of four formats, else `as_of`; the weekday's name is not parsed."""
    c = F.trim(F.regexp_replace(c, r"^[A-Za-z]{3},\s*", ""))
    c = F.regexp_replace(c, r"\s*(GMT|UTC|Z|[+-]\d{2}:?\d{2})$", "")
    tried = [F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in ("d MMM yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")]
    return F.coalesce(*tried, F.lit(as_of).cast("date"))


def table_date(c: Column) -> Column:
    """Dates like Mar-07-26; years from 69 on are of the last century."""
    day = F.to_date(F.try_to_timestamp(c, F.lit("MMM-dd-yy")))
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def relative_date(c: Column, as_of: str) -> Column:
    """Dates like '3 hours ago', '2 days ago', 7/3/2026 (day first, then month first) and ISO."""
    n = F.regexp_extract(c, r"(\d+)", 1).cast("int")
    day = F.lit(as_of).cast("date")
    low = F.lower(c)
    ago = F.when(low.rlike(r"\d+\s*(d|day)s?\b"), F.date_sub(day, n)).when(low.rlike(r"\d+\s*(m|min|minute|h|hour)s?\b"), day)
    tried = [F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in ("d/M/yyyy", "M/d/yyyy", "yyyy-MM-dd")]
    return F.coalesce(ago, *tried, day)


def merge_sources(sources: list[DataFrame]) -> DataFrame:
    """Articles of all sources; of equal headlines of a ticker the first source's first stays: by id, then by the other columns."""
    rows = None
    for i, s in enumerate(sources):
        s = s.withColumn("__rank", F.lit(i))
        rows = s if rows is None else rows.unionByName(s, allowMissingColumns=True)
    rest = sorted(c for c in rows.columns if c not in ("ticker", "headline", "__rank", "id"))
    first = F.row_number().over(Window.partitionBy("ticker", "headline").orderBy("__rank", "id", *rest))
    return rows.withColumn("__n", first).where("__n = 1").drop("__n", "__rank")


def model_sentiment(df: DataFrame, scorer: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], text: str = "headline", batch: int = 32) -> DataFrame:
    """Columns pos, neg, neu and compound from a batch scorer that gives a label and a probability; blank texts score 'no content'.

    `scorer` is called once in each task and returns the function that scores a list of texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for frame in frames:
            values = [t if isinstance(t, str) and t.strip() else "no content" for t in frame[text]]
            found = [x for i in range(0, len(values), batch) for x in score(values[i : i + batch])]
            yield frame.assign(__label=[x[0] for x in found], __p=[float(x[1]) for x in found])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    out = df.mapInPandas(run, f"{fields}, __label string, __p double")
    part = lambda name: F.round(F.when(F.col("__label") == name, F.col("__p")).otherwise(0.0), 4)
    out = out.withColumns({"pos": part("positive"), "neg": part("negative"), "neu": part("neutral")})
    return out.withColumn("compound", F.round(F.col("pos") - F.col("neg"), 4)).drop("__label", "__p")


def embed(df: DataFrame, encoder: Callable[[], Callable[[list[str]], list[list[float]]]], text: str = "headline", name: str = "embedding") -> DataFrame:
    """The rows with a vector of each text, from an encoder that each task makes once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for frame in frames:
            yield frame.assign(**{name: encode([t if isinstance(t, str) else "" for t in frame[text]])})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, `{name}` array<float>")


def embed_tokens(df: DataFrame, encoder: Callable[[], tuple[Callable, Callable]], text: str = "headline", name: str = "embedding", most_tokens: int = 128, pooling: str = "first", batch: int = 32) -> DataFrame:
    """The rows with one vector of each text from an encoder of tokens, which each task makes once.

    The encoder gives a tokenizer (text to tokens) and a model (batch of token lists to one vector a token). A text counts with its first
    `most_tokens` tokens, by the vector of the first one or the mean of all; a text without tokens, and a null, has null."""
    if pooling not in ("first", "mean"):
        raise ValueError(f"unknown pooling {pooling}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens_of, encode = encoder()
        for frame in frames:
            tokens = [list(tokens_of(t))[:most_tokens] if isinstance(t, str) else [] for t in frame[text]]
            out: list = [None] * len(tokens)
            full = sorted((i for i, t in enumerate(tokens) if t), key=lambda i: len(tokens[i]))  # texts of like length together
            for start in range(0, len(full), batch):
                own = full[start : start + batch]
                for i, vectors in zip(own, encode([tokens[i] for i in own])):
                    out[i] = list(vectors[0]) if pooling == "first" else np.mean(np.asarray(vectors, float), axis=0).tolist()
            yield frame.assign(**{name: out})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{fields}, `{name}` array<double>")


def daily_sentiment(df: DataFrame, column: str = "description_sentiment") -> DataFrame:
    return df.groupBy("date", "ticker").agg(F.avg(column).alias("sentiment_mean"), F.median(column).alias("sentiment_median"), F.coalesce(F.stddev_samp(column), F.lit(0.0)).alias("sentiment_std"), F.min(column).alias("sentiment_min"), F.max(column).alias("sentiment_max"), F.count("*").alias("news_count"))


def daily_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Mean vector by date and ticker, as rows of place and value gathered again."""
    parts = df.select("date", "ticker", F.posexplode(column).alias("place", "x")).groupBy("date", "ticker", "place").agg(F.avg("x").alias("x"))
    return parts.groupBy("date", "ticker").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias(column))


#: English words that name no subject.
STOP_WORDS = frozenset("me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very can will just don should now cannot could ought would".split())
_TERM = re.compile(r"\w\w+")


def terms_of(text: str, stop: frozenset[str]) -> list[str]:
    """Words of two characters or more in lower case that are no stop words, then pairs of neighbours among them."""
    words = [w for w in _TERM.findall(text.lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def frequent_terms(rows: DataFrame, stop: frozenset[str], most: int, held: int) -> tuple[list[str], bool]:
    """Terms among which the `most` most frequent of the column `text` are for sure, and whether that is certain.

    A task holds the counts of `held` terms; when twice as many have come, the smaller ones go and their largest count is what any count of
    the task may lack at most. A term is left out if its sum with all that may be lacking is below the sum of the term of rank `most`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        lacking = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(terms_of(text, stop))
                if len(counts) > 2 * held:
                    cut = sorted(counts.values(), reverse=True)[held]
                    lacking += cut
                    counts = Counter({t: c - cut for t, c in counts.items() if c > cut})
        names = [None, *counts]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([lacking, *counts.values()], pa.int64())], names=["term", "n"])

    sums = checkpointed(rows.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")))
    lacking = (sums.where("term is null").first() or {"n": 0})["n"]
    top = sums.where("term is not null").orderBy(F.desc("n")).limit(most).agg(F.min("n").alias("n"), F.count("*").alias("k")).first()
    if top["k"] < most:
        return [r.term for r in sums.where("term is not null").limit(held).collect()], lacking == 0
    near = sums.where("term is not null").where(F.col("n") >= top["n"] - lacking)
    found = [r.term for r in near.limit(held + 1).collect()]
    return found, len(found) <= held and top["n"] > lacking


def tfidf(df: DataFrame, columns: list[str], most: int = 100, key: str = "id", held: int = 100_000) -> DataFrame:
    """key, term and weight: terms of one and two words of the corpus' `most` most frequent, smooth idf, unit length.

    Terms of equal count are taken in the order of their letters. A first pass finds terms that may be among these, `held` at most; the second
    counts them exactly, by row, and all else comes from these counts. Where the first pass cannot be certain, all terms are counted. The
    key is unique; null texts are empty; rows without any of the terms have no weights."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    rows = df.select(F.col(key).alias("key"), text.alias("text"))
    stop = STOP_WORDS
    found, certain = frequent_terms(rows, stop, most, held)
    wanted = frozenset(found) if certain else None
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, terms, counts = [], [], []
            for i, value in enumerate(batch.column("text").to_pylist()):
                own = Counter(t for t in terms_of(value, stop) if wanted is None or t in wanted)
                keys += [i] * len(own)
                terms += own
                counts += own.values()
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(keys, pa.int64())), pa.array(terms, pa.string()), pa.array(counts, pa.int64())], names=["key", "term", "tf"])

    counts = checkpointed(rows.mapInArrow(run, f"key {kind}, term string, tf bigint"))
    chosen = counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("df")).orderBy(F.desc("n"), "term").limit(most)
    idf = chosen.select("term", (F.log((1 + F.lit(df.count())) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = counts.join(F.broadcast(idf), "term").withColumn("x", F.col("tf") * F.col("idf"))  # `most` rows
    length = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("key")))
    return raw.select(F.col("key").alias(key), "term", (F.col("x") / length).alias("weight"))


def lagged_news(df: DataFrame, mode: str = "calendar", days: DataFrame | None = None) -> DataFrame:
    """News columns named news_*, moved to the next calendar day or to the next of the trading `days`."""
    names = [c for c in df.columns if c not in ("date", "ticker")]
    df = df.withColumnsRenamed({c: f"news_{c}" for c in names})
    if mode == "calendar":
        return df.withColumn("date", F.date_add("date", 1))
    ordered = days.select("date").distinct().withColumn("__open", F.lit(True))
    grid = df.select("date").distinct().join(ordered, "date", "full")
    after = F.last(F.when(F.col("__open"), F.col("date")), ignorenulls=True).over(Window.orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, -1))
    return df.join(F.broadcast(grid.select("date", after.alias("__next"))), "date").withColumn("date", F.col("__next")).drop("__next").where("date is not null")


def news_features(sources: list[DataFrame], sentiment: Callable[[DataFrame], DataFrame], vectors: Callable[[DataFrame], DataFrame] | None = None, aggregate: bool = False) -> DataFrame:
    """Landed articles of several sources through one plan for all tickers: merged, scored, given vectors if asked for, rolled up if asked for.

    sentiment: articles to articles with description_sentiment. vectors: articles to articles with a column `embedding`. Rolled up, a
    (date, ticker) has its daily sentiment and, with vectors, their mean. Without articles the result is empty."""
    rows = sentiment(merge_sources(sources))
    if vectors is not None:
        rows = vectors(rows)
    if not aggregate:
        return rows
    if vectors is None:
        return daily_sentiment(rows)
    rows = checkpointed(rows.select("date", "ticker", "description_sentiment", "embedding"))  # both halves read them
    return daily_sentiment(rows).join(daily_vectors(rows), ["date", "ticker"], "left")
