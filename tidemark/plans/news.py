"""Queries over articles derived from the documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import news as N
from tidemark.operators import sentiment as S
from tidemark.plans.events import TD, _round
from tidemark.sources.fixtures import ARTICLES_SQL, articles, table

QUERIES: dict = {}


def _spark(f):
    QUERIES[f.__name__] = f
    return f


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """Values of words from the labelled documents: those of toxic texts are negative."""
    return S.label_lexicon(table(spark, sf, "documents"), table(spark, sf, "labels"), F.col("toxic") == 0)


def with_sentiment(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    """id, ticker, date and sentiment of the articles."""
    return S.sentence_sentiment(rows, lexicon(spark, sf), keep=("ticker", "date"))


FIVE = ["headline_sentiment", "description_sentiment", "sentiment_positive", "sentiment_negative", "sentiment_neutral"]


@_spark
def news_sentence_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment of every article's headline and description, with shares."""
    return _round(S.sentence_sentiment(articles(spark, sf), lexicon(spark, sf)), ["id"], FIVE)


@_spark
def news_daily_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sentiment of descriptions, moved to the next day."""
    out = N.lagged_news(N.daily_sentiment(with_sentiment(spark, sf, articles(spark, sf))))
    return _round(out, TD, [c for c in out.columns if c.startswith("news_")])


def _token_encoder():
    """A stand-in for an encoder of tokens: the words of a text, and their lengths and numbers of e as vectors."""
    return (lambda text: [w for w in text.split(" ") if w]), (lambda lists: [[[float(len(w)), float(w.count("e"))] for w in words] for words in lists])


@_spark
def news_pooled(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vectors of the first 128 tokens of every description, as rows."""
    found = N.embed_tokens(articles(spark, sf).select("id", "description"), _token_encoder, "description", pooling="mean")
    return found.select("id", F.posexplode("embedding").alias("place", "x")).select("id", F.col("place").cast("bigint").alias("place"), F.round("x", 6).alias("x"))


@_spark
def news_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of the 100 most frequent terms in every article."""
    return N.tfidf(articles(spark, sf), ["headline", "description"]).withColumn("weight", F.round("weight", 6))


@_spark
def news_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of two sources merged, scored, given vectors and rolled up by day and ticker."""
    a = articles(spark, sf)
    vectors = lambda rows: rows.join(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), "id", "left")
    out = N.news_features([a.where("id % 3 = 0"), a.where("id % 3 != 0")], lambda rows: with_sentiment(spark, sf, rows), vectors, aggregate=True)
    return out.select("ticker", "date", F.round("sentiment_mean", 6).alias("sentiment_mean"), F.col("news_count"), F.round(F.get("embedding", F.lit(0)), 6).alias("x0"))


def _words_sql(text: str) -> str:
    bare = r"""regexp_replace(x, '^[.,;:!?"''\-]+|[.,;:!?"''\-]+$', '', 'g')"""
    return rf"list_transform(list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: length(x) > 1), lambda x: CASE WHEN length({bare}) > 1 THEN {bare} ELSE x END)"


def _step_sql(k: int, source: str) -> str:
    """One place of words before: first what strengthens, then what negates."""
    sign, caps = "CASE WHEN x < 0 THEN -1 ELSE 1 END", f"CASE WHEN caps{k} AND mixed THEN CASE WHEN x > 0 THEN {S.CAPITALS}::DOUBLE ELSE -{S.CAPITALS}::DOUBLE END ELSE 0 END"
    factor = f"CASE WHEN not{k} THEN {S.NEGATED}::DOUBLE ELSE 1 END"
    if k == 2:
        factor = f"CASE WHEN low2 = 'never' AND low1 IN ('so', 'this') THEN 1.5 ELSE {factor} END"
    if k == 3:
        factor = f"CASE WHEN low3 = 'never' AND low2 IN ('so', 'this') OR low1 IN ('so', 'this') THEN 1.25 ELSE {factor} END"
    return f"SELECT * REPLACE (CASE WHEN plain{k} THEN (x + coalesce((({sign}) * boost{k} + {caps}) * {S.DECAY[k - 1]}::DOUBLE, 0)) * {factor} ELSE x END AS x) FROM {source}"


def sentiment_sql(source: str, name: str = "senti") -> str:
    """CTEs that end in a table `name` of the sentiment of the articles in `source`."""
    rules = [*((w, S.BOOST, "false") for w in S.STRONGER), *((w, -S.BOOST, "false") for w in S.WEAKER), *((w, "NULL", "true") for w in S.NEGATIONS)]
    values = ", ".join(f"('{w.replace(chr(39), chr(39) * 2)}', {b}, {n})" for w, b, n in rules)
    lags = ", ".join(f"coalesce(lag(low, {k}) OVER p, '') AS low{k}, lag(boost, {k}) OVER p AS boost{k}, coalesce(lag(negates, {k}) OVER p, false) AS not{k}, coalesce(lag(value IS NULL, {k}) OVER p, false) AS plain{k}, coalesce(lag(caps, {k}) OVER p, false) AS caps{k}" for k in (1, 2, 3))
    count = lambda mark: f"(length(text) - length(replace(text, '{mark}', '')))"
    share = lambda c: f"coalesce(max(CASE WHEN part = 'h' THEN coalesce({c} / nullif(up + down + even, 0), 0) END), 0)"
    return rf"""kinds AS (SELECT doc_id, max((toxic = 0)::INT) AS good FROM labels GROUP BY doc_id),
seen AS (SELECT good, unnest(list_distinct(list_transform({_words_sql("coalesce(text, '')")}, lambda x: lower(x)))) AS word FROM documents JOIN kinds USING (doc_id)),
whole AS (SELECT sum(good)::BIGINT AS g, sum(1 - good)::BIGINT AS b FROM kinds WHERE doc_id IN (SELECT doc_id FROM documents)),
counted AS (SELECT word, sum(good)::BIGINT AS g, sum(1 - good)::BIGINT AS b FROM seen GROUP BY word HAVING count(*) >= 5),
lexicon AS (SELECT word, 4::DOUBLE * (c.g * w.b - c.b * w.g) / (c.g * w.b + c.b * w.g) AS value FROM counted c, whole w WHERE abs(4::DOUBLE * (c.g * w.b - c.b * w.g) / (c.g * w.b + c.b * w.g)) >= 0.5),
extra(word, boost, negates) AS (VALUES {values}),
rules AS (SELECT coalesce(l.word, e.word) AS word, value, boost::DOUBLE AS boost, coalesce(negates, false) AS negates FROM lexicon l FULL JOIN extra e ON l.word = e.word),
parts AS (SELECT id, 'h' AS part, coalesce(headline, '') AS text FROM {source} UNION ALL SELECT id, 'd', coalesce(description, '') FROM {source}),
split AS (SELECT id, part, {_words_sql("text")} AS ws, least({count("!")}, 4) * {S.EXCLAMATION}::DOUBLE + CASE WHEN {count("?")} > 3 THEN {S.MANY_QUESTIONS}::DOUBLE WHEN {count("?")} > 1 THEN {count("?")} * {S.QUESTION}::DOUBLE ELSE 0 END AS emphasis FROM parts),
loud AS (SELECT *, len(list_filter(ws, lambda x: x = upper(x) AND x != lower(x))) AS n_loud, coalesce(list_position(list_transform(ws, lambda x: lower(x)), 'but'), 0) - 1 AS but_at FROM split),
words AS (SELECT id, part, emphasis, n_loud > 0 AND n_loud < len(ws) AS mixed, but_at, unnest(ws) AS word, unnest(range(0, len(ws))) AS place FROM loud),
tagged AS (SELECT w.* EXCLUDE (word), lower(w.word) AS low, w.word = upper(w.word) AND w.word != lower(w.word) AS caps, value, boost, coalesce(negates, false) OR contains(lower(w.word), 'n''t') AS negates FROM words w LEFT JOIN rules r ON r.word = lower(w.word)),
s0 AS (SELECT *, {lags}, coalesce(lead(low) OVER p, '') AS following, value + CASE WHEN caps AND mixed THEN CASE WHEN value > 0 THEN {S.CAPITALS}::DOUBLE ELSE -{S.CAPITALS}::DOUBLE END ELSE 0 END AS x FROM tagged WINDOW p AS (PARTITION BY id, part ORDER BY place)),
s1 AS ({_step_sql(1, "s0")}), s2 AS ({_step_sql(2, "s1")}), s3 AS ({_step_sql(3, "s2")}),
s4 AS (SELECT id, part, emphasis, CASE WHEN value IS NULL OR boost IS NOT NULL OR low = 'kind' AND following = 'of' THEN 0 WHEN plain1 AND low1 = 'least' AND low2 NOT IN ('at', 'very') THEN x * {S.NEGATED}::DOUBLE ELSE x END * CASE WHEN but_at >= 0 AND place < but_at THEN 0.5::DOUBLE WHEN but_at >= 0 AND place > but_at THEN 1.5::DOUBLE ELSE 1 END AS x FROM s3),
sums AS (SELECT id, part, emphasis, sum(x) AS total, sum(CASE WHEN x > 0 THEN x + 1 ELSE 0 END) AS up, sum(CASE WHEN x < 0 THEN 1 - x ELSE 0 END) AS down, count_if(x = 0)::DOUBLE AS even FROM s4 GROUP BY ALL),
ends AS (SELECT id, part, total + sign(total) * emphasis AS total, up + CASE WHEN up > down THEN emphasis ELSE 0 END AS up, down + CASE WHEN up < down THEN emphasis ELSE 0 END AS down, even FROM sums),
by_id AS (SELECT id, coalesce(max(CASE WHEN part = 'h' THEN total / sqrt(total * total + {S.NORM}::DOUBLE) END), 0) AS headline_sentiment, coalesce(max(CASE WHEN part = 'd' THEN total / sqrt(total * total + {S.NORM}::DOUBLE) END), 0) AS description_sentiment, {share("up")} AS sentiment_positive, {share("down")} AS sentiment_negative, {share("even")} AS sentiment_neutral FROM ends GROUP BY id),
{name} AS (SELECT a.*, {", ".join(f"coalesce({c}, 0) AS {c}" for c in FIVE)} FROM {source} a LEFT JOIN by_id USING (id))"""


ORACLES = {
    "news_sentence_sentiment": f"WITH {ARTICLES_SQL}, {sentiment_sql('articles')} SELECT id, {', '.join(f'round({c}, 6) AS {c}' for c in FIVE)} FROM senti",
    "news_daily_sentiment": f"""WITH {ARTICLES_SQL}, {sentiment_sql('articles')}, a AS (SELECT ticker, date, description_sentiment AS c FROM senti)
SELECT ticker, date + 1 AS date, round(avg(c), 6) AS news_sentiment_mean, round(median(c), 6) AS news_sentiment_median, round(coalesce(stddev_samp(c), 0), 6) AS news_sentiment_std, round(min(c), 6) AS news_sentiment_min, round(max(c), 6) AS news_sentiment_max, count(*) AS news_news_count FROM a GROUP BY ticker, date""",
    "news_pipeline": f"""WITH {ARTICLES_SQL}, m AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, headline ORDER BY (id % 3 != 0)::INT, id) AS k FROM articles) WHERE k = 1), {sentiment_sql('m')}
SELECT ticker, date, round(avg(description_sentiment), 6) AS sentiment_mean, count(*) AS news_count, round(avg(embedding[1]::DOUBLE), 6) AS x0 FROM senti LEFT JOIN embeddings ON vec_id = id GROUP BY ticker, date""",
    "news_pooled": f"""WITH {ARTICLES_SQL}, w AS (SELECT id, list_filter(string_split(description, ' '), lambda x: x != '')[1:128] AS ws FROM articles), t AS (SELECT id, unnest(ws) AS word FROM w)
SELECT id, 0::BIGINT AS place, round(avg(length(word)), 6) AS x FROM t GROUP BY id UNION ALL SELECT id, 1, round(avg(length(word) - length(replace(word, 'e', ''))), 6) FROM t GROUP BY id""",
    "news_tfidf": rf"""WITH {ARTICLES_SQL}, words AS (SELECT id, list_filter(regexp_extract_all(lower(coalesce(headline, '') || ' ' || coalesce(description, '')), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda x: NOT list_contains([{", ".join(f"'{w}'" for w in sorted(N.STOP_WORDS))}], x)) AS w FROM articles),
terms AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words),
counts AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term), chosen AS (SELECT term, sum(tf) AS n, count(*) AS df FROM counts GROUP BY term ORDER BY n DESC, term LIMIT 100),
raw AS (SELECT id, term, tf * (ln((1 + (SELECT count(*) FROM articles))::DOUBLE / (1 + df)) + 1) AS x FROM counts JOIN chosen USING (term))
SELECT id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY id)), 6) AS weight FROM raw""",
}
