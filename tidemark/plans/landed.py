"""Queries over landed pages, files and stores, which Spark derives from the given tables and writes to the checkpoint folder, with their SQL."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.storage import checkpoint_folder
from tidemark.operators import evaluate as V
from tidemark.operators import events as E
from tidemark.operators import features as X
from tidemark.operators import news as N
from tidemark.plans import bars as PB
from tidemark.plans import events as PE
from tidemark.plans.bars import BARS_SQL
from tidemark.sources import landed_pages as L
from tidemark.sources import readers as R
from tidemark.sources.fixtures import ANALYST_SQL, ARTICLES_SQL, FUNDS, INSIDER_SQL, MACRO_SQL, ORDER_DAYS_SQL, articles, bars, days_of, fund_map, insider_rows, macro_series, order_days, table
from tidemark.sources.store import Store, land

QUERIES: dict = {}


def _spark(f):
    QUERIES[f.__name__] = f
    return f


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/landed-{uuid4().hex}"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the nation of their customer as ticker."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.select(F.col("n_name").alias("ticker"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("k"), "o_orderpriority", "o_orderstatus")


_ORDERS_SQL = "o AS (SELECT n_name AS ticker, o_orderdate::DATE AS day, o_orderkey AS k, o_orderpriority, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
AS_OF = "2002-01-01"


@_spark
def news_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Days of all orders, written in every form of date that news come in, and read back."""
    o, k = _orders(spark, sf), F.col("k")
    written = lambda form: F.date_format("day", form)
    feed = F.when(k % 5 == 0, F.concat(written("EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT"))).when(k % 5 == 1, F.concat(written("yyyy-MM-dd"), F.lit("T01:02:03Z"))).when(k % 5 == 2, F.concat(written("yyyy-MM-dd"), F.lit(" 23:59:59"))).when(k % 5 == 3, written("yyyy-MM-dd")).otherwise("soon")
    ago = F.when(k % 5 == 0, F.concat((k % 400).cast("string"), F.lit(" days ago"))).when(k % 5 == 1, F.concat((k % 23).cast("string"), F.lit(" hours ago"))).when(k % 5 == 2, written("d/M/yyyy")).when(k % 5 == 3, written("yyyy-MM-dd")).otherwise("lately")
    return o.select("k", N.feed_date(feed, AS_OF).alias("feed"), N.table_date(written("MMM-dd-yy")).alias("cell"), N.relative_date(ago, AS_OF).alias("card"))


@_spark
def landed_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Trades read back from one page an order, rolled up by day."""
    kind = F.when(F.col("o_orderstatus") == "F", "Purchase").when(F.col("o_orderstatus") == "O", "Sale (Full)").otherwise("Exchange")
    cells = [F.lit("a"), F.lit("<b>b</b>"), F.lit("c"), F.date_format("day", "yyyy-MM-dd"), F.lit("e"), F.lit("f"), kind, F.lit("&amp;")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    html = F.concat(F.lit("<p>x</p><table><tr><td>head</td></tr><tbody>"), row, F.lit("<tr><td>short</td></tr></tbody></table>"))
    pages = _orders(spark, sf).select("ticker", F.col("k").cast("string").alias("url"), html.alias("html"))
    out = E.congress_daily(L.trade_rows(pages, *order_days(spark, sf)))
    return out.select("ticker", "date", *[F.col(c).cast("bigint").alias(c) for c in ("congress_buys", "congress_sells", "congress_trade_count", "congress_net")])


@_spark
def landed_news_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two articles from the table of each order's page, the second dated by the first."""
    cell = lambda a, b: F.concat(F.lit("<tr><td> "), a, F.lit(" </td><td><a href='/"), b, F.lit("'>"), b, F.lit(" news</a></td></tr>"))
    rows = F.concat(cell(F.concat(F.date_format("day", "MMM-dd-yy"), F.lit(" 09:30AM")), F.col("o_orderpriority")), F.lit("<tr><td>11:00AM</td><td>no link</td></tr>"), cell(F.lit("10:00AM"), F.col("o_orderstatus")))
    html = F.concat(F.lit("<table><tr><td>1</td><td><a>other</a></td></tr></table><table id='news-table'>"), rows, F.lit("</table>"))
    pages = _orders(spark, sf).select("ticker", F.col("k").cast("string").alias("url"), html.alias("html"))
    return L.table_articles(pages, AS_OF).select("ticker", "date", "headline", "url", "page", F.col("place").cast("bigint").alias("place"))


@_spark
def landed_news_cards(spark: SparkSession, sf: str) -> DataFrame:
    """Articles from the cards of each order's page; a headline that a ticker has again is left out."""
    head = F.concat("o_orderpriority", F.lit(" "), (F.col("k") % 97).cast("string"))
    html = F.concat(F.lit("<div class='news-card wide' data-author='Paper'><a class='title' href='/x'><b>"), head, F.lit("</b></a><span aria-label='"), F.date_format("day", "d/M/yyyy"), F.lit("'>then</span></div><div class='news-card'><a href='/y'>none</a></div>"))
    pages = _orders(spark, sf).select("ticker", F.lpad(F.col("k").cast("string"), 12, "0").alias("url"), html.alias("html"))
    return L.card_articles(pages, AS_OF).select("ticker", "date", "headline", "source", "page")


@_spark
def landed_series(spark: SparkSession, sf: str) -> DataFrame:
    """Economic series written as one folder of CSV files each, gaps as dots, and read back under their names."""
    folder, rows = _folder(spark), macro_series(spark, sf)
    value = F.when(F.day("date") % 9 == 0, ".").otherwise(F.col("value").cast("string"))
    for s in PE.RS:
        R.write_csv(rows.where(F.col("series") == s).select("date", value.alias(s.upper())), f"{folder}/{s.upper()}.csv")
    found = R.economic_series(spark, f"{folder}/*", {s.upper(): f"rate_{s}" for s in PE.RS})
    return found.select("date", "series", F.round(F.col("value") + PB.HALF, 6).alias("value"))


@_spark
def landed_short_interest(spark: SparkSession, sf: str) -> DataFrame:
    """Short interest written as files of a bar-separated table by settlement day, and read back."""
    folder = _folder(spark)
    settled = F.date_format(F.last_day("date"), "yyyyMMdd")
    by_month = bars(spark, sf).groupBy("symbol", settled.alias("settled")).agg(F.sum("volume").alias("short"), F.count("*").alias("days"))
    number = lambda c: F.format_number(c, 0)
    rows = by_month.select(F.lower("symbol").alias("Symbol Code"), number("short").alias("Current Short Position"), number("days").alias("Average Daily Volume"), (F.col("short") / F.col("days")).cast("string").alias("Days To Cover"), "settled")
    rows.repartition("settled").write.partitionBy("settled").csv(folder, header=True, sep="|", quote="")
    found = R.short_interest(spark, folder)
    return found.select("ticker", "date", "short_interest", "average_volume", F.round("days_to_cover", 6).alias("days_to_cover"))


@_spark
def store_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Daily values of events in a store by source and ticker, merged with newer ones of the days after the 15th, read back by day."""
    rows = insider_rows(spark, sf).where("code is not null").groupBy(F.col("code").alias("source"), "ticker", "date").agg(F.round(F.sum("value"), 4).alias("value"))
    new = rows.where("day(date) > 15").withColumns({"value": F.lit(-1.0), "note": F.lit("new")})
    store = Store(spark, _folder(spark))
    for part in (rows, new):
        store.merge(part)
    return store.read(*days_of(table(spark, sf, "events"), "ts")).select("source", "ticker", "date", "value", "note")


@_spark
def store_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Daily values of events written as files in two landings, the second with corrections, streamed into the store and read back."""
    rows = insider_rows(spark, sf).where("code is not null").groupBy(F.col("code").alias("source"), "ticker", "date").agg(F.round(F.sum("value"), 4).alias("value"))
    folder = _folder(spark)
    store = Store(spark, f"{folder}/store")
    for part in (rows.where("day(date) <= 20"), rows.where("day(date) > 10").withColumn("value", F.col("value") + 1)):
        part.write.mode("append").option("header", True).csv(f"{folder}/incoming")
        land(spark, f"{folder}/incoming", store, f"{folder}/progress", "source string, ticker string, date date, value double", lambda x: x, header=True)
    return store.read().select("source", "ticker", "date", F.round("value", 4).alias("value"))


@_spark
def store_fetch_plan(spark: SparkSession, sf: str) -> DataFrame:
    """What is to be fetched for each source and ticker up to a week after the last event."""
    rows = insider_rows(spark, sf).where("code is not null").select(F.col("code").alias("source"), "ticker", "date")
    last = days_of(table(spark, sf, "events"), "ts")[1]
    return R.fetch_plan(rows, last, tolerance=0)


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    """Article titles of two in three tickers, some written in lower case."""
    n = table(spark, sf, "nation").where("n_nationkey % 3 != 0")
    ticker = F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    return n.select(ticker.alias("ticker"), F.concat(F.lit("Nation_No._"), F.col("n_nationkey").cast("string")).alias("title"))


@_spark
def landed_pageviews(spark: SparkSession, sf: str) -> DataFrame:
    """Views of each ticker's article by day, written as one JSON document an article, read back and told by ticker again, with their features."""
    folder, titles = _folder(spark), _titles(spark, sf)
    e = table(spark, sf, "events").where("event_type = 'view'").groupBy(F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("ticker"), F.to_date("ts").alias("day")).agg(F.count("*").alias("views"))
    rows = R.with_articles(e, titles)
    items = F.collect_list(F.struct("article", F.concat(F.date_format("day", "yyyyMMdd"), F.lit("00")).alias("timestamp"), "views"))  # a row a day
    docs = rows.groupBy("article").agg(F.to_json(F.struct(items.alias("items"))).alias("value")).withColumn("part", F.sha2("article", 256))
    docs.select("value", "part").repartition("part").write.partitionBy("part").text(folder)
    of_article = R.with_articles(table(spark, sf, "nation").select(F.col("n_name").alias("ticker")), titles)
    found = R.pageviews(spark, folder).join(F.broadcast(of_article), "article").select("ticker", "article", "date", "views")  # a row a nation
    return E.pageview_features(found).select("ticker", "article", "date", "views", F.round("pageviews_ma7", 6).alias("pageviews_ma7"), F.col("attention_spike").cast("bigint").alias("attention_spike"))


@_spark
def landed_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Price targets of orders, written as a JSON array for each ticker and quarter, and read back; some without a day, a price or a number."""
    folder, k = _folder(spark), F.col("k")
    o = _orders(spark, sf).withColumn("quarter", F.date_format("day", "yyyyQ"))
    day = F.when(k % 11 == 0, "soon").otherwise(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T10:00:00.000Z")))
    item = F.struct(F.col("ticker").alias("symbol"), day.alias("publishedDate"), F.concat("o_orderpriority", F.lit(" "), k.cast("string")).alias("analystCompany"), F.when(k % 13 == 0, "n/a").otherwise((k % 500).cast("string")).alias("priceTarget"), (k % 7).cast("double").alias("priceWhenPosted"), k.alias("note"))
    docs = o.groupBy("ticker", "quarter").agg(F.to_json(F.collect_list(item)).alias("value"))  # a quarter of one ticker
    docs.withColumn("part", F.concat("ticker", "quarter")).select("value", "part").repartition("part").write.partitionBy("part").text(folder)
    found = R.price_targets(spark, folder)
    return found.select("ticker", "date", "firm", "target", "posted")


@_spark
def landed_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """The first four items of a feed for each ticker and month, dated by the feed's form."""
    folder = _folder(spark)
    o = _orders(spark, sf).withColumn("month", F.date_format("day", "yyyy-MM"))
    text = F.concat(F.lit("<item><title>"), F.lpad(F.col("k").cast("string"), 12, "0"), F.lit(" &amp; more</title><description>"), F.col("o_orderpriority"), F.lit("</description><link>/x</link><pubDate>"), F.date_format("day", "EEE, dd MMM yyyy"), F.lit(" 08:00:00 GMT</pubDate></item>"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", text.alias("x")))), lambda i: i["x"]), "\n")  # a month of one ticker
    docs = o.groupBy("ticker", "month").agg(F.concat(F.lit("<rss><channel><title>News</title>\n"), items, F.lit("\n</channel></rss>")).alias("value"))
    docs.withColumn("part", F.concat("ticker", F.lit("_"), "month")).select("value", "part").repartition("part").write.partitionBy("part").text(folder)
    found = R.feed_items(spark, folder, most=4)
    return found.select(F.col("title").alias("headline"), "description", N.feed_date(F.col("pubDate"), AS_OF).alias("date"))


@_spark
def landed_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Grade changes with days as text and columns named as they land, between two days."""
    rows = PE.analyst_rows(spark, sf)
    day = F.when(F.col("id") % 9 == 0, "unknown").otherwise(F.col("date").cast("string"))
    landed = rows.select(F.col("id").alias("Id"), F.col("ticker").alias("Ticker"), day.alias("GradeDate"), F.col("to_grade").alias("ToGrade"), F.col("from_grade").alias("FromGrade"), F.col("action").alias("Action"))
    return E.grade_changes(landed, "1996-03-01", "2000-10-31").select("id", "ticker", "date", "to_grade", "from_grade", "action")


@_spark
def stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """Order counts by ticker and status kept under their parameters: made once, read the second time, and made anew for others."""
    folder = _folder(spark)
    make = lambda status: lambda: _orders(spark, sf).where(F.col("o_orderstatus").isin(status)).groupBy("ticker").agg(F.count("*").alias("n"))
    none = lambda: 1 / 0
    first = R.stored_result(spark, folder, make(["F"]), status=["F"], by="ticker")
    both = R.stored_result(spark, folder, make(["F", "O"]), status=["O", "F"], by="ticker")
    again = R.stored_result(spark, folder, none, by="ticker", status=["F", "O"])
    named = [df.withColumn("result", F.lit(x)) for x, df in (("first", first), ("both", both), ("again", again))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@_spark
def news_next_open(spark: SparkSession, sf: str) -> DataFrame:
    """Daily article counts moved to the next day on which orders were placed on a Monday, Wednesday or Thursday."""
    o = _orders(spark, sf)
    days = o.where("weekday(day) in (0, 2, 3)").select(F.col("day").alias("date"))
    counts = o.groupBy("ticker", F.col("day").alias("date")).agg(F.count("*").alias("count"))
    return N.lagged_news(counts, "trading", days)


@_spark
def insider_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions of each ticker's first fifty filings by arrival; undated ones have the filing's day."""
    e = table(spark, sf, "events").select((F.col("user_id") % 25).alias("ticker"), F.to_date("ts").alias("day"), F.col("event_id").alias("filing_id"), F.col("ts").alias("arrival"))
    rows = e.select("ticker", "filing_id", "arrival", F.col("day").alias("filing_date"), F.when(F.col("filing_id") % 3 != 0, F.date_sub("day", 1)).alias("date"))
    return E.latest_filings(rows, 50).select("ticker", "filing_id", "date")


@_spark
def cross_asset_closes(spark: SparkSession, sf: str) -> DataFrame:
    """Closes of two symbols as columns on business days."""
    out = E.closes_on_grid(bars(spark, sf), {"NATION_0": "btc_price", "NATION_1": "copper_price"}, *order_days(spark, sf))
    return out.select("date", *[F.round(c, PB.TICKS).alias(c) for c in ("btc_price", "copper_price")])


@_spark
def macro_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Curve slope, inversion and four regimes over the series on business days."""
    grid = E.series_on_grid(macro_series(spark, sf), PE.RS, *order_days(spark, sf))
    out = E.curve_and_regime(grid.select("date", F.col("r1").alias("treasury_10y"), F.col("r2").alias("treasury_2y"), (F.col("r3") / 10).alias("vix")))
    return out.select("date", F.round("yield_curve_slope", 9).alias("yield_curve_slope"), F.col("yield_curve_inverted").cast("bigint").alias("yield_curve_inverted"), "vix_regime")


@_spark
def event_table(spark: SparkSession, sf: str) -> DataFrame:
    """Features of all event sources on one grid of tickers and days."""
    macro = E.series_on_grid(macro_series(spark, sf), PE.RS, *order_days(spark, sf))
    sources = {
        "earnings": E.earnings_surprise(PE._earnings(spark, sf)),
        "revisions": E.revisions_daily(PE._revisions(spark, sf)),
        "targets": E.targets_daily(E.target_direction(PE.analyst_rows(spark, sf))),
        "macro": macro,
    }
    out = E.event_features(E.spine(PE._tickers(spark, sf), *order_days(spark, sf)), sources, ["r1", "r2"])
    counts = [*PE.EARNINGS_X, *_REVISION_X, "pt_mean", "pt_count", "pt_dispersion", "pt_momentum_60d"]
    kinds = dict(out.dtypes)
    return out.select(*PE.TD, *[F.round(c, 9 if c in _MACRO_X else 4).alias(c) if kinds[c] == "double" else F.col(c).cast("bigint").alias(c) for c in [*counts, *_MACRO_X]])


_REVISION_X = ["revision_upgrades_30d", "revision_downgrades_30d", "revision_net_30d", "revision_activity"]
_MACRO_X = ["r1", "r2", "r1_5d_change", "r2_5d_change"]


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    prices = bars(spark, sf).select("date", "symbol", "close")
    macro = E.series_on_grid(macro_series(spark, sf), PE.RS, *order_days(spark, sf)).select("date", "r1")
    daily = E.targets_daily(E.target_direction(PE.analyst_rows(spark, sf))).select("date", F.col("ticker").alias("symbol"), "pt_count")
    news = E.revisions_daily(PE._revisions(spark, sf)).select("date", F.col("ticker").alias("symbol"), "upgrades")
    return V.panel(prices, macro, daily, news, ["pt_count"])


@_spark
def model_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Prices with the macro, event and news columns of their day."""
    return _panel(spark, sf).select("symbol", "date", F.round("close", PB.TICKS).alias("close"), F.round("r1", 9).alias("r1"), F.col("pt_count").cast("bigint").alias("pt_count"), F.col("upgrades").cast("bigint").alias("upgrades"))


@_spark
def technical_table(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table with technical indicators only."""
    out = X.technical_table(bars(spark, sf), fund_map(spark, sf), FUNDS)
    return PB.rounded_table(out)


def _scorer():
    """A stand-in for a sentiment model: label and probability by the number of characters."""
    names = ("positive", "negative", "neutral")
    return lambda values: [(names[len(x) % 3], 0.5 + len(x) % 5 / 10) for x in values]


@_spark
def news_model_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Columns from a batch scorer over all headlines."""
    rows = articles(spark, sf).select("id", F.when(F.col("id") % 10 != 0, F.col("headline")).alias("headline"))
    return N.model_sentiment(rows, _scorer).select("id", "pos", "neg", "neu", "compound")


def _encoder():
    """A stand-in for a text encoder: characters, words, and spaces as a vector."""
    return lambda values: [[float(len(x)), float(x.count(" ")), float(x.count("e"))] for x in values]


@_spark
def news_embedded(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors from a batch encoder over all headlines, as rows."""
    found = N.embed(articles(spark, sf).select("id", "headline"), _encoder)
    return found.select("id", F.posexplode("embedding").alias("place", "x")).select("id", F.col("place").cast("bigint").alias("place"), F.col("x").cast("double").alias("x"))


@_spark
def forecast_significance(spark: SparkSession, sf: str) -> DataFrame:
    """Rank coefficient of the forecasts by symbol with its p-value, and whether it is below 5 %."""
    out = V.with_p_value(V.scores(PE.predictions(spark, sf), "symbol"))
    return out.select("symbol", "n", F.round("spearman", 6).alias("spearman"), F.round("p_value", 6).alias("p_value"))


@_spark
def forecast_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation importance of the terms of a plain forecast, with the family of each and its share of the total."""
    names = ["return_1lag", "return_7d_1lag", "vix_like", "news_like"]
    df = X.target(X.price_features(bars(spark, sf)), 5).withColumns({"vix_like": F.col("hl_spread_pct_1lag"), "news_like": F.col("gap_pct_1lag"), "actual": F.col("target")}).select("date", "symbol", "actual", *names).dropna()
    found = V.permutation_importance(df, names, lambda x: x.withColumn("prediction", 0.3 * F.col("return_1lag") - 0.2 * F.col("return_7d_1lag") + 0.1 * F.col("vix_like")), repeats=2)
    by_family = V.family_importance(found).withColumnsRenamed({"total": "family_total", "n": "family_size"})
    return found.withColumn("family", V.family(F.col("feature"))).join(by_family, "family").select("feature", "family", F.round("importance", 9).alias("importance"), F.round("family_total", 9).alias("family_total"), F.col("family_size").cast("bigint").alias("family_size"))


_CARRY = PE._CARRY
ORACLES = {
    "news_dates": f"""WITH {_ORDERS_SQL} SELECT k, CASE WHEN k % 5 < 4 THEN day ELSE DATE '{AS_OF}' END AS feed, day AS cell,
CASE k % 5 WHEN 0 THEN DATE '{AS_OF}' - (k % 400)::INT WHEN 2 THEN day WHEN 3 THEN day ELSE DATE '{AS_OF}' END AS card FROM o""",
    "landed_trades": f"WITH {_ORDERS_SQL} SELECT ticker, day AS date, count_if(o_orderstatus = 'F')::BIGINT AS congress_buys, count_if(o_orderstatus = 'O')::BIGINT AS congress_sells, count(*) AS congress_trade_count, (count_if(o_orderstatus = 'F') - count_if(o_orderstatus = 'O'))::BIGINT AS congress_net FROM o GROUP BY ALL",
    "landed_news_tables": f"""WITH {_ORDERS_SQL} SELECT ticker, day AS date, o_orderpriority || ' news' AS headline, '/' || o_orderpriority AS url, k::VARCHAR AS page, 0::BIGINT AS place FROM o
UNION ALL SELECT ticker, day, o_orderstatus || ' news', '/' || o_orderstatus, k::VARCHAR, 2::BIGINT FROM o""",
    "landed_news_cards": f"WITH {_ORDERS_SQL} SELECT ticker, date, headline, 'Paper' AS source, page FROM (SELECT *, row_number() OVER (PARTITION BY ticker, headline ORDER BY page) AS n FROM (SELECT ticker, day AS date, o_orderpriority || ' ' || (k % 97) AS headline, lpad(k::VARCHAR, 12, '0') AS page FROM o)) WHERE n = 1",
    "landed_series": f"WITH {MACRO_SQL} SELECT date, 'rate_' || series AS series, round(value + {PB.HALF}, 6) AS value FROM series WHERE day(date) % 9 != 0",
    "landed_short_interest": f"WITH {BARS_SQL}, m AS (SELECT symbol, last_day(date) AS date, sum(volume) AS short, count(*) AS days FROM bars GROUP BY ALL) SELECT symbol AS ticker, date, short AS short_interest, days::DOUBLE AS average_volume, round(short / days, 6) AS days_to_cover FROM m",
    "store_merge": f"WITH {INSIDER_SQL}, d AS (SELECT code AS source, ticker, date, round(sum(value), 4) AS value FROM insider WHERE code IS NOT NULL GROUP BY ALL) SELECT source, ticker, date, CASE WHEN day(date) > 15 THEN -1.0::DOUBLE ELSE value END AS value, CASE WHEN day(date) > 15 THEN 'new' END AS note FROM d",
    "store_landing": f"WITH {INSIDER_SQL}, d AS (SELECT code AS source, ticker, date, round(sum(value), 4) AS value FROM insider WHERE code IS NOT NULL GROUP BY ALL) SELECT source, ticker, date, round(value + (day(date) > 10)::INT, 4) AS value FROM d",
    "store_fetch_plan": f"WITH {INSIDER_SQL}, l AS (SELECT code AS source, ticker, max(date) AS latest FROM insider WHERE code IS NOT NULL GROUP BY ALL) SELECT source, ticker, latest, CASE WHEN latest < (SELECT max(ts)::DATE FROM events) THEN latest + 1 END AS fetch_from FROM l",
    "insider_filings": "SELECT ticker, filing_id, CASE WHEN filing_id % 3 != 0 THEN day - 1 ELSE day END AS date FROM (SELECT user_id % 25 AS ticker, event_id AS filing_id, ts::DATE AS day, dense_rank() OVER (PARTITION BY user_id % 25 ORDER BY ts, event_id) AS n FROM events) WHERE n <= 50",
    "cross_asset_closes": f"""WITH {BARS_SQL}, days AS (SELECT unnest(generate_series({ORDER_DAYS_SQL[0]}, {ORDER_DAYS_SQL[1]}, INTERVAL 1 DAY))::DATE AS date), w AS (SELECT date, max(close) FILTER (symbol = 'NATION_0') AS a, max(close) FILTER (symbol = 'NATION_1') AS b FROM bars GROUP BY date)
SELECT date, round({_CARRY("a", "")}, {PB.TICKS}) AS btc_price, round({_CARRY("b", "")}, {PB.TICKS}) AS copper_price FROM days LEFT JOIN w USING (date) WHERE isodow(date) < 6""",
    "macro_curve": f"""WITH {MACRO_SQL}, {PE._GRID} SELECT date, round(r1 - r2, 9) AS yield_curve_slope, coalesce(r1 - r2 < 0, false)::BIGINT AS yield_curve_inverted,
CASE WHEN r3 / 10 <= 0 THEN 'nan' WHEN r3 / 10 <= 15 THEN 'low_vol' WHEN r3 / 10 <= 20 THEN 'normal' WHEN r3 / 10 <= 30 THEN 'elevated' WHEN r3 / 10 <= 100 THEN 'crisis' ELSE 'nan' END AS vix_regime FROM macro""",
    "event_table": f"""WITH e AS ({PE.ORACLES["earnings_features"]}), v AS ({PE.ORACLES["revision_features"]}), t AS ({PE.ORACLES["target_features"]}), m AS ({PE.ORACLES["macro_join"]})
SELECT ticker, date, {", ".join(PE.EARNINGS_X)}, {", ".join(_REVISION_X)}, pt_mean, pt_count, pt_dispersion, pt_momentum_60d, {", ".join(_MACRO_X)} FROM e JOIN v USING (ticker, date) JOIN t USING (ticker, date) JOIN m USING (ticker, date)""",
    "model_panel": f"""WITH b AS (WITH {BARS_SQL} SELECT * FROM bars), m AS (WITH {MACRO_SQL}, {PE._GRID} SELECT date, r1 FROM macro), t AS ({PE.ORACLES["targets_daily"]}), v AS ({PE.ORACLES["revisions_daily"]})
SELECT symbol, b.date, round(close, {PB.TICKS}) AS close, round(r1, 9) AS r1, coalesce(pt_count, 0) AS pt_count, upgrades FROM b LEFT JOIN m ON b.date = m.date LEFT JOIN t ON b.date = t.date AND symbol = t.ticker LEFT JOIN v ON b.date = v.date AND symbol = v.ticker""",
    "news_model_sentiment": f"""WITH {ARTICLES_SQL}, t AS (SELECT id, CASE WHEN id % 10 = 0 OR trim(headline, ' ' || chr(9) || chr(13)) = '' OR headline IS NULL THEN 'no content' ELSE headline END AS h FROM articles), s AS (SELECT id, length(h) % 3 AS l, 0.5::DOUBLE + length(h) % 5 / 10::DOUBLE AS p FROM t)
SELECT id, round(CASE WHEN l = 0 THEN p ELSE 0 END, 4) AS pos, round(CASE WHEN l = 1 THEN p ELSE 0 END, 4) AS neg, round(CASE WHEN l = 2 THEN p ELSE 0 END, 4) AS neu, round(CASE WHEN l = 0 THEN p WHEN l = 1 THEN -p ELSE 0 END, 4) AS compound FROM s""",
    "news_embedded": f"WITH {ARTICLES_SQL}, h AS (SELECT id, coalesce(headline, '') AS h FROM articles) SELECT id, 0::BIGINT AS place, length(h)::DOUBLE AS x FROM h UNION ALL SELECT id, 1, (length(h) - length(replace(h, ' ', '')))::DOUBLE FROM h UNION ALL SELECT id, 2, (length(h) - length(replace(h, 'e', '')))::DOUBLE FROM h",
    "forecast_importance": f"""WITH {BARS_SQL}, {PB._PX1}, x AS (SELECT date, symbol, {", ".join(f"{PB._PX[c]} AS {c}" for c in ("return_1lag", "return_7d_1lag", "hl_spread_pct_1lag", "gap_pct_1lag"))}, lead(close, 5) OVER s / nullif(close, 0) - 1 AS actual FROM lags {PB.S}),
full_rows AS (SELECT *, row_number() OVER (ORDER BY date, symbol) - 1 AS n FROM x WHERE return_1lag IS NOT NULL AND return_7d_1lag IS NOT NULL AND hl_spread_pct_1lag IS NOT NULL AND gap_pct_1lag IS NOT NULL AND actual IS NOT NULL),
size AS (SELECT count(*) AS rows FROM full_rows), deals(j, prime) AS (VALUES {", ".join(f"({j}, {p}::BIGINT)" for j, p in enumerate(V.dealing_primes(8)))}),
steps AS (SELECT j, CASE WHEN rows % prime = 0 THEN {V.OTHER_STEP} ELSE prime END AS a, 7919 * (j + 1) AS b, rows FROM deals, size),
dealt AS (SELECT j, (a * n + b) % rows AS n, CASE j // 2 WHEN 0 THEN return_1lag WHEN 1 THEN return_7d_1lag WHEN 2 THEN hl_spread_pct_1lag ELSE gap_pct_1lag END AS v FROM full_rows, steps),
errors AS (SELECT j, sqrt(avg(pow(0.3::DOUBLE * CASE WHEN j // 2 = 0 THEN v ELSE return_1lag END - 0.2::DOUBLE * CASE WHEN j // 2 = 1 THEN v ELSE return_7d_1lag END + 0.1::DOUBLE * CASE WHEN j // 2 = 2 THEN v ELSE hl_spread_pct_1lag END - actual, 2))) AS r FROM full_rows JOIN dealt USING (n) GROUP BY j),
plain AS (SELECT sqrt(avg(pow(0.3::DOUBLE * return_1lag - 0.2::DOUBLE * return_7d_1lag + 0.1::DOUBLE * hl_spread_pct_1lag - actual, 2))) AS r FROM full_rows),
found AS (SELECT (['return_1lag', 'return_7d_1lag', 'vix_like', 'news_like'])[j // 2 + 1] AS feature, (['price/tech', 'price/tech', 'macro', 'news_sentiment'])[j // 2 + 1] AS family, avg(e.r - p.r) AS importance FROM errors e, plain p GROUP BY j // 2)
SELECT feature, family, round(importance, 9) AS importance, round(sum(importance) OVER (PARTITION BY family), 9) AS family_total, count(*) OVER (PARTITION BY family) AS family_size FROM found""",
    "landed_pageviews": """WITH t AS (SELECT n_name AS ticker, CASE WHEN n_nationkey % 3 != 0 THEN 'Nation_No._' || n_nationkey ELSE n_name || '_(company)' END AS article FROM nation),
v AS (SELECT 'NATION_' || (user_id % 25) AS ticker, ts::DATE AS date, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT ticker, article, date, views, round(avg(views) OVER (PARTITION BY ticker ORDER BY date ROWS 6 PRECEDING), 6) AS pageviews_ma7,
(views > avg(views) OVER m + 2 * coalesce(stddev_samp(views) OVER m, 0))::BIGINT AS attention_spike FROM v JOIN t USING (ticker) WINDOW m AS (PARTITION BY ticker ORDER BY date ROWS 29 PRECEDING)""",
    "landed_targets": f"WITH {_ORDERS_SQL} SELECT ticker, day AS date, o_orderpriority || ' ' || k AS firm, (k % 500)::DOUBLE AS target, nullif(k % 7, 0)::DOUBLE AS posted FROM o WHERE k % 11 != 0 AND k % 13 != 0",
    "landed_feeds": f"WITH {_ORDERS_SQL} SELECT lpad(k::VARCHAR, 12, '0') || ' & more' AS headline, o_orderpriority AS description, day AS date FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', day) ORDER BY k) AS n FROM o) WHERE n <= 4",
    "landed_grades": f"WITH {ANALYST_SQL} SELECT id, ticker, date, to_grade, from_grade, action FROM analyst WHERE id % 9 != 0 AND date BETWEEN DATE '1996-03-01' AND DATE '2000-10-31'",
    "stored_results": f"WITH {_ORDERS_SQL}, f AS (SELECT ticker, count(*) FILTER (o_orderstatus = 'F') AS one, count(*) FILTER (o_orderstatus IN ('F', 'O')) AS two FROM o GROUP BY ticker) SELECT ticker, one AS n, 'first' AS result FROM f WHERE one > 0 UNION ALL SELECT ticker, two, unnest(['both', 'again']) FROM f WHERE two > 0",
    "news_next_open": f"WITH {_ORDERS_SQL}, c AS (SELECT ticker, day, count(*) AS n FROM o GROUP BY ALL), d AS (SELECT DISTINCT day FROM o WHERE isodow(day) IN (1, 3, 4)), nexts AS (SELECT c.day, min(d.day) AS date FROM (SELECT DISTINCT day FROM c) c JOIN d ON d.day > c.day GROUP BY c.day) SELECT ticker, date, n AS news_count FROM c JOIN nexts USING (day)",
}
