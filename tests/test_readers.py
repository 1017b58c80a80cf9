"""Readers of landed files against small files."""

import json

from tidemark.sources import readers as R
from tidemark.sources.store import Store


def test_readers(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "DGS10.csv").write_text("DATE,DGS10\n2024-01-01,.\n2024-01-02,4.5\n")
    assert [(str(r.date), r.series, r.value) for r in R.economic_series(spark, str(tmp_path / "s"), {"DGS10": "rate_10y"}).collect()] == [("2024-01-02", "rate_10y", 4.5)]
    (tmp_path / "shrt20240115.txt").write_text("Symbol Code|Current Short Position|Average Daily Volume|Days To Cover\nabc|1,200|600|2.0\nxyz|5|5|1\n")
    got = R.short_interest(spark, str(tmp_path / "shrt20240115.txt"), ["ABC"]).collect()
    assert [(r.ticker, str(r.date), r.short_interest, r.days_to_cover) for r in got] == [("ABC", "2024-01-15", 1200.0, 2.0)]
    (tmp_path / "t.json").write_text(json.dumps([{"symbol": "A", "publishedDate": "2024-01-02T03:04", "analystCompany": "f", "priceTarget": "12.5", "priceWhenPosted": 0}, {"symbol": "A", "publishedDate": "x", "priceTarget": "1"}]))
    assert [(r.ticker, r.target, r.posted) for r in R.price_targets(spark, str(tmp_path / "t.json")).collect()] == [("A", 12.5, None)]
    (tmp_path / "p.json").write_text(json.dumps({"items": [{"article": "A", "timestamp": "2024010200", "views": 7}]}))
    assert [(str(r.date), r.views) for r in R.pageviews(spark, str(tmp_path / "p.json")).collect()] == [("2024-01-02", 7)]
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>l</link><pubDate>d</pubDate></item></channel></rss>")
    assert [r.title for r in R.feed_items(spark, str(tmp_path / "f.xml")).collect()] == ["T"]


def test_store(spark, tmp_path):
    df = spark.sql("SELECT 'n' AS source, 'A' AS ticker, DATE '2024-01-02' AS date, 1 AS x UNION ALL SELECT 'n', 'B', DATE '2024-03-01', 2")
    store = Store(spark, str(tmp_path / "store"))
    store.merge(df)
    back = store.read("2024-01-01", "2024-12-31")
    assert back.count() == 2
    assert {r.ticker: str(r.fetch_from) for r in R.fetch_plan(back, "2024-03-05").collect()} == {"A": "2024-01-03", "B": "None"}


def test_feeds_take_the_first_of_each_file(spark, tmp_path):
    for f in "ab":
        items = "".join(f"<item><title>{f}{i}</title></item>" for i in range(3))
        (tmp_path / f"{f}.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    assert sorted(r.title for r in R.feed_items(spark, str(tmp_path), 2).collect()) == ["a0", "a1", "b0", "b1"]


def test_merged_prefers_the_new_side(spark):
    old = spark.createDataFrame([(1, "o"), (2, "o"), (2, "n")], "k int, x string")
    new = spark.createDataFrame([(1, "n", 5), (3, "n", 6)], "k int, x string, extra int")
    assert sorted((r.k, r.x, r.extra or 0) for r in R.merged(old, new, ["k"]).collect()) == [(1, "n", 5), (2, "n", 0), (3, "n", 6)]


def test_results_are_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for tickers in (["A", "B"], ["B", "A"], ["C"]):
        assert R.stored_result(spark, str(tmp_path), make, tickers=tickers, start="2024-01-01", vectors=None).count() == 3
    assert len(made) == 2
    R.write_csv(spark.range(2), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_landed_pages(spark):
    """Null pages have no rows; short rows, dateless trades and cards without a title go; dates are carried down within a page."""
    from tidemark.sources import landed_pages as L

    trade = lambda d, t: f"<tr><td>1</td><td>2</td><td>3</td><td> {d} </td><td>5</td><td>6</td><td>{t}</td></tr>"
    pages = [("A", "u", f"<table><tbody>{trade('2024-01-02', 'Purchase')}{trade('?', 'Sale')}<tr><td>x</td></tr></tbody></table>"), ("A", "v", None), ("B", "w", "")]
    df = spark.createDataFrame(pages, "ticker string, url string, html string")
    assert [(r.ticker, str(r.date), r.type) for r in L.trade_rows(df, "2024-01-01", "2024-12-31").collect()] == [("A", "2024-01-02", "purchase")]
    row = lambda d, h: f"<tr><td>{d}</td><td><a href='/{h}'>{h}</a></td></tr>"
    news = spark.createDataFrame([("A", "u", f"<table id=news-table>{row('09:00AM', 'zero')}{row('Mar-07-26 09:30AM', 'one')}{row('10:00AM', 'two')}<tr><td>x</td><td>none</td></tr></table>{row('1', 'out')}")], "ticker string, url string, html string")
    assert [(str(r.date), r.headline, r.url) for r in L.table_articles(news, "2026-04-01").orderBy("place").collect()] == [("2026-04-01", "zero", "/zero"), ("2026-03-07", "one", "/one"), ("2026-03-07", "two", "/two")]
    card = lambda h, w: f"<div class='x news-card'><a class='title' href='/{h}'>{h}</a><span aria-label='{w}'></span></div>"
    cards = spark.createDataFrame([("A", "u", card("h", "2 days ago") + card("h", "now") + "<div class=news-card><b>no</b></div>")], "ticker string, url string, html string")
    assert [(str(r.date), r.headline, r.source) for r in L.card_articles(cards, "2026-04-10").collect()] == [("2026-04-08", "h", "cards")]
