"""Rows from landed pages of known layouts: tables of trades, tables and cards of news."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.news import relative_date, table_date


class _Rows(HTMLParser):
    """Table rows inside one element: each cell's text, and its first link's text and address."""

    def __init__(self, inside: Callable[[str, dict], bool]):
        super().__init__()
        self.inside, self.depth, self.tag, self.rows, self.link = inside, 0, "", [], None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = dict(attrs)
        if self.depth:
            self.depth += tag == self.tag
        elif self.inside(tag, found):
            self.depth, self.tag = 1, tag
        if self.depth and tag == "tr":
            self.rows.append([])
        elif self.depth and self.rows and tag == "td":
            self.rows[-1].append({"text": "", "link": None, "href": None})
        elif self.depth and tag == "a" and self.rows and self.rows[-1] and self.rows[-1][-1]["link"] is None:
            self.rows[-1][-1].update(link="", href=found.get("href") or "")
            self.link = self.rows[-1][-1]

    def handle_endtag(self, tag: str) -> None:
        if self.depth and tag == self.tag:
            self.depth -= 1
        if tag == "a":
            self.link = None

    def handle_data(self, data: str) -> None:
        if self.depth and self.rows and self.rows[-1]:
            self.rows[-1][-1]["text"] += data
            if self.link is not None:
                self.link["link"] += data


class _Cards(HTMLParser):
    """News cards: author, title with address, and label of the date."""

    def __init__(self):
        super().__init__()
        self.cards, self.title = [], False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        found = dict(attrs)
        names = (found.get("class") or "").split()
        if "news-card" in names:
            self.cards.append({"source": found.get("data-author"), "headline": None, "url": "", "when": None})
        elif self.cards and tag == "a" and "title" in names and self.cards[-1]["headline"] is None:
            self.cards[-1].update(headline="", url=found.get("href") or "")
            self.title = True
        elif self.cards and tag == "span" and "aria-label" in found and self.cards[-1]["when"] is None:
            self.cards[-1]["when"] = found["aria-label"]

    def handle_endtag(self, tag: str) -> None:
        self.title = self.title and tag != "a"

    def handle_data(self, data: str) -> None:
        if self.title:
            self.cards[-1]["headline"] += data


def _extracted(pages: DataFrame, rows: Callable[[str], list[tuple]], names: list[str]) -> DataFrame:
    """ticker, page, place and text columns: what `rows` finds in each page's html, in its order."""
    kind = pages.schema["ticker"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents, places, found = [], [], []
            for i, html in enumerate(batch.column("html").to_pylist()):
                own = rows(html or "")
                parents += [i] * len(own)
                places += range(len(own))
                found += own
            at = pa.array(parents, pa.int32())
            columns = [pa.array([r[k] for r in found], pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("ticker").take(at), batch.column("url").take(at), pa.array(places, pa.int32()), *columns], names=["ticker", "page", "place", *names])

    return pages.select("ticker", "url", "html").mapInArrow(run, f"ticker {kind}, page string, place int, " + ", ".join(f"{n} string" for n in names))


def trade_rows(pages: DataFrame, start: str, end: str) -> DataFrame:
    """ticker, date and type of the trades in the tables of landed pages (ticker, url, html): the fourth and the seventh cell of rows with seven
    or more; rows without a date between the days go. Null pages have none; a page that lands twice counts twice."""

    def rows(html: str) -> list[tuple]:
        parser = _Rows(lambda tag, _: tag == "tbody")
        parser.feed(html)
        parser.close()
        return [(r[3]["text"].strip(), r[6]["text"].strip().lower()) for r in parser.rows if len(r) >= 7]

    found = _extracted(pages, rows, ["day", "type"])
    date = F.coalesce(*[F.try_to_date(F.col("day"), f) for f in ("yyyy-MM-dd", "M/d/yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy")])
    return found.select("ticker", date.alias("date"), "type").where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def table_articles(pages: DataFrame, as_of: str) -> DataFrame:
    """Article rows of the element with id news-table: dates like Mar-07-26 09:30AM, carried down to rows with a time alone; `as_of` before the first."""

    def rows(html: str) -> list[tuple]:
        parser = _Rows(lambda _, attrs: attrs.get("id") == "news-table")
        parser.feed(html)
        parser.close()
        return [(r[0]["text"].strip(), None if r[1]["link"] is None else r[1]["link"].strip(), r[1]["href"]) for r in parser.rows if len(r) >= 2]

    found = _extracted(pages, rows, ["cell", "headline", "url"])
    dated = F.size(F.split("cell", r"\s+")) == 2
    day = F.when(dated, F.coalesce(table_date(F.substring_index("cell", " ", 1)), F.lit(as_of).cast("date")))
    down = F.last(day, ignorenulls=True).over(Window.partitionBy("ticker", "page").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn("date", F.coalesce(down, F.lit(as_of).cast("date"))).where("headline is not null")
    return found.select("date", "ticker", "headline", F.col("headline").alias("description"), F.lit("table").alias("source"), "url", "page", "place")


def card_articles(pages: DataFrame, as_of: str) -> DataFrame:
    """Article rows of elements of class news-card, of a repeated headline of a ticker the first by page and place."""

    def rows(html: str) -> list[tuple]:
        parser = _Cards()
        parser.feed(html)
        parser.close()
        return [(c["headline"].strip(), c["source"], c["url"], c["when"]) for c in parser.cards if c["headline"] is not None]

    found = _extracted(pages, rows, ["headline", "source", "url", "when"])
    first = F.row_number().over(Window.partitionBy("ticker", "headline").orderBy("page", "place"))
    found = found.withColumn("__n", first).where("__n = 1")
    return found.select(relative_date(F.coalesce("when", F.lit("")), as_of).alias("date"), "ticker", "headline", F.col("headline").alias("description"), F.coalesce("source", F.lit("cards")).alias("source"), "url", "page", "place")
