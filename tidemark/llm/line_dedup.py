"""Boilerplate lines by site-relative frequency, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

#: Boilerplate lines that are broadcast at most; more go by joins on their keys.
MOST_BROADCAST = 100_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    """A trimmed line's key of 96 bits; blank lines have none."""
    line = F.trim(line)
    return F.when(line != "", F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b")))


def boilerplate_lines(docs: DataFrame, ratio: float, least_pages: int, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Columns host and key of the lines that stand on more than `ratio` of their host's pages, `least_pages` at least.

    A page counts a line once. Pages are counted before the shuffle, so one host or one line with a large
    part of all rows is a sum of partial counts."""
    pages = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), _line_key), lambda k: k.isNotNull()))
    counts = pages.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    same = F.col("c.host").eqNullSafe(F.col("t.host"))
    return counts.alias("c").join(totals.alias("t"), same).where(F.col("n") > F.col("pages") * ratio).select("c.host", "key")


def line_dedup(docs: DataFrame, ratio: float = 0.05, least_pages: int = 5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rows of `docs` without boilerplate lines, with columns n_lines and n_removed added (bigint).

    A line is what stands between newlines; two are equal if they are after trimming spaces; blank lines
    stay. Every row stays, one whose lines all go with an empty text; a null text stays null with no lines. A null
    host is a host of its own. Repeated rows are pages of their own. Columns of `docs` named n_lines or n_removed are replaced."""
    flagged = checkpointed(boilerplate_lines(docs, ratio, least_pages, host_col, text_col))
    by_host = flagged.groupBy(F.coalesce("host", F.lit("")).alias("__host"), F.col("host").isNull().alias("__none")).agg(F.collect_list("key").alias("__drop"))
    if flagged.count() <= most_broadcast:
        by_host = F.broadcast(by_host)
    own_host = F.col(host_col).cast("string")
    joined = docs.join(by_host, (F.coalesce(own_host, F.lit("")) == F.col("__host")) & (own_host.isNull() == F.col("__none")), "left")
    lines = _lines(F.col(text_col))
    kept = F.when(F.col("__drop").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.coalesce(F.array_contains("__drop", _line_key(x)), F.lit(False))))
    out = joined.withColumn("__kept", kept).withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("bigint"))
    out = out.withColumn("n_lines", F.when(F.col(text_col).isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_lines")))
    out = out.withColumn("n_removed", F.when(F.col(text_col).isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_lines") - F.size("__kept")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*[F.array_join("__kept", "\n").alias(c) if c == text_col else F.col(c) for c in names], "n_lines", "n_removed")
