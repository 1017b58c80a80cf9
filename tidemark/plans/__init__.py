"""Registered queries with their SQL."""

from tidemark.plans import bars, events, landed, macro, models, news

QUERIES = {**bars.QUERIES, **events.QUERIES, **macro.QUERIES, **models.QUERIES, **landed.QUERIES, **news.QUERIES}
ORACLES = {**bars.ORACLES, **events.ORACLES, **macro.ORACLES, **landed.ORACLES, **news.ORACLES}
