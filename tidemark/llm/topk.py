"""Exact search of the highest inner products by aggregation of sorted lists without random access.

Every dimension of a slab of rows is a list sorted by its component. The queries of a block read all lists in step, each query from
the end that favours it, so what has been read is the same for all of them. It bounds each row's score for a query from below (unread
components at the list's worst value) and from above (unread ones at the value the list has reached). A query stops once few rows
are left whose upper bound reaches its k-th best lower bound, which slabs hand on; only these rows' scores are then made
exact, in integers. Bounds are floating-point sums with a margin over their error, so no row is lost to rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tiles import integer_vectors, matrix, over_tiles, widened

#: Rows whose lists are sorted together, queries that read them together, steps of reading, and open rows for each wanted one at which a query stops.
SLAB, BATCH, STEPS, FEW = 8192, 256, 8, 4


class Lists:
    """A slab of rows with the sorted list of each dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, 0).astype(float)

    def depths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Reads the lists on, step by step: entries read of each, what is read of every row from the upper and from the lower
        end (side by side), and ones where nothing is."""
        n, d = self.values.shape
        read, unread, dims = np.zeros((n, 2 * d)), np.ones((n, 2 * d)), np.arange(d)
        step, at = max(1, -(-n // STEPS)), 0
        while at < n:
            to = min(n, at + step)
            for part, side in ((slice(n - to, n - at), 0), (slice(at, to), d)):
                places, columns = self.order[part], dims + side
                read[places, columns], unread[places, columns] = self.sorted[part], 0
            yield to, read, unread
            at = to

    def open_rows(self, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, int]]:
        """For each query, as it stops: its place, those of all rows that may reach its k best or its floor, whichever is higher,
        and the entries that it read of each list."""
        n, d = self.values.shape
        weight = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], 1).astype(float)
        least, most = np.concatenate([self.sorted[0], self.sorted[-1]]), np.concatenate([self.sorted[-1], self.sorted[0]])
        slack = 1e-9 * (1 + np.abs(weight) @ np.maximum(np.abs(least), np.abs(most)))
        worst, going, floor = weight * least, np.arange(len(queries)), floor.copy()
        for at, read, unread in self.depths():
            reached = weight[going] * (np.concatenate([self.sorted[n - at - 1], self.sorted[at]]) if at < n else 0)
            # while a row of which nothing is read can qualify, no query can stop
            due = (reached.sum(1) < floor[going]) | np.isneginf(floor[going]) | (at == n)
            now, reached = going[due], reached[due]
            if not len(now):
                continue
            known = weight[now] @ read.T
            if n >= k:
                lower = known + worst[now] @ unread.T
                floor[now] = np.maximum(floor[now], np.partition(lower, n - k, axis=1)[:, n - k] - slack[now])
            able = known + reached @ unread.T >= (floor[now] - slack[now])[:, None]
            stops = able.sum(1) <= FEW * k if at < n else np.ones(len(now), bool)
            for i in np.flatnonzero(stops):
                yield now[i], np.flatnonzero(able[i]), at
            going = np.setdiff1d(going, now[stops], assume_unique=True)
            if not len(going):
                break


def best_of(slabs: list[Lists], query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids and exact scores: the k best rows of all slabs but each query's own, ties to the smaller id."""
    ids, scores = [np.zeros(0, np.int64)] * len(queries), [np.zeros(0, np.int64)] * len(queries)
    for slab in slabs:
        floor = np.array([float(s[-1]) if len(s) == k else -np.inf for s in scores])
        for q, places, _ in slab.open_rows(queries, floor, k + 1):  # one more, as the query's own row may be among the best
            places = places[slab.ids[places] != query_ids[q]]
            own, score = np.concatenate([ids[q], slab.ids[places]]), np.concatenate([scores[q], slab.values[places] @ queries[q]])
            kept = np.lexsort((own, -score))[:k]
            ids[q], scores[q] = own[kept], score[kept]
    return np.repeat(query_ids, [len(x) for x in ids]), np.concatenate([*ids, np.zeros(0, np.int64)]), np.concatenate([*scores, np.zeros(0, np.int64)])


def exact_top_k(df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query row among all other rows.

    Components count as floor(scale * x). Ties go to the smaller id; fewer rows give fewer results, an empty table none. Rows
    with a null id, a null vector, or null or non-finite components take no part; of rows of one id the least vector counts;
    shorter vectors are filled with zeros, so an empty one scores 0. Other columns are ignored, whatever their names. Raises
    ValueError where a score may pass 64 bits."""
    rows = integer_vectors(df, scale, is_query.alias("asked"), id_col=id_col, vector_col=vector_col)

    def search(queries: pa.Table, share: pa.Table) -> pa.Table:
        wanted, values = widened(matrix(queries["v"]), matrix(share["v"]))
        asked, ids = queries["id"].to_numpy(), share["id"].to_numpy()
        slabs = [Lists(ids[i : i + SLAB], values[i : i + SLAB]) for i in range(0, len(ids), SLAB)]
        out = [best_of(slabs, asked[i : i + BATCH], wanted[i : i + BATCH], k) for i in range(0, len(asked), BATCH)]
        columns = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in zip(*out)] or [np.zeros(0, np.int64)] * 3
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    found = over_tiles(rows.where("asked").select("id", "v"), rows.select("id", "v"), search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
