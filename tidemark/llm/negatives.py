"""Hard negatives: rows of another label whose score lies in a window below that of an anchor's positives.

Scores are products of int64 tiles of anchors and candidates, multiplied by Strassen's recursion with zero padding; its additions are exact
in integers. Two passes over the tiles: the first fills each anchor's heap of positives, the second, now that the
positives' scores are known, one heap for each window. Heaps hold a few best entries and merge, within a task and then in Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed
from tidemark.llm.tiles import integer_vectors, matrix, over_tiles, widened

#: Anchors and candidates of a tile, and the side at which blocks are multiplied plainly.
TILE_ANCHORS, TILE_ROWS, LEAF = 512, 2048, 32
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, with seven products of halves for eight; all sides are filled with zeros to whole halves.

    Additions wrap at 64 bits, so the result is exact wherever it fits, whatever the size of intermediate sums."""
    levels, least = 0, min(*a.shape, b.shape[1])
    while least > leaf:
        least, levels = -(-least // 2), levels + 1
    unit = 1 << levels
    padded = [np.pad(x, [(0, -side % unit) for side in x.shape]) for x in (a, b)]
    return _multiplied(*padded, levels)[: a.shape[0], : b.shape[1]]


def _multiplied(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _multiplied(a11 + a22, b11 + b22, levels - 1)
    p2 = _multiplied(a21 + a22, b11, levels - 1)
    p3 = _multiplied(a11, b12 - b22, levels - 1)
    p4 = _multiplied(a22, b21 - b11, levels - 1)
    p5 = _multiplied(a11 + a12, b22, levels - 1)
    p6 = _multiplied(a21 - a11, b11 + b12, levels - 1)
    p7 = _multiplied(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n], out[:m, n:] = p1 + p4 - p5 + p7, p3 + p5
    out[m:, :n], out[m:, n:] = p2 + p4, p1 - p2 + p3 + p6
    return out


class Heaps:
    """The k best (score, smaller id) entries of each of `n` owners; empty places hold NONE."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.full((n, k), NONE), np.full((n, k), NONE)

    def merge(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Takes the allowed entries of a matrix of scores, whose columns have these ids."""
        entries = np.where(allowed, scores, NONE)
        least = self.scores[:, -1]
        if entries.shape[1] > self.k:
            least = np.maximum(least, np.partition(entries, -self.k, axis=1)[:, -self.k])
        owner, column = np.nonzero(allowed & (entries >= least[:, None]))
        held = np.nonzero(self.ids != NONE)
        owner, score, own = (np.concatenate(x) for x in ((held[0], owner), (self.scores[held], entries[owner, column]), (self.ids[held], ids[column])))
        order = np.lexsort((own, -score, owner))
        owner, score, own = owner[order], score[order], own[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = place < self.k
        self.scores[:], self.ids[:] = NONE, NONE
        self.scores[owner[kept], place[kept]], self.ids[owner[kept], place[kept]] = score[kept], own[kept]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, id and score of all entries."""
        held = np.nonzero(self.ids != NONE)
        return held[0], self.ids[held], self.scores[held]


def _tiles(anchors: pa.Table, share: pa.Table):
    """For each tile: places of its anchors, ids and labels of its rows, and the scores."""
    a, b = widened(matrix(anchors["v"]), matrix(share["v"]))
    ids, labels = share["id"].to_numpy(), share["label"].to_numpy()
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(b), TILE_ROWS):
            yield np.arange(i, min(len(a), i + TILE_ANCHORS)), ids[j : j + TILE_ROWS], labels[j : j + TILE_ROWS], strassen(a[i : i + TILE_ANCHORS], b[j : j + TILE_ROWS].T)


def positives_of(anchors: pa.Table, share: pa.Table, most: int) -> pa.Table:
    """The best rows of a share with each anchor's label, the anchor left out."""
    own, label, heaps = anchors["id"].to_numpy(), anchors["label"].to_numpy(), Heaps(anchors.num_rows, most)
    for at, ids, labels, scores in _tiles(anchors, share):
        part = Heaps(len(at), most)
        part.scores, part.ids = heaps.scores[at], heaps.ids[at]
        part.merge(scores, ids, (label[at][:, None] == labels) & (own[at][:, None] != ids))
        heaps.scores[at], heaps.ids[at] = part.scores, part.ids
    owner, ids, scores = heaps.entries()
    return pa.table([own[owner], ids, scores], names=["anchor_id", "positive_id", "positive_score"])


def negatives_of(anchors: pa.Table, share: pa.Table, most: int, low: int, high: int) -> pa.Table:
    """The best rows of a share with another label, in the window of each positive of each anchor.

    `anchors` has a row for each positive (columns positive_id and positive_score); an anchor's scores are made once for all its rows."""
    anchors = anchors.sort_by([("id", "ascending"), ("positive_id", "ascending")])
    own, first, which = np.unique(anchors["id"].to_numpy(), return_index=True, return_inverse=True)
    label, positive, level = anchors["label"].to_numpy(), anchors["positive_id"].to_numpy(), anchors["positive_score"].to_numpy()
    top, bottom = np.array([high * int(x) // 100 for x in level]), np.array([-(-low * int(x) // 100) for x in level])
    heaps = Heaps(len(which), most)
    for at, ids, labels, scores in _tiles(anchors.take(first), share):
        rows = np.flatnonzero((which >= at[0]) & (which <= at[-1]))
        for start in range(0, len(rows), TILE_ANCHORS):
            of = rows[start : start + TILE_ANCHORS]
            near, part = scores[which[of] - at[0]], Heaps(len(of), most)
            part.scores, part.ids = heaps.scores[of], heaps.ids[of]
            part.merge(near, ids, (label[of][:, None] != labels) & (near >= bottom[of][:, None]) & (near <= top[of][:, None]))
            heaps.scores[of], heaps.ids[of] = part.scores, part.ids
    owner, ids, scores = heaps.entries()
    return pa.table([own[which[owner]], positive[owner], level[owner], ids, scores], names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def hard_negatives(df: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    For each anchor and each of its `positives` best other rows of its label: the `negatives` best rows of other labels whose score is
    `low` to `high` percent of the positive's. Components count as floor(scale * x); higher scores come first, ties by smaller id; fewer
    rows give fewer results, an empty table none. Rows with a null id, label or vector, or with null or non-finite components take no
    part; of rows of one id the least by vector, then label, counts; shorter vectors are filled with zeros. Other columns are
    ignored, whatever their names. A positive of negative score has an empty window. Raises ValueError where a score may pass 64 bits."""
    label = F.col("label") if label is None else label
    rows = integer_vectors(df.where(label.isNotNull()), scale, label.cast("bigint").alias("label"), is_anchor.alias("asked"), id_col=id_col, vector_col=vector_col)
    anchors, rows = rows.where("asked").drop("asked"), rows.drop("asked")
    found = over_tiles(anchors, rows, lambda a, b: positives_of(a, b, positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = checkpointed(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place"))
    # an anchor's rows share its block, as blocks are dealt by the id
    asked = anchors.join(best.withColumnRenamed("anchor_id", "id"), "id")
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    found = over_tiles(asked, rows, lambda a, b: negatives_of(a, b, negatives, low, high), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
