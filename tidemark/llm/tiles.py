"""Stated query rows against all rows, in tiles: each block of queries meets each share of the rows once, in a group of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

#: Query rows of a block, and rows of a share, about; both are dealt by the hash of a unique id.
BLOCK, SHARE = 4096, 65536
#: Shares at least, so that small tables keep many tasks busy, and rows that are worth a share of their own.
LEAST_SHARES, WORTH = 32, 1024


def integer_vectors(df: DataFrame, scale: int, *keep: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns id, v (each component floor(scale * x), x as double) and those to keep, one row an id.

    Rows with a null id, a null vector, or a null or non-finite component are left out. Of several rows of one id the least by
    (v, kept columns) stands for all. Raises ValueError where an inner product may pass 64 bits."""
    x = f"transform({vector_col}, x -> cast(x as double))"
    whole = df.select(F.col(id_col).cast("bigint").alias("id"), F.expr(x).alias("x"), *keep).where(
        "id is not null and x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))"
    )
    most = whole.agg(F.max(F.size("x")).alias("n"), F.max(F.expr(f"array_max(transform(x, c -> abs({scale} * c)))")).alias("m")).first()
    if most["m"] is not None and most["n"] * (most["m"] + 1) ** 2 >= 2.0**62:
        raise ValueError(f"inner products of {most['n']} components up to {most['m']:.3g} may pass 64 bits")
    scaled = whole.withColumn("v", F.expr(f"transform(x, c -> cast(floor({scale} * c) as bigint))")).drop("x")
    rest = [c for c in scaled.columns if c not in ("id", "v")]
    return checkpointed(scaled.groupBy("id").agg(F.min(F.struct("v", *rest)).alias("row")).select("id", "row.*"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of integers as rows of a matrix, shorter ones filled with zeros."""
    lists = pa.concat_arrays(column.chunks)
    ends = lists.offsets.to_numpy()
    sizes, flat = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    out = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with as many columns, zeros added."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def over_tiles(queries: DataFrame, rows: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`function` of each block of `queries` with each share of `rows`, both dealt by `id`, which few rows have in common.

    Queries are copied to every share and rows to every block, so a pair of rows meets in one group only, and a group holds about
    BLOCK queries and SHARE rows, whatever the size of the tables."""
    n_rows, n_queries = rows.count(), queries.count()
    shares = max(-(-n_rows // SHARE), min(LEAST_SHARES, -(-n_rows // WORTH)), 1)
    blocks = max(-(-n_queries // BLOCK), 1)
    left = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks))).withColumn("share", F.explode(F.expr(f"sequence(0L, {shares - 1}L)")))
    right = rows.withColumn("share", F.pmod(F.xxhash64("id", F.lit("share")), F.lit(shares))).withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    left = left.toDF(*left.columns)  # both sides may come from one table
    return left.groupBy("block", "share").cogroup(right.groupBy("block", "share")).applyInArrow(function, schema)
