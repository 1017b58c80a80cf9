"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, tasks_for


def _star(edges: DataFrame, tasks: int) -> DataFrame:
    """Each edge (u, v) becomes (v, least neighbour of u, or u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).coalesce(tasks)
    return edges.join(least, "u").coalesce(tasks)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Columns node and root (the least node reachable), for every node of `edges` (columns u, v).

    Grouping takes minima only, so a hub is never gathered in one task; each round is written to the
    checkpoint folder, which also holds when executors are lost. Tasks follow the number of edges. Null ends are ignored; no
    edges give no rows. Loops and repeated edges do no harm."""
    edges = edges.select("u", "v").where("u != v")
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    tasks = tasks_for(edges.count())
    edges = edges.coalesce(tasks)
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        large = _star(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        star = _star(large, tasks)
        small = star.select(F.col("v").alias("u"), F.col("m").alias("v")).union(star.select("u", F.col("m").alias("v"))).where("u != v")
        edges = checkpointed(small.coalesce(tasks).distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
