"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask looks at seven of ten consecutive tokens and ignores three, so a substituted token inside the
window need not spoil the hash; between them the masks ignore place 5 of places 0 to 9 twice and every other inner place once.
Every place of an item has seeds. Hits of equal hashes are verified around the seed: of some 30 consecutive item
tokens that hold its window (or the whole of a shorter item), at least 80 % must stand at the same distances in
the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

MASKS = ("1101101011", "1110010111", "1011101101")
SPAN = 10
#: Seeds that are broadcast at most with their tokens, up to 50 hashes each; of more only the hashes are, KEYS times as many at a time.
MOST_SEEDS, KEYS = 100_000, 10
#: Contaminated documents and names of passages that are broadcast at most; more are joined.
MOST_BROADCAST = 500_000


def tokens(text: Column) -> Column:
    """Hashes of the letter-and-digit runs of a text, lower-cased."""
    runs = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    return F.transform(runs, lambda w: F.xxhash64(w))


def _places(words: Column) -> Column:
    """First places of whole windows; null if there are none."""
    return F.when(F.size(words) >= SPAN, F.sequence(F.lit(0), F.size(words) - SPAN))


def _ends(words: Column, i: Column) -> Column:
    """Hash of the two tokens that all masks look at."""
    return F.xxhash64(F.get(words, i), F.get(words, i + SPAN - 1))


def _seeds(words: Column, i: Column) -> Column:
    return F.array(*[F.xxhash64(F.lit(m), *[F.get(words, i + k) for k in range(SPAN) if mask[k] == "1"]) for m, mask in enumerate(MASKS)])


def benchmark_passages(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item_id, passage (hash of the item's tokens) and w (the tokens) of each item that is long enough for a seed."""
    items = benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(text_col)).alias("w")).where(F.size("w") >= SPAN)
    return items.select("item_id", F.xxhash64("w").alias("passage"), "w")


def benchmark_seeds(items: DataFrame, region: int) -> DataFrame:
    """ends, seed, passage, place of the seed's window relative to the tokens around it, and those tokens.

    All regions of `region` tokens that hold the window lie in those tokens. Items of the same tokens are one passage."""
    at = items.dropDuplicates(["passage"]).select("passage", "w", F.explode(_places(F.col("w"))).alias("j"))
    first = F.greatest(F.lit(0), F.col("j") + SPAN - region)
    at = at.select("passage", "w", "j", first.alias("s"), (F.least(F.size("w"), F.col("j") + max(region, SPAN)) - first).alias("n"))
    return at.select("passage", (F.col("j") - F.col("s")).alias("at"), F.slice("w", F.col("s") + 1, F.col("n")).alias("region"), _ends(F.col("w"), F.col("j")).alias("ends"), F.explode(_seeds(F.col("w"), F.col("j"))).alias("seed"))


def _best(same: Column, width: Column) -> Column:
    """Most ones in `width` consecutive places of an array of ones and zeros."""
    first = F.aggregate(F.slice(same, F.lit(1), width), F.lit(0), lambda a, x: a + x)
    steps = F.when(F.size(same) > width, F.sequence(F.lit(0), F.size(same) - width - 1)).otherwise(F.array().cast("array<int>"))
    moved = lambda a, i: a["now"] + F.get(same, i + width) - F.get(same, i)
    return F.aggregate(steps, F.struct(first.alias("now"), first.alias("best")), lambda a, i: F.struct(moved(a, i).alias("now"), F.greatest(a["best"], moved(a, i)).alias("best")), lambda a: a["best"])


def _few(df: DataFrame, most: int) -> DataFrame:
    """`df`, computed once, to be broadcast if it has few rows."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= most else df


def _near(docs: DataFrame, ends: DataFrame, region: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, near (the tokens around a place), i (the place among them) and seed, for all places with one of these ends."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"), tokens(F.col(text_col)).alias("w"))
    at = rows.select("doc_id", "text_hash", "w", F.explode(_places(F.col("w"))).alias("i")).withColumn("ends", _ends(F.col("w"), F.col("i")))
    at = at.join(F.broadcast(ends.distinct()), "ends", "left_semi")
    reach = max(region, SPAN)
    first = F.greatest(F.lit(0), F.col("i") + SPAN - reach)
    at = at.select("doc_id", "text_hash", F.slice("w", first + 1, F.lit(2 * reach)).alias("near"), (F.col("i") - first).alias("i"))
    return at.select("doc_id", "text_hash", "near", "i", F.explode(_seeds(F.col("near"), F.col("i"))).alias("seed"))


def matches(docs: DataFrame, items: DataFrame, share: float, region: int, id_col: str, text_col: str, most_seeds: int) -> DataFrame:
    """Columns doc_id, text_hash, passage and matched of the texts that hold a passage of `items` (see `benchmark_passages`).

    What is broadcast is bounded, and only one block at a time: up to `most_seeds` seeds with their tokens; of more only the
    hashes, and the places that have one of those meet the tokens in a join."""
    seeds = checkpointed(benchmark_seeds(items, region))
    if seeds.count() <= most_seeds:
        hits = _near(docs, seeds.select("ends"), region, id_col, text_col).join(F.broadcast(seeds.drop("ends")), "seed")
    else:
        keys = checkpointed(seeds.select("seed", "ends").distinct())
        blocks, places = -(-keys.count() // (KEYS * most_seeds)), None
        for b in range(blocks):
            block = keys.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b)
            found = _near(docs, block.select("ends"), region, id_col, text_col).join(F.broadcast(block.select("seed").distinct()), "seed", "left_semi")
            if blocks > 1:
                found = checkpointed(found)
            places = found if places is None else places.union(found)
        hits = places.join(seeds.drop("ends"), "seed")
    base = F.col("i") - F.col("at")
    same = F.transform(F.sequence(F.lit(0), F.size("region") - 1), lambda k: F.when(F.get("near", base + k) == F.get("region", k), 1).otherwise(0))
    # A projection of its own, so the array is made once and not in every step over it.
    hits = hits.select("doc_id", "text_hash", "passage", F.explode(F.array(same)).alias("same"))
    width = F.least(F.lit(region), F.size("same"))
    hits = hits.select("doc_id", "text_hash", "passage", (_best(F.col("same"), width) / width).alias("matched")).where(F.col("matched") >= share)
    return hits.groupBy("doc_id", "text_hash", "passage").agg(F.max("matched").alias("matched"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.8, region: int = 30, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_seeds: int = MOST_SEEDS
) -> DataFrame:
    """Columns doc_id, text_hash, item_id and matched (the best share of region tokens found): the documents that hold a passage of the benchmark.

    Each pair of a text and an item once, however often rows or passages repeat. Null and empty texts, and
    items of fewer than ten tokens, match nothing; null ids come out as null. Items of the same tokens are looked for once,
    and what the executors hold of the benchmark is bounded (see `matches`)."""
    items = benchmark_passages(benchmark, item_col, item_text_col)
    found = matches(docs, items, share, region, id_col, text_col, most_seeds)
    names = _few(items.select("passage", "item_id").distinct(), MOST_BROADCAST)
    return found.join(names, "passage").groupBy("doc_id", "text_hash", "item_id").agg(F.max("matched").alias("matched"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.8, region: int = 30, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_seeds: int = MOST_SEEDS, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """The rows of `docs` whose texts hold no benchmark passage; see `contaminated`. Texts are shuffled only if more than `most_broadcast` are to go."""
    found = matches(docs, benchmark_passages(benchmark, item_col, item_text_col), share, region, id_col, text_col, most_seeds)
    found = _few(found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), most_broadcast)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col("__hash"))
    return docs.join(found, same, "left_anti")
