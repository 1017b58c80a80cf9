"""SimHash near-duplicates, with candidates pruned by pigeonring chains.

A fingerprint has eight segments of eight bits on a ring. If two fingerprints differ in at most t bits, then
some segment starts a chain whose first l segments together differ in at most l * t / 8 bits, for every l.
For t = 3 its first two segments agree and at most one bit differs in the first five, so two of the other three
agree as well: four whole segments, 32 bits, are an equality key, in 8 starts x 3 choices. Nothing within
the distance is missed. Pairs that share a key must show such a chain before the full Hamming check.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, map_arrow, texts
from tidemark.llm.graph import components

SEGMENTS, WIDTH = 8, 8


def simhash_values(values: list[str], shingle: int) -> np.ndarray:
    """64-bit fingerprints of texts: a bit is set where over half of the shingles' hashes have it."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = []
    for value in values:
        words = value.encode().lower().split()
        if len(words) > shingle:
            own = [digest(b" ".join(x), 42) for x in zip(*(words[i:] for i in range(shingle)))]
        else:
            own = [digest(b" ".join(words), 42)] if words else []
        counts.append(len(own))
        hashes += own
    n = np.array(counts)
    out = np.zeros(len(values), np.uint64)
    if hashes:
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        full = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[full] = np.packbits(ones * 2 > n[full, None], axis=1).view(">u8").ravel()
    return out


def simhash_fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, text_hash and fp bigint: the fingerprint of the text's word shingles, A-Z lower-cased.

    A row for each row of `docs`; a text without words has fingerprint 0, one of fewer words than a
    shingle is a single shingle. Texts of any length count whole."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column("doc_id"), batch.column("text_hash"), pa.array(simhash_values(batch.column("text").to_pylist(), shingle).view(np.int64))]

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn("text_hash", F.xxhash64("text"))
    return map_arrow(rows, run, f"doc_id {kind}, text_hash bigint, fp bigint")


def _mask(segments: list[int]) -> int:
    m = sum((1 << WIDTH) - 1 << WIDTH * (s % SEGMENTS) for s in segments)
    return m - (1 << 64) if m >> 63 else m


def chain_keys(fp: Column) -> Column:
    """The equality keys of a fingerprint, numbered: two segments, and two of the three after them."""
    keys = []
    for i in range(SEGMENTS):
        for pair in ((2, 3), (2, 4), (3, 4)):
            segments = [i, i + 1, i + pair[0], i + pair[1]]
            keys.append(F.struct(F.lit(len(keys)).alias("table"), fp.bitwiseAND(F.lit(_mask(segments))).alias("key")))
    return F.array(*keys)


def has_chain(difference: Column, distance: int) -> Column:
    """True where some start keeps within the proportional budget for every length of its chain."""
    starts = []
    for i in range(SEGMENTS):
        within = [F.bit_count(difference.bitwiseAND(F.lit(_mask(list(range(i, i + n)))))) <= n * distance // SEGMENTS for n in range(1, SEGMENTS + 1)]
        starts.append(reduce(Column.__and__, within))
    return reduce(Column.__or__, starts)


def simhash_links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (u, v) of different fingerprints (column fp, distinct) that differ in at most `distance` bits, at most 3.

    Every such pair comes out once. Copies of one fingerprint are one row here, so a group of copies costs
    nothing; buckets hold only different fingerprints that agree in 32 bits, and the join splits large ones."""
    if not 0 <= distance <= 3:
        raise ValueError("keys are complete up to a distance of 3")
    keyed = fps.select("fp", F.explode(chain_keys(F.col("fp"))).alias("k")).select("fp", "k.table", "k.key")
    other = keyed.select(F.col("fp").alias("v"), "table", "key")
    pairs = keyed.withColumnRenamed("fp", "u").join(other, ["table", "key"]).where("u < v")
    difference = F.col("u").bitwiseXOR(F.col("v"))
    return pairs.where(has_chain(difference, distance)).where(F.bit_count(difference) <= distance).select("u", "v").distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, text_hash, fp and component_id, the smallest id reachable over links between fingerprints.

    One row for each row of `docs`. Null ids never name a component while another id is there; a
    component of null ids only has a null one. An empty table gives no rows."""
    rows = checkpointed(simhash_fingerprints(docs, shingle, id_col, text_col))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    return named_components(rows, distinct, simhash_links(distinct, distance))


def named_components(rows: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    """`rows` (doc_id, text_hash, fp) with component_id; `distinct` has each fp's first id and number of copies."""
    roots = components(links).withColumnsRenamed({"node": "fp"})
    known = distinct.join(roots, "fp", "left")
    least = known.where("root is not null").groupBy("root").agg(F.min("first").alias("of_root"))
    named = known.where("root is not null or copies > 1").join(least, "root", "left").select("fp", F.coalesce("of_root", "first").alias("component"))
    return rows.join(named, "fp", "left").select("doc_id", "text_hash", "fp", F.coalesce("component", "doc_id").alias("component_id"))


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` of one document of each component, the one of the smallest id; all columns kept.

    Rows of the same id and text are one document and stay together. A component of null ids only keeps
    the text of the smallest hash."""
    return keep_first(docs, simhash_components(docs, shingle, distance, id_col, text_col), id_col, text_col)


def keep_first(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` of the first document of each component of `found` (doc_id, text_hash, fp, component_id)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    group = ["component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone")]
    keep = found.groupBy(*group).agg(first).select(F.col("first.doc_id").alias("__kept_id"), F.col("first.text_hash").alias("__kept_text"))
    same = docs[id_col].eqNullSafe(keep["__kept_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == keep["__kept_text"])
    return docs.join(keep, same, "left_semi")
