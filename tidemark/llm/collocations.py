"""Phrases whose words keep company, by best-first growth of prefixes with score bounds.

A phrase's score is that of its weakest cut, 1000 * a * n / (l * r) with a, l and r the counts of the phrase and of both parts.
As a <= r, every phrase that begins with a given prefix scores at most 1000 * n / f(prefix), and the shortest prefix, its first word, bounds it best:
rare first words come first. A round expands the frontier of each language down to a cut in that order: prefixes grow word by word
as long as they are frequent, and their phrases are scored. The 2000th surviving score then tells how far the frontier can
still hold a phrase that ranks, ties included; the language is settled once nothing is left above it. Equally
a <= l, so from the second round on a last word whose bound is too low spares the scoring of a phrase.

Texts are encoded once, as numbers of a chunk's own words; words are told apart by 64-bit codes which are checked to be unique.
A pass counts hashes of phrases, packed by range of the hash, and only marks in a bitmap of fixed size those that may be
frequent; marked phrases are then counted exactly, with the sameness of their left and right neighbours: a phrase lies inside an equally frequent longer one
just where all its occurrences have one neighbour in common.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, compact, remove, store

#: Bytes of text of a chunk, hashes that a task holds before it sends them, hashes of a range, and bits of a bitmap (as a power of two).
CHUNK, HELD, RANGE, BITS = 4_000_000, 2_000_000, 4_000_000, 26
#: Bytes that end a piece become \xff, which no UTF-8 text holds; A-Z become lower case and tabs spaces.
_BYTES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\xff" * 10 + b" abcdefghijklmnopqrstuvwxyz")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Stands, as lower and upper end, for neighbours that differ.
_MIXED = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)


def pieces_of(text: bytes) -> list[bytes]:
    """Words in order, with a \\xff wherever a piece ends."""
    return [w for w in text.translate(_BYTES).replace(b"\xff", b" \xff ").split(b" ") if w]


def _encoded(lang: str, texts: list[bytes], salt: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a chunk, their counts and codes, and the texts as numbers of words from 1 (0: end of a piece)."""
    tokens = pieces_of(b"\xff".join(texts))
    words = dict.fromkeys(tokens)
    words.pop(b"\xff", None)
    number = dict(zip(words, range(1, len(words) + 1)))
    number[b"\xff"] = 0
    at = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
    head = f"{salt}:{len(lang)}:{lang}:".encode()
    codes = np.array([xxhash.xxh64_intdigest(head + w, 42) for w in words], np.uint64)
    return list(words), np.bincount(at, minlength=len(words) + 1)[1:], codes.view(np.int64), at


def encode(docs: DataFrame, salt: int) -> str:
    """Place of a table of chunks: a language, the words of its texts with counts and codes, and the texts as numbers of these words."""

    def chunk(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        words, counts, codes, at = _encoded(lang, texts, salt)
        columns = [pa.array([lang]), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())), pa.array([codes], pa.list_(pa.int64())), pa.array([at.tobytes()])]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "counts", "codes", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                lang, text = lang.as_py(), text.as_py()
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 64
                if size[lang] >= CHUNK or sum(size.values()) >= 4 * CHUNK:
                    most = max(size, key=size.get)
                    size.pop(most)
                    yield chunk(most, held.pop(most))
        for lang, texts in held.items():
            yield chunk(lang, texts)

    return store(docs.mapInArrow(run, "lang string, words array<string>, counts array<bigint>, codes array<bigint>, at binary"))


class Bits:
    """A set of 64-bit hashes as a bitmap of fixed size: it may hold a few more, never fewer."""

    def __init__(self, sent):
        self.packed = np.frombuffer(zlib.decompress(sent.value), np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64(8 * len(self.packed) - 1)
        return (self.packed[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a column `hash`, put together by slices in Spark; 2 ** BITS bits, whatever the number of rows."""
    slot = (F.col("hash").bitwiseAND(F.lit((1 << BITS) - 1)) + 1).alias("slot")
    slices = hashes.select(slot).groupBy(F.bitmap_bucket_number("slot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    packed = np.zeros((1 << BITS) // 8, np.uint8)
    for r in slices:
        packed[(r["b"] - 1) * 4096 :][:4096] = np.frombuffer(r["bits"], np.uint8)
    return packed


def sent(spark: SparkSession, packed: np.ndarray):
    """A bitmap, compressed and broadcast."""
    return spark.sparkContext.broadcast(zlib.compress(packed.tobytes(), 1))


def longer_hash(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word each; a single word's hash is its code."""
    x = hashes * _FACTOR + codes
    x = (x ^ (x >> np.uint64(32))) * _FACTOR
    return x ^ (x >> np.uint64(29))


def _chunks(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes by number of the word, and the text of each chunk; infrequent words become 0, as if the piece ended there."""
    bits = Bits(frequent)
    for batch in batches:
        for codes, at in zip(batch.column(0), batch.column(1)):
            codes = np.concatenate([np.zeros(1, np.uint64), codes.values.to_numpy(zero_copy_only=False).view(np.uint64)])
            known = bits.has(codes)
            known[0] = False
            at = np.frombuffer(at.as_buffer(), np.int32)
            yield codes, np.where(known[at], at, 0)


def _grown(codes: np.ndarray, at: np.ndarray, first: Bits, marked: Bits, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, places and hashes of all phrases that begin with a word of `first`, and which of them are marked; marked ones grow on."""
    begins = first.has(codes)
    begins[0] = False
    place = np.flatnonzero(begins[at])
    hashes = codes[at[place]]
    for m in range(2, longest + 1):
        place, hashes = (x[: np.searchsorted(place, len(at) - m + 1)] for x in (place, hashes))
        following = at[place + m - 1]
        inside = following > 0
        place, hashes = place[inside], longer_hash(hashes[inside], codes[following[inside]])
        kept = marked.has(hashes)
        yield m, place, hashes, kept
        place, hashes = place[kept], hashes[kept]


def frequent_hashes(chunks: DataFrame, frequent, first, marked, length: int, least: int, ranges: int) -> DataFrame:
    """Hashes (column hash) of the phrases of this length with `least` occurrences or more, if no two share a hash."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, counts = summed(*(np.concatenate(x) for x in zip(*held)))
        ends = np.searchsorted(hashes, [np.uint64((i << 64) // ranges) for i in range(1, ranges)])
        parts = [(i, h.tobytes(), c.astype(np.int64).tobytes()) for i, (h, c) in enumerate(zip(np.split(hashes, ends), np.split(counts, ends))) if len(h)]
        return pa.RecordBatch.from_arrays([pa.array([x[j] for x in parts], t) for j, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["part", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, begins, grows = [], 0, Bits(first), Bits(marked)
        for codes, at in _chunks(batches, frequent):
            for m, _, hashes, _ in _grown(codes, at, begins, grows, length):
                if m == length and len(hashes):
                    held.append(np.unique(hashes, return_counts=True))
                    size += len(held[-1][0])
            if size >= HELD:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def merge(group: pa.Table) -> pa.Table:
        hashes, counts = summed(*(np.frombuffer(b"".join(group[c].to_pylist()), t) for c, t in (("hashes", np.uint64), ("counts", np.int64))))
        return pa.table([hashes[counts >= least].view(np.int64)], names=["hash"])

    sent = chunks.select("codes", "at").mapInArrow(run, "part bigint, hashes binary, counts binary")
    return sent.groupBy("part").applyInArrow(merge, "hash bigint")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def exact_counts(chunks: DataFrame, frequent, first, marked, longest: int) -> DataFrame:
    """Columns p (codes of a phrase's words), f and the ends l0, l1, r0, r1 of its neighbours' codes: all marked phrases that begin with a word of `first`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, grows = Bits(first), Bits(marked)
        for codes, at in _chunks(batches, frequent):
            beside, base = np.concatenate([[0], at, [0]]), np.int64(len(codes))
            before = group = None
            for m, place, _, kept in _grown(codes, at, begins, grows, longest):
                place = place[kept]
                if not len(place):
                    break
                shorter = at[place].astype(np.int64) if before is None else group[np.searchsorted(before, place)]
                key = shorter * base + at[place + m - 1]
                order = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
                group = np.empty(len(place), np.int64)
                group[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(place)]))
                before, shown = place, place[order[starts]]
                ends = []
                for near in (beside[place], beside[place + m + 1]):
                    low, high = (f.reduceat(near[order], starts) for f in (np.minimum, np.maximum))
                    one = (low == high) & (low > 0)
                    ends += [np.where(one, codes[low].view(np.int64), x) for x in _MIXED]
                words = codes[at[shown[:, None] + np.arange(m)]].view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(0, words.size + 1, m, np.int32), words.ravel())
                yield pa.RecordBatch.from_arrays([lists, *map(pa.array, (np.diff([*starts, len(place)]), *ends))], names=["p", "f", "l0", "l1", "r0", "r1"])

    found = chunks.select("codes", "at").mapInArrow(run, "p array<bigint>, f bigint, l0 bigint, l1 bigint, r0 bigint, r1 bigint")
    return found.groupBy("p").agg(F.sum("f").alias("f"), F.min("l0").alias("l0"), F.max("l1").alias("l1"), F.min("r0").alias("r0"), F.max("r1").alias("r1"))


def hashed(phrases: DataFrame) -> DataFrame:
    """Hashes (column hash) of phrases given by their words' codes in `p`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for words in batch.column(0).to_pylist():
                codes = np.array(words, np.int64).view(np.uint64)[:, None]
                h = codes[0]
                for c in codes[1:]:
                    h = longer_hash(h, c)
                out.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64))], names=["hash"])

    return phrases.select("p").mapInArrow(run, "hash bigint")


def word_counts(chunks: DataFrame, least: int, salt: int) -> tuple[DataFrame, DataFrame] | None:
    """Frequent words (lang, word, code, f) and the number of words of each language (lang, n); None where two words share a code, one of them frequent."""
    word = F.explode(F.arrays_zip("words", "counts")).alias("w")
    found = checkpointed(chunks.select("lang", word).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")))
    code = F.xxhash64(F.concat(F.lit(f"{salt}:"), F.length("lang").cast("string"), F.lit(":"), "lang", F.lit(":"), "word"))
    found = found.withColumn("code", code)
    if not found.groupBy("code").agg(F.count("*").alias("n"), F.max("f").alias("f")).where((F.col("n") > 1) & (F.col("f") >= least)).isEmpty():
        return None
    return compact(found.where(F.col("f") >= least)), checkpointed(found.groupBy("lang").agg(F.sum("f").alias("n")))


def _few(df: DataFrame) -> DataFrame:
    """`df`, a row a language, broadcast where its size is small."""
    return F.broadcast(df) if df.count() <= 100_000 else df


def _scored(survivors: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Survivors (lang, p, a) with n, and the score and parts of their lowest cut; `counts` (p, f) holds all their parts."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = survivors.withColumn("k", F.explode(F.expr("sequence(1, size(p) - 1)")))
    parts = cuts.withColumn("left", F.expr("slice(p, 1, k)")).withColumn("right", F.expr("slice(p, k + 1, size(p) - k)"))
    parts = parts.join(counts.select(F.col("p").alias("left"), F.col("f").alias("l")), "left").join(counts.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    parts = parts.join(_few(totals), "lang").withColumn("top", F.lit(1000).cast("decimal(4,0)") * big("a") * big("n")).withColumn("under", big("l") * big("r"))
    least = F.min(F.struct(F.expr("top div under").alias("score"), "k", "l", "r")).alias("cut")
    return parts.groupBy("lang", "p", "a", "n").agg(least).select("lang", "p", "a", "n", "cut.score", "cut.l", "cut.r")


def _round(spark: SparkSession, chunks: DataFrame, words: DataFrame, totals: DataFrame, frequent, front: DataFrame, least: int, longest: int, ranges: int) -> DataFrame | None:
    """Scored survivors among the phrases whose first words lie between `done` and `cut` of their language's front."""
    near = words.join(_few(front), "lang")
    batch = near.where("f > done and f <= cut").select("lang", F.array("code").alias("p"), F.col("code").alias("hash"), "f")
    first, grown = sent(spark, bitmap(batch)), np.zeros((1 << BITS) // 8, np.uint8)
    marked = sent(spark, grown)
    for m in range(2, longest + 1):
        more = bitmap(frequent_hashes(chunks, frequent, first, marked, m, least, ranges))
        if not more.any():
            break
        grown |= more
        marked = sent(spark, grown)
    found = exact_counts(chunks, frequent, first, marked, longest).where(F.col("f") >= least)
    begins = batch.select("lang", F.col("hash").alias("begin"))
    found = compact(found.withColumn("begin", F.col("p")[0]).join(begins, "begin").drop("begin"))
    # a last word with too low a bound rules a phrase out; theta is null before there are enough survivors
    able = near.where("theta is null or cast(theta as decimal(19,0)) * f <= cast(1000 as decimal(4,0)) * n").select(F.col("code").alias("end"))
    alone = (F.size("p") == longest) | ((F.col("l0") != F.col("l1")) & (F.col("r0") != F.col("r1")))
    survivors = compact(found.where(alone).withColumn("end", F.element_at("p", -1)).join(able, "end").select("lang", "p", F.col("f").alias("a")))
    rest = survivors.select(F.explode(F.expr("transform(sequence(2, greatest(size(p) - 1, 2)), k -> slice(p, k, size(p)))")).alias("p")).where("size(p) > 1").distinct()
    ways = rest.select(F.explode(F.expr("transform(sequence(2, size(p)), k -> slice(p, 1, k))")).alias("p")).distinct()
    ways = checkpointed(ways)
    others = exact_counts(chunks, frequent, sent(spark, bitmap(ways.select(F.col("p")[0].alias("hash")))), sent(spark, bitmap(hashed(ways))), longest - 1)
    others = others.join(ways, "p", "left_semi").select("p", "f")
    counts = words.select(F.array("code").alias("p"), "f").union(found.select("p", "f").join(ways, "p", "left_anti")).union(others)
    return checkpointed(_scored(survivors, counts, totals))


def collocations(docs: DataFrame, most: int = 2000, least: int = 100, longest: int = 5, share: float = 0.25, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n, score: each language's `most` phrases of highest score.

    Texts (null: empty) are lower-cased (A-Z), cut in pieces at .,;:!? and line ends, and in words at spaces and tabs. Everything is counted by
    language (null: `und`): n all words, f(phrase) its contiguous occurrences within pieces. Phrases have 2 to `longest` words and
    `least` occurrences or more. The lowest cut counts, ties to the shorter first part; ties of phrases go to more occurrences, then by bytes. A phrase
    that lies inside an equally frequent longer one is left out. A language of fewer phrases gives them all; an empty table
    gives no rows. Rows and texts that repeat count as often as they stand; other columns are ignored.

    The first round expands first words that make up `share` of the running words of frequent words, at least; a round that leaves a language short doubles it."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for salt in range(100):
        place = encode(texts, salt)
        chunks = spark.read.parquet(place)
        if (counted := word_counts(chunks, least, salt)) is not None:
            break
        remove(spark, place)
    words, totals = counted
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    ranges = max(64, -(-tokens // RANGE))
    frequent = sent(spark, bitmap(words.select(F.col("code").alias("hash"))))
    classes = words.groupBy("lang", "f").agg((F.count("*") * F.col("f")).alias("mass"))
    classes = checkpointed(classes.withColumn("below", F.sum("mass").over(Window.partitionBy("lang").orderBy("f")) - F.col("mass")).withColumn("whole", F.sum("mass").over(Window.partitionBy("lang"))))

    def front_by(theta: DataFrame, done: DataFrame, share: float) -> DataFrame:
        """How far each language's frontier goes next: to its share, or to where bounds fall below the score theta that is needed."""
        near = classes.join(_few(totals), "lang").join(_few(theta), "lang", "left").join(_few(done), "lang", "left")
        bound = F.expr("cast(theta as decimal(19,0)) * f <= cast(1000 as decimal(4,0)) * n")
        goes = F.when(F.col("theta").isNotNull(), bound).otherwise(F.col("below") < F.lit(share) * F.col("whole"))
        return checkpointed(near.groupBy("lang", "n", "theta").agg(F.coalesce(F.max("done"), F.lit(0)).alias("done"), F.max(F.when(goes, F.col("f"))).alias("cut")))

    none = spark.createDataFrame([], "lang string, theta bigint")
    front, scored = front_by(none, spark.createDataFrame([], "lang string, done bigint"), share), None
    while not front.where("cut > done").isEmpty():
        found = _round(spark, chunks, words, totals, frequent, front, least, longest, ranges)
        scored = found if scored is None else checkpointed(scored.union(found))
        place_of = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        theta = scored.withColumn("place", place_of).where(F.col("place") <= most).groupBy("lang").agg(F.count("*").alias("held"), F.min("score").alias("theta"))
        theta, share = theta.where(F.col("held") == most).drop("held"), 2 * share
        front = front_by(theta, front.select("lang", F.greatest("done", F.coalesce("cut", "done")).alias("done")), share)
    remove(spark, place)
    if scored is None:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    ranked = scored.join(_few(front.select("lang", "theta")), "lang").where("theta is null or score >= theta").drop("theta")
    spelled = ranked.select("*", F.posexplode("p").alias("i", "code")).join(words.select("code", "word"), "code").groupBy("lang", "p", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    spelled = spelled.withColumn("phrase", F.expr("array_join(transform(w, x -> x.word), ' ')"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
