"""Substring dedup over windows of words, partitioned by super-k-mers.

A window's minimiser is its least hash of eight consecutive words. Consecutive windows with one minimiser
form a super-k-mer, which travels as one packed string to the bucket of that minimiser; equal windows have
equal minimisers and so meet there, and sorting the bucket's windows finds the first document of each.
Minimisers that stand in a single document only cannot hold a repeat; their strings stay at home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, pieces, stored, texts

GRAM = 8
#: Documents of a minimiser from which its windows are dealt one by one.
HOT = 5000
#: Compressed bytes of texts that a task handles at a time.
SLICE = 400_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64) if words else np.empty(0, np.uint64)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sums(h: np.ndarray, spans: np.ndarray, width: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash of the words spans[i] .. spans[i] + width[i] of h, whatever stands before them."""
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(len(h), base)[: len(h)], dtype=np.uint64)])
    return _mixed((prefix[spans + width] - prefix[spans]) * _powers(len(h), np.uint64(pow(int(base), -1, 1 << 64)))[spans])


class Runs:
    """The super-k-mers of some texts: `text`, `start` (first word), `stop` (end of the last window) and `key` by run."""

    def __init__(self, values: list[str], window: int):
        self.words = [v.encode().split() for v in values]
        n = np.array([len(w) for w in self.words])
        self.first = np.cumsum(n) - n
        flat = [w for own in self.words for w in own]
        self.hashes = _hashes(flat)
        windows = np.maximum(n - window + 1, 0)
        if not windows.sum():
            self.text = self.start = self.stop = np.empty(0, np.int64)
            self.key = np.empty(0, np.int64)
            return
        gram = min(GRAM, window)
        total = len(flat) - gram + 1
        grams = np.zeros(total, np.uint64)
        for k in range(gram):
            grams += self.hashes[k : k + total] * _MIX[k]
        grams = _mixed(grams)
        of = np.repeat(np.arange(len(n)), windows)
        place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + self.first[of]
        view = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
        least = view[place[0] : place[-1] + 1].min(axis=1)[place - place[0]]
        begin = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (of[1:] != of[:-1])]))
        end = np.append(begin[1:], len(of)) - 1
        self.text = of[begin]
        self.start = place[begin] - self.first[self.text]
        self.stop = place[end] - self.first[self.text] + window
        self.key = least[begin].view(np.int64)

    def hashes_of(self, base: np.uint64) -> np.ndarray:
        return _sums(self.hashes, self.first[self.text] + self.start, self.stop - self.start, base).view(np.int64)

    def packed(self, i: int) -> bytes:
        return b" ".join(self.words[self.text[i]][self.start[i] : self.stop[i]])


def _compressed(docs: DataFrame, kind: str) -> DataFrame:
    """doc_id, text_hash and z, the text compressed: what is shuffled and stored of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches):
            z = pa.array([compress(x.encode()) for x in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), z], names=["doc_id", "text_hash", "z"])

    return docs.mapInArrow(run, f"doc_id {kind}, text_hash bigint, z binary")


def _open(batch: pa.RecordBatch) -> list[str]:
    decompress = zstandard.ZstdDecompressor().decompress
    return [decompress(z).decode() for z in batch.column("z").to_pylist()]


def _marks(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """doc_id, text_hash and key of each text's different minimisers; rows of null ids have none."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        runs = Runs(batch.column("text").to_pylist(), window)
        order = np.lexsort((runs.key, runs.text))
        text, key = runs.text[order], runs.key[order]
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
        at = pa.array(text[new], pa.int64())
        return [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(key[new], pa.int64())]

    return map_arrow(docs.where("doc_id is not null"), run, f"doc_id {kind}, text_hash bigint, key bigint")


def _shared(marks: DataFrame) -> DataFrame:
    """key and hot of the minimisers that stand in two documents or more."""
    keys = marks.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    return keys.where("low < high").select("key", (F.col("n") > HOT).alias("hot"))


def _super_kmers(docs: DataFrame, window: int, kind: str, strings: bool) -> DataFrame:
    """The super-k-mers of shared minimisers: doc_id, text_hash, start, bucket, a, b (hash of the string) and, if asked for, packed.

    A hot minimiser's super-k-mer is dealt window by window: a window is its 128-bit hash then, with no
    string and a bucket of its own, so that its documents meet in partial minima only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "z", SLICE):
            runs = Runs(_open(batch), window)
            shared = {(i, x["key"]): x["hot"] for i, own in enumerate(batch.column("keys").to_pylist()) for x in own}
            hot = [shared.get(x) for x in zip(runs.text.tolist(), runs.key.tolist())]
            take = [i for i, h in enumerate(hot) if h is not None]
            times = np.array([runs.stop[i] - runs.start[i] - window + 1 if hot[i] else 1 for i in take], np.int64)
            if not take:
                continue
            single = np.repeat(np.array([hot[i] for i in take]), times)
            of = np.repeat(np.array(take), times)
            step = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
            key = runs.key[of]
            runs.text, start, stop = runs.text[of], runs.start[of], runs.stop[of]
            runs.start = np.where(single, start + step, start)
            runs.stop = np.where(single, start + step + window, stop)
            a, b = runs.hashes_of(_BASES[0]), runs.hashes_of(_BASES[1])
            at = pa.array(runs.text)
            out = [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(runs.start, pa.int32()), pa.array(np.where(single, a, key)), pa.array(a), pa.array(b)]
            names = ["doc_id", "text_hash", "start", "bucket", "a", "b"]
            if strings:
                out.append(pa.array([None if h else runs.packed(i) for i, h in enumerate(single.tolist())], pa.binary()))
                names.append("packed")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"doc_id {kind}, text_hash bigint, start int, bucket bigint, a bigint, b bigint" + ", packed binary" * strings
    return docs.where("keys is not null").select("doc_id", "text_hash", "z", "keys").mapInArrow(run, schema)


def _first_by_window(rows: pa.Table, window: int) -> list[np.ndarray]:
    """For each packed string, the least document of each of its windows among all strings of its bucket."""
    words = [x.split() for x in rows["packed"].to_pylist()]
    n = np.array([len(w) for w in words])
    hashes = _hashes([w for own in words for w in own])
    windows = n - window + 1
    of = np.repeat(np.arange(len(n)), windows)
    place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + (np.cumsum(n) - n)[of]
    width = np.full(len(of), window)
    a, b = (_sums(hashes, place, width, base) for base in _BASES)
    bucket = rows["bucket"].to_numpy()[of]
    doc = rows["first"].to_numpy()[of]
    order = np.lexsort((doc, b, a, bucket))
    new = np.ones(len(order), bool)
    x, y, z = bucket[order], a[order], b[order]
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
    least = np.empty(len(order), doc.dtype)
    least[order] = doc[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return np.split(least, np.cumsum(windows)[:-1])


def _counted(strings: DataFrame, window: int, kind: str) -> DataFrame:
    """bucket, a, b and least: the first document of each window of each different string; a window without string is its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        size = 0

        def done(rows: pa.Table) -> pa.RecordBatch:
            single = rows.filter(pc.is_null(rows["packed"]))
            rows = rows.filter(pc.is_valid(rows["packed"])).combine_chunks()
            least = [*(_first_by_window(rows, window) if len(rows) else ()), *single["first"].to_numpy()[:, None]]
            rows = pa.concat_tables([rows, single])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, least)]), pa.int32()), pa.array(np.concatenate(least)).cast(rows["first"].type))
            return pa.RecordBatch.from_arrays([*(rows[c].combine_chunks() for c in ("bucket", "a", "b")), lists], names=["bucket", "a", "b", "least"])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size > 4_000_000:  # all buckets but the last are whole
                rows = pa.concat_tables(waiting).combine_chunks()
                keys = rows["bucket"].to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield done(rows.slice(0, cut).combine_chunks())
                waiting = [rows.slice(cut)]
                size = waiting[0].nbytes
        if waiting:
            yield done(pa.concat_tables(waiting).combine_chunks())

    ordered = strings.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(run, f"bucket bigint, a bigint, b bigint, least array<{kind}>")


def _kept(docs: DataFrame, window: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "z", SLICE):
            n, removed, kept = [], [], []
            for text, starts in zip(_open(batch), batch.column("starts").to_pylist()):
                words = text.encode().split()
                left, reach = [], 0
                for s in sorted(starts or ()):
                    left += words[reach:s] if s > reach else ()
                    reach = s + window
                left += words[reach:]
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string")


def substring_dedup(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_words, n_removed and kept: each text without the words of windows that also start in a document of smaller id.

    One row for each row of `docs`. Words are runs without ASCII white space; `kept` has one space
    between them. Null or empty texts have no words, texts shorter than a window lose none. Rows of one id are one
    document and never remove each other's windows; a null id neither removes nor loses words."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn("text_hash", F.xxhash64("text"))
    marks = _marks(rows, window, kind)
    own = marks.join(_shared(marks), "key").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("key", "hot")).alias("keys"))
    home = stored(_compressed(rows, kind).join(own, ["doc_id", "text_hash"], "left"))
    kmers = _super_kmers(home, window, kind, True).groupBy("bucket", "a", "b", "packed").agg(F.min("doc_id").alias("first"))
    placed = _super_kmers(home, window, kind, False).join(_counted(kmers, window, kind), ["bucket", "a", "b"])
    repeats = F.transform(F.filter(F.sequence(F.lit(0), F.size("least") - 1), lambda i: F.get("least", i) < F.col("doc_id")), lambda i: i + F.col("start"))
    starts = placed.select("doc_id", "text_hash", repeats.alias("at")).where(F.size("at") > 0).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("at")).alias("starts"))
    touched = home.where("keys is not null").select("doc_id", "text_hash", "z").join(starts, ["doc_id", "text_hash"], "left").select("z", "doc_id", "starts")
    alone = home.where("keys is null").select("z", "doc_id", F.lit(None).cast("array<int>").alias("starts"))
    return _kept(touched, window, kind).union(_kept(alone, window, kind))
