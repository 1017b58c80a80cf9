"""A hashed maximum-entropy language model with a class-factored softmax.

p(word | context) = p(class | words before) * p(slot | class, words before) * p(word | slot). A word's class is a hash of
its first four bytes, its slot within the class one of the whole word. Both factors are softmaxes over hashed features. The
class sees the class before (bigram), the class before that (skip) and a hash of both; the slot within its class sees hashed
endings of the word before (bigram) and of the word before that (skip). All weights are trained by scaled gradient steps, each a
Spark job over the counts of contexts in the whole training corpus: a gradient needs the observed feature counts and the
counts of contexts alone. Within a slot a word has its smoothed relative frequency, from counts that grow with the corpus. Texts
are scored in numpy batches: frequent words by a broadcast table of fixed size, all others by a join on their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, largest, pieces, texts

#: Classes, slots of a class, hashes of endings, and rows of the weights that pairs of classes are hashed to.
CLASSES, SLOTS, ENDINGS, PAIRS = 512, 16, 16, 1024
BEGIN, END = 0, 1
STEPS = 12
#: Weight of the prior that pulls feature weights to zero.
PRIOR = 1.0
#: Most frequent words whose counts are broadcast, at most.
FREQUENT = 1 << 17
SMOOTH = 0.1
#: Hash that stands for the end of a text; no word has a newline.
END_HASH = xxhash.xxh3_64_intdigest(b"\n") - (1 << 63)
#: Tasks that hold the counts of contexts, whose number is bounded; each sends a whole gradient at every step.
TRAINING_TASKS = 3

_ALL = CLASSES * SLOTS
#: Counted cells, one after the other: contexts of the class and its features, contexts of the slot and its features.
SECTIONS = {"contexts": CLASSES**2, "one": CLASSES**2, "two": CLASSES**2, "pair": PAIRS * CLASSES, "inner": CLASSES * ENDINGS**2, "end1": ENDINGS * _ALL, "end2": ENDINGS * _ALL}
_FIRST = dict(zip(SECTIONS, np.cumsum([0, *SECTIONS.values()]).tolist()))
CELLS = sum(SECTIONS.values())
#: Shapes of the weights, in the order in which they are laid out.
SHAPES = {"class_bias": (1, CLASSES), "one": (CLASSES, CLASSES), "two": (CLASSES, CLASSES), "pair": (PAIRS, CLASSES), "slot_bias": (1, _ALL), "end1": (ENDINGS, _ALL), "end2": (ENDINGS, _ALL)}
_PLACES = dict(zip(SHAPES, np.cumsum([0, *(a * b for a, b in SHAPES.values())]).tolist()))
WEIGHTS = sum(a * b for a, b in SHAPES.values())


def part(vector: np.ndarray, name: str) -> np.ndarray:
    """One matrix of a weight vector, a view."""
    a, b = SHAPES[name]
    return vector[_PLACES[name] : _PLACES[name] + a * b].reshape(a, b)


def word_class(word: bytes) -> int:
    return 2 + xxhash.xxh32_intdigest(word[:4]) % (CLASSES - 2)


def ending(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[-2:]) % ENDINGS


def slots(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Number of each word's slot among all slots, from the hash of the word."""
    return classes * SLOTS + np.where(hashes == END_HASH, 0, hashes & (SLOTS - 1))


def pair_row(two: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Hash of two classes; with the same `two`, different classes `one` have different rows."""
    return (two * 40503 + (two >> 4) + one) & (PAIRS - 1)


class _Words(dict):
    """Index of a word among the words met so far; their hashes, classes and endings by index."""

    def __init__(self):
        self.hashes, self.classes, self.endings = [END_HASH], [END], [0]
        self._arrays = [np.zeros(0, np.int64)] * 3

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word) - (1 << 63))
        self.classes.append(word_class(word))
        self.endings.append(ending(word))
        return i

    def arrays(self) -> list[np.ndarray]:
        """hashes, classes and endings; only words that are new since the last call are converted."""
        have = len(self._arrays[0])
        if have < len(self.hashes):
            own = (self.hashes, self.classes, self.endings)
            self._arrays = [np.concatenate([x, np.array(y[have:], np.int64)]) for x, y in zip(self._arrays, own)]
        return self._arrays


class _Tokens:
    """Features of the tokens of some texts, each ended by an END: class, slot, and classes and endings of the two words before."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, words: _Words):
        hashes, classes, ends = words.arrays()
        starts = np.cumsum(counts) - counts
        self.cls = classes[ids]
        self.slot = slots(hashes[ids], self.cls)
        self.one, self.two = _before(self.cls, starts, BEGIN)
        self.end1, self.end2 = _before(ends[ids], starts, 0)

    def cells(self) -> np.ndarray:
        """The cells that the tokens count in."""
        own = {
            "contexts": self.two * CLASSES + self.one,
            "one": self.one * CLASSES + self.cls,
            "two": self.two * CLASSES + self.cls,
            "pair": pair_row(self.two, self.one) * CLASSES + self.cls,
            "inner": (self.cls * ENDINGS + self.end1) * ENDINGS + self.end2,
            "end1": self.end1 * _ALL + self.slot,
            "end2": self.end2 * _ALL + self.slot,
        }
        return np.concatenate([x + _FIRST[name] for name, x in own.items()])


def _before(values: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.concatenate([[begin], values[:-1]])
    one[starts] = begin
    two = np.concatenate([[begin], one[:-1]])
    two[starts] = begin
    return one, two


def _tokens(values: list[str], words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Word indices of all texts, index 0 (the end) after each, and each text's number of tokens."""
    ids: list[int] = []
    counts = []
    for value in values:
        own = value.encode().lower().split()
        ids += map(words.__getitem__, own)
        ids.append(0)
        counts.append(len(own) + 1)
    return np.array(ids, np.int64), np.array(counts, np.int64)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """kind, id, class and n: counts of word hashes (kind 0) and of cells (kind 1) in the texts of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        totals, cells = np.zeros(0, np.int64), np.zeros(CELLS, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def count() -> None:
            nonlocal totals, waiting, size
            if waiting:
                ids, counts = (np.concatenate(x) for x in zip(*waiting))
                new = np.bincount(ids, minlength=len(words.hashes))
                new[: len(totals)] += totals
                totals = new
                cells[:] += np.bincount(_Tokens(ids, counts, words).cells(), minlength=CELLS)
                waiting, size = [], 0

        def rows(kind: int, ids: np.ndarray, classes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(ids), kind, np.int32), ids, classes.astype(np.int32), n)], names=["kind", "id", "class", "n"])

        def flush() -> pa.RecordBatch:
            nonlocal words, totals
            hashes, classes, _ = words.arrays()
            out = rows(0, hashes[: len(totals)], classes[: len(totals)], totals)
            words, totals = _Words(), np.zeros(0, np.int64)
            return out

        for batch in pieces(batches):
            waiting.append(_tokens(batch.column("text").to_pylist(), words))
            size += len(waiting[-1][0])
            if size > 500_000:
                count()
            if len(words.hashes) > 400_000:
                count()
                yield flush()
        count()
        if len(totals):
            yield flush()
        seen = np.flatnonzero(cells)
        yield rows(1, seen, np.zeros(len(seen)), cells[seen])

    partial = docs.select("text").mapInArrow(run, "kind int, id bigint, class int, n bigint")
    return partial.groupBy("kind", "id", "class").agg(F.sum("n").alias("n"))


def class_logs(weights: np.ndarray, two: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Natural log of p(class | classes before) for each context; nothing but a text's begin has class BEGIN."""
    logits = part(weights, "one")[one] + part(weights, "two")[two]
    logits += part(weights, "pair")[pair_row(two, one)]
    logits += part(weights, "class_bias")
    logits[:, BEGIN] = -1e9
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def slot_logs(weights: np.ndarray, cls: np.ndarray, end1: np.ndarray, end2: np.ndarray) -> np.ndarray:
    """Natural log of p(slot | class, endings before) for each context, over the slots of its class."""
    own = lambda name: part(weights, name).reshape(-1, CLASSES, SLOTS)
    logits = own("slot_bias")[0, cls] + own("end1")[end1, cls] + own("end2")[end2, cls]
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def expected_counts(weights: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Feature counts that the model expects in the contexts among these cells, laid out as the weights."""
    out = np.zeros(WEIGHTS, np.float32)
    order = np.argsort(ids)
    ids, n = ids[order], n[order].astype(np.float32)[:, None]
    at = np.searchsorted(ids, np.arange(CLASSES + 1) * CLASSES)
    for two, (first, last) in enumerate(zip(at, at[1:])):
        if first < last:  # all contexts with this class two before: their other features differ
            one = ids[first:last] - two * CLASSES
            p = np.exp(class_logs(weights, np.full(len(one), two), one)) * n[first:last]
            total = p.sum(0)
            part(out, "class_bias")[0] += total
            part(out, "two")[two] += total
            part(out, "one")[one] += p
            part(out, "pair")[pair_row(two, one)] += p
    first, last = np.searchsorted(ids, [_FIRST["inner"], _FIRST["end1"]])
    for k in range(first, last, 1 << 15):
        c, m = ids[k : min(last, k + (1 << 15))] - _FIRST["inner"], n[k : min(last, k + (1 << 15))]
        cls, end1, end2 = c // ENDINGS**2, c // ENDINGS % ENDINGS, c % ENDINGS
        p = (np.exp(slot_logs(weights, cls, end1, end2)) * m).ravel()
        for name, rows in (("slot_bias", cls), ("end1", end1 * CLASSES + cls), ("end2", end2 * CLASSES + cls)):
            own = part(out, name).reshape(-1)
            own += np.bincount((rows[:, None] * SLOTS + np.arange(SLOTS)).ravel(), p, len(own)).astype(np.float32)
    return out


def observed_counts(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Feature counts among these cells, laid out as the weights."""
    out = np.zeros(WEIGHTS, np.float32)
    for name in ("one", "two", "pair", "end1", "end2"):
        inside = (ids >= _FIRST[name]) & (ids < _FIRST[name] + SECTIONS[name])
        part(out, name).reshape(-1)[ids[inside] - _FIRST[name]] = n[inside]
    part(out, "class_bias")[0] = part(out, "one").sum(0)
    part(out, "slot_bias")[0] = part(out, "end1").sum(0)
    return out


def first_weights(observed: np.ndarray) -> np.ndarray:
    """Weights with biases from the smoothed relative frequencies of classes and of slots."""
    weights = np.zeros(WEIGHTS, np.float32)
    for name in ("class_bias", "slot_bias"):
        part(weights, name)[:] = np.log(part(observed, name) + SMOOTH)
    return weights


def updated(weights: np.ndarray, observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """One step: the difference of counts less the pull of the prior, scaled by the expected counts and the active features."""
    scale = np.full(WEIGHTS, 0.25, np.float32)
    scale[_PLACES["slot_bias"] :] = 1 / 3
    pull = np.full(WEIGHTS, PRIOR, np.float32)
    for name in ("class_bias", "slot_bias"):
        part(pull, name)[:] = 0
    return weights + np.clip((observed - expected - pull * weights) / (expected + 1) * scale, -1, 1)


def train_weights(cells: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights after `steps` gradient updates. cells: id and n, at most CELLS rows, so a few tasks hold them.

    Each step every task sends the feature counts that it expects, a vector of fixed size; one at a time, as the driver's memory is small."""
    context = cells.sparkSession.sparkContext
    parts = checkpointed(cells.select("id", "n").coalesce(TRAINING_TASKS))

    def total(function) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [(b.column("id").to_numpy(), b.column("n").to_numpy()) for b in batches]
            if own:
                ids, n = (np.concatenate(x) for x in zip(*own))
                yield pa.RecordBatch.from_arrays([pa.array([function(ids, n).tobytes()], pa.binary())], names=["g"])

        out = np.zeros(WEIGHTS, np.float32)
        for r in parts.mapInArrow(run, "g binary").toLocalIterator():
            out += np.frombuffer(r.g, np.float32)
        return out

    observed = total(observed_counts)
    weights = first_weights(observed)
    for _ in range(steps):
        shared = context.broadcast(weights)
        weights = updated(weights, observed, total(lambda ids, n: expected_counts(shared.value, ids, n)))
        shared.destroy()
    return weights


class Scorer:
    """Log10 of p(slot | words before), by lookups in tables of fixed size, which are made once and broadcast."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        context = np.arange(CLASSES**2)
        self.norm = np.concatenate([self._norm(context[i : i + 4096]) for i in range(0, len(context), 4096)])
        inner = np.arange(SECTIONS["inner"])
        own = inner // ENDINGS**2, inner // ENDINGS % ENDINGS, inner % ENDINGS
        self.inner_norm = slot_logs(weights, *own)[:, 0] - self._slot(own[0] * SLOTS, own[1], own[2])

    def _norm(self, context: np.ndarray) -> np.ndarray:
        two, one = context // CLASSES, context % CLASSES
        return class_logs(self.weights, two, one)[:, END] - self._class(np.full(len(context), END), two, one)

    def _class(self, cls: np.ndarray, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        w = self.weights
        return part(w, "class_bias")[0, cls] + part(w, "one")[one, cls] + part(w, "two")[two, cls] + part(w, "pair")[pair_row(two, one), cls]

    def _slot(self, slot: np.ndarray, end1: np.ndarray, end2: np.ndarray) -> np.ndarray:
        w = self.weights
        return part(w, "slot_bias")[0, slot] + part(w, "end1")[end1, slot] + part(w, "end2")[end2, slot]

    def __call__(self, t: _Tokens) -> np.ndarray:
        of_class = self._class(t.cls, t.two, t.one) + self.norm[t.two * CLASSES + t.one]
        of_slot = self._slot(t.slot, t.end1, t.end2) + self.inner_norm[(t.cls * ENDINGS + t.end1) * ENDINGS + t.end2]
        return (of_class + of_slot) / np.float32(np.log(10))


def lm_scores(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, steps: int = STEPS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) for each row of `docs`.

    The model learns from the rows where `training` is true. Tokens are the words of the whole text, A-Z
    lower-cased, and its end; a null or empty text is its end alone. base_score is the smoothed unigram
    model, score the maximum-entropy model. Repeated rows each come out, null ids too; without training
    rows all words are unknown and classes and slots equally likely."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts(docs.withColumn("__train", F.coalesce(training, F.lit(False))), "__train", id_col=id_col, text_col=text_col)
    counted = checkpointed(corpus_counts(rows.where("__train")))
    words = counted.where("kind = 0")
    in_class = F.when(F.col("id") == END_HASH, 0).otherwise(F.col("id").bitwiseAND(SLOTS - 1))
    sizes = words.groupBy((F.col("class") * SLOTS + in_class).alias("slot")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total, distinct = sum(r.n for r in sizes), sum(r.v for r in sizes)
    slot_cost = np.full(CLASSES * SLOTS, np.log10(SMOOTH))
    for r in sizes:
        slot_cost[r.slot] = np.log10(r.n + SMOOTH * (r.v + 1))
    weights = train_weights(counted.where("kind = 1"), steps)
    top = largest(words.select("id", "n"), F.col("n"), frequent, "id").toPandas().sort_values("id")
    shared = docs.sparkSession.sparkContext.broadcast((top["id"].to_numpy(np.int64), top["n"].to_numpy(np.float64), Scorer(weights), slot_cost))
    base_cost = float(np.log10(total + SMOOTH * (distinct + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ids, known_n, scorer, cost = shared.value
        words, n = _Words(), np.zeros(0)
        for batch in pieces(batches):
            if len(words) > 400_000:
                words, n = _Words(), np.zeros(0)
            ids, counts = _tokens(batch.column("text").to_pylist(), words)
            hashes = words.arrays()[0]
            fresh = hashes[len(n) :]
            place = np.minimum(np.searchsorted(known_ids, fresh), max(len(known_ids) - 1, 0))
            n = np.concatenate([n, np.where(known_ids[place] == fresh, known_n[place], 0.0) if len(known_ids) else np.zeros(len(fresh))])
            token_n = n[ids]
            rare = token_n == 0
            starts = np.cumsum(counts) - counts
            of = np.repeat(np.arange(len(counts)), counts)
            log_n = np.where(rare, 0.0, np.log10(token_n + SMOOTH))
            tokens = _Tokens(ids, counts, words)
            context = scorer(tokens) - cost[tokens.slot]
            add = lambda x: np.add.reduceat(x, starts)
            pair, tf = np.unique(of[rare] * len(hashes) + ids[rare], return_counts=True)
            rare_of, rare_id = pair // len(hashes), pair % len(hashes)
            m, r = len(counts), len(pair)
            head = np.concatenate([np.ones(m, np.int32), np.zeros(r, np.int32)])
            at = pa.array(np.concatenate([np.arange(m), rare_of]))
            doc = batch.column("doc_id").take(at)
            text_hash = batch.column("text_hash").take(at)
            cells = [np.concatenate([a, b]) for a, b in (
                (batch.column("text_hash").to_numpy(), hashes[rare_id]),
                (np.zeros(m, np.int64), tf),
                (counts, np.zeros(r, np.int64)),
                (add((~rare).astype(np.int64)), np.zeros(r, np.int64)),
                (add(log_n), np.zeros(r)),
                (add(context), np.zeros(r)),
            )]
            yield pa.RecordBatch.from_arrays([doc, text_hash, pa.array(head), *map(pa.array, cells)], names=["doc_id", "text_hash", "head", "id", "tf", "n_tokens", "n_known", "log_n", "context"])

    marked = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    parts = marked.mapInArrow(run, f"doc_id {kind}, text_hash bigint, head int, id bigint, tf bigint, n_tokens bigint, n_known bigint, log_n double, context double")
    # Head rows carry the text's hash as id; head keeps them from matching a word.
    vocabulary = words.select("id", F.lit(0).alias("head"), F.col("n").alias("count"))
    joined = parts.join(vocabulary, ["id", "head"], "left")
    found = F.coalesce("count", F.lit(0))
    rare = F.when(F.col("head") == 0, F.col("tf") * F.log10(found + F.lit(SMOOTH))).otherwise(0.0)
    sums = joined.groupBy("doc_id", "text_hash").agg(
        F.sum("head").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(found > 0, F.col("tf")).otherwise(0)).alias("n_known"),
        F.sum(F.col("log_n") + rare).alias("log_n"),
        F.sum("context").alias("context"),
    )
    one = sums.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("k"), "copies", *[(F.col(c) / F.col("copies")).alias(c) for c in ("log_n", "context")], *[(F.col(c) / F.col("copies")).cast("bigint").alias(c) for c in ("n_tokens", "n_known")])
    return one.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), (F.col("log_n") - F.col("n_tokens") * base_cost).alias("base_score"), (F.col("log_n") + F.col("context")).alias("score"))
