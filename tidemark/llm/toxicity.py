"""A toxicity classifier with counterfactual regularisation.

Logistic regression over the presence of words and word beginnings. Identity terms in labelled texts are
swapped for other terms of their group, and the squared change of the score is a penalty, so that a text is
not scored by the group it mentions. The groups are lists of identity terms in four languages, and groups learned from the
labels: words about as frequent among toxic texts as among others, put together by their frequency, which the
score must not depend on either. Features are chosen by their association with the label over the
training sample in Spark; the sample is bounded, the scored texts are all.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, largest, map_arrow, pieces, texts

#: Labelled rows that training takes at most (to the accuracy of a hash), those of the smallest hashes of their ids.
MOST_TRAINING_ROWS = 20_000
#: Features that the model has at most, besides those of identity terms.
MOST_FEATURES = 3_000
PREFIXES = (3, 4, 5, 6)
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("deaf", "blind", "disabled", "healthy"),
    ("young", "old", "elderly"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer", "kinder"),
    ("schwul", "lesbisch", "hetero", "trans"),
    ("deutsche", "türken", "polen", "ausländer", "flüchtlinge", "einheimische"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "filles", "garçons"),
    ("français", "arabes", "africains", "étrangers", "immigrés", "réfugiés"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("españoles", "gitanos", "africanos", "extranjeros", "inmigrantes", "refugiados"),
)
#: Learned groups: their number and size at most, and the words' least number of training texts, length and greatest deviation (in standard errors).
LEARNED_GROUPS, GROUP_SIZE, LEAST_TEXTS, LEAST_LENGTH, MOST_DEVIATION = 40, 5, 20, 4, 0.5
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A word's features: itself, and the beginnings that it goes beyond, marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class _Cache(dict):
    """What `function` gives for the words of a token without white space, looked up once; emptied when large."""

    def __init__(self, function: Callable[[str], Iterable], most: int = 100_000):
        self.function, self.most = function, most

    def __missing__(self, token: str) -> tuple:
        found = tuple({x for w in _WORD.findall(token) for x in self.function(w)})
        if len(self) >= self.most:
            self.clear()
        self[token] = found
        return found

    def of(self, text: str) -> set:
        return set(chain.from_iterable(map(self.__getitem__, set(text.lower().split()))))


def _counts(sample: DataFrame) -> DataFrame:
    """feature, texts it is in, toxic ones among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, toxic = Counter(), Counter()
        cache = _Cache(features)

        def flush() -> pa.RecordBatch:
            names = list(total)
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[x] for x in names], pa.int64()), pa.array([toxic[x] for x in names], pa.int64())], names=["feature", "n", "pos"])
            total.clear()
            toxic.clear()
            return out

        for batch in pieces(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = cache.of(text)
                total.update(own)
                if label:
                    toxic.update(own)
                if len(total) > 200_000:
                    yield flush()
        yield flush()

    return sample.select("text", "toxic").mapInArrow(run, "feature string, n bigint, pos bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


class Rows(NamedTuple):
    """Training rows: labels; features (row, col); counterfactuals, which change features (swap, col) by value -1 or 1."""

    label: np.ndarray
    row: np.ndarray
    col: np.ndarray
    swaps: int
    swap: np.ndarray
    swap_col: np.ndarray
    value: np.ndarray


def fit(rows: Rows, n_features: int, l2: float = 1e-4, fairness: float = 1.0, steps: int = 250) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the log loss and `fairness` times the mean squared change by a counterfactual."""
    n = len(rows.label)
    rate = (rows.label.sum() + 0.5) / (n + 1)
    w = np.zeros(n_features + 1)
    w[-1] = np.log(rate / (1 - rate))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(rows.row, w[rows.col], n) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = np.zeros_like(w)
        error = (p - rows.label) / n
        g[:-1] = np.bincount(rows.col, error[rows.row], n_features) + l2 * w[:-1]
        g[-1] = error.sum()
        if rows.swaps:
            change = changes(rows, w)
            g[:-1] += fairness * 2 / rows.swaps * np.bincount(rows.swap_col, change[rows.swap] * rows.value, n_features)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def changes(rows: Rows, weights: np.ndarray) -> np.ndarray:
    """Change of the log odds by each counterfactual."""
    return np.bincount(rows.swap, weights[rows.swap_col] * rows.value, rows.swaps)


class Model:
    """Selected features with their weights; scores texts."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.index = {x: i for i, x in enumerate(names)}
        self.weights, self.bias = weights.tolist(), bias

    def score(self, values: list[str]) -> list[float]:
        weights = self.weights
        cache = _Cache(lambda w: known_features(w, self.index))
        out = []
        for text in values:
            z = self.bias + sum(weights[i] for i in cache.of(text))
            out.append(1 / (1 + float(np.exp(-max(-30.0, min(30.0, z))))))
        return out


def known_features(word: str, index: dict[str, int]) -> list[int]:
    return [i for f in features(word) if (i := index.get(f)) is not None]


def learned_groups(counts: DataFrame, n: int, pos: float) -> list[tuple[str, ...]]:
    """Groups of words that are about as frequent in toxic texts as in others: the most frequent, neighbours by frequency together."""
    expected = F.col("n") * F.lit(pos / n)
    words = counts.where(~F.col("feature").endswith("*") & (F.length("feature") >= LEAST_LENGTH) & (F.col("n") >= LEAST_TEXTS))
    even = words.where(F.abs(F.col("pos") - expected) <= MOST_DEVIATION * F.sqrt(expected * F.lit(1 - pos / n)))
    few = largest(even.select("feature", "n"), F.col("n"), LEARNED_GROUPS * GROUP_SIZE, "feature").collect()
    names = [r.feature for r in sorted(few, key=lambda r: (-r.n, r.feature))]
    groups = [tuple(names[i : i + GROUP_SIZE]) for i in range(0, len(names), GROUP_SIZE)]
    return [g for g in groups if len(g) > 1]


def training_rows(sample: DataFrame, names: list[str], groups: list[tuple[str, ...]]) -> Rows:
    """The features of the sample's texts, and its counterfactuals: every listed term of a text, swapped for each other term of its group."""
    index = {x: i for i, x in enumerate(names)}
    others = {t: [o for o in g if o != t] for g in groups for t in g}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = _Cache(lambda w: (w,))
        by_word: dict[str, list[int]] = {}
        for batch in pieces(batches):
            cells = []
            for text in batch.column("text").to_pylist():
                words = words_of.of(text)
                uses: Counter[int] = Counter()
                for w in words:
                    if w not in by_word:
                        by_word[w] = known_features(w, index)
                    uses.update(by_word[w])
                sizes, cols, values = [], [], []
                for t in sorted(words & others.keys()):
                    mine = set(known_features(t, index))
                    left = {i for i in mine if uses[i] == 1}
                    for other in others[t]:
                        new = set(known_features(other, index))
                        gone, come = sorted(left - new), sorted(i for i in new - left if not uses[i])
                        sizes.append(len(gone) + len(come))
                        cols += gone + come
                        values += [-1] * len(gone) + [1] * len(come)
                cells.append((np.array(sorted(uses), np.int32), np.array(sizes, np.int32), np.array(cols, np.int32), np.array(values, np.int8)))
            columns = [pa.array([c[k].tobytes() for c in cells], pa.binary()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], names=["toxic", "ids", "sizes", "cols", "vals"])

    found = sample.select("text", "toxic").mapInArrow(run, "toxic double, ids binary, sizes binary, cols binary, vals binary").toPandas()
    ids = [np.frombuffer(x, np.int32) for x in found["ids"]]
    of = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in found[name])])
    sizes = of("sizes", np.int32)
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return Rows(found["toxic"].to_numpy(float), row, np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.intp), len(sizes), np.repeat(np.arange(len(sizes)), sizes), of("cols", np.int32).astype(np.intp), of("vals", np.int8).astype(float))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """text and toxic of at most `most_rows` labelled documents (to the accuracy of a hash), a repeated text once."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col)).cast("double").alias("toxic"))
    share = min(1.0, most_rows / max(1, known.count()))
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = texts(docs, id_col=id_col, text_col=text_col).join(F.broadcast(few), "doc_id")
    return checkpointed(sample.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")))


def prepared(sample: DataFrame, most_features: int) -> tuple[list[str], list[tuple[str, ...]]]:
    """Names of the features and groups of the terms to swap; no names if the sample has texts of one kind only."""
    n, pos = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    if not n or pos in (0, n):
        return [], []
    c = checkpointed(_counts(sample).where("n >= 5"))
    strength = F.abs(F.col("pos") - F.col("n") * F.lit(pos / n)) / F.sqrt(F.col("n") * F.lit(pos / n) + 1.0)
    names = sorted(r.feature for r in largest(c.select("feature", strength.alias("s")), F.col("s"), most_features, "feature").collect())
    groups = [*IDENTITY_GROUPS, *learned_groups(c, n, pos)]
    return list(dict.fromkeys([*names, *(f for g in groups for t in g for f in features(t))])), groups


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = MOST_TRAINING_ROWS, most_features: int = MOST_FEATURES, fairness: float = 1.0) -> Model:
    """A model from `labels` (id and 0/1), of which `most_rows` are taken at most.

    Null ids or labels are left out, of repeated labels the highest counts, and texts that repeat train once.
    Without labelled texts of both kinds the model is the smoothed base rate."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, most_rows)
    names, groups = prepared(sample, most_features)
    rows = training_rows(sample, names, groups)
    weights, bias = fit(rows, len(names), fairness=fairness, steps=250 if names else 0)
    return Model(names, weights, bias)


def toxicity_scores(docs: DataFrame, model: Model, *keep: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text, repeated rows and null ids included; a null or empty text has the score of the bias."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [batch.column("doc_id"), pa.array(model.score(batch.column("text").to_pylist()), pa.float64())]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(texts(docs, id_col=id_col, text_col=text_col), run, f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, cutoff: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose score is below the cutoff, all columns kept.

    Repeated rows are scored alike; a null or empty text has the score of the bias."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            values = batch.column(names.index(text_col)).to_pylist()
            yield batch.filter(pa.array([s < cutoff for s in model.score([x or "" for x in values])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
