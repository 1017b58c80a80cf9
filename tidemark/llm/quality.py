"""Quality rules with risk-controlled thresholds.

Rules reject a document whose measure exceeds a cutoff. Cutoffs come from labelled holdouts: in each stratum several
fixed sequences of rules from lenient to strict are tested, one for each measure alone and one that moves the cutoffs of all measures
together. A rule passes if the exact (Clopper-Pearson) upper bound of the share of good documents it rejects is at most
`risk`; the first that fails ends its sequence. The error level is divided by the number of sequences of all strata
(Bonferroni), so with probability 1 - `error` every rule that passed, and so whichever is chosen, rejects at most `risk` of its
stratum's good documents among those that pass the base rules. Of the last rules passed, the one that rejects most bad
holdout documents is used. A text that repeats is one trial.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, compact, map_arrow, texts

SYMBOLS = b"#*$%&|<>"
#: Levels of a sequence, and each measure's cutoffs at the first and the last; those between are in geometric progression.
LEVELS = 12
RANGES = {"symbol_share": (0.5, 0.02), "repeat_share": (0.19, 0.02), "dup_line_share": (0.9, 0.1), "capital_share": (0.9, 0.12), "shortness": (0.09, 0.025), "digit_share": (0.6, 0.06)}
CUTOFFS = {m: [a * (b / a) ** (i / (LEVELS - 1)) for i in range(LEVELS)] for m, (a, b) in RANGES.items()}
#: Measures that each sequence moves, the widest first.
SEQUENCES = {"all": tuple(RANGES), **{m: (m,) for m in RANGES}}


def _measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - (len(data) - len(data.translate(None, _SPACE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n > 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            reach = 0
            for i, x in enumerate(windows):
                if seen[x] > 1:
                    repeated += i + 5 - max(i, reach)
                    reach = i + 5
    return n, chars, symbols, dup, repeated, len(lines), capitals, digits


_CAPITALS = bytes(range(65, 91))
_SPACE = b" \t\n\x0b\x0c\r"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_digits"]


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, text_hash and the counts of each whole text: words, their code points, symbols of `[#*$%&|<>]`,
    lines with a word that equal an earlier one, words in five-word windows found twice or more, lines with a
    word, capitals A-Z, digits. A row for each row; a null text is empty, a null stratum is 'none'."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [_measure(x) for x in batch.column("text").to_pylist()]
        return [*(batch.column(c) for c in ("doc_id", "stratum", "text_hash")), *(pa.array(x, pa.int64()) for x in zip(*found))]

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(id_col, text_col, F.coalesce(F.col(stratum_col).cast("string"), F.lit("none")).alias("__stratum"))
    rows = texts(named, "__stratum", id_col=id_col, text_col=text_col).withColumnRenamed("__stratum", "stratum").withColumn("text_hash", F.xxhash64("text"))
    return map_arrow(rows, run, f"doc_id {kind}, stratum string, text_hash bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def shares() -> dict[str, Column]:
    """The measures that cutoffs apply to, from the counts; all rise as quality falls."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbol_share": ratio("n_symbols", "word_chars"),
        "repeat_share": ratio("n_repeat_words", "n_words"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "capital_share": ratio("n_capitals", "word_chars"),
        "shortness": F.when(F.col("n_words") > 0, 1.0 / F.col("n_words")).otherwise(1.0),
        "digit_share": ratio("n_digits", "word_chars"),
    }


def binomial_upper(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the p at which a count of at most k in n has probability `error`."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def tail(p: float) -> float:
        a, b = math.log(p), math.log1p(-p)
        terms = [c + i * a + (n - i) * b for i, c in enumerate(logs)]
        top = max(terms)
        return math.exp(top) * sum(math.exp(t - top) for t in terms)

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if mid >= 1 or tail(mid) <= error:
            high = mid
        else:
            low = mid
    return high


def first_levels() -> dict[str, Column]:
    """For each sequence the first level whose rule rejects, LEVELS if none does: cutoffs fall, so all stricter levels reject too."""
    share = shares()
    of = lambda m: F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS[m]]), lambda c: c >= share[m]))
    return {s: F.least(*map(of, names)) if len(names) > 1 else of(names[0]) for s, names in SEQUENCES.items()}


def select_rules(counts: list[dict], risk: float, error: float, strata: int | None = None) -> dict[str, tuple[str, int]]:
    """The chosen rule (sequence and level) by stratum; strata where none passes are left out. counts: rows with stratum, n good
    documents and, by name good_sequence_level and bad_sequence_level, how many good and bad ones that rule rejects. strata: how many
    are tested in all, if not these."""
    level = error / max(1, (strata or len(counts)) * len(SEQUENCES))
    chosen: dict[str, tuple[str, int]] = {}
    for row in counts:
        last: dict[str, int] = {}
        for name in SEQUENCES:
            for i in range(LEVELS):
                if binomial_upper(row[f"good_{name}_{i}"], row["n"], level) > risk:
                    break
                last[name] = i
        if last:
            name = max(last, key=lambda s: row[f"bad_{s}_{last[s]}"])
            chosen[row["stratum"]] = (name, last[name])
    return chosen


def holdout_levels(measured: DataFrame, labels: DataFrame, id_col: str, quality_col: str) -> DataFrame:
    """stratum, quality, sequence, level and n: how many different texts that pass the base rules are first rejected at a level of each sequence.

    A text with any label 0 is bad."""
    known = labels.where(F.col(quality_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(F.col(quality_col)).alias("quality"))
    trials = measured.where(~base_failed()).join(known, "doc_id")
    trials = trials.groupBy("stratum", "text_hash").agg(F.min("quality").alias("quality"), *[F.first(c).alias(c) for c in _COUNTS])
    firsts = F.array(*[F.struct(F.lit(s).alias("sequence"), level.alias("level")) for s, level in first_levels().items()])
    each = trials.select("stratum", "quality", F.explode(firsts).alias("f"))
    return each.groupBy("stratum", "quality", "f.sequence", "f.level").agg(F.count("*").alias("n"))


def chosen_rules(levels: DataFrame, risk: float, error: float) -> DataFrame:
    """stratum, sequence and level of the rule that each stratum gets; a stratum is one group of a row a level at most."""
    strata = levels.select("stratum").distinct().count()

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        row: dict = {"stratum": rows["stratum"].iloc[0], "n": int(rows.loc[(rows.quality == 1) & (rows.sequence == "all"), "n"].sum())}
        for q, name in ((1, "good"), (0, "bad")):
            for s in SEQUENCES:
                own = rows[(rows.quality == q) & (rows.sequence == s)]
                row |= {f"{name}_{s}_{i}": int(own.loc[own.level <= i, "n"].sum()) for i in range(LEVELS)}
        found = select_rules([row], risk, error, strata)
        return pd.DataFrame([(k, *v) for k, v in found.items()], columns=["stratum", "sequence", "level"])

    return levels.groupBy("stratum").applyInPandas(choose, "stratum string, sequence string, level int")


def base_failed() -> Column:
    """Fewer than 10 words, or over 20 % of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def quality_filter(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", quality_col: str = "quality", risk: float = 0.03, error: float = 0.05, most_broadcast: int = 100_000
) -> DataFrame:
    """doc_id, counts, base_failed and kept for each row of `docs`.

    Every value of `stratum_col` is a stratum. base_failed: fewer than 10 words, or over 20 % of words in repeated windows. kept: not
    base_failed and not rejected by its stratum's rule; a stratum with too few labels to bound the
    risk gets none. Labels of unknown documents, null labels and repeated labels of a document (any
    label 0 makes it bad) do no harm; without labels only the base rules act. Repeated rows each come out and are one trial."""
    measured = checkpointed(quality_measures(docs, id_col, text_col, stratum_col))
    rules = compact(chosen_rules(checkpointed(holdout_levels(measured, labels, id_col, quality_col)), risk, error))
    rules = F.broadcast(rules) if rules.count() <= most_broadcast else rules
    first = F.coalesce(*[F.when(F.col("sequence") == s, level) for s, level in first_levels().items()])
    kept = ~base_failed() & (F.col("level").isNull() | (first > F.col("level")))
    measured = measured.join(rules, "stratum", "left")
    return measured.select("doc_id", *_COUNTS, base_failed().alias("base_failed"), kept.alias("kept"))
