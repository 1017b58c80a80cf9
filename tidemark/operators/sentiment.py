"""Sentiment of sentences from a lexicon of word values and the rules of the words around them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.storage import checkpointed

# Fixed values of the published rules: words that strengthen or weaken the next ones, words that negate, and their weights.
STRONGER = "absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously flipping frackin fricking friggin fully greatly hella highly hugely incredible incredibly intensely major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very".split()
WEAKER = "almost barely hardly kinda less little marginal marginally occasional occasionally partly scarce scarcely slight slightly somewhat sorta".split()
NEGATIONS = "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite".split()
BOOST, CAPITALS, NEGATED = 0.293, 0.733, -0.74
#: Weight of a strengthening word one, two and three places before, and factors of never so / never this there.
DECAY, NEVER_SO = (1.0, 0.95, 0.9), (None, 1.5, 1.25)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS, QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.292, 4, 0.18, 3, 0.96
NORM = 15.0

#: Lexicon rows that are broadcast; a longer lexicon is joined by shuffle.
MOST_BROADCAST = 500_000
#: Distinct words that a task remembers, and counts, at most.
MOST_HELD = 200_000
SPACE, MARKS = r"[\x20\x09-\x0D]+", r"""[.,;:!?"'\-]+"""
ENDS = """.,;:!?"'-"""
#: Words that rules name, beside those that strengthen, weaken or negate.
NAMED = frozenset(("but", "kind", "of", "least", "at", "very", "never", "so", "this"))


def words_of(text: Column) -> Column:
    """Words between white space without marks at their ends; single characters go, and what is marks only stays (a face)."""
    bare = lambda w: F.regexp_replace(w, f"^{MARKS}|{MARKS}$", "")
    raw = F.filter(F.split(text, SPACE), lambda w: F.length(w) > 1)
    return F.transform(raw, lambda w: F.when(F.length(bare(w)) > 1, bare(w)).otherwise(w))


def in_capitals(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the strength of a text."""
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    asked = F.when(count("?") > MOST_QUESTIONS, MANY_QUESTIONS).when(count("?") > 1, count("?") * QUESTION).otherwise(0.0)
    return F.least(count("!"), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + asked


def word_rules(lexicon: DataFrame) -> DataFrame:
    """word, value, boost and negates: a row a word of the lexicon or of the rules."""
    rules = [(w, BOOST, False) for w in STRONGER] + [(w, -BOOST, False) for w in WEAKER] + [(w, None, True) for w in NEGATIONS]
    rules = lexicon.sparkSession.createDataFrame(rules, "word string, boost double, negates boolean")
    values = lexicon.select(F.lower("word").alias("word"), F.col("value").cast("double").alias("value")).groupBy("word").agg(F.max("value").alias("value"))
    return values.join(rules, "word", "full").select("word", "value", "boost", F.coalesce("negates", F.lit(False)).alias("negates"))


def _valued(words: DataFrame, key: str) -> DataFrame:
    """The words with `x`, their value after the rules; words of no value have 0."""
    w = Window.partitionBy(key, "part").orderBy("place")
    low = lambda k: F.coalesce(F.lag("low", k).over(w), F.lit(""))
    for k in (1, 2, 3):
        words = words.withColumns({f"low{k}": low(k), f"boost{k}": F.lag("boost", k).over(w), f"not{k}": F.coalesce(F.lag("negates", k).over(w), F.lit(False)), f"plain{k}": F.coalesce(F.lag(F.col("value").isNull(), k).over(w), F.lit(False)), f"caps{k}": F.coalesce(F.lag("caps", k).over(w), F.lit(False))})
    words = words.withColumn("next", F.coalesce(F.lead("low").over(w), F.lit("")))
    strong = F.col("caps") & F.col("mixed")
    words = words.withColumn("x", F.col("value") + F.when(strong, F.when(F.col("value") > 0, CAPITALS).otherwise(-CAPITALS)).otherwise(0.0))
    so = lambda k: F.col(f"low{k}").isin("so", "this")
    for k in (1, 2, 3):
        boost = F.when(F.col("x") < 0, -F.col(f"boost{k}")).otherwise(F.col(f"boost{k}"))
        boost += F.when(F.col(f"caps{k}") & F.col("mixed"), F.when(F.col("x") > 0, CAPITALS).otherwise(-CAPITALS)).otherwise(0.0)
        # the factor must see the strengthened value, the strengthening the sign from before
        words = words.withColumn("x", F.when(F.col(f"plain{k}"), F.col("x") + F.coalesce(boost * DECAY[k - 1], F.lit(0.0))).otherwise(F.col("x")))
        factor = F.when(F.col(f"not{k}"), NEGATED).otherwise(1.0)
        if k == 2:
            factor = F.when((F.col("low2") == "never") & so(1), NEVER_SO[1]).otherwise(factor)
        if k == 3:
            factor = F.when((F.col("low3") == "never") & so(2) | so(1), NEVER_SO[2]).otherwise(factor)
        words = words.withColumn("x", F.when(F.col(f"plain{k}"), F.col("x") * factor).otherwise(F.col("x")))
    least = F.col("plain1") & (F.col("low1") == "least") & ~F.col("low2").isin("at", "very")
    valued = F.col("value").isNotNull() & F.col("boost").isNull() & ~((F.col("low") == "kind") & (F.col("next") == "of"))
    words = words.withColumn("x", F.when(valued, F.when(least, F.col("x") * NEGATED).otherwise(F.col("x"))).otherwise(0.0))
    halves = F.when((F.col("but") >= 0) & (F.col("place") < F.col("but")), BEFORE_BUT).when((F.col("but") >= 0) & (F.col("place") > F.col("but")), AFTER_BUT).otherwise(1.0)
    return words.withColumn("x", F.col("x") * halves)


def _joined(rows: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part, score, up, down and even of every text, its words joined with a long lexicon."""
    key = keys[0]
    rows = rows.withColumn("words", words_of(F.col("text")))
    loud = F.size(F.filter("words", in_capitals))
    # what holds for a whole text is made before its words become rows, as Spark would make it for every row
    rows = rows.select(*keys, "part", emphasis(F.col("text")).alias("emphasis"), ((loud > 0) & (loud < F.size("words"))).alias("mixed"), (F.array_position(F.transform("words", F.lower), "but").cast("int") - 1).alias("but"), "words")
    rows = rows.select(*keys, "part", "emphasis", "mixed", "but", F.posexplode_outer("words").alias("place", "word"))
    rows = rows.withColumns({"low": F.lower("word"), "caps": in_capitals(F.col("word"))})
    rows = rows.join(rules.withColumnRenamed("word", "low"), "low", "left").withColumn("negates", F.coalesce("negates", F.lit(False)) | F.coalesce(F.col("low").contains("n't"), F.lit(False)))
    words = _valued(rows.repartition(key), key)
    sums = {"total": F.sum("x"), "up": F.sum(F.when(F.col("x") > 0, F.col("x") + 1).otherwise(0.0)), "down": F.sum(F.when(F.col("x") < 0, 1 - F.col("x")).otherwise(0.0)), "even": F.count(F.when((F.col("x") == 0) & F.col("word").isNotNull(), 1)).cast("double")}
    found = words.groupBy(*keys, "part", "emphasis").agg(*[c.alias(n) for n, c in sums.items()])
    total = F.col("total") + F.signum("total") * F.col("emphasis")
    up = F.col("up") + F.when(F.col("up") > F.col("down"), F.col("emphasis")).otherwise(0.0)
    down = F.col("down") + F.when(F.col("up") < F.col("down"), F.col("emphasis")).otherwise(0.0)
    return found.select(*keys, "part", (total / F.sqrt(total * total + NORM)).alias("score"), up.alias("up"), down.alias("down"), "even")


class _Words(dict):
    """Words by their bytes: lower case, in capitals, value, boost, whether it negates, and whether a rule asks for it; None for single characters."""

    def __init__(self, rules: dict[str, tuple]):
        self.rules = rules

    def __missing__(self, raw: bytes) -> tuple | None:
        found, word = None, raw.decode("utf-8", "replace")
        if len(word) > 1:
            bare = word.strip(ENDS)
            word = bare if len(bare) > 1 else word
            low = word.lower()
            value, boost, negates = self.rules.get(low, (None, None, False))
            caps, negates = word == word.upper() and word != low, negates or "n't" in low
            found = (low, caps, value, boost, negates, caps or negates or boost is not None or low in NAMED)
        self[raw] = found
        return found

    def of(self, text: bytes) -> list[tuple]:
        """The words of a text, as `words_of` finds them: bytes are split at the same white space."""
        if len(self) > MOST_HELD:
            self.clear()
        return [w for w in map(self.__getitem__, text.split()) if w is not None]


def _value_at(words: list[tuple], i: int, mixed: bool) -> float:
    """A valued word's part in the sum, before what `but` does to it: the rules of `_valued`."""
    low, caps, x, boost = words[i][:4]
    if boost is not None or low == "kind" and i + 1 < len(words) and words[i + 1][0] == "of":
        return 0.0
    if caps and mixed:
        x += CAPITALS if x > 0 else -CAPITALS
    low1, low2, low3 = (words[i - k][0] if i >= k else "" for k in (1, 2, 3))
    for k in range(1, min(i, 3) + 1):
        _, before_caps, value, boost, negates, _ = words[i - k]
        if value is not None:
            continue
        if boost is not None:
            step = -boost if x < 0 else boost
            if before_caps and mixed:
                step += CAPITALS if x > 0 else -CAPITALS
            x += step * DECAY[k - 1]
        if k == 2 and low2 == "never" and low1 in ("so", "this"):
            x *= NEVER_SO[1]
        elif k == 3 and (low3 == "never" and low2 in ("so", "this") or low1 in ("so", "this")):
            x *= NEVER_SO[2]
        elif negates:
            x *= NEGATED
    return x * NEGATED if low1 == "least" and words[i - 1][2] is None and low2 not in ("at", "very") else x


def _scores(words: list[tuple], text: bytes) -> tuple[float, float, float, float]:
    """score, up, down and even of a text."""
    asked_for = [i for i, w in enumerate(words) if w[5]]
    if asked_for:
        mixed = 0 < sum([w[1] for w in words]) < len(words)
        near = {i + d for i in asked_for for d in (-1, 0, 1, 2, 3)}  # any other word has its own value
        but = next((i for i in asked_for if words[i][0] == "but"), -1)
        halves = lambda i: 1.0 if but < 0 or i == but else BEFORE_BUT if i < but else AFTER_BUT
        values = [(_value_at(words, i, mixed) if i in near else w[2]) * halves(i) for i, w in enumerate(words) if w[2] is not None]
    else:
        values = [w[2] for w in words if w[2] is not None]
    above, below = [x for x in values if x > 0], [x for x in values if x < 0]
    total, up, down = sum(values, 0.0), sum(above, 0.0) + len(above), len(below) - sum(below, 0.0)
    even = len(words) - len(above) - len(below)
    asked = text.count(b"?")
    marks = min(text.count(b"!"), MOST_EXCLAMATIONS) * EXCLAMATION + (MANY_QUESTIONS if asked > MOST_QUESTIONS else asked * QUESTION if asked > 1 else 0.0)
    total += marks if total > 0 else -marks if total < 0 else 0.0
    up, down = up + (marks if up > down else 0.0), down + (marks if up < down else 0.0)
    return total / math.sqrt(total * total + NORM), up, down, float(even)


def _in_place(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """What `_joined` gives, each text scored where it stands: words never become rows. Every task holds the rules."""
    known = {r.word: (r.value, r.boost, r.negates) for r in rules.where("word is not null").toLocalIterator()}
    shared = rows.sparkSession.sparkContext.broadcast(known)
    kept = [f for f in rows.schema if f.name != "text"]
    names = ["score", "up", "down", "even"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Words(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            found = [_scores(held.of(t), t) for start in range(0, len(texts), 256) for t in texts.slice(start, 256).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [pa.array([x[i] for x in found], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + names)

    return rows.mapInArrow(run, StructType([*kept, *[StructField(n, DoubleType()) for n in names]]))


def sentence_sentiment(df: DataFrame, lexicon: DataFrame, headline: str = "headline", description: str = "description", key: str = "id", most_broadcast: int = MOST_BROADCAST, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to keep, headline_sentiment, description_sentiment (-1 to 1), and sentiment_positive, _negative and _neutral, the shares of the headline's words.

    A word has the value of the lexicon (word, value; the highest of repeated words). Strengthening words up to three places before
    add to it, less the farther they are; negations turn it; words in capitals count more in a text that is not all in capitals; what
    stands before the first `but` counts half, what follows half as much again; exclamation and question marks strengthen the whole. Both texts
    go through one plan with one exchange on the key, which is unique, of scores only unless the lexicon is long; a null text is empty and an empty one scores 0. Values are not rounded.
    Idioms of several words are not looked up."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.coalesce(F.col(c), F.lit("")).alias("text")) for p, c in (("h", headline), ("d", description))])
    rows = df.select(key, *keep, F.explode(parts).alias("p")).select(key, *keep, "p.part", "p.text")
    rules = checkpointed(word_rules(lexicon))
    found = _in_place(rows, rules) if rules.count() <= most_broadcast else _joined(rows, rules, [key, *keep])
    of = lambda part, c: F.max(F.when(F.col("part") == part, c))
    share = lambda c: of("h", F.coalesce(F.try_divide(F.col(c), reduce(Column.__add__, map(F.col, ("up", "down", "even")))), F.lit(0.0)))
    return found.groupBy(key, *keep).agg(of("h", F.col("score")).alias("headline_sentiment"), of("d", F.col("score")).alias("description_sentiment"), share("up").alias("sentiment_positive"), share("down").alias("sentiment_negative"), share("even").alias("sentiment_neutral"))


def label_lexicon(docs: DataFrame, labels: DataFrame, good: Column, least_texts: int = 5, least_value: float = 0.5, key: str = "doc_id") -> DataFrame:
    """word and value (-4 to 4): how much more often a word stands in texts with a good label than in others, in at least `least_texts` of them.

    Words whose value is closer to 0 than `least_value` carry none and are left out. Counted over all labelled texts; each counts a word once."""
    kind = labels.groupBy(key).agg(F.max(F.when(good, 1).otherwise(0)).alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = _Words({}), (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(counts[0] | counts[1])
            out = [pa.array(words, pa.string()), *[pa.array([counts[i][w] for w in words], pa.int64()) for i in (1, 0)]]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(out, names=["word", "g", "b"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for good, text in ((g, t) for start in range(0, len(texts), 256) for g, t in zip(*(c.slice(start, 256).to_pylist() for c in (batch.column(0), texts)))):
                counts[good].update({w[0] for w in held.of(text)})
                if len(counts[0]) + len(counts[1]) > MOST_HELD:
                    yield flush()
        yield flush()

    seen = docs.join(kind, key).select("good", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word string, g bigint, b bigint")
    whole = kind.join(docs.select(key).distinct(), key).agg(F.sum("good").alias("all_good"), F.sum(1 - F.col("good")).alias("all_bad"))
    counts = seen.groupBy("word").agg(F.sum("g").alias("g"), F.sum("b").alias("b")).where(F.col("g") + F.col("b") >= least_texts)
    up, down = F.col("g") * F.col("all_bad"), F.col("b") * F.col("all_good")
    value = F.try_divide(4.0 * (up - down), up + down)
    return counts.crossJoin(F.broadcast(whole)).select("word", value.alias("value")).where(F.abs("value") >= least_value)
