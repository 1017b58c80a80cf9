"""Sentiment rules of sentences against a plain computation, one sentence at a time."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sentiment as S

LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -2.0, "kind": 2.4, "sad": -2.1, ":)": 2.0, "least": 0.0, "very": 0.5}
SENTENCES = [
    "", None, "plain words only here", "good", "Good!", "good!!!!!!", "Is it good??", "good ?????", "not good", "never so good", "never this very good", "It is not a very good day", "GREAT day but bad night",
    "GREAT DAY", "The food is REALLY great, the bar AWFUL!", "very very good", "barely good", "kind of good", "a kind man", "at least good", "least good", "the least good", "very least good", "isn't bad", "I can't say good things",
    "sad, but not awful... 'good'", "but good but bad", "so good", "so what good", "x y good", "face :) here", "hugely bad", "EXTREMELY bad indeed", "without any good", "good bad good bad", "\t good\nbad \x0b great ", "never was it this good", "straße GOOD ß",
]


def plain(text):
    """Score, and shares of words up, down and even."""
    text = text or ""
    words = []
    for w in re.split(r"[\x20\x09-\x0D]+", text):
        if len(w) > 1:
            bare = re.sub(r"""^[.,;:!?"'\-]+|[.,;:!?"'\-]+$""", "", w)
            words.append(bare if len(bare) > 1 else w)
    low = [w.lower() for w in words]
    caps = [w.isupper() for w in words]
    mixed = 0 < sum(caps) < len(words)
    boosts = {w: S.BOOST for w in S.STRONGER} | {w: -S.BOOST for w in S.WEAKER}
    negates = lambda w: w in S.NEGATIONS or "n't" in w
    found = []
    for i, w in enumerate(low):
        if w not in LEXICON or w in boosts or w == "kind" and low[i + 1 : i + 2] == ["of"]:
            found.append(0.0)
            continue
        x = LEXICON[w]
        if caps[i] and mixed:
            x += 0.733 if x > 0 else -0.733
        for k in (1, 2, 3):
            if i >= k and low[i - k] not in LEXICON:
                if low[i - k] in boosts:
                    s = boosts[low[i - k]] * (-1 if x < 0 else 1)
                    if caps[i - k] and mixed:
                        s += 0.733 if x > 0 else -0.733
                    x += s * (1, 0.95, 0.9)[k - 1]
                if k == 2 and low[i - 2] == "never" and low[i - 1] in ("so", "this"):
                    x *= 1.5
                elif k == 3 and (low[i - 3] == "never" and low[i - 2] in ("so", "this") or low[i - 1] in ("so", "this")):
                    x *= 1.25
                elif negates(low[i - k]):
                    x *= -0.74
        if i and low[i - 1] == "least" and "least" not in LEXICON and (i < 2 or low[i - 2] not in ("at", "very")):
            x *= -0.74
        found.append(x)
    if "but" in low:
        at = low.index("but")
        found = [x * (0.5 if i < at else 1.5 if i > at else 1) for i, x in enumerate(found)]
    marks = min(text.count("!"), 4) * 0.292
    asked = text.count("?")
    marks += 0.96 if asked > 3 else asked * 0.18 if asked > 1 else 0
    total, up, down, even = sum(found), sum(x + 1 for x in found if x > 0), sum(1 - x for x in found if x < 0), sum(x == 0 for x in found)
    total += marks if total > 0 else -marks if total < 0 else 0
    up, down = up + marks * (up > down), down + marks * (down > up)
    whole = up + down + even
    return (total / math.sqrt(total * total + 15), *((x / whole if whole else 0.0) for x in (up, down, even)))


@pytest.mark.parametrize("least", [True, False])
@pytest.mark.parametrize("most_broadcast", [0, 1000])
def test_sentences(spark, monkeypatch, least, most_broadcast):
    if not least:
        monkeypatch.delitem(LEXICON, "least")
    lexicon = spark.createDataFrame([*LEXICON.items(), ("GOOD", 1.0)], "word string, value double")
    rows = [(i, s, SENTENCES[-i]) for i, s in enumerate(SENTENCES)]
    df = spark.createDataFrame(rows, "id bigint, headline string, description string").withColumns({"value": F.lit(1), "word": F.lit("x")})
    got = {r.id: r for r in S.sentence_sentiment(df, lexicon, most_broadcast=most_broadcast).collect()}
    assert len(got) == len(rows)
    for i, head, text in rows:
        score, up, down, even = plain(head)
        want = (score, plain(text)[0], up, down, even)
        assert tuple(got[i])[1:] == pytest.approx(want, abs=1e-12), (head, text)


def test_one_exchange_on_the_key_and_empty_table(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, value double")
    df = spark.createDataFrame([], "id bigint, headline string, description string")
    out = S.sentence_sentiment(df, lexicon)
    assert out.count() == 0 and out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(id") == 1


def test_lexicon_of_labels(spark):
    docs = spark.createDataFrame([(i, "Good day" if i % 2 else "bad day, bad") for i in range(20)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    assert dict(S.label_lexicon(docs, labels, F.col("quality") == 1).collect()) == {"good": 4.0, "bad": -4.0}


def test_token_vectors_are_capped_and_pooled(spark):
    from tidemark.operators import news as N

    df = spark.createDataFrame([(1, "a bb ccc dddd"), (2, ""), (3, None), (4, "xx"), (5, "y " * 300)], "id int, headline string")
    encoder = lambda: (str.split, lambda lists: [[[float(len(w)), 1.0] for w in t] for t in lists])
    got = lambda **k: {r.id: r.embedding for r in N.embed_tokens(df, encoder, most_tokens=3, batch=2, **k).collect()}
    assert got(pooling="mean") == {1: [2.0, 1.0], 2: None, 3: None, 4: [2.0, 1.0], 5: [1.0, 1.0]}
    assert got() == {1: [1.0, 1.0], 2: None, 3: None, 4: [2.0, 1.0], 5: [1.0, 1.0]}
    with pytest.raises(ValueError):
        got(pooling="max")


def test_words_of_short_lexicons_never_become_rows(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, value double")
    df = spark.createDataFrame([(1, "GREAT day but never so bad", "x", "good")], "id bigint, headline string, ticker string, description string")
    out = S.sentence_sentiment(df, lexicon, keep=("ticker",))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Generate") == 1  # the two texts of an article
    r = out.first()
    assert r.ticker == "x" and r.headline_sentiment == pytest.approx(plain("GREAT day but never so bad")[0], abs=1e-12)


def test_rolled_up_news_are_scored_once(spark):
    from tidemark.operators import news as N

    seen = spark.sparkContext.accumulator(0)

    def scored(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame([(i, "t", f"h{i}", 0.5) for i in range(6)], "id bigint, ticker string, headline string, description_sentiment double").withColumn("date", F.lit("2024-01-01").cast("date"))
    out = N.news_features([df], lambda rows: rows.mapInPandas(scored, rows.schema), lambda rows: rows.withColumn("embedding", F.array(F.col("id").cast("double"))), aggregate=True)
    r = out.first()
    assert (r.news_count, r.sentiment_mean, r.embedding) == (6, 0.5, [2.5]) and seen.value == 6
