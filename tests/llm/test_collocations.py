"""Collocation mining against a plain count of all phrases, and its SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations as c
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id bigint, text string, lang string"


def plain(rows, most, least, longest=5):
    """The contract, word for word."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    frequent = {k: v for k, v in f.items() if v >= least}
    inside = {}
    for (lang, p), v in frequent.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[lang, p[i : i + m]] = max(v, inside.get((lang, p[i : i + m]), 0))
    out = {}
    for (lang, p), a in frequent.items():
        if len(p) > 1 and 100 * inside.get((lang, p), 0) < 100 * a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1)}


def invented(n, seed):
    """Texts of few words, some of which stand together; one language holds most of them."""
    random = np.random.default_rng(seed)
    words = [f"{x}{y}" for x in "abcdefgé" for y in ("", "o", "U")]
    weight = 1 / np.arange(1, len(words) + 1)
    fixed = ["New York City Hall steps down", "ex post facto", "of the people by the people", "né ça Là"]
    rows = []
    for i in range(n):
        parts = [str(random.choice(words, p=weight / weight.sum())) if random.random() < 0.9 else str(random.choice(fixed)) for _ in range(random.integers(0, 60))]
        text = "".join(p + str(random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "])) for p in parts)
        rows.append((i, text, str(random.choice(["en", "en", "en", "de", "fr"]))))
    return rows


ODD = [(1, None, "en"), (2, "", "en"), (3, "..!?", None), (4, "a b " * 40, None), (5, "a b " * 40, "und"), (6, "x y z " * 3000, "de"), (7, "\x00 \x1f \x00 \x1f " * 20, "xx"), (8, "p q r s" * 9, "xx")]


def check(spark, rows, most, least, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("p", "f", "code", "n", "a", "score", "words", "at"):
        df = df.withColumn(name, F.lit("other"))
    got = c.collocations(df, most, least, **more).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain(rows, most, least)


@pytest.mark.parametrize("most,least", [(8, 4), (40, 3), (2000, 5), (1, 20)])
def test_equals_plain_counts(spark, most, least):
    check(spark, invented(250, most), most, least)


def test_odd_rows_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 500)
    monkeypatch.setattr(c, "HELD", 50)
    monkeypatch.setattr(c, "RANGE", 10)
    check(spark, ODD + invented(60, 1) + ODD[3:5], 20, 3, share=0.05)


def test_full_bitmaps_mark_too_much_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(c, "BITS", 16)
    check(spark, invented(150, 7), 15, 3)


def test_empty_table_and_no_frequent_word(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert c.collocations(spark.createDataFrame(ODD[:3], SCHEMA)).collect() == []


def test_ties_at_the_last_rank_go_to_more_occurrences_then_bytes(spark):
    rows = [(i, f"{w} {v}", "en") for i, (w, v) in enumerate([("a", "b"), ("c", "d"), ("e", "f"), ("g", "h")] * 6)] + [(99, "z", "en")]
    check(spark, rows, 2, 3)


def test_codes_that_collide_are_salted_anew(spark, monkeypatch):
    real = c.word_counts
    monkeypatch.setattr(c, "word_counts", lambda chunks, least, salt: real(chunks, least, salt) if salt else None)
    check(spark, invented(80, 3), 10, 3)


def test_code_of_a_word_is_the_same_in_spark(spark):
    row = spark.createDataFrame([("de", "größe")], "lang string, w string").select(F.xxhash64(F.concat(F.lit("7:"), F.length("lang").cast("string"), F.lit(":"), "lang", F.lit(":"), "w"))).first()
    assert c._encoded("de", ["größe".encode()], 7)[2].tolist() == [row[0]]


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    got = QUERIES["op12_collocations"](spark, "/root/testdata/sf0.01")
    wanted = con.sql(ORACLES["op12_collocations"])
    assert sorted(got.columns) == sorted(wanted.columns)
    wanted = wanted.select(", ".join(got.columns)).fetchall()
    assert wanted and sorted(map(tuple, got.collect())) == sorted(wanted)
