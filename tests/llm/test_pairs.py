"""Operators that hold stated rows against all rows: brute force over random and odd tables."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import tiles
from tidemark.llm.negatives import Heaps, hard_negatives, strassen
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.topk import Lists, exact_top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _rows(n, seed=0, width=6, hot=0):
    """Random vectors of few values, so that scores tie; the first `hot` are equal."""
    random = np.random.default_rng(seed)
    values = random.integers(-4, 5, (n, width)) / 4
    values[:hot] = values[0]
    return [(int(i), [float(x) for x in v], int(random.integers(0, 3))) for i, v in enumerate(values)]


def _odd(n):
    nan, inf = float("nan"), float("inf")
    rows = _rows(n, 1)
    rows += [rows[0], rows[50], (None, [1.0] * 6, 1), (100, None, 1), (n + 1, [nan] * 6, 1), (n + 2, [inf] * 6, 1), (n + 3, [None, 1.0], 0), (n + 4, [], 0), (n + 5, [0.5, 1.0], 1), (n + 6, [1.0] * 6, None), (n + 7, [1.0] * 9, 2)]
    return rows


def _plain(rows, scale, labels=False):
    """Each id's integer vector, as the contract says."""
    out = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector) or labels and label is None:
            continue
        own = ([int(np.floor(scale * x)) for x in vector], label)
        out[vec_id] = min(out.get(vec_id, own), own)
    return out


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def _top(rows, k, every=10):
    own = _plain([(i, v, 0) for i, v, _ in rows], 1024)
    out = set()
    for q in own:
        if q % every == 0:
            best = sorted((-_dot(own[q][0], v), i) for i, (v, _) in own.items() if i != q)[:k]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


def _mined(rows, every=10):
    own = _plain(rows, 256, labels=True)
    out = set()
    for a in own:
        if a % every == 0:
            scores = [(-_dot(own[a][0], v), i, label) for i, (v, label) in own.items() if i != a]
            for ps, p, _ in sorted(x for x in scores if x[2] == own[a][1])[:5]:
                near = sorted(x for x in scores if x[2] != own[a][1] and 50 * -ps <= 100 * -x[0] <= 95 * -ps)[:3]
                out |= {(a, p, rank, i, -ps, -s) for rank, (s, i, _) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("rows", [_rows(300), _rows(300, 2, hot=120), _odd(120), _rows(3), []], ids=["random", "copies", "odd", "few", "empty"])
def test_top_k_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(tiles, "WORTH", 50)
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=7).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == _top(rows, 7)


@pytest.mark.parametrize("rows", [_rows(300), _rows(300, 2, hot=120), _odd(120), _rows(3), []], ids=["random", "copies", "odd", "few", "empty"])
def test_hard_negatives_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(tiles, "WORTH", 50)
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == _mined(rows)


def test_blocks_of_queries_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(tiles, "BLOCK", 4)
    monkeypatch.setattr(tiles, "WORTH", 50)
    rows = _rows(200, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "x", "asked", "share", "block", "score", "rank", "row", "positive_id"):
        df = df.withColumn(name, F.lit("other"))
    assert {tuple(r) for r in exact_top_k(df, F.col("vec_id") % 10 == 0, k=7).collect()} == _top(rows, 7)
    assert {tuple(r) for r in hard_negatives(df, F.col("vec_id") % 10 == 0).collect()} == _mined(rows)


def test_scores_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(0, [1e18, 1e18], 1), (1, [1.0, 1.0], 1)], "vec_id bigint, embedding array<double>, label int")
    for search in (exact_top_k, hard_negatives):
        with pytest.raises(ValueError, match="64 bits"):
            search(df, F.col("vec_id") % 10 == 0)


def test_reading_sorted_lists_stops_early_and_keeps_the_best():
    random = np.random.default_rng(4)
    values, queries = random.integers(-600, 600, (4000, 8)), random.integers(-600, 600, (20, 8))
    lists, scores = Lists(np.arange(4000), values), values @ queries.T
    kth = np.sort(scores, axis=0)[-10]
    for floor in (np.full(20, -np.inf), kth.astype(float)):
        stopped = list(lists.open_rows(queries, floor, 10))
        assert sorted(q for q, _, _ in stopped) == list(range(20))
        for q, places, read in stopped:
            assert read < 4000 and len(places) <= 40 and set(np.flatnonzero(scores[:, q] >= kth[q])) <= set(places)


@pytest.mark.parametrize("shape", [(1, 1, 1), (70, 64, 131), (33, 35, 37), (5, 200, 3), (0, 4, 5), (128, 64, 256)])
def test_strassen_is_exact_with_wrapping_sums(shape):
    m, k, n = shape
    random = np.random.default_rng(5)
    a, b = random.integers(-(2**28), 2**28, (m, k)), random.integers(-(2**28), 2**28, (k, n))
    assert (strassen(a, b, leaf=4) == a @ b).all() and (strassen(a, b) == a @ b).all()


def test_heaps_merge_in_any_order():
    random = np.random.default_rng(6)
    scores, ids, allowed = random.integers(0, 9, (5, 60)), random.permutation(60), random.random((5, 60)) < 0.4
    whole, parts = Heaps(5, 4), Heaps(5, 4)
    whole.merge(scores, ids, allowed)
    for part in np.array_split(random.permutation(60), 9):
        parts.merge(scores[:, part], ids[part], allowed[:, part])
    assert (whole.scores == parts.scores).all() and (whole.ids == parts.ids).all()
    for i in range(5):
        assert [tuple(x) for x in zip(whole.scores[i], whole.ids[i])] == [(s, j) for s, j in sorted(((scores[i, c], ids[c]) for c in np.flatnonzero(allowed[i])), key=lambda x: (-x[0], x[1]))][:4]


@pytest.mark.parametrize("name", ["op11_top_k", "op13_hard_negatives"])
def test_sql_gives_the_same_rows(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in os.listdir(folder):
        if t.endswith(".parquet"):
            con.sql(f"create view {t[:-8]} as select * from '{folder}/{t}'")
    got = QUERIES[name](spark, folder)
    wanted = con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    wanted = wanted.select(", ".join(got.columns)).fetchall()
    assert wanted and sorted(map(tuple, got.collect())) == sorted(wanted)
